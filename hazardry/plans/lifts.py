"""Hazard inputs derived from the given tables.

The text of a lift is plain SQL that Spark and DuckDB read alike; ``{name}``
stands for a relation.  Positions are multiples of 1/64 degree, so their sums
are exact in doubles and do not depend on the order of addition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_TYPE = "CASE {0} % 4 WHEN 0 THEN 'earthquake' WHEN 1 THEN 'fire' WHEN 2 THEN 'flood' ELSE 'storm' END"
_LAT = "CAST(({0} * 7919) % 141 AS DOUBLE) - 70 + CAST(({1} * 31) % 256 - 128 AS DOUBLE) / 64"
_LON = "CAST(({0} * 104729) % 341 AS DOUBLE) - 170 + CAST(({1} * 17) % 256 - 128 AS DOUBLE) / 64"

# codes that stand in for the nations; SG has a region but no name, GW a name but
# no region, XK neither
_NATION_CODES = (
    "JP CN ID PH IN KZ TR GE GR DE UA GB NO RU US MX CU BR NG CD ET ZA EG SG GW".split()
)
_CODE = (
    "CASE n_nationkey "
    + " ".join(f"WHEN {i} THEN '{code}'" for i, code in enumerate(_NATION_CODES))
    + " ELSE 'XK' END"
)

LIFTS: dict[str, str] = {
    # one month of reports with a time of day
    "numbered": f"""
SELECT event_id AS n, concat('EV-', CAST(event_id AS VARCHAR(20))) AS event_id,
       {_TYPE.format('event_id')} AS event_type,
       CASE event_id % 4 WHEN 0 THEN least(value / 15, CAST(9.5 AS DOUBLE)) WHEN 1 THEN value * 20
                         WHEN 2 THEN value * 4 ELSE value * 2 END AS severity_raw,
       {_LAT.format('user_id', 'event_id')} AS latitude,
       {_LON.format('user_id', 'event_id')} AS longitude,
       ts AS event_time,
       concat('SRC-', CAST(user_id % 5 AS VARCHAR(20))) AS source
FROM {{events}}""",
    "live": """
SELECT event_id, event_type, severity_raw, latitude, longitude, event_time, source FROM {numbered}""",
    # live at positions that use every bit of a double
    "live_fine": """
SELECT event_id, event_type, latitude + severity_raw / 1000003 AS latitude, longitude + severity_raw / 700001 AS longitude
FROM {live}""",
    # live with faults in every field; one source sends its reports twice
    "live_dirty": """
SELECT CASE WHEN n % 101 = 0 THEN NULL ELSE event_id END AS event_id,
       CASE WHEN n % 83 = 0 THEN 'volcano' ELSE event_type END AS event_type,
       CASE WHEN n % 97 = 0 THEN NULL WHEN n % 89 = 1 THEN CAST(0 AS DOUBLE) ELSE severity_raw END AS severity_raw,
       CASE WHEN n % 89 = 0 THEN CAST(123 AS DOUBLE) ELSE latitude END AS latitude,
       longitude, event_time, event_time + INTERVAL '3' SECOND AS processed_at, source
FROM {numbered}
UNION ALL
SELECT event_id, event_type, severity_raw * 2 AS severity_raw, latitude, longitude, event_time,
       event_time + INTERVAL '60' SECOND AS processed_at, source
FROM {numbered} WHERE source = 'SRC-3'""",
    # years of events with a date and an hour
    "hist": f"""
SELECT concat('OR-', CAST(o_orderkey AS VARCHAR(20))) AS event_id,
       {_TYPE.format('o_orderkey')} AS event_type,
       CASE o_orderkey % 4 WHEN 0 THEN o_totalprice / 50000 WHEN 1 THEN o_totalprice / 50
                           WHEN 2 THEN o_totalprice / 250 ELSE o_totalprice / 1500 END AS severity_raw,
       {_LAT.format('o_custkey', 'o_orderkey')} AS latitude,
       {_LON.format('o_custkey', 'o_orderkey')} AS longitude,
       CAST(o_orderdate AS DATE) AS event_date,
       CAST(o_orderkey % 24 AS INT) AS event_hour,
       concat('SRC-', o_orderstatus) AS source
FROM {{orders}}""",
    # fire pixels of both sensors' shapes; an hour of 24 is not a time
    "pix": """
SELECT CAST((l_suppkey * 7919) % 141 AS DOUBLE) - 70 + CAST((l_orderkey * 31) % 52 AS DOUBLE) / 64 AS latitude,
       CAST((l_suppkey * 104729) % 341 AS DOUBLE) - 170 + CAST((l_partkey * 17) % 52 AS DOUBLE) / 64 AS longitude,
       l_quantity AS frp,
       CAST(8 + l_linenumber AS DOUBLE) / 8 AS scan,
       1 + CAST(l_linenumber % 4 AS DOUBLE) / 16 AS track,
       concat('01-', lpad(CAST(month(l_shipdate) AS VARCHAR(4)), 2, '0'), '-', CAST(year(l_shipdate) AS VARCHAR(4))) AS acq_date,
       CAST((l_orderkey % 25) * 100 + l_partkey % 60 AS INT) AS acq_time,
       CAST(l_orderkey % 101 AS INT) AS confidence,
       CASE l_orderkey % 4 WHEN 0 THEN 'l' WHEN 1 THEN 'n' WHEN 2 THEN ' H' ELSE 'x' END AS confidence_class,
       CASE WHEN l_linenumber = 7 THEN 2 ELSE 0 END AS type,
       300 + CAST(l_linenumber AS DOUBLE) * 1.5 AS brightness,
       250 + l_quantity / 2 AS background,
       l_returnflag AS satellite,
       l_linestatus AS daynight,
       l_orderkey * 100000000 + l_partkey * 1000 + (l_suppkey % 100) * 10 + l_linenumber AS row_no
FROM {lineitem}""",
    # high-water marks; y and x count 1/64 degrees
    "hwm": """
SELECT l_partkey AS event_id,
       CAST(((l_partkey * 7919) % 121 - 60) * 64 + (l_orderkey * 31) % 32 AS BIGINT) AS y,
       CAST(((l_partkey * 104729) % 341 - 170) * 64 + (l_orderkey * 17) % 32 AS BIGINT) AS x,
       CAST(((l_partkey * 7919) % 121 - 60) * 64 + (l_orderkey * 31) % 32 AS DOUBLE) / 64 AS latitude_dd,
       CAST(((l_partkey * 104729) % 341 - 170) * 64 + (l_orderkey * 17) % 32 AS DOUBLE) / 64 AS longitude_dd,
       l_quantity * 10 AS elev_ft,
       CAST(2 + l_orderkey % 3 AS INT) AS hwm_quality_id,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE l_shipdate END AS flag_date,
       CASE l_linestatus WHEN 'F' THEN 'Coastal' ELSE NULL END AS hwm_environment,
       l_returnflag AS stateName,
       concat('River ', CAST(l_suppkey AS VARCHAR(20))) AS waterbody,
       concat('Flood ', CAST(l_partkey AS VARCHAR(20))) AS eventName,
       l_orderkey * 100000000 + l_partkey * 1000 + (l_suppkey % 100) * 10 + l_linenumber AS row_no
FROM {lineitem}""",
    # cities: none beyond 61 degrees, so some events have none near
    "gaz": f"""
SELECT c_custkey AS row_no,
       CAST((c_custkey * 7919) % 121 AS DOUBLE) - 60 + CAST(c_custkey % 7 AS DOUBLE) / 8 AS lat,
       CAST((c_custkey * 104729) % 341 AS DOUBLE) - 170 + CAST(c_custkey % 9 AS DOUBLE) / 16 AS lon,
       {_CODE} AS cc
FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey""",
    # the marks with faults: no position, no quality
    "hwm_dirty": """
SELECT event_id, CASE WHEN row_no % 71 = 0 THEN NULL ELSE latitude_dd END AS latitude_dd, longitude_dd, elev_ft,
       CASE WHEN row_no % 73 = 0 THEN NULL ELSE hwm_quality_id END AS hwm_quality_id, row_no
FROM {hwm}""",
    # flat columns of the raw agency records
    "raw_quake": f"""
SELECT concat('us', CAST(event_id AS VARCHAR(20))) AS id,
       CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST((event_id * 13) % 95 AS DOUBLE) / 10 END AS mag,
       CAST(1704067200000 + event_id * 259207 AS BIGINT) AS time_ms,
       CASE user_id % 7 WHEN 0 THEN 'us' WHEN 1 THEN 'eu' WHEN 2 THEN 'jp' WHEN 3 THEN 'es'
                        WHEN 4 THEN 'nz' WHEN 5 THEN 'xx' ELSE NULL END AS net,
       CASE WHEN event_id % 5 = 0 THEN NULL ELSE 'reviewed' END AS status,
       CAST(user_id % 2 AS INT) AS tsunami,
       CAST(user_id AS INT) AS sig,
       {_LAT.format('user_id', 'event_id')} AS lat,
       {_LON.format('user_id', 'event_id')} AS lon,
       CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(user_id AS DOUBLE) END AS depth,
       CASE WHEN event_id % 53 = 0 THEN 'Polygon' ELSE 'Point' END AS shape
FROM {{events}}""",
    "raw_fire": f"""
SELECT CAST(CAST(ts AS DATE) AS VARCHAR(10)) AS acq_date,
       CAST((event_id % 24) * 100 + user_id % 60 AS VARCHAR(10)) AS acq_time,
       CASE WHEN event_id % 61 = 0 THEN NULL ELSE value END AS frp,
       {_LAT.format('user_id', 'event_id')} AS latitude,
       {_LON.format('user_id', 'event_id')} AS longitude
FROM {{events}}""",
    "raw_flood": f"""
SELECT event_id AS hwm_id,
       value AS height_above_gnd_ft,
       concat(CAST(CAST(ts AS DATE) AS VARCHAR(10)), CASE WHEN event_id % 2 = 0 THEN 'T06:00:00' ELSE 'T18:30:00Z' END) AS peak_date,
       {_LAT.format('user_id', 'event_id')} AS site_latitude,
       CASE WHEN event_id % 59 = 0 THEN NULL ELSE {_LON.format('user_id', 'event_id')} END AS site_longitude
FROM {{events}}""",
    "raw_storm": f"""
SELECT concat('S', CAST(event_id AS VARCHAR(20))) AS sid,
       CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST((event_id * 37) % 1800 AS DOUBLE) / 10 END AS wmo_wind,
       concat(CAST(CAST(ts AS DATE) AS VARCHAR(10)), ' 0', CAST(user_id % 10 AS VARCHAR(2)), ':00:00') AS iso_time,
       {_LAT.format('user_id', 'event_id')} AS lat,
       {_LON.format('user_id', 'event_id')} AS lon
FROM {{events}}""",
    "raw_weather": f"""
SELECT event_id AS dt_no,
       CAST(1704067200 + event_id * 259 AS BIGINT) AS dt,
       user_id AS city_id,
       concat('City ', CAST(user_id AS VARCHAR(20))) AS city_name,
       CASE WHEN event_id % 41 = 0 THEN NULL ELSE CAST((event_id * 29) % 400 AS DOUBLE) / 10 END AS wind_ms,
       CASE WHEN event_id % 4 = 0 THEN NULL ELSE CAST((event_id * 31) % 500 AS DOUBLE) / 10 END AS gust_ms,
       CASE WHEN event_id % 6 = 0 THEN NULL ELSE CAST(980 + user_id % 50 AS INT) END AS pressure,
       CASE WHEN event_id % 2 = 0 THEN NULL ELSE CAST(event_id % 9 AS DOUBLE) / 2 END AS rain_1h,
       CAST(200 + (event_id * 7) % 650 AS INT) AS code_1,
       CAST(200 + (event_id * 11) % 650 AS INT) AS code_2,
       {_LAT.format('user_id', 'event_id')} AS lat,
       {_LON.format('user_id', 'event_id')} AS lon
FROM {{events}}""",
}

_TABLES = ("events", "orders", "lineitem", "customer", "nation")


def needs(name: str) -> list[str]:
    """Relations a lift reads."""
    return [r for r in (*_TABLES, *LIFTS) if "{" + r + "}" in LIFTS[name]]


def lift(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One derived input.  Times come out as timestamps of the session zone, UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    frames = {
        r: lift(spark, sf_dir, r)
        if r in LIFTS
        else spark.read.parquet(f"{sf_dir.rstrip('/')}/{r}.parquet")
        for r in needs(name)
    }
    out = spark.sql(LIFTS[name], **frames)
    zoneless = [f.name for f in out.schema.fields if f.dataType.typeName() == "timestamp_ntz"]
    return out.withColumns({c: F.col(c).cast("timestamp") for c in zoneless}) if zoneless else out


def lift_stream(events: DataFrame) -> DataFrame:
    """The live lift over a streaming read of the events table."""
    spark = events.sparkSession
    out = spark.sql(LIFTS["live"], numbered=spark.sql(LIFTS["numbered"], events=events))
    return out.withColumn("event_time", F.col("event_time").cast("timestamp"))
