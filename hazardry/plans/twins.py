"""SQL twins of the registered queries, for DuckDB on the same tables.

A twin says the same thing in plain SQL: self-joins, window functions and edge
tests instead of the operators' aggregations.  CTEs are listed once in ``CTES``
and pulled in by name.
"""

from __future__ import annotations

import re

from hazardry.constants import COUNTRY_BY_CODE, REGION_BY_CODE
from hazardry.plans.catalog import AS_OF, BOX, CENTER, RANGE
from hazardry.plans.lifts import LIFTS

ISO = "'%Y-%m-%dT%H:%M:%SZ'"

# --- fixed values, written out a second time so that a wrong one in the engine shows ---
KINDS = ("earthquake", "fire", "flood", "storm")
LEVELS = ("LOW", "MEDIUM", "HIGH", "CRITICAL")
FMI_LEVELS = {
    "earthquake": (1.5, 3.0, 5.0, 7.0),
    "fire": (5.0, 20.0, 50.0, 200.0),
    "flood": (0.5, 1.0, 2.0, 3.0),
    "storm": (35.0, 62.0, 120.0, 200.0),
}
CM_LEVELS = {
    "earthquake": (1.5, 3.0, 5.0, 7.0),
    "fire": (5.0, 100.0, 2000.0, 7000.0),
    "flood": (5.0, 50.0, 200.0, 800.0),
    "storm": (35.0, 62.0, 120.0, 200.0),
}
BEAUFORT = (0.3, 1.6, 3.4, 5.5, 8.0, 10.8, 13.9, 17.2, 20.8, 24.5, 28.5, 32.7)
RANGES = {"earthquake": (0.0, 9.5), "fire": (0.0, 10000.0), "flood": (0.0, 2000.0), "storm": (0.0, 300.0)}
TARGETS = {
    "earthquake": {1980: 740, 1990: 740, 2000: 740, 2010: 740, 2020: 740, 2025: 740},
    "flood": {1980: 820, 1990: 880, 2000: 980, 2010: 1080, 2020: 1200, 2025: 1200},
    "storm": {1980: 740, 1990: 880, 2000: 1080, 2010: 1320, 2020: 1600, 2025: 1600},
    "fire": {1980: 820, 1990: 1020, 2000: 1320, 2010: 1750, 2020: 2200, 2025: 2200},
}
ZOOM_4_CELL, ZOOM_2_CELL, ZOOM_6_CELL = 6.0, 5.0, 0.2
ZOOM_2_HEX_KM2, ZOOM_6_HEX_KM2 = 86000.0, 12000.0
ZOOM_6_CAP = 80


def _plain(text: str) -> str:
    """A lift with its relations named as they are."""
    return re.sub(r"\{(\w+)\}", r"\1", text)


def _round(x: str, digits: int) -> str:
    """Exact rounding of a double column, true ties to even."""
    scale = float(10**digits)
    top = 134217729.0 * scale - (134217729.0 * scale - scale)
    high, low = (f"CAST({v!r} AS DOUBLE)" for v in (top, scale - top))
    p = f"({x} * CAST({scale!r} AS DOUBLE))"
    c = f"({x} * CAST(134217729 AS DOUBLE))"
    h = f"({c} - ({c} - {x}))"
    rest = f"({x} - {h})"
    error = f"((({h} * {high} - {p}) + {h} * {low} + {rest} * {high}) + {rest} * {low})"
    whole = f"floor({p})"
    up = (
        f"{p} - {whole} > 0.5 OR ({p} - {whole} = 0.5 AND "
        f"({error} > 0 OR ({error} = 0 AND CAST({whole} AS BIGINT) % 2 <> 0)))"
    )
    return f"(({whole} + CASE WHEN {up} THEN 1 ELSE 0 END) / CAST({scale!r} AS DOUBLE))"


def _level(kind: str, value: str, profile: str, below: str) -> str:
    low = {"low": "'LOW'", "drop": "NULL", "label": "'DROP'"}[below]
    arms = []
    for name, (least, medium, high, top) in {"fmi": FMI_LEVELS, "cm": CM_LEVELS}[profile].items():
        arms.append(
            f"WHEN {kind} = '{name}' THEN CASE WHEN {value} < {least} THEN {low} WHEN {value} < {medium} THEN 'LOW' "
            f"WHEN {value} < {high} THEN 'MEDIUM' WHEN {value} < {top} THEN 'HIGH' ELSE 'CRITICAL' END"
        )
    return f"(CASE WHEN {value} IS NULL THEN NULL {' '.join(arms)} END)"


_KINDS = "(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
_HEMISPHERE = (
    "concat(CASE WHEN {0} >= 0 THEN 'North' ELSE 'South' END, ' ', "
    "CASE WHEN {1} >= 0 THEN 'East' ELSE 'West' END, ' Hemisphere')"
)
_BOX_WHERE = f"latitude BETWEEN {BOX[0]} AND {BOX[1]} AND longitude BETWEEN {BOX[2]} AND {BOX[3]}"
GEODESIC_BOX = (20.003, 50.003, 60.003, 120.003)
# the latitude of a great circle through two positions of one latitude, at a longitude between them
_BOW = "degrees(atan(tan(radians({0})) / cos(radians({1} - {2}) / 2) * cos(radians(longitude - ({1} + {2}) / 2))))"
_GEODESIC_WHERE = (
    f"longitude BETWEEN {GEODESIC_BOX[2]} AND {GEODESIC_BOX[3]} AND latitude BETWEEN "
    + " AND ".join(_BOW.format(lat, GEODESIC_BOX[3], GEODESIC_BOX[2]) for lat in GEODESIC_BOX[:2])
)
_TYPE_KEY = "CASE event_type " + " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(KINDS, 1)) + " END"


def _codes() -> str:
    quoted = lambda v: "NULL" if v is None else "'" + v.replace("'", "''") + "'"
    rows = [
        f"('{c}', {quoted(COUNTRY_BY_CODE.get(c))}, {quoted(REGION_BY_CODE.get(c))})"
        for c in sorted({*COUNTRY_BY_CODE, *REGION_BY_CODE})
    ]
    return f"SELECT * FROM (VALUES {', '.join(rows)}) AS t(cc, country_name, region_name)"


def _near(source: str) -> str:
    """Nearest city of every point of ``source`` by the ring-limited search."""
    return f"""
SELECT latitude, longitude, coalesce(cc, '') AS cc FROM (
  SELECT p.latitude, p.longitude, g.cc,
         row_number() OVER (PARTITION BY p.latitude, p.longitude
           ORDER BY g.row_no IS NULL, greatest(abs(p.dlat), abs(p.dlon), 1),
                    (g.lat - p.latitude) * (g.lat - p.latitude) + (g.lon - p.longitude) * (g.lon - p.longitude),
                    p.dlat, p.dlon, g.row_no) AS n
  FROM (SELECT q.*, o.dlat, o.dlon FROM (SELECT DISTINCT latitude, longitude, trunc(latitude) AS clat, trunc(longitude) AS clon FROM {source}) q,
               (SELECT a.i AS dlat, b.i AS dlon FROM range(-3, 4) a(i), range(-3, 4) b(i)) o) p
  LEFT JOIN (SELECT *, trunc(lat) AS clat, trunc(lon) AS clon FROM gaz) g
    ON g.clat = p.clat + p.dlat AND g.clon = p.clon + p.dlon) ranked
WHERE n = 1"""


def _placed(near: str) -> str:
    return f"""
SELECT n.latitude, n.longitude, n.cc,
       coalesce(country_name, nullif(n.cc, ''), 'Unknown') AS country,
       coalesce(region_name, {_HEMISPHERE.format('n.latitude', 'n.longitude')}) AS region
FROM {near} n LEFT JOIN codes ON codes.cc = n.cc"""


_FIRE_GROUP = """
SELECT cell_lat, cell_lon, acq_date, sum(frp) AS frp_sum, sum(scan * track) AS area_sum,
       sum(latitude * frp) AS lat_frp, sum(longitude * frp) AS lon_frp, count(*) AS pixel_count,
       avg(conf) AS conf_avg, avg(brightness) AS bright_avg, avg(background) AS back_avg,
       arg_min(struct_pack(t := acq_time, s := satellite, d := daynight), acq_time * 10000000000000000::HUGEINT + row_no) AS first
FROM (SELECT *, floor(latitude / 0.5) * 0.5 AS cell_lat, floor(longitude / 0.5) * 0.5 AS cell_lon, {conf} AS conf
      FROM pix WHERE type = 0 AND {keep}) kept
GROUP BY cell_lat, cell_lon, acq_date"""

_FIRE_EVENTS = """
SELECT concat('FIRMS-{name}-', printf('%.2f', cell_lat), '-', printf('%.2f', cell_lon), '-', acq_date) AS event_id,
       'fire' AS event_type, {frp} AS severity_raw, {lat} AS latitude, {lon} AS longitude,
       CASE WHEN first.t >= 2400 THEN '2024-01-01T00:00:00Z' ELSE
         concat(substring(acq_date, 7, 4), '-', substring(acq_date, 4, 2), '-', substring(acq_date, 1, 2),
                'T', lpad(CAST(first.t // 100 AS VARCHAR), 2, '0'), ':', lpad(CAST(first.t % 100 AS VARCHAR), 2, '0'), ':00Z') END AS timestamp,
       'NASA_FIRMS_{name}' AS source, {mag} AS magnitude, {area} AS area_km2, {frp} AS frp_mw,
       pixel_count, {conf} AS confidence_pct, {bright} AS brightness_k, {back} AS background_temp_k,
       first.s AS satellite, first.d AS daynight
FROM (SELECT *, lat_frp / frp_sum AS lat_c, lon_frp / frp_sum AS lon_c, log10(frp_sum + 1) AS lg FROM {grouped}) g
WHERE {frp} >= 5.0"""


def _fires(name: str, grouped: str) -> str:
    return _FIRE_EVENTS.format(
        name=name,
        grouped=grouped,
        frp=_round("frp_sum", 2),
        lat=_round("lat_c", 6),
        lon=_round("lon_c", 6),
        mag=_round("lg", 4),
        area=_round("area_sum", 4),
        conf=_round("conf_avg", 1),
        bright=_round("bright_avg", 1),
        back=_round("back_avg", 1),
    )


def _hull(points: str, keys: str, on: str) -> str:
    """Hull area in grid units squared: a directed pair is an edge if no point lies to
    its right and none is collinear outside it; the area is half the sum of cross products."""
    return f"""
SELECT {keys}, CAST(coalesce(sum(CASE WHEN is_edge THEN px * qy - qx * py ELSE 0 END), 0) AS DOUBLE) / 2 AS grid_area
FROM (SELECT {', '.join('p.' + k.strip() for k in keys.split(','))}, p.x AS px, p.y AS py, q.x AS qx, q.y AS qy,
             NOT EXISTS (SELECT 1 FROM {points} r WHERE {on.format('r', 'p')} AND (
               (q.x - p.x) * (r.y - p.y) - (q.y - p.y) * (r.x - p.x) < 0 OR (
               (q.x - p.x) * (r.y - p.y) - (q.y - p.y) * (r.x - p.x) = 0 AND
               ((r.x - p.x) * (r.x - q.x) + (r.y - p.y) * (r.y - q.y) > 0)))) AS is_edge
      FROM {points} p JOIN {points} q ON {on.format('q', 'p')} AND (p.x <> q.x OR p.y <> q.y)) pairs
GROUP BY {keys}"""


_FACT_RANGE = f"event_date BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'"
_HOUR_TEXT = "concat(strftime(event_date, '%Y-%m-%d'), ' ', lpad(CAST(event_hour AS VARCHAR), 2, '0'), ':00:00')"

CTES: dict[str, str] = {
    **{name: _plain(text) for name, text in LIFTS.items()},
    "codes": _codes(),
    "uni": f"SELECT * REPLACE (CAST(event_id AS VARCHAR) AS event_id), strftime(event_time, {ISO}) AS ts_text FROM live_dirty",
    "gated": f"SELECT * FROM uni WHERE event_id IS NOT NULL AND event_type IN {_KINDS} AND severity_raw IS NOT NULL",
    "proc": f"""
SELECT * FROM (SELECT event_id, event_type, {_level('event_type', 'severity_raw', 'cm', 'drop')} AS severity_level, latitude, longitude,
       ts_text AS event_time, strftime(processed_at, {ISO}) AS processed_at, source,
       date_trunc('second', event_time) AS t, processed_at AS p FROM gated) x WHERE severity_level IS NOT NULL""",
    "stored": "SELECT * FROM proc QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY p DESC) = 1",
    "ev": f"""
SELECT * FROM (SELECT *, {_level('event_type', 'severity_raw', 'cm', 'drop')} AS severity_level FROM hist) x
WHERE severity_level IS NOT NULL""",
    "near_ev": _near("ev"),
    "placed_ev": _placed("near_ev"),
    "wide": "SELECT ev.*, country, region FROM ev JOIN placed_ev USING (latitude, longitude)",
    "near_live": _near("live"),
    "placed_live": _placed("near_live"),
    "near_fine": _near("live_fine"),
    "modis_groups": _FIRE_GROUP.format(conf="confidence", keep="confidence >= 30"),
    "csv_groups": _FIRE_GROUP.format(conf="confidence", keep="confidence >= 30 AND row_no % 67 <> 0"),
    "viirs_groups": _FIRE_GROUP.format(
        conf="CASE lower(trim(confidence_class)) WHEN 'l' THEN 25 WHEN 'n' THEN 60 WHEN 'h' THEN 90 ELSE 60 END",
        keep="lower(trim(confidence_class)) <> 'l'",
    ),
    "marks_xy": "SELECT DISTINCT event_id, x, y FROM hwm",
    "good_xy": """
SELECT DISTINCT h.event_id, x, y FROM hwm h JOIN (SELECT event_id, count_if(hwm_quality_id <= 3) AS good FROM hwm GROUP BY event_id) g USING (event_id)
WHERE good = 0 OR hwm_quality_id <= 3""",
    "good_hull": _hull("good_xy", "event_id", "{0}.event_id = {1}.event_id"),
    "norm_quake_rows": f"""
SELECT sha256(concat_ws('|', 'earthquake', id, CAST(time_ms AS VARCHAR), CAST(lon AS VARCHAR), CAST(lat AS VARCHAR), CAST(mag AS VARCHAR))) AS event_id,
       'earthquake' AS event_type, mag AS severity_raw, lat AS latitude, lon AS longitude,
       strftime(make_timestamp(time_ms * 1000), {ISO}) AS timestamp,
       CASE net WHEN 'eu' THEN 'EMSC' WHEN 'jp' THEN 'JMA' WHEN 'es' THEN 'IGN' WHEN 'nz' THEN 'GeoNet' ELSE 'USGS' END AS source
FROM raw_quake""",
    "norm_fire_rows": """
SELECT sha256(concat_ws('|', 'fire', acq_date, acq_time, CAST(latitude AS VARCHAR), CAST(longitude AS VARCHAR), CAST(frp AS VARCHAR))) AS event_id,
       'fire' AS event_type, frp AS severity_raw, latitude, longitude,
       concat(acq_date, 'T', substring(lpad(acq_time, 4, '0'), 1, 2), ':', substring(lpad(acq_time, 4, '0'), 3, 2), ':00Z') AS timestamp,
       'NASA-FIRMS' AS source FROM raw_fire""",
    "norm_flood_rows": f"""
SELECT sha256(concat_ws('|', 'flood', CAST(hwm_id AS VARCHAR), peak_date, CAST(site_latitude AS VARCHAR), CAST(site_longitude AS VARCHAR))) AS event_id,
       'flood' AS event_type, {_round('cm', 2)} AS severity_raw, site_latitude AS latitude, site_longitude AS longitude,
       CASE WHEN peak_date LIKE '%Z' THEN peak_date ELSE peak_date || 'Z' END AS timestamp, 'USGS-HWM' AS source
FROM (SELECT *, height_above_gnd_ft * CAST(30.48 AS DOUBLE) AS cm FROM raw_flood) f""",
    "norm_storm_rows": f"""
SELECT sha256(concat_ws('|', 'storm', sid, iso_time, CAST(lat AS VARCHAR), CAST(lon AS VARCHAR))) AS event_id,
       'storm' AS event_type, {_round('kmh', 1)} AS severity_raw, lat AS latitude, lon AS longitude,
       replace(iso_time, ' ', 'T') || 'Z' AS timestamp, 'IBTrACS' AS source
FROM (SELECT *, coalesce(wmo_wind, 0) * CAST(1.852 AS DOUBLE) AS kmh FROM raw_storm) s""",
    "norm_rows": """
SELECT * FROM norm_quake_rows UNION ALL SELECT * FROM norm_fire_rows
UNION ALL SELECT * FROM norm_flood_rows UNION ALL SELECT * FROM norm_storm_rows""",
    "quakes": f"""
SELECT *, pow(CAST(10 AS DOUBLE), mag * CAST(0.91 AS DOUBLE) + CAST(-3.49 AS DOUBLE)) AS area,
       strftime(make_timestamp(time_ms * 1000), {ISO}) AS time_text
FROM raw_quake WHERE shape = 'Point' AND mag IS NOT NULL""",
    "stormy": """
SELECT * FROM raw_weather WHERE coalesce(rain_1h, 0) >= 2.5 OR coalesce(wind_ms, 0) >= 10
  OR code_1 BETWEEN 200 AND 299 OR code_2 BETWEEN 200 AND 299""",
    "publishable": f"""
SELECT event_id, event_type, severity_raw, latitude, longitude, ts_text AS timestamp, source FROM gated
WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180""",
}


def _with(select: str) -> str:
    """Prefix a statement with the CTEs it names, in order of need."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in ordered and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                visit(CTES[name])
                if name not in ordered:
                    ordered.append(name)

    visit(select)
    if not ordered:
        return select
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in ordered) + "\n" + select


_PROC = "event_id, event_type, severity_level, latitude, longitude, event_time, processed_at, source"
_UNI = "event_id, event_type, severity_raw, latitude, longitude, ts_text AS timestamp, source"

_BEAUFORT = "CASE " + " ".join(f"WHEN wind < {b} THEN {i}" for i, b in enumerate(BEAUFORT)) + " ELSE 12 END"
_BASIN = """CASE WHEN lat >= 0 THEN CASE WHEN lon >= 100 THEN 'WP' WHEN lon >= 40 THEN 'NI' WHEN lon < -100 THEN 'EP' ELSE 'NA' END
 ELSE CASE WHEN lon >= 90 THEN 'SP' ELSE 'SI' END END"""


def _range_case(which: int) -> str:
    arms = " ".join(f"WHEN '{k}' THEN {r[which]}" for k, r in RANGES.items())
    return f"CASE event_type {arms} END"


def _target_case() -> str:
    arms = []
    for kind, anchors in TARGETS.items():
        points = sorted(anchors.items())
        inner = f"WHEN year <= {points[0][0]} THEN {points[0][1]} "
        for (y0, v0), (y1, v1) in zip(points, points[1:]):
            inner += f"WHEN year <= {y1} THEN (year - {y0}) / CAST({y1 - y0} AS DOUBLE) * {v1 - v0} + {v0} "
        arms.append(f"WHEN '{kind}' THEN CASE {inner} ELSE {points[-1][1]} END")
    return f"CAST(round_even(CAST(CASE event_type {' '.join(arms)} END AS DOUBLE), 0) AS INTEGER)"


def _cells(cell: float, where: str) -> str:
    return f"""
SELECT round(latitude / CAST({cell} AS DOUBLE)) AS gy, round(longitude / CAST({cell} AS DOUBLE)) AS gx, event_type,
       sum(latitude) AS lat_sum, sum(longitude) AS lng_sum, count(*) AS n FROM ev WHERE {where} GROUP BY 1, 2, 3"""


def _hexes(pre_cell: float, hex_km2: float, where: str, least: int, cap: int) -> str:
    """Hexagons of the given area, pointy top, on the plane of degrees."""
    edge = f"(sqrt(CAST({hex_km2} AS DOUBLE) * 2 / (3 * sqrt(CAST(3 AS DOUBLE)))) / 111)"
    third = "(sqrt(CAST(3 AS DOUBLE)) / 3)"
    return _with(f"""
SELECT lat, lng, event_type, event_count FROM (
  SELECT lat_sum / event_count AS lat, lng_sum / event_count AS lng, event_type, event_count,
         row_number() OVER (PARTITION BY event_type ORDER BY event_count DESC, lat_sum / event_count, lng_sum / event_count) AS n
  FROM (SELECT hq, hr, event_type, sum(lat_sum) AS lat_sum, sum(lng_sum) AS lng_sum, CAST(sum(n) AS BIGINT) AS event_count FROM (
    SELECT *, CASE WHEN abs(rq - q) > abs(rr - r) AND abs(rq - q) > abs(rs - s) THEN -rr - rs ELSE rq END AS hq,
           CASE WHEN abs(rq - q) > abs(rr - r) AND abs(rq - q) > abs(rs - s) THEN rr
                WHEN abs(rr - r) > abs(rs - s) THEN -rq - rs ELSE rr END AS hr
    FROM (SELECT *, floor(q + 0.5) AS rq, floor(r + 0.5) AS rr, floor(s + 0.5) AS rs
          FROM (SELECT *, -q - r AS s FROM (
            SELECT *, (lng_sum / n * {third} - lat_sum / n * CAST({1.0 / 3.0!r} AS DOUBLE)) / {edge} AS q,
                   lat_sum / n * CAST({2.0 / 3.0!r} AS DOUBLE) / {edge} AS r
            FROM ({_cells(pre_cell, where)}) f) a) b) c) d
    GROUP BY hq, hr, event_type) e WHERE event_count >= {least}) g WHERE n <= {cap}""")


_QUAKE_COLUMNS = f"""id AS event_id, mag AS magnitude, {_round('area', 4)} AS area_km2, coalesce(depth, 0) AS depth_km,
 tsunami <> 0 AS tsunami, coalesce(status, 'automatic') AS review_status, coalesce(net, '') AS network, time_text AS timestamp"""

_PIXEL_COLUMNS = """row_no, latitude, longitude, CASE WHEN row_no % 67 = 0 THEN NULL ELSE frp END AS frp, scan, track, acq_date, acq_time,
 satellite, {confidence} AS confidence, brightness, CAST(type AS INTEGER) AS type, CASE WHEN row_no % 67 = 0 THEN 'frp' END AS reason"""

_PASSED = f"""
SELECT event_type, severity_raw, {_level('event_type', 'severity_raw', 'cm', 'drop')} AS level,
       event_id IS NOT NULL AND event_type IN {_KINDS} AND severity_raw IS NOT NULL AS valid FROM"""


def _stats(source: str) -> str:
    passed = "valid AND level IS NOT NULL"
    measures = {
        "received": "count(*)",
        "processed": f"count_if({passed})",
        "dropped_invalid": "count_if(NOT valid)",
        "dropped_below_threshold": "count_if(valid AND level IS NULL)",
        **{f"type:{k}": f"count_if({passed} AND event_type = '{k}')" for k in KINDS},
        **{f"level:{v}": f"count_if({passed} AND level = '{v}')" for v in LEVELS},
        "total_dropped": "count_if(NOT valid) + count_if(valid AND level IS NULL)",
        "pass_rate": f"CAST(count_if({passed}) AS DOUBLE) / count(*) * 100",
        "drop_rate": "CAST(count_if(NOT valid) + count_if(valid AND level IS NULL) AS DOUBLE) / count(*) * 100",
    }
    return _with(
        " UNION ALL ".join(
            f"SELECT '{n}' AS measure, CAST({e} AS DOUBLE) AS value FROM ({_PASSED} {source}) c" for n, e in measures.items()
        )
    )


def _loads() -> str:
    steps = []
    for step, where in ((1, "event_date < DATE '1998-01-01'"), (2, "true"), (3, "true")):
        for table, what in (
            ("fact", "count(*)"),
            ("location", "count(DISTINCT (latitude, longitude))"),
            ("time", "count(DISTINCT (event_date, event_hour))"),
            ("event_type", "count(DISTINCT event_type)"),
        ):
            steps.append(f"SELECT {step} AS load_no, '{table}' AS table_name, {what} AS row_count FROM ev WHERE {where}")
    return _with(" UNION ALL ".join(steps))


def _summary(where: str, source: str = "ev") -> str:
    return _with(f"""
SELECT 'type' AS dimension, event_type AS label, count(*) AS event_count FROM {source} WHERE {where} GROUP BY event_type
UNION ALL SELECT 'severity', severity_level, count(*) FROM {source} WHERE {where} GROUP BY severity_level
UNION ALL SELECT 'total', 'all', count(*) FROM {source} WHERE {where}""")


_TREND = """
SELECT CAST(year(event_date) AS INTEGER) AS year, CAST(month(event_date) AS INTEGER) AS month,
       monthname(min(event_date)) AS month_name, count(*) AS event_count FROM {0} WHERE {1} GROUP BY 1, 2"""
_TOP = """
SELECT country, region, count(*) AS event_count FROM wide WHERE {0} GROUP BY country, region
ORDER BY event_count DESC, country, region LIMIT {1}"""
_TIME_KEY = "year(event_date) * 1000000 + month(event_date) * 10000 + day(event_date) * 100 + event_hour"
_PLACE_KEY = "concat(CAST(latitude + 0.0 AS VARCHAR), ',', CAST(longitude + 0.0 AS VARCHAR))"
_SEARCH_WHERE = f"{_FACT_RANGE} AND event_type IN ('fire', 'storm') AND region ILIKE '%asia%'"
_REACH = CENTER[2] / 111.0
_NEAR_WHERE = (
    f"latitude BETWEEN {CENTER[0] - _REACH!r} AND {CENTER[0] + _REACH!r} "
    f"AND longitude BETWEEN {CENTER[1] - _REACH!r} AND {CENTER[1] + _REACH!r}"
)
_STREAMED = f"""
SELECT event_id, event_type, {_level('event_type', 'severity_raw', 'cm', 'drop')} AS severity_level, latitude, longitude,
       strftime(event_time, {ISO}) AS event_time, date_trunc('second', event_time) AS t,
       strftime(date_trunc('second', event_time) + INTERVAL '3' SECOND, {ISO}) AS processed_at, source FROM live"""
CTES["streamed"] = f"SELECT * FROM ({_STREAMED}) x WHERE severity_level IS NOT NULL"

_STRICT = f"""
SELECT {_UNI}, concat_ws('; ', CASE WHEN event_id IS NULL THEN 'missing event_id' END,
  CASE WHEN severity_raw IS NULL THEN 'missing severity_raw' END,
  CASE WHEN event_type NOT IN {_KINDS} THEN 'unknown event_type' END,
  CASE WHEN latitude NOT BETWEEN -90 AND 90 THEN 'latitude out of range' END) AS reasons FROM uni"""

_FLOODS = f"""
SELECT g.*, h.grid_area / 4096 AS deg2,
       CASE WHEN good > 0 THEN good ELSE marks END AS points,
       CASE WHEN good > 0 THEN lat_good ELSE lat_all END AS lat_c, CASE WHEN good > 0 THEN lon_good ELSE lon_all END AS lon_c
FROM (SELECT event_id, count(*) AS marks, count_if(hwm_quality_id <= 3) AS good, min(hwm_quality_id) AS best,
             avg(latitude_dd) FILTER (hwm_quality_id <= 3) AS lat_good, avg(longitude_dd) FILTER (hwm_quality_id <= 3) AS lon_good,
             avg(latitude_dd) AS lat_all, avg(longitude_dd) AS lon_all, avg(elev_ft) AS mean_elev, min(elev_ft) AS min_elev,
             min(flag_date) AS f0, max(flag_date) AS f1,
             arg_min(struct_pack(env := hwm_environment, st := stateName, wb := waterbody, en := eventName), row_no) AS m
      FROM hwm GROUP BY event_id) g LEFT JOIN good_hull h USING (event_id)
WHERE best <= 3 OR marks >= 3"""
CTES["flood_facts"] = _FLOODS
CTES["flood_scores"] = """
SELECT *, CASE WHEN points >= 3 THEN coalesce(deg2, 0) * CAST(111 AS DOUBLE) * (CAST(111 AS DOUBLE) * cos(radians(lat_c))) ELSE 1.0 END AS area,
       least(CAST(5 AS DOUBLE), (mean_elev - min_elev) * CAST(0.3048 AS DOUBLE) / 2) AS depth,
       CASE WHEN f0 IS NULL THEN CAST(24 AS DOUBLE) ELSE greatest(CAST(1 AS DOUBLE), (epoch_us(f1) - epoch_us(f0)) / CAST(3600000000 AS DOUBLE)) END AS hours
FROM flood_facts"""
CTES["flood_index"] = """
SELECT *, log10(area + 1) * CAST(0.5 AS DOUBLE) + depth * CAST(0.3 AS DOUBLE) + log10(hours + 1) * CAST(0.2 AS DOUBLE) AS raw FROM flood_scores"""

_EDGE_4 = "(sqrt(CAST(1700 AS DOUBLE) * 2 / (3 * sqrt(CAST(3 AS DOUBLE)))) / 111)"

TWINS: dict[str, str] = {
    # sources
    "src_geojson_quakes": _with(f"""
SELECT id AS event_id, 'earthquake' AS event_type, mag AS severity_raw, lat AS latitude, lon AS longitude, time_text AS timestamp,
       'USGS_EQ' AS source, mag AS magnitude, {_round('area', 4)} AS area_km2, coalesce(depth, 0) AS depth_km, tsunami <> 0 AS tsunami, sig AS significance, concat('near ', id) AS place,
       coalesce(status, 'automatic') AS review_status, coalesce(net, '') AS network FROM quakes"""),
    "src_firms_modis": _with(f"SELECT {_PIXEL_COLUMNS.format(confidence='confidence')} FROM pix"),
    "src_firms_viirs": _with(f"SELECT {_PIXEL_COLUMNS.format(confidence='lower(trim(confidence_class))')} FROM pix"),
    "src_hwm_json": _with(f"""
SELECT event_id, latitude_dd, longitude_dd, elev_ft, hwm_quality_id, strftime(flag_date, {ISO}) AS flag_date, hwm_environment,
       stateName, waterbody, eventName, count(*) AS copies FROM hwm GROUP BY ALL"""),
    "src_openweather_json": _with("""
SELECT dt, city_id AS id, lat, lon, wind_ms, rain_1h, pressure, 2 AS conditions FROM raw_weather"""),
    "src_union_feeds": _with(f"""
SELECT event_id, event_type, severity_raw, latitude, longitude, strftime(event_time, {ISO}) AS timestamp, source FROM live"""),
    # normalisers and adapters
    "norm_quake": _with("SELECT * FROM norm_quake_rows"),
    "norm_fire": _with("SELECT * FROM norm_fire_rows"),
    "norm_flood": _with("SELECT * FROM norm_flood_rows"),
    "norm_storm": _with("SELECT * FROM norm_storm_rows"),
    "norm_all": _with("""
SELECT * FROM norm_rows WHERE severity_raw IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL AND timestamp IS NOT NULL"""),
    "norm_rejects": _with("""
SELECT event_type, CASE WHEN severity_raw IS NULL THEN 'severity_raw' WHEN latitude IS NULL THEN 'latitude' ELSE 'longitude' END AS reason,
       count(*) AS row_count FROM norm_rows WHERE severity_raw IS NULL OR latitude IS NULL OR longitude IS NULL GROUP BY 1, 2"""),
    "quake_area": _with(f"SELECT {_QUAKE_COLUMNS} FROM quakes"),
    "storm_gate": _with("SELECT dt, city_id AS id, city_name FROM stormy"),
    "storm_adapter": _with(f"""
SELECT concat('OWM-', city_id, '-', dt) AS event_id, 'storm' AS event_type, {_round('kmh', 2)} AS severity_raw, lat AS latitude, lon AS longitude,
       strftime(make_timestamp(dt * 1000000), {ISO}) AS timestamp, 'OPENWEATHER' AS source, CAST({_BEAUFORT} AS DOUBLE) AS magnitude,
       coalesce(rain_1h, 0) AS rain_1h_mm, CAST(0 AS DOUBLE) AS rain_3h_mm, wind AS wind_speed_ms, {_round('kmh', 2)} AS wind_speed_kmh,
       gust_ms AS wind_gust_ms, CAST(0 AS INTEGER) AS wind_direction, coalesce(pressure, 1013) AS pressure_hpa, CAST(0 AS INTEGER) AS humidity_pct,
       CAST(0 AS INTEGER) AS cloud_cover_pct, concat('W', code_1) AS condition_main, code_1 AS condition_id, 'sky' AS condition_desc,
       city_name, '' AS country_code, CAST({_BEAUFORT} AS INTEGER) AS beaufort_scale
FROM (SELECT *, coalesce(wind_ms, 0) AS wind, coalesce(wind_ms, 0) * CAST(3.6 AS DOUBLE) AS kmh FROM stormy) s"""),
    "beaufort": _with(f"""
SELECT CAST({_BEAUFORT} AS INTEGER) AS beaufort_scale, count(*) AS row_count, min(wind) AS slowest, max(wind) AS fastest
FROM (SELECT wind_ms AS wind FROM raw_weather WHERE wind_ms IS NOT NULL) w GROUP BY 1"""),
    "storm_basin": _with(f"""
SELECT sid, basin, CASE WHEN knots < 34 THEN 'TD' WHEN knots < 64 THEN 'TS' WHEN basin = 'WP' THEN 'TY' ELSE 'HU' END AS nature
FROM (SELECT sid, coalesce(wmo_wind, 0) AS knots, {_BASIN} AS basin FROM raw_storm) s"""),
    # validation, classification, processing
    "validate_strict": _with(f"SELECT * FROM ({_STRICT}) r WHERE reasons <> ''"),
    "validate_publish": _with(f"""
SELECT {_UNI} FROM uni WHERE event_id IS NOT NULL AND severity_raw IS NOT NULL AND event_type IN {_KINDS}
  AND latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180"""),
    "validate_process": _with(f"SELECT {_UNI} FROM gated"),
    "classify_fmi": _with(f"""
SELECT event_id, event_type, severity_raw, {_level('event_type', 'severity_raw', 'fmi', 'low')} AS severity_level FROM live_dirty"""),
    "classify_cm_drop": _with(f"""
SELECT * FROM (SELECT event_id, event_type, severity_raw, {_level('event_type', 'severity_raw', 'cm', 'drop')} AS severity_level FROM live_dirty) x
WHERE severity_level IS NOT NULL"""),
    "severity_summary": _with("""
SELECT coalesce(event_type, 'TOTAL') AS event_type, count(*) AS event_count, min(severity_raw) AS min_severity, max(severity_raw) AS max_severity,
       round(avg(severity_raw), 5) AS mean_severity, CAST(count_if(severity_raw = 0) AS BIGINT) AS zero_count FROM live GROUP BY ROLLUP (event_type)"""),
    "severity_distribution": _with(f"""
SELECT {_level('event_type', 'severity_raw', 'fmi', 'label')} AS severity_level, count(*) AS event_count FROM live GROUP BY 1"""),
    "process_events": _with(f"SELECT {_PROC} FROM proc"),
    "processing_stats": _stats("uni"),
    "first_per_level": _with(f"""
SELECT * EXCLUDE (n) FROM (
  SELECT outcome, {_UNI}, row_number() OVER (PARTITION BY outcome ORDER BY ts_text, coalesce(event_id, ''), processed_at) AS n
  FROM (SELECT *, coalesce(CASE WHEN event_id IS NOT NULL AND event_type IN {_KINDS} AND severity_raw IS NOT NULL
          THEN {_level('event_type', 'severity_raw', 'cm', 'drop')} END, 'DROPPED') AS outcome FROM uni) o) r WHERE n = 1"""),
    "critical_alerts": _with(f"SELECT {_PROC} FROM proc WHERE severity_level = 'CRITICAL'"),
    "dq_min_count": _with("SELECT event_type, count(*) AS row_count, count(*) >= 50 AS passed FROM live_dirty GROUP BY 1"),
    "dq_schema": _with(f"""
SELECT event_type, count(*) AS row_count,
       CAST(count_if(event_id IS NULL OR event_type IS NULL OR severity_raw IS NULL OR latitude IS NULL OR longitude IS NULL OR ts_text IS NULL OR source IS NULL) AS BIGINT) AS missing_fields,
       CAST(count_if(event_type NOT IN {_KINDS}) AS BIGINT) AS unknown_type, CAST(count_if(severity_raw IS NULL) AS BIGINT) AS non_numeric,
       CAST(count_if(latitude NOT BETWEEN -90 AND 90 OR longitude NOT BETWEEN -180 AND 180) AS BIGINT) AS out_of_range FROM uni GROUP BY 1"""),
    "dq_spread": _with(f"""
SELECT event_type, min_severity, max_severity, min_severity >= {_range_case(0)} AND max_severity <= {_range_case(1)} AS in_range,
       CASE WHEN mean > 0 THEN max_severity > 2 * mean ELSE true END AS has_spread
FROM (SELECT event_type, min(severity_raw) AS min_severity, max(severity_raw) AS max_severity, avg(severity_raw) AS mean FROM live GROUP BY 1) s"""),
    "dq_zeros": _with("""
SELECT event_type, CAST(count_if(severity_raw = 0) AS BIGINT) AS zero_count, count_if(severity_raw = 0) >= 1 AS passed FROM live_dirty GROUP BY 1"""),
    "dq_timestamps": _with("""
SELECT event_type, bad_timestamps, CAST(floor(span / 86400) AS BIGINT) AS span_days, floor(span / 86400) >= 30 AS span_ok FROM (
  SELECT coalesce(event_type, '*') AS event_type, CAST(count_if(source = 'SRC-4') AS BIGINT) AS bad_timestamps,
         epoch(max(date_trunc('second', event_time)) FILTER (source <> 'SRC-4')) - epoch(min(date_trunc('second', event_time)) FILTER (source <> 'SRC-4')) AS span
  FROM live_dirty GROUP BY ROLLUP (event_type)) r"""),
    # documents
    "to_document": _with("""
SELECT event_id AS _id, event_type, severity_level, source, 'Point' AS geo_type, longitude AS coord_0, latitude AS coord_1, event_time, processed_at FROM proc"""),
    "doc_flatten": _with("""
SELECT event_id, event_type, severity_level, CASE WHEN source = 'SRC-1' THEN 0 ELSE latitude END AS latitude,
       CASE WHEN source = 'SRC-1' THEN 0 ELSE longitude END AS longitude, event_time, processed_at, source FROM proc"""),
    "live_flatten": _with(f"SELECT {_PROC} FROM proc"),
    "replay_document": _with(f"""
SELECT event_id, event_type, severity_raw, severity_level, source, latitude, longitude,
       CASE WHEN source = 'SRC-2' THEN '{AS_OF.replace(' ', 'T')}Z' ELSE strftime(event_time, {ISO}) END AS event_time,
       '{AS_OF.replace(' ', 'T')}Z' AS processed_at
FROM (SELECT *, {_level('event_type', 'severity_raw', 'cm', 'drop')} AS severity_level FROM live) l WHERE severity_level IS NOT NULL"""),
    "dedup_first": _with(f"SELECT {_PROC} FROM proc QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY p) = 1"),
    "dedup_last": _with(f"SELECT {_PROC} FROM stored"),
    "upsert_last_wins": _with(f"""
SELECT coalesce(b.event_id, a.event_id) AS event_id, coalesce(b.event_type, a.event_type) AS event_type,
       coalesce(b.severity_level, a.severity_level) AS severity_level, coalesce(b.latitude, a.latitude) AS latitude,
       coalesce(b.longitude, a.longitude) AS longitude, coalesce(b.event_time, a.event_time) AS event_time,
       coalesce(b.processed_at, a.processed_at) AS processed_at, a.source AS source
FROM (SELECT {_PROC} FROM proc WHERE p <= t + INTERVAL '30' SECOND) a
FULL JOIN (SELECT {_PROC} FROM proc WHERE p > t + INTERVAL '30' SECOND) b ON a.event_id = b.event_id"""),
    "exclude_loaded": _with(f"""
SELECT {_PROC} FROM stored WHERE event_id NOT IN (SELECT event_id FROM stored WHERE t < TIMESTAMP '{AS_OF}')"""),
    "exclude_by_filter": _with(f"""
SELECT {_PROC} FROM stored WHERE event_id NOT IN (SELECT event_id FROM stored WHERE t < TIMESTAMP '{AS_OF}')"""),
    "collection_stats": _with("""
SELECT event_type, count(*) AS event_count, string_agg(DISTINCT severity_level, ',' ORDER BY severity_level) AS levels FROM stored GROUP BY 1"""),
    "extract_since": _with(f"SELECT {_PROC} FROM stored WHERE t >= TIMESTAMP '{AS_OF}'"),
    # searches over documents
    "recent_events": _with(f"SELECT {_PROC} FROM stored ORDER BY t DESC, event_id LIMIT 50"),
    "recent_by_type": _with(f"SELECT {_PROC} FROM stored WHERE event_type = 'flood' ORDER BY t DESC, event_id LIMIT 50"),
    "search_paged": _with(f"""
SELECT {_PROC}, count(*) OVER () AS total, CAST(ceil(count(*) OVER () / 25.0) AS BIGINT) AS pages FROM stored
WHERE event_type = 'fire' AND severity_level = 'MEDIUM' AND t BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-20 00:00:00'
ORDER BY t DESC, event_id LIMIT 25 OFFSET 50"""),
    "search_paged_empty": _with("""
SELECT count(*) AS total, CAST(greatest(1, ceil(count(*) / 25.0)) AS BIGINT) AS pages, CAST(0 AS BIGINT) AS rows_on_page FROM stored
WHERE event_type = 'fire' AND severity_level = 'MEDIUM' AND t BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-20 00:00:00'"""),
    "upsert_stats": _with(f"""
SELECT count(*) AS received, count(DISTINCT id) FILTER (id NOT IN (SELECT event_id FROM proc WHERE t < TIMESTAMP '{AS_OF}')) AS inserted,
       count(DISTINCT id) FILTER (id IN (SELECT event_id FROM proc WHERE t < TIMESTAMP '{AS_OF}')) AS updated,
       count(id) - count(DISTINCT id) AS repeated, count(*) - count(id) AS errors
FROM (SELECT CASE WHEN source <> 'SRC-4' THEN event_id END AS id FROM proc) p"""),
    "by_location": _with(f"SELECT {_PROC} FROM stored WHERE {_BOX_WHERE} ORDER BY event_id LIMIT 100"),
    "by_polygon": _with(f"SELECT {_PROC} FROM stored WHERE {_GEODESIC_WHERE} ORDER BY event_id LIMIT 100"),
    "polygon_events": _with(f"SELECT event_id, latitude, longitude, severity_level FROM wide WHERE {_FACT_RANGE} AND {_GEODESIC_WHERE}"),
    "new_since": _with(f"SELECT {_PROC} FROM stored WHERE p > TIMESTAMP '{AS_OF}'"),
    "live_window": _with(f"""
SELECT {_PROC} FROM stored WHERE t > TIMESTAMP '{AS_OF}' - INTERVAL '8' HOUR AND t <= TIMESTAMP '{AS_OF}'"""),
    "live_snapshot": _with(f"""
SELECT {_PROC} FROM stored WHERE t > TIMESTAMP '{AS_OF}' - INTERVAL '8' HOUR AND t <= TIMESTAMP '{AS_OF}' ORDER BY t DESC, event_id LIMIT 40"""),
    # feeds
    "merge_sorted": _with("SELECT * FROM publishable ORDER BY timestamp, event_id, severity_raw"),
    "route_topics": _with("""
SELECT concat(event_type, 's-topic') AS topic, count(*) AS messages, count(DISTINCT event_id) AS keys, sum(latitude) AS lat_sum, max(timestamp) AS last
FROM publishable GROUP BY 1"""),
    "sample_per_type": _with(f"""
SELECT event_id, event_type, severity_raw, latitude, longitude, timestamp, source, CAST(position AS INTEGER) AS position, type_total FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY timestamp, event_id) AS position, count(*) OVER (PARTITION BY event_type) AS type_total
  FROM (SELECT *, strftime(event_time, {ISO}) AS timestamp FROM live) l) r WHERE position <= 5"""),
    # fires and floods
    "fire_clusters_modis": _with(_fires("MODIS", "modis_groups")),
    "fire_clusters_viirs": _with(_fires("VIIRS", "viirs_groups")),
    "fires_from_csv": _with(_fires("MODIS", "csv_groups")),
    "fire_rejects": _with("""
SELECT CASE WHEN row_no % 67 = 0 THEN 'frp' ELSE 'longitude' END AS reason, count(*) AS row_count FROM pix
WHERE row_no % 67 = 0 OR row_no % 59 = 0 GROUP BY 1"""),
    "flood_rejects": _with("""
SELECT CASE WHEN latitude_dd IS NULL THEN 'latitude_dd' ELSE 'hwm_quality_id' END AS reason, count(*) AS row_count FROM hwm_dirty
WHERE latitude_dd IS NULL OR hwm_quality_id IS NULL GROUP BY 1"""),
    "flood_marks_used": _with("""
SELECT event_id AS flood_event_id, count(*) AS hwm_count, CASE min(hwm_quality_id) WHEN 2 THEN 'Good' WHEN 3 THEN 'Fair' ELSE 'Poor' END AS quality
FROM hwm_dirty WHERE latitude_dd IS NOT NULL AND hwm_quality_id IS NOT NULL GROUP BY 1 HAVING min(hwm_quality_id) <= 3 OR count(*) >= 3"""),
    "fires_union": _with(
        " UNION ALL ".join(
            f"SELECT * FROM ({_fires(n, g)}) {g[0]}"
            for n, g in (("MODIS", "modis_groups"), ("VIIRS", "viirs_groups"))
        )
    ),
    "hull_area": _with(f"""
SELECT event_id, grid_area / 4096 AS hull_area FROM ({_hull('marks_xy', 'event_id', '{0}.event_id = {1}.event_id')}) h"""),
    "flood_fmi": _with(f"""
SELECT concat('USGS-FLOOD-', event_id) AS event_id, 'flood' AS event_type, greatest(0, {_round('raw', 4)}) AS severity_raw,
       {_round('lat_c', 6)} AS latitude, {_round('lon_c', 6)} AS longitude, coalesce(strftime(f0, {ISO}), '2024-06-01T00:00:00Z') AS timestamp,
       'USGS_FLOOD' AS source, greatest(0, {_round('raw', 4)}) AS magnitude, {_round('area', 4)} AS area_km2, event_id AS flood_event_id,
       coalesce(m.en, '') AS flood_event_name, marks AS hwm_count, {_round('mean_elev', 2)} AS water_elevation_ft,
       CASE best WHEN 2 THEN 'Good' WHEN 3 THEN 'Fair' WHEN 4 THEN 'Poor' ELSE 'Unknown' END AS quality, coalesce(m.env, 'Riverine') AS environment,
       coalesce(m.st, '') AS state, coalesce(m.wb, '') AS waterbody, greatest(0, {_round('raw', 4)}) AS fmi, {_round('hours', 1)} AS duration_hours
FROM flood_index"""),
    # places
    "nearest_city": _with("SELECT latitude, longitude, cc FROM near_live"),
    "nearest_city_fine": _with("SELECT latitude, longitude, cc FROM near_fine"),
    "hex_counts_fine": _with(f"""
SELECT CAST(CASE WHEN dq > dr AND dq > ds THEN -rr - rs ELSE rq END AS BIGINT) AS q,
       CAST(CASE WHEN dq > dr AND dq > ds THEN rr WHEN dr > ds THEN -rq - rs ELSE rr END AS BIGINT) AS r, count(*) AS event_count
FROM (SELECT *, abs(rq - q) AS dq, abs(rr - r) AS dr, abs(rs - s) AS ds
      FROM (SELECT *, floor(q + 0.5) AS rq, floor(r + 0.5) AS rr, floor(s + 0.5) AS rs
            FROM (SELECT *, -q - r AS s FROM (
              SELECT (longitude * (sqrt(CAST(3 AS DOUBLE)) / 3) - latitude * (CAST(1 AS DOUBLE) / 3)) / {_EDGE_4} AS q,
                     latitude * (CAST(2 AS DOUBLE) / 3) / {_EDGE_4} AS r
              FROM live_fine WHERE {_BOX_WHERE}) a) b) c) d GROUP BY 1, 2"""),
    "classify_location": _with("SELECT latitude, longitude, cc, country, region FROM placed_live"),
    "hemisphere": _with(f"SELECT {_HEMISPHERE.format('latitude', 'longitude')} AS hemisphere, count(*) AS row_count FROM live GROUP BY 1"),
    # star schema
    "star_wide": _with("""
SELECT event_type AS event_type_name, latitude, longitude, country, region, strftime(event_date, '%Y-%m-%d') AS date, CAST(day(event_date) AS INTEGER) AS day,
       CAST(month(event_date) AS INTEGER) AS month, CAST(year(event_date) AS INTEGER) AS year, event_hour AS hour, event_id, severity_level, source FROM wide"""),
    "dim_event_type_build": _with("SELECT DISTINCT event_type AS event_type_name FROM ev"),
    "dim_time_build": _with(f"""
SELECT DISTINCT {_TIME_KEY} AS time_id, strftime(event_date, '%Y-%m-%d') AS date, CAST(day(event_date) AS INTEGER) AS day, CAST(month(event_date) AS INTEGER) AS month,
       CAST(year(event_date) AS INTEGER) AS year, event_hour AS hour FROM ev"""),
    "dim_location_build": _with(f"SELECT {_PLACE_KEY} AS location_id, country, region, latitude, longitude FROM placed_ev"),
    "fact_build": _with(f"""
SELECT event_id, CAST({_TYPE_KEY} AS INTEGER) AS event_type_id, {_PLACE_KEY} AS location_id, {_TIME_KEY} AS time_id, severity_level, source,
       CAST(1 AS INTEGER) AS count_metric, CAST((floor(latitude) + 90) * 400 + floor(longitude) + 180 AS INTEGER) AS cell_id,
       latitude, longitude, CAST(year(event_date) AS INTEGER) AS year FROM ev"""),
    "dim_event_type_new": _with("""
SELECT CASE WHEN source = 'SRC-F' AND event_hour = 3 THEN 'drought' WHEN source = 'SRC-P' THEN 'volcano' ELSE event_type END AS event_type,
       count(*) AS event_count FROM ev GROUP BY 1"""),
    "star_join": _with("""
SELECT event_id, event_type, severity_level, latitude, longitude, country, region, strftime(event_date, '%Y-%m-%d') AS date, event_hour AS hour, source FROM wide"""),
    "star_load_idempotent": _loads(),
    "load_stats": _with(f"""
SELECT total_events, facts_inserted, total_events - errors - facts_inserted AS facts_skipped, errors,
       CAST(facts_inserted AS DOUBLE) / total_events * 100 AS load_rate FROM (
  SELECT count(*) AS total_events, CAST(count_if(event_id IS NULL) AS BIGINT) AS errors,
         count(DISTINCT event_id) FILTER (event_id NOT IN (SELECT event_id FROM stored WHERE t < TIMESTAMP '{AS_OF}')) AS facts_inserted
  FROM (SELECT *, {_level('event_type', 'severity_raw', 'cm', 'drop')} AS severity_level FROM live_dirty) l
  WHERE severity_level IS NOT NULL) c"""),
    "event_counts": _with("SELECT event_type, count(*) AS event_count FROM ev GROUP BY 1"),
    "event_counts_total": _with("""
SELECT coalesce(event_type, 'TOTAL') AS event_type, count(*) AS event_count FROM ev GROUP BY ROLLUP (event_type)"""),
    "monthly_trends": _with(_TREND.format("ev", "true")),
    "monthly_trends_filtered": _with(
        _TREND.format(
            "wide",
            "event_type = 'fire' AND year(event_date) = 1998 AND event_date BETWEEN DATE '1998-02-10' AND DATE '1998-11-20' AND lower(country) = lower('jAPAN')",
        )
    ),
    "top_locations": _with(_TOP.format("true", 20)),
    "top_locations_by_type": _with(_TOP.format("event_type = 'storm'", 10)),
    "event_summary": _summary("true"),
    "event_summary_filtered": _summary(
        f"{_FACT_RANGE} AND event_type IN ('earthquake', 'flood') AND lower(country) = 'india'", "wide"
    ),
    "year_type_counts": _with("SELECT CAST(year(event_date) AS INTEGER) AS year, event_type, count(*) AS event_count FROM ev GROUP BY 1, 2"),
    "interp_targets": _with(f"""
SELECT year, event_type, event_count, {_target_case()} AS target FROM (
  SELECT CAST((year(event_date) - 1996) * 9 + 1978 AS INTEGER) AS year, event_type, count(*) AS event_count FROM ev GROUP BY 1, 2) y"""),
    "stratified_cap": _with(f"""
SELECT event_id, event_type, year, severity_level FROM (
  SELECT *, row_number() OVER (PARTITION BY year, event_type ORDER BY md5(event_id), event_id) AS n
  FROM (SELECT *, CAST(year(event_date) AS INTEGER) AS year FROM ev) e) r WHERE n <= ceil({_target_case()} * 0.5)"""),
    # searches and maps over the star schema
    "search_events": _with(f"""
SELECT event_id, event_type, severity_level, latitude, longitude, country, region, {_HOUR_TEXT} AS event_time, source, count(*) OVER () AS total
FROM wide WHERE {_SEARCH_WHERE} ORDER BY event_date DESC, event_hour DESC, event_id LIMIT 60 OFFSET 40"""),
    "search_total": _with(f"SELECT count(*) AS total FROM ev WHERE {_FACT_RANGE} AND event_type IN ('fire', 'storm')"),
    "bbox_events": _with(f"SELECT event_id, latitude, longitude, strftime(event_date, '%Y-%m-%d') AS event_date FROM hist WHERE {_BOX_WHERE}"),
    "proximity_search": _with(f"""
SELECT event_id, event_type, severity_level, latitude, longitude, country, region, {_HOUR_TEXT} AS event_time, source, count(*) OVER () AS total
FROM wide WHERE {_NEAR_WHERE} ORDER BY event_date DESC, event_hour DESC, event_id LIMIT 200"""),
    "search_after": _with(f"""
SELECT event_id, event_type, severity_level, latitude, longitude, country, region, {_HOUR_TEXT} AS event_time, source, count(*) OVER () AS total
FROM wide WHERE event_type = 'fire' ORDER BY event_date DESC, event_hour DESC, event_id LIMIT 50 OFFSET 100"""),
    "search_empty_page": _with(f"SELECT count(*) AS total, CAST(0 AS BIGINT) AS rows_on_page FROM wide WHERE {_SEARCH_WHERE}"),
    "map_total": _with(f"""
SELECT 1 AS map_no, 'clusters' AS mode, count(*) AS total FROM ev WHERE {_BOX_WHERE} AND {_FACT_RANGE}
UNION ALL SELECT 2, 'points', count(*) FROM ev WHERE {_BOX_WHERE} AND {_FACT_RANGE}
UNION ALL SELECT 3, 'clusters', count(*) FROM ev WHERE latitude BETWEEN -89.5 AND -89 AND longitude BETWEEN 10 AND 11 AND {_FACT_RANGE}"""),
    "map_grid": _with(f"SELECT lat_sum / n AS lat, lng_sum / n AS lng, event_type, n AS event_count FROM ({_cells(ZOOM_4_CELL, 'true')}) c"),
    "map_hex": _hexes(ZOOM_2_CELL, ZOOM_2_HEX_KM2, _FACT_RANGE, 3, 20),
    "map_points": _with(f"""
SELECT event_id, event_type, severity_level, latitude, longitude, {_HOUR_TEXT} AS event_time, count(*) OVER () AS total_count
FROM ev WHERE {_BOX_WHERE} AND {_FACT_RANGE} ORDER BY event_date DESC, event_hour DESC, event_id LIMIT 1000"""),
    "map_view": _hexes(ZOOM_6_CELL, ZOOM_6_HEX_KM2, _BOX_WHERE, 0, ZOOM_6_CAP),
    # streams: the same as their batch twins
    "stream_ingest": _with(f"""
SELECT event_id, event_type, severity_raw, latitude, longitude, strftime(event_time, {ISO}) AS timestamp, source FROM live"""),
    "stream_process": _with(f"SELECT {_PROC} FROM streamed"),
    "stream_critical": _with(f"SELECT {_PROC} FROM streamed WHERE severity_level = 'CRITICAL'"),
    "stream_route": _with("SELECT concat(event_type, 's-topic') AS topic, count(*) AS messages FROM live GROUP BY 1"),
    "stream_counts": _with("SELECT event_type, severity_level, count(*) AS event_count FROM streamed GROUP BY 1, 2"),
    "stream_stats": _stats("(SELECT * REPLACE (CASE WHEN source <> 'SRC-4' THEN severity_raw END AS severity_raw) FROM live) s"),
    "stream_live_window": _with(f"""
SELECT event_id, event_type, severity_raw, latitude, longitude, strftime(event_time, {ISO}) AS event_time, source FROM live
WHERE event_time > TIMESTAMP '{AS_OF}' - INTERVAL '8' HOUR AND event_time <= TIMESTAMP '{AS_OF}'"""),
    "stream_new_events": _with(f"SELECT {_PROC} FROM streamed WHERE t + INTERVAL '3' SECOND > TIMESTAMP '{AS_OF}'"),
    "stream_upsert": _with(f"""
SELECT coalesce(b.event_id, a.event_id) AS event_id, coalesce(b.event_type, a.event_type) AS event_type,
       coalesce(b.severity_level, a.severity_level) AS severity_level, coalesce(b.latitude, a.latitude) AS latitude,
       coalesce(b.longitude, a.longitude) AS longitude, coalesce(b.event_time, a.event_time) AS event_time,
       coalesce(b.processed_at, a.processed_at) AS processed_at, a.source AS source
FROM streamed a FULL JOIN (SELECT * FROM proc WHERE p > t + INTERVAL '30' SECOND) b ON a.event_id = b.event_id"""),
}
