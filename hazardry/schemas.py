"""Explicit schemas of every input and stored table; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _D, _I, _L = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


UNIFIED_EVENT = _struct(
    event_id=_S,
    event_type=_S,
    severity_raw=_D,
    latitude=_D,
    longitude=_D,
    timestamp=_S,
    source=_S,
)

GEO_POINT = _struct(type=_S, coordinates=T.ArrayType(_D))

QUAKE_FEATURE = _struct(
    id=_S,
    properties=_struct(
        mag=_D,
        time=_L,
        place=_S,
        net=_S,
        status=_S,
        tsunami=_I,
        sig=_I,
        magType=_S,
        alert=_S,
        mmi=_D,
        felt=_I,
    ),
    geometry=GEO_POINT,
)
QUAKE_COLLECTION = _struct(features=T.ArrayType(QUAKE_FEATURE))

_PIXEL_TAIL = ("acq_date", "acq_time", "satellite", "instrument", "confidence", "version")
MODIS_PIXEL_TEXT = T.StructType(
    [
        T.StructField(name, _S)
        for name in ("latitude", "longitude", "brightness", "scan", "track", *_PIXEL_TAIL, "bright_t31", "frp", "daynight", "type")
    ]
)
VIIRS_PIXEL_TEXT = T.StructType(
    [
        T.StructField(name, _S)
        for name in ("latitude", "longitude", "bright_ti4", "scan", "track", *_PIXEL_TAIL, "bright_ti5", "frp", "daynight", "type")
    ]
)

FIRE_RECORD = _struct(latitude=_D, longitude=_D, acq_date=_S, acq_time=_S, frp=_D)

HIGH_WATER_MARK = _struct(
    event_id=_L,
    latitude_dd=_D,
    longitude_dd=_D,
    elev_ft=_D,
    hwm_quality_id=_I,
    flag_date=_S,
    hwm_environment=_S,
    stateName=_S,
    waterbody=_S,
    eventName=_S,
)
FLOOD_RECORD = _struct(
    hwm_id=_L, site_latitude=_D, site_longitude=_D, height_above_gnd_ft=_D, peak_date=_S
)

WEATHER_SNAPSHOT = T.StructType(
    [
        T.StructField("coord", _struct(lat=_D, lon=_D)),
        T.StructField("dt", _L),
        T.StructField("id", _L),
        T.StructField("name", _S),
        T.StructField("wind", _struct(speed=_D, gust=_D, deg=_I)),
        T.StructField("main", _struct(pressure=_I, humidity=_I)),
        T.StructField("rain", T.StructType([T.StructField("1h", _D), T.StructField("3h", _D)])),
        T.StructField("visibility", _I),
        T.StructField("clouds", _struct(all=_I)),
        T.StructField("weather", T.ArrayType(_struct(id=_I, main=_S, description=_S))),
        T.StructField("sys", _struct(country=_S)),
    ]
)
STORM_RECORD = _struct(
    sid=_S, season=_I, basin=_S, iso_time=_S, nature=_S, lat=_D, lon=_D, wmo_wind=_D
)

GAZETTEER = _struct(row_no=_L, lat=_D, lon=_D, cc=_S)

DIM_EVENT_TYPE = _struct(event_type_id=_I, event_type_name=_S)
DIM_LOCATION = _struct(location_id=_S, country=_S, region=_S, latitude=_D, longitude=_D)
DIM_TIME = _struct(time_id=_L, date=T.DateType(), day=_I, month=_I, year=_I, hour=_I)
FACT_EVENT = _struct(
    event_id=_S,
    event_type_id=_I,
    location_id=_S,
    time_id=_L,
    severity_level=_S,
    source=_S,
    count_metric=_I,
    cell_id=_I,
    latitude=_D,
    longitude=_D,
    country=_S,
    region=_S,
    year=_I,
)
EVENT_COUNTS = _struct(year=_I, event_type_id=_I, severity_level=_S, event_count=_L)
MAP_PYRAMID = _struct(
    month=_I, event_type_id=_I, cell_lat=_D, cell_lon=_D, lat_sum=_D, lng_sum=_D, event_count=_L, kind=_S, zoom=_I
)
LOAD_LOG = _struct(load_id=_S, state=_S)
