"""Small constant lookups."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardry import constants as C


def map_or(key: Column, table: dict, default: Column | str | int | None) -> Column:
    """Value of a constant map, or ``default`` when the key is NULL or unknown."""
    literal = F.create_map(*[F.lit(v) for v in chain.from_iterable(table.items())])
    fallback = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(F.try_element_at(literal, key), fallback)


def country_codes(spark: SparkSession) -> DataFrame:
    """Code, country, region: the union of the two fixed tables (about 140 rows)."""
    codes = sorted({*C.COUNTRY_BY_CODE, *C.REGION_BY_CODE})
    rows = [(c, C.COUNTRY_BY_CODE.get(c), C.REGION_BY_CODE.get(c)) for c in codes]
    return spark.createDataFrame(rows, "cc string, country_name string, region_name string")
