"""Readers of the agency feeds and of event streams.  Every schema is explicit."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from hazardry import constants as C
from hazardry import schemas


def file_system(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def existing(spark: SparkSession, paths: list[str]) -> list[str]:
    """The paths that exist, on whatever file system they name."""
    found = []
    for path in paths:
        system, where = file_system(spark, path)
        matches = system.globStatus(where)
        if matches is not None and len(matches) > 0:
            found.append(path)
    return found


def modified_at(spark: SparkSession, path: str) -> int:
    """Time of the last change of a file or folder, in milliseconds."""
    system, where = file_system(spark, path)
    return system.getFileStatus(where).getModificationTime()


def quake_features(spark: SparkSession, path: str | list[str], multi_line: bool = True) -> DataFrame:
    """GeoJSON FeatureCollections to one row per feature."""
    collections = spark.read.schema(schemas.QUAKE_COLLECTION).json(path, multiLine=multi_line)
    return collections.select(F.explode("features").alias("f")).select("f.*")


def _pixel_text(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True, mode="PERMISSIVE")


def modis_text(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """MODIS pixels as text; :func:`hazardry.operators.fires.parse_pixels` types them."""
    return _pixel_text(spark, path, schemas.MODIS_PIXEL_TEXT)


def viirs_text(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return _pixel_text(spark, path, schemas.VIIRS_PIXEL_TEXT)


def high_water_marks(spark: SparkSession, path: str | list[str], multi_line: bool = True) -> DataFrame:
    """JSON array of high-water marks."""
    return spark.read.schema(schemas.HIGH_WATER_MARK).json(path, multiLine=multi_line)


def weather_snapshots(spark: SparkSession, path: str | list[str], multi_line: bool = True) -> DataFrame:
    """JSON array of weather snapshots."""
    return spark.read.schema(schemas.WEATHER_SNAPSHOT).json(path, multiLine=multi_line)


RAW_FEED_SCHEMAS = {
    "earthquake": schemas.QUAKE_FEATURE,
    "fire": schemas.FIRE_RECORD,
    "flood": schemas.FLOOD_RECORD,
    "storm": schemas.STORM_RECORD,
}


def raw_feeds(spark: SparkSession, folder: str, multi_line: bool = True) -> dict[str, DataFrame]:
    """Raw records per type from the four files of a folder; a missing file gives no rows."""
    feeds = {}
    for kind, name in C.FEED_FILES.items():
        found = existing(spark, [f"{folder}/{name}"])
        schema = RAW_FEED_SCHEMAS[kind]
        feeds[kind] = (
            spark.read.schema(schema).json(found, multiLine=multi_line)
            if found
            else spark.createDataFrame([], schema)
        )
    return feeds


def union_feeds(
    spark: SparkSession, paths: list[str], multi_line: bool = True, schema: T.StructType = schemas.UNIFIED_EVENT
) -> DataFrame:
    """Unified events of all feeds that exist, together."""
    found = existing(spark, paths)
    if not found:
        return spark.createDataFrame([], schema)
    feeds = [spark.read.schema(schema).json(p, multiLine=multi_line) for p in found]
    return reduce(DataFrame.unionByName, feeds)


# --- streams ---------------------------------------------------------------------


def kafka_stream(spark: SparkSession, servers: str, starting: str = "earliest") -> DataFrame:
    """Raw messages of the four topics.  Needs the Kafka connector on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(C.TOPICS.values()))
        .option("startingOffsets", starting)
        .load()
        .select(F.col("key").cast("string"), F.col("value").cast("string"), "topic")
    )


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str, **options) -> DataFrame:
    """Files of a folder as a stream."""
    reader: DataStreamReader = spark.readStream.schema(schema).format(fmt)
    return reader.options(**options).load(path)


def table_stream(spark: SparkSession, folder: str, name: str, files_per_trigger: int | None = None) -> DataFrame:
    """A Parquet table ``folder/name.parquet`` as a stream, be it one file or a folder of parts."""
    path = f"{folder.rstrip('/')}/{name}.parquet"
    table = spark.read.parquet(path)
    system, where = file_system(spark, path)
    options = {} if files_per_trigger is None else {"maxFilesPerTrigger": str(files_per_trigger)}
    if system.getFileStatus(where).isFile():
        # a file stream watches folders; the filter picks the one file
        return file_stream(
            spark, folder, table.schema, "parquet", pathGlobFilter=f"{name}.parquet", **options
        )
    return file_stream(spark, path, table.schema, "parquet", **options)


def parse_messages(messages: DataFrame) -> DataFrame:
    """JSON message values to unified events; an unreadable value becomes a row of NULLs."""
    return messages.select(
        F.from_json("value", schemas.UNIFIED_EVENT).alias("event")
    ).select("event.*")
