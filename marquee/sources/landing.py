"""Landed files: folders ``<root>/<entity>/<folder>/`` of Parquet, written once and read as a whole."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType, DataType, DoubleType, FloatType, IntegerType, LongType, ShortType, StringType, StructField, StructType,
    TimestampType,
)

from marquee.sources import storage

FULL_LOAD = "full_load"
ARCHIVE = "_archive"  # below the landing area: files that were claimed for ingestion, under the same names
LINEAGE = StructType(
    [
        StructField("_ingested_at", TimestampType()),
        StructField("_source_file", StringType()),
        StructField("_landed_at", TimestampType()),
    ]
)


def land(df: DataFrame, root: str, entity: str, folder: str, mode: str = "append") -> str:
    """Write one delivery and return its path; ``overwrite`` replaces this delivery only."""
    path = f"{root}/{entity}/{folder}"
    df.write.mode(mode).option("compression", storage.COMPRESSION).parquet(path)
    return path


def landed_history(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Everything landed below ``path``, whatever the folder depth.

    Without a ``schema`` the columns of all files are merged, which reads every file's footer.
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    reader = reader.option("mergeSchema", "true") if schema is None else reader.schema(schema)
    return reader.parquet(path)


def landed_rows(spark: SparkSession, path: str) -> int:
    """Number of landed rows, 0 if the folder is not there. Reads file footers only.

    A folder that cannot be read is an error: ids that continue from a wrong 0 would repeat.
    """
    return landed_history(spark, path).count() if storage.exists(spark, path) else 0


def read_full_load(spark: SparkSession, root: str, entity: str) -> DataFrame:
    """The full delivery of an entity that only a full load brings, ingested or not."""
    for home in (root, f"{root}/{ARCHIVE}"):
        try:
            return spark.read.parquet(f"{home}/{entity}/{FULL_LOAD}")
        except AnalysisException:
            continue
    raise RuntimeError(f"no full load of {entity} below {root}: run a full load before an incremental one")


def with_lineage(df: DataFrame) -> DataFrame:
    """Adds when and from which file a row was ingested, and when that file landed.

    ``_ingested_at`` is the same for a whole batch; ``_landed_at`` keeps the order of deliveries
    when a rebuild ingests all of them at once. ``df`` must read files directly.
    """
    return df.withColumns(
        {
            "_ingested_at": F.current_timestamp(),
            "_source_file": F.col("_metadata.file_path"),
            "_landed_at": F.col("_metadata.file_modification_time"),
        }
    )


# Types of one column that files may differ in, narrow ones first.
_WHOLE = (ByteType(), ShortType(), IntegerType(), LongType())
_REAL = (FloatType(), DoubleType())


def wider(name: str, one: DataType, other: DataType) -> DataType:
    """The type that holds the values of both: whole numbers and reals widen, all else must agree."""
    for family in (_WHOLE, _REAL):
        if one in family and other in family:
            return max(one, other, key=family.index)
    if one != other:
        raise TypeError(f"column {name} is {one.simpleString()} in one file and {other.simpleString()} in another")
    return one


def merge_schemas(known: StructType | None, found: StructType) -> StructType:
    """Known columns first, new ones appended; a column whose type widened has the wider one."""
    if known is None:
        return found
    fresh = {field.name: field for field in found.fields}
    kept = [
        StructField(f.name, wider(f.name, f.dataType, fresh[f.name].dataType) if f.name in fresh else f.dataType)
        for f in known.fields
    ]
    names = set(known.fieldNames())
    return StructType([*kept, *[StructField(f.name, f.dataType) for f in found.fields if f.name not in names]])


def groups_of_files(spark: SparkSession, paths: Sequence[str]) -> list[tuple[list[str], StructType]]:
    """Files with their columns, read from the footers of exactly these files.

    Spark merges the footers in tasks; files whose types differ cannot be merged and are told apart by halves.
    """
    try:
        return [(list(paths), spark.read.option("mergeSchema", "true").parquet(*paths).schema)]
    except Exception as error:
        if len(paths) < 2 or "CANNOT_MERGE" not in f"{error}":
            raise
    middle = len(paths) // 2
    return groups_of_files(spark, paths[:middle]) + groups_of_files(spark, paths[middle:])


def read_files(spark: SparkSession, paths: Sequence[str], record: str, number: int) -> DataFrame:
    """Landed files with lineage, in the columns of all files so far; what they add is recorded first.

    ``record`` is the folder the schemas are kept in, ``number`` tells this batch from others.
    """
    schema = _read_record(spark, record)
    groups = groups_of_files(spark, paths)
    for _, found in groups:
        schema = merge_schemas(schema, found)
    storage.remove(spark, f"{record}/{number:012d}.json")  # of a batch that is repeated
    storage.write_text(spark, f"{record}/{number:012d}.json", json.dumps(json.loads(schema.json())))
    whole = None
    for some, own in groups:
        rows = with_lineage(spark.read.schema(own).parquet(*some))
        cast = [F.col(f.name).cast(schema[f.name].dataType).alias(f.name) for f in own.fields]
        rows = rows.select(*cast, *LINEAGE.names)
        whole = rows if whole is None else whole.unionByName(rows, allowMissingColumns=True)
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields if f.name not in whole.columns]
    return whole.select("*", *missing).select(*schema.names, *LINEAGE.names)


def _records(spark: SparkSession, record: str) -> list[str]:
    return [name for name in storage.file_names(spark, record) if name.endswith(".json")]


def recorded_schema(spark: SparkSession, record: str) -> StructType:
    """The columns of all files ingested so far."""
    schema = _read_record(spark, record)
    if schema is None:
        raise RuntimeError(f"no schema recorded in {record}")
    return schema


def _read_record(spark: SparkSession, record: str) -> StructType | None:
    done = _records(spark, record)
    return StructType.fromJson(json.loads(storage.read_text(spark, f"{record}/{done[-1]}"))) if done else None


def forget_records(spark: SparkSession, record: str) -> None:
    """Remove all recorded schemas but the newest."""
    for name in _records(spark, record)[:-1]:
        storage.remove(spark, f"{record}/{name}")


def read_fixture(spark: SparkSession, path: str) -> DataFrame:
    """A fixture by suffix: ``.json`` holds a list of objects, ``.csv`` has a header, all strings."""
    if path.lower().endswith(".json"):
        return spark.read.option("multiLine", "true").json(path)
    if path.lower().endswith(".csv"):
        return spark.read.option("header", "true").csv(path)
    raise ValueError(f"unsupported fixture type: {path}")


def lookup_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table from literal rows, with its schema spelled out."""
    return spark.createDataFrame(rows, schema)


def preview(df: DataFrame, rows: int = 100, by: list[str] | None = None) -> DataFrame:
    """The first rows; with ``by`` always the same ones."""
    return (df.orderBy(*by) if by else df).limit(rows)
