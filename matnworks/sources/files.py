"""File formats, input contracts and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# CSV as RFC 4180 writes it: a quote in a field is doubled and a field may hold newlines. The format
# cannot tell an empty text from a missing one; both are read as null, and the corpus drops both.
CSV_READ = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"', "encoding": "UTF-8"}
# With column pruning a short record would pass when its missing fields are not asked for.
RAW_READ = {**CSV_READ, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record", "columnPruning": "false"}
CSV_WRITE = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "encoding": "UTF-8",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

CORRUPT = "_corrupt_record"

_local_base: dict[str, str] = {}
_open_paths: dict[str, list[str]] = {}


def _paths(spark: SparkSession) -> list[str]:
    """The scratch tables of this application."""
    return _open_paths.setdefault(spark.sparkContext.applicationId, [])


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder named by ``spark.checkpoint.dir``, removed by ``release``.

    Only a local session without that setting falls back to a temporary folder: on a cluster the
    executors could not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if context.applicationId not in _local_base:
            _local_base[context.applicationId] = tempfile.mkdtemp(prefix="matnworks-")
        base = _local_base[context.applicationId]
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _paths(spark).append(path)
    return path


def release(spark: SparkSession, since: int = 0) -> int:
    """Remove the scratch tables made after the first ``since``; call it once their results are consumed."""
    context, paths, removed = spark.sparkContext, _paths(spark), 0
    while len(paths) > since:
        path = context._jvm.org.apache.hadoop.fs.Path(paths.pop())
        removed += path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
    return removed


@contextmanager
def scratch_space(spark: SparkSession) -> Iterator[None]:
    """Scratch tables that are made inside are removed at the end; read results before that."""
    since = len(_paths(spark))
    try:
        yield
    finally:
        release(spark, since)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Free-text CSV with an explicit schema: no inference pass, and no shifted columns."""
    return spark.read.schema(schema).options(**CSV_READ).csv(path)


def raw_schema(schema: T.StructType) -> T.StructType:
    """All columns as text, and a column for records that do not have as many fields as the schema."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema] + [T.StructField(CORRUPT, T.StringType())])


def read_raw_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """CSV as text, for ``well_formed`` and ``malformed``; no row is dropped or guessed."""
    return spark.read.schema(raw_schema(schema)).options(**RAW_READ).option("header", header).csv(path)


def _fault(schema: T.StructType) -> Column:
    """Null for a good row, ``record`` for a wrong number of fields, else the first column that does not parse."""
    wrong = F.when(F.col(CORRUPT).isNotNull(), F.lit("record"))
    for f in schema:
        wrong = wrong.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), F.lit(f.name))
    return wrong


def well_formed(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows of a raw frame that fit the schema, with its types. Missing values stay null."""
    return raw.where(_fault(schema).isNull()).select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema])


def malformed(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """``record, reason`` of the other rows. A record with a wrong number of fields is kept as it was read."""
    record = F.coalesce(F.col(CORRUPT), F.to_csv(F.struct(*[F.col(f.name) for f in schema])))
    return raw.where(_fault(schema).isNotNull()).select(record.alias("record"), _fault(schema).alias("reason"))


def write_csv(df: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """A multi-line CSV file cannot be split on reading, so the size of each file is bounded."""
    df.write.mode("overwrite").options(**CSV_WRITE).option("maxRecordsPerFile", rows_per_file).csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_orc(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").orc(path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """The frame, written to the scratch folder and read back, so that later jobs start from it."""
    path = scratch(df.sparkSession, name)
    write_parquet(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _shape(schema: T.StructType) -> list[tuple[str, T.DataType]]:
    return [(f.name, f.dataType) for f in schema.fields]


def require_columns(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Fail before any job runs if a column is missing or has another type."""
    have = dict(_shape(df.schema))
    wrong = [
        f"{name} should be {kind.simpleString()}, is {have[name].simpleString() if name in have else 'missing'}"
        for name, kind in _shape(contract)
        if have.get(name) != kind
    ]
    if wrong:
        raise ValueError("; ".join(wrong))
    return df


def verify_written(df: DataFrame, written: DataFrame) -> int:
    """Compare schema and row count of a table read back with the frame it came from."""
    if _shape(df.schema) != _shape(written.schema):
        raise ValueError(f"schema changed: {df.schema.simpleString()} -> {written.schema.simpleString()}")
    expected, found = df.count(), written.count()
    if expected != found:
        raise ValueError(f"row count changed: {expected} -> {found}")
    return found
