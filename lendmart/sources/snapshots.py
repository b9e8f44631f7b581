"""Snapshot tables: parquet partitioned by their slice columns.

A slice (one month, or one month and model) is the unit of work. Re-running a
slice overwrites only its own partition directory, so the cost of a run is the
size of the slice, not of the history, and a re-run cannot duplicate rows.
"""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from lendmart import constants as K


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Raw CSV with a header and doubled quotes, as the schema's columns by name.

    All columns are read as text (no inference pass over the data) and cast leniently
    to the declared types; a column the header lacks is an error.
    """
    raw = spark.read.options(header=True, quote='"', escape='"').csv(path)
    return raw.select([F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema])


def snapshot_of(df: DataFrame, snapshot_date, column: str = K.SNAPSHOT) -> DataFrame:
    """One snapshot. On a partitioned table this prunes to one directory."""
    return df.filter(F.col(column) == F.lit(str(snapshot_date)).cast("date"))


def read_snapshot(spark: SparkSession, path: str, snapshot_date,
                  schema: StructType | None = None, columns: Sequence[str] | None = None,
                  column: str = K.SNAPSHOT) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = snapshot_of(reader.parquet(path), snapshot_date, column)
    return df.select(*columns) if columns else df


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def table_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
        return True
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def is_loaded(spark: SparkSession, path: str, value, column: str = K.SNAPSHOT) -> bool:
    """Whether the slice holds rows; partition pruning makes this a look at one directory."""
    return table_exists(spark, path) and not snapshot_of(
        spark.read.parquet(path), value, column).isEmpty()


def write_slices(df: DataFrame, path: str, by: Sequence[str] = (K.SNAPSHOT,),
                 mode: str = "replace", value=None, rebalance: bool = True) -> bool:
    """Write the frame's slices and return whether anything was written.

    ``replace`` overwrites the partitions present in the frame. With ``value``, the
    date of one slice, it replaces that slice as a whole: what the frame no longer has
    goes, also when it has no rows, and rows of other slices are not written. ``skip``
    leaves a slice alone that already holds rows and needs ``value``. Rows are rebalanced by slice before the write: AQE then splits a
    large slice over many tasks and merges small ones, so a month is neither one
    huge file nor thousands of small ones.
    """
    if mode not in ("replace", "skip"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode == "skip":
        if value is None:
            raise ValueError("mode='skip' needs value=")
        if is_loaded(df.sparkSession, path, value, by[0]):
            return False
    if value is not None:
        df = snapshot_of(df, value, by[0])
    out = df.hint("rebalance", *[F.col(c) for c in by]) if rebalance else df
    if value is not None:
        writer = out.drop(by[0]).write.mode("overwrite").option("partitionOverwriteMode", "static")
        (writer.partitionBy(*by[1:]) if by[1:] else writer).parquet(f"{path}/{by[0]}={value}")
        return True
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*by).parquet(path))
    return True


def upsert_slice(existing: DataFrame, new: DataFrame, value, key: str = K.SNAPSHOT) -> DataFrame:
    """Relational form of a slice replacement: all other slices plus the new rows.

    Columns only one side has are filled with null; a slice with new columns never
    drops the history.
    """
    kept = existing.filter(~F.col(key).eqNullSafe(F.lit(str(value)).cast("date")))
    return kept.unionByName(new, allowMissingColumns=True)


def list_slices(df: DataFrame, *columns: str) -> DataFrame:
    """The distinct slices of a table."""
    return df.select(*columns).distinct()


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: StructType | str) -> DataFrame:
    """A few driver values as a table. Handed over as Arrow, it becomes a local relation
    of known size; no Python worker is started for it."""
    kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = list(zip(*rows)) if rows else [()] * len(kind)
    arrow = pa.table({f.name: pa.array(list(values), to_arrow_type(f.dataType))
                      for f, values in zip(kind, columns)})
    return spark.createDataFrame(arrow, schema=kind)


@functools.cache
def _own_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="lendmart-")


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder the session names in spark.checkpoint.dir, or the one its
    context was given. Only a local master, as in tests, may do without: on a cluster
    executors would not see a folder of the driver's machine."""
    named = (spark.conf.get("spark.checkpoint.dir", None)
             or spark.sparkContext.getCheckpointDir())
    if not named and not spark.conf.get("spark.master", "local[*]").startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return named or _own_folder(spark.sparkContext.applicationId)


def stage(df: DataFrame) -> DataFrame:
    """Write a frame that several passes will read to the shared folder, and read it
    back.

    The passes then share one evaluation, a lost executor costs re-reading a file
    rather than recomputing the lineage, column pruning still applies, and the
    optimizer knows the real size.
    """
    path = f"{checkpoint_folder(df.sparkSession)}/lendmart-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: str) -> DataFrame:
    """``stage`` by buckets of a key, as many as a shuffle has partitions: joins and groups
    by the key then read their buckets and move only the other side.

    A task writes a file for every bucket it has rows of, so the frame should already be
    dealt out by the key, or have few rows. The catalog's entry goes again at once; the
    files, which are not the catalog's own, stay as those of ``stage`` do.
    """
    spark, name = df.sparkSession, f"lendmart_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, key).option(
        "path", f"{checkpoint_folder(spark)}/lendmart-{uuid.uuid4().hex}").saveAsTable(name)
    rows = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return rows
