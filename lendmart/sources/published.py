"""Tables whose slices are published whole.

A slice is written to a directory of its own and becomes visible by one row in the table's
manifest, appended after the write has succeeded. Readers take each slice's newest row, so
they see the old slice or the new one, never a half; a failed write leaves the old one. The
manifest has a row per publication (slice, version, path, row count, columns, note), which
answers what is there, how large it is and what columns it has without a look at the data:
no listing, no footers. The columns of all slices together are the table's one schema; a
slice that lacks a column has nulls there. Two slices that disagree on a column's type are an
error when the second is published.

The number of slices is a calendar's, so their rows are collected. Superseded directories
stay until ``superseded`` has named them to whoever removes them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lendmart.sources.snapshots import small_table

MANIFEST = ("slice string, version long, path string, rows long, schema string, note string,"
            " published string")
_SLICE = "__slice"


def _manifest(path: str) -> str:
    return f"{path}/manifest"


def publications(spark: SparkSession, path: str) -> DataFrame:
    """Every publication of a table; none if there is no such table."""
    try:
        return spark.read.schema(MANIFEST).parquet(_manifest(path))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return small_table(spark, [], MANIFEST)
        raise


def _order(r: Row) -> tuple:
    return r["version"], r["published"], r["path"]


def entries(spark: SparkSession, path: str) -> list[Row]:
    """The newest publication of each slice, by slice."""
    newest: dict[str, Row] = {}
    for r in sorted(publications(spark, path).collect(), key=_order):
        newest[r["slice"]] = r
    return sorted(newest.values(), key=lambda r: r["slice"])


def slices(spark: SparkSession, path: str) -> DataFrame:
    """(slice, rows, version, note, published) of the slices that have rows."""
    rows = publications(spark, path)
    newest = F.max_by(F.struct("rows", "version", "note", "published"),
                      F.struct("version", "published", "path"))
    return rows.groupBy("slice").agg(newest.alias("r")).select("slice", "r.*").filter("rows > 0")


def held(spark: SparkSession, path: str) -> list[str]:
    """The slices that have rows, in order. Reads the manifest only."""
    return [r["slice"] for r in entries(spark, path) if r["rows"]]


def is_published(spark: SparkSession, path: str, value) -> bool:
    """Whether the slice holds rows. Reads the manifest only."""
    return str(value) in held(spark, path)


def newest_upto(spark: SparkSession, path: str, value, before: bool = False) -> str | None:
    """The last slice up to a date (before it, if asked for), from the manifest only."""
    found = [s for s in held(spark, path) if s < str(value) or s == str(value) and not before]
    return found[-1] if found else None


def contract(rows: Sequence[Row]) -> StructType:
    """The columns of all slices, those of the first publication first."""
    fields: dict[str, object] = {}
    for r in sorted(rows, key=_order):
        for f in StructType.fromJson(json.loads(r["schema"])):
            held = fields.setdefault(f.name, f)
            if held.dataType != f.dataType:
                raise ValueError(f"column {f.name} is {held.dataType.simpleString()} in one slice and"
                                 f" {f.dataType.simpleString()} in {r['slice']}")
    return StructType(list(fields.values()))


def _nullable(schema: StructType) -> str:
    return StructType([type(f)(f.name, f.dataType) for f in schema]).json()


def _announce(spark: SparkSession, path: str, rows: Sequence[tuple]) -> None:
    """Append (slice, version, path, rows, schema, note) to the manifest."""
    stamp = datetime.now(timezone.utc).isoformat()
    small_table(spark, [(*r, stamp) for r in rows], MANIFEST).coalesce(1).write.mode(
        "append").parquet(_manifest(path))


def _checked(df: DataFrame, known: Sequence[Row], replaced: Sequence[str]) -> tuple[int, str]:
    """The next version, and the frame's schema, which must fit the slices that stay."""
    version = max([r["version"] for r in known], default=0) + 1
    schema = _nullable(df.schema)
    contract([*[r for r in known if r["slice"] not in replaced],
              Row(slice=str(replaced), version=version, path="", schema=schema, published="")])
    return version, schema


def publish(df: DataFrame, path: str, value, note: str = "") -> int:
    """Write the frame as one slice and publish it; returns its number of rows."""
    spark = df.sparkSession
    version, schema = _checked(df, entries(spark, path), [str(value)])
    place = f"{path}/data/{value}-{uuid.uuid4().hex}"
    df.hint("rebalance").write.parquet(place)
    rows = spark.read.schema(df.schema).parquet(place).count()  # from the footers
    _announce(spark, path, [(str(value), version, place, rows, schema, note)])
    return rows


def publish_slices(df: DataFrame, path: str, by: str, note: str = "") -> dict[str, int]:
    """Publish every slice that the frame has by a column, in one pass over it; returns
    their numbers of rows. All become visible together."""
    spark, place = df.sparkSession, f"{path}/data/{uuid.uuid4().hex}"
    df.withColumn(_SLICE, F.col(by).cast("string")).hint("rebalance", F.col(_SLICE)).write \
        .partitionBy(_SLICE).parquet(place)
    written = spark.read.schema(
        StructType([*df.schema, StructField(_SLICE, StringType())])).parquet(place)
    counts = {r[0]: r[1] for r in written.groupBy(_SLICE).count().collect()}
    if None in counts:
        raise ValueError(f"{counts[None]} rows without {by}")
    version, schema = _checked(df, entries(spark, path), list(counts))
    _announce(spark, path, [(value, version, f"{place}/{_SLICE}={value}", n, schema, note)
                            for value, n in sorted(counts.items())])
    return counts


def read(spark: SparkSession, path: str, value=None, upto=None, after=None,
         columns: Sequence[str] | None = None) -> DataFrame:
    """One slice or a list of them, the slices after and up to a date, or all, with the
    columns of the whole table."""
    wanted = None if value is None else set(map(str, [value] if not isinstance(value, list)
                                                else value))
    known = entries(spark, path)
    if not known:
        raise ValueError(f"nothing is published at {path}")
    chosen = [r for r in known if r["rows"] and (wanted is None or r["slice"] in wanted)
              and (upto is None or r["slice"] <= str(upto))
              and (after is None or r["slice"] > str(after))]
    schema = contract(known)
    if chosen:
        df = spark.read.schema(schema).parquet(*[r["path"] for r in chosen])
    else:
        df = spark.createDataFrame([], schema)
    return df.select(*columns) if columns else df


def superseded(spark: SparkSession, path: str) -> list[str]:
    """Directories that no reader is sent to any more."""
    live = {r["path"] for r in entries(spark, path)}
    return sorted(r["path"] for r in publications(spark, path).select("path").collect()
                  if r["path"] not in live)
