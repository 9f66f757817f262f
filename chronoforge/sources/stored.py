"""Series kept on storage so that later reads prune (B7, B8) and later windows need no exchange.

* Monthly tables: Parquet partitioned by year and month. ``month = 6`` becomes a partition filter, so a held-out month
  and its lead-in read their own folders only. For tables without such folders ``month_ranges`` turns the month into time
  ranges, which reach the Parquet readers as pushed filters (``month(time) = 6`` does not).
* Stored series: rows with their position ``idx``, cut into chunks and bucketed by (keys, chunk); each row is also kept in
  the neighbour chunk if it lies within ``back`` or ``fwd`` of its border. Lags, leads and trailing frames then are windows
  over buckets: no range exchange, no checkpoint, no hash exchange. A manifest holds the rows per series, from which later rows
  go on counting.
"""

from __future__ import annotations

import datetime
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronoforge.functions.columns import nan_to_null
from chronoforge.operators.sequence import DEFAULT_BLOCK, IDX, halo_expand, positional_index
from chronoforge.plans.strategies import join_small
from chronoforge.session import reliable_checkpoint
from chronoforge.sources.io import scratch_path

YEAR, MONTH = "__year", "__month"


# --------------------------------------------------------------------------------------------
# Monthly tables
# --------------------------------------------------------------------------------------------


def write_monthly(df: DataFrame, path: str, time: str = "time", mode: str = "overwrite") -> str:
    """``df`` as Parquet in one folder per year and month of ``time``; rows without a time have a folder of their own."""
    df.withColumn(YEAR, F.year(time)).withColumn(MONTH, F.month(time)).write.mode(mode).partitionBy(YEAR, MONTH).parquet(path)
    return path


def read_monthly(spark: SparkSession, path: str, months: list[int] | None = None, without: int | None = None) -> DataFrame:
    """The rows of ``months``, or of all but the month ``without`` (rows without a time are not in it); other folders are
    not read."""
    df = spark.read.parquet(path)
    if months is not None:
        df = df.where(F.col(MONTH).isin(months))
    if without is not None:
        df = df.where(F.col(MONTH).isNull() | (F.col(MONTH) != without))
    return nan_to_null(df.drop(YEAR, MONTH))


def read_holdout(spark: SparkSession, path: str, part: str, month: int = 6, hours: int = 0, keys: list[str] | None = None,
                 time: str = "time") -> DataFrame:
    """One part of the month holdout (B7), or with ``hours`` of the holdout with lead-in (B8), from a monthly table.

    ``predict`` reads the month and, for the lead-in, the months before it that ``hours`` can reach; ``train`` all others. The rows
    are those that ``columns.month_holdout`` and ``holdout_with_leadin`` label so."""
    keys = list(keys or [])
    held = read_monthly(spark, path, months=[month])
    if not hours:
        return held if part == "predict" else read_monthly(spark, path, without=month)
    firsts = held.groupBy(*keys).agg(F.min(time).alias("__first"))
    reach = [(month - 1 - back) % 12 or 12 for back in range(min(11, 1 + hours // (28 * 24)))]
    near = read_monthly(spark, path, months=[m for m in reach if m != month])
    lead = (F.col(time) >= F.col("__first") - F.expr(f"INTERVAL {int(hours)} HOURS")) & (F.col(time) < F.col("__first"))
    if part == "predict":
        return held.unionByName(join_small(near, firsts, on=keys).where(lead).drop("__first"))
    far = read_monthly(spark, path, without=month)
    joined = join_small(far, firsts, on=keys, how="left" if keys else "inner")
    return joined.where(~F.coalesce(lead, F.lit(False))).drop("__first")


def month_ranges(lo: datetime.datetime, hi: datetime.datetime, month: int) -> list[tuple[datetime.datetime, datetime.datetime]]:
    """The months ``month`` between ``lo`` and ``hi`` as half-open time ranges."""
    after = (1, 1) if month == 12 else (0, month + 1)
    return [(datetime.datetime(y, month, 1), datetime.datetime(y + after[0], after[1], 1)) for y in range(lo.year, hi.year + 1)]


def in_month(df: DataFrame, month: int, lo: datetime.datetime, hi: datetime.datetime, time: str = "time") -> DataFrame:
    """Rows of calendar month ``month`` of a table whose times lie between ``lo`` and ``hi``, by comparisons with constants that the
    file readers can apply to row-group statistics."""
    kind = df.schema[time].dataType
    cond: Column | None = None
    for a, b in month_ranges(lo, hi, month):
        one = (F.col(time) >= F.lit(a).cast(kind)) & (F.col(time) < F.lit(b).cast(kind))
        cond = one if cond is None else cond | one
    return df.where(cond)


# --------------------------------------------------------------------------------------------
# Stored series
# --------------------------------------------------------------------------------------------


@dataclass
class StoredSeries:
    """A bucketed table of indexed rows with halos, its manifest ``keys, n, last``, and how it was cut."""

    spark: SparkSession
    table: str
    manifest: DataFrame
    keys: list[str]
    time: str
    columns: list[str]
    back: int
    fwd: int
    block: int
    buckets: int

    def rows(self) -> DataFrame:
        """The series once, with ``idx``."""
        return self.spark.table(self.table).where("__own").select(*self.columns, IDX)


def _save(indexed: DataFrame, s: StoredSeries, path: str | None, mode: str) -> None:
    expanded, block = halo_expand(indexed, s.back, s.fwd, s.block)
    if block != s.block:
        raise ValueError(f"a block of {s.block} rows is smaller than its halo")
    # a bucket of a chunk is written by one task, from rows that the exchange brings in its order
    dealt = expanded.repartition(s.buckets, *s.keys, "__chunk")
    w = dealt.write.mode(mode).bucketBy(s.buckets, *s.keys, "__chunk").sortBy(IDX)
    (w.option("path", path) if path else w).format("parquet").saveAsTable(s.table)


def store_series(df: DataFrame, keys: list[str] | None = None, time: str = "time", tiebreak: str | list[str] | None = None, back: int = 64,
                 fwd: int = 16, block: int = DEFAULT_BLOCK, buckets: int = 16, path: str | None = None, name: str | None = None) -> StoredSeries:
    """Index ``df`` once and store it for windows of up to ``back`` rows before and ``fwd`` after a row."""
    keys = list(keys or [])
    spark = df.sparkSession
    name = name or f"series_{uuid.uuid4().hex}"
    indexed = positional_index(df, keys, time, tiebreak)
    s = StoredSeries(spark, name, indexed, keys, time, list(df.columns), back, fwd, block, buckets)
    _save(indexed, s, path or scratch_path(spark, "series"), "overwrite")
    s.manifest = _manifest(s)
    return s


def _manifest(s: StoredSeries) -> DataFrame:
    """Rows and last time of each series."""
    return reliable_checkpoint(s.rows().groupBy(*s.keys).agg(F.count(F.lit(1)).alias("n"), F.max(s.time).alias("last")))


def append_series(s: StoredSeries, df: DataFrame, tiebreak: str | list[str] | None = None) -> StoredSeries:
    """Add later rows: positions go on from the manifest, stored rows stay as they are. A row that is not later than its
    series' last stored one raises."""
    indexed = positional_index(df.select(*s.columns), s.keys, s.time, tiebreak)
    known = s.manifest if s.keys else s.manifest.where("n > 0")
    if s.keys:
        met = join_small(indexed, known.withColumnsRenamed({"n": "__n", "last": "__last"}), on=s.keys, how="left")
    else:
        row = known.first()
        met = indexed.withColumn("__n", F.lit(row["n"] if row else 0)).withColumn("__last", F.lit(row["last"] if row else None).cast(df.schema[s.time].dataType))
    met = reliable_checkpoint(met)
    if not met.where(F.col(s.time) <= F.col("__last")).isEmpty():
        raise ValueError("rows to append must be later than the stored ones of their series")
    _save(met.withColumn(IDX, F.col(IDX) + F.coalesce("__n", F.lit(0))).drop("__n", "__last"), s, None, "append")
    s.manifest = _manifest(s)
    return s


def _window(s: StoredSeries) -> Window:
    return Window.partitionBy(*s.keys, "__chunk").orderBy(IDX)


def shift_stored(s: StoredSeries, specs: list[tuple[str, str, int]]) -> DataFrame:
    """``sequence.shift_columns`` on a stored series: ``(out, col, k)``, k > 0 rows earlier, k < 0 later. No exchange."""
    if max([k for _, _, k in specs] + [0]) > s.back or max([-k for _, _, k in specs] + [0]) > s.fwd:
        raise ValueError(f"the series is stored for shifts of {s.back} rows back and {s.fwd} ahead")
    w = _window(s)
    out = s.spark.table(s.table).select("*", *[(F.lag(c, k).over(w) if k > 0 else F.lead(c, -k).over(w) if k < 0 else F.col(c)).alias(name) for name, c, k in specs])
    return out.where("__own").drop("__own", "__chunk")


def windows_stored(s: StoredSeries, cols: list[str], window: int, target: str, horizon: int) -> DataFrame:
    """C5 on a stored series: ``x`` = the last ``window`` rows of ``cols``, ``y`` = ``target`` ``horizon`` rows ahead, for every row
    that has both. No exchange."""
    if window - 1 > s.back or horizon > s.fwd:
        raise ValueError(f"the series is stored for windows of {s.back + 1} rows and {s.fwd} ahead")
    w = _window(s)
    frame = F.collect_list(F.array(*[F.col(c).cast("float") for c in cols])).over(w.rowsBetween(1 - window, 0))
    out = s.spark.table(s.table).select(*s.keys, s.time, IDX, "__own", F.lead(target, horizon).over(w).cast("float").alias("y"), frame.alias("x"))
    return out.where((F.col("__own")) & (F.size("x") == window) & F.col("y").isNotNull()).drop("__own")
