"""Positional sequence operators (C1-C5) and the two execution patterns behind them.

P1 (``strategy="window"``): ``Window.partitionBy(*keys).orderBy(time)``. Simple, but one key is
one task, and ``keys=[]`` plans ``Exchange SinglePartition``.

P2 (``strategy="chunked"``, the default): a distributed positional index and chunk + halo.

1. Range-repartition by ``(keys, order)`` and sort inside partitions; number rows with
   ``monotonically_increasing_id`` (consecutive inside a partition). The result is written to the
   checkpoint folder, so the range sample is taken once and a lost executor cannot renumber rows.
2. Per ``(partition, key)`` count and first id (a table of at most partitions + keys rows);
   running sum of counts over partitions gives each piece's offset.
3. ``idx = offset + id - first_id``: the row's position in its series, exact and dense.
4. Windows then run per ``(keys, chunk)`` with ``chunk = idx div B``; rows within ``back`` of a
   chunk's end are also sent to the next chunk and rows within ``fwd`` of its start to the
   previous one, so every lag / lead / trailing frame up to that depth is complete. Only owned
   rows are kept. A hot key is split into ``n / B`` independent groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronoforge.plans.strategies import join_small
from chronoforge.session import reliable_checkpoint

IDX = "idx"
DEFAULT_BLOCK = 8192


def _order_cols(time: str, tiebreak: str | list[str] | None) -> list[str]:
    if tiebreak is None:
        return [time]
    if isinstance(tiebreak, str):
        return [time, tiebreak]
    return [time, *tiebreak]


# --------------------------------------------------------------------------------------------
# C4 / B2 helpers that define the series before any positional work
# --------------------------------------------------------------------------------------------


def dedupe_first(
    df: DataFrame,
    keys: list[str] | None = None,
    time: str = "time",
    tiebreak: str | list[str] | None = None,
) -> DataFrame:
    """C4: one row per ``(keys, time)``, the one with the smallest tiebreak.

    Written as an aggregate ``min(struct(tiebreak, rest))`` so that partial aggregation keeps at
    most one row per group per map task before the shuffle: a timestamp that repeats in a third
    of all rows costs one row per task, not one task holding them all. Without a tiebreak every
    remaining column takes part in the ordering (deterministic, unlike an unstable sort).
    """
    keys = list(keys or [])
    ties = [] if tiebreak is None else ([tiebreak] if isinstance(tiebreak, str) else list(tiebreak))
    rest = [c for c in df.columns if c not in keys and c != time and c not in ties]
    packed = F.struct(*[F.col(c) for c in ties + rest]).alias("__row")
    out = df.groupBy(*keys, time).agg(F.min(packed).alias("__row"))
    return out.select(*keys, time, *[F.col(f"__row.{c}").alias(c) for c in df.columns
                                     if c not in keys and c != time]).select(*df.columns)


# --------------------------------------------------------------------------------------------
# Positional index
# --------------------------------------------------------------------------------------------


def window_index(df: DataFrame, keys: list[str], order: list[str], idx_col: str = IDX) -> DataFrame:
    """P1 positional index: ``row_number() - 1`` per key (one key = one task)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(idx_col, (F.row_number().over(w) - 1).cast("long"))


def positional_index(
    df: DataFrame,
    keys: list[str] | None = None,
    time: str = "time",
    tiebreak: str | list[str] | None = None,
    idx_col: str = IDX,
    n_col: str | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """P2 positional index: ``idx`` = 0-based row position within the series ordered by
    ``(time, tiebreak)``; optionally ``n_col`` = series length. No single-partition step over
    data rows; the only window runs over the (partition, key) statistics table.
    """
    keys = list(keys or [])
    order = _order_cols(time, tiebreak)
    range_cols = [F.col(c) for c in keys + order]
    # Without an explicit count the session's shuffle parallelism applies and AQE may coalesce
    # adjacent ranges (a coalesced partition is still one contiguous range).
    ranged = df.repartitionByRange(num_partitions, *range_cols) if num_partitions else \
        df.repartitionByRange(*range_cols)
    ranged = (
        ranged
        .sortWithinPartitions(*keys, *order)
        .withColumn("__pid", F.spark_partition_id())
        .withColumn("__mono", F.monotonically_increasing_id())
    )
    ranged = reliable_checkpoint(ranged)
    stats = ranged.groupBy("__pid", *keys).agg(
        F.count(F.lit(1)).alias("__cnt"), F.min("__mono").alias("__first")
    )
    w = Window.partitionBy(*keys).orderBy("__pid")
    stats = stats.withColumn(
        "__off",
        F.coalesce(F.sum("__cnt").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    )
    cols = ["__pid", *keys, "__off", "__first"]
    if n_col:
        stats = stats.withColumn(n_col, F.sum("__cnt").over(Window.partitionBy(*keys)))
        cols.append(n_col)
    out = join_small(ranged, stats.select(*cols), on=["__pid", *keys])
    out = out.withColumn(idx_col, (F.col("__off") + F.col("__mono") - F.col("__first")).cast("long"))
    return out.drop("__pid", "__mono", "__off", "__first")


def ensure_index(
    df: DataFrame,
    keys: list[str] | None = None,
    time: str = "time",
    tiebreak: str | list[str] | None = None,
    strategy: str = "chunked",
) -> DataFrame:
    """Add ``idx`` unless present."""
    if IDX in df.columns:
        return df
    keys = list(keys or [])
    if strategy == "window":
        return window_index(df, keys, _order_cols(time, tiebreak))
    return positional_index(df, keys, time, tiebreak)


def order_and_number(
    df: DataFrame,
    keys: list[str] | None = None,
    time: str = "time",
    tiebreak: str | list[str] | None = None,
    strategy: str = "chunked",
) -> DataFrame:
    """Drop rows with NULL time and number the rest in time order (``idx``)."""
    df = df.na.drop(subset=[time])
    return ensure_index(df.drop(IDX) if IDX in df.columns else df, keys, time, tiebreak, strategy)


# --------------------------------------------------------------------------------------------
# Chunk + halo
# --------------------------------------------------------------------------------------------


def halo_expand(
    df: DataFrame,
    back: int,
    fwd: int,
    block_size: int | None = None,
) -> tuple[DataFrame, int]:
    """Emit every indexed row to its chunk, plus to the next chunk if it lies in the last
    ``back`` rows of its own, plus to the previous chunk if it lies in the first ``fwd`` rows.
    Adds ``__chunk`` (group) and ``__own`` (row belongs to this group). Returns the block size.
    """
    block = max(block_size or max(DEFAULT_BLOCK, 8 * (back + fwd)), back, fwd, 1)
    chunk = F.floor(F.col(IDX) / F.lit(block)).cast("long")
    pos = F.col(IDX) - chunk * F.lit(block)
    targets = [chunk]
    if back > 0:
        targets.append(F.when(pos >= F.lit(block - back), chunk + 1))
    if fwd > 0:
        targets.append(F.when((pos < F.lit(fwd)) & (chunk > 0), chunk - 1))
    out = (
        df.withColumn("__home", chunk)
        .withColumn("__chunk", F.explode(F.filter(F.array(*targets), lambda x: x.isNotNull())))
        .withColumn("__own", F.col("__chunk") == F.col("__home"))
        .drop("__home")
    )
    return out, block


def _window(keys: list[str], strategy: str) -> Window:
    if strategy == "window":
        return Window.partitionBy(*keys).orderBy(IDX)
    return Window.partitionBy(*keys, "__chunk").orderBy(IDX)


def shift_columns(
    df: DataFrame,
    specs: list[tuple[str, str, int]],
    keys: list[str] | None = None,
    time: str = "time",
    tiebreak: str | list[str] | None = None,
    strategy: str = "chunked",
    block_size: int | None = None,
    keep_index: bool = True,
) -> DataFrame:
    """Positional shifts. ``specs`` = ``[(out_name, col, k)]``; ``k > 0`` is the value ``k`` rows
    earlier (lag), ``k < 0`` the value ``|k|`` rows later (lead). All shifts share one sort.
    """
    keys = list(keys or [])
    had_idx = IDX in df.columns
    indexed = ensure_index(df, keys, time, tiebreak, strategy)
    back = max([k for _, _, k in specs if k > 0], default=0)
    fwd = max([-k for _, _, k in specs if k < 0], default=0)

    def expr(col: str, k: int, w):
        return F.lag(col, k).over(w) if k > 0 else F.lead(col, -k).over(w) if k < 0 else F.col(col)

    if strategy == "window":
        w = _window(keys, strategy)
        out = indexed.select("*", *[expr(c, k, w).alias(name) for name, c, k in specs])
    else:
        expanded, _ = halo_expand(indexed, back, fwd, block_size)
        w = _window(keys, strategy)
        out = (
            expanded.select("*", *[expr(c, k, w).alias(name) for name, c, k in specs])
            .filter(F.col("__own"))
            .drop("__chunk", "__own")
        )
    if not keep_index and not had_idx:
        out = out.drop(IDX)
    return out


def add_target(df: DataFrame, col: str, horizon: int, keys=None, time="time", **kw) -> DataFrame:
    """``{col}_target`` = value ``horizon`` rows ahead (NULL in the last ``horizon`` rows)."""
    return shift_columns(df, [(f"{col}_target", col, -horizon)], keys, time, **kw)


def add_lags(df: DataFrame, col: str, lags: list[int], keys=None, time="time", **kw) -> DataFrame:
    """``{col}_lag_{k}`` for each ``k`` in ``lags`` (in the given order).

    An unknown column raises (the reference logs and continues; a Spark user expects an error).
    """
    if col not in df.columns:
        raise ValueError(f"column {col!r} is not in the DataFrame")
    return shift_columns(df, [(f"{col}_lag_{k}", col, k) for k in lags], keys, time, **kw)


def trailing_window(
    df: DataFrame,
    cols: list[str],
    window: int,
    out: str = "x",
    keys: list[str] | None = None,
    extra: list[tuple[str, str, int]] | None = None,
    strategy: str = "chunked",
    block_size: int | None = None,
    time: str = "time",
    tiebreak: str | list[str] | None = None,
) -> DataFrame:
    """Array of the last ``window`` rows (oldest first) of ``struct(cols)`` per row, plus
    optional shifts ``extra`` computed in the same pass. Rows keep their ``idx``.
    """
    keys = list(keys or [])
    indexed = ensure_index(df, keys, time, tiebreak, strategy)
    extra = list(extra or [])
    back = max([window - 1] + [k for _, _, k in extra if k > 0])
    fwd = max([0] + [-k for _, _, k in extra if k < 0])
    packed = F.struct(*[F.col(c) for c in cols])

    def shifted(c, k, w):
        return F.lag(c, k).over(w) if k > 0 else F.lead(c, -k).over(w)

    if strategy == "window":
        w = _window(keys, strategy)
        frame = w.rowsBetween(-(window - 1), 0)
        return indexed.select(
            "*", F.collect_list(packed).over(frame).alias(out),
            *[shifted(c, k, w).alias(n) for n, c, k in extra],
        )
    expanded, _ = halo_expand(indexed, back, fwd, block_size)
    w = _window(keys, strategy)
    frame = w.rowsBetween(-(window - 1), 0)
    return (
        expanded.select(
            "*", F.collect_list(packed).over(frame).alias(out),
            *[shifted(c, k, w).alias(n) for n, c, k in extra],
        )
        .filter(F.col("__own"))
        .drop("__chunk", "__own")
    )
