"""Exact order statistics by repeated value histograms.

No value is sorted or ranked. For every wanted rank an interval of values is known to hold it; a pass counts the values of
each interval in bins (one aggregate with partial sums, so a value that fills a third of the table costs one row a
task) and keeps the one bin with the rank, tightened to the smallest and largest value in it. The interval is a single
value after a few passes, and that value is the answer. All groups, ranks and intervals go through the same passes.

Bins: 512 of equal width; in every other pass an interval that holds zero or spans many orders of magnitude has bins of
equal width in the exponent instead. The mapping is monotone, hence exact whatever its rounding.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoforge.plans.strategies import join_small
from chronoforge.session import written_table

LINEAR_BINS = 512


def _finite(x: Column) -> Column:
    return F.greatest(F.least(x, F.lit(1.7976931348623157e308)), F.lit(-1.7976931348623157e308))


def _exponent(x: Column) -> Column:
    """A monotone map of the doubles to +-2200 that spreads them by their exponents."""
    size = F.log2(F.abs(x)) + F.lit(1100.0)
    return F.when(x > 0, size).when(x < 0, -size).otherwise(F.lit(0.0))


def _bin(x: Column, lo: Column, hi: Column, by_exponent: bool) -> Column:
    """A monotone bin number of ``x`` in [lo, hi]; halves avoid an overflow of the width. The ends have bins of their
    own, so that every pass tightens an interval of two values or more."""
    at, low, high = (_finite(v) * F.lit(0.5) for v in (x, lo, hi))
    equal = F.floor(F.try_divide(at - low, high - low) * LINEAR_BINS)
    if by_exponent:
        e, e_lo, e_hi = (_exponent(_finite(v)) for v in (x, lo, hi))
        wide = (low <= 0) & (high >= 0) | (F.abs(e_hi - e_lo) > 20)
        equal = F.when(wide, F.floor(F.try_divide(e - e_lo, e_hi - e_lo) * LINEAR_BINS)).otherwise(equal)
    return F.when(x == lo, F.lit(-1)).when(x == hi, F.lit(LINEAR_BINS + 1)).otherwise(F.coalesce(equal, F.lit(0))).cast("int")


def order_statistics(values: DataFrame, ranks: DataFrame, group: list[str], value: str) -> DataFrame:
    """(group, rank, value): the value of each 0-based ``rank`` of ``ranks(group, rank)`` among its group's non-null
    values. ``values`` is read once per pass."""
    span = written_table(values.groupBy(*group).agg(F.min(value).alias("lo"), F.max(value).alias("hi")))
    now = join_small(ranks, span, on=group, materialize=False).withColumn("below", F.lit(0).cast("long"))
    now = written_table(now.select(*group, "rank", "lo", "hi", "below"))
    for turn in count():
        active = now.where("lo < hi")
        if active.isEmpty():
            return now.select(*group, "rank", F.col("lo").alias(value))
        # the intervals of a group are the same or apart, so a value lies in one of them at most
        held = active.groupBy(*group).agg(F.collect_set(F.struct("lo", "hi")).alias("__held"))
        met = join_small(values, written_table(held), on=group, materialize=False)
        mine = F.filter("__held", lambda h: (h["lo"] <= F.col(value)) & (F.col(value) <= h["hi"]))
        met = met.select(*group, value, F.get(mine, F.lit(0)).alias("__in")).where("__in IS NOT NULL")
        met = met.select(*group, value, F.col("__in.lo").alias("__lo"), _bin(F.col(value), F.col("__in.lo"), F.col("__in.hi"), turn % 2 == 1).alias("__bin"))
        counts = met.groupBy(*group, "__lo", "__bin").agg(F.count(F.lit(1)).alias("__c"), F.min(value).alias("__min"), F.max(value).alias("__max"))
        w = Window.partitionBy(*group, "__lo").orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("__before", F.coalesce(F.sum("__c").over(w), F.lit(0)))
        # bins of a group by ranks of a group: both are few
        wanted = written_table(active.groupBy(*group).agg(F.collect_list(F.struct("rank", "lo", "below")).alias("__ranks")))
        found = join_small(counts, wanted, on=group, materialize=False)
        found = found.select(*group, "__lo", "__c", "__min", "__max", "__before", F.explode("__ranks").alias("__r")).where(
            (F.col("__r.lo") == F.col("__lo")) & (F.col("__r.rank") >= F.col("__r.below") + F.col("__before"))
            & (F.col("__r.rank") < F.col("__r.below") + F.col("__before") + F.col("__c")))
        moved = found.select(*group, F.col("__r.rank").alias("rank"), F.col("__min").alias("lo"), F.col("__max").alias("hi"),
                             (F.col("__r.below") + F.col("__before")).alias("below"))
        now = written_table(now.where("NOT lo < hi").unionByName(moved))


def quantiles_exact(long: DataFrame, probs: list[float], group: list[str], value: str = "value", names: list[str] | None = None) -> DataFrame:
    """Linear-interpolation quantiles (``h = (n-1)p``) per ``group`` over ``value`` without NULL and NaN; one row per group
    that has a value."""
    names = names or [f"q{int(round(p * 100))}" for p in probs]
    keys = group or ["__all"]
    vals = long.filter(F.col(value).isNotNull() & ~F.isnan(value))
    vals = written_table((vals if group else vals.withColumn("__all", F.lit(0))).select(*keys, value))
    counts = written_table(vals.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")))
    h = [(F.col("__n") - 1) * F.lit(float(p)) for p in probs]
    wanted = F.array_distinct(F.concat(*[F.array(F.floor(x).cast("long"), F.ceil(x).cast("long")) for x in h]))
    found = order_statistics(vals, counts.select(*keys, F.explode(wanted).alias("rank")), keys, value)
    found = found.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("rank", value))).alias("__at"))
    # Spark's map lookup of a rank that is there by construction
    low = [F.element_at("__at", F.floor(x).cast("long")) for x in h]
    high = [F.element_at("__at", F.ceil(x).cast("long")) for x in h]
    out = join_small(found, counts, on=keys, materialize=False)
    return out.select(*group, *[
        F.when(a == b, a).otherwise(a + (x - F.floor(x)) * (b - a)).alias(name) for a, b, x, name in zip(low, high, h, names)])
