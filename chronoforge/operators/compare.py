"""Joins, sorts and limits over scored tables (F1-F6, G13 glue)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def comparison_table(a: DataFrame, b: DataFrame, actual: str, names: tuple[str, str],
                     on: list[str] | None = None, prediction: str = "prediction") -> DataFrame:
    """side-by-side table of two scored tables (equi-join on ``on``): actual, both predictions and
    both errors (actual − prediction). Without ``on`` the tables hold one series each and join on ``time``; a time that
    repeats raises then, as rows of different series would be paired."""
    if not on:
        on = ["time"]
        for t in (a, b):
            if not t.groupBy(*on).count().where("count > 1").isEmpty():
                raise ValueError("a time repeats: give the keys of the series in `on`")
    na, nb = names
    left = a.select(*on, actual, F.col(prediction).alias(f"pred_{na}"))
    right = b.select(*on, F.col(prediction).alias(f"pred_{nb}"))
    out = left.join(right, on=on, how="inner")
    return out.withColumns({
        f"error_{na}": F.col(actual) - F.col(f"pred_{na}"),
        f"error_{nb}": F.col(actual) - F.col(f"pred_{nb}"),
    })


def leaderboard(metrics: DataFrame, by: str, name: str = "model") -> DataFrame:
    """rank models by a metric (ascending; ties by name). The metrics table is small
    (one row per model), so its global order is cheap."""
    w = Window.orderBy(F.col(by).asc(), F.col(name).asc())
    return metrics.withColumn("rank", F.row_number().over(w).cast("int"))


def top_k(df: DataFrame, by: str, k: int, keys: list[str] | None = None, tiebreak: str | None = None,
          descending: bool = True) -> DataFrame:
    """first ``k`` rows per key by ``by``.

    Keyed: ``row_number`` over ``(keys)``. Without keys: Spark's ``orderBy().limit(k)``
    (TakeOrderedAndProject keeps ``k`` rows per task, then merges)."""
    keys = list(keys or [])
    order = [F.col(by).desc() if descending else F.col(by).asc()]
    if tiebreak:
        order.append(F.col(tiebreak).asc())
    if not keys:
        return df.orderBy(*order).limit(k)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w).cast("int")).filter(F.col("rank") <= k)


def union_parts(a: DataFrame, b: DataFrame) -> DataFrame:
    """union by column name (order restored by the consumer's ``idx``/``time``)."""
    return a.unionByName(b)


def align_columns(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    """positional column concat of two tables of the same series, as an equi-join on
    ``(keys…, idx)`` (a DataFrame has no implicit row order)."""
    return a.join(b, on=on, how="inner")
