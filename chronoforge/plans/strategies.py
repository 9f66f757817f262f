"""Join and partitioning choices.

``join_small`` attaches a small per-key or per-partition statistics table to a big table.
The small side is materialised once (reliable checkpoint, cheap because it is small), its row
count is checked, and only then broadcast; beyond the bound the join stays a shuffle join and
AQE's skew-join split handles a hot key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoforge.session import reliable_checkpoint

# Broadcast bound for statistics tables (rows). A row of such a table is < 100 bytes.
BROADCAST_MAX_ROWS = 2_000_000


def key_condition(left: DataFrame, right: DataFrame, cols: list[str]) -> Column | None:
    """Null-safe equality on ``cols`` (series keys may be NULL)."""
    conds = [left[c].eqNullSafe(right[c]) for c in cols]
    return reduce(lambda a, b: a & b, conds) if conds else None


def join_small(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    how: str = "inner",
    max_rows: int = BROADCAST_MAX_ROWS,
    materialize: bool = True,
) -> DataFrame:
    """Join ``small`` (statistics, one row per key) onto ``big`` on ``on``.

    The small side is checkpointed and counted; it is broadcast only if the count is at most
    ``max_rows``. With ``on == []`` the small side must have exactly one row; its values are
    attached as literals (a fixed-size result, not a join).
    """
    if materialize:
        small = reliable_checkpoint(small)
    n_small = small.count()
    if not on:
        if n_small != 1:
            raise ValueError(f"global statistics must have one row, got {n_small}")
        # one verified row of statistics: attach its values as typed literals
        row = small.first()
        return big.withColumns({f.name: F.lit(row[f.name]).cast(f.dataType) for f in small.schema.fields})
    # both sides get private key names and the condition uses unbound column names, so a small
    # side derived from the big one (same attribute ids) never makes the join ambiguous
    left = big
    right = small
    for c in on:
        left = left.withColumnRenamed(c, f"__l_{c}")
        right = right.withColumnRenamed(c, f"__r_{c}")
    if n_small <= max_rows:
        right = F.broadcast(right)
    cond = reduce(lambda a, b: a & b, [F.col(f"__l_{c}").eqNullSafe(F.col(f"__r_{c}")) for c in on])
    out = left.join(right, cond, how)
    for c in on:
        out = out.withColumnRenamed(f"__l_{c}", c)
    return out.drop(*[f"__r_{c}" for c in on])
