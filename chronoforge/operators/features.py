"""Raw series -> feature table (section 3.1): parse time, dedupe, target + lags, drop missing.

One lazy chain; shuffles: the dedupe aggregate, the range repartition of the index, and one
window exchange on (keys, chunk) for all shifts together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from chronoforge.functions.columns import drop_missing, parse_time
from chronoforge.operators.sequence import IDX, dedupe_first, shift_columns

# The reference's feature recipe (target column, horizon, lag lists in its order).
TARGET = "temperature_2m"
HORIZON = 3
LAGS = {
    "temperature_2m": [1, 2, 3, 24],
    "wind_speed_10m": [1, 2, 6, 12, 24],
    "relative_humidity_2m": [1, 2, 36, 12, 24],
}


def feature_specs(target: str, horizon: int, lags: dict[str, list[int]]) -> list[tuple[str, str, int]]:
    specs = [(f"{target}_target", target, -horizon)]
    for col, ks in lags.items():
        specs += [(f"{col}_lag_{k}", col, k) for k in ks]
    return specs


def build_features(
    df: DataFrame,
    target: str = TARGET,
    horizon: int = HORIZON,
    lags: dict[str, list[int]] | None = None,
    keys: list[str] | None = None,
    time: str = "time",
    tiebreak: str | list[str] | None = None,
    dedupe: bool = True,
    strategy: str = "chunked",
    block_size: int | None = None,
    keep_index: bool = False,
) -> DataFrame:
    """B2 -> C4 -> C1 + C2 -> B3. Output: input columns, ``{target}_target``, lag columns."""
    keys = list(keys or [])
    lags = LAGS if lags is None else lags
    missing = [c for c in [target, *lags] if c not in df.columns]
    if missing:
        raise ValueError(f"columns not in the DataFrame: {missing}")
    out = parse_time(df, time)
    if dedupe:
        out = dedupe_first(out, keys, time, tiebreak)
    out = shift_columns(out, feature_specs(target, horizon, lags), keys, time, tiebreak,
                        strategy=strategy, block_size=block_size)
    out = drop_missing(out)
    return out if keep_index else out.drop(IDX)
