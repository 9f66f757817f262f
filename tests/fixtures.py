"""Synthetic fixtures of FIXTURES.md section 3 (built in tests only)."""

from __future__ import annotations

import numpy as np
import pandas as pd


def hourly_grid(seed: int = 0) -> pd.DataFrame:
    """Gap-free hours 2024-01-01 00:00 .. 2024-06-30 23:00 (4,368 rows)."""
    rng = np.random.default_rng(seed)
    t = pd.date_range("2024-01-01", "2024-06-30 23:00", freq="h")
    n = len(t)
    hour = t.hour.to_numpy()
    temp = 14 + 4 * np.sin(2 * np.pi * (hour - 9) / 24) + rng.normal(0, 0.8, n).cumsum() * 0.05
    hum = 75 - 2 * (temp - 14) + rng.normal(0, 3, n)
    wind = np.abs(5 + rng.normal(0, 1.5, n))
    return pd.DataFrame({"time": t, "temperature_2m": temp, "relative_humidity_2m": hum,
                         "wind_speed_10m": wind})


def white_noise(n: int = 2000, seed: int = 1) -> np.ndarray:
    return np.random.default_rng(seed).normal(0, 1, n)


def random_walk(n: int = 2000, seed: int = 2) -> np.ndarray:
    return np.random.default_rng(seed).normal(0, 1, n).cumsum()


def sine24(n: int = 2000, seed: int = 3) -> np.ndarray:
    rng = np.random.default_rng(seed)
    return np.sin(2 * np.pi * np.arange(n) / 24) + rng.normal(0, 0.2, n)


def series_frame(values: np.ndarray, start: str = "2024-01-01", freq: str = "h", key=None) -> pd.DataFrame:
    t = pd.date_range(start, periods=len(values), freq=freq)
    df = pd.DataFrame({"time": t, "y": values})
    if key is not None:
        df.insert(0, "series", key)
    return df
