"""chronoforge: time-series feature, diagnostics and forecasting operators on Spark DataFrames.

Every operator takes a DataFrame and returns a DataFrame. Series identity is a list of
``keys`` columns (``[]`` = one series); order is the ``time`` column. Nothing is collected to
the driver except small fixed-size results (model coefficients, a few hundred statistics).
"""

from chronoforge.session import checkpoint_dir, get_spark, reliable_checkpoint

__all__ = ["get_spark", "checkpoint_dir", "reliable_checkpoint"]
