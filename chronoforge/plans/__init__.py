"""Plan-shape helpers shared by the operators (join strategy for statistics tables)."""

from chronoforge.plans.strategies import join_small, key_condition

__all__ = ["join_small", "key_condition"]
