"""runoff: cohort expected-credit-loss analytics on Spark DataFrames."""
from runoff.config import DEFAULT, YOUNG_BOOK, EclConfig, MobGrid, Window  # noqa: F401

__all__ = ["DEFAULT", "YOUNG_BOOK", "EclConfig", "MobGrid", "Window"]
