"""Column-level helpers and reusable relational building blocks."""

from hirelens.functions.percentile import percentile_cont
from hirelens.functions.ratio import safe_ratio
from hirelens.functions.time import days_between, week_start

__all__ = ["days_between", "percentile_cont", "safe_ratio", "week_start"]
