"""evwin: event-window analytics on Spark DataFrames.

Entities with an anchor date (new listings), vendor-keyed daily price series,
source-precedence resolution, a ``[anchor, anchor + N days]`` window join,
coverage classes, first/last/min/max returns, cohort benchmarks, load
worklists, serving queries and data-quality checks.  Every operator is a lazy
``f(DataFrame, ..., *, params) -> DataFrame``; nothing collects.
"""

from evwin.config import Params, DEFAULT_PARAMS

__all__ = ["Params", "DEFAULT_PARAMS"]
