"""Run parameters.  Every time-dependent operator takes ``as_of`` explicitly;
nothing calls ``current_date``."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


# --- fixed values (must equal the reference's defaults) -------------------
MODEL_RECENT_DAYS = 180          # listing look-back in the models
WORKLIST_RECENT_DAYS = 120       # listing look-back in the load worklists
LONG_WINDOW_DAYS = 100           # long post-listing window
SHORT_WINDOW_DAYS = 30           # short post-listing window
LONG_COVERAGE_LIMITS = (20, 60)  # very_low < 20 <= partial < 60 <= good
SHORT_COVERAGE_LIMITS = (15, 7, 1)  # good >= 15, partial >= 7, very_low >= 1
CALENDAR_LOOKBACK_DAYS = 365
CALENDAR_LOOKAHEAD_DAYS = 14
BACKFILL_START_YEAR = 2014
HISTORY_LOOKBACK_DAYS = 30
# Budgets of web calls, and the slider's ends; never defaults, only passed explicitly.
PROFILE_LIMITS = {"finnhub": 30, "yahoo": 50}
RESOLVE_LIMITS = {"alphavantage": 50, "yahoo": 80}
PRICE_PAIR_LIMIT = 40
BACKFILL_LIMIT = 30
RETURN_FILTER_RANGE = (-100.0, 300.0)
# ---------------------------------------------------------------------------

# As-of date of the derived test inputs (FIXTURES.md §2).
FIXTURE_AS_OF = dt.date(2001, 6, 30)


@dataclass(frozen=True)
class Params:
    as_of: dt.date = FIXTURE_AS_OF
    model_recent_days: int = MODEL_RECENT_DAYS
    worklist_recent_days: int = WORKLIST_RECENT_DAYS
    long_window: int = LONG_WINDOW_DAYS
    short_window: int = SHORT_WINDOW_DAYS
    long_limits: tuple = LONG_COVERAGE_LIMITS
    short_limits: tuple = SHORT_COVERAGE_LIMITS
    # Width of the date buckets used to turn the window (range) join into an
    # equi-join on (symbol, bucket).  Smaller = fewer wasted pairs, more
    # replicated listing rows.  [design]
    bucket_days: int = 32
    # Worklists are whole unless a run passes a budget.
    profile_limit: int | None = None
    resolve_limit: int | None = None
    price_pair_limit: int | None = None
    backfill_limit: int | None = None


DEFAULT_PARAMS = Params()
