"""Reusable DataFrame operators (each is a function DataFrame -> DataFrame)."""

from subledger.operators.calendar import calendar_fill, union_dates
from subledger.operators.dedup import keep_latest
from subledger.operators.firsts import conditional_min, first_value_by
from subledger.operators.intervals import interval_sum_daily
from subledger.operators.rejects import tag_rejects
from subledger.operators.sequence import prev_in_order, prev_in_ranges

__all__ = [
    "calendar_fill",
    "union_dates",
    "keep_latest",
    "first_value_by",
    "conditional_min",
    "interval_sum_daily",
    "tag_rejects",
    "prev_in_order",
    "prev_in_ranges",
]
