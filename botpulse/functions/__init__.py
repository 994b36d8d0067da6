"""Shared column helpers, constants and day ranges."""

from botpulse.functions.dates import DayRange, day_spine, spread_over_days, within
from botpulse.functions.metrics import bot_type, ratio, zero_if_null

__all__ = ["DayRange", "day_spine", "spread_over_days", "within", "bot_type", "ratio", "zero_if_null"]
