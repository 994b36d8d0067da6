"""Column helpers shared by the KPI jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from botpulse.functions.constants import AIGC, ALL_BOTS


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num: Column | str, den: Column | str, decimals: int) -> Column:
    """``ROUND(num / NULLIF(den, 0), decimals)``: NULL when ``den`` is 0 or NULL.

    Spark ``round`` is HALF_UP; ``/`` on integral columns yields a double.
    """
    num, den = _col(num), _col(den)
    return F.round(num.cast("double") / F.nullif(den, F.lit(0)), decimals)


def zero_if_null(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit(0))


def bot_type(matched: Column) -> Column:
    """``AIGC`` when the bot matched the AIGC dimension, else ``AllBots``."""
    return F.when(matched, F.lit(AIGC)).otherwise(F.lit(ALL_BOTS))
