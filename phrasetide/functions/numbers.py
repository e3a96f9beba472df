"""Vote arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def synthetic_downs(post_id: Column | str, ups: Column | str) -> Column:
    """A stand-in down-vote count, spread evenly over ``0..ups``.

    Drawn from a hash of the id instead of a random number, so a task that is
    run again gives the same value.
    """
    post_id = F.col(post_id) if isinstance(post_id, str) else post_id
    ups = F.col(ups) if isinstance(ups, str) else ups
    # 15 hex digits stay inside a signed 64-bit integer.
    drawn = F.conv(F.substring(F.md5(post_id.cast("string")), 1, 15), 16, 10).cast("bigint")
    return F.pmod(drawn, ups + 1)


def percent_change(value: Column | str, base: Column | str) -> Column:
    """Change against ``base`` in percent; NULL for a missing or zero base."""
    value = F.col(value) if isinstance(value, str) else value
    base = F.col(base) if isinstance(base, str) else base
    return F.lit(100.0) * value / F.nullif(base, F.lit(0)) - F.lit(100.0)


def percent_label(change: Column | str) -> Column:
    """Axis label: ``' + '`` before a rise, at most one decimal, percent sign."""
    change = F.col(change) if isinstance(change, str) else change
    shown = change.cast("decimal(20,1)")
    return F.concat(F.when(shown > 0, F.lit(" + ")).otherwise(F.lit("")),
                    F.regexp_replace(shown.cast("string"), r"\.0$", ""), F.lit("%"))
