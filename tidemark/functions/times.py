"""Timestamps at a coarser precision, and as numbers; independent of the session's time zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _below(column: Column, digits: int) -> Column:
    """The part of the seconds below ``digits`` fractional digits, as an interval."""
    micros = (F.extract(F.lit("SECOND"), column) * 1_000_000).cast("bigint")
    rest = F.pmod(micros, F.lit(_step(digits)))
    return F.make_dt_interval(secs=(rest / F.lit(1_000_000)).cast("decimal(18,6)"))


def _step(digits: int) -> int:
    if not 0 <= digits <= 6:
        raise ValueError("precision must be between 0 and 6 digits")
    return 10 ** (6 - digits)


def truncate_timestamp(column: Column, digits: int = 3) -> Column:
    """Drop everything below ``digits`` fractional digits (towards the past, also before 1970)."""
    return column - _below(column, digits)


def round_timestamp(column: Column, digits: int = 3) -> Column:
    """Round half up to ``digits`` fractional digits."""
    half = F.make_dt_interval(secs=F.lit(_step(digits) // 2 / 1_000_000).cast("decimal(18,6)"))
    return truncate_timestamp(column + half, digits)


def epoch_micros(column: Column) -> Column:
    """Microseconds from 1970-01-01 00:00 to a timestamp without time zone."""
    since = column - F.lit("1970-01-01").cast("timestamp_ntz")
    return (since.cast("interval second").cast("decimal(20,6)") * 1_000_000).cast("bigint")


def from_epoch_micros(micros: Column) -> Column:
    seconds = (micros.cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
