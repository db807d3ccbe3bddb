"""Scalar column expressions (E*, P5, S3).  All built-in Spark functions, so
they stay inside whole-stage code generation; no Python UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KMH_TO_MS = 3.6  # km/h divided by this gives m/s


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def travel_time(distance: str | Column, speed: str | Column,
                unit_factor: float = KMH_TO_MS) -> Column:
    """Seconds to cover ``distance`` metres at ``speed`` km/h.

    distance / (speed / 3.6); a zero or null speed gives null (the reference
    got null from non-ANSI division; ``try_divide`` keeps that under ANSI).
    """
    return F.try_divide(_c(distance), _c(speed) / F.lit(unit_factor))


def hour_timestamp(day: str | Column, hour: str | Column, fmt: str = "yyyyMMdd") -> Column:
    """Timestamp of ``hour`` o'clock on ``day`` (text or yyyyMMdd integer).

    Hour 24 rolls to 00:00 of the next day; unparsable day text gives null
    instead of failing the job.
    """
    day_ts = F.try_to_timestamp(_c(day).cast("string"), F.lit(fmt))
    return F.timestamp_add("HOUR", _c(hour).cast("int"), day_ts)


def digits_only(text: str | Column) -> Column:
    return F.regexp_replace(_c(text), r"[^0-9]", "")


def file_period(name: str | Column) -> Column:
    """Struct (digits, ext, period) from a monthly file name.

    ``digits``: every digit of the part before the first dot
    (``2017년 12월 통행속도.csv`` -> ``201712``; ``2017년 1월`` -> ``20171``, which
    does not sort, hence ``period``); ``ext``: the part after the first dot;
    ``period``: first day of the month, from a 4-digit year followed by a
    1-2 digit month, or from a name that is six digits only (``202112.csv``).
    """
    n = _c(name)
    stem = F.split_part(n, F.lit("."), F.lit(1))
    # year and month must be whole digit runs (not part of a longer number)
    pattern = r"(?<!\d)(\d{4})\D+(\d{1,2})(?!\d)"
    plain = stem.rlike(r"^\d{6}$")
    year = F.when(plain, F.substring(stem, 1, 4)).otherwise(F.regexp_extract(n, pattern, 1))
    month = F.when(plain, F.substring(stem, 5, 2)).otherwise(F.regexp_extract(n, pattern, 2))
    period = F.try_to_date(F.concat_ws("-", year, month, F.lit("1")), "yyyy-M-d")
    return F.struct(digits_only(stem).alias("digits"),
                    F.split_part(n, F.lit("."), F.lit(2)).alias("ext"),
                    period.alias("period"))


def base_name(path: str | Column, level: int = 0) -> Column:
    """File name (level 0) or the name of an enclosing folder (level 1, 2...)."""
    parts = F.split(_c(path), "/")
    return F.url_decode(F.element_at(parts, -1 - level))
