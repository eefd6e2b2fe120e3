"""Times: parsing, shifting, formatting."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

LOCAL_ZONE = "Asia/Singapore"

# Python date codes and the Java date patterns they stand for.
DATE_CODES = {
    "Y": "yyyy", "m": "MM", "d": "dd", "H": "HH", "M": "mm", "S": "ss",
    "a": "E", "A": "EEEE", "b": "MMM", "B": "MMMM", "y": "yy", "I": "hh",
    "p": "a", "f": "SSSSSS", "z": "Z", "Z": "z", "j": "DDD",
    "c": "EEE MMM d HH:mm:ss yyyy", "X": "HH:mm:ss", "G": "yyyy",
}


def java_pattern(python_format: str) -> str:
    """Translate ``%Y-%m-%d`` into ``yyyy-MM-dd``; ``%%`` is a percent sign."""
    def code(match: re.Match) -> str:
        letter = match.group(1)
        if letter == "%":
            return "%"
        if letter not in DATE_CODES:
            raise ValueError(f"no pattern for %{letter} in {python_format!r}")
        return DATE_CODES[letter]

    return re.sub(r"%(.)", code, python_format)


def format_ts(value: Column, python_format: str) -> Column:
    return F.date_format(value, java_pattern(python_format))


def shifted(value: Column, hours: int) -> Column:
    """Read ISO-8601 text as a time and add hours; text that is no time gives NULL."""
    return F.try_to_timestamp(value) + F.make_dt_interval(hours=F.lit(hours))


def to_local_time(value: Column, zone: str = LOCAL_ZONE) -> Column:
    return F.from_utc_timestamp(value, zone)
