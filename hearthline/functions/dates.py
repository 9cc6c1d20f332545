"""Timestamps without zone, ISO text and date windows."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Calendar dates in extended (2024-05-01) or basic (20240501) form, optionally
# followed by any one separator, a time and an offset. Year-only and year-month
# texts do not match.
ISO_PATTERN = (
    r"(?s)^(?<year>\d{4})(?<dash>-?)(?<month>\d{2})\k<dash>(?<day>\d{2})"
    r"(?:.(?<hour>\d{2})(?:(?<colon>:?)(?<minute>\d{2})(?:\k<colon>(?<second>\d{2})(?:[.,](?<fraction>\d+))?)?)?"
    r"(?:(?<sign>[+-])(?<hours>\d{2})(?:(?<mark>:?)(?<minutes>\d{2})(?:\k<mark>(?<seconds>\d{2})(?:[.,]\d+)?)?)?)?)?$"
)
# The two spellings met most, which a cast reads faster: a date, and a date-time to
# the second or finer in UTC.
_PLAIN_PATTERN = r"^(?!0000)\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}:\d{2}(?:\.\d{1,6})?Z?)?$"
# A date-time to the second with an offset: the same, shifted.
_OFFSET_PATTERN = r"^(?!0000)\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}[+-](?:[01]\d|2[0-3]):[0-5]\d\z"
# No date is shorter.
_LEAST = 8
# The parts by the number of their group.
_GROUPS = {
    "year": 1, "month": 3, "day": 4, "hour": 5, "minute": 7, "second": 8, "fraction": 9,
    "sign": 10, "hours": 11, "minutes": 13, "seconds": 14,
}
_PARTS = tuple(_GROUPS)


def ntz(moment: datetime | str | Column) -> Column:
    """A literal moment as TIMESTAMP_NTZ, independent of the session zone."""
    if isinstance(moment, Column):
        return moment.cast("timestamp_ntz")
    if isinstance(moment, datetime):
        if moment.tzinfo is not None:
            raise ValueError("pass a naive UTC datetime")
        moment = moment.isoformat(sep=" ")
    return F.lit(moment).cast("timestamp_ntz")


def day(moment: datetime | date | str | Column) -> Column:
    """The date of a literal moment or column."""
    if isinstance(moment, date) and not isinstance(moment, datetime):
        return F.lit(moment.isoformat()).cast("date")
    return ntz(moment).cast("date")


def iso_timestamp(text: str) -> str:
    """SQL for an ISO date or date-time text in UTC without zone; NULL if it is not
    one. ``text`` is SQL too; the parts are taken apart once and bound to ``p``.
    """
    zulu = f"replace({text}, 'Z', '+00:00')"
    listed = ",".join(f"${group}" for group in _GROUPS.values())

    def number(part: str) -> str:
        # The leading zero turns a part that is not there into 0.
        return f"CAST('0' || p[{_PARTS.index(part)}] AS INT)"

    micros = f"CAST(rpad(p[{_PARTS.index('fraction')}], 6, '0') AS INT)"
    local = (
        f"try_make_timestamp_ntz({number('year')}, {number('month')}, {number('day')}, {number('hour')}, "
        f"{number('minute')}, CAST({number('second')} + {micros} / 1e6D AS DECIMAL(16, 6)))"
    )
    shift = f"({number('hours')} * 3600 + {number('minutes')} * 60 + {number('seconds')})"
    in_range = (
        f"{number('year')} >= 1 AND {number('hour')} <= 23 AND {number('second')} <= 59 AND "
        f"{number('hours')} <= 23 AND {number('minutes')} <= 59 AND {number('seconds')} <= 59"
    )
    utc = (
        f"CASE WHEN p IS NULL THEN NULL WHEN {in_range} THEN timestampadd(SECOND, "
        f"if(p[{_PARTS.index('sign')}] = '-', {shift}, -{shift}), {local}) END"
    )
    # A text that matches never stays as it is, so that the pattern runs once.
    replaced = f"array(regexp_replace({zulu}, r'{ISO_PATTERN}', '{listed}'))"
    parts = f"transform({replaced}, r -> CASE WHEN r <> {zulu} THEN split(r, ',') END)"
    general = f"transform({parts}, p -> {utc})[0]"
    plain = f"{text} RLIKE r'{_PLAIN_PATTERN}'"
    offset = f"(CAST(substr({text}, 21, 2) AS INT) * 3600 + CAST(substr({text}, 24, 2) AS INT) * 60)"
    shifted = (
        f"timestampadd(SECOND, if(substr({text}, 20, 1) = '-', {offset}, -{offset}), "
        f"try_cast(substr({text}, 1, 19) AS TIMESTAMP_NTZ))"
    )
    return (
        f"CASE WHEN coalesce(length({text}), 0) < {_LEAST} THEN NULL "
        f"WHEN {plain} THEN try_cast(rtrim('Z', {text}) AS TIMESTAMP_NTZ) "
        f"WHEN {text} RLIKE r'{_OFFSET_PATTERN}' THEN {shifted} ELSE {general} END"
    )


def days_back(as_of: datetime | str | Column, days: int) -> tuple[Column, Column]:
    """First and last day of the window of ``days`` days up to ``as_of``."""
    last = day(as_of)
    return F.date_sub(last, days), last


def epoch_second(moment: Column) -> Column:
    """Seconds since 1970, fraction dropped, without passing through a zone."""
    return (
        F.unix_date(moment.cast("date")).cast("long") * 86400
        + F.hour(moment) * 3600
        + F.minute(moment) * 60
        + F.second(moment)
    )


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from start to end, both truncated to the second."""
    return epoch_second(end) - epoch_second(start)
