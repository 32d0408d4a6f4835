"""Clocks in log text: patterns that find them, columns that read them.

A line pattern takes a clock apart by named groups; `clock_parts` lists them in ISO order
with the month's name on its own, and `wall_clock` casts them. No second pattern runs, and
an impossible date gives NULL. Wall clocks are kept as written (`timestamp_ntz`), whatever
the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names in log clocks.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")

ZONE = r"[+-]\d{2}:?[0-5]\d(?::?[0-5]\d)?|Z"
WEEKDAY = r"(?:[Mm]on|[Tt]ue|[Ww]ed|[Tt]hu|[Ff]ri|[Ss]at|[Ss]un|MON|TUE|WED|THU|FRI|SAT|SUN)"
_TIME = r"\d{1,2}:\d{1,2}:\d{1,2}"
_MONTH = "[A-Za-z]{3}"


# Patterns name their groups by what they hold plus a letter, so several fit in one line.
def access_clock(at: str) -> str:
    """`23/Nov/2025:08:15:23`"""
    return rf"(?<day{at}>\d{{1,2}})/(?<month{at}>{_MONTH})/(?<year{at}>\d{{4}}):(?<time{at}>{_TIME})"


def error_clock(at: str, fraction: str = "") -> str:
    """`Sun Nov 23 08:15:23 2025`"""
    return (
        rf"{WEEKDAY}\s+(?<month{at}>{_MONTH})\s+(?<day{at}>\d{{1,2}})\s+"
        rf"(?<time{at}>{_TIME}{fraction})\s+(?<year{at}>\d{{4}})"
    )


def iso_clock(at: str) -> str:
    """`2025-11-23 08:15:23`"""
    return (
        rf"(?<year{at}>\d{{4}})-(?<num{at}>\d{{2}})-(?<day{at}>\d{{2}})\s+"
        rf"(?<time{at}>\d{{2}}:\d{{2}}:\d{{2}})"
    )


def bracket_clocks() -> str:
    """Clocks a bracket in a free-form line may hold, each filling the bracket.

    Seconds, and after a date the whole time, may be missing. Of two numbers parted by a
    slash the first is the month unless it is above 12. A time may be one of a half day, and
    date and time may be plain digits.
    """
    fraction = r"(?:[.,]\d{1,6})?"
    time = rf"\d{{1,2}}:\d{{2}}(?::\d{{2}}{fraction})?"
    month_day = r"(?:0?[1-9]|1[0-2])"
    forms = (
        rf"(?<yearC>\d{{4}})-(?<numC>\d{{1,2}})-(?<dayC>\d{{1,2}})(?:[T\s]\s*(?<timeC>{time}))?",
        rf"(?<yearD>\d{{4}})/(?<numD>\d{{1,2}})/(?<dayD>\d{{1,2}})(?:\s+(?<timeD>{time}))?",
        rf"(?<numE>{month_day})/(?<dayE>\d{{1,2}})/(?<yearE>\d{{4}})(?:\s+(?<timeE>{time}))?",
        rf"(?<dayI>1[3-9]|[23]\d)/(?<numI>{month_day})/(?<yearI>\d{{4}})(?:\s+(?<timeI>{time}))?",
        error_clock("F", fraction),
        rf"(?:{WEEKDAY},?\s+)?(?<dayG>\d{{1,2}})\s+(?<monthG>{_MONTH})\s+(?<yearG>\d{{4}})(?:\s+(?<timeG>{time})(?:\s+GMT)?)?",
        rf"(?<monthH>{_MONTH})\s+(?<dayH>\d{{1,2}}),?\s+(?<yearH>\d{{4}})(?:\s+(?<timeH>{time}))?",
        r"(?<yearK>\d{4})(?<numK>\d{2})(?<dayK>\d{2})(?:[T\s]?(?<timeK>\d{6}))?",
    )
    half = r"(?:\s*(?<half>[AaPp])[Mm])?"
    return rf"\s*(?:{'|'.join(forms)}){half}(?:\s*(?<zoneC>{ZONE}))?\s*(?=\])"


def clock_parts(named: str = "", numbered: str = "") -> list[str]:
    """Replacement texts for the parts of a clock: `2025-`, `Nov`, `-23 08:15:23`.

    The letters tell which clocks the pattern holds, with a month's name or its number (a
    number joins the first part). Groups of clocks that did not match come out empty.
    """

    def every(part: str, letters: str) -> str:
        return "".join(f"${{{part}{at}}}" for at in letters)

    return [
        f"{every('year', named + numbered)}-{every('num', numbered)}",
        every("month", named),
        f"-{every('day', named + numbered)} {every('time', named + numbered)}",
    ]


def wall_clock(year: Column, month: Column, rest: Column) -> Column:
    """The clock of three parts; NULL for an impossible one."""
    numbers = {"": ""} | {name: f"{i:02d}" for i, name in enumerate(MONTHS, 1)}
    lookup = F.create_map(*[F.lit(x) for pair in numbers.items() for x in pair])
    number = lookup[F.lower(month)]
    return F.concat(year, number, rest).try_cast("timestamp_ntz")


def whole_day_time(rest: Column, half: Column) -> Column:
    """Day and time with the hour counted from midnight, and with the time's colons.

    `half` is `a`, `p` or empty; an hour above 12 in a half day gives NULL.
    """
    day, time = F.substring_index(rest, " ", 1), F.substring_index(rest, " ", -1)
    hour = F.substring_index(time, ":", 1).try_cast("int")
    counted = hour % 12 + F.when(F.lower(half) == "p", 12).otherwise(0)
    behind = time.substr(F.instr(time, ":"), F.lit(32))
    moved = F.concat(day, F.lit(" "), F.lpad(counted.cast("string"), 2, "0"), behind)
    digits = F.concat_ws(":", time.substr(1, 2), time.substr(3, 2), time.substr(5, 2))
    return (
        F.when((half == "") & ((F.instr(time, ":") > 0) | (time == "")), rest)
        .when(half == "", F.concat(day, F.lit(" "), digits))
        .when(hour <= 12, moved)
    )


def instant(clock: Column, zone: Column) -> Column:
    """The instant of a wall clock in a written zone; NULL without a zone."""
    return F.when(zone != "", F.concat(clock.cast("string"), zone).try_cast("timestamp"))
