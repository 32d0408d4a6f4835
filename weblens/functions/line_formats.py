"""The four line formats as column expressions.

A format rewrites a line into its parts with one regular expression and splits them: the
cheapest way to get many groups out of a line without leaving generated code (a
`regexp_extract` per group would run the expression once for each). A line holds no
"\\n", so the number of parts tells whether the pattern matched.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from weblens import schema as S
from weblens.functions.classify import keyword_level, level_status, status_level
from weblens.functions.clocks import (
    ZONE,
    access_clock,
    bracket_clocks,
    clock_parts,
    error_clock,
    instant,
    iso_clock,
    wall_clock,
    whole_day_time,
)

# The line patterns, used as they are to detect a file's format.
ACCESS_PATTERN = r'(\S+) \S+ \S+ \[(.*?)\] "(\S+) (\S+) (\S+)" (\d+) (\S+)'
NGINX_PATTERN = r'(\S+) - - \[(.*?)\] "(\S+) (\S+) (\S+)" (\d+) (\d+)'
ERROR_PATTERN = r"\[(.*?)\] \[(.*?)\] (.*)"
STRICT_ACCESS_PATTERN = r'(\S+) \S+ \S+ \[([^\]]+)\] "(\S+) (\S+) (\S+)" (\d+) (\d+|-)'
MIN_FALLBACK_TOKENS = 5
ABSENT = "-"


def at_line_start(pattern: str) -> str:
    """A pattern anchored at the start; `(?d)` lets a dot match all but "\\n"."""
    return "(?d)^" + pattern


_GROUP = re.compile(r"\\.|\[(?:\\.|[^\]\\])*\]|\((?:(?!\?)|\?<(\w+)>)")


def _by_number(pattern: str, parts: str) -> tuple[str, str]:
    """Turn named groups into numbered ones, which are filled in much faster."""
    opening = [m for m in _GROUP.finditer(pattern) if m.group().startswith("(")]
    number = {m[1]: n for n, m in enumerate(opening, 1) if m[1]}
    plain = _GROUP.sub(lambda m: "(" if m[1] else m.group(), pattern)
    return plain, re.sub(r"\$\{(\w+)\}", lambda m: f"${number[m[1]]}", parts)


def rewrite(raw: Column, pattern: str, parts: Sequence[str]) -> Column:
    """The line's parts if the whole line fits the pattern, else an array of one."""
    whole, listed = _by_number(at_line_start(f"(?:{pattern})$"), "\n".join(parts))
    return F.split(F.regexp_replace(raw, F.lit(whole), F.lit(listed)), "\n", -1)


class LineFormat(NamedTuple):
    """A format: what its lines look like, how to take one apart, and its columns.

    `fields` may only be read where `parts` has `size` elements.
    """

    name: str
    pattern: str | None
    size: int
    parts: Callable[[Column], Column]
    fields: Callable[[Column, Column], dict[str, Column]]


def _clock_fields(first: Column, month: Column, rest: Column, zone: Column) -> dict[str, Column]:
    clock = wall_clock(first, month, rest)
    return {"ts": clock, "ts_utc": instant(clock, zone)}


def _or_absent(text: Column) -> Column:
    return F.when(text == "", ABSENT).otherwise(text)


# --- access lines, common or combined ----------------------------------------------

# A bracket may start with a clock, after which only a zone is of interest.
_BRACKET = (
    rf"(?<text>(?:\s*{access_clock('A')}(?=\s|\] \")(?:\s+(?<zoneA>{ZONE})(?=\]))?)?.*?)"
)
_REQUEST = r'"(?<method>\S+) (?<path>\S+) (?<protocol>\S+)"'
_ACCESS_LINE = rf"(?<ip>\S+) \S+ \S+ \[{_BRACKET}\] {_REQUEST} (?<status>\d+) (?<size>\S+).*"
_NGINX_LINE = rf"(?<ip>\S+) - - \[{_BRACKET}\] {_REQUEST} (?<status>\d+) (?<size>\d+).*"

# A malformed access line: at least five tokens, parted by blanks or quotes.
_ENOUGH_TOKENS = rf"(?=(?>[^\s\"]*+(?:\s*\"\s*|\s+)){{{MIN_FALLBACK_TOKENS - 1}}})"
_FIRST_TOKEN = r"(?=(?<ipB>[^\s\"]*+))"
# The first bracket anywhere: if it does not end, no later one does. A clock counts only if
# the bracket holds more than it.
_ZONED = rf"(?=[^\]\n]*[ ]|\S+\s+(?:{ZONE})\])"
_ANY_BRACKET = (
    rf"(?:(?=[^\[]*+(?<textB>\[(?:{_ZONED}\s*{access_clock('B')}(?=[\s\]])"
    rf"(?:\s+(?<zoneB>{ZONE})(?=\]))?)?[^\]]*+\]))|)"
)
# The first quoted text is the request; what follows the last quote is status and size.
_QUOTED = (
    r'[^"]*+"(?:\s*+(?<methodB>[^"\s]*+)\s*+(?<pathB>[^"\s]*+)\s*+(?<protocolB>[^"\s]*+)[^"]*+")?'
    r'(?:.*")?\s*+(?<statusB>[^"\s]*+)\s*+(?<sizeB>[^"\s]*+)[^"]*+'
)
# Without quotes the last two tokens are.
_UNQUOTED = r'(?:[^"]*\s)?(?<statusC>[^"\s]++)\s++(?<sizeC>[^"\s]*+)'
_MALFORMED_LINE = _ENOUGH_TOKENS + _FIRST_TOKEN + _ANY_BRACKET + f"(?:{_QUOTED}|{_UNQUOTED})"

_ACCESS_PARTS = (
    "${ip}",
    "${ip}${ipB}",
    "${text}${textB}",
    *clock_parts(named="AB"),
    "${zoneA}${zoneB}",
    "${method}${methodB}",
    "${path}${pathB}",
    "${protocol}${protocolB}",
    "${status}${statusB}${statusC}",
    "${size}${sizeB}${sizeC}",
)


def _access_fields(raw: Column, part: Column) -> dict[str, Column]:
    matched = part[0] != ""
    # The malformed line's bracket comes with its brackets, or not at all.
    text = (
        F.when(matched, part[2])
        .when(part[2] == "", ABSENT)
        .otherwise(F.regexp_replace(part[2], r"^\[|\]$", ""))
    )
    # Only after quotes is a size missing; as a last token it may be empty.
    size = F.when((part[11] == "") & raw.contains('"'), ABSENT).otherwise(part[11])
    status = part[10].try_cast("int")
    return {
        "parse_status": F.when(matched, S.MATCHED).otherwise(S.FALLBACK),
        "ip": part[1],
        "method": _or_absent(part[7]),
        "path": _or_absent(part[8]),
        "protocol": _or_absent(part[9]),
        "timestamp_raw": text,
        "status_raw": _or_absent(part[10]),
        "status_code": status,
        "size_raw": size,
        "size_bytes": part[11].try_cast("bigint"),
        "error_level": F.when(matched, status_level(status)).otherwise(S.INFO),
    } | _clock_fields(part[3], part[4], part[5], part[6])


ACCESS = LineFormat(
    "apache",
    ACCESS_PATTERN,
    len(_ACCESS_PARTS),
    lambda raw: rewrite(raw, f"{_ACCESS_LINE}|{_MALFORMED_LINE}", _ACCESS_PARTS),
    _access_fields,
)


# --- nginx lines: no fallback, numeric size ----------------------------------------

_NGINX_PARTS = (
    "${ip}",
    *clock_parts(named="A"),
    "${zoneA}",
    "${method}",
    "${path}",
    "${protocol}",
    "${status}",
    "${size}",
)


def _nginx_fields(raw: Column, part: Column) -> dict[str, Column]:
    status = part[8].try_cast("int")
    return {
        "parse_status": F.lit(S.MATCHED),
        "ip": part[0],
        "method": part[5],
        "path": part[6],
        "protocol": part[7],
        "status_raw": part[8],
        "status_code": status,
        "size_raw": part[9],
        "size_bytes": part[9].try_cast("bigint"),
        "error_level": status_level(status),
    } | _clock_fields(part[1], part[2], part[3], part[4])


NGINX = LineFormat(
    "nginx",
    NGINX_PATTERN,
    len(_NGINX_PARTS),
    lambda raw: rewrite(raw, _NGINX_LINE, _NGINX_PARTS),
    _nginx_fields,
)


# --- error lines: [time] [level] message -------------------------------------------

_ERROR_CLOCK = (
    rf"{error_clock('A')}(?=\])"
    rf"|\s*{access_clock('B')}(?=[\s\]])(?:\s+(?<zoneB>{ZONE})(?=\]))?"
)
_ERROR_LINE = rf"\[(?:{_ERROR_CLOCK})?.*?\] \[(?<level>.*?)\] (?<message>.*)"
_ERROR_PARTS = (*clock_parts(named="AB"), "${zoneB}", "${level}", "${message}")


def _error_fields(raw: Column, part: Column) -> dict[str, Column]:
    return {
        "parse_status": F.lit(S.MATCHED),
        "status_code": level_status(part[4]),
        "error_level": F.upper(part[4]),
        "message": part[5],
    } | _clock_fields(part[0], part[1], part[2], part[3])


ERROR_LOG = LineFormat(
    "error",
    ERROR_PATTERN,
    len(_ERROR_PARTS),
    lambda raw: rewrite(raw, _ERROR_LINE, _ERROR_PARTS),
    _error_fields,
)


# --- anything else: a clock if one can be found ------------------------------------

# The first form that occurs anywhere, in this order, decides, even if it is no date.
_FREE_LINE = (
    rf"(?:(?=.*?{iso_clock('A')})|(?=.*?{access_clock('B').replace('{1,2}', '{2}')})"
    rf"|(?=[^\[]*+\[(?:{bracket_clocks()})?[^\]]*+\])|).*"
)
_FREE_PARTS = (*clock_parts(named="BFGH", numbered="ACDEIK"), "${zoneC}", "${half}")


def _generic_fields(raw: Column, part: Column) -> dict[str, Column]:
    rest = whole_day_time(F.replace(part[2], F.lit(","), F.lit(".")), part[4])
    return {
        "parse_status": F.lit(S.MATCHED),
        "error_level": keyword_level(raw),
        "message": raw,
    } | _clock_fields(part[0], part[1], rest, part[3])


GENERIC = LineFormat(
    "generic",
    None,
    len(_FREE_PARTS),
    lambda raw: rewrite(raw, _FREE_LINE, _FREE_PARTS),
    _generic_fields,
)

# Detection takes the first of these, in this order, that fits half the sample.
FORMATS: dict[str, LineFormat] = {f.name: f for f in (ACCESS, NGINX, ERROR_LOG, GENERIC)}
