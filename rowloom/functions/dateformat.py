"""Date formats of several dialects, compiled to expressions for writing and for reading.

A format is cut into elements. Most stand for letters of a Spark pattern; the others (ISO weeks, Julian
days, seconds of the day, two-digit years with a window, ordinals) are expressions. For reading, such an
element is matched by a regular expression and rewritten to text that a Spark pattern can read. What is
not an element of the dialect raises, as does reading an element that says too little about a date.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowloom.functions.nulls import as_col

# Format elements and their Spark pattern letters.
_ELEMENTS = {
    "YYYY": "yyyy",
    "YY": "yy",
    "MONTH": "MMMM",
    "MON": "MMM",
    "MM": "MM",
    "DD": "dd",
    "DAY": "EEEE",
    "DY": "EEE",
    "DDD": "DDD",
    "HH24": "HH",
    "HH12": "hh",
    "HH": "hh",
    "MI": "mm",
    "SS": "ss",
    "FF": "SSSSSS",
    "FF3": "SSS",
    "FF6": "SSSSSS",
    "AM": "a",
    "PM": "a",
    "Q": "Q",
}
_PERCENT_ELEMENTS = {
    "%Y": "yyyy",
    "%y": "yy",
    "%m": "MM",
    "%c": "M",
    "%d": "dd",
    "%e": "d",
    "%H": "HH",
    "%k": "H",
    "%h": "hh",
    "%I": "hh",
    "%l": "h",
    "%i": "mm",
    "%s": "ss",
    "%S": "ss",
    "%f": "SSSSSS",
    "%p": "a",
    "%M": "MMMM",
    "%b": "MMM",
    "%W": "EEEE",
    "%a": "EEE",
    "%j": "DDD",
    "%T": "HH:mm:ss",
    "%r": "hh:mm:ss a",
}
# format strings of .NET, which FORMAT of T-SQL takes
_NET_ELEMENTS = {
    "yyyy": "yyyy",
    "yy": "yy",
    "MMMM": "MMMM",
    "MMM": "MMM",
    "MM": "MM",
    "M": "M",
    "dddd": "EEEE",
    "ddd": "EEE",
    "dd": "dd",
    "d": "d",
    "HH": "HH",
    "H": "H",
    "hh": "hh",
    "h": "h",
    "mm": "mm",
    "m": "m",
    "ss": "ss",
    "s": "s",
    "f": "S",
    "ff": "SS",
    "fff": "SSS",
    "ffff": "SSSS",
    "fffff": "SSSSS",
    "ffffff": "SSSSSS",
    "tt": "a",
}
# what a pattern's letters look like in a text
_LOOKS = {"yyyy": r"\d{4}", "yy": r"\d{2}", "MMMM": "[A-Za-z]+", "MMM": "[A-Za-z]+", "EEEE": "[A-Za-z]+", "EEE": "[A-Za-z]+", "a": "[AaPp][Mm]", "DDD": r"\d{3}"}
_JULIAN_OF_1970 = 2440588


class Made(NamedTuple):
    """An element without a pattern of its own: how it is written and, where it can be, read."""

    write: Callable[[Column], Column]
    looks: str | None = None
    reread: Callable[[Column], Column] | None = None
    pattern: str = ""


class Element(NamedTuple):
    """A piece of a format: text that stands for itself, a Spark pattern, or a made element."""

    text: str | None = None
    pattern: str | None = None
    made: Made | None = None


def _padded(number: Column, width: int) -> Column:
    return F.lpad(number.cast("int").cast("string"), width, "0")


def _iso_year(value: Column) -> Column:
    return F.date_part(F.lit("YEAROFWEEK"), value)


def _sunday(value: Column) -> Column:
    """Days since Sunday."""
    return F.dayofweek(value) - 1


def _ordinal(value: Column) -> Column:
    day = F.dayofmonth(value)
    end = F.when(day.isin(11, 12, 13), "th").when(day % 10 == 1, "st").when(day % 10 == 2, "nd").when(day % 10 == 3, "rd").otherwise("th")
    return F.concat(day.cast("string"), end)


def _monday_week(value: Column) -> Column:
    """Weeks from Monday with most of their days in the year; 0 before the first, no fall back at the end."""
    last = F.weekofyear(F.date_sub(value, 7)) + 1
    return F.when(_iso_year(value) < F.year(value), 0).when(_iso_year(value) > F.year(value), last).otherwise(F.weekofyear(value))


def _window_year(text: Column) -> Column:
    """A year of two digits: 00 to 49 lie in 2000 to 2049, 50 to 99 in 1950 to 1999; longer ones stand."""
    number = text.cast("int")
    return _padded(F.when(F.length(text) > 2, number).when(number < 50, number + 2000).otherwise(number + 1900), 4)


def _seconds(value: Column) -> Column:
    return F.hour(value) * 3600 + F.minute(value) * 60 + F.second(value)


def _clock_text(text: Column) -> Column:
    n = text.cast("int")
    return F.concat_ws(":", _padded(F.floor(n / 3600), 2), _padded(F.floor(n / 60) % 60, 2), _padded(n % 60, 2))


def _julian_text(text: Column) -> Column:
    return F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), text.cast("int") - _JULIAN_OF_1970), "yyyy-MM-dd")


def _year_digits(n: int) -> Made:
    return Made(lambda v: F.right(_padded(F.year(v), 4), F.lit(n)))


_MADE = {
    "RRRR": Made(lambda v: _padded(F.year(v), 4), r"\d{4}|\d{2}", _window_year, "yyyy"),
    "RR": Made(lambda v: F.right(_padded(F.year(v), 4), F.lit(2)), r"\d{2}", _window_year, "yyyy"),
    "IYYY": Made(lambda v: _padded(_iso_year(v), 4)),
    "IW": Made(lambda v: _padded(F.weekofyear(v), 2)),
    "WW": Made(lambda v: _padded(F.floor((F.dayofyear(v) - 1) / 7) + 1, 2)),
    "W": Made(lambda v: (F.floor((F.dayofmonth(v) - 1) / 7) + 1).cast("string")),
    "D": Made(lambda v: F.dayofweek(v).cast("string")),
    "J": Made(lambda v: (F.datediff(v, F.lit("1970-01-01").cast("date")) + _JULIAN_OF_1970).cast("string"), r"\d{1,7}", _julian_text, "yyyy-MM-dd"),
    "SSSSS": Made(lambda v: _padded(_seconds(v), 5), r"\d{5}", _clock_text, "HH:mm:ss"),
    "CC": Made(lambda v: _padded(F.ceil(F.year(v) / 100), 2)),
    "YYY": _year_digits(3),
    "Y": _year_digits(1),
}
_PERCENT_MADE = {
    "%D": Made(_ordinal, r"\d{1,2}[a-z]{2}", lambda t: F.regexp_extract(t, r"^\d+", 0), "d"),
    "%U": Made(lambda v: _padded(F.floor((F.dayofyear(v) + 6 - _sunday(v)) / 7), 2)),
    "%u": Made(lambda v: _padded(_monday_week(v), 2)),
    "%v": Made(lambda v: _padded(F.weekofyear(v), 2)),
    "%x": Made(lambda v: _padded(_iso_year(v), 4)),
    "%w": Made(lambda v: _sunday(v).cast("string")),
}


def _found(name: str, patterns: dict[str, str], made: dict[str, Made]) -> Element:
    return Element(made=made[name]) if name in made else Element(pattern=patterns[name])


def compile_format(fmt: str, dialect: str) -> list[Element]:
    """The elements of a format. Unknown elements raise; other signs, and text in quotes, stand for themselves."""
    if dialect == "mysql":
        pieces = re.findall(r"%.|[^%]+|%$", fmt, re.S)
        known = {**_PERCENT_ELEMENTS, **_PERCENT_MADE}
        for piece in pieces:
            if piece[0] == "%" and piece != "%%" and piece not in known:
                raise ValueError(f"unknown date element {piece!r} in {fmt!r}")
        return [_found(p, _PERCENT_ELEMENTS, _PERCENT_MADE) if p in known else Element(text="%" if p == "%%" else p) for p in pieces]
    net = dialect in ("sqlserver", "sybase")
    patterns, made = (_NET_ELEMENTS, {}) if net else (_ELEMENTS, _MADE)
    names = "|".join(sorted([*patterns, *made], key=len, reverse=True))
    quotes = r"\"[^\"]*\"|'[^']*'" if net else r"\"[^\"]*\""
    elements = []
    for piece in re.findall(rf"{quotes}|{names}|[A-Za-z]+|[^A-Za-z\"']+|.", fmt, 0 if net else re.I | re.S):
        name = piece if net else piece.upper()
        if name in patterns or name in made:
            elements.append(_found(name, patterns, made))
        elif piece[0] in "\"'" and len(piece) > 1:
            elements.append(Element(text=piece[1:-1]))
        elif re.match("[A-Za-z]", piece):
            raise ValueError(f"unknown date element {piece!r} in {fmt!r}")
        else:
            elements.append(Element(text=piece))
    return elements


def _quoted(text: str) -> str:
    """Text of a pattern, with quotes from its first to its last reserved sign."""
    reserved = r"A-Za-z'#{}\[\]"
    before, inner, after = re.fullmatch(rf"([^{reserved}]*)(.*?)([^{reserved}]*)", text, re.S).groups()
    return before + ("'" + inner.replace("'", "''") + "'" if inner else "") + after


def _joined(elements: list[Element]) -> str:
    """A Spark pattern; neighbouring texts are quoted together."""
    pattern, text = "", ""
    for e in [*elements, Element(pattern="")]:
        if e.pattern is None:
            text += e.text or ""
            continue
        pattern, text = pattern + (_quoted(text) if text else "") + e.pattern, ""
    return pattern


def spark_pattern(fmt: str, dialect: str) -> str:
    """A format as a Spark pattern; Java formats are that already. Raises where no pattern can say it."""
    if dialect == "java":
        return fmt
    elements = compile_format(fmt, dialect)
    if any(e.made for e in elements):
        raise ValueError(f"{fmt!r} has no Spark pattern")
    return _joined(elements)


def format_date(value: Column | str, fmt: str, dialect: str = "oracle") -> Column:
    """TO_CHAR, DATE_FORMAT, TO_VARCHAR, FORMAT."""
    value = as_col(value)
    if dialect == "java":
        return F.date_format(value, fmt)
    parts, held = [], []
    for e in [*compile_format(fmt, dialect), None]:
        if e is not None and e.made is None:
            held.append(e)
            continue
        if held:
            parts.append(F.date_format(value, _joined(held)))
            held = []
        if e is not None:
            parts.append(e.made.write(value))
    if not parts:
        return F.when(value.isNotNull(), "")
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def _readable(value: Column, fmt: str, dialect: str) -> tuple[Column, str]:
    """The text and the Spark pattern that reads it."""
    if dialect == "java":
        return value, fmt
    elements = compile_format(fmt, dialect)
    if not any(e.made for e in elements):
        return value, _joined(elements)
    looks = []
    for e in elements:
        if e.made is not None and e.made.looks is None:
            raise ValueError(f"{fmt!r} has an element that does not tell a date")
        if e.text is not None:
            looks.append(re.sub(r"([^A-Za-z0-9\s])", r"\\\1", e.text))
        elif e.made is not None:
            looks.append(e.made.looks)
        else:
            runs = [m.group(0) for m in re.finditer(r"([A-Za-z])\1*|[^A-Za-z]", e.pattern)]
            looks.append("".join(_LOOKS.get(m, rf"\d{{1,{max(len(m), 2)}}}") if m[0].isalpha() else re.escape(m) for m in runs))
    whole = "^" + "".join(f"({x})" for x in looks) + "$"
    parts = [F.regexp_extract(value, whole, i) for i in range(1, len(looks) + 1)]
    text = F.concat(*[p if e.made is None else e.made.reread(p) for e, p in zip(elements, parts, strict=True)])
    # a text of another form is left as it is, for the pattern to refuse
    text = F.when(value.rlike(whole), text).otherwise(value)
    return text, _joined([e if e.made is None else Element(pattern=e.made.pattern) for e in elements])


def parse_date(value: Column | str, fmt: str, dialect: str = "oracle", strict: bool = True) -> Column:
    """TO_DATE, STR_TO_DATE for dates; bad text raises when strict, else gives null."""
    text, pattern = _readable(as_col(value), fmt, dialect)
    return F.to_date(text, pattern) if strict else F.try_to_date(text, pattern)


def parse_timestamp(value: Column | str, fmt: str, dialect: str = "oracle", strict: bool = True) -> Column:
    text, pattern = _readable(as_col(value), fmt, dialect)
    if strict:
        return F.to_timestamp_ntz(text, F.lit(pattern))
    return F.try_to_timestamp(text, F.lit(pattern)).cast("timestamp_ntz")
