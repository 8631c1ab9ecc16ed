"""Scalar expressions: null dialects, text, dates, durations, numbers, labels and paths."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Tokens that the list dialect and the data-frame dialect read as null.
NULL_LIST = ("", "NA", "null", "NULL", "None")
FRAME_NULLS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def blank(c: Column) -> Column:
    """Raw dialect: null, empty or only white space."""
    return F.coalesce(F.trim(c.cast("string")), F.lit("")) == ""


def null_by_list(c: Column) -> Column:
    return c.isNull() | c.cast("string").isin(*NULL_LIST)


def null_by_frame(c: Column) -> Column:
    return c.isNull() | c.cast("string").isin(*FRAME_NULLS)


def invalid_concept(c: Column) -> Column:
    """Blank, or exactly 0 once trimmed; 0.0 and 00 pass."""
    return F.coalesce(F.trim(c.cast("string")), F.lit("")).isin("", "0")


def to_long(c: Column) -> Column:
    """Integer ids, also where they carry a fraction of zero."""
    return c.try_cast("double").try_cast("long")


def to_double(c: Column) -> Column:
    return c.try_cast("double")


def finite(c: Column) -> Column:
    """A value that is there, a number, and finite."""
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))


def text_key(*cols: Column) -> Column:
    """Columns joined by a bar, for display; nulls are empty."""
    return F.concat_ws("|", *(F.coalesce(c.cast("string"), F.lit("")) for c in cols))


def strip_fraction(c: Column) -> Column:
    """Drop fractional seconds."""
    return F.regexp_replace(c, r"(\d{2}:\d{2}:\d{2})\.\d+", "$1")


#: Accepted layouts in the order they are tried; those of day precision stay dates.
DATE_FORMATS = (
    ("yyyy-MM-dd HH:mm:ss", r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"),
    ("yyyy-MM-dd", r"^\d{4}-\d{2}-\d{2}$"),
    ("yyyy-MM-dd HH:mm", r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}$"),
    ("yyyy/MM/dd HH:mm:ss", r"^\d{4}/\d{2}/\d{2} \d{2}:\d{2}:\d{2}$"),
    ("yyyy/MM/dd", r"^\d{4}/\d{2}/\d{2}$"),
    ("MM/dd/yyyy HH:mm:ss", r"^\d{2}/\d{2}/\d{4} \d{2}:\d{2}:\d{2}$"),
    ("MM/dd/yyyy", r"^\d{2}/\d{2}/\d{4}$"),
)


def normalise_date(c: Column, name: str = "") -> Column:
    """ISO text of a date or datetime in any accepted layout; what cannot be parsed stays as it is.

    A name that ends in _date or _datetime first tries that layout without padding, as lenient parsers do."""
    plain = strip_fraction(F.trim(c))
    tried = []
    if name.endswith("_datetime"):
        tried.append(F.date_format(F.try_to_timestamp(F.when(plain.rlike(r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"), plain), F.lit("yyyy-M-d H:m:s")), "yyyy-MM-dd HH:mm:ss"))
    elif name.endswith("_date"):
        tried.append(F.date_format(F.try_to_timestamp(F.when(plain.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), plain), F.lit("yyyy-M-d")), "yyyy-MM-dd"))
    for layout, shape in DATE_FORMATS:
        out = "yyyy-MM-dd HH:mm:ss" if "HH" in layout else "yyyy-MM-dd"
        tried.append(F.date_format(F.try_to_timestamp(F.when(plain.rlike(shape), plain), F.lit(layout)), out))
    return F.coalesce(*tried, c)


def elapsed(start: Column, end: Column, unit: str) -> Column:
    """Signed time between timestamps in minutes or hours (fractions kept) or whole days (rounded down)."""
    micros = F.timestamp_diff("MICROSECOND", start, end)
    if unit == "days":
        return F.floor(micros / F.lit(86_400_000_000)).cast("long")
    return micros / F.lit({"minutes": 6e7, "hours": 3.6e9}[unit])


def percent(part: Column, whole: Column) -> Column:
    """100 part / whole, 0 where there is nothing."""
    return F.when(whole > 0, 100.0 * part / whole).otherwise(F.lit(0.0))


def labelled(code: Column, labels: Mapping[int, str]) -> Column:
    """The label of a code, or Other(code)."""
    out = F.when(code.isNull(), F.lit(None).cast("string"))
    for k, v in labels.items():
        out = out.when(code == k, F.lit(v))
    return out.otherwise(F.format_string("Other(%s)", code.cast("string")))


def binned(value: Column, edges: Sequence[float], right: bool = False) -> Column:
    """Label of the bin a value lies in: [a, b), or (a, b] with right; null outside. The last bin of [a, b) takes its end."""
    out = F.when(F.lit(False), F.lit(""))
    for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        inside = (value > a) & (value <= b) if right else (value >= a) & ((value <= b) if k == len(edges) - 2 else (value < b))
        out = out.when(inside, F.lit(f"{a}-{b}"))
    return out


def convert_units(concept: Column, unit: Column | None, value: Column, conversions: Sequence[tuple], gate: bool = True) -> Column:
    """Values in the unit that a concept is kept in.

    Gated, a conversion applies where the row's unit is its source; otherwise all of a concept's conversions apply in turn."""
    if gate:
        out = value
        for c, source, _, factor, offset in conversions:
            out = F.when((concept == c) & (F.lower(unit) == source.lower()), (value + offset) * factor).otherwise(out)
        return out
    out = value
    for c, _, _, factor, offset in conversions:
        out = F.when(concept == c, (out + offset) * factor).otherwise(out)
    return out


def partition_path(person: Column, split_prefix: str = "600000071", width: int = 1000) -> tuple[Column, Column]:
    """Folder of a person: the first nine characters, and for one prefix the thousand that the last six digits lie in."""
    prefix = F.substring(person, 1, 9)
    low = (F.floor(F.substring(person, -6, 6).try_cast("long") / width) * width).cast("long")
    bucket = F.when(prefix == split_prefix, F.format_string("%06d-%06d", low, low + (width - 1)))
    return prefix, bucket


def min_max(value: Column, low: Column, high: Column) -> Column:
    return F.when(high > low, (value - low) / (high - low)).otherwise(F.lit(0.0))


def strip_ansi(c: Column) -> Column:
    """A log line without terminal colours and other escape sequences."""
    return F.regexp_replace(c, "\\x1B(?:\\[[0-?]*[ -/]*[@-~]|[@-Z\\\\^_])", "")
