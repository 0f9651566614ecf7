"""Column expressions. All are built-in functions, so they stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The earliest date the target accepts, and the stand-in for a missing date.
EARLIEST_DATE = "1753-01-01"
MISSING_DATE = "1900-01-01"

# Date layouts of the bureau feeds, tried in this order; the first that fits wins.
DATE_LAYOUTS = ["d.M.yyyy", "d.M.yy", "d/M/yyyy", "d-M-yyyy", "yyyy-M-d", "yyyy.M.d"]

TIMESTAMP_LAYOUT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?$"
ZONED_LAYOUT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?(Z|[+-][0-9]{2}:?[0-9]{2})$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nvl_text(c: Column | str, default: str) -> Column:
    """Replace null by a default, counting the empty string as null."""
    return F.coalesce(F.nullif(_col(c).cast("string"), F.lit("")), F.lit(default))


def nvl(c: Column | str, default) -> Column:
    return F.coalesce(_col(c), F.lit(default))


def concat_text(*cs: Column | str) -> Column:
    """Concatenate; a null part counts as empty. Null only when every part is null or empty."""
    parts = [_col(c).cast("string") for c in cs]
    return F.nullif(F.concat_ws("", *parts), F.lit(""))


def decode(c: Column | str, *pairs: tuple, default=None) -> Column:
    """Map values by (search, result) pairs. The selector is compared as text, and null matches null."""
    sel = _col(c).cast("string")
    out = F.lit(default)
    for search, result in reversed(pairs):
        key = F.lit(None if search is None else str(search)).cast("string")
        out = F.when(sel.eqNullSafe(key), F.lit(result)).otherwise(out)
    return out


def clamp_date(c: Column | str) -> Column:
    """Null becomes 1900-01-01 and anything before 1753-01-01 becomes 1753-01-01."""
    c = _col(c).cast("date")
    low = F.lit(EARLIEST_DATE).cast("date")
    return F.when(c.isNull(), F.lit(MISSING_DATE).cast("date")).otherwise(F.greatest(c, low))


def parse_date(c: Column | str) -> Column:
    """Read a date written in any of the known layouts; null when none fits."""
    c = _col(c)
    found = [F.when(c.rlike("^[0-9]{8}$"), F.try_to_date(c, "yyyyMMdd"))]
    for layout in DATE_LAYOUTS:
        d = F.try_to_date(c, layout)
        if layout.endswith(".yy"):
            # two-digit years run from 1969 to 2068
            d = F.when(F.year(d) >= 2069, F.add_months(d, -1200)).otherwise(d)
        found.append(d)
    return F.coalesce(*found)


def parse_day_first(c: Column | str) -> Column:
    return F.try_to_date(_col(c), "dd-MM-yyyy")


def parse_timestamp(c: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` with an optional fraction, a blank or ``T`` between; null when it does not fit.

    A value with a zone is taken to UTC; one without is kept as it is, so the session's zone plays no part. The layout is checked by a pattern and read by the
    native cast, which is much faster than a date formatter.
    """
    c = _col(c)
    fixed = F.regexp_replace(c, "([+-][0-9]{2})([0-9]{2})$", "$1:$2")
    utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), fixed.try_cast("timestamp").cast("timestamp_ntz"))
    return F.when(c.rlike(TIMESTAMP_LAYOUT), c.try_cast("timestamp_ntz")).when(c.rlike(ZONED_LAYOUT), utc)


def pad_code(c: Column | str, width: int = 3) -> Column:
    """Number as text with leading zeros; wider numbers are left whole."""
    s = _col(c).cast("string")
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))


def sub_code(c: Column | str, start: int, length: int) -> Column:
    return F.substring(_col(c).cast("string"), start, length)


def key_from_parts(*cs: Column | str, width: int = 2) -> Column:
    """One number from several codes, each padded to ``width`` digits."""
    return F.concat(*[F.lpad(_col(c).cast("string"), width, "0") for c in cs]).try_cast("bigint")


def status_flag(c: Column | str) -> Column:
    """Null and 0 give 0, above 0 gives 1. Negatives stay; text that is no number gives null (a reject)."""
    n = _col(c).cast("string").try_cast("double")
    return (
        F.when(_col(c).isNull() | (n == 0), F.lit(0))
        .when(n > 0, F.lit(1))
        .otherwise(n)
        .cast("bigint")
    )


def cut_tail(c: Column | str, tail: int = 11) -> Column:
    """Drop a tail of fixed length from text that holds a dot; other text is left alone."""
    s = _col(c).cast("string")
    return F.when(s.contains("."), F.left(s, F.greatest(F.length(s) - tail, F.lit(0)))).otherwise(s)


def floor_div(c: Column | str, by: int) -> Column:
    """Integer division that rounds down, also below zero."""
    c = _col(c)
    return ((c - F.pmod(c, F.lit(by))) / F.lit(by)).cast("bigint")


def keep_prefix(c: Column | str, prefix: str) -> Column:
    return F.when(_col(c).startswith(prefix), _col(c))


def drop_first_word(c: Column | str) -> Column:
    """The words after the first, joined by single blanks; null gives the empty string."""
    words = F.split(F.regexp_replace(_col(c), r"^\s+|\s+$", ""), r"\s+")
    return F.coalesce(F.array_join(F.slice(words, F.lit(2), F.greatest(F.size(words), F.lit(1))), " "), F.lit(""))


def present_flag(c: Column | str) -> Column:
    return _col(c).isNotNull().cast("int")


def poly_bool(c: Column | str) -> Column:
    """A boolean that may arrive as a boolean or as text."""
    return F.lower(_col(c).cast("string")).try_cast("boolean")


def poly_flag(c: Column | str) -> Column:
    """``true``/``false`` or a number as 0/1/number; null gives 0."""
    s = F.lower(_col(c).cast("string"))
    return (
        F.when(s.isNull() | (s == "false"), F.lit(0).cast("bigint"))
        .when(s == "true", F.lit(1).cast("bigint"))
        .otherwise(s.try_cast("double").cast("bigint"))
    )


def number_from_text(c: Column | str) -> Column:
    """Number from text that may carry thousands separators."""
    return F.replace(_col(c).cast("string"), F.lit(","), F.lit("")).try_cast("bigint")


def month_stamp(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyy'M'MM")


def minute_stamp(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyy-MM-dd HH:mm")


def shift_hours(c: Column | str, hours: int) -> Column:
    return _col(c) + F.make_dt_interval(hours=F.lit(hours))
