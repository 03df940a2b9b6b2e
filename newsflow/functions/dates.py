"""Publish dates: reading candidates, strict parsing, formatting and epochs."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsflow.functions.text import bind, collapse_spaces, strip

# The four date shapes, tried in this order, and which group holds which part.
DATE_SHAPES = (
    (r"(\d{4})-(\d{1,2})-(\d{1,2})(?:T|\s+)(\d{1,2}):(\d{1,2})", {"y": 1, "m": 2, "d": 3, "h": 4, "mi": 5}),
    (r"(\d{1,2})[/-](\d{1,2})[/-](\d{4}).*?(\d{1,2}):(\d{1,2})", {"d": 1, "m": 2, "y": 3, "h": 4, "mi": 5}),
    (r"(\d{1,2}):(\d{1,2}).*?(\d{1,2})[/-](\d{1,2})[/-](\d{4})", {"h": 1, "mi": 2, "d": 3, "m": 4, "y": 5}),
    (r"(\d{1,2})[/-](\d{1,2})[/-](\d{4})", {"d": 1, "m": 2, "y": 3}),
)

# The strict stored form, with the one-digit fields a lenient reader also takes.
STORED_FORM = (r"^(\d{4})-(1[0-2]|0?[1-9])-(3[01]|[12]\d|0?[1-9]| [1-9])\s+(2[0-3]|[01]?\d):([0-5]?\d):([0-5]?\d)\z")
URL_DAY = r"/((?:19|20)\d{2})[/_.-](1[0-2]|0?[1-9])[/_.-](3[01]|[12]\d|0?[1-9])(?:[/_.-]|$)"
STORED_FORMAT = "yyyy-MM-dd HH:mm:ss"
UNKNOWN = "Unknown"


def _moment(year: Column, month: Column, day: Column, hour: Column, minute: Column, second: Column) -> Column:
    """A zone-free timestamp, NULL when no such moment exists."""
    return F.when(year > 0, F.try_make_timestamp_ntz(year, month, day, hour, minute, second))


def parse_publish_date(raw: Column) -> Column:
    """Read one candidate. The first shape that fits decides, even if its date is impossible (NULL)."""
    text = strip(collapse_spaces(raw))

    def read(shape: str, groups: dict) -> Column:
        found = F.regexp_extract(text, shape, 0)

        def part(name: str) -> Column:
            if name not in groups:
                return F.lit(0)
            return F.regexp_extract(found, shape, groups[name]).try_cast("int")

        return _moment(part("y"), part("m"), part("d"), part("h"), part("mi"), F.lit(0))

    out = None
    for shape, groups in DATE_SHAPES:
        fits = F.rlike(text, F.lit(shape))
        value = read(shape, groups)
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out


def first_publish_date(candidates: Column) -> Column:
    """The first candidate of an array that reads as a date."""
    return F.get(F.filter(F.transform(candidates, parse_publish_date), lambda ts: ts.isNotNull()), F.lit(0))


def url_date(url: Column) -> Column:
    """The day in the path of an address, as in ``/2024/05/17/``; NULL without one."""
    return bind(F.regexp_extract(url, URL_DAY, 0), lambda found: _moment(
        *[F.regexp_extract(found, URL_DAY, group).try_cast("int") for group in (1, 2, 3)],
        F.lit(0), F.lit(0), F.lit(0)))


def stored_timestamp(text: Column) -> Column:
    """Strictly parse the stored form; anything else is NULL."""
    def part(group: int) -> Column:
        return F.regexp_extract(text, STORED_FORM, group).try_cast("int")

    return F.when(F.rlike(text, F.lit(STORED_FORM)),
                  _moment(part(1), part(2), part(3), part(4), part(5), part(6)))


def format_publish_date(moment: Column) -> Column:
    """The stored form, or ``Unknown``."""
    return F.coalesce(F.date_format(moment, STORED_FORMAT), F.lit(UNKNOWN))


def epoch_seconds(date: Column) -> Column:
    """Seconds since 1970 at UTC midnight of a date; 0 when there is none."""
    return F.coalesce(F.unix_date(date).cast("bigint") * F.lit(86400), F.lit(0).cast("bigint"))
