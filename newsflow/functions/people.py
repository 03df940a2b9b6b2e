"""Author names: validity, cleaning and splitting."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsflow.functions.text import SPACE_CLASS, strip

UNKNOWN = "Unknown"

# Words that disqualify a name, anywhere in it.
FORBIDDEN_IN_NAME = (
    "thứ hai", "thứ ba", "thứ tư", "thứ năm", "thứ sáu", "thứ bảy", "chủ nhật",
    "ngày", "tháng", "năm", "phút trước", "giờ trước",
    "january", "february", "march", "april", "may", "june", "july", "august",
    "september", "october", "november", "december",
    "ảnh:", "video:", "xem thêm", "bản quyền", "chia sẻ", "liên hệ", "hotline", "sđt", "thông tin", "fax",
    "telephone",
)

# Newsroom names that are parked as a last resort.
HOUSE_NAMES = (
    "vietnamnet news", "vietnamnet", "ban biên tập",
    "giảm nghèo bền vững", "dân trí", "thời sự", "kinh tế", "bnvsba",
)

# How a long name must start, and what may join several names.
LONG_NAME_STARTS = ("theo", "nguồn", "báo", "tạp chí", "đài", "ban", "ủy ban", "sở", "bộ")
NAME_JOINERS = (",", "-", "và", "&")

# Patterns for numbered headings, day/month or clock parts, phone numbers and edge dashes.
HEADING = r"^\d+[\.\-\)]"
DATE_OR_CLOCK = r"\d{1,2}[/-]\d{1,2}|\d{1,2}:\d{1,2}"
PHONE = (r"(?:hotline|liên hệ|sđt|đt)?" + SPACE_CLASS + r"*:?" + SPACE_CLASS + r"*(?:0|\+84)(?:[\d.-]|" + SPACE_CLASS
         + r"){8,12}")
EDGE_DASH = r"^-|-$"
SOURCE_PREFIX = r"(?:Nguồn|Theo|Source)" + SPACE_CLASS + r"*:?" + SPACE_CLASS + r"*(.+)"

# An author string loses its brackets, then all from the word "và", then splits on comma or dash.
BRACKETS = r"\(.*?\)"
AND_WORD = SPACE_CLASS + "+và" + SPACE_CLASS + "+"
NAME_SEPARATOR = ",|" + SPACE_CLASS + "*-" + SPACE_CLASS + "*"


def _any_of(text: Column, words) -> Column:
    """True when one of the words occurs; none of them has a character special to patterns."""
    return F.rlike(text, F.lit("|".join(words)))


def is_valid_author(name: Column) -> Column:
    """True when a string may stand as an author name; NULL counts as not valid."""
    bare = strip(name)
    lower = F.lower(name)
    words = F.size(F.split(bare, SPACE_CLASS + "+"))
    long_but_fine = _any_of(lower, NAME_JOINERS) | F.rlike(
        bare, F.lit("(?iu)^(?:" + "|".join(LONG_NAME_STARTS) + ")"))
    valid = (
        F.length(name).between(2, 100)
        & ~F.rlike(bare, F.lit(HEADING))
        & ~F.rlike(name, F.lit(r"[?!]"))
        & (F.regexp_count(name, F.lit(r"\d")) < 7)
        & ~F.rlike(name, F.lit(DATE_OR_CLOCK))
        & ((words <= 6) | long_but_fine)
        & ~_any_of(lower, FORBIDDEN_IN_NAME)
    )
    return F.coalesce(valid, F.lit(False))


def is_house_name(name: Column) -> Column:
    """True when a newsroom name occurs in the string."""
    return F.coalesce(_any_of(F.lower(name), HOUSE_NAMES), F.lit(False))


def tidy_candidate(raw: Column) -> Column:
    """Cut at the bullet, remove phone numbers and edge dashes."""
    head = strip(F.split_part(raw, F.lit("•"), F.lit(1)))
    no_phone = F.regexp_replace(head, "(?iu)" + PHONE, "")
    return strip(F.regexp_replace(no_phone, EDGE_DASH, ""))


def split_authors(names: Column) -> Column:
    """One author string to an array of names; ``['Unknown']`` when nothing is left."""
    bare = F.regexp_replace(names, BRACKETS, "")
    first = F.get(F.split(bare, "(?iu)" + AND_WORD), F.lit(0))
    parts = F.filter(F.transform(F.split(first, NAME_SEPARATOR), strip), lambda name: name != "")
    return F.when(F.size(parts) > 0, parts).otherwise(F.array(F.lit(UNKNOWN)))
