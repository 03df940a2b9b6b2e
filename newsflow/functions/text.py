"""Whitespace handling and text cleaning."""

import functools
import operator
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space, as a pattern class and as a trim set.
SPACE_CLASS = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"
SPACE_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
               "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
# Boilerplate removed from article text, in this order, whatever the case.
JUNK_PATTERNS = (
    r"Chia sẻ bài viết qua email",
    r"Ảnh:.*?\.",
    r"Video:.*?\.",
    r"Độc giả.*?\.",
    r"Bản quyền thuộc về.*",
    r"Hãy gửi câu hỏi về.*",
)

# The literal start of each of these patterns, in lower case.
JUNK_HEADS = tuple(re.match(r"[^.*?\\]+", pattern).group().lower() for pattern in JUNK_PATTERNS)

# Characters stripped from the start of a chunk.
CHUNK_LEAD = ". ,!?\n\t"


def collapse_spaces(text: Column) -> Column:
    """Every run of white space becomes one space."""
    return F.regexp_replace(text, SPACE_CLASS + "+", " ")


def strip(text: Column) -> Column:
    """Remove white space, Unicode included, from both ends."""
    return F.btrim(text, F.lit(SPACE_CHARS))


def bind(value: Column, use) -> Column:
    """Evaluate ``value`` once per row and hand it to ``use``, also inside higher-order functions."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _may_hold_junk(text: Column) -> Column:
    """False only where no boilerplate pattern can match: folding case both ways keeps every match visible."""
    folded = F.lower(F.upper(F.translate(text, "İ", "i")))
    return bind(folded, lambda t: functools.reduce(
        operator.or_, [F.contains(t, F.lit(head)) for head in JUNK_HEADS]))


def _without_junk(text: Column) -> Column:
    for pattern in JUNK_PATTERNS:
        text = F.regexp_replace(text, f"(?iu){pattern}", "")
    return text


def clean_text(text: Column) -> Column:
    """Collapse white space, then delete the boilerplate; NULL becomes empty.

    Six patterns run only over texts in which one of them can match.
    """
    cleaned = bind(collapse_spaces(text), lambda t: F.when(_may_hold_junk(t), _without_junk(t)).otherwise(t))
    return F.coalesce(F.btrim(cleaned), F.lit(""))


def strip_chunk_lead(chunk: Column) -> Column:
    """Drop the punctuation a chunk inherits from the separator it was cut at."""
    return F.ltrim(chunk, F.lit(CHUNK_LEAD))


def blank(text: Column) -> Column:
    """True for NULL and for the empty string."""
    return F.coalesce(text, F.lit("")) == ""


def or_default(text: Column, default) -> Column:
    """The text, or the default when it is NULL or empty."""
    return F.when(~blank(text), text).otherwise(default if isinstance(default, Column) else F.lit(default))
