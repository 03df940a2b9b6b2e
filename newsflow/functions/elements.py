"""Pages as element tables.

One pass over a page cuts it into tags, keeps a stack of open elements, and gives every place (place 0 is the page, each tag is
one more) its name, attributes, the text behind it, the place at which its element ends and the element that owns the text. An element
is the interval from its place to its end, so containment is a comparison. ``places`` leads from a name, a ``.class``
word or an ``[attribute`` to the opening tags that have it, so a selector is a look-up. The cost of a page is linear in its size.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# A tag: a value in quotes may hold a >, a quote that nothing closes is a character like others. Where all > up to the end of the page
# stand in quotes, quotes mean nothing. Both Java and Python read these.
STRICT_TAG = r"""</?[a-zA-Z](?>[^>=]++|=(?>\s*+"[^"]*+"|\s*+'[^']*+')?+)*+>"""
LOOSE_TAG = "</?[a-zA-Z][^>]*+>"
_STRICT = re.compile(STRICT_TAG + "|</?[a-zA-Z]")
_LOOSE = re.compile(LOOSE_TAG)
_NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>][^\s>]*+)))?+""")
_BLANK = re.compile(r"(?i)&(?:nbsp|#160|#xa0);")

# Elements without content; elements that an end tag of others does not cross; what ends a paragraph; what ends its like.
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))
CONTAINERS = frozenset(("article", "aside", "blockquote", "body", "div", "footer", "header", "main", "nav", "ol", "section", "table",
                        "td", "th", "tr", "ul"))
ENDS_PARAGRAPH = CONTAINERS | {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "form", "figure", "hr", "pre"}
_ENDS = {name: frozenset(("p",)) for name in ENDS_PARAGRAPH} | {
    "li": frozenset(("p", "li")), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")), "option": frozenset(("option",)),
    "td": frozenset(("p", "td", "th")), "th": frozenset(("p", "td", "th")), "tr": frozenset(("p", "td", "th", "tr"))}

ELEMENTS = T.StructType([
    T.StructField("tag_names", T.ArrayType(T.StringType())),
    T.StructField("tag_texts", T.ArrayType(T.StringType())),
    T.StructField("tag_attrs", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
    T.StructField("tag_ends", T.ArrayType(T.IntegerType())),
    T.StructField("tag_owners", T.ArrayType(T.IntegerType())),
    T.StructField("tag_places", T.MapType(T.StringType(), T.ArrayType(T.IntegerType())))])
SLICE_BYTES = 1 << 20


def _decoded(text: str) -> str:
    """Character references read once; those to a blank that does not break become plain ones."""
    return references.unescape(_BLANK.sub(" ", text)) if "&" in text else text


def _tags(page: str) -> Iterator[re.Match]:
    """The tags of a page in order. Once a tag does not end outside of quotes, no later one is looked through for that."""
    last = page.rfind(">") + 1
    for token in _STRICT.finditer(page, 0, last):
        if not token.group().endswith(">"):
            yield from _LOOSE.finditer(page, token.start(), last)
            return
        yield token


class _Open:
    """The open elements of a page."""

    def __init__(self) -> None:
        self.places, self.names, self.count = [0], [""], {"": 1}

    def push(self, place: int, name: str) -> None:
        self.places.append(place)
        self.names.append(name)
        self.count[name] = self.count.get(name, 0) + 1

    def find(self, wanted, crossing: bool) -> int:
        """How deep the innermost open element of these names is; 0 if there is none, or none this side of a container."""
        if any(self.count.get(name) for name in wanted):
            for depth in range(len(self.names) - 1, 0, -1):
                if self.names[depth] in wanted:
                    return depth
                if not crossing and self.names[depth] in CONTAINERS:
                    return 0
        return 0

    def close(self, depth: int, ends: list[int], place: int) -> None:
        """End what is open from ``depth`` on at ``place``."""
        for at, name in zip(self.places[depth:], self.names[depth:]):
            ends[at] = place
            self.count[name] -= 1
        del self.places[depth:], self.names[depth:]


def element_table(page: str) -> tuple[list, list, list, list, list, dict]:
    """The columns of the element table of a page."""
    names, texts, attrs, ends, owners = [""], [], [{}], [0], [0]
    places: dict[str, list[int]] = {}
    opened = _Open()
    behind = 0
    for token in _tags(page):
        texts.append(_decoded(page[behind:token.start()]))
        behind = token.end()
        place, tag = len(names), token.group()
        closing = tag[1] == "/"
        found = _NAME.match(tag, 1 + closing)
        name = found.group().lower()
        ends.append(place)
        if closing:
            names.append("/" + name)
            attrs.append({})
            depth = opened.find((name,), name in CONTAINERS)
            if depth:
                opened.close(depth, ends, place)
        else:
            names.append(name)
            held: dict[str, str] = {}
            if "=" in tag:
                for key, *values in _ATTRIBUTE.findall(tag, found.end(), len(tag) - 1):
                    value = next(filter(None, values), "")
                    held.setdefault(key.lower(), _decoded(value))
            attrs.append(held)
            for key in ("*", name, *{"." + word for word in held.get("class", "").split()}, *["[" + key for key in held]):
                places.setdefault(key, []).append(place)
            while name in _ENDS and (depth := opened.find(_ENDS[name], False)):
                opened.close(depth, ends, place)
            if name not in VOID:
                opened.push(place, name)
        owners.append(opened.places[-1])
    texts.append(_decoded(page[behind:]))
    opened.close(0, ends, len(names))
    return names, texts, attrs, ends, owners, places


def _lists(rows: list[list], kind: pa.DataType) -> pa.Array:
    return pa.array(rows, pa.list_(kind))


def _table(pages: list[str]) -> list[pa.Array]:
    names, texts, attrs, ends, owners, places = zip(*map(element_table, pages))
    maps = pa.map_(pa.string(), pa.string())
    return [
        _lists(names, pa.string()), _lists(texts, pa.string()), _lists([[list(x.items()) for x in row] for row in attrs], maps),
        _lists(ends, pa.int32()), _lists(owners, pa.int32()),
        pa.array([list(x.items()) for x in places], pa.map_(pa.string(), pa.list_(pa.int32())))]


def with_elements(pages: DataFrame, html: str) -> DataFrame:
    """``pages`` with the columns of the element table of ``html`` in its place; null is an empty page."""
    kept = [name for name in pages.columns if name != html]
    schema = T.StructType([*[pages.schema[name] for name in kept], *ELEMENTS.fields])
    fields = to_arrow_schema(schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(len(kept))
            first = 0
            while first < batch.num_rows:
                pages, size = [], 0
                while first + len(pages) < batch.num_rows and (not pages or size < SLICE_BYTES):
                    pages.append(column[first + len(pages)].as_py() or "")
                    size += len(pages[-1])
                columns = [*[batch.column(i).slice(first, len(pages)) for i in range(len(kept))], *_table(pages)]
                yield pa.RecordBatch.from_arrays([x.cast(field.type) for x, field in zip(columns, fields)], schema=fields)
                first += len(pages)

    return pages.select(*kept, html).mapInArrow(cut, schema)


class Page:
    """The columns of the element table, where expressions read them."""

    def __init__(self) -> None:
        self.names, self.texts, self.attrs, self.ends, self.owners, self.places = map(F.col, ELEMENTS.names)


def listed(page: Page, key: Column) -> Column:
    """Places of the opening tags with a name, ``.class`` word or ``[attribute``; ``*`` for all."""
    return F.coalesce(F.try_element_at(page.places, key), F.array().cast("array<int>"))


def attribute(page: Page, place: Column, name: Column) -> Column:
    """The value of an attribute of a tag, decoded; NULL without it."""
    return F.try_element_at(F.get(page.attrs, place), name)


def end(page: Page, place: Column) -> Column:
    """The place at which the element that starts at ``place`` ends; its own place without content."""
    return F.get(page.ends, place)


def span(first: Column, last: Column) -> Column:
    """Numbers from ``first`` to ``last``; none if that is less."""
    return F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))


def own_texts(page: Page, place: Column) -> Column:
    """Texts of an element that stand in none of its child elements."""
    held = F.filter(span(place, end(page, place) - 1), lambda at: (F.get(page.owners, at) == place) & (F.get(page.texts, at) != ""))
    return F.transform(held, lambda at: F.get(page.texts, at))


def inside(page: Page, places: Column, around: Column) -> Column:
    """The places that lie in one of the elements starting at ``around``."""
    return F.filter(places, lambda at: F.exists(around, lambda start: (start < at) & (at < end(page, start))))
