"""Reading HTML: links, titles, texts and selector rules.

Links are cut out of a page by patterns. What needs the structure of a page reads its element table (``elements``): a selector is an
intersection of place lists, a descendant has to start inside its ancestor's interval, and an element's own text is what it owns.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsflow.functions.elements import LOOSE_TAG, STRICT_TAG, Page, attribute, end, inside, listed, own_texts, span
from newsflow.functions.text import bind, collapse_spaces, strip

HIDDEN = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->"
ATTRIBUTE = r"""[^\s"'>/=]+\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>][^\s>]*)"""
REFERENCE = r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]{1,30});"

# Elements that begin a new paragraph of text where they open and where they close.
BLOCKS = ("p", "div", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "br", "blockquote", "section", "header", "footer",
          "table", "tr")
# What windows-1252 has at the numbers that Unicode leaves to control characters; references to these mean the former.
_WESTERN = {point: bytes([point]).decode("cp1252", "ignore") for point in range(0x80, 0xA0)}
_BREAK = "\x01"


def _character(point: Column) -> Column:
    """The character of a code point; U+FFFD for none."""
    western = F.from_json(F.lit(json.dumps({str(point): char for point, char in _WESTERN.items() if char})), "map<string,string>")
    real = ((point > 0) & (point < 0xD800)) | ((point > 0xDFFF) & (point <= 0x10FFFF))
    safe = F.when(real, point).otherwise(F.lit(0xFFFD))
    return F.coalesce(F.when(point.between(0x80, 0x9F), F.try_element_at(western, point.cast("string"))),
                      F.decode(F.unhex(F.lpad(F.hex(safe), 8, "0")), "UTF-32"))


def _named() -> Column:
    """Names of character references and what they stand for."""
    known = {name[:-1]: chars for name, chars in html5.items() if name.endswith(";")}
    return F.from_json(F.lit(json.dumps(known)), "map<string,string>")


def _decoded_part(part: Column) -> Column:
    """What follows an ampersand, with its reference decoded if it is one."""
    def read(name: Column) -> Column:
        number = F.when(F.lower(F.substr(name, F.lit(2), F.lit(1))) == "x", F.conv(F.substr(name, F.lit(3)), 16, 10)).otherwise(
            F.substr(name, F.lit(2))).try_cast("bigint")
        char = F.when(name == "", None).when(F.startswith(name, F.lit("#")), _character(number)).otherwise(
            F.try_element_at(_named(), name))
        char = F.when(char == " ", " ").otherwise(char)
        return F.when(char.isNull(), F.concat(F.lit("&"), part)).otherwise(
            F.concat(char, F.substr(part, F.length(name) + 2)))
    return bind(F.regexp_extract(part, REFERENCE, 1), read)


def decode_entities(text: Column) -> Column:
    """Decode numeric and named character references, once."""
    parts = F.transform(F.split(text, "&", -1), lambda part, i: F.when(i == 0, part).otherwise(_decoded_part(part)))
    return F.when(F.contains(text, F.lit("&")), F.array_join(parts, "")).otherwise(text)


def tidy(text: Column) -> Column:
    """White space collapsed and trimmed."""
    return strip(collapse_spaces(text))


def visible(html: Column) -> Column:
    """The page without scripts, styles and comments, whose content is no markup of the page."""
    return F.regexp_replace(html, HIDDEN, " ")


def hrefs(html: Column) -> Column:
    """All link targets of a visible page in document order."""
    def target(tag: Column) -> Column:
        held = F.filter(_attributes(F.substr(tag, F.lit(3))), lambda each: each["name"] == "href")
        return F.get(held, F.lit(0))["value"]

    # nothing behind the last > is a tag, and patterns would look for its end from every <
    tagged = F.left(html, F.length(html) - F.length(F.substring_index(html, ">", -1)))
    tags = F.regexp_extract_all(tagged, F.lit(f"{STRICT_TAG}|{LOOSE_TAG}"), F.lit(0))
    links = F.filter(tags, lambda tag: F.rlike(tag, F.lit(r"^<[aA][\s/]")))
    found = F.filter(F.transform(links, target), lambda x: x.isNotNull())
    return F.transform(found, decode_entities)


def _attributes(text: Column) -> Column:
    """Names and values, quoted or not, of all attributes in a tag."""
    def read(pair: Column) -> Column:
        def parts(raw: Column) -> Column:
            quoted = F.substr(raw, F.lit(1), F.lit(1)).isin('"', "'")
            value = F.when(quoted, F.substr(raw, F.lit(2), F.length(raw) - 2)).otherwise(raw)
            return F.struct(F.lower(F.regexp_extract(pair, r"^[^\s=]+", 0)).alias("name"), value.alias("value"))
        return bind(F.regexp_extract(pair, r"(?s)=\s*(.*)$", 1), parts)
    return F.transform(F.regexp_extract_all(text, F.lit(ATTRIBUTE), F.lit(0)), read)


def page_title(page: Page) -> Column:
    """Text of the title element; empty without one."""
    return bind(F.get(listed(page, F.lit("title")), F.lit(0)), lambda at: F.coalesce(
        whole_text(page, at, end(page, at)), F.lit("")))


def _paragraphs(page: Page, start: Column) -> Column:
    """Paragraphs of an element, joined by a blank line; NULL without an element or a paragraph."""
    breaks = [*BLOCKS, *["/" + name for name in BLOCKS]]

    def piece(at: Column) -> Column:
        text = F.get(page.texts, at)
        lead = F.when(at == start, "").when(F.get(page.names, at).isin(*breaks), _BREAK).otherwise(" ")
        return F.concat(lead, text)

    raw = F.array_join(F.transform(span(start, end(page, start) - 1), piece), "")
    parts = F.filter(F.transform(F.split(raw, _BREAK, -1), tidy), lambda text: text != "")
    return F.nullif(F.array_join(parts, "\n\n"), F.lit(""))


def main_text(page: Page) -> Column:
    """Paragraphs of the article element, else of the body, else of all, joined by a blank line."""
    first = [F.get(listed(page, F.lit(name)), F.lit(0)) for name in ("article", "body")]
    return F.coalesce(*[bind(at, lambda at: _paragraphs(page, at)) for at in (*first, F.lit(0))], F.lit(""))


def whole_text(page: Page, start: Column, stop: Column) -> Column:
    """All text of an element, its white space collapsed and trimmed."""
    return tidy(F.array_join(F.transform(span(start, stop - 1), lambda at: F.get(page.texts, at)), ""))


_COMPOUND = "struct<keys:array<string>,tests:array<struct<name:string,value:string,part:boolean>>>"


def _compound(text: str) -> dict:
    """``tag``, ``.class``, ``[name="v"]``, ``[name*="v"]``, ``*`` or a mix of these, as look-up keys and tests of values.

    The rarest come first: classes, then attributes, then the name.
    """
    name = re.match(r"[a-zA-Z][a-zA-Z0-9]*", text)
    tests = [{"name": name, "value": value, "part": bool(part)} for name, part, value in re.findall(r'\[([\w-]+)(\*?)="([^"]*)"\]', text)]
    keys = ["." + word for word in re.findall(r"\.([\w-]+)", text.split("[")[0])] + ["[" + test["name"] for test in tests]
    return {"keys": [*keys, *([name.group().lower()] if name else [])] or ["*"], "tests": tests}


def _fitting(page: Page, compound: Column) -> Column:
    """Places of the opening tags that fit a compound, in order."""
    def holds(at: Column) -> Column:
        def held(test: Column) -> Column:
            return bind(F.coalesce(attribute(page, at, test["name"]), F.lit("")), lambda value: F.when(
                test["part"], F.contains(value, test["value"])).otherwise(value == test["value"]))
        return F.forall(compound["tests"], held)

    keys = compound["keys"]
    places = F.aggregate(F.slice(keys, F.lit(2), F.size(keys)), listed(page, F.get(keys, F.lit(0))),
                         lambda found, key: F.array_intersect(found, listed(page, key)))
    return F.filter(places, holds)


def _fitting_one(page: Page, compounds: Column) -> Column:
    """Places of the opening tags that fit one of an array of compounds, in order."""
    found = F.flatten(F.transform(compounds, lambda compound: _fitting(page, compound)))
    return F.when(F.size(compounds) == 1, found).otherwise(F.array_sort(F.array_distinct(found)))


def starts(page: Page, *compounds: str) -> Column:
    """Places of the opening tags that fit one of the compounds, in order."""
    return _fitting_one(page, F.from_json(F.lit(json.dumps([_compound(x) for x in compounds])), f"array<{_COMPOUND}>"))


@dataclass(frozen=True)
class Rule:
    """One selector: ``selector`` ends in ``::text`` or ``::attr(name)``; ``every`` joins all matches by a space."""

    selector: str
    every: bool = False

    def _paths(self) -> tuple[list[list[str]], str]:
        """Element paths of a comma list, and the target they share."""
        parts = [part.rsplit("::", 1) for part in self.selector.split(", ")]
        return [re.findall(r"(?:\[[^\]]*\]|[^\s\[])+", path) for path, _ in parts], parts[0][1]

    def described(self) -> dict:
        """The rule as data: last and first compounds of its paths, the attribute wanted (none: text)."""
        paths, target = self._paths()
        return {"every": self.every, "last": [_compound(path[-1]) for path in paths],
                "first": [_compound(path[0]) for path in paths if len(path) > 1],
                "attribute": "" if target == "text" else target[len("attr("):-1]}


_RULES = f"array<struct<every:boolean,last:array<{_COMPOUND}>,first:array<{_COMPOUND}>,attribute:string>>"


def _found(rule: Column, page: Page) -> Column:
    """The string a rule finds on a page; empty when there is none."""
    def within(around: Column) -> Column:
        # without an ancestor there is no descendant to look for
        return F.when(F.size(around) > 0, inside(page, _fitting_one(page, rule["last"]), around))

    places = F.when(F.size(rule["first"]) == 0, _fitting_one(page, rule["last"])).otherwise(
        F.coalesce(bind(_fitting_one(page, rule["first"]), within), F.array().cast("array<int>")))

    def read(places: Column) -> Column:
        texts = F.flatten(F.transform(places, lambda at: own_texts(page, at)))
        values = F.filter(F.transform(places, lambda at: attribute(page, at, rule["attribute"])), lambda value: value.isNotNull())
        return bind(F.when(rule["attribute"] == "", texts).otherwise(values), lambda found: F.when(
            rule["every"], F.array_join(F.filter(F.transform(found, strip), lambda text: text != ""), " ")).otherwise(
            F.get(found, F.lit(0))))
    return F.coalesce(bind(places, read), F.lit(""))


def candidates(page: Page, rules: tuple[Rule, ...]) -> Column:
    """What each rule finds, in rule order. A rule that occurs again cannot win and is not evaluated twice."""
    once = F.from_json(F.lit(json.dumps([rule.described() for rule in distinct(rules)])), _RULES)
    return F.transform(once, lambda rule: _found(rule, page))


def distinct(rules: tuple[Rule, ...]) -> tuple[Rule, ...]:
    return tuple(dict.fromkeys(rules))


# Where an author name may stand, in the order tried; True joins all matches.
AUTHOR_RULES = tuple(Rule(*entry) for entry in (
    ('a[href*="tac-gia"]::text', True),
    ('a[rel="author"]::text', True),
    (".news-detail-project::text", False),
    (".news-detail-project *::text", True),
    ("div.relative.font-medium::text", False),
    ('[rel="author"]::text', False),
    ('div.name a[href*="tac-gia"]::text', False),
    ('div.name a[href*="tac-gia"]::attr(title)', False),
    ('a[href*="tac-gia"]::text', False),
    ('a[href*="tac-gia"]::attr(title)', False),
    ("span.t1::text, span.t2::text, span.t3::text, span.t4::text, span.t5::text, span.t6::text", False),
    (".author-info .name::text", False),
    (".author-name::text", False),
    (".author-name a::text", False),
    (".author-info .name::text", False),
    (".detail-author::text", False),
    (".tacgia::text", False),
    (".tac-gia::text", False),
    (".post-author::text", False),
    (".article-author::text", False),
    (".author::text", False),
    ('[itemprop="author"] [itemprop="name"]::text', False),
    ('[rel="author"]::text', False),
    ('p[style*="text-align:right"] strong::text', False),
    ('p[style*="text-align: right"] strong::text', False),
    ('div[style*="text-align: right"] strong::text', False),
    ("p.t-a-r strong::text", False),
    ("p.t-a-r b::text", False),
))

# Author names in page metadata.
META_AUTHOR_RULES = (
    Rule('meta[name="author"]::attr(content)'),
    Rule('meta[property="article:author"]::attr(content)'),
)

# Where a publish date may stand, in the order tried.
DATE_RULES = tuple(Rule(selector) for selector in (
    'meta[property="article:published_time"]::attr(content)',
    "time::attr(datetime)",
    "time::text",
    'meta[name="pubdate"]::attr(content)',
    ".publish-date::text",
    ".bread-crumb-detail__time::text",
    ".bread-crumb__detail-time p::text",
    ".bread-crumb__detail-time::text",
    '[data-role="publishdate"]::text',
    ".detail-time div::text",
    ".detail-time::text",
    "span.date::text",
    ".time-now::text",
))

# Where the content of a page stands, which blocks close it, how many are read, and what marks an aligned or bold one.
CONTENT_AREAS = ('div[class*="content"]', "article", 'div[id*="content"]', ".post-body", ".detail-content", ".main-content")
TAIL_BLOCKS = ("p", 'div[class*="author"]', 'div[class*="right"]', 'div[style*="right"]', 'div[align*="right"]')
TAIL_EMPHASIS = ("strong", "b", "em")
TAIL_ALIGNED = (("style", "right"), ("class", "right"), ("align", "right"), ("class", "t-a-r"))
TAIL_NODES = 15
QUOTES = r"[\"“”]"
