"""Articles from stored pages: text, author and publish date."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.functions import dates, elements, markup, people, urls
from newsflow.functions.elements import ELEMENTS, Page
from newsflow.functions.text import bind, blank, collapse_spaces, strip
from newsflow.operators.compute import compute_once, remembered

MIN_TEXT = 100


def visible_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url) and the columns of element tables without scripts, styles and comments; the operators below read these."""
    return elements.with_elements(pages.select("page_id", "url", markup.visible(F.col("html")).alias("html")), "html")


def page_texts(pages: DataFrame) -> DataFrame:
    """(page_id, url, title, text) and the element table of every page."""
    page = Page()
    return compute_once(pages.select("page_id", "url", *ELEMENTS.names), title=markup.page_title(page), text=markup.main_text(page))


def long_enough(texts: DataFrame) -> DataFrame:
    """Drops pages with less than 100 characters of text."""
    return texts.filter(F.length("text") >= MIN_TEXT)


def join_authors(authors: Column) -> Column:
    """A list of authors as one string."""
    return strip(F.array_join(authors, ", "))


_RULES = markup.AUTHOR_RULES + markup.META_AUTHOR_RULES + markup.DATE_RULES


@remembered
def _rule_texts() -> Column:
    return markup.candidates(Page(), _RULES)


def rule_texts(pages: DataFrame) -> DataFrame:
    """Adds ``rule_texts``: what every rule for authors and dates finds on a page, in one evaluation."""
    return pages if "rule_texts" in pages.columns else compute_once(pages, rule_texts=_rule_texts())


def _found_by(texts: Column, rules: tuple[markup.Rule, ...]) -> Column:
    """What some of the rules, that stand together, have found."""
    some = markup.distinct(rules)
    return F.slice(texts, markup.distinct(_RULES).index(some[0]) + 1, len(some))


def byline(texts: Column) -> Column:
    """Author list a page declares in its metadata."""
    declared = F.get(_found_by(texts, markup.META_AUTHOR_RULES), F.lit(0))
    names = F.transform(F.split(declared, ","), strip)
    return F.filter(names, lambda name: name != "")


def park_house_name(author: Column) -> tuple[Column, Column]:
    """(author kept, name parked for later): house names and invalid names are parked."""
    doubtful = people.is_house_name(author) | ~people.is_valid_author(author)
    parked = F.when(~blank(author) & doubtful, author).otherwise(F.lit(""))
    kept = F.when(blank(author) | doubtful, F.lit("")).otherwise(author)
    return kept, parked


def author_candidates(texts: Column) -> Column:
    """What each author rule finds, in rule order."""
    return _found_by(texts, markup.AUTHOR_RULES)


def first_valid_author(candidates: Column) -> Column:
    """The first candidate that is a valid name once tidied, or NULL."""
    present = F.filter(candidates, lambda raw: ~strip(raw).isin("", people.UNKNOWN))
    return F.get(F.filter(F.transform(present, people.tidy_candidate), people.is_valid_author), F.lit(0))


def tail_nodes(page: Page) -> Column:
    """Places of the last paragraphs and aligned blocks of the content areas, last first; of the page if it has no such area.

    A block in two areas, one inside the other, counts in both. Areas are read from the last until there are blocks enough.
    """
    def last(blocks: Column) -> Column:
        return F.reverse(F.slice(blocks, F.greatest(F.size(blocks) - markup.TAIL_NODES + 1, F.lit(1)), F.lit(markup.TAIL_NODES)))

    def closing(blocks: Column) -> Column:
        def add(found: Column, area: Column) -> Column:
            within = bind(elements.end(page, area), lambda stop: last(F.filter(blocks, lambda at: (area < at) & (at < stop))))
            return F.when(F.size(found) >= markup.TAIL_NODES, found).otherwise(F.concat(found, within))

        def read(areas: Column) -> Column:
            found = F.aggregate(F.reverse(areas), F.array().cast("array<int>"), add)
            return F.when(F.size(areas) > 0, F.slice(found, 1, markup.TAIL_NODES)).otherwise(last(blocks))
        return bind(markup.starts(page, *markup.CONTENT_AREAS), read)
    return bind(markup.starts(page, *markup.TAIL_BLOCKS), closing)


def _emphasised(page: Page, bold: Column, start: Column, stop: Column) -> Column:
    """Whether a block holds one of the bold elements or is aligned right."""
    found = F.exists(bold, lambda at: (start < at) & (at < stop))
    for name, mark in markup.TAIL_ALIGNED:
        found = found | F.contains(F.lower(F.coalesce(elements.attribute(page, start, F.lit(name)), F.lit(""))), F.lit(mark))
    return found


def tail_author(page: Page) -> Column:
    """The first author among closing blocks: a named source, else a valid bold or right-aligned text."""
    def read(start: Column, bold: Column) -> Column:
        def within(stop: Column) -> Column:
            text = strip(F.regexp_replace(markup.whole_text(page, start, stop), markup.QUOTES, ""))

            def choose(text: Column) -> Column:
                named = strip(F.regexp_extract(text, "(?iu)" + people.SOURCE_PREFIX, 1))
                return (F.when(~F.length(text).between(2, 100), F.lit(None).cast("string"))
                        .when(people.is_valid_author(named), named)
                        .when(people.is_valid_author(text) & _emphasised(page, bold, start, stop), text))
            return bind(text, choose)
        return bind(elements.end(page, start), within)

    found = bind(markup.starts(page, *markup.TAIL_EMPHASIS), lambda bold: F.filter(
        F.transform(tail_nodes(page), lambda start: read(start, bold)), lambda name: name.isNotNull()))
    return F.get(found, F.lit(0))


def meta_author(texts: Column) -> Column:
    """The first author in page metadata, if it is a valid name."""
    found = F.filter(_found_by(texts, markup.META_AUTHOR_RULES), lambda raw: raw != "")
    return bind(strip(F.get(found, F.lit(0))), lambda name: F.when(people.is_valid_author(name), name))


def last_resort_author(author: Column, parked: Column, from_meta: Column) -> Column:
    """The author, else the parked name, else the metadata name, else ``Unknown``."""
    return F.coalesce(F.nullif(author, F.lit("")), F.nullif(parked, F.lit("")), from_meta, F.lit(people.UNKNOWN))


@remembered
def _page_byline() -> Column:
    return join_authors(byline(F.col("rule_texts")))


@remembered
def _rule_author() -> Column:
    return first_valid_author(author_candidates(F.col("rule_texts")))


@remembered
def _tail_author() -> Column:
    return tail_author(Page())


@remembered
def _page_meta_author() -> Column:
    return meta_author(F.col("rule_texts"))


@remembered
def _page_date() -> Column:
    return dates.first_publish_date(date_candidates(F.col("rule_texts")))


def page_authors(pages: DataFrame) -> DataFrame:
    """Adds ``author``, trying byline, rules, closing blocks, the parked name and metadata in turn."""
    declared = compute_once(rule_texts(pages), _declared=_page_byline())
    kept, parked = park_house_name(F.col("_declared"))
    sorted_out = compute_once(declared, _kept=F.nullif(kept, F.lit("")), _parked=parked)
    by_rule = compute_once(sorted_out, _found=F.coalesce(F.col("_kept"), _rule_author()))
    by_tail = compute_once(by_rule, _closing=F.coalesce(F.col("_found"), _tail_author()), _meta=_page_meta_author())
    return by_tail.withColumn("author", last_resort_author(F.col("_closing"), F.col("_parked"), F.col("_meta"))).drop(
        "_declared", "_kept", "_parked", "_found", "_closing", "_meta")


def date_candidates(texts: Column) -> Column:
    """What each date rule finds, in rule order, without blanks."""
    return F.filter(_found_by(texts, markup.DATE_RULES), lambda raw: strip(raw) != "")


def page_dates(pages: DataFrame) -> DataFrame:
    """Adds ``publish_date`` in the stored form: from the page, else from its address, else ``Unknown``."""
    found = compute_once(rule_texts(pages), _found=_page_date())
    return found.withColumn("publish_date", dates.format_publish_date(
        F.coalesce(F.col("_found"), dates.url_date(F.col("url"))))).drop("_found")


def extract_articles(pages: DataFrame) -> DataFrame:
    """Pages to article items: (title, content, url, source, author, publish_date). One pass, no shuffle."""
    return page_dates(page_authors(long_enough(page_texts(visible_pages(pages))))).select(
        strip(collapse_spaces(F.col("title"))).alias("title"),
        strip(F.col("text")).alias("content"),
        "url",
        urls.netloc(F.col("url")).alias("source"),
        "author",
        "publish_date",
    )
