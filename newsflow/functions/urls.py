"""URL helpers: keys, hosts, resolution and link classes."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Link prefixes that are never followed, article suffixes, and the depth of a category page.
SKIPPED_PREFIXES = ("mailto:", "tel:", "javascript:", "#")
ARTICLE_MARKS = (".html", ".htm", ".amp")
CATEGORY_PARTS = 3

_ORIGIN = r"^([a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*)"
_SCHEME = r"^([a-zA-Z][a-zA-Z0-9+.\-]*:)"


def url_key(url: Column) -> Column:
    """Hex SHA-256 of the URL."""
    return F.sha2(url, 256)


def netloc(url: Column) -> Column:
    """Host and port of an absolute URL, else empty."""
    return F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#]*)", 1)


def domain_of(url: Column) -> Column:
    """The third slash-separated part when ``//`` occurs, else the URL itself."""
    return F.when(F.contains(url, F.lit("//")), F.split_part(url, F.lit("/"), F.lit(3))).otherwise(url)


def _without_dots(path: Column) -> Column:
    """Resolve ``.`` and ``..`` in an absolute path; paths without them pass untouched."""
    parts = F.split(path, "/")
    last = F.get(parts, F.size(parts) - 1)
    kept = F.aggregate(
        F.slice(parts, F.lit(2), F.size(parts)),
        F.array().cast("array<string>"),
        lambda done, part: F.when(part == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
        .when(part == ".", done)
        .otherwise(F.concat(done, F.array(part))),
    )
    tail = F.when(last.isin(".", ".."), F.lit("/")).otherwise(F.lit(""))
    tail = F.when(F.size(kept) == 0, F.lit("")).otherwise(tail)
    joined = F.concat(F.lit("/"), F.array_join(kept, "/"), tail)
    return F.when(F.rlike(path, F.lit(r"/\.\.?(/|$)")), joined).otherwise(path)


def resolve_link(base: Column, link: Column) -> Column:
    """The absolute form of a link found on page ``base``; blanks in front, tabs and line ends do not belong to it."""
    link = F.regexp_replace(F.regexp_replace(link, r"[\t\r\n]", ""), r"^[\x00-\x20]+", "")
    origin = F.regexp_extract(base, _ORIGIN, 1)
    base_path = F.regexp_extract(base, _ORIGIN + r"([^?#]*)", 2)
    folder = F.regexp_extract(base_path, r"^(.*/)[^/]*$", 1)
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    path = F.regexp_extract(link, r"^([^?#]*)", 1)
    rest = F.regexp_extract(link, r"^[^?#]*(.*)$", 1)
    return (
        F.when(link == "", base)
        .when(F.rlike(link, F.lit(_SCHEME)), link)
        .when(F.startswith(link, F.lit("//")), F.concat(F.regexp_extract(base, _SCHEME, 1), link))
        .when(F.startswith(link, F.lit("?")), F.concat(origin, base_path, link))
        .when(F.startswith(link, F.lit("/")), F.concat(origin, _without_dots(path), rest))
        .otherwise(F.concat(origin, _without_dots(F.concat(folder, path)), rest))
    )


def is_skipped(link: Column) -> Column:
    """True for mail, phone, script and fragment links."""
    out = F.startswith(link, F.lit(SKIPPED_PREFIXES[0]))
    for prefix in SKIPPED_PREFIXES[1:]:
        out = out | F.startswith(link, F.lit(prefix))
    return out


def link_kind(url: Column, host: Column) -> Column:
    """``article``, ``category`` or NULL for a link to be dropped."""
    article = F.contains(url, F.lit(ARTICLE_MARKS[0]))
    for mark in ARTICLE_MARKS[1:]:
        article = article | F.contains(url, F.lit(mark))
    below = F.replace(url, F.concat(F.lit("https://"), host), F.lit(""))
    return F.when(article, F.lit("article")).when(
        F.size(F.split(below, "/")) <= CATEGORY_PARTS, F.lit("category"))
