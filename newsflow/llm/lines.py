"""Line dedup by site-relative frequency, in DataFrame functions only.

Pages are grouped by host; the pages of a host that contain a line, divided by the pages of that host, is the line's ratio, and
lines above a ratio are boilerplate of that host and dropped from its pages. A page that is served several times with
the same text counts once, so that copies of a page do not make its text boilerplate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.llm.batches import fresh
from newsflow.operators.joins import lookup
from newsflow.session import stage

RATIO = 0.01
LEAST_PAGES = 3


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r"))


def _line_key(line: Column) -> Column:
    """96 bits of a line without the blanks around it."""
    bare = _bare(line)
    return F.struct(F.xxhash64(bare).alias("a"), F.hash(bare).alias("b"))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _host_key(host: Column) -> Column:
    """Never null: no host is a host of its own."""
    return F.coalesce(F.concat(F.lit("+"), host.cast("string")), F.lit("-"))


def boilerplate(pages: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO,
                least: int = LEAST_PAGES) -> DataFrame:
    """(host_key, line_keys): per host the keys of its lines that are on ``least`` pages and on more than ``ratio`` of all.

    A host's array has at most (mean lines of a page / ratio) keys.
    """
    known = pages.filter(F.col(text).isNotNull()).select(
        _host_key(F.col(host)).alias("host_key"), F.xxhash64(text).alias("page"), F.col(text).alias("text"))
    total = known.select("host_key", "page").distinct().groupBy("host_key").agg(F.count(F.lit(1)).alias("pages"))
    real = F.filter(_lines(F.col("text")), lambda x: _bare(x) != "")
    keys = F.array_distinct(F.transform(real, _line_key))
    each = known.select("host_key", "page", F.explode(keys).alias("line_key"))
    counted = each.distinct().groupBy("host_key", "line_key").agg(F.count(F.lit(1)).alias("n"))
    often = counted.filter(F.col("n") >= least).join(total, "host_key").filter(F.col("n") > F.col("pages") * ratio)
    return often.groupBy("host_key").agg(F.collect_list("line_key").alias("line_keys"))


def drop_boilerplate(pages: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO,
                     least: int = LEAST_PAGES, counts: bool = False) -> DataFrame:
    """``pages`` without the boilerplate lines of their hosts; all rows and columns stay.

    Lines end at line feeds and are compared without blanks around them; empty lines are never dropped. Null text stays
    null and counts for no host; a null host is one host; a page all of whose lines go has an empty text. Repeated rows
    are treated alike. ``counts`` adds ``n_lines`` and ``dropped_lines`` (0 for null text).
    """
    key, listed = fresh(pages, "host_key"), fresh(pages, "line_keys")
    known = stage(boilerplate(pages, host, text, ratio, least), "boilerplate").select(
        F.col("host_key").alias(key), F.col("line_keys").alias(listed))
    joined = lookup(pages.withColumn(key, _host_key(F.col(host))), known, key, F.col(text), "left")
    lines = _lines(F.col(text))
    kept = F.filter(lines, lambda x: (_bare(x) == "") | ~F.array_contains(F.col(listed), _line_key(x)))
    clean = F.when(F.col(listed).isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))
    if not counts:
        return joined.withColumn(text, clean).select(*pages.columns)
    before = F.when(F.col(text).isNull(), 0).otherwise(F.size(_lines(F.col(text))))
    # a page that loses all its lines has none left, not an empty one
    after = F.when(F.col(text).isNull(), 0).when(F.col(listed).isNull(), before).otherwise(F.size(kept))
    return joined.select(
        *[c for c in pages.columns if c != text], clean.alias(text), before.alias("n_lines"),
        (before - after).alias("dropped_lines"))


def op5_line_dedup(documents: DataFrame) -> DataFrame:
    """doc_id, source, n_lines, dropped_lines and the text that is left, for every row of ``documents``."""
    return drop_boilerplate(documents.select("doc_id", "source", "text"), counts=True)


OP5_SQL = f"""
WITH lines AS (
  SELECT DISTINCT coalesce('+' || source, '-') AS host, text, trim(line, chr(32) || chr(9) || chr(13)) AS line
  FROM (SELECT source, text, unnest(string_split(text, chr(10))) AS line FROM documents)
), pages AS (
  SELECT coalesce('+' || source, '-') AS host, count(DISTINCT text) AS pages FROM documents GROUP BY ALL
), often AS (
  SELECT l.host, l.line FROM lines l JOIN pages p ON p.host = l.host WHERE l.line <> ''
  GROUP BY l.host, l.line, p.pages HAVING count(*) >= {LEAST_PAGES} AND count(*) > p.pages * {RATIO}::DOUBLE
), listed AS (
  SELECT host, list(line) AS bad FROM often GROUP BY host
), cut AS (
  SELECT d.doc_id, d.source, string_split(d.text, chr(10)) AS parts,
         list_filter(string_split(d.text, chr(10)),
                     lambda x: NOT list_contains(coalesce(l.bad, []), trim(x, chr(32) || chr(9) || chr(13)))) AS kept
  FROM documents d LEFT JOIN listed l ON l.host = coalesce('+' || d.source, '-')
)
SELECT doc_id, source, CASE WHEN parts IS NULL THEN NULL ELSE coalesce(array_to_string(kept, chr(10)), '') END AS text,
       coalesce(len(parts), 0)::INTEGER AS n_lines, coalesce(len(parts) - len(kept), 0)::INTEGER AS dropped_lines
FROM cut
"""
