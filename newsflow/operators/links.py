"""Links of stored pages and the depth-limited crawl frontier."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.functions import markup, urls
from newsflow.operators.compute import unfold
from newsflow.session import stage


def raw_links(pages: DataFrame) -> DataFrame:
    """Every link target of the visible pages, decoded: (page_id, src_url, position, href), position from 0 in document order."""
    seen = pages.select("page_id", F.col("url").alias("src_url"), markup.visible(F.col("html")).alias("html"))
    return unfold(seen, ["page_id", "src_url"], markup.hrefs(F.col("html")), "position", "href")


def followable_links(links: DataFrame) -> DataFrame:
    """Without mail, phone, script and fragment links."""
    return links.filter(~urls.is_skipped(F.col("href")))


def resolved_links(links: DataFrame) -> DataFrame:
    """Adds ``dst_url``, the absolute target."""
    return links.withColumn("dst_url", urls.resolve_link(F.col("src_url"), F.col("href")))


def same_site_links(links: DataFrame) -> DataFrame:
    """Keeps targets that contain the host of their page."""
    return links.filter(F.contains("dst_url", urls.netloc(F.col("src_url"))))


def classified_links(links: DataFrame) -> DataFrame:
    """Adds ``kind`` (article or category) and drops the rest."""
    kind = urls.link_kind(F.col("dst_url"), urls.netloc(F.col("src_url")))
    return links.withColumn("kind", kind).filter(F.col("kind").isNotNull())


def extract_links(pages: DataFrame) -> DataFrame:
    """All followable links of pages: (page_id, src_url, position, href, dst_url, kind)."""
    return classified_links(same_site_links(resolved_links(followable_links(raw_links(pages)))))


def crawl_frontier(links: DataFrame, seeds: DataFrame, max_depth: int = 5) -> DataFrame:
    """URLs reachable from ``seeds(url)`` within ``max_depth`` links, with first depth and kind.

    Article pages are leaves: only seeds and category pages are expanded. Each level joins the newest
    URLs with the distinct edges, drops what was seen, and is staged, so the plan does not grow.
    """
    edges = stage(links.select("src_url", "dst_url", "kind").distinct(), "edges")
    level = stage(seeds.select("url").distinct().select(
        "url", F.lit(0).alias("depth"), F.lit("seed").alias("kind")), "frontier")
    seen = level
    for depth in range(1, max_depth + 1):
        sources = level.filter(F.col("kind") != "article").select(F.col("url").alias("src_url"))
        fresh = (
            edges.join(sources, "src_url", "left_semi")
            .groupBy(F.col("dst_url").alias("url"))
            .agg(F.lit(depth).alias("depth"), F.max("kind").alias("kind"))
            .join(seen.select("url"), "url", "left_anti")
        )
        level = stage(fresh, "frontier")
        if level.isEmpty():
            break
        seen = seen.unionByName(level)
    return seen
