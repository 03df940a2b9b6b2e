"""Overlapping chunks of long texts."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.functions.text import strip_chunk_lead
from newsflow.operators.compute import unfold

# Chunk size and overlap in characters, and the separators from coarse to fine.
CHUNK_SIZE = 800
CHUNK_OVERLAP = 150
SEPARATORS = ("\n\n", "\n", ".", " ", "")


def _cuts(text: str, lo: int, hi: int, separator: str) -> list[int]:
    """Piece boundaries of text[lo:hi]; a separator opens the piece that follows it."""
    cuts, at = [lo], text.find(separator, lo, hi)
    while at >= 0:
        if at > lo:
            cuts.append(at)
        at = text.find(separator, at + len(separator), hi)
    cuts.append(hi)
    return cuts


def _pack(cuts: list[int], size: int, overlap: int) -> Iterator[tuple[int, int]]:
    """Greedy windows over adjoining pieces: at most ``size`` long, sharing up to ``overlap`` with the last."""
    first = 0
    for last in range(1, len(cuts)):
        if cuts[last] - cuts[first] > size and last - 1 > first:
            yield cuts[first], cuts[last - 1]
            while first < last - 1 and (cuts[last - 1] - cuts[first] > overlap
                                        or cuts[last] - cuts[first] > size):
                first += 1
    if cuts[-1] > cuts[first]:
        yield cuts[first], cuts[-1]


def _windows(lo: int, hi: int, size: int, overlap: int) -> Iterator[tuple[int, int]]:
    """What packing single characters gives, in closed form."""
    while hi - lo > size:
        yield lo, lo + size
        lo += size - min(overlap, size - 1)
    yield lo, hi


def _spans(text: str, lo: int, hi: int, separators: tuple[str, ...], size: int,
           overlap: int) -> Iterator[tuple[int, int]]:
    """Spans of the chunks of text[lo:hi]."""
    level = next((i for i, s in enumerate(separators) if s == "" or text.find(s, lo, hi) >= 0), None)
    if level is None:
        yield from _pack([lo, hi], size, overlap)
        return
    if separators[level] == "":
        yield from _windows(lo, hi, size, overlap)
        return
    finer = separators[level + 1:]
    cuts = _cuts(text, lo, hi, separators[level])
    run = [cuts[0]]
    for start, end in zip(cuts, cuts[1:]):
        if end - start < size:
            run.append(end)
            continue
        if len(run) > 1:
            yield from _pack(run, size, overlap)
        if finer:
            yield from _spans(text, start, end, finer, size, overlap)
        else:
            yield start, end
        run = [end]
    if len(run) > 1:
        yield from _pack(run, size, overlap)


def split_text(text: str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
               separators: tuple[str, ...] = SEPARATORS) -> list[str]:
    """Chunks of one text, trimmed, without empty ones."""
    if not text:
        return []
    pieces = (text[lo:hi].strip() for lo, hi in _spans(text, 0, len(text), separators, size, overlap))
    return [piece for piece in pieces if piece]


def chunk_array(text: Column, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Column:
    """The chunks of a text column as an array. Texts may be long and go to Python a hundred at a time, not by the Arrow batch."""
    return F.udf(lambda one: split_text(one, size, overlap) if one else [], "array<string>", useArrow=False)(text)


def chunk_text(articles: DataFrame, text: str = "content", size: int = CHUNK_SIZE,
               overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """One row per chunk: ``chunk_index`` from 0 and ``chunk`` replace the text column. No shuffle."""
    keep = [name for name in articles.columns if name != text]
    cut = articles.withColumn("_chunks", chunk_array(F.col(text), size, overlap))
    return unfold(cut, keep, F.col("_chunks"), "chunk_index", "chunk")


def chunk_rows(articles: DataFrame) -> DataFrame:
    """(article_id, chunk_index, content): leading punctuation stripped, empty chunks dropped, index kept."""
    return (
        chunk_text(articles.select("article_id", "content"))
        .select("article_id", "chunk_index", strip_chunk_lead(F.col("chunk")).alias("content"))
        .filter(F.col("content") != "")
    )
