"""Spelling variants of words by dense prefix-suffix tiling.

Two words are one edit apart if their common prefix and suffix together reach the longer length less one. So at least half of
what the edit leaves alone is a prefix or a suffix of both, and of the rest again: each word is put under eight keys, a
prefix or suffix of half its length and of half the remainder, once as the longer and once as the shorter of a pair, and every
near pair shares a key. The words of a key are a tile: a padded matrix of code points, aligned left and right, in which rows
are compared at every distance. A pair is taken only under the first key that it shares.

Keys with more words than a tile are cut into blocks by hash, and each pair of blocks is a tile, so that no task holds a key whole
and no pair is left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from newsflow.operators.joins import lookup
from newsflow.session import stage

LEAST_LENGTH = 7
LEAST_COUNT = 2
RATIO = 10
TILE_WORDS = 512
TILE_CELLS = 1 << 20
PIECE_CELLS = 2 << 20
LETTERS = "[A-Za-zÀ-ÿ]+"
DROPPED = 31

PAIRS = T.StructType([
    T.StructField("word", T.StringType()), T.StructField("other", T.StringType()), T.StructField("other_n", T.LongType())])
_GROUP = ("size", "kind", "key", "one", "two")


def _halves(size):
    """The sizes of the first and the second piece that near words share, if the longer has ``size`` code points."""
    first = size // 2
    return first, (size - first) // 2


def keyed(words: DataFrame) -> DataFrame:
    """(size, kind, key, word, n): every word under its keys, as the longer word of a pair and as the shorter one."""
    def keys(size: Column) -> Column:
        first = F.floor(size / 2).cast("int")
        second = F.floor((size - first) / 2).cast("int")
        none = F.lit(0)
        pieces = ((first + second, none), (first, second), (second, first), (none, first + second))
        return F.array(*[F.struct(
            size.alias("size"), F.lit(kind).alias("kind"),
            F.xxhash64(size, F.lit(kind), F.left("word", head), F.right("word", tail)).alias("key"))
            for kind, (head, tail) in enumerate(pieces)])

    length = F.length("word")
    return words.select("word", "n", F.inline(F.concat(keys(length), keys(length + 1))))


def tiled(entries: DataFrame) -> DataFrame:
    """Adds ``block``, ``one`` and ``two``: a row per tile that a word is in. A key that fits a tile is the tile (0, 0)."""
    need = F.ceil(F.greatest(F.col("words") / TILE_WORDS, F.col("words") * F.col("longest") / TILE_CELLS)).cast("int")
    counts = entries.groupBy("key").agg(F.count(F.lit(1)).alias("words"), F.max("size").alias("longest"))
    large = stage(counts.select("key", need.alias("blocks")).filter(F.col("blocks") > 1), "tiles")
    met = lookup(entries, large, "key", F.col("word"), "left")
    blocks = F.coalesce(F.col("blocks"), F.lit(1))
    block = F.pmod(F.xxhash64(F.lit(1), "word"), blocks).cast("int")
    dealt = met.select(*entries.columns, block.alias("block"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("with"))
    return dealt.select(*entries.columns, "block", F.least("block", "with").alias("one"), F.greatest("block", "with").alias("two"))


def _matrices(words: list[str], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code points of words, padded at the right and at the left."""
    width = max(int(sizes.max()), 1)
    left = np.array(words, dtype=f"U{width}").view(np.uint32).reshape(len(words), width)
    column = np.arange(width)
    right = np.zeros_like(left)
    right[column >= width - sizes[:, None]] = left[column < sizes[:, None]]
    return left, right


def _same(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Length of the common beginning of the rows of two matrices."""
    unlike = one != two
    return np.where(unlike.any(axis=1), unlike.argmax(axis=1), one.shape[1])


def tile_pairs(words: list[str], sizes: np.ndarray, ends: np.ndarray, longer: np.ndarray, kind: np.ndarray,
               block: np.ndarray, crossed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of near words. ``ends`` has the end of each row's tile, ``longer`` the length of the longer word of a pair there.

    In ``crossed`` tiles only rows of different blocks meet.
    """
    left, right = _matrices(words, sizes)
    mirrored = right[:, ::-1]
    first, second = _halves(longer)
    found_one, found_two = [], []
    rows = np.arange(len(words))
    step = 1
    while True:
        rows = rows[rows + step < ends[rows]]
        if not len(rows):
            break
        for at in range(0, len(rows), max(1, PIECE_CELLS // left.shape[1])):
            one = rows[at:at + max(1, PIECE_CELLS // left.shape[1])]
            two = one + step
            meet = (np.maximum(sizes[one], sizes[two]) == longer[one]) & (~crossed[one] | (block[one] != block[two]))
            one, two = one[meet], two[meet]
            least = np.minimum(sizes[one], sizes[two])
            prefix = np.minimum(_same(left[one], left[two]), least)
            suffix = np.minimum(_same(mirrored[one], mirrored[two]), least)
            h, g = first[one], second[one]
            own = np.select([prefix >= h + g, (prefix >= h) & (suffix >= g), (suffix >= h) & (prefix >= g)], [0, 1, 2], 3)
            near = (prefix + suffix >= longer[one] - 1) & (own == kind[one])
            found_one.append(one[near])
            found_two.append(two[near])
        step += 1
    none = np.empty(0, dtype=np.int64)
    return np.concatenate([none, *found_one]), np.concatenate([none, *found_two])


def near_words(words: DataFrame) -> DataFrame:
    """(word, other, other_n): every two of the distinct ``words`` (word, n) that differ by one code point, both ways round."""
    entries = keyed(words)
    dealt = tiled(entries).repartition("key", "one", "two").sortWithinPartitions(*_GROUP)
    fields = to_arrow_schema(PAIRS)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            held = table.slice(_group_starts(table)[-1])
            yield from _compared(table.slice(0, len(table) - len(held)), fields)
        if held is not None:
            yield from _compared(held, fields)

    return dealt.mapInArrow(compare, PAIRS)


def _group_starts(table: pa.Table) -> np.ndarray:
    new = np.zeros(len(table), dtype=bool)
    new[:1] = True
    for name in _GROUP:
        values = table.column(name).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def _compared(table: pa.Table, fields: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The near words of whole groups, in pieces of bounded size whose words have about the same length."""
    if not len(table):
        return
    starts = _group_starts(table)
    counts = np.diff(np.append(starts, len(table)))
    # words that share a key with none are left out
    shared = np.repeat(counts > 1, counts)
    if not shared.all():
        table = table.filter(pa.array(shared))
        counts = counts[counts > 1]
        starts = np.cumsum(counts) - counts
    longer = table.column("size").to_numpy().astype(np.int64)
    cells = np.cumsum(longer)
    ends = np.append(starts, len(table))
    group = 0
    while group < len(starts):
        done = cells[ends[group] - 1] if group else 0
        last = max(group + 1, int(np.searchsorted(cells[ends[1:] - 1], done + PIECE_CELLS, side="right")))
        # a piece is as wide as its longest word
        while last > group + 1 and longer[ends[last] - 1] > 2 * longer[ends[group]] + 16:
            last = group + max(1, (last - group) // 2)
        yield from _piece(table.slice(ends[group], ends[last] - ends[group]), counts[group:last], fields)
        group = last


def _piece(table: pa.Table, counts: np.ndarray, fields: pa.Schema) -> Iterator[pa.RecordBatch]:
    words = table.column("word").to_pylist()
    column = {name: table.column(name).to_numpy().astype(np.int64) for name in ("n", "size", "kind", "block", "one", "two")}
    sizes = np.array([len(word) for word in words], dtype=np.int64)
    one, two = tile_pairs(words, sizes, np.repeat(np.cumsum(counts), counts), column["size"], column["kind"], column["block"],
                          column["one"] != column["two"])
    if len(one):
        text = table.column("word").combine_chunks()
        here, there = pa.array(np.concatenate([one, two])), np.concatenate([two, one])
        yield pa.RecordBatch.from_arrays([
            text.take(here).cast(fields.field(0).type), text.take(pa.array(there)).cast(fields.field(1).type),
            pa.array(column["n"][there], pa.int64())], schema=fields)


def count_words(words: DataFrame, least: int = LEAST_COUNT, length: int = LEAST_LENGTH) -> DataFrame:
    """(word, n) of the words of at least ``length`` code points that occur ``least`` times; rows are occurrences, nulls do not count."""
    return words.filter(F.length("word") >= length).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)


def spelling_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every row of ``words`` (word, n), whose words are distinct.

    Near words differ by one inserted, deleted or replaced code point. A word's form is its near word of largest n, of equal ones the first by
    code points, if that n is ``ratio`` (more than 1) times its own; else null. Its root is the last word that forms lead to,
    the word itself without one. Null words are dropped, empty ones are near to those of one code point. An empty table gives
    none; words of any length are compared whole, in tiles of at most about ``TILE_CELLS`` code points or two words; other
    columns are not looked at.
    """
    if ratio <= 1:
        raise ValueError("a form has to be more frequent than its word")
    known = stage(words.select("word", F.col("n").cast("bigint").alias("n")).filter(F.col("word").isNotNull()), "words")
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("word")))
    near = near_words(known).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    n = -F.col("best.less")
    chosen = n >= ratio * F.col("n")
    judged = stage(known.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(chosen, F.col("best.word")).alias("form"),
        F.when(chosen, n).alias("form_n")), "forms")
    return judged.join(_roots(judged, ratio), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(judged: DataFrame, ratio: int) -> DataFrame:
    """(word, root) of the words that have a form.

    Each form is ``ratio`` times as frequent as its word, so the greatest count bounds the steps to a root, and each round
    doubles the steps a row has made.
    """
    most = judged.agg(F.max("form_n"), F.min("n")).first()
    reach = judged.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    steps = max(1, int(math.log(max(most[0] or 1, 1) / max(most[1] or 1, 1), ratio) + 1e-9)) if most[0] else 1
    for _ in range(math.ceil(math.log2(steps))):
        ahead = reach.select(F.col("word").alias("root"), F.col("root").alias("further"))
        reach = stage(reach.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")
    return reach


def misspelt_words(documents: DataFrame) -> DataFrame:
    """(word): the words of texts, one row per occurrence, some without a code point as their checksum says.

    Words are runs of letters up to U+00FF with only A-Z lower-cased. A null doc_id counts as an empty one in the checksum.
    """
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = documents.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"),
                            F.explode(F.regexp_extract_all(lower, F.lit(LETTERS), F.lit(0))).alias("run"))
    # shorter ones cannot become words
    checked = runs.filter(F.length("run") >= LEAST_LENGTH).withColumn("checksum", F.crc32(F.concat("doc_id", F.lit(":"), "run")))
    place = F.pmod(F.col("checksum"), F.length("run")).cast("int")
    cut = F.concat(F.left("run", place), F.substr("run", place + 2))
    return checked.select(F.when(F.pmod("checksum", F.lit(DROPPED)) == 0, cut).otherwise(F.col("run")).alias("word"))


def op11_spelling_variants(documents: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n of the words of ``documents``."""
    return spelling_variants(count_words(misspelt_words(documents)))
