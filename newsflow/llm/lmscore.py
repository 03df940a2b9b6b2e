"""LM scoring by cross-entropy difference.

Two bigram models, of a target corpus and of the background (all documents), share their smoothing. A document's score is the
mean over its tokens of the target model's loss less the background model's: negative means closer to the target.

Words and bigrams are counted under keys of 63 bits over all texts; no table has a fixed size. Documents are dealt into groups. Every
group packs its distinct keys and their counts by ranges of keys; a range adds up what all groups sent and answers each of them with
the sums of its own keys, in the same order. The group scores its documents with these.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from newsflow.llm.spans import mix, split_words, text_slices, word_keys

# Words that smoothing allows for at least; a corpus that has more of them counts its own.
WORD_CELLS = 1 << 17
CHUNK = 1 << 14
SMOOTHING = 0.1
BACKOFF = 8.0
# Text of a group, and text whose counts meet in a range.
GROUP_BYTES = 16 << 20
RANGE_BYTES = 32 << 20
_START = np.uint64(0x5A17)
_WORD_BIT = np.uint64(1 << 63)


def _cells(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every token: its word's key, its context's, its bigram's; and the bounds of rows. Keys of words are negative, of bigrams not."""
    words = split_words(texts)
    keys = word_keys(words)
    opens = np.zeros(len(keys), dtype=bool)
    opens[words.bounds[:-1][words.count > 0]] = True
    context = np.where(opens, _START, np.roll(keys, 1)) if len(keys) else keys
    pair = mix(keys ^ mix(context))
    return (keys | _WORD_BIT).view(np.int64), (context | _WORD_BIT).view(np.int64), (pair & ~_WORD_BIT).view(np.int64), words.bounds


def _packed(values: np.ndarray) -> bytes:
    """Places in use and their counts, in as few bytes as they need."""
    place = np.flatnonzero(values)
    kind = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if values.max() <= np.iinfo(t).max)
    return b"".join([np.array([np.dtype(kind).itemsize, len(place)], np.int32).tobytes(),
                     place.astype(np.uint16).tobytes(), values[place].astype(kind).tobytes()])


def _unpacked(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    size, n = np.frombuffer(packed, np.int32, 2)
    place = np.frombuffer(packed, np.uint16, n, 8).astype(np.int64)
    return place, np.frombuffer(packed, f"u{size}", n, 8 + 2 * n).astype(np.int64)


def _planes(values: np.ndarray) -> bytes:
    """Numbers byte by byte, all first bytes in front; upper bytes that are 0 throughout are left out."""
    width = (int(values.max(initial=0)).bit_length() + 7) // 8 or 1
    return bytes([width]) + np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _from_planes(packed: bytes) -> np.ndarray:
    width = packed[0]
    flat = np.frombuffer(packed, np.uint8, offset=1).reshape(width, -1)
    out = np.zeros((flat.shape[1], 8), dtype=np.uint8)
    out[:, :width] = flat.T
    return out.view("<u8").ravel()


def _rotated(cells: np.ndarray) -> np.ndarray:
    """Keys whose last bit tells a word, so that ranges of them hold words and bigrams alike."""
    own = cells.view(np.uint64)
    return (own << np.uint64(1)) | (own >> np.uint64(63))


def _cuts(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Where each of the even ranges of 64-bit numbers starts in sorted ``keys``, and their end."""
    firsts = np.array([(i << 64) // ranges for i in range(ranges)], dtype=np.uint64)
    return np.append(np.searchsorted(keys, firsts), len(keys))


@dataclass
class Tokens:
    """Tokens of a group's texts: of every token its row, whether it opens that, and the places of its word and its bigram in ``keys``."""

    keys: np.ndarray
    word: np.ndarray
    pair: np.ndarray
    row: np.ndarray
    opens: np.ndarray

    @classmethod
    def of(cls, texts: pa.Array) -> Tokens:
        words, pairs, rows = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for first, part in text_slices(texts):
            word, _, pair, bounds = _cells(part)
            words.append(_rotated(word))
            pairs.append(_rotated(pair))
            rows.append(first + np.repeat(np.arange(len(part)), np.diff(bounds)))
        row = np.concatenate(rows)
        keys, place = np.unique(np.concatenate(words + pairs), return_inverse=True)
        return cls(keys, place[:len(row)], place[len(row):], row, np.diff(row, prepend=-1) != 0)

    def counts(self, wanted: np.ndarray | None = None) -> np.ndarray:
        """How often each key occurs, in the rows that are wanted."""
        own = slice(None) if wanted is None else wanted[self.row]
        return np.bincount(self.word[own], minlength=len(self.keys)) + np.bincount(self.pair[own], minlength=len(self.keys))

    def losses(self, counts: np.ndarray, total: float, vocabulary: float, rows: int) -> np.ndarray:
        """The sum of losses of each row under a model."""
        single = (counts[self.word] + SMOOTHING) / (total + SMOOTHING * vocabulary)
        pair = counts[self.pair]
        # the start of a text is no word and has no count of its own
        context = np.where(self.opens, pair, counts[np.roll(self.word, 1)])
        return np.bincount(self.row, weights=-np.log((pair + BACKOFF * single) / (context + BACKOFF)), minlength=rows)


def _column(table: pa.Table, place: int) -> pa.Array:
    own = table.column(place).combine_chunks()
    return own if isinstance(own, pa.Array) else pa.concat_arrays(own.chunks)


_REQUEST = T.StructType([
    T.StructField("group", T.LongType()), T.StructField("range", T.IntegerType()), T.StructField("keys", T.BinaryType()),
    T.StructField("background", T.BinaryType()), T.StructField("target", T.BinaryType())])
_ANSWER = T.StructType([
    T.StructField("group", T.LongType()), T.StructField("range", T.IntegerType()), T.StructField("words", T.LongType()),
    T.StructField("background_total", T.LongType()), T.StructField("target_total", T.LongType()),
    T.StructField("background", T.BinaryType()), T.StructField("target", T.BinaryType())])


def _answers(requests: pa.Table) -> pa.Table:
    """Sums of a range for every group's keys, and over the range the number of words, distinct and in all."""
    sides = [[_from_planes(x.as_py()) for x in requests.column(i)] for i in (2, 3, 4)]
    sizes = [len(x) for x in sides[0]]
    keys, place = np.unique(np.concatenate([np.cumsum(x, dtype=np.uint64) for x in sides[0]]), return_inverse=True)
    word = (keys & np.uint64(1)).astype(bool)
    sums = [np.bincount(place, weights=np.concatenate(side), minlength=len(keys)).astype(np.int64) for side in sides[1:]]
    ends = np.cumsum(sizes)
    rows = len(sizes)
    packed = [pa.array([_planes(own[place[end - size:end]]) for size, end in zip(sizes, ends)], pa.binary()) for own in sums]
    repeated = [pa.array([int(n)] * rows, pa.int64()) for n in (word.sum(), *(own[word].sum() for own in sums))]
    return pa.Table.from_arrays([_column(requests, 0), _column(requests, 1), *repeated, *packed], schema=to_arrow_schema(_ANSWER))


def score(documents: DataFrame, good: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, tokens, target_loss, background_loss, score) of every row: means per token and their difference.

    All texts count for the background, those whose id is among ``good`` for the target; without any the target model is the smoothing
    alone. Texts without tokens, null ones too, have 0 in all four. Repeated rows score alike.
    """
    size = documents.agg(F.sum(F.octet_length(text)).alias("size")).first()["size"] or 0
    least = documents.sparkSession.sparkContext.defaultParallelism
    groups, ranges = (max(least, -(-size // each)) for each in (GROUP_BYTES, RANGE_BYTES))
    number = lambda hashed: F.pmod(hashed, F.lit(groups)).alias("group")
    kind = documents.schema[key].dataType
    # rows without an id are in no target and are dealt out by their text
    texts = documents.select(F.col(key).alias("id"), F.col(text).alias("text"), number(
        F.when(F.col(key).isNull(), F.xxhash64(F.col(text))).otherwise(F.xxhash64(F.col(key)))))
    wanted = good.select(F.col(key).cast(kind).alias("id")).filter("id IS NOT NULL").distinct()
    wanted = wanted.select("id", number(F.xxhash64("id")))
    by_group = texts.groupBy("group")

    def ask(docs: pa.Table, ids: pa.Table) -> pa.Table:
        names = to_arrow_schema(_REQUEST)
        if not docs.num_rows:
            return names.empty_table()
        tokens = Tokens.of(_column(docs, 1))
        target = pc.fill_null(pc.is_in(_column(docs, 0), value_set=_column(ids, 0)), False).to_numpy(zero_copy_only=False)
        both = tokens.counts(), tokens.counts(target)
        cuts = _cuts(tokens.keys, ranges)
        parts = [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:])]
        zero = np.zeros(1, np.uint64)
        return pa.Table.from_arrays([
            pa.array([docs.column(2)[0].as_py()] * ranges, pa.int64()), pa.array(range(ranges), pa.int32()),
            pa.array([_planes(np.diff(tokens.keys[x], prepend=zero)) for x in parts], pa.binary()),
            *(pa.array([_planes(own[x]) for x in parts], pa.binary()) for own in both)], schema=names)

    made = T.StructType([
        T.StructField(key, kind), T.StructField("tokens", T.LongType()),
        *(T.StructField(name, T.DoubleType()) for name in ("target_loss", "background_loss", "score"))])

    def add(docs: pa.Table, answers: pa.Table) -> pa.Table:
        names = to_arrow_schema(made)
        if not docs.num_rows:
            return names.empty_table()
        tokens = Tokens.of(_column(docs, 1))
        answers = answers.sort_by("range")
        vocabulary, *totals = (sum(answers.column(i).to_pylist()) for i in (2, 3, 4))
        n = np.bincount(tokens.row, minlength=docs.num_rows)
        means = []
        for place, total in zip((5, 6), totals):
            counts = np.concatenate([_from_planes(x.as_py()) for x in answers.column(place)])
            if len(counts) != len(tokens.keys):
                raise ValueError("the counts are not those of this group's keys")
            sums = tokens.losses(counts.astype(np.float64), total, max(WORD_CELLS, vocabulary), docs.num_rows)
            means.append(np.round(sums / np.maximum(n, 1), 9))
        return pa.Table.from_arrays([_column(docs, 0), pa.array(n, pa.int64()), pa.array(means[1]), pa.array(means[0]),
                                     pa.array(np.round(means[1] - means[0], 9))], schema=names)

    requests = by_group.cogroup(wanted.groupBy("group")).applyInArrow(ask, _REQUEST)
    answers = requests.groupBy("range").applyInArrow(_answers, _ANSWER)
    return by_group.cogroup(answers.groupBy("group")).applyInArrow(add, made)


def op7_lm_scoring(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, tokens, target_loss, background_loss, score for every row; the target is documents labelled as of good quality."""
    return score(documents, labels.filter("quality = 1 AND doc_id IS NOT NULL").select("doc_id"))
