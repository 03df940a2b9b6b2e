"""Quality classifier: regularised quadratic discriminant over document statistics.

Each class has a mean and a covariance of transformed statistics, shrunk towards its diagonal; the score is the difference
of the two Gaussian log densities, with Mahalanobis distances from Cholesky factors that are made once and kept in the model.
Statistics are taken from whole texts; only moments of a bounded sample of labelled rows reach the driver.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow.llm.batches import fresh, hash_share, over_batches, small_batches
from newsflow.llm.spans import Words, mix, raw_bytes, split_words, text_slices, word_keys

SAMPLE_PER_CLASS = 20_000
SHRINKAGE = 0.1
FLOOR = 1e-3
THRESHOLD = 0.3
STATISTICS = (
    "word_length", "digit_share", "upper_share", "stop_share", "symbol_share", "other_sign_share", "signs_per_word",
    "repeated_words", "repeated_lines", "line_words", "packing",
)


# Classes of bytes: the rest is 0 (other signs).
_BLANK, _LETTER, _UPPER, _DIGIT, _STOP, _SYMBOL = range(1, 7)
_CLASSES = np.zeros(256, dtype=np.uint8)
for _bytes, _class in (
    (b" \t\n\v\f\r", _BLANK), (bytes(range(97, 123)) + bytes(range(128, 256)), _LETTER), (bytes(range(65, 91)), _UPPER),
    (b"0123456789", _DIGIT), (b".,;:?'\"-()", _STOP), (b"#$%&*@^~|<>=+_\\{}[]/", _SYMBOL),
):
    _CLASSES[np.frombuffer(_bytes, dtype=np.uint8)] = _class


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of the values of each row; 0 for rows without any."""
    out = np.zeros(len(offsets) - 1)
    full = np.diff(offsets) > 0
    if full.any():
        out[full] = np.add.reduceat(values, offsets[:-1][full], dtype=np.int64)
    return out


def _towards(total: np.ndarray, of: np.ndarray, usual: float, weight: float) -> np.ndarray:
    """total / of, drawn to its usual value by ``weight`` units of evidence: short texts say little."""
    return (total + usual * weight) / (of + weight)


def _repeated(keys: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Number of a row's keys that have come before in the same row."""
    order = np.lexsort((keys, row))
    again = np.zeros(len(keys), dtype=bool)
    again[1:] = (keys[order][1:] == keys[order][:-1]) & (row[order][1:] == row[order][:-1])
    return np.bincount(row[order][again], minlength=rows)


def _line_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Non-empty lines, as spans."""
    text = data != ord("\n")
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets] = True
    before = np.concatenate([[False], text[:-1]]) if len(text) else text
    after = np.concatenate([text[1:], [False]]) if len(text) else text
    start = np.flatnonzero(text & (~before | first[:-1]))
    end = np.flatnonzero(text & (~after | first[1:])) + 1
    return Words(data, start, end, np.searchsorted(start, offsets))


def _line_keys(lines: Words, words: Words, keys: np.ndarray) -> np.ndarray:
    """A key per line, of its words and their order."""
    line = np.searchsorted(lines.start, words.start, side="right") - 1
    first = np.searchsorted(words.start, lines.start)
    place = (np.arange(len(line)) - first[line]).astype(np.uint64) if len(line) else np.empty(0, np.uint64)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(keys + place))])
    return total[np.searchsorted(words.start, lines.end)] - total[first]


def _statistics(texts: pa.Array) -> np.ndarray:
    """One row of ``STATISTICS`` per text of a null-free array."""
    data, offsets = raw_bytes(texts)
    rows = len(offsets) - 1
    words = split_words(texts, lower=False)
    count = words.count
    keys = word_keys(words)
    lines = _line_words(data, offsets)
    line_keys = _line_keys(lines, words, keys)
    classes = _CLASSES[data]
    stop, symbol, other, digit, upper = (
        _sums(classes == kind, offsets) for kind in (_STOP, _SYMBOL, 0, _DIGIT, _UPPER))
    size = np.diff(offsets)
    packed = np.array([len(zlib.compress(data[a:b].tobytes(), 1)) - 11.0 for a, b in zip(offsets[:-1], offsets[1:])])
    total = np.concatenate([[0], np.cumsum(words.end - words.start)])
    letters = np.diff(total[words.bounds])
    root = np.sqrt
    return np.column_stack([
        np.log(_towards(letters, count, 6, 10)),
        root(_towards(digit, size, 0.001, 60)),
        root(_towards(upper, size, 0.02, 60)),
        root(_towards(stop, size, 0.02, 60)),
        root(_towards(symbol, size, 0.001, 60)),
        root(_towards(other, size, 0.001, 60)),
        np.log(_towards(stop + symbol + other, count, 0.15, 10)),
        root(_towards(_repeated(keys, words.row, rows), count, 0.1, 20)),
        root(_towards(_repeated(line_keys, lines.row, rows), lines.count, 0.0, 5)),
        np.log(_towards(count, lines.count, 15, 2)),
        _towards(packed, size, 0.5, 120),
    ])


def statistics(texts: pa.Array) -> np.ndarray:
    """``STATISTICS`` of every text; null counts as empty."""
    parts = [_statistics(part) for _, part in text_slices(texts)]
    return np.concatenate(parts) if parts else np.empty((0, len(STATISTICS)))


@dataclass
class Discriminant:
    """Per class: mean, Cholesky factor of the shrunk covariance, half its log determinant, log prior."""

    means: list[np.ndarray]
    factors: list[np.ndarray]
    half_dets: list[float]
    priors: list[float]

    def log_density(self, values: np.ndarray, kind: int) -> np.ndarray:
        away = np.linalg.solve(self.factors[kind], (values - self.means[kind]).T)
        return self.priors[kind] - self.half_dets[kind] - 0.5 * (away * away).sum(axis=0)

    def score(self, values: np.ndarray) -> np.ndarray:
        """Probability of class 1."""
        gap = np.clip(self.log_density(values, 1) - self.log_density(values, 0), -500, 500)
        return np.round(1 / (1 + np.exp(-gap)), 9)


def _moments(sample: DataFrame, text: str, label: str) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Count, sum and sum of products of the statistics per label: tasks add up theirs, the driver reads one row each."""
    width = len(STATISTICS)
    schema = T.StructType([T.StructField("label", T.IntegerType()), T.StructField("sums", T.ArrayType(T.DoubleType()))])

    def sums(batch: pa.RecordBatch) -> dict:
        values = statistics(batch.column(0))
        labels = batch.column(1).to_numpy(zero_copy_only=False)
        rows = {"label": [], "sums": []}
        for kind in (0, 1):
            own = values[labels == kind]
            if len(own):
                rows["label"].append(kind)
                rows["sums"].append(np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()]).tolist())
        return rows

    parts = over_batches(sample.select(F.col(text), F.col(label).cast("int")), sums, schema)
    whole = parts.select("label", F.posexplode("sums").alias("place", "value")).groupBy("label", "place").agg(
        F.sum("value").alias("value"))
    found: dict[int, np.ndarray] = {}
    for row in whole.collect():
        found.setdefault(row["label"], np.zeros(1 + width + width * width))[row["place"]] = row["value"]
    return {k: (v[0], v[1:1 + width], v[1 + width:].reshape(width, width)) for k, v in found.items()}


def train(documents: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text", key: str = "doc_id",
          per_class: int = SAMPLE_PER_CLASS, shrinkage: float = SHRINKAGE) -> Discriminant | None:
    """Fit on ``labels`` (key, label 0 or 1) of ``documents`` (key, text); None if a class has fewer than two rows.

    At most about ``per_class`` rows of each label are read, chosen by a hash of the key; priors come from all
    labelled rows. Rows with a null key, label or another label value are not used; of several labels of one key the
    greatest counts.
    """
    spark = documents.sparkSession
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).filter(
        "key IS NOT NULL AND label IN (0, 1)")
    counts = {row["label"]: row["count"] for row in known.groupBy("label").count().collect()}
    if len(counts) < 2:
        return None
    share = F.when(F.col("label") == 1, F.lit(min(1.0, per_class / counts[1]))).otherwise(
        F.lit(min(1.0, per_class / counts[0])))
    sample = known.filter(hash_share("key") < share).groupBy("key").agg(F.max("label").alias("label"))
    small_batches(spark)
    # the sample's size is bounded by ``per_class``, so it may be broadcast
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(sample), "key")
    moments = _moments(rows, "text", "label")
    if any(moments.get(kind, (0,))[0] < 2 for kind in (0, 1)):
        return None
    made = Discriminant([], [], [], [])
    for kind in (0, 1):
        n, total, products = moments[kind]
        mean = total / n
        cov = products / n - np.outer(mean, mean)
        cov = (1 - shrinkage) * cov + shrinkage * np.diag(np.diag(cov)) + FLOOR * np.eye(len(mean))
        factor = np.linalg.cholesky(cov)
        made.means.append(mean)
        made.factors.append(factor)
        made.half_dets.append(float(np.log(np.diag(factor)).sum()))
        made.priors.append(float(np.log(counts[kind] / sum(counts.values()))))
    return made


def score(documents: DataFrame, model: Discriminant | None, text: str = "text", column: str = "score") -> DataFrame:
    """``documents`` with the probability of label 1 as ``column``, as a row of its own for every row.

    Null texts are scored as empty ones. Without a model (no labels of both kinds) every score is 1. A column of the
    same name is replaced.
    """
    kept = documents.drop(column)
    if model is None:
        return kept.withColumn(column, F.lit(1.0))
    small_batches(documents.sparkSession)
    schema = T.StructType([*kept.schema.fields, T.StructField(column, T.DoubleType())])
    place = kept.columns.index(text)

    def add(batch: pa.RecordBatch) -> dict:
        made = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        return made | {column: pa.array(model.score(statistics(batch.column(place))))}

    return over_batches(kept, add, schema)


def train_fold(key: str = "doc_id"):
    """Rows whose crc32(key as text) mod 5 is not 0; a null key counts as held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 != 0, F.lit(False))


def quality_filter(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score ``threshold`` or more, with their columns as they were.

    Learns from the labels of the training fold. Null and empty texts are scored like others; repeated rows are each
    kept or not alike; an empty table stays empty.
    """
    model = train(documents, labels.filter(train_fold()))
    name = fresh(documents, "quality_score")
    return score(documents, model, column=name).filter(F.col(name) >= threshold).drop(name)


def op6_quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``documents``."""
    model = train(documents, labels.filter(train_fold()))
    scored = score(documents.select("doc_id", "text"), model).drop("text")
    return scored.select(
        "doc_id", (~train_fold()).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
