"""Toxicity by a weighted finite-state grammar over clauses.

Small transducers read a clause's tokens: insults and threats give weight, targets near them raise it, negation in front of them and
reported speech lower it. They are composed once into a single machine whose transitions carry the product of their
factors. Insult stems and their weights are learned from labels; words of the grammar are fixed. Only clauses with an insult or a
threat are run, and a document is judged by the weights of its matched clauses against its length.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow.llm.batches import hash_share, over_batches, small_batches
from newsflow.llm.quality import train_fold
from newsflow.llm.spans import _BYTE_KEYS, _MULTIPLIER, Words, mix, split_words, text_slices, word_keys
from newsflow.session import stage

SAMPLE_PER_CLASS = 4_000
STEM_BYTES = (4, 5, 6, 7, 8)
LEAST_TEXTS = 5
LEAST_SHARE = 0.005
LEAST_ODDS = 1.5
LEAST_DEVIATION = 5.0
MAX_STEMS = 20_000
THRESHOLD = 0.5
THREAT_WEIGHT = 4.0
RIDGE = 1e-2

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
# Words of the grammar, in English, German, French and Spanish.
THREATS = (
    "kill hurt destroy attack shoot burn stab murder beat töten umbringen schlagen erschießen tuer frapper détruire brûler "
    "matar golpear destruir quemar").split()
TARGETS = (
    "you your yours yourself he she they him them his their du dein deine dich euch ihr ihnen tu toi vous ton votre ils "
    "tú usted ustedes vosotros ellos").split()
NEGATIONS = "not never isn aren wasn weren don doesn neither nor nicht kein keine nie niemals pas jamais aucun nunca ni sin".split()
REPORTS = (
    "said says told called calls wrote writes claimed claims reported quoted alleged sagte sagt nannte schrieb berichtete "
    "dit appelé écrit rapporté dijo dice llamó escribió").split()

Transducer = Callable[[int, int], tuple[int, float]]


def insults(state: int, kind: int) -> tuple[int, float]:
    """An insult right behind another one weighs more."""
    return (1, 1.25 if state else 1.0) if kind == INSULT else (0, 1.0)


def threats(state: int, kind: int) -> tuple[int, float]:
    """A threat counts when its target follows within three tokens."""
    if kind == THREAT:
        return 3, 0.0
    if kind == TARGET:
        return 0, THREAT_WEIGHT if state else 0.0
    return max(0, state - 1), 1.0


def addressed(state: int, kind: int) -> tuple[int, float]:
    """A target up to four tokens before raises the weight."""
    if kind == TARGET:
        return 4, 1.0
    return max(0, state - 1), 1.5 if state and kind == INSULT else 1.0


def negated(state: int, kind: int) -> tuple[int, float]:
    """Negation reaches three tokens."""
    factor = 0.3 if state else 1.0
    return (3, 1.0) if kind == NEGATION else (max(0, state - 1), factor)


def reported(state: int, kind: int) -> tuple[int, float]:
    """What follows a verb of speech is another's word, up to the clause's end."""
    return (1, 1.0) if kind == REPORT else (state, 0.5 if state else 1.0)


def compose(*machines: Transducer) -> tuple[np.ndarray, np.ndarray]:
    """(next state, factor) by state and token kind of the product machine; its start is state 0."""
    start = (0,) * len(machines)
    number, rows, factors, waiting = {start: 0}, [], [], [start]
    while len(rows) < len(waiting):
        state = waiting[len(rows)]
        after, weight = [], []
        for kind in range(6):
            moves = [machine(own, kind) for machine, own in zip(machines, state)]
            to = tuple(move[0] for move in moves)
            if to not in number:
                number[to] = len(waiting)
                waiting.append(to)
            after.append(number[to])
            weight.append(float(np.prod([move[1] for move in moves])))
        rows.append(after)
        factors.append(weight)
    return np.array(rows), np.array(factors)


_NEXT, _FACTOR = (table.tolist() for table in compose(insults, threats, addressed, negated, reported))


def clause_weight(kinds: list[int], weights: list[float]) -> float:
    """The clause's weight: an insult gives its own times the factor, a target that a threat reaches the factor alone.

    A target behind an insult counts like one before: the clause is read from both ends and the greater weight holds.
    """
    return max(_run(kinds, weights), _run(kinds[::-1], weights[::-1]) if INSULT in kinds and NEGATION not in kinds
               and REPORT not in kinds and THREAT not in kinds else 0.0)


def _run(kinds: list[int], weights: list[float]) -> float:
    state, total = 0, 0.0
    for kind, weight in zip(kinds, weights):
        if kind == INSULT:
            total += weight * _FACTOR[state][kind]
        elif kind == TARGET:
            total += _FACTOR[state][kind]
        state = _NEXT[state][kind]
    return total


def stem_keys(words: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """(word numbers, keys) of the stems of each length of ``STEM_BYTES``, and of whole words."""
    length = words.end - words.start
    key = np.full(len(length), 0x51ED270B, dtype=np.uint64)
    out = []
    live = np.arange(len(length))
    for step in range(max(STEM_BYTES)):
        live = live[length[live] > step]
        key[live] = (key[live] ^ _BYTE_KEYS[words.data[words.start[live] + step]]) * _MULTIPLIER
        if step + 1 in STEM_BYTES:
            out.append((live, mix(key[live] + np.uint64(step + 1))))
    odd = np.flatnonzero((length > max(STEM_BYTES)) | (length < min(STEM_BYTES)))
    short = Words(words.data, words.start[odd], words.end[odd], np.array([0, len(odd)]))
    return [*out, (odd, word_keys(short))]


def _fixed() -> dict[int, int]:
    out = {}
    for kind, listed in ((REPORT, REPORTS), (NEGATION, NEGATIONS), (TARGET, TARGETS), (THREAT, THREATS)):
        out.update(dict.fromkeys(word_keys(split_words(pa.array(listed))).tolist(), kind))
    return out


_GRAMMAR = _fixed()
_THREAT_KEYS = np.sort(np.array([k for k, kind in _GRAMMAR.items() if kind == THREAT], dtype=np.uint64))


class Stems:
    """Keys of insult stems with their weights."""

    def __init__(self, keys: np.ndarray, weights: np.ndarray) -> None:
        order = np.argsort(keys)
        self.keys, self.weights = keys[order].astype(np.uint64), weights[order].astype(np.float64)
        self.seen = np.zeros(1 << 16, dtype=bool)
        self.seen[self.keys >> np.uint64(48)] = True

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys are stems, and their places."""
        maybe = np.flatnonzero(self.seen[keys >> np.uint64(48)])
        if not len(maybe):
            return maybe, maybe
        place = np.minimum(np.searchsorted(self.keys, keys[maybe]), len(self.keys) - 1)
        hit = self.keys[place] == keys[maybe]
        return maybe[hit], place[hit]

    def word_weights(self, words: Words) -> np.ndarray:
        """The greatest weight of a stem that a word has; 0 without."""
        out = np.zeros(len(words.start))
        for own, keys in stem_keys(words):
            at, place = self.places(keys)
            np.maximum.at(out, own[at], self.weights[place])
        return out


def matched_clauses(texts: pa.Array, stems: Stems) -> tuple[np.ndarray, list[tuple[int, int, int, float]]]:
    """Words per text, and (row, first byte, end byte, weight) of the clauses with weight, of a null-free array."""
    words = split_words(texts)
    keys = word_keys(words)
    weights = stems.word_weights(words)
    rows = words.row
    ends = np.isin(words.data, np.frombuffer(b".!?;:\n", dtype=np.uint8))
    stops = np.concatenate([[0], np.cumsum(ends)])
    before = np.concatenate([[0], words.end[:-1]]) if len(rows) else rows
    new = np.ones(len(rows), dtype=bool)
    if len(rows):
        new[1:] = (stops[words.start[1:]] != stops[before[1:]]) | (rows[1:] != rows[:-1])
    clause = np.cumsum(new) - 1
    first = np.append(np.flatnonzero(new), len(rows))
    threat = _THREAT_KEYS[np.minimum(np.searchsorted(_THREAT_KEYS, keys), len(_THREAT_KEYS) - 1)] == keys
    offsets = np.searchsorted(words.start, 0)
    found = []
    for at in np.unique(clause[(weights > 0) | threat]).tolist():
        inner = slice(first[at], first[at + 1])
        own = weights[inner].tolist()
        kinds = [INSULT if w > 0 else _GRAMMAR.get(k, OTHER) for k, w in zip(keys[inner].tolist(), own)]
        weight = clause_weight(kinds, own)
        if weight > 0:
            found.append((int(rows[first[at]]), int(words.start[first[at]]), int(words.end[first[at + 1] - 1]) - offsets, weight))
    return words.count, found


def _features(texts: pa.Array, stems: Stems) -> np.ndarray:
    """Per text: 1, and logarithms of the matched weight, its share of the words, the greatest clause, the matched clauses, their
    share, the words, and whether there are any. All but the first are 0 without a matched clause: length alone says nothing."""
    out = []
    for _, part in text_slices(texts):
        count, found = matched_clauses(part, stems)
        row = np.array([x[0] for x in found], dtype=np.int64)
        weight = np.array([x[3] for x in found])
        total = np.bincount(row, weights=weight, minlength=len(part))
        clauses = np.bincount(row, minlength=len(part))
        most = np.zeros(len(part))
        np.maximum.at(most, row, weight)
        out.append(np.column_stack([
            np.ones(len(part)), np.log1p(total), np.log1p(100 * total / (count + 10)), np.log1p(most),
            np.log1p(clauses), np.log1p(100 * clauses / (count + 10)),
            np.log1p(count / 100) * (clauses > 0), clauses > 0]))
    return np.concatenate(out) if out else np.empty((0, 8))


@dataclass
class ToxicityModel:
    """Stems, and coefficients of the document features."""

    stems: Stems
    coefficients: np.ndarray

    def score(self, texts: pa.Array) -> np.ndarray:
        away = np.clip(_features(texts, self.stems) @ self.coefficients, -500, 500)
        return np.round(1 / (1 + np.exp(-away)), 9)

    def clauses(self, text: str) -> list[tuple[str, float]]:
        """The matched clauses of one text and their weights."""
        found = matched_clauses(pa.array([text]), self.stems)[1]
        raw = text.encode()
        return [(raw[a:b].decode("utf-8", "replace"), weight) for _, a, b, weight in found]


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Newton's steps for a ridge logistic regression."""
    beta = np.zeros(x.shape[1])
    penalty = ridge * len(y) * np.eye(x.shape[1]) / 100
    penalty[0, 0] = 1e-9
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (y - chance) - penalty @ beta
        hessian = (x * (chance * (1 - chance))[:, None]).T @ x + penalty + 1e-9 * np.eye(x.shape[1])
        step = np.linalg.solve(hessian, gradient)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    return beta


def _stem_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of the distinct stems of every text."""
    rows, keys = [], []
    for first, part in text_slices(texts):
        words = split_words(part)
        own = words.row
        for at, key in stem_keys(words):
            rows.append(own[at] + first)
            keys.append(key)
    row, key = np.concatenate(rows), np.concatenate(keys)
    order = np.lexsort((key, row))
    row, key = row[order], key[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1])
    return row[new], key[new]


_STEM_COUNTS = T.StructType([T.StructField("key", T.LongType()), T.StructField("n", T.LongType())])


def _frequent(toxic: DataFrame, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Stems of at least ``least`` of the toxic sample's texts, and their numbers of texts; the commonest ``MAX_STEMS`` times ten."""
    def count(batch: pa.RecordBatch) -> dict:
        keys, n = np.unique(_stem_sets(batch.column(0))[1], return_counts=True)
        return {"key": keys.view(np.int64), "n": n}

    rows = over_batches(toxic.select("text"), count, _STEM_COUNTS).groupBy("key").agg(F.sum("n").alias("n")).filter(
        F.col("n") >= least).orderBy(F.desc("n"), "key").limit(10 * MAX_STEMS).collect()
    return np.array([row["key"] for row in rows], dtype=np.int64).view(np.uint64), np.array([row["n"] for row in rows])


def _clean_counts(clean: DataFrame, keys: np.ndarray) -> np.ndarray:
    """Number of clean texts with each of the stems."""
    shared = clean.sparkSession.sparkContext.broadcast(Stems(keys, np.zeros(len(keys))))

    def count(batch: pa.RecordBatch) -> dict:
        stems = shared.value
        places = stems.places(_stem_sets(batch.column(0))[1])[1]
        n = np.bincount(places, minlength=len(stems.keys))
        place = np.flatnonzero(n)
        return {"key": stems.keys[place].view(np.int64), "n": n[place]}

    rows = over_batches(clean.select("text"), count, _STEM_COUNTS).groupBy("key").agg(F.sum("n").alias("n")).collect()
    found = {row["key"]: row["n"] for row in rows}
    return np.array([found.get(key, 0) for key in keys.view(np.int64).tolist()], dtype=np.int64)


def train(documents: DataFrame, labels: DataFrame, label: str = "toxic", text: str = "text", key: str = "doc_id",
          per_class: int = SAMPLE_PER_CLASS) -> ToxicityModel | None:
    """Learn stems and coefficients from ``labels`` (key, label 0 or 1); None if a class has no row.

    About ``per_class`` rows of each label are read, chosen by a hash of the key, their whole texts; the driver gets counts of
    frequent stems and eight numbers per sampled text. Of several labels of one key the greatest counts.
    """
    small_batches(documents.sparkSession)
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).filter(
        "key IS NOT NULL AND label IN (0, 1)").groupBy("key").agg(F.max("label").alias("label"))
    counts = {row["label"]: row["count"] for row in known.groupBy("label").count().collect()}
    if len(counts) < 2:
        return None
    shares = {kind: min(1.0, per_class / n) for kind, n in counts.items()}
    chosen = known.filter(hash_share("key", seed=2) < F.when(F.col("label") == 1, shares[1]).otherwise(shares[0]))
    # bounded by ``per_class``, so it may be broadcast, and its texts be written once
    sample = stage(documents.select(F.col(key).alias("key"), F.col(text).alias("text")).join(
        F.broadcast(chosen), "key"), "toxicity")
    toxic, clean = sample.filter("label = 1"), sample.filter("label = 0")
    texts = {row["label"]: row["count"] for row in sample.groupBy("label").count().collect()}
    if len(texts) < 2:
        return None
    keys, hits = _frequent(toxic, max(LEAST_TEXTS, int(LEAST_SHARE * texts[1])))
    misses = _clean_counts(clean, keys) if len(keys) else np.empty(0, np.int64)
    odds = np.log((hits + 0.5) / (texts[1] - hits + 0.5)) - np.log((misses + 0.5) / (texts[0] - misses + 0.5))
    pooled = (hits + misses) / (texts[1] + texts[0])
    error = np.sqrt(pooled * (1 - pooled) * (1 / texts[1] + 1 / texts[0])) + 1e-12
    telling = (odds >= LEAST_ODDS) & ((hits / texts[1] - misses / texts[0]) / error >= LEAST_DEVIATION)
    best = np.flatnonzero(telling)[np.argsort(-odds[telling], kind="stable")[:MAX_STEMS]]
    stems = Stems(keys[best], odds[best])

    shared = documents.sparkSession.sparkContext.broadcast(stems)
    schema = T.StructType([T.StructField("label", T.IntegerType()), T.StructField("x", T.ArrayType(T.DoubleType()))])
    rows = over_batches(sample.select("text", "label"), lambda batch: {
        "label": batch.column(1), "x": _features(batch.column(0), shared.value).tolist()}, schema).collect()
    rows.sort(key=lambda row: (row["label"], row["x"]))
    x, y = np.array([row["x"] for row in rows]), np.array([row["label"] for row in rows], dtype=float)
    beta = _logistic(x, y)
    # classes were sampled at different rates
    beta[0] += np.log(shares[0] / shares[1])
    return ToxicityModel(stems, beta)


def score(documents: DataFrame, model: ToxicityModel | None, text: str = "text", column: str = "score") -> DataFrame:
    """``documents`` with the probability of label 1 as ``column``, which replaces one of that name.

    Null texts count as empty, which match no clause. Without a model every score is 0.
    """
    kept = documents.drop(column)
    if model is None:
        return kept.withColumn(column, F.lit(0.0))
    small_batches(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*kept.schema.fields, T.StructField(column, T.DoubleType())])
    place = kept.columns.index(text)

    def add(batch: pa.RecordBatch) -> dict:
        made = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        return made | {column: shared.value.score(batch.column(place))}

    return over_batches(kept, add, schema)


def op8_toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``documents``."""
    model = train(documents, labels.filter(train_fold()))
    scored = score(documents.select("doc_id", "text"), model).drop("text")
    return scored.select(
        "doc_id", (~train_fold()).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
