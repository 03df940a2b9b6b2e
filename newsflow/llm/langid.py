"""Language ID: script ranges narrow the candidates, a Viterbi path over words labels spans.

Every word gets a log probability under each candidate language, from the language's counts of byte four-grams (hashed into a fixed
number of cells). Candidates of a word are the languages that use its script. The Viterbi path over a text's words may change
language between words at the price of a penalty, so that mixed text falls into spans. The text's language is the one with the
most letters on the path.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow.llm.batches import hash_share, over_batches, small_batches
from newsflow.llm.spans import Words, split_words, text_slices

SAMPLE_PER_LANGUAGE = 2_000
CELLS = 1 << 16
CONTEXTS = 1 << 13
SMOOTHING = 0.2
SWITCH_PENALTY = 12.0
LEAST_SCRIPT_SHARE = 0.01
UNKNOWN = "und"
PATH_BYTES = 8 << 20
# First code points of script ranges; a range ends where the next one starts.
SCRIPTS = (
    (0x0041, "latin"), (0x0250, "phonetic"), (0x0300, "marks"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"),
    (0x0590, "hebrew"), (0x0600, "arabic"), (0x0700, "syriac"), (0x0750, "arabic"), (0x0780, "thaana"), (0x07C0, "other"),
    (0x08A0, "arabic"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"),
    (0x0B00, "oriya"), (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"), (0x0D80, "sinhala"),
    (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"),
    (0x1200, "ethiopic"), (0x13A0, "other"), (0x1780, "khmer"), (0x1800, "mongolian"), (0x1900, "other"), (0x1E00, "latin"),
    (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3130, "hangul"), (0x3190, "other"),
    (0x31F0, "kana"), (0x3200, "other"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"),
    (0xF900, "han"), (0xFB00, "latin"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"), (0xFE70, "arabic"),
    (0xFF00, "other"), (0xFF21, "latin"), (0xFF66, "kana"), (0xFFA0, "other"), (0x20000, "han"), (0x32000, "other"),
)
_SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})
_SCRIPT_STARTS = np.array([start for start, _ in SCRIPTS])
_SCRIPT_OF = np.array([_SCRIPT_NAMES.index(name) for _, name in SCRIPTS])


def word_scripts(words: Words) -> np.ndarray:
    """The number of the script of each word's first character."""
    if not len(words.start):
        return np.empty(0, dtype=np.int64)
    data = np.append(words.data, np.zeros(3, np.uint8)).astype(np.int64)
    a, b, c, d = (data[words.start + i] for i in range(4))
    two, three, four = ((a & 31) << 6) | (b & 63), ((a & 15) << 12) | ((b & 63) << 6) | (c & 63), (
        ((a & 7) << 18) | ((b & 63) << 12) | ((c & 63) << 6) | (d & 63))
    point = np.select([a < 0x80, a < 0xE0, a < 0xF0], [a, two, three], four)
    return _SCRIPT_OF[np.maximum(np.searchsorted(_SCRIPT_STARTS, point, side="right") - 1, 0)]


def _grams(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cell and context cell of every byte of every word and of the end of each word, and where words start in them."""
    length = words.end - words.start + 1
    first = np.concatenate([[0], np.cumsum(length)])
    word = np.repeat(np.arange(len(length)), length)
    within = np.arange(first[-1]) - first[:-1][word]
    at = words.start[word] + within
    data = np.append(words.data, np.uint8(0))
    code = np.where(within == length[word] - 1, 32, data[np.minimum(at, len(data) - 1)]).astype(np.uint32)
    # three bytes of context; in front of the word there are blanks
    context = np.zeros(len(code), dtype=np.uint32)
    for back in (3, 2, 1):
        earlier = np.where(within >= back, np.roll(code, back), 32)
        context = (context << np.uint32(8)) | earlier.astype(np.uint32)
    mixed = context * np.uint32(0x9E3779B1)
    mixed ^= mixed >> np.uint32(15)
    cell = (mixed ^ (code * np.uint32(0x85EBCA6B))) * np.uint32(0xC2B2AE35)
    return (cell >> np.uint32(16)) % CELLS, ((mixed * np.uint32(0x27D4EB2F)) >> np.uint32(19)) % CONTEXTS, first


def gram_counts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of cells, of context cells, and of word bytes per script, over all texts."""
    cells, contexts = np.zeros(CELLS), np.zeros(CONTEXTS)
    scripts = np.zeros(len(_SCRIPT_NAMES))
    for _, part in text_slices(texts):
        words = split_words(part, digits=False)
        if len(words.start):
            cell, context, _ = _grams(words)
            cells += np.bincount(cell, minlength=CELLS)
            contexts += np.bincount(context, minlength=CONTEXTS)
            scripts += np.bincount(word_scripts(words), weights=words.end - words.start, minlength=len(scripts))
    return cells, contexts, scripts


@dataclass
class LanguageModel:
    """Log probabilities of cells given contexts per language, and which languages use a script."""

    languages: list[str]
    cells: np.ndarray
    contexts: np.ndarray
    uses: np.ndarray = field(default_factory=lambda: np.empty(0))

    @classmethod
    def of(cls, counts: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]) -> LanguageModel:
        languages = sorted(counts)
        cells = np.stack([counts[x][0] for x in languages], axis=1)
        contexts = np.stack([counts[x][1] for x in languages], axis=1)
        scripts = np.stack([counts[x][2] for x in languages], axis=1)
        share = scripts / np.maximum(scripts.sum(axis=0), 1)
        # a script that nobody uses leaves all languages as candidates
        uses = share >= LEAST_SCRIPT_SHARE
        uses[~uses.any(axis=1)] = True
        return cls(languages, np.log(cells + SMOOTHING).astype(np.float32),
                   np.log(contexts + SMOOTHING * 64).astype(np.float32), uses)

    def word_scores(self, words: Words) -> np.ndarray:
        """(words, languages): log probability less the best language's; languages that don't use the script get the worst."""
        if not len(words.start):
            return np.empty((0, len(self.languages)), dtype=np.float32)
        cell, context, first = _grams(words)
        each = self.cells[cell] - self.contexts[context]
        total = np.add.reduceat(each, first[:-1], axis=0)
        usable = self.uses[word_scripts(words)]
        total = np.where(usable, total, -1e4)
        return (total - total.max(axis=1, keepdims=True)).astype(np.float32)


def best_paths(scores: np.ndarray, bounds: np.ndarray, penalty: float = SWITCH_PENALTY) -> np.ndarray:
    """The language of every word on the best path of its row; all rows of a batch advance together, a word at a time."""
    count = np.diff(bounds)
    order = np.argsort(-count, kind="stable")
    starts, count = bounds[:-1][order], count[order]
    kinds = scores.shape[1]
    path = np.zeros(len(scores), dtype=np.int16)
    if not len(scores):
        return path
    longest = int(count[0])
    # rows that still have a word at step t are the first live[t]
    live = np.searchsorted(-count, -np.arange(1, longest + 1), side="right")
    state = np.zeros((int(live[0]), kinds), dtype=np.float32)
    stays = np.zeros((len(scores), kinds), dtype=bool)
    before = np.zeros(len(scores), dtype=np.int16)
    ends = np.zeros(len(count), dtype=np.int16)
    for step in range(longest):
        rows = int(live[step])
        state = state[:rows]
        at = starts[:rows] + step
        if step:
            best = state.argmax(axis=1)
            top = state[np.arange(rows), best][:, None] - penalty
            stays[at] = state >= top
            before[at] = best
            state = np.maximum(state, top)
            state -= state.max(axis=1, keepdims=True)
        state = state + scores[at]
        done = rows if step == longest - 1 else rows - int(live[step + 1])
        last = slice(rows - done, rows) if step < longest - 1 else slice(0, rows)
        ends[last] = state[last].argmax(axis=1)
    now = ends.copy()
    for step in range(longest - 1, -1, -1):
        rows = int(live[step])
        at = starts[:rows] + step
        path[at] = now[:rows]
        if step:
            stay = stays[at, now[:rows]]
            now[:rows] = np.where(stay, now[:rows], before[at])
    return path


def _groups(texts: pa.Array) -> list[tuple[int, pa.Array]]:
    return list(text_slices(texts, PATH_BYTES))


def _labelled(texts: pa.Array, model: LanguageModel, penalty: float):
    """Per slice of rows: word lengths, path, scores and bounds."""
    for first, group in _groups(texts):
        parts, bounds, sizes = [], [np.zeros(1, np.int64)], []
        offset = 0
        for _, part in text_slices(group):
            words = split_words(part, digits=False)
            parts.append(model.word_scores(words))
            sizes.append(words.end - words.start)
            bounds.append(words.bounds[1:] + offset)
            offset += len(words.start)
        scores, ends = np.concatenate(parts), np.concatenate(bounds)
        yield first, group, np.concatenate(sizes), best_paths(scores, ends, penalty), scores, ends


def predict(texts: pa.Array, model: LanguageModel, penalty: float = SWITCH_PENALTY) -> tuple[list[str], np.ndarray]:
    """Language and score of every text.

    The score is the share of letters on the path in that language, times the probability of the language against the others for the
    whole text.
    """
    names: list[str] = []
    out: list[np.ndarray] = []
    kinds = len(model.languages)
    letters = pc.match_substring_regex(pc.fill_null(texts, ""), r"\p{L}").to_numpy(zero_copy_only=False)
    for first, group, sizes, path, scores, bounds in _labelled(texts, model, penalty):
        rows = len(bounds) - 1
        row = np.repeat(np.arange(rows), np.diff(bounds))
        weight = np.bincount(row * kinds + path, weights=sizes, minlength=rows * kinds).reshape(rows, kinds)
        total = np.stack([np.bincount(row, weights=scores[:, k], minlength=rows) for k in range(kinds)], axis=1)
        # equal letters: the more probable language, then the first in order
        rank = weight + 1e-6 / (1 + np.abs(total))
        best = rank.argmax(axis=1)
        share = weight[np.arange(rows), best] / np.maximum(weight.sum(axis=1), 1)
        odds = np.exp(np.clip(total - total.max(axis=1, keepdims=True), -700, 0))
        sure = odds.max(axis=1) / odds.sum(axis=1)
        known = letters[first:first + rows]
        names += [model.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
        out.append(np.where(known, share * sure, 0.0))
    return names, np.round(np.concatenate(out), 9) if out else np.empty(0)


def spans(text: str, model: LanguageModel, penalty: float = SWITCH_PENALTY) -> list[tuple[int, int, str]]:
    """(start, end, language) of the spans of one text, in characters, from the first word of a span to its last."""
    texts = pa.array([text])
    words = split_words(texts, digits=False, lower=False)
    raw = text.encode()
    path = best_paths(model.word_scores(split_words(texts, digits=False)), words.bounds, penalty)
    found: list[list] = []
    for at, kind in enumerate(path[:len(words.start)].tolist()):
        if found and found[-1][2] == kind:
            found[-1][1] = int(words.end[at])
        else:
            found.append([int(words.start[at]), int(words.end[at]), kind])
    return [(len(raw[:a].decode()), len(raw[:b].decode()), model.languages[k]) for a, b, k in found]


def train(documents: DataFrame, lang: str = "lang", text: str = "text", key: str = "doc_id",
          per_language: int = SAMPLE_PER_LANGUAGE) -> LanguageModel | None:
    """Learn from the texts of rows with a language; None if there are none.

    About ``per_language`` rows of each are read, chosen by a hash of the key; the whole text of each. The driver
    gets sums of a fixed number of cells per language.
    """
    known = documents.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"),
                             F.col(key).alias("key")).filter("lang IS NOT NULL AND text IS NOT NULL")
    counts = {row["lang"]: row["count"] for row in known.groupBy("lang").count().collect()}
    if not counts:
        return None
    shares = F.create_map(*[x for name, n in sorted(counts.items()) for x in (
        F.lit(name), F.lit(min(1.0, per_language / n)))])
    small_batches(documents.sparkSession)
    sample = known.filter(hash_share("key", seed=1) < F.element_at(shares, F.col("lang")))
    schema = T.StructType([
        T.StructField("lang", T.StringType()), T.StructField("place", T.ArrayType(T.IntegerType())),
        T.StructField("n", T.ArrayType(T.DoubleType()))])

    def count(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"lang": [], "place": [], "n": []}
        names = batch.column(0)
        for name in sorted(set(names.to_pylist())):
            sums = np.concatenate(gram_counts(batch.column(1).filter(pc.equal(names, name))))
            place = np.flatnonzero(sums)
            out["lang"].append(name)
            out["place"].append(place.astype(np.int32))
            out["n"].append(sums[place])
        return out

    parts = over_batches(sample.select("lang", "text"), count, schema)
    summed = parts.select("lang", F.inline(F.arrays_zip("place", "n"))).groupBy("lang", "place").agg(F.sum("n").alias("n"))
    whole = summed.groupBy("lang").agg(F.collect_list("place").alias("place"), F.collect_list("n").alias("n"))
    out = {}
    for row in whole.toLocalIterator():
        sums = np.zeros(CELLS + CONTEXTS + len(_SCRIPT_NAMES))
        sums[np.array(row["place"], dtype=np.int64)] = row["n"]
        out[row["lang"]] = tuple(np.split(sums, [CELLS, CELLS + CONTEXTS]))
    return LanguageModel.of(out) if out else None


def identify(documents: DataFrame, model: LanguageModel | None, text: str = "text") -> DataFrame:
    """``documents`` with ``lang_pred`` and ``score`` (0 to 1) in place of columns of these names.

    Null texts, texts without a letter and all texts without a model are ``und`` with score 0. Only the text is looked at.
    """
    kept = documents.drop("lang_pred", "score")
    if model is None:
        return kept.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    small_batches(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([
        *kept.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    place = kept.columns.index(text)

    def add(batch: pa.RecordBatch) -> dict:
        names, scores = predict(batch.column(place), shared.value)
        made = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        return made | {"lang_pred": names, "score": scores}

    return over_batches(kept, add, schema)


def held_out():
    """Rows whose crc32(doc_id as text) mod 4 is 2; a null id is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op1_language_id(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``documents``, learned from rows that aren't held out."""
    model = train(documents.filter(~held_out()))
    found = identify(documents.select("doc_id", "text"), model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
