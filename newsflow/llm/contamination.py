"""Benchmark decontamination by templates.

Numbers, units behind numbers and names become typed placeholders, and runs of eight template tokens (windows) of documents are
joined by hash with those of the benchmark. What stood at the placeholders are slots; where an item's windows match in one alignment,
equal item slots must stand for equal document slots, so that a question with other numbers or names is caught and a chance meeting of
templates is not. A second kind of window keeps names as words, for texts that were written in another case.

Documents meet the benchmark in a bitmap of fixed size first; only windows that it lets through leave their task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow.llm.batches import fresh, over_batches, small_batches
from newsflow.llm.neardup import row_key
from newsflow.llm.spans import Words, mix, raw_bytes, split_words, text_slices, windows, word_keys
from newsflow.session import broadcast_limit, estimated_bytes, stage

WIDTH = 8
LEAST_WORDS = 5
LEAST_COVERAGE = 0.25
LEAST_RUN = 6
# Items below both of these are common words rather than questions; they are found only as a whole text.
SHORT_WORDS = 3
SHORT_BYTES = 16
BITMAP_BITS = 1 << 24
# Units that may follow a number.
UNITS = (
    "mm", "cm", "m", "km", "in", "ft", "yd", "mi", "mg", "g", "kg", "t", "oz", "lb", "lbs", "ml", "cl", "l", "ms", "s", "sec", "min",
    "h", "hr", "hrs", "kb", "mb", "gb", "tb", "hz", "khz", "mhz", "ghz", "w", "kw", "mw", "kwh", "v", "mv", "kv", "j", "kj", "mj", "n", "pa",
    "kpa", "k", "c", "f", "mph", "kmh", "usd", "eur", "gbp", "dollar", "dollars", "euro", "euros", "cent", "cents", "pound", "pounds",
    "percent", "meter", "meters", "metre", "metres", "kilometer", "kilometers", "kilometre", "kilometres", "mile", "miles", "inch",
    "inches", "foot", "feet", "gram", "grams", "kilogram", "kilograms", "liter", "liters", "litre", "litres", "second", "seconds",
    "minute", "minutes", "hour", "hours", "day", "days", "week", "weeks", "month", "months", "year", "years", "degree", "degrees",
)
_WORD, _NUMBER, _UNIT, _NAME = range(4)
_PLACEHOLDERS = mix(np.arange(101, 105, dtype=np.uint64))
_KINDS = mix(np.arange(201, 203, dtype=np.uint64))


def _lowered(texts: pa.Array) -> pa.Array:
    """Lower case of the same length in bytes: characters that would change it stay as they are."""
    lower = pc.utf8_lower(texts)
    odd = pc.not_equal(pc.binary_length(lower), pc.binary_length(texts)).to_numpy(zero_copy_only=False)
    if not odd.any():
        return lower
    fixed = lower.to_pylist()
    for at in np.flatnonzero(odd):
        fixed[at] = "".join(c.lower() if len(c.lower().encode()) == len(c.encode()) else c for c in texts[at].as_py())
    return pa.array(fixed, type=texts.type)


def _unit_keys() -> np.ndarray:
    return np.sort(word_keys(split_words(pa.array(UNITS))))


_UNIT_KEYS = _unit_keys()


def _types(words: Words, raw: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Word, number, unit or name, per word."""
    out = np.zeros(len(keys), dtype=np.int8)
    if not len(keys):
        return out
    first = words.data[words.start]
    number = (first >= 48) & (first <= 57)
    opens = np.zeros(len(keys), dtype=bool)
    opens[words.bounds[:-1][words.count > 0]] = True
    follows = np.concatenate([[False], number[:-1]]) & ~opens
    place = np.minimum(np.searchsorted(_UNIT_KEYS, keys), len(_UNIT_KEYS) - 1)
    unit = follows & (_UNIT_KEYS[place] == keys)
    # a name: first character in upper case, the rest not, and no end of sentence or line in front of it
    changed = np.concatenate([[0], np.cumsum(raw != words.data)])
    lead = np.where(first >= 0xF0, 4, np.where(first >= 0xE0, 3, np.where(first >= 0xC0, 2, 1)))
    head = np.minimum(words.start + lead, words.end)
    titled = (changed[head] > changed[words.start]) & (changed[words.end] == changed[head])
    ends = np.isin(raw, np.frombuffer(b".!?\n\r:", dtype=np.uint8))
    stops = np.concatenate([[0], np.cumsum(ends)])
    before = np.concatenate([[0], words.end[:-1]])
    inside = ~opens & (stops[words.start] == stops[before])
    out[titled & inside] = _NAME
    out[unit] = _UNIT
    out[number] = _NUMBER
    return out


def _templates(texts: pa.Array) -> tuple[list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], np.ndarray]:
    """For both kinds of window: token keys, token types, slot keys, and bounds of rows, of a null-free array; and which rows are tiny."""
    lower = _lowered(texts)
    words = split_words(lower, lower=False)
    raw, _ = raw_bytes(texts)
    keys = word_keys(words)
    types = _types(words, raw, keys)
    out = []
    for kind in range(2):
        own = types if kind == 0 else np.where(types == _NAME, _WORD, types)
        # neighbours of one type, numbers parted by one sign or names, are one slot
        joins = np.zeros(len(own), dtype=bool)
        if len(own):
            gap = words.start[1:] - words.end[:-1]
            joins[1:] = (own[1:] == own[:-1]) & (gap == 1) & ((own[1:] == _NUMBER) | (own[1:] == _NAME))
            joins[words.bounds[:-1][words.count > 0]] = False
        lead = np.flatnonzero(~joins)
        slots = np.add.reduceat(mix(keys + np.uint64(1)), lead) if len(lead) else keys
        kept = own[lead]
        token = np.where(kept == _WORD, keys[lead], _PLACEHOLDERS[kept]) ^ _KINDS[kind]
        out.append((token, kept, slots, np.searchsorted(lead, words.bounds)))
    length = np.concatenate([[0], np.cumsum(words.end - words.start)])
    return out, (words.count < SHORT_WORDS) & (np.diff(length[words.bounds]) < SHORT_BYTES)


def _windows(texts: pa.Array, bitmap: np.ndarray | None, widths: list[int], whole_widths: list[int]) -> dict[str, list]:
    """Windows of the texts. Slots are part of the hash where a window has nothing else.

    Without a bitmap, those of benchmark items: of ``WIDTH`` tokens, or of all if there are fewer. Else those of documents that the bitmap
    has: of all ``widths``, and whole texts of ``whole_widths``. Each with its row, hash, place, the number of its row's windows of that kind and of those
    with a word in them, kind, slots in order, the places of the window's words in the row, how many words and tokens the row has, and
    whether it is tiny.
    """
    found: dict[str, list] = {name: [] for name in ("row", *_WINDOW.names)}
    for first, part in text_slices(texts):
        kinds, tiny = _templates(part)
        for kind, (token, types, slots, bounds) in enumerate(kinds):
            count = np.diff(bounds)
            plain = np.concatenate([[0], np.cumsum(types == _WORD)])
            for width in range(1, WIDTH + 1):
                if bitmap is None:
                    rows = count == width if width < WIDTH else count >= width
                elif width in widths:
                    rows = count >= width
                else:
                    rows = (count == width) & (width in whole_widths)
                if not rows.any():
                    continue
                hashes, own = windows(token, bounds, width)
                sizes = np.diff(own)
                of = np.repeat(np.arange(len(sizes)), sizes)
                start = bounds[of] + np.arange(len(hashes)) - own[of]
                stop = np.minimum(start + width, bounds[of + 1])
                worded = plain[stop] > plain[start]
                hashes = np.where(worded, hashes, hashes ^ mix(windows(slots, bounds, width)[0]))
                hit = rows[of]
                if bitmap is not None:
                    slot = hashes & np.uint64(BITMAP_BITS - 1)
                    hit &= ((bitmap[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)
                templates = np.bincount(of, weights=worded, minlength=len(sizes))
                for at in np.flatnonzero(hit):
                    row = of[at]
                    inner = slice(start[at], stop[at])
                    found["row"].append(first + int(row))
                    found["hash"].append(int(hashes[at].view(np.int64)))
                    found["place"].append(int(start[at] - bounds[row]))
                    found["windows"].append(int(sizes[row]))
                    found["templates"].append(int(templates[row]))
                    found["kind"].append(kind)
                    found["slots"].append(slots[inner][types[inner] != _WORD].view(np.int64).tolist())
                    found["words"].append((np.flatnonzero(types[inner] == _WORD) + start[at] - bounds[row]).tolist())
                    found["row_words"].append(int(plain[bounds[row + 1]] - plain[bounds[row]]))
                    found["tokens"].append(int(count[row]))
                    found["tiny"].append(bool(tiny[row]))
    return found


_WINDOW = T.StructType([
    T.StructField("hash", T.LongType()), T.StructField("place", T.IntegerType()),
    T.StructField("windows", T.IntegerType()), T.StructField("templates", T.IntegerType()), T.StructField("kind", T.IntegerType()),
    T.StructField("slots", T.ArrayType(T.LongType())), T.StructField("words", T.ArrayType(T.IntegerType())),
    T.StructField("row_words", T.IntegerType()), T.StructField("tokens", T.IntegerType()),
    T.StructField("tiny", T.BooleanType())])


def _window_rows(texts: DataFrame, bitmap: np.ndarray | None = None, widths: list[int] = (), whole_widths: list[int] = ()) -> DataFrame:
    """The windows of texts (columns, last of them ``text``) with the other columns."""
    small_batches(texts.sparkSession)
    kept = texts.drop("text")
    schema = T.StructType([*kept.schema.fields, *_WINDOW.fields])
    names = kept.columns
    shared = None if bitmap is None else texts.sparkSession.sparkContext.broadcast(bitmap)

    def make(batch: pa.RecordBatch) -> dict:
        found = _windows(batch.column(len(names)), None if shared is None else shared.value, widths, whole_widths)
        rows = pa.array(found.pop("row"), type=pa.int64())
        return {name: batch.column(i).take(rows) for i, name in enumerate(names)} | found

    return over_batches(texts.select(*names, "text"), make, schema)


def _bitmap(windows_: DataFrame) -> np.ndarray:
    """One bit per window hash modulo ``BITMAP_BITS``: 2 MB, whatever the benchmark's size."""
    slot = F.col("hash").bitwiseAND(F.lit(BITMAP_BITS - 1)) + 1
    parts = windows_.select(F.bitmap_bucket_number(slot).alias("part"), F.bitmap_bit_position(slot).alias("bit"))
    bitmap = np.zeros(BITMAP_BITS // 8, dtype=np.uint8)
    for row in parts.groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits")).collect():
        own = np.frombuffer(bytes(row["bits"]), dtype=np.uint8)
        at = (row["part"] - 1) * 4096
        bitmap[at:at + 4096] = own[:4096]
    return bitmap


def matches(documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
            item_text: str = "text") -> DataFrame:
    """(id, row_key, item_id, matched, windows, rewritten): the items that a document has in it.

    ``matched`` of an item's ``windows`` stand in the document, word for word or in alignments whose slots are consistent; a quarter of them, or six in
    all, make a match. ``rewritten`` tells that slots were filled anew. An item of fewer than eight template tokens is one
    window of all of them; below three words and 16 bytes it is found only as a whole text. Null and empty texts match nothing. Repeated rows of a document or an item are each reported once.
    """
    spark = documents.sparkSession
    items = benchmark.select(F.col(item).alias("item_id"), F.col(item_text).alias("text")).distinct()
    known = stage(_window_rows(items).withColumnsRenamed(
        {"place": "item_place", "slots": "item_slots", "tokens": "item_tokens"}), "benchmark")
    lengths = known.select(F.least("item_tokens", F.lit(WIDTH)).alias("width"), "tiny").distinct().collect()
    widths, whole_widths = ([x["width"] for x in lengths if x["tiny"] == tiny] for tiny in (False, True))
    texts = documents.select(F.col(key).alias("id"), row_key(key, text).alias("row_key"), F.col(text).alias("text"))
    found = _window_rows(texts, _bitmap(known), widths, whole_widths).select(
        "id", "row_key", "hash", "kind", "place", "slots", "tokens")
    small = estimated_bytes(known) <= max(broadcast_limit(spark), 8 << 20)
    both = found.join(F.broadcast(known) if small else known, ["hash", "kind"])
    both = both.filter(F.size("slots") == F.size("item_slots")).filter(
        ~F.col("tiny") | (F.col("tokens") == F.col("item_tokens"))).drop("tokens", "tiny").distinct()

    whole = ["id", "row_key", "item_id", "windows", "kind"]
    item_side = ["templates", "row_words", "item_tokens"]
    aligned = both.groupBy(*whole, *item_side, (F.col("place") - F.col("item_place")).alias("offset")).agg(
        F.collect_set("item_place").alias("places"),
        F.collect_set(F.when(F.col("slots") == F.col("item_slots"), F.col("item_place"))).alias("exact"),
        F.size(F.collect_set(F.when(F.size("words") > 0, F.col("item_place")))).alias("templated"),
        F.size(F.array_distinct(F.flatten(F.collect_set("words")))).alias("covered"),
        F.array_distinct(F.flatten(F.collect_set(F.arrays_zip("item_slots", "slots")))).alias("pairs"))
    bound = F.size("pairs") == F.size(F.array_distinct(F.transform("pairs", lambda x: x["item_slots"])))
    # slots filled anew need words around them: enough, or those of all windows of an item that is poor in them
    all_of_it = (F.col("item_tokens") > WIDTH) & (F.col("row_words") >= 2) & (F.col("templated") == F.col("templates")) & (
        F.col("templates") >= 2)
    trusted = bound & ((F.col("covered") >= LEAST_WORDS) | all_of_it)
    rewritten = trusted & F.exists("pairs", lambda x: x["item_slots"] != x["slots"])
    places = F.explode(F.when(trusted, F.col("places")).otherwise(F.col("exact")))
    by_kind = aligned.select(*whole, places.alias("place"), rewritten.alias("rewritten")).groupBy(*whole).agg(
        F.countDistinct("place").alias("matched"), F.min("rewritten").alias("rewritten"))
    enough = by_kind.filter((F.col("matched") >= F.col("windows") * LEAST_COVERAGE) | (F.col("matched") >= LEAST_RUN))
    # the kind of window that covers more of the item speaks for the match
    best = F.max(F.struct((F.col("matched") / F.col("windows")).alias("cover"), (~F.col("rewritten")).alias("same"), "matched", "windows"))
    return enough.groupBy("id", "row_key", "item_id").agg(best.alias("best")).select(
        "id", "row_key", "item_id", "best.matched", "best.windows", (~F.col("best.same")).alias("rewritten"))


def decontaminate(documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``documents`` without those that match an item; null texts stay, columns stay as they are."""
    found = stage(matches(documents, benchmark, key, text).select("row_key").distinct(), "matched")
    own = fresh(documents, "row_key")
    return documents.withColumn(own, row_key(key, text)).join(
        found.withColumnRenamed("row_key", own), own, "left_anti").drop(own)


def op3_decontamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, matched, windows, rewritten for every benchmark item found in a document."""
    return matches(documents, benchmark).select(
        F.col("id").alias("doc_id"), "item_id", "matched", "windows", "rewritten")
