"""Token ids of texts in binary files that share one zstandard dictionary.

Texts are dealt out in the order of their keys, encoded once, and written by the tasks: each document's ids are one frame, compressed
on its own with a dictionary trained on serialised ids, so that short documents compress well and each can be read alone.
A file keeps the hash of its dictionary, the offset of every frame, the count of ids and the key; a manifest lists the files of
the attempts that Spark committed, so that files of lost attempts are never read.

Layout of a folder: ``dictionary`` (empty: none), ``manifest`` (Parquet), ``data/*.ids``. A file is ``MAGIC``, the frames, the
index (offsets, counts, keys, null flags), and a footer of fixed size. All numbers are little-endian.
"""

from __future__ import annotations

import hashlib
import json
import operator
import os
import re
import struct
import sys
import uuid
from array import array
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from newsflow.llm.batches import hash_share
from newsflow.llm.spans import text_slices
from newsflow.session import new_folder

MAGIC = b"TOKIDS01"
FOOTER = "<QQQQ32s8s"
FOOTER_BYTES = struct.calcsize(FOOTER)
DICTIONARY_BYTES = 32 << 10
SAMPLE_TEXTS = 1500
SAMPLE_TEXT_BYTES = 8 << 10
FILE_BYTES = 64 << 20
READ_BYTES = 8 << 20
MAX_MODEL_BYTES = 64 << 20
LEVEL = 3
# Parts of texts whose ids a task remembers, their greatest length, and how many are encoded together.
REMEMBERED, REMEMBERED_LENGTH, LINES = 1 << 19, 64, 1000
# Bytes of the texts whose parts are looked up together.
TEXT_BYTES = 4 << 20
# Fixed rule: byte-level vocabularies write a printable byte as its Latin-1 letter, the n-th other one as code point 256 + n.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_LETTERS = {byte: chr(256 + n) for n, byte in enumerate(sorted(set(range(256)) - _PRINTABLE))}

MANIFEST = T.StructType([
    T.StructField("part", T.IntegerType()), T.StructField("number", T.IntegerType()), T.StructField("file", T.StringType()),
    T.StructField("documents", T.LongType()), T.StructField("tokens", T.LongType()), T.StructField("bytes", T.LongType()),
    T.StructField("first_key", T.LongType()), T.StructField("last_key", T.LongType())])
READ = T.StructType([
    T.StructField("key", T.LongType()), T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()),
    T.StructField("ids", T.BinaryType())])


def _place(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a folder or file, on a path or in any store that pyarrow reads."""
    return pafs.FileSystem.from_uri(uri)


def _shared(dictionary: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(dictionary) if dictionary else None


class FileWriter:
    """Writes documents to one file, in the order given."""

    def __init__(self, out, dictionary: bytes, width: int) -> None:
        self.out, self.width = out, np.dtype(f"<u{width}")
        self.hash = hashlib.sha256(dictionary).digest()
        shared = _shared(dictionary)
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_dict_id=False)
        self.offsets, self.counts, self.keys, self.nulls = [len(MAGIC)], [], [], []
        out.write(MAGIC)

    def add(self, key: int | None, ids: np.ndarray) -> None:
        frame = self.compressor.compress(ids.astype(self.width).tobytes())
        self.out.write(frame)
        self.offsets.append(self.offsets[-1] + len(frame))
        self.counts.append(len(ids))
        self.keys.append(0 if key is None else key)
        self.nulls.append(key is None)

    @property
    def size(self) -> int:
        return self.offsets[-1]

    def close(self) -> dict:
        """Write index and footer; what the manifest has on the file."""
        for numbers, kind in ((self.offsets, "<u8"), (self.counts, "<u8"), (self.keys, "<i8"), (self.nulls, "u1")):
            self.out.write(np.array(numbers, dtype=kind).tobytes())
        self.out.write(struct.pack(FOOTER, self.offsets[-1], len(self.keys), sum(self.counts), self.width.itemsize, self.hash, MAGIC))
        self.out.close()
        known = [key for key, null in zip(self.keys, self.nulls) if not null]
        return {"documents": len(self.keys), "tokens": sum(self.counts), "bytes": self.offsets[-1],
                "first_key": known[0] if known else None, "last_key": known[-1] if known else None}


class FileReader:
    """Random access to the documents of one file."""

    def __init__(self, file, dictionary: bytes) -> None:
        self.file = file
        size = file.size()
        index, count, tokens, width, hashed, magic = struct.unpack(FOOTER, self._read(size - FOOTER_BYTES, FOOTER_BYTES))
        if magic != MAGIC:
            raise ValueError("not a file of token ids")
        if hashed != hashlib.sha256(dictionary).digest():
            raise ValueError("the file was written with another dictionary")
        self.width, self.tokens = np.dtype(f"<u{width}"), tokens
        raw = self._read(index, size - FOOTER_BYTES - index)
        self.offsets = np.frombuffer(raw, "<u8", count + 1).astype(np.int64)
        self.counts = np.frombuffer(raw, "<u8", count, 8 * (count + 1)).astype(np.int64)
        self.keys = np.frombuffer(raw, "<i8", count, 8 * (2 * count + 1))
        self.nulls = np.frombuffer(raw, "u1", count, 8 * (3 * count + 1)).astype(bool)
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])
        self.decompressor = zstandard.ZstdDecompressor(dict_data=_shared(dictionary))

    def _read(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        return self.file.read(size)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The numbers of the documents with these keys."""
        return np.flatnonzero(np.isin(self.keys, keys) & ~self.nulls)

    def documents(self, numbers: np.ndarray) -> Iterator[np.ndarray]:
        """The ids of each document; neighbours are read together, ``READ_BYTES`` at most or one document at a time."""
        at = 0
        while at < len(numbers):
            last = at + 1
            while (last < len(numbers) and numbers[last] == numbers[last - 1] + 1
                   and self.offsets[numbers[last] + 1] - self.offsets[numbers[at]] <= READ_BYTES):
                last += 1
            base = int(self.offsets[numbers[at]])
            raw = self._read(base, int(self.offsets[numbers[last - 1] + 1]) - base)
            for number in numbers[at:last]:
                frame = raw[int(self.offsets[number]) - base:int(self.offsets[number + 1]) - base]
                yield np.frombuffer(self.decompressor.decompress(frame), self.width)
            at = last


_ID = operator.attrgetter("id")


def _raw(ids: Iterable[int]) -> bytes:
    """Unsigned 32-bit integers, little-endian."""
    numbers = array("I", ids)
    if sys.byteorder == "big":
        numbers.byteswap()
    return numbers.tobytes()


class Encoder:
    """Ids of texts by a tokenizer file, in one thread, as tasks already fill the cores.

    Byte-level tokenizers begin a new piece at every space before a character that is no white space, and treat a piece
    alike wherever it stands. Texts are cut there, and each distinct part is encoded once while a worker remembers it. Other
    tokenizers are given whole texts.
    """

    def __init__(self, content: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content.decode())
        self.model = self.tokenizer.model
        newline = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.newline = newline[0] if len(newline) == 1 and _cuts_at_spaces(json.loads(content)) else None
        self.known: dict[str, bytes] = {}

    def largest(self) -> int:
        return max(self.tokenizer.get_vocab(with_added_tokens=True).values())

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [_raw(found.ids) for found in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _piece(self, text: str) -> bytes:
        """Ids of a text that the pattern does not cut: the model reads its bytes by their letters."""
        letters = text.encode().decode("latin-1").translate(BYTE_LETTERS)
        return _raw(map(_ID, self.model.tokenize(letters)))

    def _learn(self, keys: set[str]) -> dict[str, bytes]:
        """Ids of parts by their keys. Words and signs behind them go to the model, also on several lines, other plain parts are encoded together, a line each."""
        out: dict[str, bytes] = {}
        signs: dict[str, bytes] = {"": b""}
        parts = []
        space, newline, tokenize = BYTE_LETTERS[32], _raw([self.newline]), self.model.tokenize
        for key in keys:
            if key.isalpha() and key.isascii():
                out[key] = _raw(map(_ID, tokenize(space + key)))
                continue
            bare = key[:2] == "  "
            words = [_WORD.fullmatch(line) for line in (key[2:] if bare else key).split("\n")]
            if None in words:
                parts.append(key)
                continue
            lines = []
            for word in words:
                letters, sign = word.groups()
                # no space is before the first word of a text or line
                name = "  " + letters if bare else letters
                head = self.known.get(name) or out.get(name)
                if head is None:
                    head = _raw(map(_ID, tokenize(space + letters))) if not bare and letters.isascii() else self._piece(_part(name))
                    if not bare:
                        out[name] = head
                if sign not in signs:
                    signs[sign] = self._piece(sign)
                lines.append(head + signs[sign])
                bare = True
            out[key] = newline.join(lines)
        texts = [_part(key) for key in parts]
        plain = [at for at, text in enumerate(texts) if text[:1] == " " and "\n" not in text and not text[-1].isspace()]
        for first in range(0, len(plain), LINES):
            some = plain[first:first + LINES]
            ids = np.array(self.tokenizer.encode_batch_fast(["\n".join(texts[at] for at in some)], add_special_tokens=False)[0].ids, "<u4")
            ends = [*(4 * np.flatnonzero(ids == self.newline)).tolist(), 4 * len(ids)]
            raw, at = ids.tobytes(), 0
            for place, end in zip(some, ends, strict=True):
                out[parts[place]] = raw[at:end]
                at = end + 4
        rest = [at for at in range(len(parts)) if parts[at] not in out]
        out.update(zip([parts[at] for at in rest], self._whole([texts[at] for at in rest])))
        return out

    def _ids_of(self, keys: list[str]) -> list[bytes]:
        """The ids of parts by their keys; new ones are learned and remembered."""
        found = list(map(self.known.get, keys))
        if None in found:
            places = [at for at, ids in enumerate(found) if ids is None]
            new = self._learn({keys[at] for at in places})
            if len(self.known) < REMEMBERED:
                self.known.update((key, ids) for key, ids in new.items() if len(key) <= REMEMBERED_LENGTH)
            for at in places:
                found[at] = new[keys[at]]
        return found

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text, as unsigned 32-bit integers. Of the parts of all texts, equal ones are looked up once."""
        if self.newline is None:
            return (np.frombuffer(ids, "<u4") for ids in self._whole(texts.to_pylist()))
        cut = _cut(texts)
        ends = cut.offsets.to_numpy().astype(np.int64)
        flat, starts = cut.values.slice(ends[0], ends[-1] - ends[0]), ends[:-1] - ends[0]
        later = np.ones(len(flat), bool)
        later[starts] = False
        parts = flat.filter(pa.array(later)).dictionary_encode()
        keys = parts.dictionary.to_numpy(zero_copy_only=False).tolist()
        keys += ["  " + first for first in flat.take(pa.array(starts)).to_pylist()]
        of = np.empty(len(flat), np.int64)
        of[later], of[starts] = parts.indices.to_numpy(), len(parts.dictionary) + np.arange(len(starts))
        held = self._ids_of(keys)
        ids, sizes = np.frombuffer(b"".join(held), "<u4"), np.fromiter(map(len, held), np.int64, len(held)) // 4
        # ids of a part lie behind those of the parts before it, here and in the texts
        sizes, begins = sizes[of], (np.cumsum(sizes) - sizes)[of]
        lasts = np.cumsum(sizes)
        laid = ids[np.arange(lasts[-1]) + np.repeat(begins - lasts + sizes, sizes)]
        bounds = np.concatenate([[0], lasts])[np.concatenate([starts, [len(flat)]])]
        return (laid[first:last] for first, last in zip(bounds[:-1].tolist(), bounds[1:].tolist()))


def _encoder(content: bytes) -> Encoder:
    """The encoder of this process, with the parts it remembers.

    Functions travel to the tasks by value and bring modules of their own; what later tasks of a worker are to find hangs on an installed one.
    """
    import tokenizers

    kept = tokenizers.__dict__.setdefault("_kept_encoders", {})
    name = hashlib.sha256(content).digest()
    if name not in kept:
        kept.clear()
        kept[name] = Encoder(content)
    return kept[name]


def _cuts_at_spaces(model: dict) -> bool:
    """Whether a tokenizer file describes a byte-level tokenizer of the usual pattern, on texts as they are."""
    cutter = model.get("pre_tokenizer") or {}
    return (cutter.get("type") == "ByteLevel" and cutter.get("use_regex") is True and cutter.get("add_prefix_space") is False
            and not any(model.get(name) for name in ("normalizer", "truncation", "padding"))
            and not (model.get("model") or {}).get("dropout")
            and not any(" " in token["content"] or token["lstrip"] or token["rstrip"] or token["normalized"] or token["single_word"]
                        for token in model.get("added_tokens") or []))


# A space before these begins a piece; before any other character it may, and is not cut at.
_CUT = re.compile(r"(?= [!-~\u00a1-\u024f])")
# Latin letters, then ASCII signs: a space and the letters are one piece, the signs another.
_WORD = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([!-/:-@\[-`{-~]*)")
# A text where a space is not cut at, for RE2.
_UNCUT = r" (?:[^!-~\x{a1}-\x{24f}]|$)"


def _cut(texts: pa.Array) -> pa.ListArray:
    """The parts of each text without their space. The first part of a text has none; an empty text is one empty part."""
    texts = texts.cast(pa.string())
    cut = pc.split_pattern(texts, " ")
    uncut = pc.match_substring_regex(texts, _UNCUT)
    if not pc.any(uncut).as_py():
        return cut
    return pa.array([_parts_of(text) if whole else parts for text, whole, parts
                     in zip(texts.to_pylist(), uncut.to_pylist(), cut.to_pylist())], pa.list_(pa.string()))


def _parts_of(text: str) -> list[str]:
    """The parts of a text that has a space that is not cut at."""
    first, *rest = _CUT.split(text)
    return [first, *[part[1:] for part in rest]]


def _part(key: str) -> str:
    return key[2:] if key[:2] == "  " else " " + key


def _encoded(encoder: Encoder, texts: pa.Array, end_id: int | None) -> Iterator[tuple[int, np.ndarray]]:
    """(row, ids) of each text, by slices of bounded size; null is an empty text."""
    tail = np.array([] if end_id is None else [end_id], "<u4")
    for first, part in text_slices(texts, TEXT_BYTES):
        for row, ids in enumerate(encoder.encode(part), first):
            yield row, np.concatenate([ids, tail])


def train_dictionary(texts: DataFrame, text: str, model, width: int, end_id: int | None) -> bytes:
    """A dictionary trained on the serialised ids of at most ``SAMPLE_TEXTS`` different texts of ``SAMPLE_TEXT_BYTES`` at most.

    The sample goes by the texts' hashes. Empty if the trainer cannot make one of the sample, as from too few texts.
    """
    rows = texts.count()
    share = min(1.0, 2 * SAMPLE_TEXTS / max(rows, 1))
    short = texts.select(F.col(text).alias("text")).filter(
        (F.octet_length("text") <= SAMPLE_TEXT_BYTES) & (hash_share(F.col("text")) < share))
    picked = short.distinct().orderBy(F.xxhash64("text"), "text").limit(SAMPLE_TEXTS)

    def serialise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model.value)
        for batch in batches:
            made = [ids.astype(f"<u{width}").tobytes() for _, ids in _encoded(encoder, batch.column(0), end_id)]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], names=["ids"])

    samples = [bytes(row["ids"]) for row in picked.mapInArrow(serialise, "ids BINARY").collect()]
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(256, sum(map(len, samples)) // 8)), samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def write_tokens(df: DataFrame, folder: str, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int | None = 2) -> None:
    """Write the ids of every text to ``folder``, in ascending order of ``key``, null keys last.

    ``tokenizer`` is the path of a tokenizer file (tokenizers library) on the driver; its content goes to the tasks, ``MAX_MODEL_BYTES``
    at most. No special tokens are added; ``end_id`` ends each document. Null and empty texts have no other id. Rows of
    equal keys are written by the hash of their texts; equal rows are all written, dealt out by their places in the input. Other
    columns are not looked at. An empty table leaves an empty manifest. A text is encoded whole, so that a task's memory grows with
    its longest text.
    """
    spark = df.sparkSession
    with open(tokenizer, "rb") as file:
        content = file.read()
    if len(content) > MAX_MODEL_BYTES:
        raise ValueError(f"the tokenizer takes {len(content)} bytes; at most {MAX_MODEL_BYTES} are brought to each task")
    width = 2 if max(end_id or 0, Encoder(content).largest()) < 1 << 16 else 4
    model = spark.sparkContext.broadcast(content)
    rows = df.select(F.col(f"`{key}`").cast("bigint").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    dictionary = train_dictionary(rows, "text", model, width, end_id)
    store, path = _place(folder)
    store.create_dir(f"{path}/data")
    with store.open_output_stream(f"{path}/dictionary") as out:
        out.write(dictionary)

    # equal rows may be a large part of all; their places in the input deal them out
    order = [F.col("key").asc_nulls_last(), F.col("hash"), F.col("copy")]
    dealt = rows.withColumns({"hash": F.xxhash64("text"), "copy": F.monotonically_increasing_id()})
    ordered = dealt.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, attempt, number = TaskContext.get().partitionId(), uuid.uuid4().hex, 0
        there, root = _place(folder)
        encoder = writer = None
        name = ""

        def done() -> pa.RecordBatch:
            row = {"part": part, "number": number, "file": name, **writer.close()}
            return pa.RecordBatch.from_pylist([row], schema=to_arrow_schema(MANIFEST))

        for batch in batches:
            encoder = encoder or _encoder(model.value)
            keys = batch.column(0).to_pylist()
            for row, ids in _encoded(encoder, batch.column(1), end_id):
                if writer is None:
                    name = f"{part:06d}-{number:04d}-{attempt}.ids"
                    writer = FileWriter(there.open_output_stream(f"{root}/data/{name}"), dictionary, width)
                writer.add(keys[row], ids)
                if writer.size >= FILE_BYTES:
                    yield done()
                    writer, number = None, number + 1
        if writer is not None:
            yield done()

    ordered.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/manifest")


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The files of a folder in order, with ``base``, the ids in all files before; one row per file."""
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").withColumn(
        "base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def read_tokens(spark: SparkSession, folder: str, keys: Sequence[int] | None = None) -> DataFrame:
    """(key, start, n_tokens, ids) of the documents of a folder; ``start`` counts the ids before a document in all files.

    ``ids`` are unsigned 32-bit integers, little-endian. With ``keys``, only those documents: files that cannot hold one are not opened,
    and of the others the index and the frames wanted are read. Raises ValueError if a file was written with another
    dictionary than that of the folder.
    """
    store, path = _place(folder)
    with store.open_input_stream(f"{path}/dictionary") as file:
        dictionary = file.read()
    files = read_manifest(spark, folder)
    wanted = None if keys is None else np.array(sorted({int(key) for key in keys}), dtype=np.int64)
    if wanted is not None:
        listed = F.lit(wanted.tolist()) if len(wanted) else F.array().cast("array<bigint>")
        files = files.filter(F.exists(listed, lambda key: key.between(F.col("first_key"), F.col("last_key"))))
    count = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").count()
    tasks = max(1, min(count, 8 * spark.sparkContext.defaultParallelism))
    schema = to_arrow_schema(READ)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        there, root = _place(folder)
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with there.open_input_file(f"{root}/data/{name}") as file:
                    reader = FileReader(file, dictionary)
                    numbers = np.arange(len(reader.keys)) if wanted is None else reader.find(wanted)
                    for part in _parts(numbers, reader.counts):
                        yield pa.RecordBatch.from_arrays([
                            pa.array(reader.keys[part], pa.int64(), mask=reader.nulls[part]),
                            pa.array(base + reader.starts[part], pa.int64()), pa.array(reader.counts[part], pa.int64()),
                            pa.array([ids.astype("<u4").tobytes() for ids in reader.documents(part)], pa.binary())], schema=schema)

    return files.select("file", "base").repartition(tasks).mapInArrow(read, READ)


def _parts(numbers: np.ndarray, counts: np.ndarray) -> Iterator[np.ndarray]:
    """``numbers`` in pieces of about ``READ_BYTES`` of ids."""
    if len(numbers):
        piece = np.cumsum(4 * counts[numbers]) // READ_BYTES
        yield from np.split(numbers, np.flatnonzero(np.diff(piece)) + 1)


def op13_token_files(documents: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, read back from the files."""
    import public_tokenizers

    spark = documents.sparkSession
    folder = new_folder(spark, "tokens")
    write_tokens(documents, folder, public_tokenizers.path("byte_bpe_50k.json"))
    return read_tokens(spark, folder).select(
        F.col("key").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
