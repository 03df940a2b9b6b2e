"""Token files: round trip against the tokenizer, random access, files of several sizes, and edge cases."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from newsflow.llm import tokens
from newsflow.session import new_folder

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id BIGINT, text STRING"
ROWS = [(7, "The quick brown fox"), (3, None), (5, ""), (-2, "  <|endoftext|> \n"), (5, "zwei"), (None, "no key"), (None, None),
        (9, "x" * 20_000), (4, "Ein Satz. " * 5_000), (3, "日本語 😀 é"), (7, "The quick brown fox"), (7, "The quick brown fox")]


def plain(rows, path=PATH, end=2):
    """(key, ids) in the order of the files; rows of one key by hash, which only the starts show."""
    tokenizer = Tokenizer.from_file(path)
    return [(key, tokenizer.encode(text or "", add_special_tokens=False).ids + ([] if end is None else [end])) for key, text in rows]


def read(spark, folder, keys=None):
    return sorted(((r["key"], r["start"], np.frombuffer(bytes(r["ids"]), "<u4").tolist()) for r in tokens.read_tokens(spark, folder, keys).collect()),
                  key=lambda row: row[1])


def check(found, rows, **options):
    """The same documents, keys ascending with nulls last, each starting where the one before ends."""
    expected = plain(rows, **options)
    assert sorted(((k, ids) for k, _, ids in found), key=str) == sorted(expected, key=str)
    assert [k for k, *_ in found] == sorted((k for k, _ in expected), key=lambda k: (k is None, k or 0))
    at = 0
    for _, start, ids in found:
        assert start == at
        at += len(ids)


def test_round_trip(spark):
    folder = new_folder(spark, "test")
    df = spark.createDataFrame([(*row, 1, "y") for row in ROWS], SCHEMA + ", start INT, `a.b` STRING")
    tokens.write_tokens(df.repartition(5), folder, PATH)
    found = read(spark, folder)
    check(found, ROWS)
    assert read(spark, folder, [7, 4, 100]) == [row for row in found if row[0] in (4, 7)]
    assert read(spark, folder, []) == []
    rows = tokens.read_tokens(spark, folder).collect()
    assert all(r["n_tokens"] * 4 == len(r["ids"]) for r in rows)


def test_query(spark):
    got = tokens.op13_token_files(spark.createDataFrame(ROWS, SCHEMA)).collect()
    expected = [(key, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for key, ids in plain(ROWS)]
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got), key=str) == sorted(expected, key=str)
    ordered = sorted(got, key=lambda r: r["start"])
    assert [r["start"] for r in ordered] == [0, *np.cumsum([r["n_tokens"] for r in ordered])[:-1]]


def test_empty_table_and_empty_texts(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert tokens.op13_token_files(df.limit(0)).collect() == []
    folder = new_folder(spark, "test")
    tokens.write_tokens(spark.createDataFrame([(1, None), (2, "")], SCHEMA), folder, PATH, end_id=None)
    assert read(spark, folder) == [(1, 0, []), (2, 0, [])]


def test_many_files_and_a_dictionary(spark, monkeypatch):
    monkeypatch.setattr(tokens, "FILE_BYTES", 2_000)
    monkeypatch.setattr(tokens, "READ_BYTES", 500)
    rows = [(i * 3 % 997, f"Document {i} about the state of the {i % 7} rivers, and more of it. " * (i % 5 + 1)) for i in range(600)]
    folder = new_folder(spark, "test")
    tokens.write_tokens(spark.createDataFrame(rows, SCHEMA), folder, PATH)
    found = read(spark, folder)
    check(found, rows)
    files = tokens.read_manifest(spark, folder).collect()
    assert len(files) > 3 and sum(f["documents"] for f in files) == 600
    assert [row[0] for row in read(spark, folder, [rows[5][0], rows[400][0]])] == sorted([rows[5][0], rows[400][0]])
    raw = sum(2 * len(ids) for *_, ids in found)
    assert sum(f["bytes"] for f in files) < raw / 3


def test_other_dictionary_is_refused(spark):
    folder = new_folder(spark, "test")
    tokens.write_tokens(spark.createDataFrame(ROWS, SCHEMA), folder, PATH)
    with open(f"{folder}/dictionary", "ab") as file:
        file.write(b"more")
    with pytest.raises(Exception, match="another dictionary"):
        tokens.read_tokens(spark, folder).collect()


def test_other_tokenizers(spark):
    """A tokenizer with other ids and no end of documents."""
    path = public_tokenizers.path("word_bpe_49k.json")
    folder = new_folder(spark, "test")
    tokens.write_tokens(spark.createDataFrame(ROWS, SCHEMA), folder, path, end_id=None)
    check(read(spark, folder), ROWS, path=path, end=None)


def test_parts_are_looked_up_once_and_lines_go_to_the_model(monkeypatch):
    """Equal parts of many texts cost one look at what is known; words on several lines are not given to the whole tokenizer."""
    tokenizer = Tokenizer.from_file(PATH)
    with open(PATH, "rb") as file:
        encoder = tokens.Encoder(file.read())
    texts = ["One two.\nThree, four\nFive", "One two.\nThree, four\nFive one", None, "", "Es é.\nÈé! ñ\nA"] * 50
    wanted = [tokenizer.encode(text or "", add_special_tokens=False).ids + [2] for text in texts]
    asked, whole = [], []
    ids_of, encode_whole = encoder._ids_of, encoder._whole
    monkeypatch.setattr(encoder, "_ids_of", lambda keys: asked.extend(keys) or ids_of(keys))
    monkeypatch.setattr(encoder, "_whole", lambda some: whole.extend(some) or encode_whole(some))
    assert [ids.tolist() for _, ids in tokens._encoded(encoder, pa.array(texts), 2)] == wanted
    later = [key for key in asked if key[:2] != "  "]
    assert len(later) == len(set(later)) and not any(whole)
    odd = ["", " ", "  ", None, " a", "a ", "a  b", "x\n\n y", "tab\t z", "日本 語 text", " 日本 x", "a\u3000b c", "é è", "\n", "a.\r\nb 1.\nA",
           "don't.\nIt's \n x", "it'\ns x'\nt", "a\n b\n", "\na", "a \U0001F600 b", "We\nre\n.a b.\n.c"]
    assert [ids.tolist() for _, ids in tokens._encoded(encoder, pa.array(odd), None)] == [
        tokenizer.encode(text or "", add_special_tokens=False).ids for text in odd]
    sliced = pa.array(["x y", *odd, "z"]).slice(1, len(odd))
    assert [ids.tolist() for _, ids in tokens._encoded(encoder, sliced, None)] == [
        tokenizer.encode(text or "", add_special_tokens=False).ids for text in odd]
