"""Periodic runs: Lyndon arrays, runs and the query against brute force, and edge cases."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from newsflow.llm import runs

SCHEMA = "doc_id BIGINT, text STRING"


def plain_lyndon(word):
    """The longest stretch from each place that is smaller than all its proper suffixes."""
    return [max(end - at for end in range(at + 1, len(word) + 1)
                if all(word[at:end] < word[k:end] for k in range(at + 1, end))) for at in range(len(word))]


def plain_runs(word, exponent, length):
    """Every maximal stretch of every period, without those that have a smaller one."""
    found = []
    for period in range(1, len(word) // exponent + 1):
        at = 0
        while at + period < len(word):
            start = at
            while at + period < len(word) and word[at] == word[at + period]:
                at += 1
            size = at + period - start
            if size >= max(length, exponent * period) and not any(
                    word[start:start + size - p] == word[start + p:start + size] for p in range(1, period)):
                found.append((start, size, period))
            at = max(at, start + 1)
    return sorted(found, key=lambda run: (run[0], run[2]))


def sequences(count, longest):
    rng = random.Random(4)
    for _ in range(count):
        word = [rng.randrange(rng.choice([1, 2, 3, 5])) for _ in range(rng.randint(0, longest))]
        for _ in range(rng.randrange(3) if len(word) > 4 else 0):
            at, period = rng.randrange(len(word)), rng.randint(1, 7)
            word = [x if i < at else word[at + (i - at) % period] if at + period <= len(word) else x for i, x in enumerate(word)]
        yield word


def test_lyndon_array():
    for word in sequences(400, 14):
        assert runs.lyndon_lengths(np.array(word, dtype=int)).tolist() == plain_lyndon(word), word


@pytest.mark.parametrize("exponent, length", [(2, 2), (3, 2), (4, 6)])
def test_runs_are_those_of_brute_force(exponent, length):
    for word in sequences(400, 60):
        assert runs.find_runs(np.array(word, dtype=int), exponent, length) == plain_runs(word, exponent, length), word


def test_texts_are_cut_without_loss():
    words = [[b"w%d" % x for x in word] for word in sequences(300, 80)]
    assert runs.runs_of_texts(words) == [plain_runs(word, 4, 6) for word in words]


def test_equal_sums_of_unlike_words(monkeypatch):
    """Where all sums are equal, runs are read word by word."""
    monkeypatch.setattr(runs.Extensions, "_equal", lambda self, one, two, size: np.ones(len(one), dtype=bool))
    word = [7, 8, *[0, 1, 2] * 5, 9, 9]
    assert runs.find_runs(np.array(word)) == [(2, 15, 3)]


def test_long_texts():
    assert runs.find_runs(np.zeros(50_000, dtype=int)) == [(0, 50_000, 1)]
    assert runs.find_runs(np.tile(np.random.default_rng(1).integers(0, 300, 5000), 4)) == [(0, 20_000, 5000)]


def digests(doc_id, text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    checksum = zlib.crc32(str("" if doc_id is None else doc_id).encode())
    number, n = checksum // 10, len(words)
    if checksum % 10 == 0 and n:
        start = number % n
        period = 1 + (n - start) // (3 + number % 8)
        words = [x if i < start else words[start + (i - start) % period] for i, x in enumerate(words)]
    found = plain_runs(words, 4, 6)
    best = min(found, key=lambda run: (-Fraction(run[1], run[2]), run[0], run[2]), default=(None, None, None))
    gone = {at for start, size, period in found for at in range(start + period, start + size)}
    lines = "".join("%d,%d,%d\n" % run for run in found)
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(b" ".join(x for i, x in enumerate(words) if i not in gone)).hexdigest())


def test_query_against_brute_force(spark):
    """Nulls, blanks, all ASCII white space and a blank that is none, repeated rows, ties, texts with a repeated tail, clashing names."""
    rng = random.Random(2)
    rows = [(None, None), (None, "a a a a a a b"), (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "x y " * 7), (4, "x y " * 7),
            (5, "a b " * 4 + "c " + "d e " * 4), (6, "é ü " * 6), (7, "x" * 100_000), (8, "a\x1cb\x85 " * 6)]
    tails = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 10 == 0][:60]
    rows += [(i, " ".join(rng.choice(["of", "the", f"w{rng.randrange(9)}"]) for _ in range(rng.randrange(120)))) for i in [*tails, *range(100, 140)]]
    df = spark.createDataFrame([(*row, 0, "clash") for row in rows], SCHEMA + ", n_words INT, Runs STRING")
    got = [tuple(row) for row in runs.op12_periodic_runs(df).collect()]
    assert sorted(got, key=str) == sorted([digests(*row) for row in rows], key=str)
    assert runs.op12_periodic_runs(df.limit(0)).collect() == []


def test_operator_keeps_rows_and_columns(spark):
    df = spark.createDataFrame([(1, "a  b a b a b a b c", "k", 1), (1, "a  b a b a b a b c", "k", 1), (2, None, None, None)],
                               "doc_id BIGINT, body STRING, `x.y` STRING, RUNS INT")
    got = runs.periodic_runs(df, "body").orderBy("doc_id").collect()
    assert got[0] == got[1] and got[0].asDict(recursive=True) == {
        "doc_id": 1, "body": "a  b a b a b a b c", "x.y": "k", "runs": [{"start": 0, "length": 8, "period": 2}], "n_words": 9,
        "collapsed": "a b c"}
    assert got[2]["runs"] == [] and got[2]["n_words"] == 0 and got[2]["collapsed"] == "" and got[2]["body"] is None
