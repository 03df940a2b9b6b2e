"""Spelling variants: near words and forms against brute force, tiles of many blocks, and edge cases."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from newsflow.llm import spelling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def is_near(a, b):
    """Whether one inserted, deleted or replaced code point makes one word of the other."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(counts, ratio=10):
    """Every word against every other one."""
    out, forms = {}, {}
    for word, n in counts.items():
        near = [(-m, other) for other, m in counts.items() if is_near(word, other)]
        best = min(near, default=None)
        if best and -best[0] >= ratio * n:
            forms[word] = best[1]
        out[word] = (n, len(near))
    def root(word):
        return root(forms[word]) if word in forms else word
    return {word: (forms.get(word), root(word), n, near, counts[forms[word]] if word in forms else None) for word, (n, near) in out.items()}


def variants(spark, counts, **options):
    df = spark.createDataFrame([(word, n, "x") for word, n in counts.items()], "word STRING, n INT, form STRING")
    rows = spelling.spelling_variants(df, **options).collect()
    assert len(rows) == len(counts)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


def vocabulary(rng, bases, alphabet, longest):
    words = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, longest))) for _ in range(bases)]
    for word in list(words):
        for _ in range(rng.randrange(6)):
            at, letter = rng.randint(0, len(word)), rng.choice(alphabet)
            word = rng.choice([word[:at] + word[at + 1:], word[:at] + letter + word[at:], word[:at] + letter + word[at + 1:]])
            words.append(word)
    return {word: rng.choice([2, 2, 3, 20, 30, 200, 2000, 20000]) for word in words}


@pytest.mark.parametrize("alphabet, longest", [("ab", 9), ("abcdé日😀", 7), ("abcdefghijkl", 20)])
def test_near_words_of_any_length(spark, alphabet, longest):
    counts = vocabulary(random.Random(longest), 120, alphabet, longest)
    assert variants(spark, counts) == plain_variants(counts)


def test_large_keys_are_cut_into_blocks(spark, monkeypatch):
    """One beginning and one end shared by most words, ties, and a chain of forms."""
    monkeypatch.setattr(spelling, "TILE_WORDS", 16)
    rng = random.Random(3)
    counts = {"common" + "".join(rng.choice("abcd") for _ in range(4)): rng.choice([2, 5, 50, 500]) for _ in range(300)}
    counts |= {"".join(rng.choice("xyz") for _ in range(4)) + "common": 7 for _ in range(60)}
    counts |= {"chained": 2, "chainee": 20, "chainef": 20, "chaineee": 200, "chaineeee": 2000, "chaineeeee": 20000}
    got = variants(spark, counts)
    assert got == plain_variants(counts)
    assert got["chained"][:2] == ("chainee", "chaineeeee")


def test_very_long_words(spark, monkeypatch):
    monkeypatch.setattr(spelling, "TILE_CELLS", 1 << 16)
    base = "ab" * 30_000
    counts = {base: 100, base[:5] + "x" + base[5:]: 2, base[:-1]: 3, base[:-2]: 4, base.replace("ab", "ba"): 5}
    assert variants(spark, counts) == plain_variants(counts)


def test_frequent_words_have_no_form_of_equal_weight(spark):
    with pytest.raises(ValueError):
        spelling.spelling_variants(spark.createDataFrame([("a", 1)], "word STRING, n INT"), ratio=1)


def plain_query(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            checksum = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if checksum % 31 == 0:
                at = checksum % len(run)
                run = run[:at] + run[at + 1:]
            counts[run] += 1
    return plain_variants({word: n for word, n in counts.items() if len(word) >= 7 and n >= 2})


def test_query_against_brute_force(spark):
    """Nulls, empty and long texts, capitals outside A-Z, repeated rows, clashing names, an empty table."""
    rng = random.Random(9)
    words = ["".join(rng.choice("aeéÉntrslÀ") for _ in range(rng.randint(5, 10))) for _ in range(40)]
    rows = [(None, None), (1, None), (2, ""), (3, "12 _ — 日本語"), (None, " ".join(words * 3))]
    rows += [(i, " ".join(rng.choice(words).capitalize() for _ in range(rng.randrange(80)))) for i in range(200)]
    rows += [rows[-1]] * 3 + [(500, "Straße-étendues " * 2000), (501, "x" * 50_000 + " " + "x" * 50_000)]
    df = spark.createDataFrame([(*row, 5, "y") for row in rows], "doc_id BIGINT, text STRING, n INT, Word STRING")
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in spelling.op11_spelling_variants(df).collect()}
    assert got == plain_query(rows) and any(form for form, *_ in got.values())
    empty = spelling.op11_spelling_variants(df.limit(0))
    assert empty.collect() == [] and dict(empty.dtypes) == {
        "word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}


def test_work_grows_with_tiles_not_pairs(spark):
    """Words that share no half with another are compared with none."""
    words = spark.range(2000).select(F.concat(F.substring(F.translate(F.sha2(F.col("id").cast("string"), 256), "0123456789", "ghijklmnop"), 1, 20)).alias("word"), F.lit(2).alias("n"))
    assert spelling.near_words(words).count() == 0
