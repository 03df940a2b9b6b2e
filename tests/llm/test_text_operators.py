"""Language ID, quality, toxicity and LM scoring: edge cases, brute force and held-out accuracy."""

import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from newsflow.llm import langid, lmscore, quality, toxicity
from newsflow.llm.queries import QUERIES
from newsflow.llm.spans import split_words, text_slices, windows, word_keys

SF_DIR = "/root/testdata/sf0.001"
ODD_TEXTS = [None, "", " \n\t ", "!!! ... 123", "a", "word " * 30_000, "x" * 200_000, "é" * 3, "日本語 текст ελληνικά", "a\x00b", "😀"]


def documents(spark, texts, **columns):
    rows = [(i, t, "en" if i % 2 else "de") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING")
    return df.withColumns({name: F.lit(value) for name, value in columns.items()})


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id BIGINT, quality INT, toxic INT")


def crc(i):
    return zlib.crc32(str(i).encode())


# Words


@pytest.mark.parametrize("text", ["", "one two", "A1b2 c-d_e", "naïve café ÉTÉ", "“quoted” – dash…", "日本。語", "x\u00a0y ½ ª", "end."])
def test_words_match_a_plain_split(text):
    words = split_words(pa.array([text]))
    signs = r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f\u0080-\u00a9\u00ab-\u00b4\u00b6-\u00b9\u00bb-\u00bf\u2000-\u2bff\u3000-\u303f\U0001f000-\U0001ffff]+"
    assert [words.text(i) for i in range(len(words.start))] == [w for w in re.split(signs, text.lower()) if w]


def test_word_keys_depend_on_the_word_alone():
    texts = pa.array(["alpha beta", "beta " + "y" * 100, "", "alpha " + "y" * 100 + " " + "y" * 99 + "z"])
    words = split_words(texts)
    keys = word_keys(words)
    by_word = {}
    for i, key in enumerate(keys.tolist()):
        by_word.setdefault(words.text(i), set()).add(key)
    assert all(len(found) == 1 for found in by_word.values()) and len(set(keys.tolist())) == len(by_word)
    shingles, bounds = windows(keys, words.bounds, 2)
    assert np.diff(bounds).tolist() == [1, 1, 0, 2] and len(set(shingles.tolist())) == 4
    assert [len(part) for _, part in text_slices(texts, 8)] == [1, 1, 2] or sum(len(p) for _, p in text_slices(texts, 8)) == 4


# Language ID


def plain_path(scores, penalty):
    """The best path by the textbook recurrence."""
    n, kinds = scores.shape
    best, back = scores[0].astype(np.float64), []
    for t in range(1, n):
        moves = best[:, None] - penalty * (1 - np.eye(kinds))
        back.append(moves.argmax(axis=0))
        best = moves.max(axis=0) + scores[t]
    path = [int(best.argmax())]
    for step in reversed(back):
        path.append(int(step[path[-1]]))
    return path[::-1], float(best.max())


def test_paths_are_the_best_ones():
    rng = np.random.default_rng(3)
    sizes = [0, 1, 7, 30, 30, 2, 0]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    scores = -rng.random((bounds[-1], 4)).astype(np.float32) * 4
    path = langid.best_paths(scores, bounds, 1.5)
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b > a:
            expected, value = plain_path(scores[a:b].astype(np.float64), 1.5)
            own = path[a:b]
            got = scores[a:b][np.arange(b - a), own].sum() - 1.5 * (own[1:] != own[:-1]).sum()
            assert abs(got - value) < 1e-3


def test_spans_of_mixed_text():
    model = langid.LanguageModel.of({
        "en": langid.gram_counts(pa.array(["the cat and the dog of this house with that thing " * 20])),
        "de": langid.gram_counts(pa.array(["der hund und die katze aus diesem haus mit jenem ding " * 20])),
        "ru": langid.gram_counts(pa.array(["кошка и собака из этого дома " * 20]))})
    text = "the dog and the cat of that house. der hund und die katze mit diesem ding! кошка и собака"
    found = langid.spans(text, model)
    assert [kind for *_, kind in found] == ["en", "de", "ru"]
    assert text[found[1][0]:found[1][1]].startswith("der hund") and found[-1][1] == len(text)


def test_language_of_odd_texts(spark):
    known = ["the cat and the dog of this house", "der hund und die katze aus diesem haus"] * 40
    docs = documents(spark, known + ODD_TEXTS, lang_pred="clash", score=7.0, key="clash")
    rows = {r["doc_id"]: r for r in langid.op1_language_id(docs).collect()}
    assert len(rows) == len(known) + len(ODD_TEXTS)
    for i, text in enumerate(ODD_TEXTS, len(known)):
        blank = text is None or not any(c.isalpha() for c in text)
        assert (rows[i]["lang_pred"] == "und") == blank and 0 <= rows[i]["score"] <= 1
        assert rows[i]["held_out"] == (crc(i) % 4 == 2)
    wide = langid.identify(docs, langid.train(docs))
    assert set(wide.columns) == {"doc_id", "text", "lang", "key", "lang_pred", "score"}


def test_language_without_training_rows_or_rows(spark):
    docs = documents(spark, ["text"]).withColumn("lang", F.lit(None).cast("string"))
    assert [(r["lang_pred"], r["score"]) for r in langid.op1_language_id(docs).collect()] == [("und", 0.0)]
    assert langid.op1_language_id(docs.limit(0)).collect() == []


def test_language_held_out_accuracy(spark):
    rows = QUERIES["op1_language_id"](spark, SF_DIR).join(
        spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in rows) >= 0.95 * len(rows)


# Quality


def test_discriminant_matches_the_densities():
    rng = np.random.default_rng(0)
    width = len(quality.STATISTICS)
    cov = np.diag(rng.random(width) + 0.5)
    model = quality.Discriminant([np.zeros(width), np.ones(width)], [np.linalg.cholesky(cov)] * 2,
                                 [float(np.log(np.diag(np.linalg.cholesky(cov))).sum())] * 2, [np.log(0.25), np.log(0.75)])
    x = rng.normal(size=(5, width))
    zero, one = (np.exp(-0.5 * ((x - m) @ np.linalg.inv(cov) * (x - m)).sum(axis=1)) * p for m, p in ((0, 0.25), (1, 0.75)))
    assert np.allclose(model.score(x), one / (zero + one), atol=1e-8)


def test_quality_of_odd_texts(spark):
    good = [f"A plain sentence about thing {i}, and another one. It goes on for a while." for i in range(60)]
    bad = ["### %%% $$$ &&& *** " * (3 + i % 5) for i in range(60)]
    docs = documents(spark, good + bad + ODD_TEXTS, score=5.0, quality="clash", label="clash", key="clash")
    marks = labels(spark, [(i, int(i < 60), 0) for i in range(120)] + [(None, 1, 1), (3, None, None), (500, 1, 0), (0, 0, 0)])
    rows = {r["doc_id"]: r for r in quality.op6_quality(docs, marks).collect()}
    assert len(rows) == 120 + len(ODD_TEXTS) and all(0 <= r["score"] <= 1 for r in rows.values())
    assert all(r["predicted"] == int(r["score"] >= 0.3) and r["held_out"] == (crc(i) % 5 == 0) for i, r in rows.items())
    assert sum(rows[i]["predicted"] == int(i < 60) for i in range(120)) >= 115
    kept = quality.quality_filter(docs, marks)
    assert kept.columns == docs.columns and kept.filter("doc_id < 60").count() >= 57


def test_quality_without_labels_or_rows(spark):
    docs = documents(spark, ["a", None])
    none = labels(spark, [(0, 1, 0)])
    assert [r["score"] for r in quality.op6_quality(docs, none).collect()] == [1.0, 1.0]
    assert quality.op6_quality(docs.limit(0), none.limit(0)).collect() == []
    assert quality.quality_filter(docs, none.limit(0)).count() == 2


def test_repeated_rows_score_alike(spark):
    docs = documents(spark, ["same text here"] * 3).union(documents(spark, ["same text here"] * 3))
    marks = labels(spark, [(i, i % 2, i % 2) for i in range(3)] * 2)
    for query in (quality.op6_quality, toxicity.op8_toxicity, lmscore.op7_lm_scoring):
        assert len({r["score"] for r in query(docs, marks).collect()}) == 1


# Toxicity


def reference_weight(kinds, weights):
    """The grammar spelled out, one reading direction."""
    total, insult, threat, near, negation, said = 0.0, False, 0, 0, 0, False
    for kind, weight in zip(kinds, weights):
        factor = (0.3 if negation else 1) * (0.5 if said else 1)
        if kind == toxicity.INSULT:
            total += weight * factor * (1.25 if insult else 1) * (1.5 if near else 1)
        if kind == toxicity.TARGET and threat:
            total += toxicity.THREAT_WEIGHT * factor
        insult = kind == toxicity.INSULT
        threat = 3 if kind == toxicity.THREAT else 0 if kind == toxicity.TARGET else max(0, threat - 1)
        near = 4 if kind == toxicity.TARGET else max(0, near - 1)
        negation = 3 if kind == toxicity.NEGATION else max(0, negation - 1)
        said = said or kind == toxicity.REPORT
    return total


def test_composed_machine_matches_the_grammar():
    rng = np.random.default_rng(7)
    for _ in range(500):
        kinds = rng.choice(6, size=rng.integers(1, 12)).tolist()
        weights = [2.0 if k == toxicity.INSULT else 0.0 for k in kinds]
        assert abs(toxicity._run(kinds, weights) - reference_weight(kinds, weights)) < 1e-9


def test_clauses_are_read_as_wholes():
    words = split_words(pa.array(["fool"]))
    stems = toxicity.Stems(toxicity.stem_keys(words)[0][1], np.array([2.0]))

    def weight(text):
        return round(sum(x[3] for x in toxicity.matched_clauses(pa.array([text]), stems)[1]), 6)

    assert weight("a foolish thing") == 2.0 and weight("a thing. No more") == 0
    assert weight("you fool") == 3.0 and weight("fool, you") == 3.0
    assert weight("not a fool") == 0.6 and weight("she said fool") == 1.5
    assert weight("not here. fool") == 2.0
    assert weight("I will kill you") == toxicity.THREAT_WEIGHT and weight("I will kill time") == 0


def test_toxicity_of_odd_texts(spark):
    toxic = [f"thing {i} is a moron and more" for i in range(60)]
    clean = [f"thing {i} is a marvel and more" for i in range(60)]
    docs = documents(spark, toxic + clean + ODD_TEXTS, score=5.0, toxic="clash", label="clash")
    marks = labels(spark, [(i, 1, int(i < 60)) for i in range(120)] + [(None, 1, 1), (3, None, None)])
    rows = {r["doc_id"]: r for r in toxicity.op8_toxicity(docs, marks).collect()}
    assert len(rows) == 120 + len(ODD_TEXTS) and all(0 <= r["score"] <= 1 for r in rows.values())
    assert all(rows[i]["predicted"] == int(i < 60) for i in range(120))
    assert all(rows[i]["predicted"] == 0 for i in range(120, len(rows)))


def test_toxicity_without_labels_or_rows(spark):
    docs = documents(spark, ["a", None])
    assert [r["score"] for r in toxicity.op8_toxicity(docs, labels(spark, [(0, 1, 0)])).collect()] == [0.0, 0.0]
    assert toxicity.op8_toxicity(docs.limit(0), labels(spark, []).limit(0)).collect() == []


# LM scoring


def plain_losses(texts, target, models):
    """Losses counted and added up token by token."""
    def cells(text):
        word, context, pair, _ = lmscore._cells(pa.array([text or ""]))
        return list(zip(word.tolist(), context.tolist(), pair.tolist()))

    counts = [{}, {}]
    for text, hit in zip(texts, target):
        if text is None:
            continue
        for word, _, pair in cells(text):
            for model in (0, 1) if hit else (0,):
                for cell in (word, pair):
                    counts[model][cell] = counts[model].get(cell, 0) + 1
    out = []
    for text in texts:
        sums = [0.0, 0.0]
        for word, context, pair in cells(text):
            for model in (0, 1):
                own = counts[model]
                total = sum(n for cell, n in own.items() if cell < lmscore.WORD_CELLS)
                single = (own.get(word, 0) + lmscore.SMOOTHING) / (total + lmscore.SMOOTHING * lmscore.WORD_CELLS)
                pairs = own.get(pair, 0)
                sums[model] -= np.log((pairs + lmscore.BACKOFF * single) / (max(own.get(context, 0), pairs) + lmscore.BACKOFF))
        n = max(1, len(cells(text)))
        out.append((len(cells(text)), sums[1] / n, sums[0] / n))
    return out


def test_losses_match_plain_counting(spark):
    texts = ["the cat sat on the mat", "the dog sat", "a b a b a b", None, "", "!!", "the cat"] * 2
    docs = documents(spark, texts, tokens="clash", score="clash", good="clash", target="clash").repartition(3)
    marks = labels(spark, [(0, 1, 0), (2, 0, 0), (5, 1, 0), (None, 1, 0), (0, 1, 1)])
    rows = {r["doc_id"]: r for r in lmscore.op7_lm_scoring(docs, marks).collect()}
    expected = plain_losses(texts, [i in (0, 5) for i in range(len(texts))], None)
    for i, (tokens, target, background) in enumerate(expected):
        assert rows[i]["tokens"] == tokens
        assert abs(rows[i]["target_loss"] - target) < 1e-4 and abs(rows[i]["background_loss"] - background) < 1e-4
        assert abs(rows[i]["score"] - (target - background)) < 2e-4


def test_lm_scores_of_odd_texts(spark):
    docs = documents(spark, ODD_TEXTS)
    rows = lmscore.op7_lm_scoring(docs, labels(spark, [])).collect()
    assert len(rows) == len(ODD_TEXTS) and all(np.isfinite(r["score"]) for r in rows)
    assert lmscore.op7_lm_scoring(docs.limit(0), labels(spark, [])).collect() == []


def test_lm_tables_pack_and_unpack():
    values = np.zeros(lmscore.CHUNK, dtype=np.int64)
    values[[0, 5, lmscore.CHUNK - 1]] = [1, 300, 1 << 40]
    place, n = lmscore._unpacked(lmscore._packed(values))
    assert place.tolist() == [0, 5, lmscore.CHUNK - 1] and n.tolist() == [1, 300, 1 << 40]


def test_words_and_bigrams_are_counted_apart(spark):
    """Counts by strings, over more words and bigrams than a small table of cells keeps apart."""
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 6000, size=600)) for _ in range(40)]
    marks = labels(spark, [(i, 1, 0) for i in range(0, 40, 3)])
    rows = {r["doc_id"]: r for r in lmscore.op7_lm_scoring(documents(spark, texts), marks).collect()}
    single, pairs = [{}, {}], [{}, {}]
    for i, text in enumerate(texts):
        split = text.split()
        for model in (0, 1) if i % 3 == 0 else (0,):
            for context, word in zip([None, *split], split):
                single[model][word] = single[model].get(word, 0) + 1
                pairs[model][context, word] = pairs[model].get((context, word), 0) + 1
    for i, text in enumerate(texts):
        split = text.split()
        for model, name in enumerate(("background_loss", "target_loss")):
            loss, total = 0.0, sum(single[model].values())
            for context, word in zip([None, *split], split):
                chance = (single[model].get(word, 0) + lmscore.SMOOTHING) / (total + lmscore.SMOOTHING * lmscore.WORD_CELLS)
                both = pairs[model].get((context, word), 0)
                loss -= np.log((both + lmscore.BACKOFF * chance) / (
                    (both if context is None else single[model].get(context, 0)) + lmscore.BACKOFF))
            assert abs(rows[i][name] - loss / len(split)) < 1e-7
