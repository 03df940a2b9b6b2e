"""Near-dedup, decontamination, top-k, line dedup, mixing and URL filters: edge cases and brute force."""

import math
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.compare import compare, connect
from newsflow.llm import contamination, lines, mixing, neardup, topk, urls
from newsflow.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
ODD_TEXTS = [None, "", " \n\t ", "!!!", "a", "a", "word " * 30_000, "x" * 100_000, None, "", "日本語 текст"]


def documents(spark, rows, **columns):
    df = spark.createDataFrame(rows, "doc_id BIGINT, source STRING, text STRING")
    return df.withColumns({name: F.lit(value) for name, value in columns.items()})


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, name):
    line = compare(spark, connect(SF_DIR), SF_DIR, name, QUERIES[name], ORACLES[name])
    assert "  ok" in line, line


# Near-dedup


def words(rng, n):
    return [f"w{i}" for i in rng.integers(0, 5000, size=n)]


def plain_similar(a, b):
    """Order-aware similarity of five-word shingles by the full alignment table."""
    def shingles(text):
        w = re.findall(r"\w+", text.lower())
        return [tuple(w[i:i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else []
    x, y = shingles(a), shingles(b)
    if not x or not y:
        return a == b
    row = [0] * (len(y) + 1)
    for p in x:
        new = [0]
        for j, q in enumerate(y, 1):
            new.append(row[j - 1] + 1 if p == q else max(row[j], new[-1]))
        row = new
    return row[-1] >= 0.8 * (len(x) + len(y) - row[-1]) - 1e-9


def test_classes_match_brute_force(spark):
    rng = np.random.default_rng(11)
    texts = []
    for _ in range(25):
        base = words(rng, int(rng.integers(3, 160)))
        texts.append(" ".join(base))
        for _ in range(rng.integers(0, 4)):
            other = list(base)
            for _ in range(rng.integers(0, 5)):
                kind, at = rng.integers(0, 3), int(rng.integers(0, max(1, len(other))))
                if kind == 0 and other:
                    other[at % len(other)] = "new%d" % rng.integers(0, 999)
                elif kind == 1 and len(other) > 1:
                    del other[at % len(other)]
                else:
                    other.insert(at, "ins%d" % rng.integers(0, 999))
            texts.append(" ".join(other))
    passage = " ".join(words(rng, 60))
    texts += [" ".join(words(rng, 80)) + " " + passage for _ in range(12)]
    rows = [(i, "s", t) for i, t in enumerate(texts)]
    got = {r["doc_id"]: r["class_id"] for r in neardup.op2_near_dedup(documents(spark, rows, class_id="clash")).collect()}
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if plain_similar(texts[i], texts[j]):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    assert got == {i: find(i) for i in range(len(texts))}


def test_similarity_is_that_of_the_full_alignment():
    import pyarrow as pa

    rng = np.random.default_rng(5)
    for _ in range(200):
        a = words(rng, int(rng.integers(1, 60)))
        b = list(a)
        for _ in range(rng.integers(0, 6)):
            at = int(rng.integers(0, len(b) + 1))
            b[at:at + int(rng.integers(0, 3))] = words(rng, int(rng.integers(0, 3)))
        one, two = (neardup._tokens(pa.array([" ".join(x)]))[0].as_py() for x in (a, b))
        if a and b:
            assert neardup.similar(one, two) == plain_similar(" ".join(a), " ".join(b))


def test_sketches_see_order():
    rng = np.random.default_rng(2)
    bounds = np.array([0, 40, 80])
    shingles = np.unique(rng.integers(0, 1 << 60, size=80).astype(np.uint64))[:40]
    same = np.concatenate([shingles, shingles])
    turned = np.concatenate([shingles, shingles[::-1]])
    one, two = neardup.sketch(same, bounds), neardup.sketch(turned, bounds)
    assert (one[0] == one[1]).all() and (two[0] != two[1]).any()


def test_large_groups_and_unlike_texts_with_a_shared_passage(spark, monkeypatch):
    """Many near copies, and buckets of more than one block."""
    monkeypatch.setattr(neardup, "BLOCK", 16)
    rng = np.random.default_rng(8)
    base, passage = words(rng, 120), " ".join(words(rng, 40))
    near = [" ".join(base[:60] + [f"n{i}"] + base[60:]) for i in range(150)]
    unlike = [passage + " " + " ".join(words(rng, 15)) for _ in range(60)]
    twins = [unlike[7] + " extra", unlike[31] + " extra"]
    rows = [(i, "s", t) for i, t in enumerate(near + unlike + twins)]
    got = {r["doc_id"]: r["class_id"] for r in neardup.op2_near_dedup(documents(spark, rows)).collect()}
    assert all(got[i] == 0 for i in range(150))
    expected = {i: i for i in range(150, 210)} | {210: 157, 211: 181}
    linked = [(i, j) for i in range(60) for j in range(i) if plain_similar(unlike[i], unlike[j])]
    assert not linked and {i: got[i] for i in range(150, 212)} == expected


def test_near_dedup_of_odd_texts(spark):
    rows = [(i, "s", t) for i, t in enumerate(ODD_TEXTS)] + [(None, "s", "a"), (0, "s", None), (4, "s", "a")]
    docs = documents(spark, rows, node="clash", row_key="clash", id="clash")
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["class_id"]) for r in neardup.op2_near_dedup(docs).collect())
    classes = {(n, i): c for n, i, c in got}
    assert len(got) == len(rows)
    assert classes[(False, 5)] == 4 and classes[(True, 0)] == 4 and classes[(False, 9)] == 1
    assert classes[(False, 0)] == 0 and classes[(False, 8)] == 8 and classes[(False, 3)] == 3
    kept = neardup.near_dedup(docs)
    assert kept.columns == docs.columns
    found = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    assert max(found.values()) == 1 and (4, "a") in found and (5, "a") not in found and (None, "a") not in found
    assert {(0, None), (8, None), (1, ""), (2, " \n\t ")} <= set(found) and (9, "") not in found
    assert neardup.op2_near_dedup(docs.limit(0)).collect() == [] and neardup.near_dedup(docs.limit(0)).collect() == []


# Decontamination

ITEMS = [
    (0, "If a train leaves Paris at 9 and travels 120 km in 2 hours, how fast does it go on average between stops?"),
    (1, "the small brown fox was seen near the old wooden bridge over the quiet river at dawn"),
    (2, "short one"), (3, None), (4, ""), (5, "In which year did Ada Lovelace meet the inventor of the engine for the first time?"),
]


def found_items(spark, texts, items=ITEMS):
    docs = documents(spark, [(i, "s", t) for i, t in enumerate(texts)], row_key="clash", id="clash", item_id="clash")
    bench = spark.createDataFrame(items, "item_id BIGINT, text STRING").withColumn("doc_id", F.lit("clash"))
    return {(r["doc_id"], r["item_id"]): r["rewritten"] for r in contamination.op3_decontamination(docs, bench).collect()}


def test_templates_are_found(spark):
    fox = ITEMS[1][1]
    texts = [
        "Some text before. " + ITEMS[0][1] + " And more.",
        "if a train leaves Berlin at 11 and travels 350 km in 5 hours, how fast does it go on average between stops?",
        "A train travels fast on average between stops in Paris.",
        fox.upper(), fox.replace(" ", "\n"), "unlike text with nothing of the sort in it at all",
        "Short one", "a short one here", None, "", "word " * 20_000 + fox,
        "In which year did Grace Hopper meet the inventor of the engine for the first time?",
        "the small brown fox was seen near the old wooden bridge",
    ]
    got = found_items(spark, texts)
    assert got == {(0, 0): False, (1, 0): True, (3, 1): False, (4, 1): False, (6, 2): False, (10, 1): False, (11, 5): True, (12, 1): False}


def test_slots_have_to_be_consistent(spark):
    item = [(0, "add 3 apples to 3 pears and then count 3 more plums in the wide basket")]
    texts = ["add 7 apples to 7 pears and then count 7 more plums in the wide basket",
             "add 7 apples to 8 pears and then count 9 more plums in the wide basket"]
    assert found_items(spark, texts, item) == {(0, 0): True}


def test_whole_passages_by_brute_force(spark):
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["op3_decontamination"](spark, SF_DIR).collect()}
    texts = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()
    flat = lambda t: " " + " ".join(re.findall(r"\w+", (t or "").lower())) + " "
    wanted = {(d["doc_id"], i["item_id"]) for d in texts for i in items if flat(i["text"]) in flat(d["text"])}
    assert wanted and got == wanted


def test_decontamination_keeps_the_rest(spark):
    docs = documents(spark, [(1, "s", ITEMS[1][1]), (1, "s", "other text"), (2, None, None), (3, "s", "")], row_key="clash")
    bench = spark.createDataFrame(ITEMS, "item_id BIGINT, text STRING")
    kept = contamination.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["text"] or "") for r in kept.collect()) == [(1, "other text"), (2, ""), (3, "")]
    assert contamination.decontaminate(docs, bench.limit(0)).count() == 4
    assert contamination.decontaminate(docs.limit(0), bench).count() == 0


# Top-k


def plain_top(rows, k):
    usable = {}
    for i, (key, vector) in enumerate(rows):
        if key is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            usable[i] = (key, [math.floor(1024 * float(np.float32(x))) for x in vector])
    out = []
    for query, own in {(q, tuple(v)) for q, v in usable.values() if q % 100 == 0}:
        scored = sorted((-sum(a * b for a, b in zip(own, v)), key) for key, v in usable.values() if key != query)
        out += [(query, rank, key, -score) for rank, (score, key) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("block_rows,query_rows", [(1 << 14, 256), (70, 2)])
def test_topk_by_brute_force(spark, block_rows, query_rows):
    rng = np.random.default_rng(6)
    rows = [(int(i), [float(x) for x in rng.normal(size=12)]) for i in range(420)]
    rows[10:30] = [(i, rows[0][1]) for i in range(10, 30)]
    rows[300] = (300, [0.0] * 12)
    rows[301:305] = [(301, None), (302, [None] * 12), (303, [float("nan")] * 12), (304, [float("inf")] * 12)]
    rows += [(None, rows[1][1]), (5, rows[5][1]), (100, rows[100][1]), (500, rows[7][1][:5]), (501, [])]
    df = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<FLOAT>").withColumn("id", F.lit("clash"))
    usable = df.filter(F.col("vec_id").isNotNull() & topk.usable(F.col("embedding"))).select(
        F.col("vec_id").alias("id"), topk.scaled(F.col("embedding")).alias("vector"))
    got = topk.top_k(usable, usable.filter("id % 100 = 0"), 10, block_rows, query_rows)
    assert sorted((r["query_id"], r["rank"], r["id"], r["score"]) for r in got.collect()) == plain_top(rows, 10)


def test_sliced_sums_are_exact():
    rng = np.random.default_rng(1)
    values = rng.integers(-400, 400, size=(150, 5))
    block = topk.SlicedBlock(values, slices=20)
    for _ in range(20):
        query = rng.integers(-300, 300, size=5)
        sums = block.coarse(query.tolist())
        total = sum(np.unpackbits(s.view(np.uint8), bitorder="little").astype(np.int64) << p for p, s in enumerate(sums))[:150]
        exact = values @ query
        assert len(set((total - exact).tolist())) == 1
        rows, scores = block.top(query, np.arange(150), -1, 7)
        assert scores.tolist() == sorted(exact.tolist(), reverse=True)[:7]


def test_topk_of_nothing(spark):
    df = spark.createDataFrame([(1, [1.0])], "vec_id BIGINT, embedding ARRAY<FLOAT>")
    assert topk.op4_topk(df).collect() == [] and topk.op4_topk(df.limit(0)).collect() == []
    assert topk.op4_topk(df.withColumn("vec_id", F.lit(100).cast("bigint"))).collect() == []


# Line dedup


def test_line_dedup_of_odd_texts(spark):
    rows = [(i, "a", f"Menu\nown {i}\n\n Menu \nx") for i in range(5)] + [(5, "b", "Menu"), (6, None, "Menu"), (7, "a", None), (8, "a", "")]
    rows += [(9, "b", "same\npage")] * 5 + [(10, "b", "Menu\n" + "long " * 50_000)]
    docs = documents(spark, rows, host_key="clash", line_keys="clash")
    kept = lines.drop_boilerplate(docs, ratio=0.5)
    assert kept.columns == docs.columns
    text = defaultdict(list)
    for r in kept.collect():
        text[r["doc_id"]].append(r["text"])
    assert text[0] == ["own 0\n"] and text[5] == ["Menu"] and text[6] == ["Menu"] and text[7] == [None] and text[8] == [""]
    assert text[9] == ["same\npage"] * 5 and text[10][0].startswith("Menu\nlong")
    counted = {r["doc_id"]: (r["n_lines"], r["dropped_lines"]) for r in lines.drop_boilerplate(docs, ratio=0.5, counts=True).collect()}
    assert counted[0] == (5, 3) and counted[7] == (0, 0) and counted[8] == (1, 0)
    assert lines.drop_boilerplate(docs.limit(0)).collect() == []


def test_line_dedup_sql_on_odd_texts(spark, folder):
    rows = [(i, "a" if i % 3 else None, f"Menu\n own {i}\r\n\nfoot") for i in range(30)] + [(99, "a", None), (98, "a", "")]
    docs = documents(spark, rows)
    docs.write.parquet(folder)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/*.parquet')")
    got = sorted(map(repr, map(tuple, lines.op5_line_dedup(docs).select("doc_id", "dropped_lines", "n_lines", "text").collect())))
    want = sorted(map(repr, con.execute(f"SELECT doc_id, dropped_lines, n_lines, text FROM ({lines.OP5_SQL})").fetchall()))
    assert got == want


# Mixing


def plain_targets(sizes):
    """Share out, stop at the cap and share the excess again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, open_, out = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        above = [s for s in open_ if left * weight[s] / total >= 2 * sizes[s]]
        if not above:
            return out | {s: left * weight[s] / total for s in open_}
        for s in above:
            out[s] = 2.0 * sizes[s]
            open_.remove(s)
        left -= sum(out[s] for s in above)
    return out


@pytest.mark.parametrize("block_words", [50, 1 << 14])
def test_mix_meets_its_targets(spark, block_words):
    rng = np.random.default_rng(4)
    rows = [(i, ["é", "b", "a", None, "big", "tiny"][min(5, int(rng.integers(0, 12)) % 6)] if i % 3 else "big",
             " ".join(["w"] * int(rng.integers(0, 40)))) for i in range(900)]
    rows += [(1000, "empty", ""), (1001, "empty", None), (1002, "tiny", "\t a\x0bb\u00a0c ")]
    docs = documents(spark, rows, size="clash", row="clash", plan="clash", source_key="clash")
    made = mixing.mix(docs.repartition(5), block_words=block_words)
    got = {r["doc_id"]: r for r in made.collect()}
    again = {r["doc_id"]: r for r in mixing.mix(docs.repartition(3), block_words=block_words).collect()}
    assert {k: (r["taken"], r["shards"]) for k, r in got.items()} == {k: (r["taken"], r["shards"]) for k, r in again.items()}
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, _, t in rows}
    by_source = defaultdict(int)
    for i, s, _ in rows:
        by_source[s] += size[i]
    targets = plain_targets(dict(by_source))
    taken = defaultdict(int)
    for i, s, _ in rows:
        r = got[i]
        assert r["size"] == size[i] and r["source_size"] == by_source[s] and abs(r["target"] - targets[s]) < 1e-6
        assert r["taken"] == r["copies"] * size[i] <= 2 * size[i] and len(r["shards"]) == r["copies"]
        taken[s] += r["taken"]
    assert all(abs(taken[s] - targets[s]) <= 40 for s in by_source)


def test_copies_of_a_row_are_taken_one_by_one(spark, monkeypatch):
    """A source that is mostly copies of one row meets its target within one text, whatever the partitions."""
    monkeypatch.setattr(mixing, "COPY_PARTS", 7)
    rows = [(7, "a", "w " * 100)] * 1000 + [(i, "a", "v " * 100) for i in range(100, 200)] + [(None, "b", None)] * 3
    rows += [(i, "b", "u " * 100) for i in range(1000, 1400)] + [(9, "b", "t " * 50)] * 2 + [(3000, "c", "s")]
    for parts in (1, 6):
        made = mixing.mix(documents(spark, rows, copy_part="clash", repeated="clash").repartition(parts))
        got = made.collect()
        assert len(got) == len(rows) and made.columns[:5] == ["doc_id", "source", "text", "copy_part", "repeated"]
        for source in "abc":
            here = [r for r in got if r["source"] == source]
            assert abs(sum(r["taken"] for r in here) - here[0]["target"]) <= 100
            assert sum(r["size"] for r in here) == here[0]["source_size"] and all(r["copies"] <= 2 for r in here)
        counted = Counter((r["doc_id"], r["copies"]) for r in got)
        assert counted[7, 0] + counted[7, 1] + counted[7, 2] == 1000
        first = counted if parts == 1 else first
        assert counted == first


def test_quotas_are_split_exactly(spark):
    quotas = [0, 1, 37, 500, 3, 1000]
    one = spark.createDataFrame([(quotas,)], "quotas ARRAY<BIGINT>")
    shards = [r["quotas"] for r in mixing.split_quotas(one, 8).collect()]
    assert len(shards) == 8 and [sum(x) for x in zip(*shards)] == quotas
    sizes = [sum(s) for s in shards]
    assert max(sizes) - min(sizes) <= 3 and min(min(s) for s in shards) >= 0


def test_draws_follow_the_hypergeometric_distribution(spark):
    draw = mixing.hypergeometric("12L", "5L", "6L", "(id + 0.5D) / 4000D")
    counts = Counter(r[0] for r in spark.range(4000).select(F.expr(draw)).collect())
    exact = {x: math.comb(5, x) * math.comb(7, 6 - x) / math.comb(12, 6) for x in range(6)}
    assert all(abs(counts[x] / 4000 - exact[x]) < 2e-3 for x in range(6))


def test_mixture_has_a_row_per_copy(spark):
    docs = documents(spark, [(i, "ab"[i % 2], "one two three") for i in range(40)], shard="clash", position="clash")
    made = mixing.mix(docs)
    assert mixing.mixture(docs).count() == made.agg(F.sum("copies")).first()[0] == 60
    assert mixing.mix(docs.limit(0)).collect() == [] and mixing.mixture(docs.limit(0)).collect() == []


# URL filters


def plain_verdict(url, rules, default):
    if url is None or "://" not in url:
        return "", "", None, default
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[2:] if fits else (None, default)))


URLS = [None, "", "no scheme", "http://", "https://EXAMPLE.net", "https://example.net/", "http://a.b.example.net/en/x?y#z", "http://net/",
        "http://xnet/", "http://.net/", "x://y://net/a", "http://a.org/fr/", "http://a.org/fr", "http://example.com?/de/", "http://b.example.com/de/1",
        "http://É.org/fr/x", "http://example.org:80/fr/", "http://user@m.example.com/de/", "http://a.net/\nen", "://net/x", "http://net/en/" + "p" * 50_000]


def test_url_verdicts(spark):
    rules = [*urls.RULES, ("example.net", "/en/x", "block"), ("b.example.net", "/e", "block")]
    pages = spark.createDataFrame(list(enumerate(URLS)) + [(0, "http://net/")], "page_id BIGINT, url STRING").withColumn("host", F.lit("clash"))
    rows = urls.filter_urls(pages, rules).collect()
    assert len(rows) == len(URLS) + 1
    for r in rows:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == plain_verdict(r["url"], rules, "allow"), r["url"]
    assert urls.op10_url_filters(pages.limit(0)).collect() == []
    assert {r["verdict"] for r in urls.filter_urls(pages, []).collect()} == {"allow"}


def test_colliding_digests_are_confirmed(monkeypatch):
    monkeypatch.setattr(urls.xxhash, "xxh64_intdigest", lambda key: len(key) % 3)
    index = urls.DigestIndex(urls.DigestIndex.build([(h, "/", h) for h in ("aa.b", "ab.b", "ac.b", "a.bcd")]))
    found, verdicts = index.judge(["x.ab.b", "ad.b", "a.bcd", ""], ["/", "/q", "/", ""])
    assert found == ["ab.b/", None, "a.bcd/", None] and verdicts == ["ab.b", None, "a.bcd", None]


def test_too_many_rules_are_refused(spark, monkeypatch):
    monkeypatch.setattr(urls, "MAX_INDEX_BYTES", 10)
    with pytest.raises(ValueError):
        urls.filter_urls(spark.createDataFrame([(1, "x")], "page_id BIGINT, url STRING"))


def test_items_poor_in_words_are_found(spark):
    items = [(0, "A train travels 60 km in 2 hours and 30 minutes"), (1, "3 + 4 * 12 - 5 + 81 * 7 - 6 + 19 * 2"), (2, "Is 7 + 5 less than 13")]
    texts = ["Before that. " + items[0][1] + ". After it.", "A train travels 80 km in 3 hours and 15 minutes",
             "We saw " + items[1][1] + " there", "We saw 1 + 4 * 12 - 5 + 80 * 7 - 3 + 19 * 2 there", items[2][1],
             "It was 60 km in 2 hours by bus and 10 km in 30 minutes on foot"]
    assert found_items(spark, texts, items) == {(0, 0): False, (1, 0): True, (2, 1): False, (4, 2): False}


def test_short_items_are_found_inside_of_texts(spark):
    items = [(0, "who wrote the long letters"), (1, "why"), (2, "Is 7 + 5 less than 13"), (3, "今天天气怎么样呢朋友们")]
    texts = ["first this, then who wrote the long letters, and more of it after that one", "nobody knows why it is so late in the day today",
             "we asked: is 7 + 5 less than 13, or is it not as large as that", "we asked: is 8 + 5 less than 14, or is it not as large",
             "问 今天天气怎么样呢朋友们 答 很好", "why", "who wrote the longer letters to all of them in that year", "letters"]
    assert found_items(spark, texts, items) == {(0, 0): False, (2, 2): False, (4, 3): False, (5, 1): False}


def test_an_edited_number_leaves_the_verbatim_windows(spark):
    item = "take 2 cups of flour and 2 eggs from the box and stir them in a deep bowl for a while then bake it with 2 sticks of butter"
    texts = [item.replace("2 sticks", "3 sticks"), item.replace("2", "4"), item]
    assert found_items(spark, texts, [(0, item)]) == {(0, 0): False, (1, 0): True, (2, 0): False}


def test_one_sketch_is_enough_in_buckets_of_any_size(spark):
    import pyarrow as pa

    run = [f"w{i}" for i in range(40)]
    tokens = neardup._tokens(pa.array([" ".join(run), " ".join([*run, "more"]), " ".join(run[:20])])).to_pylist()
    sketches = [[100 * i + j if j != 3 else 7 for j in range(16)] for i in range(3)]
    nodes = [b"a", b"b", b"c"]
    for n in (3, 10 * neardup.BLOCK):
        members = spark.createDataFrame([(7, 3, x, x, n) for x in nodes], "key BIGINT, used INT, node BINARY, root BINARY, n BIGINT")
        reps = spark.createDataFrame(list(zip(nodes, sketches)), "node BINARY, sketches ARRAY<BIGINT>")
        runs = spark.createDataFrame(list(zip(nodes, tokens)), "node BINARY, tokens BINARY")
        links = neardup._open_links(members, reps, runs, neardup.SIMILARITY).collect()
        assert [{bytes(r["a"]), bytes(r["b"])} for r in links] == [{b"a", b"b"}]
