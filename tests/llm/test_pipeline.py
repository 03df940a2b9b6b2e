"""The pipeline's stages take effect one after the other, each as brute force says."""

import re
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from newsflow.llm import quality
from newsflow.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def flat(text):
    return " " + " ".join(re.findall(r"\w+", (text or "").lower())) + " "


def shingles(text):
    w = flat(text).split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or {tuple(w)}


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    seen = [docs]
    for number, (name, function) in enumerate(corpus_pipeline.STAGES):
        function(spark, seen[-1], SF_DIR).write.parquet(f"{folder}/{number}")
        seen.append(spark.read.parquet(f"{folder}/{number}"))
        if number < len(corpus_pipeline.STAGES) - 1:
            assert seen[-1].columns == docs.columns, name
    rows = [{r["doc_id"]: r for r in df.collect()} for df in seen[:-1]]
    all_, good, clean, single, held = rows

    scores = quality.op6_quality(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet")).collect()
    assert set(good) == {r["doc_id"] for r in scores if r["predicted"]}

    assert set(clean) == set(good)
    pages = {}
    for r in good.values():
        pages.setdefault(r["source"], set()).add(r["text"])
    for r in good.values():
        total = len(pages[r["source"]])
        n = Counter(line for t in pages[r["source"]] for line in {x.strip(" \t\r") for x in t.split("\n")} if line)
        kept = [x for x in r["text"].split("\n") if not (n[x.strip(" \t\r")] >= 3 and n[x.strip(" \t\r")] > total * 0.01)]
        assert clean[r["doc_id"]]["text"] == "\n".join(kept) and clean[r["doc_id"]]["n_chars"] == len("\n".join(kept))

    ids = sorted(clean)
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = {i: shingles(clean[i]["text"]) for i in ids}
    for a, i in enumerate(ids):
        for j in ids[:a]:
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    assert set(single) == {find(i) for i in ids}

    items = [flat(r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    assert set(held) == {i for i, r in single.items() if not any(item in flat(r["text"]) for item in items)}

    mixed = seen[-1].groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.max("target").alias("t")).collect()
    assert {r["doc_id"] for r in mixed} <= set(held) and max(r["n"] for r in mixed) <= 2
    assert {"shard", "position", *docs.columns} <= set(seen[-1].columns)


def test_run_gives_the_last_stage(spark):
    assert corpus_pipeline.run(spark, SF_DIR).count() > 0


def test_an_empty_corpus_passes_through(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, function in corpus_pipeline.STAGES:
        out = function(spark, docs, SF_DIR)
        assert out.collect() == []


def test_every_operator_has_a_query():
    assert sorted({int(re.match(r"op(\d+)_", name).group(1)) for name in QUERIES}) == list(range(1, 14))
