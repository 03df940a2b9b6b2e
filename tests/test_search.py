import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from newsflow import session
from newsflow.functions import encoders
from newsflow.functions.encoders import hashing_encoder
from newsflow.operators import evaluation, links, retrieval, topk
from newsflow.plans.search import retrieve, search_view
from newsflow.sources import files


def vectors(spark, matrix, name, vector="vector"):
    return spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(matrix)], f"{name} BIGINT, {vector} ARRAY<FLOAT>")


def brute_force(scores, k):
    """(query, id, score, rank) for a matrix of scores, NaN for no hit."""
    out = set()
    for q, row in enumerate(np.round(scores, topk.SCORE_DECIMALS)):
        order = sorted((-s, i) for i, s in enumerate(row) if not np.isnan(s))[:k]
        out |= {(q, i, round(-s, 6) + 0.0, rank) for rank, (s, i) in enumerate(order, 1)}
    return out


def found(df):
    return {(r["query_id"], r["id"], round(r["score"], 6) + 0.0, r["rank"]) for r in df.collect()}


@pytest.mark.parametrize("block", [32 << 20, 8 * 6 * 3])
def test_dense_topk(spark, monkeypatch, block):
    """Also in several query blocks, with ties and a zero vector."""
    monkeypatch.setattr(topk, "QUERY_BLOCK_BYTES", block)
    rng = np.random.default_rng(1)
    points = rng.normal(size=(300, 6)).astype(np.float32)
    points[100:150] = points[0]
    points[7] = 0
    queries = rng.normal(size=(11, 6)).astype(np.float32)
    queries[3] = points[0] * 2

    def unit(m):
        m = m.astype(float)
        n = np.linalg.norm(m, axis=1, keepdims=True)
        return np.divide(m, n, out=np.zeros_like(m), where=n > 0)

    hits = topk.dense_topk(vectors(spark, queries, "query_id"), vectors(spark, points, "id").repartition(5), 20)
    assert found(hits) == brute_force(unit(queries) @ unit(points).T, 20)


def test_dense_topk_tells_close_scores_apart(spark):
    """Points 1e-7 apart keep their order, though their ids would reverse it."""
    points = np.array([[1, 0.0005], [1, 0.0003], [1, 0]], dtype=float)
    hits = topk.dense_topk(vectors(spark, np.array([[1.0, 0]]), "query_id"), vectors(spark, points, "id"), 2)
    assert [(r["id"], r["rank"]) for r in hits.orderBy("rank").collect()] == [(2, 1), (1, 2)]


def test_topk_reads_points_once(spark, monkeypatch, folder):
    """Both sides and many query blocks take one scan; the driver sees counts only."""
    monkeypatch.setattr(topk, "QUERY_BLOCK_BYTES", 8 * 4 * 2)
    rng = np.random.default_rng(4)
    entries = F.expr("array(struct(CAST(id % 5 AS INT) AS id, 1D AS weight))")
    vectors(spark, rng.normal(size=(40, 4)), "id").withColumn("entries", entries).write.parquet(folder)
    queries = vectors(spark, rng.normal(size=(9, 4)), "query_id").withColumn(
        "entries", F.expr("array(struct(CAST(query_id % 5 AS INT) AS id, 1D AS weight))"))
    hits = topk.topk(queries, spark.read.parquet(folder), 3)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[0].count(folder.rsplit("/", 1)[1]) == 1
    assert hits.groupBy("side").count().collect().__len__() == 2 and hits.count() == 9 * 3 * 2


def test_one_block_is_searched_batch_by_batch(spark):
    """A single block comes with the first point of a task and meets the points of every later Arrow batch; nothing is packed before."""
    rng = np.random.default_rng(8)
    points, queries = rng.normal(size=(300, 4)), rng.normal(size=(6, 4))
    stored, asked = vectors(spark, points, "id").repartition(3), vectors(spark, queries, "query_id")
    with session.arrow_batches(spark, 7):
        hits = topk.dense_topk(asked, stored, 5)
        plan = hits._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert plan.count("MapInArrow") == 1 and "BroadcastHashJoin" in plan
        got = {(r["query_id"], r["rank"]): r["id"] for r in hits.collect()}
    unit = [rows.astype(np.float32).astype(float) for rows in (queries, points)]
    cosine = unit[0] @ (unit[1] / np.linalg.norm(unit[1], axis=1, keepdims=True)).T
    assert got == {(q, rank + 1): int(i) for q in range(6) for rank, i in enumerate(np.argsort(-cosine[q])[:5])}


def test_texts_are_folded_in_bounded_steps(monkeypatch):
    """A hundred texts of fifty tokens are not folded at once, and give the same vectors."""
    texts = pa.array([[f"w{i}-{j}" for j in range(50)] for i in range(100)] + [None, []])
    whole, held, numbers = encoders._folded(texts, 8), [], encoders._numbers
    monkeypatch.setattr(encoders, "_CELLS", 1000)
    monkeypatch.setattr(encoders, "_numbers", lambda tokens: held.append(len(tokens)) or numbers(tokens))
    assert encoders._folded(texts, 8).equals(whole)
    assert sum(held) == 5000 and max(held) <= 1000


def test_grid_deals_each_point_once(spark, monkeypatch, folder):
    """Twenty query blocks: the only exchange of the points holds a row per point, and a row per block and part."""
    monkeypatch.setattr(topk, "QUERY_BLOCK_BYTES", 8 * 4)
    monkeypatch.setattr(topk, "LEAST_PART_BYTES", 1000)
    rng = np.random.default_rng(5)
    points, queries = rng.normal(size=(200, 4)), rng.normal(size=(20, 4))
    vectors(spark, points, "id").write.parquet(folder)
    stored = spark.read.parquet(folder)
    seen = []
    dealt = topk._dealt
    monkeypatch.setattr(topk, "_dealt", lambda points, blocks, parts: seen.append((points, blocks, parts)) or dealt(points, blocks, parts))
    hits = topk.dense_topk(vectors(spark, queries, "query_id"), stored, 5)
    (held, blocks, parts), = seen
    full = blocks.count()
    assert 10 < full <= 20 and dealt(held, blocks, 3).filter("block IS NULL").count() == 200 and dealt(held, blocks, 3).count() == 200 + 3 * full
    plan = hits._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count(folder.rsplit("/", 1)[1]) == 1 and plan.count("Exchange hashpartitioning(part") == 1
    assert hits.count() == 100
    cosine = queries.astype(np.float32).astype(float) @ points.astype(np.float32).astype(float).T / np.linalg.norm(points, axis=1)
    assert {r["query_id"]: r["id"] for r in hits.filter("rank = 1").collect()} == {q: int(cosine[q].argmax()) for q in range(20)}


def test_pieces_that_cannot_reach_are_passed_over(monkeypatch):
    """Only postings of pieces that may hold one of the k best are read; the hits are those of all pieces."""
    rng = np.random.default_rng(6)
    read = []
    score = topk._Piece._score
    monkeypatch.setattr(topk._Piece, "_score", lambda self, query, value, place, best: read.append(int(self.count[place].sum())) or score(
        self, query, value, place, best))
    strengths = np.sort(rng.random(4000))[::-1] ** 4
    tokens = [rng.choice(30, size=6, replace=False) for _ in strengths]
    pieces = []
    for at in range(0, 4000, 200):
        rows = range(at, at + 200)
        token = np.concatenate([tokens[i] for i in rows])
        owner, order = np.repeat(np.arange(200), 6), np.argsort(token, kind="stable")
        pieces.append(topk._Piece(np.array(rows), None, owner[order], token[order], np.repeat(strengths[list(rows)], 6)[order]))
    row = {"query_ids": list(range(8)), "q_dense": None, "q_owner": np.repeat(np.arange(8), 3).tobytes(),
           "q_token": np.concatenate([rng.choice(30, size=3, replace=False) for _ in range(8)]).tobytes(), "q_weight": (rng.random(24) - 0.2).tobytes()}
    block = topk._Block(row, 10)
    for piece in pieces:
        block.search(piece)
    asked = [dict(zip(block.token[block.owner == q].tolist(), block.weight[block.owner == q])) for q in range(8)]
    expected = np.full((8, 4000), np.nan)
    for q in range(8):
        for i, held in enumerate(tokens):
            shared = [asked[q][t] * strengths[i] for t in held if t in asked[q]]
            if shared:
                expected[q, i] = sum(shared)
    best = block.best[topk.SPARSE]
    got = {(int(q), int(i), round(float(s), 9)) for q, s, i in zip(best.query, best.score, best.id)}
    assert got == {(q, i, round(float(s), 9)) for q, i, s, _ in [(q, i, expected[q, i], 0) for q, i, *_ in brute_force(expected, 10)]}
    touched = sum(len(pieces[0].owner) * 0 + int(np.isin(np.concatenate(tokens), block.token[block.owner == q]).sum()) for q in range(8))
    assert sum(read) < touched / 2


def test_dense_topk_rejects_other_widths(spark):
    with pytest.raises(Exception, match="every vector must have 2 values"):
        topk.dense_topk(vectors(spark, np.ones((1, 2)), "query_id"), vectors(spark, np.ones((4, 3)), "id")).collect()


@pytest.mark.parametrize("block, matches", [(32 << 20, 4 << 20), (200, 4 << 20), (500, 3)])
def test_sparse_topk(spark, monkeypatch, block, matches):
    monkeypatch.setattr(topk, "QUERY_BLOCK_BYTES", block)
    monkeypatch.setattr(topk, "_MATCHES", matches)
    monkeypatch.setattr(topk, "PIECE_ROWS", 30)
    rng = np.random.default_rng(2)

    def entries(n):
        return [[(int(t), float(w)) for t, w in zip(rng.choice(40, size=rng.integers(0, 9), replace=False), rng.random(9) + 0.1)]
                for _ in range(n)]

    points, queries = entries(200), entries(9)
    queries[4] = []
    kind = "ARRAY<STRUCT<id: INT, weight: DOUBLE>>"
    scores = np.full((9, 200), np.nan)
    for q, wanted in enumerate(queries):
        for p, held in enumerate(points):
            shared = [w * dict(held)[t] for t, w in wanted if t in dict(held)]
            if shared:
                scores[q, p] = sum(shared)
    hits = topk.sparse_topk(spark.createDataFrame(list(enumerate(queries)), f"query_id BIGINT, entries {kind}"),
                            spark.createDataFrame(list(enumerate(points)), f"id BIGINT, entries {kind}").repartition(3), 15)
    assert found(hits) == brute_force(scores, 15)


def ranked(spark, rows):
    return spark.createDataFrame([(q, i, s, n) for q, i, s, n in rows], "query_id BIGINT, id BIGINT, score DOUBLE, rank INT")


def test_fuse(spark):
    dense = ranked(spark, [(1, 1, 0.9, 1), (1, 2, 0.5, 2), (1, 3, 0.1, 3), (2, 1, 0.3, 1), (3, 5, 0.7, 1), (3, 6, 0.7, 2)])
    sparse = ranked(spark, [(1, 2, 8.0, 1), (1, 4, 4.0, 2), (3, 5, 2.0, 1), (4, 9, 3.0, 1), (4, 8, 1.0, 2)])
    hits = {(r["query_id"], r["id"]): (r["score"], r["rank"]) for r in retrieval.fuse(dense, sparse, 3).collect()}
    assert hits == {
        (1, 2): (0.75, 1), (1, 1): (0.5, 2), (1, 3): (0.0, 3),
        (2, 1): (0.3, 1), (3, 5): (1.35, 1), (3, 6): (0.35, 2), (4, 9): (3.0, 1), (4, 8): (1.0, 2)}


def corpus(spark):
    rows = [(1, "Giá vàng", "giá vàng tăng mạnh hôm nay", "https://d/1"), (2, "", "thời tiết hôm nay mưa", ""),
            (3, None, "bóng đá việt nam", None)]
    return spark.createDataFrame(rows, "id BIGINT, title STRING, content STRING, url STRING")


def test_answers(spark):
    queries = spark.createDataFrame([(1, "giá vàng hôm nay"), (2, "zzz")], "query_id BIGINT, text STRING")
    hits = ranked(spark, [(1, 2, 0.9, 1), (1, 1, 0.8, 2), (1, 3, 0.7, 3)])
    better = retrieval.rerank(retrieval.with_texts(retrieval.rerank_pool(hits, 2), queries, corpus(spark)))
    shown = retrieval.project_hits(better)
    rows = shown.orderBy("rank").collect()
    assert [(r["id"], r["title"], r["url"], r["score"]) for r in rows] == [("1", "Giá vàng", "https://d/1", 1.0), ("2", "No Title", "#", 0.5)]
    context = retrieval.format_context(shown).first()["context"]
    assert context == ("[1] Giá vàng: giá vàng tăng mạnh hôm nay\nSource: https://d/1\n\n"
                       "[2] No Title: thời tiết hôm nay mưa\nSource: #")
    prompt = retrieval.build_prompts(queries, retrieval.format_context(shown)).first()
    assert context in prompt["prompt"] and "giá vàng hôm nay" in prompt["prompt"]
    answers = spark.createDataFrame([(1, "Tăng.")], "query_id BIGINT, answer STRING")
    records = {r["query_id"]: r for r in retrieval.answer_records(queries, shown, answers).collect()}
    assert (records[1]["summary"], records[1]["total"], [h["id"] for h in records[1]["results"]]) == ("Tăng.", 2, ["1", "2"])
    assert (records[2]["summary"], records[2]["total"], records[2]["results"]) == (retrieval.NO_SOURCES, 0, [])


def test_rerank_with_a_plugged_in_scorer(spark):
    def factory():
        return lambda queries, texts: [float(len(t)) for t in texts]

    queries = spark.createDataFrame([(1, "x")], "query_id BIGINT, text STRING")
    hits = retrieval.with_texts(ranked(spark, [(1, 3, 0.9, 1), (1, 1, 0.8, 2)]), queries, corpus(spark))
    assert [r["id"] for r in retrieval.rerank(hits, 5, factory).orderBy("rank").collect()] == [1, 3]


def test_retrieve_from_stored_points(spark):
    from newsflow.functions import lexical
    from newsflow.functions.encoders import dense_vector

    stored = corpus(spark).select(
        F.col("id").cast("string").alias("id"), dense_vector(F.col("content"), hashing_encoder(32)).alias("dense"),
        F.map_from_entries(lexical.sparse_entries(F.col("content"))).alias("sparse"),
        F.struct(F.col("id").alias("article_id"), F.lit(0).alias("chunk_index"), "title", "url", "content",
                 F.lit("An").alias("authors"), F.lit(0).cast("bigint").alias("publish_timestamp")).alias("payload"))
    queries = spark.createDataFrame([(1, "giá vàng")], "query_id BIGINT, text STRING")
    result = retrieve(queries, search_view(stored), hashing_encoder(32))
    first = result.hits.orderBy("rank").first()
    assert first["id"] == "1" and first["metadata"]["authors"] == "An" and "title" not in first["metadata"]


PRECISION = [([1, 1, 0, 1, 1], 3.55 / (4 + 1e-10)), ([1] * 5, 5 / (5 + 1e-10)), ([0, 0], 0.0), ([0, 1], 0.5 / (1 + 1e-10))]


def test_context_precision(spark, monkeypatch):
    rows = [(q, n, v) for q, (verdicts, _) in enumerate(PRECISION) for n, v in enumerate(verdicts, 1)]
    table = spark.createDataFrame(rows, "q INT, rank INT, verdict INT")
    for block in (1024, 2):
        monkeypatch.setattr(evaluation, "_BLOCK", block)
        got = {r["q"]: r["context_precision"] for r in evaluation.context_precision(table, ["q"]).collect()}
        assert all(abs(got[q] - expected) < 1e-12 for q, (_, expected) in enumerate(PRECISION))
    assert round(PRECISION[0][1], 6) == 0.8875


def test_other_metrics(spark):
    rows = spark.sql("SELECT 1 AS q, array(1F, 0F) AS question_vector, array(1F, 0F) AS generated_vector, 0 AS noncommittal "
                     "UNION ALL SELECT 1, array(1F, 0F), array(0F, 1F), 0 UNION ALL SELECT 2, array(1F, 0F), array(1F, 0F), 1")
    assert {r[0]: r[1] for r in evaluation.answer_relevancy(rows, ["q"]).collect()} == {1: 0.5, 2: 0.0}
    scores = spark.sql("SELECT 'm' AS model, 0.5D AS faithfulness, double('nan') AS answer_relevancy, NULL AS context_precision, "
                       "1D AS context_recall UNION ALL SELECT 'm', NULL, 0.25D, 0.75D, 0D")
    row = evaluation.model_scoreboard(scores.withColumn("context_precision", F.col("context_precision").cast("double"))).first()
    assert tuple(row) == ("m", 0.5, 0.25, 0.75, 0.5)


def test_eval_records(spark):
    asked = spark.createDataFrame([(1, " q ", "\tt\n"), (2, "r", "u")], "query_id BIGINT, question STRING, ground_truth STRING")
    grid = evaluation.eval_grid(asked, ["a", "b"])
    hits = spark.createDataFrame([(1, 2, "second"), (1, 1, "first")], "query_id BIGINT, rank INT, content STRING")
    answers = spark.createDataFrame([("a", 1, "yes"), ("b", 1, "")], "model STRING, query_id BIGINT, answer STRING")
    rows = {(r["model"], r["query_id"]): r for r in evaluation.eval_records(grid, hits, answers).collect()}
    assert len(rows) == 4
    assert tuple(rows["a", 1])[2:] == ("q", "yes", ["first", "second"], "t")
    assert rows["b", 1]["answer"] == evaluation.NO_ANSWER and rows["a", 2]["contexts"] == []


def test_files(spark, folder):
    import os

    os.makedirs(f"{folder}/seeds")
    with open(f"{folder}/seeds/sites.json", "w") as f:
        f.write('["https://a/",\n {"url": "https://b/"}]')
    assert {r["url"] for r in files.read_seeds(spark, f"{folder}/seeds").collect()} == {"https://a/", "https://b/"}
    rows = [("Hỏi, \"gì\"?\ndòng hai", " đáp "), ("x", "a,b")]
    files.write_csv(spark.createDataFrame(rows, "question STRING, ground_truth STRING"), f"{folder}/set")
    assert sorted(map(tuple, files.read_testset(spark, f"{folder}/set").collect())) == sorted(rows)
    scores = spark.createDataFrame([("m", "q", ["c1", "c\n2"], 0.5), ("n", "q", [], None)],
                                   "model STRING, user_input STRING, retrieved_contexts ARRAY<STRING>, faithfulness DOUBLE")
    files.write_scores(scores, f"{folder}/scores")
    assert sorted(d for d in os.listdir(f"{folder}/scores") if d.startswith("model=")) == ["model=m", "model=n"]


def test_links_and_frontier(spark):
    def page(i, url, *hrefs):
        return i, url, "".join(f"<a class='x' href='{h}'>t</a>" for h in hrefs)

    pages = spark.createDataFrame([
        page(1, "https://d/", "/a", "mailto:x", "#top", "/n/1.html", "https://other/z", "tel:1", "javascript:f()"),
        page(2, "https://d/a", "b", "/", "/deep/er/path/x"), page(3, "https://d/b", "/c"), page(4, "https://d/c", "/e"),
        page(5, "https://d/e", "/f"), page(6, "https://d/f", "/g"), page(7, "https://d/n/1.html", "/hidden"),
    ], "page_id BIGINT, url STRING, html STRING")
    found = links.extract_links(pages)
    assert {(r["position"], r["dst_url"], r["kind"]) for r in found.filter("page_id = 1").collect()} == {
        (0, "https://d/a", "category"), (3, "https://d/n/1.html", "article")}
    seeds = spark.createDataFrame([("https://d/",)], "url STRING")
    depth = {r["url"]: r["depth"] for r in links.crawl_frontier(found, seeds).collect()}
    assert depth == {"https://d/": 0, "https://d/a": 1, "https://d/n/1.html": 1, "https://d/b": 2, "https://d/c": 3,
                     "https://d/e": 4, "https://d/f": 5}
