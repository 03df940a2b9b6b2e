import json

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from newsflow.operators.keys import assign_keys, new_keys
from newsflow.operators import joins
from newsflow.operators.etl import texts_of, title_winners
from newsflow.operators.ingest import ingest_batch
from newsflow.operators.joins import lookup, numbered_rows
from newsflow.plans import etl, reports
from newsflow.plans.etl import run_etl
from newsflow.plans.vectorize import vectorize
from newsflow.schemas import WAREHOUSE_TABLES
from newsflow.sources.warehouse import LOG, OUTCOMES, POINTS, REPLACED, Warehouse


def raw(spark, *items):
    """Raw table rows from (url, title, message)."""
    rows = [(url, title, message if isinstance(message, str) else json.dumps(message, ensure_ascii=False))
            for url, title, message in items]
    return spark.createDataFrame(rows, "url STRING, title STRING, content STRING").select(
        F.sha2("url", 256).alias("url_hash"), "url", "title", "content",
        F.lit("a").alias("author"), F.lit("Unknown").alias("publish_date"))


GOOD = {"author": "An, Bo", "publish_date": "2024-03-01 10:00:00", "content": "Một. Hai."}


def loaded(warehouse):
    return {t: sorted(map(tuple, warehouse.table(t).drop("load_id").collect()), key=repr) for t in WAREHOUSE_TABLES}


def test_load_states(spark, warehouse):
    warehouse.init_metadata()
    warehouse.append_metadata(raw(
        spark, ("https://d/1", "one", GOOD), ("https://d/2", "two", {**GOOD, "author": "Unknown"}),
        ("https://d/3", "three", {**GOOD, "publish_date": None}), ("https://d/4", "four", "{bad"),
        ("https://d/5", "five", {**GOOD, "author": ["Lan", "", "Lan"]}), ("https://d/6", "six", {**GOOD, "author": 7}),
        ("https://d/7", "seven", {**GOOD, "publish_date": "soon"}), ("d8", "eight", {**GOOD, "content": None}),
        ("https://d/9", "nine", {**GOOD, "author": []}), ("https://d/10", "ten", {**GOOD, "author": "0"}),
        ("https://d/11", "eleven", "[1]")))
    summary = run_etl(warehouse).first().asDict()
    assert summary == {"found": 11, "loaded": 5, "skipped": 3, "errors": 3}
    facts = {r["title"]: r for r in warehouse.table("fact_articles").collect()}
    assert set(facts) == {"one", "five", "seven", "eight", "ten"}
    assert facts["seven"]["time_id"] == 0 and facts["eight"]["content_length"] == 0
    names = warehouse.table("fact_article_authors").join(warehouse.table("dim_author"), "author_id").join(
        warehouse.table("fact_articles").select("article_id", "title"), "article_id")
    found = {}
    for r in names.collect():
        found.setdefault(r["title"], set()).add(r["author_name"])
    assert found["five"] == {"Lan", "Unknown"} and found["one"] == {"An", "Bo"} and found["ten"] == {"0"}
    assert {r["domain"] for r in warehouse.table("dim_source").collect()} == {"d", "d8"}
    assert all(r["repeated"] == 0 for r in reports.key_violations(warehouse).collect())


def test_second_run_changes_nothing_and_new_rows_follow_on(spark, warehouse):
    warehouse.init_metadata()
    warehouse.append_metadata(raw(spark, ("https://d/1", "one", GOOD), ("https://d/2", "one", GOOD)))
    assert run_etl(warehouse).first()["loaded"] == 1
    before = loaded(warehouse)
    warehouse.append_metadata(raw(spark, ("https://e/3", "three", {**GOOD, "author": "Bo, Cy"})))
    assert run_etl(warehouse).first().asDict() == {"found": 2, "loaded": 2, "skipped": 0, "errors": 0}
    after = loaded(warehouse)
    assert all(set(before[t]) <= set(after[t]) for t in WAREHOUSE_TABLES)
    assert [r[1] for r in sorted(after["dim_author"])] == ["An", "Bo", "Cy"]
    assert run_etl(warehouse).first()["found"] == 0
    assert loaded(warehouse) == after
    assert all(r["repeated"] == 0 for r in reports.key_violations(warehouse).collect())


def test_a_load_that_died_is_repeated(spark, warehouse):
    warehouse.init_metadata()
    warehouse.append_metadata(raw(spark, ("https://d/1", "one", GOOD)))
    warehouse.init_warehouse()
    load = warehouse.next_load()
    spark_rows = spark.createDataFrame([(1, 1, 0, "half")], "chunk_id BIGINT, article_id BIGINT, chunk_index INT, content STRING")
    warehouse.write_load("fact_chunks", spark_rows, load)
    warehouse.write_load("dim_author", spark.createDataFrame([(1, "half")], "author_id BIGINT, author_name STRING"), load)
    run_etl(warehouse)
    assert [r["content"] for r in warehouse.table("fact_chunks").collect()] == ["Một. Hai."]
    assert {r["author_name"] for r in warehouse.table("dim_author").collect()} == {"An", "Bo"}


def test_reset_truncate_and_drop(spark, warehouse):
    warehouse.init_metadata()
    warehouse.append_metadata(raw(spark, ("https://d/1", "one", GOOD)))
    run_etl(warehouse)
    vectorize(warehouse)
    assert warehouse.points_dim() == 1024
    warehouse.truncate_all()
    assert all(warehouse.table(t).isEmpty() for t in ("article_metadata", *WAREHOUSE_TABLES))
    warehouse.append_metadata(raw(spark, ("https://d/1", "one", GOOD)))
    run_etl(warehouse)
    assert warehouse.table("fact_articles").first()["article_id"] == 1
    warehouse.reset_metadata()
    assert warehouse.table("article_metadata").isEmpty()
    warehouse.drop_points()
    assert not spark.catalog.tableExists(f"{warehouse.database}.{POINTS}")


def test_bucketed_tables_join_without_shuffle(spark, folder):
    warehouse = Warehouse(spark, "bucketed_" + folder[-8:], folder, buckets=4)
    warehouse.init_metadata()
    warehouse.append_metadata(raw(spark, *[(f"https://d/{i}", f"t{i}", GOOD) for i in range(40)]))
    run_etl(warehouse)
    vectorize(warehouse)
    assert warehouse.table(POINTS).count() == 40
    joined = warehouse.table("fact_articles").hint("merge").join(
        warehouse.table("article_metadata").select("url_hash", "url"), "url_hash")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 40 and "Exchange" not in plan


def test_vectorize_is_incremental(spark, warehouse):
    warehouse.init_metadata()
    warehouse.append_metadata(raw(spark, ("https://d/1", "one", GOOD)))
    run_etl(warehouse)
    warehouse.init_points(16)
    vectorize(warehouse)
    first = warehouse.table(POINTS).collect()
    vectorize(warehouse)
    assert warehouse.table(POINTS).collect() == first
    point = first[0]
    assert len(point["dense"]) == 16 and point["payload"]["authors"] == "An, Bo"
    assert point["payload"]["publish_timestamp"] == 1709251200
    assert abs(sum(x * x for x in point["dense"]) - 1) < 1e-5
    changed = warehouse.table(POINTS).withColumn("payload", F.col("payload").withField("title", F.lit("new")))
    other = changed.withColumn("id", F.lit("other"))
    warehouse.upsert_points(changed.unionByName(other))
    assert {(r["id"], r["payload"]["title"]) for r in warehouse.table(POINTS).collect()} == {(point["id"], "new"), ("other", "new")}
    with pytest.raises(ValueError):
        warehouse.upsert_points(changed.withColumn("dense", F.array(F.lit(1.0).cast("float"))))


def some_points(spark, ids, title="t", dim=4):
    return spark.createDataFrame([(i,) for i in ids], "id STRING").select(
        "id", F.array_repeat(F.lit(0.5).cast("float"), dim).alias("dense"), F.create_map(F.lit(1), F.lit(1.0).cast("float")).alias("sparse"),
        F.struct(F.lit(1).cast("bigint").alias("article_id"), F.lit(0).alias("chunk_index"), F.lit(title).alias("title"), F.lit("u").alias("url"),
                 F.lit("c").alias("content"), F.lit("a").alias("authors"), F.lit(0).cast("bigint").alias("publish_timestamp")).alias("payload"))


def test_upsert_writes_its_own_rows_and_compaction_changes_nothing(spark, warehouse):
    """Points replaced once, twice, and after a compaction; new ones among them."""
    warehouse.init_points(4)
    warehouse.append_points(some_points(spark, [f"p{i}" for i in range(1000)]))

    def shown():
        rows = warehouse.table(POINTS).select("id", "payload.title").collect()
        assert len({r["id"] for r in rows}) == len(rows)
        return {r["id"]: r["title"] for r in rows}

    def written():
        return warehouse.table(LOG).count(), warehouse.table(REPLACED).count()

    expected = {f"p{i}": "t" for i in range(1000)}
    for title, start in (("one", 968), ("two", 980), ("three", 960)):
        before = written()
        ids = [f"p{i}" for i in range(start, start + 64)]
        warehouse.upsert_points(some_points(spark, ids, title))
        expected |= dict.fromkeys(ids, title)
        assert written() == (before[0] + 64, before[1] + 64) and shown() == expected
        if title == "two":
            warehouse.compact_points()
            assert written() == (len(expected), 0) and shown() == expected
    warehouse.append_points(some_points(spark, ["late"]))
    assert shown() == expected | {"late": "t"}
    warehouse.compact_points()
    assert written() == (len(expected) + 1, 0) and shown() == expected | {"late": "t"}


def test_writes_are_seen_whole_or_not_at_all(spark, warehouse):
    """A write or a compaction that died before its commit shows nothing, and is overwritten by the next one."""
    warehouse.init_points(4)
    warehouse.append_points(some_points(spark, ["a", "b"]))
    warehouse._write_partition(LOG, some_points(spark, ["a", "x", "y"], "half"), 2)
    assert sorted(r["id"] for r in warehouse.table(POINTS).collect()) == ["a", "b"]
    warehouse.upsert_points(some_points(spark, ["b"], "new"))
    assert sorted((r["id"], r["payload"]["title"]) for r in warehouse.table(POINTS).collect()) == [("a", "t"), ("b", "new")]
    with pytest.raises(Exception, match="4 dense values"):
        warehouse.append_points(some_points(spark, ["c"], dim=3))
    assert warehouse.table(POINTS).count() == 2


def test_vectorize_reads_later_loads_only(spark, warehouse):
    warehouse.init_metadata()
    warehouse.append_metadata(raw(spark, ("https://d/1", "one", GOOD)))
    run_etl(warehouse)
    warehouse.init_points(16)
    vectorize(warehouse)
    assert warehouse.points_loads() == 1 and warehouse.table(LOG).count() == 1
    read = warehouse.table
    vectorize(warehouse)
    assert read(LOG).count() == 1
    warehouse.append_metadata(raw(spark, ("https://d/2", "two", GOOD)))
    run_etl(warehouse)
    vectorize(warehouse)
    assert warehouse.points_loads() == 2 and read(POINTS).count() == 2
    # a run that died between its points and the record repeats nothing
    warehouse.mark_loads(0)
    vectorize(warehouse)
    assert read(POINTS).count() == 2 and warehouse.points_loads() == 2


def test_rejected_articles_are_counted_but_not_read_again(spark, warehouse, monkeypatch):
    """A second load over a day with rejected rows reads no content; their outcomes stand in for them."""
    from newsflow.plans import etl as plan

    warehouse.init_metadata()
    warehouse.append_metadata(raw(spark, ("https://d/1", "one", GOOD), ("https://d/2", "two", {**GOOD, "author": "Unknown"}),
                                  ("https://d/3", "three", "{bad")))
    read = []
    texts_of = plan.texts_of
    monkeypatch.setattr(plan, "texts_of", lambda *args: read.append(texts_of(*args).select("content").collect()) or texts_of(*args))
    assert run_etl(warehouse).first().asDict() == {"found": 3, "loaded": 1, "skipped": 1, "errors": 1}
    assert {(r["title"], r["state"]) for r in warehouse.table(OUTCOMES).collect()} == {
        ("one", "loaded"), ("two", "skipped"), ("three", "error")}
    assert run_etl(warehouse).first().asDict() == {"found": 2, "loaded": 0, "skipped": 1, "errors": 1}
    assert [len(rows) for rows in read] == [3, 0]
    warehouse.append_metadata(raw(spark, ("https://d/4", "four", GOOD), ("https://d/5", "two", GOOD)))
    assert run_etl(warehouse).first()["found"] in (3, 4) and len(read[-1]) in (1, 2)
    assert {r["title"] for r in warehouse.table("fact_articles").collect()} >= {"one", "four"}


def test_facts_without_outcomes_are_not_loaded_again(spark, warehouse):
    """A load died behind its facts: its articles are known by these, and get their outcomes with the next load."""
    warehouse.init_metadata()
    warehouse.append_metadata(raw(spark, ("https://d/1", "one", GOOD), ("https://d/2", "two", GOOD)))
    run_etl(warehouse)
    spark.sql(f"TRUNCATE TABLE {warehouse.name(OUTCOMES)}")
    assert run_etl(warehouse).first()["found"] == 0
    assert warehouse.table("fact_articles").count() == 2
    assert {(r["title"], r["state"]) for r in warehouse.table(OUTCOMES).collect()} == {("one", "loaded"), ("two", "loaded")}
    assert run_etl(warehouse).first()["found"] == 0


def test_metrics_round_half_to_even(spark, warehouse):
    warehouse.init_metadata()
    warehouse.init_warehouse()
    empty = reports.warehouse_metrics(warehouse).first()
    assert (empty["articles"], empty["chunks_per_article"]) == (0, 0.0)
    facts = spark.range(8).select(F.col("id").alias("article_id"), F.col("id").cast("string").alias("url_hash"),
                                  F.lit("t").alias("title"), F.lit(1).alias("source_id"), F.lit(1).alias("time_id"),
                                  F.lit(1).alias("content_id"), F.lit(1).alias("content_length"))
    warehouse.write_load("fact_articles", facts, 1)
    warehouse.write_load("fact_chunks", spark.createDataFrame([(1, 1, 0, "x")], "chunk_id BIGINT, article_id BIGINT, "
                                                              "chunk_index INT, content STRING"), 1)
    assert reports.warehouse_metrics(warehouse).first()["chunks_per_article"] == 0.12


def test_assign_keys_are_dense_and_ordered(spark):
    names = spark.range(0, 5000, 1, 7).select(F.sha2(F.col("id").cast("string"), 256).alias("name"))
    found = sorted(assign_keys(names, "name", "k", 10).collect())
    assert [r["k"] for r in found] == list(range(11, 5011))
    table = spark.createDataFrame([(4, found[0]["name"])], "k BIGINT, name STRING")
    fresh = new_keys(names.union(names), table, "name", "k")
    assert sorted(r["k"] for r in fresh.collect()) == list(range(5, 5004))


def test_latest_articles_widens_its_range(spark, warehouse):
    warehouse.init_metadata()
    warehouse.init_warehouse()
    facts = spark.range(1, 1001).select(F.col("id").alias("article_id"), F.col("id").cast("string").alias("url_hash"),
                                        F.concat(F.lit("t"), "id").alias("title"), F.lit(1).alias("source_id"),
                                        F.lit(1).alias("time_id"), "id", F.lit(1).alias("content_length"))
    warehouse.write_load("fact_articles", facts.withColumnRenamed("id", "content_id"), 1)
    warehouse.write_load("dim_author", spark.sql("SELECT 1L AS author_id, 'B' AS author_name UNION ALL SELECT 2, 'A'"), 1)
    few = spark.sql("SELECT explode(array(3L, 7L, 900L)) AS article_id").crossJoin(spark.sql("SELECT explode(array(1L, 2L)) AS author_id"))
    warehouse.write_load("fact_article_authors", few, 1)
    rows = reports.latest_articles(warehouse, 2).collect()
    assert [(r["article_id"], r["authors"]) for r in rows] == [(900, "A & B"), (7, "A & B")]
    assert len(reports.latest_articles(warehouse).collect()) == 3


def test_small_dimensions_are_broadcast(spark, warehouse):
    warehouse.init_metadata()
    warehouse.append_metadata(raw(spark, ("https://d/1", "one", GOOD)))
    run_etl(warehouse)
    joined = lookup(warehouse.table("fact_articles"), warehouse.table("dim_time").select("time_id", "date"), "time_id",
                    F.col("article_id"))
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("limit", ["10MB", "-1"])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_beyond_the_broadcast_limit(spark, limit, how):
    facts = spark.range(0, 3000, 1, 4).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("key"))
    dim = spark.range(40).select(F.col("id").alias("key"), (F.col("id") * 2).alias("value"))
    expected = sorted(map(tuple, facts.join(dim, "key", how).collect()), key=repr)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        joined = lookup(facts, dim, "key", F.col("id"), how)
        assert sorted(map(tuple, joined.collect()), key=repr) == expected
        assert ("_salt" in joined._jdf.queryExecution().optimizedPlan().toString()) == (limit == "-1")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_staged_folders_go_with_their_block(spark, monkeypatch, tmp_path):
    import os

    from newsflow import session

    monkeypatch.setattr(session, "scratch_root", lambda _: str(tmp_path))
    with session.staging(spark):
        held = session.stage(spark.range(5), "x")
        assert held.count() == 5 and os.listdir(tmp_path / "newsflow")
    assert not os.listdir(tmp_path / "newsflow")


def test_scratch_folder_without_the_setting():
    from types import SimpleNamespace

    from newsflow import session

    def fake(master):
        context = SimpleNamespace(master=master, applicationId=f"app-{master}")
        return SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=context)

    assert session.scratch_root(fake("local[2]")) == session.scratch_root(fake("local[2]"))
    with pytest.raises(ValueError):
        session.scratch_root(fake("yarn"))


def test_truncate_all_ingests_once(spark, monkeypatch):
    """Both loads take the same staged rows; the messages are decoded and staged once."""
    from checks import corpus, queries

    calls, metadata = [], corpus.metadata
    monkeypatch.setattr(corpus, "metadata", lambda *args: calls.append(args) or metadata(*args))
    facts = queries.truncate_all(spark, "/root/testdata/sf0.001")
    assert len(calls) == 1
    assert facts.agg(F.min("article_id")).first()[0] == 1 and not facts.isEmpty()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def never_small(spark):
    """Every table is too large to be broadcast by its size."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def test_numbered_rows_are_a_semi_join(spark, never_small):
    rows = spark.range(0, 70000, 1, 3).select((F.col("id") * 3).alias("row"), F.col("id").cast("string").alias("text"),
                                              F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("file"))
    kept = rows.filter("row % 7 = 1").select("row", "file").unionByName(
        spark.createDataFrame([(None, "a"), (3, None), (3, "b"), (1 << 40, "a")], "row LONG, file STRING"))
    for within, keys in ((None, ["row"]), ("file", ["file", "row"])):
        found = numbered_rows(rows, kept, "row", within)
        wanted = rows.join(kept.select(*keys), keys, "left_semi").select(*rows.columns)
        assert "SortMergeJoin" not in plan_of(found) and "SortMergeJoin" in plan_of(wanted)
        assert found.exceptAll(wanted).isEmpty() and wanted.exceptAll(found).isEmpty() and not found.isEmpty()
    assert numbered_rows(rows, kept.limit(0), "row").isEmpty()


def test_numbered_rows_beyond_the_bitmaps_are_joined(spark, never_small, monkeypatch):
    monkeypatch.setattr(joins, "BITMAP_BYTES", 0)
    rows = spark.range(100).select(F.col("id").alias("row"))
    found = numbered_rows(rows, rows.filter("row % 3 = 0"), "row")
    assert "SortMergeJoin" in plan_of(found) and found.count() == 34


def test_messages_and_texts_stay_where_they_are(spark, warehouse, never_small):
    lines = [(n, json.dumps({"url": f"https://d/{n % 40}", "title": f"t{n % 30}", **GOOD})) for n in range(60)]
    rows = ingest_batch(spark.createDataFrame(lines, "seq LONG, value STRING"), spark.createDataFrame([], "url_hash STRING"))
    assert "SortMergeJoin" not in plan_of(rows) and rows.count() == 40
    warehouse.init_metadata()
    warehouse.append_metadata(rows)
    metadata = warehouse.read_metadata()
    winners = title_winners(metadata.select("url_hash", "title", "ingest_day", F.lit(None).cast("string").alias("state")))
    texts = texts_of(metadata, winners)
    assert "SortMergeJoin" not in plan_of(texts) and texts.columns == metadata.columns
    assert {r["url_hash"] for r in texts.collect()} == {r["url_hash"] for r in winners.collect()} and texts.count() == 30


def test_facts_are_made_without_texts(spark, warehouse, monkeypatch):
    seen, fact_rows = [], etl.fact_rows
    monkeypatch.setattr(etl, "fact_rows", lambda keyed, *dims: seen.append(keyed.columns) or fact_rows(keyed, *dims))
    warehouse.init_metadata()
    warehouse.append_metadata(raw(spark, ("https://d/1", "one", GOOD)))
    run_etl(warehouse)
    assert "content" not in seen[0]
    assert warehouse.table("fact_articles").first()["content_length"] == len(GOOD["content"])


def test_texts_are_written_compressed(spark, warehouse):
    warehouse.init_metadata()
    warehouse.append_metadata(raw(spark, ("https://d/1", "one", GOOD)))
    run_etl(warehouse)
    for table in ("article_metadata", "dim_content", "fact_chunks"):
        file = pq.ParquetFile(warehouse.table(table).inputFiles()[0].removeprefix("file:").replace("///", "/"))
        assert file.metadata.row_group(0).column(0).compression == "ZSTD"


def test_points_are_written_where_they_are_made(spark, warehouse, monkeypatch):
    warehouse.init_metadata()
    warehouse.append_metadata(raw(spark, *[(f"https://d/{n}", f"t{n}", GOOD) for n in range(20)]))
    run_etl(warehouse)
    warehouse.init_points(8)
    plans, write = [], Warehouse._write_partition
    monkeypatch.setattr(Warehouse, "_write_partition", lambda self, table, df, number: (
        plans.append(df._jdf.queryExecution().optimizedPlan().toString()), write(self, table, df, number)))
    vectorize(warehouse)
    assert "RebalancePartitions" not in plans[0]
    assert warehouse.table(POINTS).count() == 20
