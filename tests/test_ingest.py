import json
import time

from pyspark.sql import functions as F

from newsflow.operators.ingest import decode_messages, ingest_batch, ingest_counters
from newsflow.sources import topic
from newsflow.streaming.ingest import IngestCounters, count_statuses, ingest_articles
from newsflow.streaming.live import live_metrics, refresh_metrics

LINES = ['{bad', '[1]', '{"url":""}', '{"title":"no url"}', '{"url":null}', '{"url":5}', '{"url":"u","title":null}',
         '{"url":"v"}', '{"url":"u","title":"late","author":"x"}', "", "null"]


def messages(spark, lines=LINES):
    return spark.createDataFrame([(line, i) for i, line in enumerate(lines)], "value STRING, seq BIGINT")


def test_decode(spark):
    rows = {r["seq"]: r for r in decode_messages(messages(spark)).collect()}
    assert [rows[i]["status"] for i in range(len(LINES))] == [
        "bad", "bad", "skipped", "skipped", "skipped", "bad", "ok", "ok", "ok", "bad", "bad"]
    assert (rows[6]["title"], rows[6]["author"], rows[6]["publish_date"]) == (None, "Unknown", None)
    assert (rows[7]["title"], rows[7]["author"], rows[7]["publish_date"]) == ("Unknown Title", "Unknown", None)


def test_first_arrival_wins(spark):
    none = spark.createDataFrame([], "url_hash STRING")
    rows = ingest_batch(messages(spark), none).collect()
    assert {(r["url"], r["title"]) for r in rows} == {("u", None), ("v", "Unknown Title")}
    known = spark.createDataFrame([("u",)], "url STRING").select(F.sha2("url", 256).alias("url_hash"))
    assert [r["url"] for r in ingest_batch(messages(spark), known).collect()] == ["v"]


def test_counters(spark):
    assert {r["status"]: r["n"] for r in ingest_counters(messages(spark)).collect()} == {"ok": 3, "skipped": 3, "bad": 5}


def test_hot_url(spark):
    copies = spark.range(0, 30000, 1, 8).select(
        F.concat(F.lit('{"url":"hot","title":"'), F.col("id"), F.lit('"}')).alias("value"), F.col("id").alias("seq"))
    rows = ingest_batch(copies, spark.createDataFrame([], "url_hash STRING")).collect()
    assert [(r["url"], r["title"]) for r in rows] == [("hot", "0")]


def test_equal_copies_of_one_message(spark):
    """A message sent again has the same number and the same text."""
    copies = spark.range(0, 20000, 1, 8).select(F.lit('{"url":"hot","title":"t"}').alias("value"), F.lit(7).cast("bigint").alias("seq"))
    rows = ingest_batch(copies, spark.createDataFrame([], "url_hash STRING")).collect()
    assert [(r["url"], r["title"]) for r in rows] == [("hot", "t")]


def write(spark, folder, lines):
    topic.write_topic(spark.createDataFrame([(line,) for line in lines], "value STRING").coalesce(1), folder)


def test_stream_restarts_and_repeats(spark, folder, warehouse):
    warehouse.init_metadata()

    def run():
        stream = topic.stream_topic(spark, f"{folder}/topic")
        ingest_articles(stream, warehouse, f"{folder}/checkpoint", availableNow=True).awaitTermination()
        return {(r["url"], r["title"]) for r in warehouse.table("article_metadata").collect()}

    write(spark, f"{folder}/topic", [json.dumps({"url": "a", "title": "one", "seq": 1}), "{bad",
                                     json.dumps({"url": "a", "title": "two", "seq": 2})])
    assert run() == {("a", "one")}
    write(spark, f"{folder}/topic", [json.dumps({"url": "a", "title": "three", "seq": 3}),
                                     json.dumps({"url": "b", "title": "báo", "seq": 4}), "[]"])
    assert run() == {("a", "one"), ("b", "báo")}
    assert run() == {("a", "one"), ("b", "báo")}
    write(spark, f"{folder}/topic", [json.dumps({"url": "c", "title": "twice", "seq": 5})] * 3)
    assert run() == {("a", "one"), ("b", "báo"), ("c", "twice")}
    again = topic.stream_topic(spark, f"{folder}/topic")
    ingest_articles(again, warehouse, f"{folder}/checkpoint2", availableNow=True).awaitTermination()
    assert warehouse.table("article_metadata").count() == 3


def test_topic_round_trip_and_peek(spark, folder):
    articles = spark.createDataFrame([("Tin \"nóng\"\n", None, "https://d/1")], "title STRING, author STRING, url STRING")
    topic.write_topic(topic.to_messages(articles), folder)
    lines = topic.read_topic(spark, folder)
    assert json.loads(lines.first()["value"]) == {"title": "Tin \"nóng\"\n", "author": None, "url": "https://d/1"}
    assert "nóng" in lines.first()["value"]
    first = topic.peek_topic(messages(spark))
    assert [r["seq"] for r in first.collect()] == [0, 1, 2, 3, 4]


def test_status_counters_of_a_stream(spark, folder):
    write(spark, f"{folder}/topic", [line for line in LINES if line])
    listener = IngestCounters()
    spark.streams.addListener(listener)
    query = count_statuses(topic.stream_topic(spark, f"{folder}/topic"), f"{folder}/checkpoint", "statuses", availableNow=True)
    query.awaitTermination()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    spark.streams.removeListener(listener)
    observed = {k: v for p in query.recentProgress for k, v in p["observedMetrics"].get("ingest", {}).items()} \
        if not any(listener.totals.values()) else listener.totals
    assert observed == {"ok": 3, "skipped": 3, "bad": 4}


def test_live_metrics_show_the_tables_as_they_are(spark, folder, warehouse):
    warehouse.init_metadata()
    warehouse.init_warehouse()

    def insert(*dates):
        rows = spark.createDataFrame([(d,) for d in dates], "publish_date STRING")
        columns = {c: F.lit("x") for c in ("url_hash", "url", "title", "content", "author")}
        warehouse.append_metadata(rows.withColumns(columns))

    def facts(load, n, chunks):
        warehouse.write_load("fact_chunks", spark.range(chunks).select(
            "id", "id", F.lit(0), F.lit("x")).toDF("chunk_id", "article_id", "chunk_index", "content"), load)
        warehouse.write_load("fact_articles", spark.range(n).select(*["id"] * 7).toDF(
            "article_id", "url_hash", "title", "source_id", "time_id", "content_id", "content_length"), load)

    def now():
        return tuple(refresh_metrics(warehouse, "live_now").first())

    insert("Unknown", "2024-01-01 00:00:00")
    facts(1, 2, 3)
    assert now() == (2, 3, 1, 1.5)
    facts(1, 2, 4)
    assert now() == (2, 4, 1, 2.0)
    warehouse.write_load("fact_chunks", spark.createDataFrame([(1, 1, 0, "x")], "chunk_id BIGINT, article_id BIGINT, "
                                                              "chunk_index INT, content STRING"), 2)
    assert now() == (2, 4, 1, 2.0)
    warehouse.truncate_all()
    assert now()[:3] == (0, 0, 0)
    running = live_metrics(warehouse, "live_test", f"{folder}/live", processingTime="1 second")
    deadline = time.monotonic() + 60
    while not spark.catalog.tableExists("live_test") and time.monotonic() < deadline:
        time.sleep(0.2)
    running.stop()
    assert spark.table("live_test").first()["articles"] == 0


def test_arrival_order(spark, folder):
    """A later, larger file does not come first, and a number in a message means nothing."""
    write(spark, folder, [json.dumps({"url": "a", "title": "first"}), json.dumps({"url": "b", "title": "second"})])
    time.sleep(1.1)
    write(spark, folder, [json.dumps({"url": "a", "title": "late", "seq": -1})] * 3000)
    rows = ingest_batch(topic.read_topic(spark, folder), spark.createDataFrame([], "url_hash STRING")).collect()
    assert {(r["url"], r["title"]) for r in rows} == {("a", "first"), ("b", "second")}
    assert [json.loads(r["value"])["title"] for r in topic.peek_files(spark, folder, 3).orderBy("seq").collect()] == [
        "first", "second", "late"]


def test_kafka_positions_do_not_collide(spark):
    stamp = F.lit("2024-01-01 00:00:00").cast("timestamp")
    raw = spark.createDataFrame([("x", 4096, 0), ("y", 0, 1), ("z", 5000, 1)], "value STRING, partition INT, offset BIGINT")
    found = topic._kafka_messages(raw.withColumn("timestamp", stamp))
    assert found.select("seq").distinct().count() == 3


def test_kafka_peek_is_bounded(spark):
    """Known starts give ends; a start by name is cut by the tasks, which keep their first messages."""
    starts = json.dumps({"news_raw": {"0": 100, "1": 7}})
    options = topic.peek_options({"kafka.bootstrap.servers": "b:9092", "startingOffsets": starts}, 3)
    assert json.loads(options["endingOffsets"]) == {"news_raw": {"0": 103, "1": 10}} and options["subscribe"] == "news_raw"
    assert "endingOffsets" not in topic.peek_options({"kafka.bootstrap.servers": "b:9092"}, 3)
    assert "endingOffsets" not in topic.peek_options({"startingOffsets": json.dumps({"news_raw": {"0": -2}})}, 3)
    rows = spark.range(0, 20_000, 1, 4).select(F.col("id").cast("string").alias("value"), F.col("id").alias("seq"))
    kept = topic.first_of_tasks(rows, 3)
    assert sorted(r["seq"] for r in kept.collect()) == [p * 5000 + i for p in range(4) for i in range(3)]
    assert [r["seq"] for r in topic.peek_topic(kept, 3).collect()] == [0, 1, 2]


def test_stream_state_starts_from_the_table(spark, folder, warehouse):
    """Keys of the table are known to a new checkpoint; later batches read no key of the table."""
    warehouse.init_metadata()
    known = ingest_batch(messages(spark, ['{"url":"old","title":"kept"}']), spark.createDataFrame([], "url_hash STRING"))
    warehouse.append_metadata(known)
    lines = [json.dumps({"url": url, "title": f"{url}{i}"}) for i in range(3) for url in ("old", "new", "newer")]
    write(spark, f"{folder}/topic", lines[:6])
    time.sleep(1.1)
    write(spark, f"{folder}/topic", lines[6:] + ['{"url":"last","title":"z"}'])
    stream = spark.readStream.option("maxFilesPerTrigger", 1).text(f"{folder}/topic")
    query = ingest_articles(topic._file_messages(stream), warehouse, f"{folder}/checkpoint", availableNow=True)
    query.awaitTermination()
    assert {(r["url"], r["title"]) for r in warehouse.table("article_metadata").collect()} == {
        ("old", "kept"), ("new", "new0"), ("newer", "newer0"), ("last", "z")}
    batches = [p for p in query.recentProgress if p["numInputRows"]]
    assert len(batches) == 2 and batches[-1]["stateOperators"][0]["numRowsTotal"] == 4
    plan = query._jsq.explainInternal(False) if hasattr(query._jsq, "explainInternal") else ""
    assert "LeftAnti" not in plan


def test_a_batch_that_was_written_but_not_committed_is_not_written_again(spark, folder, warehouse):
    """The commit of the last batch is lost: its messages come again, with the state before it."""
    import os

    warehouse.init_metadata()

    def run():
        ingest_articles(topic.stream_topic(spark, f"{folder}/topic"), warehouse, f"{folder}/checkpoint", availableNow=True).awaitTermination()
        return sorted(r["title"] for r in warehouse.table("article_metadata").collect())

    write(spark, f"{folder}/topic", [json.dumps({"url": "a", "title": "one"})])
    assert run() == ["one"]
    time.sleep(1.1)
    write(spark, f"{folder}/topic", [json.dumps({"url": url, "title": "two"}) for url in "aabb"])
    assert run() == ["one", "two"]
    commits = f"{folder}/checkpoint/commits"
    last = max((name for name in os.listdir(commits) if name.isdigit()), key=int)
    for name in (last, f".{last}.crc"):
        if os.path.exists(f"{commits}/{name}"):
            os.remove(f"{commits}/{name}")
    assert run() == ["one", "two"]
    time.sleep(1.1)
    write(spark, f"{folder}/topic", [json.dumps({"url": url, "title": "three"}) for url in "abc"])
    assert run() == ["one", "three", "two"]


def test_state_takes_the_first_of_plain_rows():
    """A key costs a look at its rows, not a frame of its own; nulls come last."""
    from pyspark.sql import Row

    from newsflow.streaming.ingest import _FIELDS, _ORDER, FirstArrival

    class Seen:
        held = None

        def exists(self):
            return self.held is not None

        def update(self, value):
            self.held = value

    def row(value, *order):
        return Row(**{name: value for name in _FIELDS}, **dict(zip(_ORDER, order)))

    one = FirstArrival()
    one.seen = Seen()
    rows = [row("none", None, "a", 0, 0), row("late", 2, "a", 0, 0), row("first", 1, "b", 0, 3), row("copy", 1, "b", 0, 3)]
    assert [found["value"] for found in one.handleInputRows(("k",), iter(rows), None)] == ["first"]
    assert one.seen.held == (True,) and not list(one.handleInputRows(("k",), iter(rows), None))
