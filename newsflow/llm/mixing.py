"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree, in DataFrame functions only.

The rows of a source are dealt into blocks by a hash: blocks in their order are a permutation of the source. A source's target buys
whole passes over its blocks and one part of a pass: the first blocks, and of the block where the target is met the first
rows by another hash. The blocks bought are the source's quota. A tree over the output shards splits quotas: at each node
the left half of the shards gets a multivariate hypergeometric draw of the node's blocks, so shards are equally large and
every source's quota is met exactly. Each shard then owns disjoint runs of each source's permuted blocks; a hash gives the
order within the shard. Everything a row needs is an expression of its source's entry in one small table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsflow.llm.batches import fresh
from newsflow.operators.joins import lookup
from newsflow.session import stage

WEIGHTS = (5, 2, 1)
TOTAL_SHARE = 1.5
MOST_PASSES = 2
BLOCK_WORDS = 1 << 14
MOST_BLOCKS = 1 << 16
SHARD_WORDS = 1 << 22
MOST_SHARDS = 1 << 12
COPY_PARTS = 1 << 12
SEED = 9
WORD = r"[^\x20\x09-\x0D]+"


def text_size(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """Never null; orders as the source does, with null last."""
    return F.coalesce(F.concat(F.lit("+"), source.cast("string")), F.lit("-"))


def _source_order() -> list[Column]:
    return [F.col("source_key") == "-", F.col("source_key")]


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = TOTAL_SHARE,
            most: float = MOST_PASSES) -> DataFrame:
    """(source_key, source_size, place, target) for sources (source_key, source_size).

    Sources by code point, null last, take ``weights`` in turn and split ``share`` of all sizes by them; none goes
    above ``most`` times its size, the excess goes to the others by weight. In order of the share at which they stop, a source
    stops if the rest, split among it and all later ones, would take it above; one row per source goes through one task.
    """
    kinds = F.array(*[F.lit(float(w)) for w in weights])
    placed = sizes.withColumn("place", F.row_number().over(Window.orderBy(*_source_order())) - 1).withColumn(
        "weight", F.get(kinds, F.pmod("place", F.lit(len(weights))))).withColumn("cap", F.col("source_size") * float(most))
    by_stop = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    before = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    after = by_stop.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(0))
    level = (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    ranked = placed.withColumn("total", F.sum("source_size").over(everything) * float(share)).withColumn("level", level)
    stopped = ranked.withColumn("stops", F.col("cap") / F.col("weight") <= F.col("level"))
    free = F.min(F.when(~F.col("stops"), F.struct(F.col("cap") / F.col("weight"), "place", "level"))).over(everything)
    return stopped.withColumn("free", free.getField("level")).select(
        "source_key", "source_size", "place",
        F.when(F.col("stops"), F.col("cap")).otherwise(F.least("cap", F.col("weight") * F.col("free"))).alias("target"))


def _block(blocks: Column, row: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(SEED), row), blocks)


def _order(row: Column) -> Column:
    return F.xxhash64(F.lit(SEED + 1), row)


def _plans(rows: DataFrame, block_words: int) -> DataFrame:
    """Per source what it buys: whole ``passes``, then blocks below ``cut`` and rows of block ``cut`` up to ``limit``.

    ``rows`` are (source_key, size, row), row a 64-bit hash. Sums are taken per block before a source's blocks meet.
    """
    sizes = rows.groupBy("source_key").agg(F.sum("size").alias("source_size"))
    blocks = F.least(F.lit(MOST_BLOCKS), F.greatest(F.lit(1), F.ceil(F.col("source_size") / block_words))).cast("long")
    passes = F.when(F.col("source_size") > 0, F.least(
        F.lit(MOST_PASSES), F.floor(F.col("target") / F.col("source_size")))).otherwise(0).cast("long")
    plans = stage(targets(sizes).withColumn("blocks", blocks).withColumn("passes", passes).withColumn(
        "rest", F.when(F.col("passes") < MOST_PASSES, F.col("target") - F.col("passes") * F.col("source_size")).otherwise(
            F.lit(0.0))), "plans")

    dealt = lookup(rows, plans.select("source_key", "blocks", "rest"), "source_key", F.col("row")).withColumn(
        "block", _block(F.col("blocks"), F.col("row")))
    per_block = dealt.groupBy("source_key", "block", "rest").agg(F.sum("size").alias("words"))
    in_order = Window.partitionBy("source_key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    met = per_block.withColumn("before", F.coalesce(F.sum("words").over(in_order), F.lit(0))).filter(
        (F.col("before") <= F.col("rest")) & (F.col("before") + F.col("words") > F.col("rest")))
    cuts = stage(met.groupBy("source_key").agg(F.max(F.struct("block", "before")).alias("m")).select(
        "source_key", F.col("m.block").alias("cut"), F.col("m.before").alias("before")), "cuts")

    last = lookup(dealt, cuts, "source_key", F.col("row")).filter(F.col("block") == F.col("cut"))
    each = last.groupBy("source_key", "rest", "before", _order(F.col("row")).alias("order")).agg(
        F.sum("size").alias("words"))
    running = Window.partitionBy("source_key").orderBy("order").rowsBetween(Window.unboundedPreceding, 0)
    reached = each.withColumn("upto", F.sum("words").over(running) + F.col("before")).withColumn(
        "start", F.col("upto") - F.col("words"))
    # a row belongs to the part if that brings the source nearer to its target
    taken = reached.filter(F.col("upto") - F.col("rest") <= F.col("rest") - F.col("start"))
    limits = taken.groupBy("source_key").agg(F.max("order").alias("limit"))
    return stage(plans.join(cuts.drop("before"), "source_key", "left").join(limits, "source_key", "left"), "plans")


def _told_apart(sized: DataFrame, repeated: DataFrame, row: str) -> DataFrame:
    """``sized`` with another hash in ``row`` for each of the rows that share one of ``repeated``, so that a cut may fall between copies.

    Only such rows are staged and numbered, dealt into ``COPY_PARTS`` by their place so that no task holds all copies of one.
    """
    flag, part, before = (fresh(sized, name) for name in ("repeated", "copy_part", "copies_before"))
    marked = lookup(sized, repeated.withColumn(flag, F.lit(True)), row, F.monotonically_increasing_id(), "left")
    copies = stage(marked.filter(F.col(flag)).drop(flag).withColumn(
        part, F.pmod(F.monotonically_increasing_id(), F.lit(COPY_PARTS))), "copies")
    counts = copies.groupBy(row, part).agg(F.count(F.lit(1)).alias(before))
    running = Window.partitionBy(row).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn(before, F.coalesce(F.sum(before).over(running), F.lit(0)))
    rest = [F.col(f"`{name}`").cast("string") for name in sized.columns if name != row]
    within = F.row_number().over(Window.partitionBy(row, part).orderBy(F.xxhash64(*rest))) - 1
    number = within + F.col(before)
    told = copies.join(offsets, [row, part]).withColumn("_", number).withColumn(
        row, F.when(F.col("_") == 0, F.col(row)).otherwise(F.xxhash64(F.lit(SEED + 3), row, "_")))
    columns = [f"`{name}`" for name in sized.columns]
    return marked.filter(F.col(flag).isNull()).select(*columns).unionByName(stage(told.select(*columns), "copies"))


def _log_factorial(n: str) -> str:
    """Stirling's series; exact to six digits from 2 on."""
    return (f"IF({n} < 2, 0D, {n} * ln({n}) - {n} + 0.5D * ln(2 * pi() * {n}) + 1 / (12D * {n})"
            f" - 1 / (360D * pow({n}, 3)) + 1 / (1260D * pow({n}, 5)))")


def _log_choose(n: str, k: str) -> str:
    return f"({_log_factorial(n)} - {_log_factorial(k)} - {_log_factorial(f'({n} - {k})')})"


def hypergeometric(all_: str, marked: str, drawn: str, chance: str) -> str:
    """SQL for how many of ``drawn`` out of ``all_`` are ``marked``, as the inverse distribution at ``chance``.

    The arguments are SQL expressions of bigint (chance: double). Counts further than 8 deviations from the mean are not looked at.
    """
    mean = f"({drawn} * CAST({marked} AS DOUBLE) / greatest(1, {all_}))"
    spread = (f"(8 * sqrt({mean} * greatest(0, {all_} - {marked}) / greatest(1, {all_}) * greatest(0, {all_} - {drawn})"
              f" / greatest(1, {all_} - 1)) + 2)")
    low = f"greatest(0L, {drawn} - ({all_} - {marked}), CAST(floor({mean} - {spread}) AS BIGINT))"
    high = f"least({marked}, {drawn}, CAST(ceil({mean} + {spread}) AS BIGINT))"
    logs = f"{_log_choose(marked, 'v')} + {_log_choose(f'({all_} - {marked})', f'({drawn} - v)')}"
    raw = f"transform(sequence({low}, {high}), v -> {logs})"
    weights = f"transform(array({raw}), l -> transform(l, x -> exp(x - array_max(l))))[0]"
    total = "aggregate(w, 0D, (acc, y) -> acc + y)"
    passed = ("aggregate(w, named_struct('sum', 0D, 'n', 0L), (acc, y) -> named_struct('sum', acc.sum + y, 'n',"
              f" acc.n + IF(acc.sum + y < {chance} * {total}, 1L, 0L))).n")
    return f"transform(array({weights}), w -> least({high}, {low} + {passed}))[0]"


def split_quotas(quotas: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """(shard, quotas) for one row of ``quotas`` (an array of bigint, one per source); ``shards`` is a power of two.

    Level by level each node's blocks are halved among its shards; within a node sources draw one after the other, each
    from what the earlier ones left, which makes the draw multivariate.
    """
    nodes = quotas.select(F.lit(0).cast("long").alias("shard"), "quotas")
    width = shards
    while width > 1:
        chance = f"pmod(xxhash64({seed}L, {width}L, shard, CAST(size(s.out) AS BIGINT)), 1099511627776L) / 1099511627776D"
        draw = hypergeometric("s.all", "k", "s.left", chance)
        whole = "aggregate(quotas, 0L, (s, k) -> s + k)"
        odd = f"pmod(xxhash64({seed}L, {width}L, shard), 2L) * pmod({whole}, 2L)"
        left = (f"aggregate(quotas, named_struct('all', {whole}, 'left', {whole} DIV 2 + {odd}, 'out', CAST(array() AS ARRAY<BIGINT>)),"
                f" (s, k) -> transform(array({draw}), x -> named_struct('all', s.all - k, 'left', s.left - x,"
                " 'out', concat(s.out, array(x))))[0]).out")
        halves = nodes.withColumn("first", F.expr(left))
        nodes = halves.select(F.inline(F.array(
            F.struct(F.col("shard"), F.col("first").alias("quotas")),
            F.struct((F.col("shard") + width // 2).alias("shard"), F.zip_with(
                "quotas", "first", lambda k, x: k - x).alias("quotas")))))
        nodes = stage(nodes, "shards") if width in (shards // 16, shards // 256) else nodes
        width //= 2
    return nodes


def _shard_count(words: int) -> int:
    shards = 1
    while shards < MOST_SHARDS and shards * SHARD_WORDS < words * TOTAL_SHARE:
        shards *= 2
    return shards


def mix(documents: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text",
        block_words: int = BLOCK_WORDS) -> DataFrame:
    """``documents`` with ``size``, ``source_size``, ``target``, ``copies`` (0 to 2), ``taken`` (size times copies) and ``shards``.

    ``shards`` has the shard of every copy. Columns of these names are replaced. Null texts have size 0; a null source is
    one source. Of rows equal in key and text each is taken on its own: which of them, if they differ in other columns, depends on
    their places. No rows and only empty texts give targets of 0. The same rows
    give the same mix, whatever their order or partitions.
    """
    made = ("size", "source_size", "target", "copies", "taken", "shards")
    base = documents.drop(*made)
    names = {name: fresh(base, name) for name in ("source_key", "row")}
    sized = base.withColumn("size", text_size(F.col(text))).withColumn(
        names["source_key"], source_key(F.col(source))).withColumn(
        names["row"], F.xxhash64(F.col(key).isNull(), F.col(key), F.col(text)))
    narrow = [F.col(names["source_key"]).alias("source_key"), "size", F.col(names["row"]).alias("row")]
    rows = stage(sized.select(*narrow), "sizes")
    repeated = stage(rows.groupBy("row").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("row").alias(names["row"])), "repeated")
    if not repeated.isEmpty():
        sized = _told_apart(sized, repeated, names["row"])
        rows = stage(sized.select(*narrow), "sizes")
    plans = _plans(rows, block_words)

    pieces = (F.col("passes") * F.col("blocks") + F.coalesce(F.col("cut") + 1, F.lit(0))).cast("long")
    quotas = plans.withColumn("pieces", pieces)
    words = rows.agg(F.sum("size")).first()[0] or 0
    listed = F.array_sort(F.collect_list(F.struct("place", "source_key", "pieces")))
    one = stage(quotas.agg(listed.alias("listed")), "quotas")
    shares = stage(split_quotas(one.select(F.col("listed.pieces").alias("quotas")), _shard_count(words)), "shards")
    runs = shares.select("shard", F.posexplode("quotas").alias("place", "own")).groupBy("place").agg(
        F.array_sort(F.collect_list(F.struct("shard", "own"))).alias("runs"))
    ends = F.aggregate("runs", F.lit(None).cast("array<bigint>"), lambda out, x: F.concat(
        F.coalesce(out, F.array().cast("array<bigint>")),
        F.array(F.coalesce(F.element_at(out, -1), F.lit(0).cast("long")) + x["own"])))
    table = stage(plans.join(runs.select("place", ends.alias("ends")), "place").select(
        F.col("source_key").alias(names["source_key"]),
        F.struct("source_size", "target", "passes", "blocks", "cut", "limit", "ends").alias("plan")), "mix")

    plan_name = fresh(base, "plan")
    joined = lookup(sized, table.withColumnRenamed("plan", plan_name), names["source_key"], F.col(names["row"]), "left")
    plan, row = F.col(plan_name), F.col(names["row"])
    block = _block(plan["blocks"], row)
    part = (plan["cut"].isNotNull() & (
        (block < plan["cut"]) | ((block == plan["cut"]) & (_order(row) <= plan["limit"])))).cast("long")
    copies = plan["passes"] + F.coalesce(part, F.lit(0))
    piece = F.transform(F.slice(F.array(F.lit(0), F.lit(1)), 1, copies.cast("int")),
                        lambda n: n * plan["blocks"] + block)
    shards = F.transform(piece, lambda p: F.size(F.filter(plan["ends"], lambda end: end <= p)))
    return joined.select(
        *base.columns, "size", plan["source_size"].alias("source_size"), plan["target"].alias("target"),
        copies.alias("copies"), (copies * F.col("size")).alias("taken"), shards.alias("shards"))


def mixture(documents: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The mix itself: a row per copy taken, with its ``shard``; ``position`` orders a shard's rows at random.

    Rows of a task come sorted by shard and position.
    """
    mixed = mix(documents, key, source, text)
    copies = mixed.select("*", F.posexplode("shards").alias("copy", "shard")).drop("shards", "copies", "taken")
    placed = copies.withColumn("position", F.xxhash64(F.lit(SEED + 2), "copy", F.col(key), F.col(text)))
    return placed.sortWithinPartitions("shard", "position")


def op9_mixing(documents: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken and the shards of the copies, for every row of ``documents``."""
    return mix(documents.select("doc_id", "source", "text")).select(
        "doc_id", "size", "source_size", "target", "taken", "shards")
