"""Near-dedup by Order MinHash.

Texts are runs of five-word shingles, each labelled with how often it came before in its text. A sketch picks the few
shingles with the least hash values and keeps them in text order, so that texts agree on it if they share shingles in the same order
(edit similarity), not only as a set. Texts that agree on one of several sketches are candidates; a banded alignment of the
two shingle runs decides: shingles aligned, divided by all shingles of both less the aligned ones, is 0.8 or more.

Equal word sequences are one node. In a bucket every node is first compared with one of them, the leader, and those not linked to it
with one of their own. In buckets that then still hold nodes of different groups, the nodes outside of the largest group are compared with all others, in blocks: labelled
shingles that two texts share bound their alignment from above, and what passes the bound is aligned until the two groups are
linked.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow.llm.batches import arrow_rows, fresh, over_batches, small_batches
from newsflow.llm.spans import mix, split_words, text_slices, windows, word_keys
from newsflow.session import stage

WIDTH = 5
SKETCHES = 16
PICKS = 4
SIMILARITY = 0.8
BLOCK = 256
BLOCK_BATCH = 4
PER_LEADER = 64
LEADERS = 2
COLUMNS = 4096
_PLACE_BITS = np.uint64(28)
_ODD = np.uint64(0xD6E8FEB86659FD93)
_SEEDS = mix(np.arange(1, 65, dtype=np.uint64))


def _labelled(shingles: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Shingle keys that also tell the occurrence within the row."""
    within = shingles ^ mix(row.astype(np.uint64))
    order = np.argsort(within, kind="stable")
    new = np.ones(len(order), dtype=bool)
    new[1:] = within[order][1:] != within[order][:-1]
    at = np.arange(len(order))
    occurrence = np.empty(len(order), dtype=np.uint64)
    occurrence[order] = at - np.maximum.accumulate(np.where(new, at, 0))
    return mix(shingles + occurrence * _ODD)


def sketch(labelled: np.ndarray, bounds: np.ndarray, sketches: int = SKETCHES, picks: int = PICKS) -> np.ndarray:
    """(rows, sketches) keys: the ``picks`` least of each row's shingles under each hash, folded in text order.

    Rows need a shingle at least.
    """
    starts = bounds[:-1]
    rows = len(starts)
    # a hash's upper bits and the place in the row share a number, so that the least tells the place too
    place = (np.arange(len(labelled)) - np.repeat(starts, np.diff(bounds))).astype(np.uint64)
    low = (np.uint64(1) << _PLACE_BITS) - np.uint64(1)
    out = np.empty((rows, sketches), dtype=np.uint64)
    for number in range(sketches):
        hashed = ((labelled ^ _SEEDS[number]) * _ODD & ~low) | place
        places = np.empty((picks, rows), dtype=np.int64)
        for pick in range(picks):
            places[pick] = np.minimum.reduceat(hashed, starts) & low
            places[pick] += starts
            hashed[places[pick]] |= ~low
        places.sort(axis=0)
        key = np.full(rows, _SEEDS[number])
        for pick in range(picks):
            key = mix(key * _ODD + labelled[places[pick]])
        out[:, number] = key
    return out


def _nodes(keys: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """128 bits of each row's word sequence; rows without words are 0."""
    count = np.diff(bounds)
    place = (np.arange(len(keys)) - np.repeat(bounds[:-1], count)).astype(np.uint64)
    full = count > 0
    out = np.zeros((len(count), 2), dtype=np.uint64)
    for half, seed in enumerate(_SEEDS[:2]):
        summed = np.add.reduceat(mix((keys ^ seed) + mix(place + seed)), bounds[:-1][full]) if full.any() else 0
        out[full, half] = mix(summed + count[full].astype(np.uint64))
    return out


def _lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))


def _binary(rows: list[bytes | None]) -> pa.Array:
    return pa.array(rows, type=pa.binary())


def _describe(texts: pa.Array) -> dict:
    """node and sketches of every text: null node for null, no sketches for a text without words."""
    nulls = pc.is_null(texts).to_numpy(zero_copy_only=False)
    nodes: list[bytes | None] = []
    parts, sizes = [], []
    for first, part in text_slices(texts):
        words = split_words(part)
        keys = word_keys(words)
        ids = _nodes(keys, words.bounds)
        shingles, bounds = windows(keys, words.bounds, WIDTH)
        full = np.diff(bounds) > 0
        count = np.where(full, SKETCHES, 0)
        if full.any():
            row = np.repeat(np.arange(len(full)), np.diff(bounds))
            own = np.append(bounds[:-1][full], bounds[-1])
            parts.append(sketch(_labelled(shingles, row), own).ravel().view(np.int64))
        sizes.append(count)
        for at in range(len(part)):
            if nulls[first + at]:
                nodes.append(None)
            elif full[at]:
                nodes.append(ids[at].tobytes())
            else:
                nodes.append(xxhash.xxh128_digest("-" + part[at].as_py()))
    flat = np.concatenate(parts) if parts else np.empty(0, np.int64)
    return {"node": _binary(nodes), "sketches": _lists(flat, np.concatenate(sizes) if sizes else [], pa.int64())}


def _tokens(texts: pa.Array) -> pa.Array:
    """32 bits per word of every text, as bytes."""
    out: list[bytes] = []
    for _, part in text_slices(texts):
        words = split_words(part)
        keys = word_keys(words).astype(np.uint32)
        out += [keys[a:b].tobytes() for a, b in zip(words.bounds[:-1], words.bounds[1:])]
    return _binary(out)


def _aligned(a: list[int], b: list[int], band: int) -> int:
    """Length of the longest common subsequence within a band around the diagonal.

    A row of the alignment is kept as bits, one per place of ``a`` (0 where the length steps up), and moves on by one sum per
    element of ``b``; blocks of ``b`` only touch the places that the band allows.
    """
    state = (1 << len(a)) - 1
    step = max(64, band)
    for start in range(0, len(b), step):
        low, high = max(0, start - band), min(len(a), start + step + band)
        if low >= high:
            break
        full = (1 << (high - low)) - 1
        masks: dict[int, int] = {}
        for place, item in enumerate(a[low:high]):
            masks[item] = masks.get(item, 0) | (1 << place)
        here = (state >> low) & full
        for item in b[start:start + step]:
            mask = masks.get(item)
            if mask:
                both = here & mask
                here = ((here + both) | (here - both)) & full
        state = (state & ~(full << low)) | (here << low)
    return len(a) - state.bit_count()


def _needed(total: int, least: float) -> int:
    """Shingles to be aligned out of ``total`` of two texts."""
    return int(np.ceil(total * least / (1 + least) - 1e-9))


def _shingles(tokens: bytes) -> np.ndarray:
    words = np.frombuffer(tokens, dtype=np.uint32).astype(np.uint64)
    return windows(words, np.array([0, len(words)]), WIDTH)[0]


def _alike(a: np.ndarray, b: np.ndarray, least: float) -> bool:
    """Whether two runs of shingles align to ``least`` or more."""
    needed = _needed(len(a) + len(b), least)
    if not len(a) or not len(b) or min(len(a), len(b)) < needed:
        return False
    short = min(len(a), len(b))
    differ = np.flatnonzero(a[:short] != b[:short])
    head = int(differ[0]) if len(differ) else short
    a, b = a[head:], b[head:]
    short = min(len(a), len(b))
    differ = np.flatnonzero(a[::-1][:short] != b[::-1][:short])
    tail = int(differ[0]) if len(differ) else short
    a, b = a[:len(a) - tail], b[:len(b) - tail]
    rest = needed - head - tail
    if rest <= 0:
        return True
    values, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    both = np.minimum(np.bincount(place[:len(a)], minlength=len(values)),
                      np.bincount(place[len(a):], minlength=len(values)))
    band = len(a) + len(b) - 2 * rest
    return both.sum() >= rest and band >= 0 and _aligned(a.tolist(), b.tolist(), band) >= rest


def similar(first: bytes, second: bytes, least: float = SIMILARITY) -> bool:
    """Whether the shingles of two token runs align to ``least`` or more."""
    return _alike(_shingles(first), _shingles(second), least)


def _verified(pairs: DataFrame, tokens: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose texts are similar. Pairs of one ``a`` are dealt out in parts of about ``PER_LEADER``."""
    degree = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PER_LEADER).alias("parts"))
    dealt = pairs.join(degree, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts"))).drop("parts")
    right = dealt.join(tokens.withColumnsRenamed({"node": "b", "tokens": "right"}), "b")
    left = dealt.select("a", "part").distinct().join(tokens.withColumnsRenamed({"node": "a", "tokens": "left"}), "a")
    both = right.join(left, ["a", "part"]).select("a", "b", "left", "right")
    schema = T.StructType([both.schema["a"], both.schema["b"]])

    def check(batch: pa.RecordBatch) -> dict:
        left, right = batch.column(2), batch.column(3)
        keep = pa.array([similar(x.as_py(), y.as_py(), least) for x, y in zip(left, right)])
        return {"a": batch.column(0).filter(keep), "b": batch.column(1).filter(keep)}

    return over_batches(both, check, schema)


def components(links: DataFrame) -> DataFrame:
    """(node, root) for the nodes of links (a, b): the least node that links lead to.

    Every round a node takes the least root among those of its neighbours, of its root and of itself, which one join and one
    grouping bring; rounds grow with the logarithm of the longest chain.
    """
    edges = stage(links.union(links.select("b", "a")).distinct(), "edges")
    roots = stage(edges.groupBy("a").agg(F.min("b").alias("root")).select(
        F.col("a").alias("node"), F.least("a", "root").alias("root")), "roots")
    while True:
        own, ahead = roots.select(F.col("node").alias("a"), F.col("node").alias("b")), roots.select(
            F.col("node").alias("a"), F.col("root").alias("b"))
        asked = edges.union(ahead).withColumn("own", F.lit(False)).union(own.withColumn("own", F.lit(True)))
        moved = stage(asked.join(roots, asked["b"] == roots["node"]).groupBy("a").agg(
            F.min("root").alias("new"), F.min(F.when(F.col("own"), F.col("root"))).alias("old")), "roots")
        settled = moved.filter(F.col("new") != F.col("old")).isEmpty()
        roots = moved.select(F.col("a").alias("node"), F.col("new").alias("root"))
        if settled:
            return roots


def _open_buckets(buckets: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows (key, used, node, root, n) of the buckets (key, used, node) that hold more than one root."""
    own = stage(buckets.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "members")
    sizes = own.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("low"), F.max("root").alias("high"))
    return own.join(sizes.filter("low != high").select("key", "n"), "key").select("key", "used", "node", "root", "n")


def _led(members: DataFrame, turn: int) -> DataFrame:
    """(key, a, b): the other nodes b of every bucket (key, node) with the node a that leads it this turn."""
    first = F.min(F.struct(F.xxhash64(F.lit(turn), "node").alias("order"), "node")).alias("first")
    leaders = members.groupBy("key").agg(first).select("key", F.col("first.node").alias("a"))
    return members.join(leaders, "key").filter("node != a").select("key", "a", F.col("node").alias("b"))


def _shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """(left, right) numbers of labelled shingles that each two texts share."""
    def rows(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        row = np.repeat(np.arange(len(parts)), [len(x) for x in parts])
        shingles = np.concatenate(parts) if parts else np.empty(0, np.uint64)
        return row, _labelled(shingles, row)

    (row_a, a), (row_b, b) = rows(left), rows(right)
    common = np.intersect1d(a, b)
    out = np.zeros((len(left), len(right)))
    keep_a, keep_b = np.isin(a, common), np.isin(b, common)
    row_a, a, row_b, b = row_a[keep_a], np.searchsorted(common, a[keep_a]), row_b[keep_b], np.searchsorted(common, b[keep_b])
    for first in range(0, len(common), COLUMNS):
        sides = []
        for row, column, size in ((row_a, a, len(left)), (row_b, b, len(right))):
            side = np.zeros((size, COLUMNS), dtype=np.float32)
            here = (column >= first) & (column < first + COLUMNS)
            side[row[here], column[here] - first] = 1
            sides.append(side)
        out += sides[0] @ sides[1].T
    return out


def _block_links(left: list[dict], right: list[dict], band: int, least: float) -> list[tuple[bytes, bytes]]:
    """Links between the nodes of two blocks, one for every two groups that have any.

    Pairs that agree on an earlier sketch meet in that one's bucket.
    """
    agree = np.array([x["sketches"] for x in left])[:, None, :] == np.array([x["sketches"] for x in right])[None, :, :]
    wanted = (agree.argmax(axis=2) == band) & agree.any(axis=2)
    groups = {root: i for i, root in enumerate({x["root"] for x in (*left, *right)})}
    group_a, group_b = (np.array([groups[x["root"]] for x in side]) for side in (left, right))
    wanted &= group_a[:, None] != group_b[None, :]
    if not wanted.any():
        return []
    runs_a, runs_b = ([_shingles(x["tokens"]) for x in side] for side in (left, right))
    size_a, size_b = (np.array([len(x) for x in runs]) for runs in (runs_a, runs_b))
    needed = np.ceil((size_a[:, None] + size_b[None, :]) * least / (1 + least) - 1e-9)
    # texts of too different lengths cannot be similar; the rest of the blocks is compared
    wanted &= np.minimum(size_a[:, None], size_b[None, :]) >= needed
    rows, columns = np.flatnonzero(wanted.any(axis=1)), np.flatnonzero(wanted.any(axis=0))
    if not len(rows):
        return []
    shared = np.zeros(wanted.shape)
    shared[np.ix_(rows, columns)] = _shared([runs_a[i] for i in rows], [runs_b[j] for j in columns])
    found, parent = [], list(range(len(groups)))

    def top(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in zip(*np.nonzero(wanted & (shared >= needed))):
        one, two = top(group_a[i]), top(group_b[j])
        if one != two and _alike(runs_a[i], runs_b[j], least):
            parent[one] = two
            found.append((left[i]["node"], right[j]["node"]))
    return found


def _open_links(members: DataFrame, reps: DataFrame, tokens: DataFrame, least: float) -> DataFrame:
    """Links (a, b) between nodes of different groups in buckets (key, used, node, root, n).

    Nodes of a bucket's largest group form blocks of their own, numbered below 0, which need not meet each other.
    """
    size = BLOCK
    groups = members.groupBy("key", "root").agg(F.count(F.lit(1)).alias("size"))
    largest = groups.groupBy("key").agg(F.max(F.struct("size", "root")).alias("most"))
    known = members.join(largest, "key")
    main = F.ceil(F.col("most.size") / size)
    rest = F.ceil((F.col("n") - F.col("most.size")) / size)
    block = F.when(F.col("root") == F.col("most.root"), -1 - F.pmod(F.xxhash64("node"), main)).otherwise(
        F.pmod(F.xxhash64("node"), rest))
    placed = known.select("key", "used", "node", "root", main.alias("main"), rest.alias("rest"), block.alias("block"))
    nodes = placed.join(reps.select("node", "sketches"), "node").join(tokens, "node")
    packed = stage(nodes.groupBy("key", "used", "main", "rest", "block").agg(
        F.collect_list(F.struct("node", "root", "sketches", "tokens")).alias("nodes")), "blocks")
    meets = F.concat(F.sequence(F.col("block"), F.col("rest") - 1), F.sequence(-F.col("main"), F.lit(-1).cast("bigint")))
    left = packed.filter("block >= 0").select("key", "used", F.col("nodes").alias("left"), F.explode(meets).alias("block"))
    both = left.join(packed.select("key", "block", F.col("nodes").alias("right")), ["key", "block"]).select(
        "used", "left", "right")
    node = T.StructField("a", T.BinaryType())

    def search(batch: pa.RecordBatch) -> dict:
        found = []
        for at in range(batch.num_rows):
            used, left, right = (batch.column(i)[at].as_py() for i in range(3))
            found += _block_links(left, right, used, least)
        return {"a": _binary([x for x, _ in found]), "b": _binary([x for _, x in found])}

    return over_batches(both, search, T.StructType([node, T.StructField("b", T.BinaryType())]))


def _linked(buckets: DataFrame, reps: DataFrame, tokens: DataFrame, similarity: float) -> DataFrame:
    """(node, root) of all nodes that have a link.

    The second leader of a bucket leads the nodes that are not linked to the first one.
    """
    spark = buckets.sparkSession
    members, parts = buckets.select("key", "node"), []
    for turn in range(LEADERS):
        led = stage(_led(members, turn), "pairs")
        parts.append(stage(_verified(led.select("a", "b").distinct(), tokens, similarity), "links"))
        members = led.join(parts[-1], ["a", "b"], "left_anti").select("key", F.col("b").alias("node"))
    links = functools.reduce(DataFrame.union, parts)
    roots = components(links)
    members = stage(_open_buckets(buckets, roots), "members")
    with arrow_rows(spark, BLOCK_BATCH):
        found = stage(_open_links(members, reps, tokens, similarity), "links")
    return roots if found.isEmpty() else components(links.union(found))


def _rep(*columns) -> F.Column:
    """The row with the least id, ids that are there first."""
    return F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row_key", *columns))


def row_key(key: str, text: str):
    """64 bits of a row's id and text; with the id it names the row's copies."""
    return F.xxhash64(F.col(key).isNull(), F.col(key), F.col(text).isNull(), F.col(text))


def near_classes(documents: DataFrame, key: str = "doc_id", text: str = "text",
                 similarity: float = SIMILARITY) -> DataFrame:
    """(id, row_key, class_id, class_row_key) for every row: the class is named by its row with the least id.

    Null texts are classes of their own; texts without words are alike only if they are equal. A null id never names a class
    that has another id. Ties of ids are broken by ``row_key``, repeated rows are equal in all columns. An empty table
    gives an empty result. Other columns are not read.
    """
    small_batches(documents.sparkSession)
    source = documents.select(F.col(key).alias("id"), F.col(text).alias("text")).withColumn(
        "row_key", row_key("id", "text"))
    schema = T.StructType([
        source.schema["id"], source.schema["row_key"], T.StructField("node", T.BinaryType()),
        T.StructField("sketches", T.ArrayType(T.LongType()))])
    rows = stage(over_batches(source, lambda batch: {
        "id": batch.column(0), "row_key": batch.column(2), **_describe(batch.column(1))}, schema), "sketches")
    reps = stage(rows.filter("node IS NOT NULL").groupBy("node").agg(_rep("sketches").alias("rep")).select(
        "node", "rep.id", "rep.row_key", "rep.sketches"), "nodes")

    buckets = reps.select("node", F.posexplode("sketches").alias("used", "key"))
    often = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    shared = stage(buckets.join(often, "key"), "buckets")
    wanted = shared.select("node").distinct().join(reps.select("node", "id", "row_key"), "node")
    texts = source.withColumnRenamed("id", "own").join(wanted, "row_key").filter(F.col("own").eqNullSafe(F.col("id")))
    token_schema = T.StructType([reps.schema["node"], T.StructField("tokens", T.BinaryType())])
    tokens = stage(over_batches(texts.select("node", "text"), lambda batch: {
        "node": batch.column(0), "tokens": _tokens(batch.column(1))}, token_schema).dropDuplicates(["node"]), "tokens")
    roots = _linked(shared, reps, tokens, similarity)

    grouped = reps.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = grouped.groupBy("root").agg(_rep().alias("rep")).select(
        "root", F.col("rep.id").alias("class_id"), F.col("rep.row_key").alias("class_row_key"))
    classes = stage(grouped.select("node", "root").join(named, "root").drop("root"), "classes")
    return rows.select("id", "row_key", "node").join(classes, "node", "left").select(
        "id", "row_key",
        F.when(F.col("class_row_key").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_row_key", "row_key").alias("class_row_key"))


def near_dedup(documents: DataFrame, key: str = "doc_id", text: str = "text",
               similarity: float = SIMILARITY) -> DataFrame:
    """``documents`` with one row of each class, the one that names it; rows equal in id and text count once.

    Null texts stay. Columns stay as they are.
    """
    kept = near_classes(documents, key, text, similarity).filter(
        F.col("row_key") == F.col("class_row_key")).filter(F.col("id").eqNullSafe(F.col("class_id")))
    own = fresh(documents, "row_key")
    chosen = kept.select(F.col("row_key").alias(own)).distinct()
    marked = documents.withColumn(own, row_key(key, text))
    return marked.join(chosen, own, "left_semi").dropDuplicates([own, key]).drop(own)


def op2_near_dedup(documents: DataFrame) -> DataFrame:
    """doc_id, class_id and whether the row stays, for every row of ``documents``."""
    return near_classes(documents).select(
        F.col("id").alias("doc_id"), "class_id",
        (F.col("row_key") == F.col("class_row_key")).alias("kept"))
