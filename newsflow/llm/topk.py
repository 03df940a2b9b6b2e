"""Exact top-k by inner product over a bit-sliced index.

Components become integers. An index block holds, for each dimension, the upper bits of its rows' values as slices: one bitmap over
rows per bit. A query's coarse scores are sums of slices, added bit by bit with bitmap arithmetic; a negative weight adds the
complement of the slices. The k-th coarse score is found from the most significant slice of the sum downward, all rows that the error
of the coarse values leaves in reach of it are the boundary, and their scores are computed exactly from the whole integers.

Rows travel in index blocks and queries in query blocks. A task takes an index block, slices it once, and runs the query blocks over
it one by one; every pair of blocks meets once and gives k rows per query at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from newsflow.session import stage

SCALE = 1024
BLOCK_ROWS = 1 << 14
QUERY_ROWS = 256
SLICES = 6
TOP = 10


def _digits(weight: int) -> list[tuple[int, int]]:
    """(power, sign) of the non-adjacent form: a number as few signed powers of two."""
    out, power = [], 0
    while weight:
        if weight & 1:
            sign = 2 - (weight & 3)
            weight -= sign
            out.append((power, sign))
        weight >>= 1
        power += 1
    return out


class SlicedBlock:
    """Bit slices of the upper bits of an integer matrix (rows, dimensions)."""

    def __init__(self, values: np.ndarray, slices: int = SLICES) -> None:
        self.values = values
        self.rows = len(values)
        self.low = values.min(axis=0) if self.rows else np.zeros(values.shape[1], dtype=values.dtype)
        spread = values - self.low
        bits = int(spread.max(initial=0)).bit_length()
        self.cut = max(0, bits - slices)
        self.bits = bits - self.cut
        upper = spread >> self.cut
        padded = np.zeros((-(-max(self.rows, 1) // 64) * 64, values.shape[1]), dtype=upper.dtype)
        padded[:self.rows] = upper
        # slices[d][b] is the bitmap of bit b of dimension d
        self.slices = [
            [np.packbits((padded[:, d] >> b) & 1, bitorder="little").view(np.uint64) for b in range(self.bits)]
            for d in range(values.shape[1])]
        rest = (spread - (upper << self.cut)).astype(np.float64) - ((1 << self.cut) - 1) / 2
        self.rest = float(np.sqrt((rest * rest).sum(axis=1).max(initial=0.0)))
        full = np.zeros(len(padded), dtype=np.uint8)
        full[:self.rows] = 1
        self.full = np.packbits(full, bitorder="little").view(np.uint64)

    def coarse(self, weights: list[int]) -> list[np.ndarray]:
        """Slices, least significant first, of the sum of weight * upper bits, less a constant of the query."""
        waiting: list[list[np.ndarray]] = []

        def put(power: int, bitmap: np.ndarray) -> None:
            while len(waiting) <= power:
                waiting.append([])
            waiting[power].append(bitmap)

        for weight, own in zip(weights, self.slices):
            for power, sign in _digits(weight):
                for bit, bitmap in enumerate(own):
                    put(power + bit, bitmap if sign > 0 else ~bitmap)
        # carry-save addition: three bitmaps of one power become one of it and one of the next
        out, power = [], 0
        while power < len(waiting):
            column = waiting[power]
            while len(column) > 2:
                a, b, c = column.pop(), column.pop(), column.pop()
                half = a ^ b
                column.append(half ^ c)
                put(power + 1, (a & b) | (half & c))
            if len(column) == 2:
                a, b = column.pop(), column.pop()
                column.append(a ^ b)
                put(power + 1, a & b)
            out.append(column[0] if column else np.zeros_like(self.full))
            power += 1
        return out

    def boundary(self, sums: list[np.ndarray], k: int, slack: int) -> np.ndarray:
        """Rows whose coarse score is at least that of the k-th best row less ``slack``."""
        if self.rows <= k:
            return np.arange(self.rows)
        even, need, score = self.full, k, 0
        for power in range(len(sums) - 1, -1, -1):
            ones = even & sums[power]
            count = int(np.bitwise_count(ones).sum())
            if count >= need:
                even = ones
                score |= 1 << power
            else:
                need -= count
                even = even & ~sums[power]
        least = score - slack
        if least <= 0:
            return np.arange(self.rows)
        above, even = np.zeros_like(self.full), self.full
        for power in range(max(len(sums), least.bit_length()) - 1, -1, -1):
            bitmap = sums[power] if power < len(sums) else np.zeros_like(self.full)
            if least >> power & 1:
                even = even & bitmap
            else:
                above = above | (even & bitmap)
                even = even & ~bitmap
        return np.flatnonzero(np.unpackbits((above | even).view(np.uint8), bitorder="little"))

    def top(self, query: np.ndarray, ids: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of the k best rows other than those of id ``own``, ties to smaller ids."""
        weights = query.tolist()
        norm = float(np.sqrt((query.astype(np.float64) ** 2).sum()))
        # coarse scores are in units of 2 ** cut; two rows' errors add up
        slack = int(np.ceil(2 * norm * self.rest / (1 << self.cut) + 1e-6))
        mine = int(np.count_nonzero(ids == own))
        rows = self.boundary(self.coarse(weights), k + mine, slack)
        rows = rows[ids[rows] != own]
        scores = self.values[rows] @ query
        order = np.lexsort((ids[rows], -scores))[:k]
        return rows[order], scores[order]


def _integers(packed: bytes, width: int) -> np.ndarray:
    return np.frombuffer(packed, dtype=np.int64).reshape(-1, width)


def scaled(vector, scale: float = SCALE):
    """floor(scale * x) of every component, x as double, as bigint."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))


def usable(vector):
    """Whether a vector is there and all its components are finite numbers."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (
        F.abs(x.cast("double")) < float("inf"))), F.lit(False))


def _blocks(rows: DataFrame, per_block: int, width: int, name: str, repeated: bool) -> DataFrame:
    """(block, ids, values): about ``per_block`` rows packed in one, numbered from 0.

    A row's block depends on all of it and, where rows are ``repeated``, on its place in the input, so that copies part too.
    """
    count = max(1, -(-rows.count() // per_block))
    place = [F.monotonically_increasing_id()] if repeated else []
    spread = rows.withColumn("block", F.pmod(F.xxhash64("id", "vector", *place), F.lit(count)))
    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("ids", T.BinaryType()), T.StructField("values", T.BinaryType())])

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy().astype(np.int64)
        vectors = table.column("vector").combine_chunks()
        bounds = vectors.offsets.to_numpy().astype(np.int64)
        flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        bounds = bounds - bounds[0]
        values = np.zeros((len(ids), width), dtype=np.int64)
        row = np.repeat(np.arange(len(ids)), np.diff(bounds))
        values[row, np.arange(len(flat)) - bounds[:-1][row]] = flat
        return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "ids": pa.array([ids.tobytes()], pa.binary()),
                         "values": pa.array([values.tobytes()], pa.binary())})

    packed = spread.groupBy("block").applyInArrow(pack, schema)
    return stage(packed, name)


HITS = T.StructType([T.StructField(name, T.LongType()) for name in ("query_id", "id", "score")])


def _met(index: DataFrame, asking: DataFrame, count: int, asked: int) -> DataFrame:
    """Rows (block, lane, query_block, ids, values): an index block, then the query blocks that it meets.

    An index block crosses the shuffle once per lane, a query block once per index block. There is more than one lane only where there are
    fewer index blocks than cores.
    """
    lanes = max(1, min(asked, -(-index.sparkSession.sparkContext.defaultParallelism // count)))
    blocks = index.select("block", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane"), F.lit(None).cast("bigint").alias("query_block"),
                          "ids", "values")
    copies = asking.select(
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(count - 1).cast("bigint"))).alias("block"),
        F.pmod("query_block", F.lit(lanes)).cast("int").alias("lane"), "query_block", "ids", "values")
    return blocks.unionByName(copies).repartition(count * lanes, "block", "lane").sortWithinPartitions(
        "block", "lane", F.col("query_block").asc_nulls_first())


def _search(width: int, k: int):
    """The k best rows of an index block for each query that meets it; a block's slices are made once."""
    names = to_arrow_schema(HITS)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = ids = held = None
        for batch in batches:
            for at in range(batch.num_rows):
                number, _, query_block, some, values = (batch.column(i)[at].as_py() for i in range(5))
                some = np.frombuffer(some, dtype=np.int64)
                if query_block is None:
                    block, ids, held = SlicedBlock(_integers(values, width)), some, number
                # a number may have no rows
                if query_block is None or number != held:
                    continue
                hits = [(own, *block.top(query, ids, own, k)) for own, query in zip(some.tolist(), _integers(values, width))]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(some, [len(rows) for _, rows, _ in hits]), pa.int64()),
                    pa.array(np.concatenate([ids[rows] for _, rows, _ in hits]), pa.int64()),
                    pa.array(np.concatenate([scores for _, _, scores in hits]), pa.int64())], schema=names)

    return search


def top_k(vectors: DataFrame, queries: DataFrame, k: int = TOP, block_rows: int = BLOCK_ROWS,
          query_rows: int = QUERY_ROWS) -> DataFrame:
    """The k rows of ``vectors`` (id, vector of bigint) with the highest inner product, for each row of ``queries`` alike.

    (query_id, rank from 1, id, score); rows with the query's own id are left out, ties go to smaller ids, fewer rows
    than k give all. Shorter vectors count as filled up with zeros. Rows with a null id or vector take no part; repeated
    rows are candidates each, repeated queries count once. Scores are computed in 64 bits.
    """
    points = vectors.filter("id IS NOT NULL AND vector IS NOT NULL").select(F.col("id").cast("long"), "vector")
    asked = queries.filter("id IS NOT NULL AND vector IS NOT NULL").select(F.col("id").cast("long"), "vector").distinct()
    width = max(1, points.agg(F.max(F.size("vector"))).first()[0] or 1, asked.agg(F.max(F.size("vector"))).first()[0] or 1)
    index = _blocks(points, block_rows, width, "index", True)
    asking = _blocks(asked, query_rows, width, "queries", False).withColumnRenamed("block", "query_block")
    count, asked_count = ((x.agg(F.max(name)).first()[0] or 0) + 1 for x, name in ((index, "block"), (asking, "query_block")))
    found = _met(index, asking, count, asked_count).mapInArrow(_search(width, k), HITS)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "id", "score")


def op4_topk(embeddings: DataFrame) -> DataFrame:
    """query_id, rank, vec_id, score: the ten best rows for each row whose vec_id is divisible by 100."""
    rows = embeddings.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(
        F.col("vec_id").alias("id"), scaled(F.col("embedding")).alias("vector"))
    return top_k(rows, rows.filter(F.col("id") % 100 == 0)).select(
        "query_id", "rank", F.col("id").alias("vec_id"), "score")


OP4_SQL = f"""
WITH rows AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM (SELECT DISTINCT * FROM rows WHERE vec_id % 100 = 0) q JOIN rows c ON c.vec_id <> q.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {TOP}
"""
