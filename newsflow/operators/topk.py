"""Exact top-k of points for a table of queries.

Queries are packed into blocks of bounded size and staged; neither they nor the points pass through the driver. A single block is
broadcast to the points, which then stay where they are and are searched batch by batch. More blocks meet the points in a grid: points are dealt into parts that fit a
task, each crosses the shuffle once, and every block once per part. A task packs the points of its part into pieces,
strongest first, and runs the blocks over them one by one.

Dense scores are matrix products. Sparse scores come from the inverted lists of a piece, so that only rows sharing a
token with a query are touched; the greatest weight per token and piece bounds what a query can score there, and pieces that
cannot reach a query's k-th score so far are passed over, which loses nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from newsflow.session import estimated_bytes, stage

# Sums differ in their last bits by the order of summation; scores are compared at this many decimals, equal ones by id.
SCORE_DECIMALS = 12
QUERY_BLOCK_BYTES = 16 << 20
# Points, by Catalyst's estimate, that a task of the grid holds at a time, and the least it is worth to deal out.
PART_BYTES, LEAST_PART_BYTES = 64 << 20, 1 << 20
PIECE_ROWS = 2048
DENSE, SPARSE = "dense", "sparse"
_CELLS = 1 << 20
_MATCHES = 1 << 20
# The low bits of Spark's increasing ids: the place of a row in its partition.
_ROW_BITS = 33
# Catalyst's estimate of what it knows nothing about is beyond this.
_UNKNOWN_BYTES = 1 << 55


class _Best:
    """The k best (score, id) per query of a block seen by one task."""

    def __init__(self, queries: list, k: int) -> None:
        self.k, self.queries = k, queries
        self.floor = np.full(len(queries), -np.inf)
        self.query = np.empty(0, dtype=np.int64)
        self.score = np.empty(0)
        self.id: np.ndarray | None = None

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Hits as pairs of a query and a point; equal pairs must not come twice."""
        held = score >= self.floor[query]
        if not held.any():
            return
        query = np.concatenate([self.query, query[held]])
        score = np.concatenate([self.score, score[held]])
        found = ids[held] if self.id is None else np.concatenate([self.id, ids[held]])
        order = np.lexsort((found, -score, query))
        query, score, found = query[order], score[order], found[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query, side="left")
        best = rank < self.k
        self.query, self.score, self.id = query[best], score[best], found[best]
        full = rank == self.k - 1
        self.floor[query[full]] = score[full]


def _matrix(vectors: pa.ListArray, width: int) -> np.ndarray:
    """Rows of an array column, scaled to length 1; zero rows stay zero."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(flat) != width * len(vectors):
        raise ValueError(f"every vector must have {width} values")
    rows = flat.reshape(len(vectors), width)
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, length, out=np.zeros_like(rows), where=length > 0)


def _entries(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, token id and weight of every entry of an array column, in order of tokens."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    flat = column.flatten()
    owner = np.repeat(np.arange(len(column)), sizes)
    token = flat.field(0).to_numpy(zero_copy_only=False).astype(np.int64)
    weight = flat.field(1).to_numpy(zero_copy_only=False).astype(np.float64)
    order = np.argsort(token, kind="stable")
    return owner[order], token[order], weight[order]


_PACKED = ("dense", "owner", "token", "weight")
_KINDS = (np.float64, np.int64, np.int64, np.float64)


def _pack(table: pa.Table | pa.RecordBatch, width: int) -> dict[str, bytes | None]:
    """The vectors and entries of rows as bytes."""
    out: dict[str, bytes | None] = dict.fromkeys(_PACKED)
    names = table.schema.names
    if "vector" in names:
        out["dense"] = _matrix(_whole(table.column("vector")), width).tobytes()
    if "entries" in names:
        out |= {name: part.tobytes() for name, part in zip(_PACKED[1:], _entries(_whole(table.column("entries"))))}
    return out


def _whole(column):
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _packed_fields(prefix: str) -> list[T.StructField]:
    return [T.StructField(prefix + name, T.BinaryType()) for name in _PACKED]


def _unpacked(row: dict, prefix: str) -> list:
    return [None if row[prefix + name] is None else np.frombuffer(row[prefix + name], kind) for name, kind in zip(_PACKED, _KINDS)]


class _Piece:
    """Some points: their vectors, and the inverted lists of their entries with the greatest and least weight of each token."""

    def __init__(self, ids: np.ndarray, dense: np.ndarray | None, owner: np.ndarray | None, token: np.ndarray | None,
                 weight: np.ndarray | None) -> None:
        self.ids = ids
        self.dense = None if dense is None else dense.reshape(len(ids), -1)
        self.sparse = token is not None
        if self.sparse:
            self.owner, self.weight = owner, weight
            self.token, first = np.unique(token, return_index=True)
            self.first, self.count = first, np.diff(np.append(first, len(token)))
            self.top = np.maximum.reduceat(weight, first) if len(first) else weight
            self.low = np.minimum.reduceat(weight, first) if len(first) else weight

    def dense_hits(self, asked: np.ndarray, best: _Best) -> None:
        """All points against all queries, in steps of bounded size."""
        step = max(1, _CELLS // max(1, len(asked)))
        for at in range(0, len(self.ids), step):
            scores = np.round(self.dense[at:at + step] @ asked.T, SCORE_DECIMALS)
            floor = best.floor
            if len(scores) > best.k:
                cut = len(scores) - best.k
                floor = np.maximum(floor, np.partition(scores, cut, axis=0)[cut])
            row, query = np.nonzero(scores >= floor)
            best.add(query, scores[row, query], self.ids[at + row])

    def sparse_hits(self, query: np.ndarray, token: np.ndarray, value: np.ndarray, best: _Best) -> None:
        """Points that share a token with a query, unless the query cannot reach its k-th score here."""
        if not len(self.token):
            return
        place = np.minimum(np.searchsorted(self.token, token), len(self.token) - 1)
        shared = np.flatnonzero(self.token[place] == token)
        query, value, place = query[shared], value[shared], place[shared]
        most = np.maximum(np.maximum(value * self.top[place], value * self.low[place]), 0)
        reach = np.bincount(query, most, len(best.queries))
        # sums may differ in their last bits
        open_to = reach + 1e-9 * (1 + np.abs(reach)) >= best.floor
        live = np.flatnonzero(open_to[query])
        live = live[np.argsort(query[live], kind="stable")]
        query, value, place = query[live], value[live], place[live]
        done = np.cumsum(self.count[place])
        at = 0
        while at < len(query):
            # whole queries, up to a bound of matches
            last = int(np.searchsorted(done, (done[at - 1] if at else 0) + _MATCHES, side="right"))
            last = int(np.searchsorted(query, query[last], side="left")) if last < len(query) else last
            if last <= at:
                last = int(np.searchsorted(query, query[at], side="right"))
            self._score(query[at:last], value[at:last], place[at:last], best)
            at = last

    def _score(self, query: np.ndarray, value: np.ndarray, place: np.ndarray, best: _Best) -> None:
        n = self.count[place]
        posting = np.repeat(self.first[place], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        weight = np.repeat(value, n) * self.weight[posting]
        cell = np.repeat(query - query[0], n) * len(self.ids) + self.owner[posting]
        cells = int(query[-1] - query[0] + 1) * len(self.ids)
        if cells <= 4 * len(cell):
            hit = np.flatnonzero(np.bincount(cell, minlength=cells))
            score = np.bincount(cell, weight, cells)[hit]
        else:
            hit, which = np.unique(cell, return_inverse=True)
            score = np.bincount(which, weight, len(hit))
        best.add(query[0] + hit // len(self.ids), np.round(score, SCORE_DECIMALS), self.ids[hit % len(self.ids)])


def _pieces(table: pa.Table, sides: list[str], width: int) -> Iterator[_Piece]:
    """The rows of a table in pieces of bounded size."""
    for at in range(0, len(table), PIECE_ROWS):
        some = table.slice(at, PIECE_ROWS).combine_chunks()
        dense = _matrix(_whole(some.column("vector")), width) if "vector" in sides else None
        sparse = _entries(_whole(some.column("entries"))) if "entries" in sides else (None, None, None)
        yield _Piece(np.asarray(some.column("id").to_pylist()), dense, *sparse)


class _Block:
    """A block of queries and the best points found for it, by side."""

    def __init__(self, row: dict, k: int) -> None:
        self.queries = row["query_ids"]
        dense, self.owner, self.token, self.weight = _unpacked(row, "q_")
        self.dense = None if dense is None else dense.reshape(len(self.queries), -1)
        self.best = {side: _Best(self.queries, k) for side in (DENSE, SPARSE)}

    def search(self, piece: _Piece) -> None:
        if piece.dense is not None and self.dense is not None:
            piece.dense_hits(self.dense, self.best[DENSE])
        if piece.sparse and self.token is not None:
            piece.sparse_hits(self.owner, self.token, self.weight, self.best[SPARSE])

    def hits(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        for side, best in self.best.items():
            if best.id is not None:
                yield pa.RecordBatch.from_arrays([
                    pa.array([side] * len(best.query), schema.field(0).type),
                    pa.array([self.queries[q] for q in best.query], schema.field(1).type),
                    pa.array(best.id.tolist(), schema.field(2).type),
                    pa.array(best.score, schema.field(3).type)], schema=schema)


def _query_blocks(queries: DataFrame, width: int, blocks: int) -> DataFrame:
    """(block, query_ids, packed columns), staged."""
    numbered = queries.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
    ids = T.StructField("query_ids", T.ArrayType(queries.schema["query_id"].dataType))
    schema = T.StructType([T.StructField("block", T.IntegerType()), ids, *_packed_fields("q_")])
    names = to_arrow_schema(schema)

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        packed = {f"q_{name}": [value] for name, value in _pack(table, width).items()}
        row = {"block": [key[0].as_py()], "query_ids": [table.column("query_id").to_pylist()], **packed}
        return pa.table([pa.array(row[field.name], field.type) for field in names], schema=names)

    return stage(numbered.groupBy("block").applyInArrow(pack, schema), "queries")


def _hit_schema(queries: DataFrame, points: DataFrame) -> T.StructType:
    return T.StructType([
        T.StructField("side", T.StringType()),
        T.StructField("query_id", queries.schema["query_id"].dataType),
        T.StructField("id", points.schema["id"].dataType),
        T.StructField("score", T.DoubleType()),
    ])


def _beside(points: DataFrame, block: DataFrame, width: int, k: int, schema: T.StructType) -> DataFrame:
    """The best points of every task for the only block, which is broadcast to the points and handed to the first row of each task."""
    sides = [name for name in ("vector", "entries") if name in points.columns]
    out, held = to_arrow_schema(schema), [name for name in block.columns if name != "block"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if found is None and len(table):
                found = _Block(table.slice(0, 1).select(held).to_pylist()[0], k)
            for piece in _pieces(table, sides, width):
                found.search(piece)
        if found:
            yield from found.hits(out)

    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    # the only block has number 0
    return points.withColumn("block", place).join(F.broadcast(block), "block", "left").mapInArrow(search, schema)


def _dealt(points: DataFrame, blocks: DataFrame, parts: int) -> DataFrame:
    """Points and blocks by part: a row per point, then a row per block; the strongest points come first."""
    strength = F.array_max(F.transform("entries", lambda entry: entry["weight"])) if "entries" in points.columns else F.lit(0)
    rows = points.select("*", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("part"), strength.cast("double").alias("strength"))
    copies = blocks.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    both = rows.unionByName(copies, allowMissingColumns=True)
    return both.repartition(parts, "part").sortWithinPartitions("part", F.col("block").asc_nulls_first(), F.desc("strength"))


def _grid(points: DataFrame, blocks: DataFrame, width: int, parts: int, k: int, schema: T.StructType) -> DataFrame:
    """The best points of every part for every block."""
    sides = [name for name in ("vector", "entries") if name in points.columns]
    out = to_arrow_schema(schema)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, ready = None, [], []
        for batch in batches:
            table = pa.Table.from_batches([batch])
            numbers, is_point = table.column("part").to_numpy(), table.column("block").is_null().to_numpy()
            cuts = np.flatnonzero((numbers[1:] != numbers[:-1]) | (is_point[1:] != is_point[:-1])) + 1
            for first, last in zip([0, *cuts], [*cuts, len(table)]):
                if numbers[first] != part:
                    part, held, ready = numbers[first], [], []
                some = table.slice(first, last - first)
                if is_point[first]:
                    held.append(some.select(["id", *sides]))
                    continue
                if held:
                    ready, held = list(_pieces(pa.concat_tables(held), sides, width)), []
                for at in range(len(some) if ready else 0):
                    block = _Block(some.slice(at, 1).to_pylist()[0], k)
                    for piece in ready:
                        block.search(piece)
                    yield from block.hits(out)

    return _dealt(points, blocks, parts).mapInArrow(search, schema)


def topk(queries: DataFrame, points: DataFrame, k: int = 50) -> DataFrame:
    """(side, query_id, id, score, rank) by one scan of the points.

    Queries (query_id) and points (id, each once) may both have ``vector`` (side dense: cosine) and ``entries`` (side sparse: dot product
    over shared token ids).
    """
    sides = [name for name in ("vector", "entries") if name in queries.columns and name in points.columns]
    sizes = [F.count(F.lit(1)).alias("count"), *[F.max(F.size(name)).alias(name) for name in sides]]
    row = queries.agg(*sizes).first().asDict()
    schema = _hit_schema(queries, points)
    if not row["count"] or not sides:
        return queries.sparkSession.createDataFrame([], schema).withColumn("rank", F.lit(0))
    width = max(1, row.get("vector") or 1)
    per_block = max(1, QUERY_BLOCK_BYTES // (8 * width + 24 * (row.get("entries") or 0)))
    count = math.ceil(row["count"] / per_block)
    blocks = _query_blocks(queries.select("query_id", *sides), width, count)
    held = points.select("id", *sides)
    if count == 1:
        found = _beside(held, blocks, width, k, schema)
    else:
        size = estimated_bytes(held)
        if size >= _UNKNOWN_BYTES:
            size = held.count() * 24 * (width + (row.get("entries") or 0))
        cores = points.sparkSession.sparkContext.defaultParallelism
        parts = max(math.ceil(size / PART_BYTES), min(cores, math.ceil(size / LEAST_PART_BYTES)), 1)
        found = _grid(held, blocks, width, parts, k, schema)
    order = Window.partitionBy("side", "query_id").orderBy(F.desc("score"), F.col("id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def dense_topk(queries: DataFrame, points: DataFrame, k: int = 50) -> DataFrame:
    """Cosine top-k: queries (query_id, vector), points (id, vector) to (query_id, id, score, rank)."""
    return topk(queries.select("query_id", "vector"), points.select("id", "vector"), k).drop("side")


def sparse_topk(queries: DataFrame, points: DataFrame, k: int = 50) -> DataFrame:
    """Dot-product top-k over shared token ids; ``entries`` is an array of (id, weight) on both sides."""
    return topk(queries.select("query_id", "entries"), points.select("id", "entries"), k).drop("side")
