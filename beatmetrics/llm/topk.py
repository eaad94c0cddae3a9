"""Exact top-k search by block-at-a-time pruning.

Rows are ordered by the anchors they lie nearest to and cut into shards of
blocks of neighbouring rows.  A component of a vector is a term; every block
knows the largest and the smallest weight of each term, and its rows' weights
as a forward index.  The largest score that a block can hold for a query is the
sum over terms of the query's weight times that maximum (minimum, for a negative
weight).  A query takes the blocks by falling bounds, scores their rows through
the forward index and stops when the next bound is below its k-th score.

Every query first searches the shard it stands in, which needs no shuffle; its
k-th score there is where the search of the other shards starts.  Queries then
go to all shards in tiles.  A task holds one shard and one tile at a time.
Scores are integers; they are computed in the narrowest type that holds them
exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beatmetrics.llm.common import ship, written

BLOCK = 32
TILE = 1024
# Rows of a shard: a part of the table, within these bounds.
SHARDS = 64
SHARD_ROWS = (2048, 65536)
# The order of the rows is fitted on so many vectors of a length.
ANCHORS = 256
NO_ID = (1 << 63) - 1
LONG = range(-(1 << 63), 1 << 63)

SHARD = "shard int, width int, row long, vec_id long, vector binary"


def _packed(x: np.ndarray) -> bytes:
    """Whole numbers in four bytes each where these hold them exactly."""
    small = not x.size or np.abs(x).max() < 2.0**24
    return (x.astype(np.float32) if small else x).tobytes()


def _numeric(data: list[bytes], width: int) -> np.ndarray:
    if len({len(d) for d in data}) > 1:
        return np.stack([_numeric([d], width)[0] for d in data])
    wide = bool(data) and len(data[0]) == 8 * width
    flat = np.frombuffer(b"".join(data), np.float64 if wide else np.float32)
    return flat.reshape(len(data), width).astype(np.float64)


def exact_type(width: int, a: float, b: float) -> type:
    """The narrowest type in which sums of ``width`` products are exact."""
    largest = width * max(a, 1) * max(b, 1)
    return np.float32 if largest < 2**24 else np.float64 if largest < 2**53 else object


def _as(kind: type, x: np.ndarray) -> np.ndarray:
    """The whole numbers in another type; as objects they are Python's integers."""
    return np.frompyfunc(int, 1, 1)(x) if kind is object else x.astype(kind)


class Shard:
    """Blocks of neighbouring rows with the bounds of their terms."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray):
        n, width = vectors.shape
        blocks = -(-n // BLOCK)
        pad = blocks * BLOCK - n
        # The last block is filled up with its own last row, which then stands for itself once.
        take = np.concatenate([np.arange(n), np.full(pad, n - 1)])
        self.forward = vectors[take].reshape(blocks, BLOCK, width)
        self.rows = np.concatenate([rows, np.full(pad, -1)]).reshape(blocks, BLOCK)
        self.ids = np.concatenate([ids, np.full(pad, NO_ID)]).reshape(blocks, BLOCK)
        self.most = self.forward.max(axis=1)
        self.least = self.forward.min(axis=1)
        self.size = float(np.abs(vectors).max()) if vectors.size else 0.0
        self.casts: dict = {}

    def cast(self, kind: type):
        if kind not in self.casts:
            parts = (self.forward, self.most, self.least)
            self.casts = {kind: [_as(kind, p) for p in parts]}
        return self.casts[kind]

    def search(self, rows, vectors, floors, k: int):
        """For each query its k best (score, id) here that reach its floor.

        ``floors`` are scores that the k-th best row is known to reach, or None.
        Rows of -1 in the result stand for nothing.
        """
        size = float(np.abs(vectors).max()) if vectors.size else 0.0
        width = vectors.shape[1]
        kind = exact_type(width, self.size, size)
        forward, most, least = self.cast(kind)
        q = _as(kind, vectors)
        n = len(q)
        bounds = np.maximum(q, 0) @ most.T + np.minimum(q, 0) @ least.T
        order = np.argsort(-bounds, axis=1, kind="stable")
        # Below every score.
        low = -(1 << 4096) if kind is object else -np.inf
        best = np.full((n, k), low, kind)
        ids = np.full((n, k), NO_ID)
        found = np.full((n, k), -1)
        floor = np.array([low if f is None else f for f in floors], kind)
        going = np.arange(n)
        for step in range(bounds.shape[1]):
            block = order[going, step]
            kth = np.maximum(best[going, -1], floor[going])
            on = bounds[going, block] >= kth
            going, block, kth = going[on], block[on], kth[on]
            if not len(going):
                break
            if kind is object:
                scores = (forward[block] * q[going][:, None, :]).sum(axis=2)
            else:
                scores = np.matmul(forward[block], q[going][:, :, None])[:, :, 0]
            fits = (scores >= kth[:, None]) & (self.rows[block] >= 0)
            fits &= self.rows[block] != rows[going][:, None]
            some = np.flatnonzero(fits.any(axis=1))
            if not len(some):
                continue
            here, at = going[some], block[some]
            s = np.concatenate([best[here], np.where(fits[some], scores[some], low)], axis=1)
            i = np.concatenate([ids[here], np.where(fits[some], self.ids[at], NO_ID)], axis=1)
            r = np.concatenate([found[here], np.where(fits[some], self.rows[at], -1)], axis=1)
            first = np.lexsort((r < 0, i, -s), axis=1)[:, :k]
            best[here] = np.take_along_axis(s, first, 1)
            ids[here] = np.take_along_axis(i, first, 1)
            found[here] = np.take_along_axis(r, first, 1)
        return best, ids, found


def _order(table: DataFrame, anchors: np.ndarray, width: int) -> DataFrame:
    """Adds a key that puts rows near the same anchors next to each other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _numeric(batch.column(2).to_pylist(), width)
            key = np.zeros(len(x), np.int64)
            if width and len(anchors):
                near = np.argsort(-(x @ anchors.T), axis=1, kind="stable")[:, :3]
                for rank in range(near.shape[1]):
                    key = key * ANCHORS + near[:, rank]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(key)], names=["row", "vec_id", "vector", "key"]
            )

    return table.select("row", "vec_id", "vector").mapInArrow(
        run, "row long, vec_id long, vector binary, key long"
    )


def _anchors(table: DataFrame, width: int) -> np.ndarray:
    sample = table.orderBy(F.xxhash64("vector"), "vector").select("vector").limit(4 * ANCHORS)
    distinct = list(dict.fromkeys(bytes(r.vector) for r in sample.collect()))[:ANCHORS]
    x = _numeric(distinct, width)
    size = np.abs(x).max(axis=1, initial=1.0)[:, None]
    x = x / size
    return x / np.maximum(np.linalg.norm(x, axis=1), 1e-300)[:, None]


def build(
    df: DataFrame, id_col: str, vector_col: str, scale: int
) -> tuple[DataFrame, dict[int, int]]:
    """The index and its number of shards for every length of vectors.

    Rows (shard, width, row, vec_id, vector), a shard's rows in their order.
    """
    spark = df.sparkSession
    vector = F.col("vector")

    def floors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            flat = lists.flatten().to_numpy(zero_copy_only=False) * float(scale)
            if not np.isfinite(flat).all():
                raise ValueError("a component is too large to be scaled")
            flat = np.floor(flat) + 0.0
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
            parts = [_packed(x) for x in np.split(flat, ends[:-1])] if len(ends) else []
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(parts, pa.binary()),
                    lists.value_lengths().cast(pa.int32()),
                ],
                names=["row", "vec_id", "vector", "width"],
            )

    table = written(
        df.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).cast("long").alias("vec_id"),
            F.col(vector_col).cast("array<double>").alias("vector"),
        )
        .where(
            vector.isNotNull()
            & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        )
        .mapInArrow(floors, "row long, vec_id long, vector binary, width int"),
        "scaled",
    )
    index, shards = None, {}
    # A table usually holds vectors of one length.
    for found in table.groupBy("width").count().orderBy("width").collect():
        width, n = found["width"], found["count"]
        own = table.where(F.col("width") == width)
        size = min(max(-(-n // SHARDS), SHARD_ROWS[0]), SHARD_ROWS[1])
        shards[width] = -(-n // size)
        ordered = (
            _order(own, _anchors(own, width), width)
            .repartitionByRange(shards[width], "key", "row")
            .sortWithinPartitions("key", "row")
        )
        part = written(
            ordered.select(
                F.spark_partition_id().alias("shard"),
                F.lit(width).alias("width"),
                "row",
                "vec_id",
                "vector",
            ),
            "ranges",
        )
        index = part if index is None else index.unionByName(part)
    return (spark.createDataFrame([], SHARD) if index is None else index), shards


FOUND = "row long, query_id long, vector binary, other long, vec_id long, score decimal(38,0)"


def _result(rows, ids, data, best, others, found) -> pa.RecordBatch:
    """One row per query and hit; a query without one has a row without a hit."""
    take, columns = [], ([], [], [])
    for q in range(len(rows)):
        hits = [c for c in range(found.shape[1]) if found[q, c] >= 0]
        for c in hits or [None]:
            take.append(q)
            columns[0].append(None if c is None else int(found[q, c]))
            columns[1].append(None if c is None or others[q, c] == NO_ID else int(others[q, c]))
            columns[2].append(None if c is None else int(best[q, c]))
    if any(s is not None and s not in LONG for s in columns[2]):
        raise ValueError("a score is beyond the range of a long")
    return pa.RecordBatch.from_arrays(
        [
            pa.array([int(rows[q]) for q in take], pa.int64()),
            pa.array([ids[q] for q in take], pa.int64()),
            pa.array([data[q] for q in take], pa.binary()),
            pa.array(columns[0], pa.int64()),
            pa.array(columns[1], pa.int64()),
            pa.array([None if s is None else Decimal(s) for s in columns[2]], pa.decimal128(38, 0)),
        ],
        names=["row", "query_id", "vector", "other", "vec_id", "score"],
    )


def _ids(values: list) -> np.ndarray:
    return np.array([NO_ID if v is None else v for v in values], np.int64)


def _search(placed: DataFrame, k: int, home: int | None) -> DataFrame:
    """Searches every shard for the queries that stand behind its rows.

    ``placed`` has (shard, width, kind, row, vec_id, vector, floor), sorted by
    shard, width and kind: 0 for a row of the shard, 1 for a query.  With
    ``home`` the queries are the shard's own rows whose id it divides.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, shard, held, tile = None, None, ([], [], []), ([], [], [], [])

        def searched():
            rows, ids, data, floors = tile
            x = _numeric(data, place[1])
            best, others, found = shard.search(np.array(rows, np.int64), x, floors, k)
            out = _result(rows, ids, data, best, others, found)
            for column in tile:
                column.clear()
            return out

        def loaded():
            rows, ids, data = held
            made = Shard(np.array(rows, np.int64), _ids(ids), _numeric(data, place[1]))
            if home is None:
                for column in held:
                    column.clear()
            return made

        def at_home():
            """The shard's own queries, in tiles."""
            nonlocal shard
            shard = loaded()
            for row, vec_id, data in zip(*held, strict=True):
                if vec_id is not None and vec_id % home == 0:
                    for column, value in zip(tile, (row, vec_id, data, None), strict=True):
                        column.append(value)
                    if len(tile[0]) == TILE:
                        yield searched()
            if tile[0]:
                yield searched()
            for column in held:
                column.clear()

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in range(7)]
            for at, width, kind, row, vec_id, data, floor in zip(*columns, strict=True):
                if (at, width) != place:
                    if home is not None and held[0]:
                        yield from at_home()
                    elif tile[0]:
                        yield searched()
                    place, shard = (at, width), None
                    for column in held:
                        column.clear()
                if kind == 0:
                    for column, value in zip(held, (row, vec_id, data), strict=True):
                        column.append(value)
                    continue
                if shard is None:
                    shard = loaded()
                values = (row, vec_id, data, None if floor is None else int(floor))
                for column, value in zip(tile, values, strict=True):
                    column.append(value)
                if len(tile[0]) == TILE:
                    yield searched()
        if home is not None and held[0]:
            yield from at_home()
        elif tile[0]:
            yield searched()

    order = ["shard", "width", "kind", "row"]
    return (
        placed.repartition("width", "shard")
        .sortWithinPartitions(*order)
        .select("shard", "width", "kind", "row", "vec_id", "vector", "floor")
        .mapInArrow(run, FOUND)
    )


def top_k(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 5,
    every: int = 50,
    scale: int = 256,
) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the k largest inner products of each query.

    Components become floor(scale * x).  Queries are the rows whose id is
    divisible by ``every``, candidates all rows but the query's own; the search
    is exact, ties go to the smaller id and a candidate without an id comes
    last among equals.  All candidates are returned where there are fewer.

    A vector that is null or holds a null or non-finite component takes no
    part; only vectors of one length are compared.  Rows of a repeated id are
    queries and candidates of their own, each other's too.  Other columns are
    ignored, whatever their names; an empty table gives an empty one.  A score
    beyond a long is an error.
    """
    spark = df.sparkSession
    ship(spark)
    index, shards = build(df, id_col, vector_col, scale)
    own = index.withColumns({"kind": F.lit(0), "floor": F.lit(None).cast("decimal(38,0)")})
    home = written(_search(own, k, every), "home")
    # A query's hits at home: at most k rows.
    queries = (
        home.groupBy("row")
        .agg(
            F.first("query_id").alias("vec_id"),
            F.first("vector").alias("vector"),
            F.when(F.count("other") == k, F.min("score")).alias("floor"),
        )
        .withColumn("kind", F.lit(1))
    )
    homes = index.where(F.col("vec_id") % every == 0).select(
        "row", "width", F.col("shard").alias("home")
    )
    last = F.lit(-1)
    for width, n in shards.items():
        last = F.when(F.col("width") == width, n - 1).otherwise(last)
    elsewhere = (
        queries.join(homes, "row")
        .withColumn("shard", F.explode(F.sequence(F.lit(0), last)))
        .where("shard <> home")
        .select(*own.columns)
    )
    hits = home.unionByName(_search(own.unionByName(elsewhere), k, None)).where("other IS NOT NULL")
    order = [F.desc("score"), F.asc_nulls_last("vec_id"), F.asc("other")]
    return (
        hits.withColumn("rank", F.row_number().over(Window.partitionBy("row").orderBy(*order)))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", F.col("score").cast("long").alias("score"))
    )
