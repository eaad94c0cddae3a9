"""Near-duplicate vectors by cross-polytope hashing.

Every table of the index rotates the vectors by random signs and fast Hadamard
transforms, three times per hash, and hashes them to the signed axis they lie
nearest to.  Several such hashes make a cell.  A vector stands in its own cell
and visits the cells next likely for it (multiprobe); vectors that meet in a
cell are compared by their cosine in double precision.  Cells are counted and
cut into blocks as bare ids; vectors are fetched for cells of two or more only.
Equal vectors are one row of the index.  A pair is counted in the first cell in which it meets, so
that links are counted without being written out; what leaves a task is a
count per vector and a spanning forest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatmetrics.llm.common import ship, written
from beatmetrics.llm.components import components
from beatmetrics.llm.packing import slices

# Vectors of a cell that are compared at once; fuller cells are cut into blocks.
BLOCK = 512
ROUNDS = 3
# Tables for each hash of a cell beyond the first.  Of pairs at a cosine of 0.9 in 64
# dimensions, 99.9 % meet with two hashes in 6 tables, 99.7 % with three in 12.
TABLES = 6


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows, a power of two long."""
    n, width, step = *x.shape, 1
    while step < width:
        pairs = x.reshape(n, width // (2 * step), 2, step)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2)
        step *= 2
        x = x.reshape(n, width)
    return x


@dataclass
class Hashes:
    """The random signs of all tables; the same seed gives the same index."""

    width: int
    tables: int
    parts: int
    seed: int = 17

    @property
    def code_type(self) -> type:
        return np.int32 if (2 * self.width) ** self.parts < 2**31 else np.int64

    def cells(self, x: np.ndarray) -> np.ndarray:
        """(n, tables, 1 + parts * 2) codes: the own cell, then those to visit.

        A visited cell has one of its hashes replaced by the second or third
        nearest axis.
        """
        random = np.random.default_rng(self.seed)
        padded = np.zeros((len(x), self.width))
        padded[:, : x.shape[1]] = x
        codes = np.empty((len(x), self.tables, 1 + 2 * self.parts), np.int64)
        rows = np.arange(len(x))
        for t in range(self.tables):
            nearest = []
            for _ in range(self.parts):
                y = padded
                for _ in range(ROUNDS):
                    y = hadamard(y * random.choice([-1.0, 1.0], self.width))
                top = np.argsort(-np.abs(y), axis=1, kind="stable")[:, :3]
                top = top * 2 + (y[rows[:, None], top] < 0)
                nearest.append(top[:, [min(k, top.shape[1] - 1) for k in range(3)]])
            base = np.zeros(len(x), np.int64)
            for part in nearest:
                base = base * (2 * self.width) + part[:, 0]
            codes[:, t, 0] = base
            for p, part in enumerate(nearest):
                scale = (2 * self.width) ** (self.parts - 1 - p)
                for k in (1, 2):
                    codes[:, t, 2 * p + k] = base + (part[:, k] - part[:, 0]) * scale
        return codes


def hashes_for(width: int, rows: int, tables: int = TABLES) -> Hashes:
    """Cells in proportion to the rows, about eight vectors in each, and tables for them."""
    power = 1 << max(1, (width - 1).bit_length())
    parts = max(1, round(np.log(max(rows, 8) / 8) / np.log(2 * power)))
    return Hashes(power, tables * int(max(1, parts - 1)), int(parts))


def _vectors(df: DataFrame) -> DataFrame:
    """Rows (vec_id, sig, width, vector); sig is null for what links with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sigs, widths, data = [], [], []
            for vector, vec_id in zip(batch.column(1).to_pylist(), batch.column(0), strict=True):
                good = bool(vector) and vec_id.is_valid and None not in vector
                x = np.array(vector if good else [], np.float64)
                if not good or not np.isfinite(x).all() or not (size := _norm(x)):
                    sigs.append(None)
                    widths.append(None)
                    data.append(None)
                    continue
                x = x + 0.0
                sigs.append(xxhash.xxh3_128_digest(x.tobytes()))
                widths.append(len(x))
                data.append((x / np.abs(x).max() / size).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sigs, pa.binary()),
                    pa.array(widths, pa.int32()),
                    pa.array(data, pa.binary()),
                ],
                names=["vec_id", "sig", "width", "vector"],
            )

    return df.mapInArrow(run, "vec_id long, sig binary, width int, vector binary")


def _norm(x: np.ndarray) -> float:
    """Norm after division by the largest component, so that no square overflows."""
    largest = np.abs(x).max()
    return float(np.linalg.norm(x / largest)) if largest > 0 else 0.0


def _coded(classes: DataFrame, hashes: Hashes) -> DataFrame:
    """Rows (rep, weight, vector, codes): the classes with all their cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 500):
                x = np.stack([np.frombuffer(v.as_py()) for v in batch.column(2)])
                codes = hashes.cells(x).astype(hashes.code_type)
                flat = pa.array([row.tobytes() for row in codes], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, flat], names=["rep", "weight", "vector", "codes"]
                )

    return classes.select("rep", "weight", "vector").mapInArrow(
        run, "rep long, weight long, vector binary, codes binary"
    )


def _cells(coded: DataFrame, hashes: Hashes) -> DataFrame:
    """Rows (t, cell, rep), one for every cell of a vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 2000):
                flat = b"".join(v.as_py() for v in batch.column(1))
                codes = np.frombuffer(flat, hashes.code_type).astype(np.int64)
                codes = np.sort(codes.reshape(batch.num_rows, hashes.tables, -1), axis=2)
                # The same cell is visited once.
                new = np.ones(codes.shape, bool)
                new[:, :, 1:] = codes[:, :, 1:] != codes[:, :, :-1]
                rows, table, _ = np.nonzero(new)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(table.astype(np.int32)),
                        pa.array(codes[new]),
                        batch.column(0).take(pa.array(rows)),
                    ],
                    names=["t", "cell", "rep"],
                )

    return coded.select("rep", "codes").mapInArrow(run, "t int, cell long, rep long")


def forest(a: np.ndarray, b: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Links (i, j) that connect what the given links connect, fewer than n."""
    top = list(range(n))

    def root(i: int) -> int:
        while top[i] != i:
            top[i] = top[top[i]]
            i = top[i]
        return i

    kept = []
    for i, j in zip(a.tolist(), b.tolist(), strict=True):
        x, y = root(i), root(j)
        if x != y:
            top[max(x, y)] = min(x, y)
            kept.append((i, j))
    return kept


def _first_here(codes: np.ndarray, i: np.ndarray, j: np.ndarray, t: int, cell: int) -> np.ndarray:
    """Whether pairs meet in this cell of table t for the first time."""
    a, b = codes[i], codes[j]
    in_b = (a[:, :, :1] == b).any(axis=2)  # the own cell of a is one of b's
    in_a = (b[:, :, :1] == a).any(axis=2)
    before = (in_a | in_b)[:, :t].any(axis=1)
    own_a, own_b = a[:, t, 0], b[:, t, 0]
    smaller = (in_b[:, t] & (own_a < cell)) | (in_a[:, t] & (own_b < cell))
    meets = (own_a == cell) | (own_b == cell)
    return meets & ~before & ~smaller


def _compare(coded: DataFrame, hashes: Hashes, least: float) -> DataFrame:
    """Rows (a, b, links): counts of a with b null, and links of a forest with 0."""
    tables, kinds = hashes.tables, 1 + 2 * hashes.parts

    def group(key, rows) -> list[tuple]:
        t, cell, first, second = key
        reps = np.array([r[0] for r in rows])
        order = np.argsort(reps)
        reps = reps[order]
        weights = np.array([rows[k][1] for k in order])
        blocks = np.array([rows[k][4] for k in order])
        x = np.stack([np.frombuffer(rows[k][2]) for k in order])
        codes = np.stack(
            [np.frombuffer(rows[k][3], hashes.code_type).reshape(tables, kinds) for k in order]
        )
        i, j = np.nonzero(np.triu(x @ x.T >= least, 1))
        if first != second:
            across = blocks[i] != blocks[j]
            i, j = i[across], j[across]
        if not len(i):
            return []
        once = _first_here(codes, i, j, t, cell)
        i, j = i[once], j[once]
        counts = np.bincount(i, weights[j], len(reps)) + np.bincount(j, weights[i], len(reps))
        out = [(int(reps[k]), None, int(counts[k])) for k in np.flatnonzero(counts)]
        return out + [(int(reps[p]), int(reps[q]), 0) for p, q in forest(i, j, len(reps))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The rows of a group follow each other; a group has two blocks at most.
        key, rows = None, []

        def flush():
            found = group(key, rows) if len(rows) > 1 else []
            a, b, n = zip(*found, strict=True) if found else ([], [], [])
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (a, b, n)], names=["a", "b", "links"]
            )

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(9)]
            for t, cell, first, second, *row in zip(*columns, strict=True):
                if (t, cell, first, second) != key:
                    if len(rows) > 1:
                        yield flush()
                    key, rows = (t, cell, first, second), []
                rows.append(row)
        if len(rows) > 1:
            yield flush()

    cells = written(_cells(coded, hashes), "cells")
    counts = cells.groupBy("t", "cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    block = F.pmod(F.xxhash64("rep"), F.col("blocks"))
    pairs = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
        lambda k: F.struct(
            F.least(k, F.col("block")).alias("first"), F.greatest(k, F.col("block")).alias("second")
        ),
    )
    keyed = (
        cells.join(counts, ["t", "cell"])
        .withColumn("blocks", F.ceil(F.col("n") / BLOCK))
        .withColumn("block", block)
        .withColumn("pair", F.explode(pairs))
        .select("t", "cell", "pair.first", "pair.second", "rep", "block")
        .join(coded, "rep")
        .select("t", "cell", "first", "second", "rep", "weight", "vector", "codes", "block")
    )
    order = ["t", "cell", "first", "second"]
    return (
        keyed.repartition(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(run, "a long, b long, links long")
    )


def near_vectors(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    least: float = 0.9,
    tables: int = TABLES,
) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept), one per row of the table.

    A vector that is null, empty or zero, or holds a null or non-finite
    component, or has no id, links with nothing.  Only vectors of one length
    are compared.  Equal vectors link.  The pairs found have a cosine of
    ``least`` or more; see the README for the measured recall.  Rows of one id
    share its component; other columns are ignored.
    """
    ship(df.sparkSession)
    table = written(
        _vectors(
            df.select(
                F.col(id_col).cast("long").alias("vec_id"),
                F.col(vector_col).cast("array<double>").alias("vector"),
            )
        ),
        "vectors",
    )
    classes = written(
        table.where("sig IS NOT NULL")
        .groupBy("sig")
        .agg(
            F.min("vec_id").alias("rep"),
            F.count(F.lit(1)).alias("weight"),
            F.first("width").alias("width"),
            F.first("vector").alias("vector"),
        ),
        "classes",
    )
    found = None
    # One index per length of vectors; a table usually has one.
    for row in classes.groupBy("width").count().orderBy("width").collect():
        hashes = hashes_for(row["width"], row["count"], tables)
        own = classes.where(F.col("width") == row["width"])
        coded = written(_coded(own, hashes), "coded")
        part = written(_compare(coded, hashes, least), "compared")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = df.sparkSession.createDataFrame([], "a long, b long, links long")
    counts = found.where("b IS NULL").groupBy("a").agg(F.sum("links").alias("links"))
    joined = components(found.where("b IS NOT NULL").select("a", "b"))
    named = (
        classes.select("sig", "rep", "weight")
        .join(counts, F.col("rep") == F.col("a"), "left")
        .join(joined, F.col("rep") == F.col("node"), "left")
        .select(
            "sig",
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    return (
        table.select("vec_id", "sig")
        .join(named, "sig", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component_id", "vec_id").alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )
