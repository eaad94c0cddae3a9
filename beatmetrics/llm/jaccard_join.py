"""Near-duplicate texts by an exact Jaccard join on word shingles.

Shingles are hashed and ordered by their hash.  Two sets whose similarity
reaches the threshold share at least l of their first |set| - ceil(t |set|) + l
shingles.  Every set is indexed under these extended prefixes: under each rare
shingle alone, and under pairs of frequent shingles of one class.  With l - 1
classes, l common frequent shingles put two into one class, so that a pair of
texts meets under a rare shingle or under a pair of frequent ones.  A common
passage alone gives a text fewer than l frequent shingles and no such pair.

Equal sets are joined to one node first.  The texts under one key are compared
with one of them; what is linked then is one component, and only texts of
different components are compared further: under crowded keys with a few heads
first, so that a large group of copies becomes one component in linear work.
Where components still differ, a key of at most 64 texts is searched pair by
pair.  The texts under larger keys, such as those that share a long passage, are
indexed anew: whole sets ordered from the rarest shingle to the most frequent,
whose plain prefixes leave the passage out.  Any pair that met under a large key
has both ends there, and prefixes are exact in every common order.  Parities of 256 groups of
hashes bound the difference of two sets from below and reject most of these
pairs inside the join; a bound on the prefixes rejects others before whole sets
are compared.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatmetrics.llm.common import release, ship, shingles, written
from beatmetrics.llm.components import joined
from beatmetrics.llm.packing import slices

# A shingle in more prefixes than this is frequent; no key of one shingle has more texts.
RARE = 40
# Heads with which the texts under one key are compared before pairs are, if there are more texts.
HEADS = 8
# Texts under one key of which each is compared with each; with more, their rarest shingles decide.
CROWD = 64
# Ids of texts to fetch are broadcast up to this number (8 bytes each).
MAX_BROADCAST_IDS = 500_000


def prefix_sizes(n: int, percent: int) -> tuple[int, int]:
    """Length of the plain prefix of n shingles, and the classes l - 1 at that size."""
    plain = n + 1 + (-percent * n) // 100
    return plain, max(1, plain // 3)


def level(n: int, percent: int) -> int:
    """Sizes in steps of the threshold: similar sets differ by one step at most."""
    return math.floor(math.log(n) / math.log(100 / percent) + 1e-9)


def classes_at(step: int, percent: int) -> int:
    return prefix_sizes(max(1, math.floor((100 / percent) ** step)), percent)[1]


def extended(n: int, percent: int) -> int:
    """Length of the prefix under which a set of n shingles is indexed."""
    plain, _ = prefix_sizes(n, percent)
    step = level(n, percent)
    return min(n, plain + max(classes_at(step, percent), classes_at(step + 1, percent)))


def may_match(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int, percent: int) -> bool:
    """Whether prefixes leave the threshold possible.

    Up to the smaller of the last hashes both prefixes are whole, so shingles
    there in one of them only are differences of the sets.
    """
    end = min(a[-1], b[-1])
    a, b = a[: np.searchsorted(a, end, "right")], b[: np.searchsorted(b, end, "right")]
    differences = len(a) + len(b) - 2 * len(np.intersect1d(a, b, assume_unique=True))
    return differences * (100 + percent) <= (100 - percent) * (n_a + n_b)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def parities(hashes: np.ndarray) -> np.ndarray:
    """256 bits in four numbers: whether each group of hashes has an odd number."""
    groups = (hashes >> np.uint64(8)) & np.uint64(255)
    odd = np.bincount(groups.astype(np.int64), minlength=256) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def _sets(df: DataFrame, n_words: int, percent: int) -> DataFrame:
    """Rows (doc_id, n, sig, bits, prefix) of a frame (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1000):
                sizes, sigs, bits, prefixes = [], [], [], []
                for text in batch.column(1):
                    s = shingles(text.as_py(), n_words)
                    sizes.append(len(s))
                    sigs.append(xxhash.xxh3_128_digest(s.tobytes()))
                    bits.append(parities(s))
                    size = extended(len(s), percent) if len(s) else 0
                    prefixes.append(s[:size].view(np.int64))
                ends = np.cumsum([0, *map(len, prefixes)])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(sizes, pa.int32()),
                        pa.array(sigs, pa.binary()),
                        pa.array(bits, pa.list_(pa.int64())),
                        pa.ListArray.from_arrays(
                            pa.array(ends, pa.int32()), pa.array(np.concatenate(prefixes))
                        ),
                    ],
                    names=["doc_id", "n", "sig", "bits", "prefix"],
                )

    return df.mapInArrow(
        run, "doc_id long, n int, sig binary, bits array<long>, prefix array<long>"
    )


def _combinations(frequent: DataFrame, percent: int) -> DataFrame:
    """Rows (key, node, n) for pairs of frequent shingles of one class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, nodes, sizes = [], [], []
            for node, n, tokens in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = np.sort(np.array(tokens, np.int64).view(np.uint64))
                for step in (level(n, percent), level(n, percent) + 1):
                    classes = classes_at(step, percent)
                    if len(own) <= classes:
                        continue
                    for c in range(classes):
                        t = own[own % np.uint64(classes) == c]
                        i, j = np.triu_indices(len(t), 1)
                        mixed = (t[i] * np.uint64(0x9E3779B97F4A7C15)) ^ (t[j] >> np.uint64(7))
                        mixed = mixed * np.uint64(0xBF58476D1CE4E5B9) + t[j] + np.uint64(step)
                        keys.append(mixed.view(np.int64))
                        nodes.append(np.full(len(i), node, np.int64))
                        sizes.append(np.full(len(i), n, np.int32))
            kinds = (np.int64, np.int64, np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([np.empty(0, k), *x]))
                    for x, k in zip((keys, nodes, sizes), kinds, strict=True)
                ],
                names=["key", "node", "n"],
            )

    return frequent.mapInArrow(run, "key long, node long, n int")


def _index(reps: DataFrame, percent: int) -> DataFrame:
    """Rows (key, node, n) of the keys under which two nodes or more meet."""
    posts = reps.select(F.explode("prefix").alias("key"), "node", "n")
    counts = posts.groupBy("key").agg(F.count(F.lit(1)).alias("nodes")).where("nodes > 1")
    shared = written(posts.join(counts, "key"), "shared")
    frequent = (
        shared.where(F.col("nodes") > RARE)
        .groupBy("node")
        .agg(F.first("n").alias("n"), F.collect_list("key").alias("tokens"))
        .select("node", "n", "tokens")
    )
    rare = shared.where(F.col("nodes") <= RARE).select("key", "node", "n")
    keys = written(rare.unionByName(_combinations(frequent, percent)), "keys")
    release(shared)
    return keys


def _rarest_first(
    nodes: DataFrame, reps: DataFrame, texts: DataFrame, n_words: int, percent: int
) -> DataFrame:
    """Rows (key, node, n): plain prefixes of the nodes with their rarest shingles first.

    Shingles of one node alone fill the prefix without becoming keys.
    """
    sets = _whole_sets(nodes, reps, texts, n_words)
    posts = sets.select(F.explode("hashes").alias("key"), "node", F.size("hashes").alias("n"))
    counts = posts.groupBy("key").agg(F.count(F.lit(1)).alias("nodes")).where("nodes > 1")
    plain = F.expr(f"n + 1 - ({percent}L * n + 99) div 100")
    prefixes = (
        posts.join(counts, "key")
        .groupBy("node")
        .agg(
            F.first("n").alias("n"),
            F.array_sort(F.collect_list(F.struct("nodes", "key"))).alias("tokens"),
        )
        .withColumn("left", (plain - F.col("n") + F.size("tokens")).cast("int"))
        .where(F.col("left") > 0)
    )
    keys = prefixes.select(F.explode(F.slice("tokens", 1, "left")).alias("token"), "node", "n")
    keys = written(keys.select("token.key", "node", "n"), "keys")
    release(sets)
    return keys


def _fits(a: str, b: str, percent: int):
    """Sizes that allow the threshold."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _whole_sets(nodes: DataFrame, reps: DataFrame, texts: DataFrame, n_words: int) -> DataFrame:
    """Rows (node, hashes): all shingles of the nodes, made anew from their texts."""

    def with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1000):
                sets = [shingles(t.as_py(), n_words) for t in batch.column(0)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                        pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                    ],
                    names=["sig", "hashes"],
                )

    wanted = written(nodes.join(reps.select("node", "sig", "rep"), "node"), "wanted")
    ids = wanted.select(F.col("rep").alias("doc_id"))
    if wanted.count() <= MAX_BROADCAST_IDS:
        ids = F.broadcast(ids)
    sets = (
        texts.join(ids, "doc_id", "left_semi")
        .select("text")
        .mapInArrow(with_sets, "sig binary, hashes array<long>")
        .join(wanted, "sig")
        .groupBy("node")
        .agg(F.first("hashes").alias("hashes"))
    )
    sets = written(sets, "hashes")
    release(wanted)
    return sets


def _checked(
    pairs: DataFrame, reps: DataFrame, texts: DataFrame, n_words: int, percent: int
) -> DataFrame:
    """The pairs (a, b) of nodes whose sets reach the threshold, written.

    Of no pairs, or none whose prefixes may match, nothing more is made.
    """

    def by_prefix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 2000):
                x, y = (_arrays(batch.column(i)) for i in (4, 5))
                n_a, n_b = (batch.column(i).to_pylist() for i in (2, 3))
                keep = [may_match(*r, percent) for r in zip(x, y, n_a, n_b, strict=True)]
                yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    def by_set(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1000):
                rows = zip(_arrays(batch.column(2)), _arrays(batch.column(3)), strict=True)
                keep = [similar(x, y, percent) for x, y in rows]
                yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    def ends(table: DataFrame, column: str, end: str, *more: str) -> DataFrame:
        return table.select(
            F.col("node").alias(end), F.col(column).alias(f"{column}_{end}"), *more
        )

    if pairs.isEmpty():
        return pairs.select("a", "b").limit(0)  # Rows of no file, as pairs are emptied later.
    left = (
        pairs.join(ends(reps, "prefix", "b"), "b")
        .join(ends(reps, "prefix", "a"), "a")
        .select("a", "b", "n_a", "n_b", "prefix_a", "prefix_b")
        .mapInArrow(by_prefix, "a long, b long")
    )
    left = written(left, "pairs")
    if left.isEmpty():
        return left
    nodes = left.select(F.col("a").alias("node")).union(left.select("b")).distinct()
    sets = _whole_sets(nodes, reps, texts, n_words)
    found = written(
        left.join(ends(sets, "hashes", "b"), "b")
        .join(ends(sets, "hashes", "a"), "a")
        .select("a", "b", "hashes_a", "hashes_b")
        .mapInArrow(by_set, "a long, b long"),
        "links",
    )
    release(left, sets)
    return found


def _arrays(column: pa.Array) -> list[np.ndarray]:
    values, ends = column.values.to_numpy(), column.offsets.to_numpy()
    values = values.view(np.uint64)
    return [values[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _members(keys: DataFrame, whole: DataFrame, reps: DataFrame) -> DataFrame:
    """Rows (key, node, n, component, texts, bits0..3) of keys that several components share."""
    keyed = keys.join(whole, "node", "left").select(
        "key", "node", "n", F.coalesce("component", "node").alias("component")
    )
    keyed = written(keyed, "keyed")
    open_keys = (
        keyed.groupBy("key")
        .agg(
            F.min("component").alias("low"),
            F.max("component").alias("high"),
            F.count(F.lit(1)).alias("texts"),
        )
        .where("low <> high")
        .select("key", "texts")
    )
    bits = reps.select("node", *[F.get("bits", F.lit(i)).alias(f"bits{i}") for i in range(4)])
    members = written(keyed.join(open_keys, "key").join(bits, "node"), "members")
    release(keyed)
    return members


def _apart(left: DataFrame, right: DataFrame, ends: str, percent: int) -> DataFrame:
    """Pairs under one key of different components that sizes and parities leave possible."""
    names = [c for c in right.columns if c != "key"]
    a = left.select("key", *[F.col(c).alias(f"{c}_a") for c in names])
    b = right.select("key", *[F.col(c).alias(f"{c}_b") for c in names])
    apart = sum(
        F.bit_count(F.col(f"bits{i}_a").bitwiseXOR(F.col(f"bits{i}_b"))) for i in range(4)
    )
    return (
        a.join(b, "key")
        .where(ends)
        .where("component_a <> component_b")
        .where(_fits("n_a", "n_b", percent))
        .where((100 + percent) * apart <= (100 - percent) * (F.col("n_a") + F.col("n_b")))
    )


def near_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n_words: int = 4,
    percent: int = 85,
) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id), one per row of the table.

    Two texts link when 100 * common >= percent * all of their distinct
    ``n_words``-word shingles; a shorter text is one shingle, a text without
    words links with nothing.  ``component_id`` is the smallest id that links
    reach.  Rows of equal text link whatever their ids; a row without an id has
    no component and links with nothing; other columns are ignored.
    """
    ship(df.sparkSession)
    texts = df.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    table = written(_sets(texts, n_words, percent), "sets")
    reps = written(
        table.where("n > 0 AND doc_id IS NOT NULL")
        .groupBy("sig")
        .agg(
            F.min("doc_id").alias("rep"),
            *[F.first(c).alias(c) for c in ("n", "bits", "prefix")],
        )
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    rows = written(table.select("doc_id", "n", "sig"), "rows")
    release(table)
    keys = _index(reps, percent)

    heads = keys.groupBy("key").agg(
        F.min(F.struct("node", "n")).alias("head"), F.count(F.lit(1)).alias("nodes")
    )
    first = written(
        keys.join(heads.where("nodes > 1"), "key")
        .where(F.col("node") != F.col("head.node"))
        .select(
            F.col("head.node").alias("a"),
            F.col("node").alias("b"),
            F.col("head.n").alias("n_a"),
            F.col("n").alias("n_b"),
        )
        .where(_fits("n_a", "n_b", percent))
        .distinct(),
        "stars",
    )
    links = _checked(first, reps, texts, n_words, percent)

    whole = joined(links)
    shared = _members(keys, whole, reps)
    release(keys)
    crowded = shared.where(F.col("texts") > 2 * HEADS)
    drawn = [
        F.min(F.struct(F.xxhash64("node", F.lit(i)).alias("h"), "node")).alias(f"head{i}")
        for i in range(HEADS)
    ]
    drawn_nodes = F.array_distinct(F.array(*[f"head{i}.node" for i in range(HEADS)]))
    heads = crowded.groupBy("key").agg(*drawn).select("key", F.explode(drawn_nodes).alias("node"))
    second = written(
        _apart(crowded.join(heads, ["key", "node"]), crowded, "node_a <> node_b", percent)
        .select(
            F.least("node_a", "node_b").alias("a"),
            F.greatest("node_a", "node_b").alias("b"),
            F.when(F.col("node_a") < F.col("node_b"), F.col("n_a"))
            .otherwise(F.col("n_b"))
            .alias("n_a"),
            F.when(F.col("node_a") < F.col("node_b"), F.col("n_b"))
            .otherwise(F.col("n_a"))
            .alias("n_b"),
        )
        .distinct()
        .join(first.select("a", "b"), ["a", "b"], "left_anti"),
        "stars",
    )
    found = _checked(second, reps, texts, n_words, percent)

    # Keys of one component stay so; without new links the others stay as they are, too.
    members = shared
    if not found.isEmpty():
        links = written(links.unionByName(found), "links")
        whole = joined(links)
        members = _members(shared.select("key", "node", "n"), whole, reps)
        release(shared)
    few = members.where(F.col("texts") <= CROWD)
    apart = _apart(few, few, "node_a < node_b", percent)
    open_tables = [members, first, second]
    crowd = members.where(F.col("texts") > CROWD).select("node")
    if not crowd.isEmpty():
        again = _rarest_first(crowd.distinct(), reps, texts, n_words, percent)
        again = _members(again, whole, reps)
        apart = apart.unionByName(_apart(again, again, "node_a < node_b", percent))
        open_tables.append(again)
    tested = first.select("a", "b").union(second.select("a", "b"))
    rest = (
        apart.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"), "n_a", "n_b")
        .distinct()
        .join(tested, ["a", "b"], "left_anti")
    )
    rest = written(rest, "rest")
    release(*open_tables)
    found = _checked(rest, reps, texts, n_words, percent)
    if not found.isEmpty():
        whole = joined(links.unionByName(found))

    named = reps.select("node", "sig", "rep").join(whole, "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    by_sig = named.join(least, "component").select("sig", "component_id")
    return (
        rows.select("doc_id", F.col("n").cast("long").alias("n_shingles"), "sig")
        .join(by_sig, "sig", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(
                F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")
            ).alias("component_id"),
        )
    )


def keep_first(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n_words: int = 5,
    percent: int = 80,
) -> DataFrame:
    """One row of each group of near-duplicates: the one with the smallest id.

    The groups are those of rows, so repeated and null ids neither join nor
    part texts.  A null id is the smallest; among equal ids a hash of the text
    decides, among equal texts any one row stays.  Rows without words are no
    copies and all stay; columns are kept as they are.
    """
    row = "_row"
    while row in (c.lower() for c in df.columns):
        row = "_" + row
    # Written with the numbers, so that they stay the same however often they are read.
    rows = written(df.withColumn(row, F.monotonically_increasing_id()), "rows")
    groups = near_duplicates(rows, row, text_col, n_words, percent)
    order = rows.select(
        F.col(row).alias("doc_id"),
        F.struct(
            F.col(id_col).cast("long").alias("id"),
            F.xxhash64(F.col(text_col).cast("string")).alias("text"),
            F.col(row).alias("row"),
        ).alias("place"),
    )
    found = written(
        groups.select("doc_id", "component_id").join(order, "doc_id"), "groups"
    )
    first = (
        found.groupBy("component_id")
        .agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("rows"))
        .where("rows > 1")
    )
    copies = (
        found.join(first, "component_id")
        .where("place.row <> first.row")
        .select(F.col("doc_id").alias(row))
    )
    return rows.join(copies, row, "left_anti").select(*[F.col(f"`{c}`") for c in df.columns])
