"""Prefix trie of conversations as burst tries.

A turn's id is a digest of its role and text.  The trie starts as one container
with all conversations under the root.  A container of more than ``LIMIT``
conversations bursts: its node becomes a head, and its conversations go on to
the containers of their next turn.  How many conversations a container holds is
the number that share its prefix, so all bursts are found by one count per
prefix instead of one round per depth.  What is left are containers of at most
``LIMIT`` conversations under heads; each holds the suffixes that two or more
conversations share, is sorted, and is swept from the deepest level upwards
into nodes, holding two levels at a time.  A suffix that only one conversation
has is a chain of nodes that its rows already describe; it enters no container.

A prefix is named by two polynomials of its turn ids modulo a prime.  Such a
name can be continued from that of the part before it, so conversations are
numbered and named in sorted ranges of rows, with one row per range added up on
the driver: a conversation of any length may span many tasks.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beatmetrics.llm.common import ship, written

# Conversations that a container holds before it bursts.
LIMIT = 1000
# Bytes of joined ids in one row on their way to the hash of a head's ends.
CHUNK = 1 << 16

# A Mersenne prime and two bases of the names.
PRIME = (1 << 61) - 1
BASES = (1_000_003_000_007, 777_767_777_000_011)
ROOT = bytes(16)
NOTHING = hashlib.sha256(b"").hexdigest()

COLUMNS = (
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
    "ends_sha256",
)
ORDER = ("c", "part", "known", "turn", "tid", "uid")


def turn_ids(conversations: DataFrame) -> DataFrame:
    """Rows (c, known, turn, tid, uid, bytes) of conv_id, turn, role and text, written.

    ``known`` is 0 for a null turn, which comes first; equal turns are ordered
    by the digest of role and text.  ``uid`` tells equal rows apart.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    named = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    return written(
        conversations.where("conv_id IS NOT NULL").select(
            F.col("conv_id").cast("long").alias("c"),
            F.col("turn").isNotNull().cast("int").alias("known"),
            F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"),
            F.unhex(F.md5(named.cast("binary"))).alias("tid"),
            F.monotonically_increasing_id().alias("uid"),
            F.octet_length(text).cast("long").alias("bytes"),
        ),
        "turns",
    )


def rebuilt(turns: DataFrame, family: int = 5, modulus: int = 9) -> DataFrame:
    """The rows of :func:`turn_ids` with the first h turns of every conversation replaced.

    They come from the conversation whose id is c - c % ``family``; h is the
    crc32 of c in decimal modulo ``modulus``.
    """
    order = [F.col(c) for c in ("known", "turn", "tid", "uid")]
    # Spark cuts every conversation down to its first rows before the shuffle.
    firsts = written(
        turns.withColumn("n", F.row_number().over(Window.partitionBy("c").orderBy(*order))).where(
            F.col("n") < modulus
        ),
        "firsts",
    )
    h = F.crc32(F.col("c").cast("string").cast("binary")) % modulus
    own = turns.join(firsts.where(F.col("n") <= h).select("uid"), "uid", "left_anti")
    ids = turns.select("c").distinct()
    lent = firsts.select(F.col("c").alias("from"), "n", "tid", "bytes")
    borrowed = (
        ids.withColumn("from", F.col("c") - F.col("c") % family)
        .withColumn("h", h)
        .join(lent, "from")
        .where(F.col("n") <= F.col("h"))
    )
    return own.withColumn("part", F.lit(1)).select(*ORDER, "bytes").unionByName(
        borrowed.select(
            "c",
            F.lit(0).alias("part"),
            F.lit(1).alias("known"),
            F.col("n").cast("long").alias("turn"),
            "tid",
            F.lit(0).cast("long").alias("uid"),
            "bytes",
        )
    )


def extend(name: tuple[int, int], turn: tuple[int, int]) -> tuple[int, int]:
    return tuple((h * b + t) % PRIME for h, t, b in zip(name, turn, BASES, strict=True))


def joined(before: tuple[int, int], after: tuple[int, int], length: int) -> tuple[int, int]:
    """The name of one sequence behind another; ``length`` is the second one's."""
    return tuple(
        (h * pow(b, length, PRIME) + t) % PRIME
        for h, t, b in zip(before, after, BASES, strict=True)
    )


def _bytes(name: tuple[int, int]) -> bytes:
    return struct.pack(">QQ", *name)


def _name(data: bytes) -> tuple[int, int]:
    return struct.unpack(">QQ", data)


LOCAL = "pid int, seq long, c long, d long, p binary, q binary, bytes long, last boolean"


def _local(rows: DataFrame) -> DataFrame:
    """Depths and names counted from a conversation's first row in its partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, seq = TaskContext.get().partitionId(), 0
        conv, depth, name, held = None, 0, (0, 0), None

        def out(lines):
            columns = list(zip(*lines, strict=True)) or [[]] * 6
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.bool_())
            n = len(lines)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([pid] * n, pa.int32()),
                    pa.array(range(seq, seq + n), pa.int64()),
                    *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ],
                names=["pid", "seq", "c", "d", "p", "q", "bytes", "last"],
            )

        for batch in batches:
            lines = []
            for c, tid, size in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                if held:
                    lines.append((*held, c != conv))
                if c != conv:
                    conv, depth, name = c, 0, (0, 0)
                before, name = name, extend(name, _name(tid))
                depth += 1
                held = (c, depth, _bytes(before), _bytes(name), size)
            yield out(lines)
            seq += len(lines)
        if held:
            yield out([(*held, True)])

    return rows.select("c", "tid", "bytes").mapInArrow(run, LOCAL)


def prefixes(sequences: DataFrame) -> DataFrame:
    """Rows (c, d, p, q, bytes, last): each turn's depth, the names before and with it.

    ``last`` marks the end of a conversation.  Written.
    """
    local = written(
        _local(sequences.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)), "ranges"
    )
    ends = F.struct("c", "d", "q").alias("end")
    # One row per range.
    summary = (
        local.groupBy("pid")
        .agg(F.min_by("c", "seq").alias("first"), F.max_by(ends, "seq").alias("end"))
        .orderBy("pid")
        .collect()
    )
    carried, goes_on, conv, length, name = {}, {}, None, 0, (0, 0)
    for n, row in enumerate(summary):
        if row.first == conv:
            carried[row.pid] = (conv, length, name)
        here = _name(bytes(row.end.q))
        if row.first == conv == row.end.c:
            length, name = length + row.end.d, joined(name, here, row.end.d)
        else:
            conv, length, name = row.end.c, row.end.d, here
        if n + 1 < len(summary) and summary[n + 1].first == conv:
            goes_on[row.pid] = conv

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(i) for i in (2, 3, 4, 5, 6, 7)]
            pids = set(batch.column(0).unique().to_pylist())
            if pids & (carried.keys() | goes_on.keys()):
                rows = []
                for pid, _, c, d, p, q, size, last in zip(
                    *[x.to_pylist() for x in batch.columns], strict=True
                ):
                    last = last and goes_on.get(pid, None) != c
                    if pid in carried and carried[pid][0] == c:
                        _, length, name = carried[pid]
                        p = _bytes(joined(name, _name(p), d - 1))
                        q = _bytes(joined(name, _name(q), d))
                        d += length
                    rows.append((c, d, p, q, size, last))
                columns = [
                    pa.array(x, kind.type) for x, kind in zip(zip(*rows), columns, strict=True)
                ]
            yield pa.RecordBatch.from_arrays(columns, names=["c", "d", "p", "q", "bytes", "last"])

    return written(
        local.mapInArrow(run, "c long, d long, p binary, q binary, bytes long, last boolean"),
        "prefixes",
    )


NODES = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string"
)


def _swept(suffixes: DataFrame) -> DataFrame:
    """The nodes of all containers, and under ``p`` the head above a container's top.

    Rows (container, d, q, p, c, bytes, last).  They are sorted by falling
    depth, so a node's children are known before it; a node waits for its
    parent's smallest member.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        container, at = None, None
        first = size = above = digest = None
        count, ended = 0, False
        # By parent: children, leaves, saved bytes, and the children's rows.
        waiting: dict[bytes, list] = {}
        lines: list[tuple] = []

        def close_node():
            nonlocal at
            if at is None:
                return
            children, leaves, saved, rows = waiting.pop(at[1], (0, 0, 0, []))
            up = waiting.setdefault(above, [0, 0, 0, []])
            up[0] += 1
            if count == 1:  # the top of a chain, already a row of the result
                up[1] += 1
            else:
                leaves, saved = leaves or 1, saved + (count - 1) * size
                for c, d, *rest in rows:
                    lines.append((c, d, first, *rest, None))
                up[1] += leaves
                up[2] += saved
                up[3].append((first, at[0], count, children, leaves, saved, digest.hexdigest()))
            at = None

        def close_container():
            close_node()
            for head, (_, _, _, rows) in waiting.items():
                lines.extend((c, d, None, *rest, head) for c, d, *rest in rows)
            waiting.clear()

        def out():
            kinds = [pa.int64()] * 7 + [pa.string(), pa.binary()]
            columns = list(zip(*lines, strict=True)) or [[]] * 9
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            lines.clear()
            return pa.RecordBatch.from_arrays(arrays, names=[*COLUMNS, "p"])

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(7)]
            for k, d, q, p, c, length, last in zip(*columns, strict=True):
                if k != container:
                    close_container()
                    container = k
                elif (d, q) != at:
                    close_node()
                if at is None:
                    at, above, first, size = (d, q), p, c, length
                    count, ended, digest = 0, False, hashlib.sha256()
                count += 1
                if last:
                    digest.update(f"{',' if ended else ''}{c}".encode())
                    ended = True
            yield out()
        close_container()
        yield out()

    return (
        suffixes.repartition("container")
        .sortWithinPartitions("container", F.desc("d"), "q", "c")
        .select("container", "d", "q", "p", "c", "bytes", "last")
        .mapInArrow(run, f"{NODES}, p binary")
    )


def _digests(ends: DataFrame) -> DataFrame:
    """Rows (q, ends_sha256): the hash of each node's ids, ascending, joined by commas.

    A node may have a third of all conversations.  Its ids are sorted in ranges
    and leave them as long texts; only these meet, and are hashed as they come.
    """

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, ids, size = None, None, [], 0

        def out():
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([node], pa.binary()),
                    pa.array([first], pa.int64()),
                    pa.array([",".join(ids)], pa.string()),
                ],
                names=["q", "first", "text"],
            )

        for batch in batches:
            for q, c in zip(*[batch.column(i).to_pylist() for i in range(2)], strict=True):
                if ids and (q != node or size > CHUNK):
                    yield out()
                    ids = []
                if not ids:
                    node, first, size = q, c, 0
                ids.append(str(c))
                size += len(ids[-1]) + 1
        if ids:
            yield out()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array([node], pa.binary()), pa.array([digest.hexdigest()], pa.string())],
                names=["q", "ends_sha256"],
            )

        for batch in batches:
            for q, text in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
                if q != node:
                    if node is not None:
                        yield out()
                    node, digest = q, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(text.as_py().encode())
        if node is not None:
            yield out()

    parts = (
        ends.select("q", "c")
        .repartitionByRange("q", "c")
        .sortWithinPartitions("q", "c")
        .mapInArrow(texts, "q binary, first long, text string")
    )
    return (
        parts.repartition("q")
        .sortWithinPartitions("q", "first")
        .mapInArrow(hashed, "q binary, ends_sha256 string")
    )


def nodes(sequences: DataFrame, members: DataFrame, limit: int = LIMIT) -> DataFrame:
    """One row per node of the trie of the sequences, with the columns ``COLUMNS``.

    ``sequences`` has the columns ``ORDER`` and ``bytes``, one row per turn;
    ``members`` has one row ``c`` per conversation, those without a turn too.
    """
    root = F.lit(ROOT)
    paths = prefixes(sequences)
    counted = paths.groupBy("q").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("c").alias("conv"),
        F.first("d").alias("d"),
        F.first("p").alias("p"),
        F.first("bytes").alias("bytes"),
    )
    everyone = members.agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("conv")).where("n > 0")
    top = everyone.select(
        root.alias("q"),
        "n",
        "conv",
        F.lit(0).cast("long").alias("d"),
        F.lit(None).cast("binary").alias("p"),
        F.lit(0).cast("long").alias("bytes"),
    )
    shared = written(counted.where("n > 1").unionByName(top), "shared")
    is_head = (F.col("n") > limit) | (F.col("q") == root)
    under_head = (F.col("above") > limit) | (F.col("p") == root)
    in_container = F.col("n").between(2, limit)

    placed = written(
        paths.join(shared.select("q", "n"), "q", "left").join(
            shared.select(F.col("q").alias("p"), F.col("n").alias("above"), "conv"), "p", "left"
        ),
        "placed",
    )

    # Prefixes of one conversation.
    alone = placed.where("n IS NULL")
    last, one = F.col("last"), F.lit(1).cast("long")
    own_id = F.sha2(F.col("c").cast("string").cast("binary"), 256)
    chains = alone.select(
        F.col("c").alias("conv_id"),
        F.col("d").alias("depth"),
        F.coalesce("conv", "c").alias("parent_conv_id"),
        one.alias("n_convs"),
        F.when(last, 0).otherwise(1).cast("long").alias("n_children"),
        one.alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"),
        F.when(last, own_id).otherwise(NOTHING).alias("ends_sha256"),
    )

    # Containers: a conversation is in the one under its deepest head.
    entries = placed.where(in_container & under_head).select("c", F.col("q").alias("container"))
    tops = F.col("n").isNull() & F.col("above").isNotNull() & ~under_head
    swept = written(_swept(placed.where(in_container | tops).join(entries, "c")), "swept")
    parents = shared.select(F.col("q").alias("p"), "conv")
    contained = swept.join(parents.where("p IS NOT NULL"), "p", "left").select(
        *[
            F.coalesce("parent_conv_id", "conv").alias(c) if c == "parent_conv_id" else c
            for c in COLUMNS
        ]
    )

    # Heads: what stands below each directly, then sums along the paths of smallest members.
    heads = shared.where(is_head)
    parts = (
        alone.where(under_head)
        .select("p", one.alias("leaves"), F.lit(0).cast("long").alias("saved"))
        .unionAll(swept.where("p IS NOT NULL").select("p", "n_leaves", "saved_tokens"))
        .unionAll(heads.where("p IS NOT NULL").selectExpr("p", "0L AS leaves", "0L AS saved"))
        .groupBy(F.col("p").alias("q"))
        .agg(
            F.count(F.lit(1)).alias("n_children"),
            F.sum("leaves").alias("leaves"),
            F.sum("saved").alias("saved"),
        )
    )
    none = F.lit(0).cast("long")
    own = written(
        heads.join(parts, "q", "left").select(
            "q",
            "p",
            "d",
            "n",
            "conv",
            F.coalesce("n_children", none).alias("n_children"),
            F.coalesce("leaves", one).alias("leaves"),
            (F.coalesce("saved", none) + (F.col("n") - 1) * F.col("bytes")).alias("saved"),
        ),
        "heads",
    )
    firsts = own.select(F.col("conv").alias("c")).distinct()
    along = (
        placed.where(F.col("n") > limit)
        .join(firsts, "c", "left_semi")
        .select("c", "d", "q")
        .unionAll(firsts.select("c", none, root))
        .join(own.select("q", F.col("conv").alias("c"), "leaves", "saved"), ["q", "c"], "left")
    )
    below = Window.partitionBy("c").orderBy(F.desc("d"))
    sums = (
        along.select(
            "q",
            F.sum(F.coalesce("leaves", none)).over(below).alias("leaves"),
            F.sum(F.coalesce("saved", none)).over(below).alias("saved"),
        )
        .groupBy("q")
        .agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    )
    turnless = members.join(paths.where("d = 1").select("c"), "c", "left_anti")
    ends = (
        placed.where(last & (F.col("n") > limit))
        .select("q", "c")
        .unionAll(turnless.select(root, "c"))
    )
    headed = (
        own.join(sums, "q")
        .join(_digests(ends), "q", "left")
        .join(parents.withColumnRenamed("conv", "parent_conv_id"), "p", "left")
        .select(
            F.col("conv").alias("conv_id"),
            F.col("d").alias("depth"),
            "parent_conv_id",
            F.col("n").alias("n_convs"),
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"),
        )
    )
    return chains.unionByName(contained).unionByName(headed)


def conversation_trie(
    conversations: DataFrame, family: int = 5, modulus: int = 9, limit: int = LIMIT
) -> DataFrame:
    """The prefix trie of the rebuilt conversations, one row per node.

    Every conversation takes its first h turns from the first of its family
    (see :func:`rebuilt`).  Null roles and texts are empty; null turns come
    first and equal turns are ordered by a digest of role and text; repeated
    rows are turns of their own.  Rows without a conversation's id belong to no
    conversation.  Other columns are ignored, whatever their names.  An empty
    table has no conversation and gives no node, not even the root.
    """
    ship(conversations.sparkSession)
    turns = turn_ids(conversations.select("conv_id", "turn", "role", "text"))
    sequences = rebuilt(turns, family, modulus)
    return nodes(sequences, turns.select("c").distinct(), limit)
