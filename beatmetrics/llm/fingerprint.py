"""Document fingerprints: bottom-k sketches of hashed word shingles.

A sketch is the sorted array of the k smallest distinct 32-bit hashes of a
text's shingles.  Sketches of parts merge into the sketch of the whole, and two
sketches estimate resemblance, containment and the number of distinct shingles.
Built-in column functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 128
N_WORDS = 5
# Documents of neighbouring ids meet in groups of 2 ** GROUP_BITS ids.
GROUP_BITS = 8
PARENT_BITS = 10
# A list of at most so many groups is ordered by one task.
MAX_ORDERED = 10_000
# Ids of first rows are broadcast up to this number (16 bytes each).
MAX_BROADCAST_IDS = 500_000


def word_hashes(text: Column) -> Column:
    """64-bit hashes of the words (runs without ASCII white space, A-Z lower-cased)."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.filter(F.split(lower, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def sketch(hashes: Column, k: int = K, n_words: int = N_WORDS) -> Column:
    """Sketch of a text from its word hashes; a shorter text is one shingle.

    Without a word the sketch is empty.
    """
    n = F.size(hashes)
    many = F.transform(
        F.sequence(F.lit(0), n - n_words),
        lambda i: F.hash(*[F.get(hashes, i + j) for j in range(n_words)]),
    )
    all_hashes = (
        F.when(n >= n_words, many)
        .when(n > 0, F.array(F.hash(hashes)))
        .otherwise(F.array().cast("array<int>"))
    )
    return F.slice(F.sort_array(F.array_distinct(all_hashes)), 1, k)


def with_sketch(
    df: DataFrame, text_col: str, name: str, k: int = K, n_words: int = N_WORDS
) -> DataFrame:
    """Adds the sketch of a text column."""
    return (
        df.withColumn("_hashes", word_hashes(F.coalesce(F.col(text_col), F.lit(""))))
        .withColumn(name, sketch(F.col("_hashes"), k, n_words))
        .drop("_hashes")
    )


def merged(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of common shingles in all shingles; 1 for two empty sketches."""
    both = merged(a, b, k)
    common = F.size(F.array_intersect(F.array_intersect(both, a), b))
    return F.when(F.size(both) == 0, 1.0).otherwise(common / F.size(both)).cast("double")


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    share = (F.element_at(a, -1).cast("double") + 2147483649) / 4294967296
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the first text's shingles that the second has too."""
    j = resemblance(a, b, k)
    common = j / (1 + j) * (distinct_shingles(a, k) + distinct_shingles(b, k))
    return F.when(F.size(a) == 0, 1.0).otherwise(
        F.least(F.lit(1.0), common / distinct_shingles(a, k))
    )


def as_text(a: Column) -> Column:
    """Eight hexadecimal digits for each value."""
    return F.array_join(
        F.transform(a, lambda v: F.lpad(F.hex(v.cast("long") + 2147483648), 8, "0")), ""
    )


def following(groups: DataFrame) -> DataFrame:
    """Rows (g, behind): for every number the next larger one, the smallest after the last.

    Long lists are first cut into ranges of numbers; only their few heads are
    ordered as one list, or cut again.
    """
    groups = groups.distinct()
    everything = Window.orderBy("g")
    if groups.count() <= MAX_ORDERED:
        ends = Window.orderBy("g").rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing
        )
        behind = F.coalesce(F.lead("g").over(everything), F.first("g").over(ends))
        return groups.withColumn("behind", behind)
    parents = groups.withColumn("p", F.shiftright("g", PARENT_BITS))
    heads = parents.groupBy("p").agg(F.min("g").alias("head"))
    jumps = (
        following(heads.select(F.col("p").alias("g")))
        .join(heads.withColumnRenamed("p", "behind"), "behind")
        .select(F.col("g").alias("p"), F.col("head"))
    )
    inside = Window.partitionBy("p").orderBy("g")
    return (
        parents.withColumn("next", F.lead("g").over(inside))
        .join(jumps, "p")
        .select("g", F.coalesce("next", "head").alias("behind"))
    )


def with_next(df: DataFrame, id_col: str, columns: list[str]) -> DataFrame:
    """Adds ``next``, the named columns of the row with the next id; of the first after the last.

    One shuffle by groups of neighbouring ids.  The first row of each group
    also goes to the group before it, behind its rows.  The ids of these rows
    are one per group; beyond MAX_BROADCAST_IDS they are joined by a shuffle.
    Null ids come first; rows of one id follow each other by the columns.
    """
    key = F.coalesce(F.col(id_col), F.lit(-(1 << 63)))
    rows = df.withColumn("_key", key)
    groups = rows.select("_key").groupBy(F.shiftright("_key", GROUP_BITS).alias("g"))
    heads = groups.agg(F.min("_key").alias("head"))
    first = (
        following(heads.select("g"))
        .join(heads.select(F.col("g").alias("behind"), "head"), "behind")
        .select(F.col("head").alias("_key"), F.col("g").alias("_before"))
    )
    if heads.count() <= MAX_BROADCAST_IDS:
        first = F.broadcast(first)
    here = F.struct(F.lit(0).alias("_late"), F.shiftright("_key", GROUP_BITS).alias("_g"))
    before = F.struct(F.lit(1).alias("_late"), F.col("_before").alias("_g"))
    sent = F.when(F.col("_before").isNull(), F.array(here)).otherwise(F.array(here, before))
    order = Window.partitionBy("_g").orderBy("_late", "_key", *columns)
    return (
        rows.join(first, "_key", "left")
        .withColumn("_to", F.explode(sent))
        .select("*", "_to._late", "_to._g")
        .withColumn("next", F.lead(F.struct(*columns)).over(order))
        .where("_late = 0")
        .select(*df.columns, "next")
    )


def edited_likeness(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K
) -> DataFrame:
    """Fingerprints of every text and of its edited text, with their likeness.

    The edited text has its last floor(n_chars / 2) code points replaced by the
    first as many (or all) of the next text by ascending id; after the last
    comes the first.  A null text is empty; a null id comes first; rows of one
    id are ordered by their text; other columns are ignored; an empty table
    gives no rows.
    """
    base = df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    rows = with_next(with_sketch(base, "text", "own", k), "doc_id", ["text", "own"])
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), n - half),
        F.substring(F.col("next.text"), F.lit(1), half),
    )
    return (
        with_sketch(
            rows.select(
                "doc_id",
                n.cast("long").alias("n_chars"),
                "own",
                F.col("next.own").alias("following"),
                edited.alias("edited_text"),
            ),
            "edited_text",
            "edited",
            k,
        )
        .select(
            "doc_id",
            "n_chars",
            F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"),
            as_text(F.col("own")).alias("fingerprint"),
            as_text(F.col("edited")).alias("edited_fingerprint"),
            resemblance(F.col("own"), F.col("edited"), k).alias("near_edited"),
            resemblance(F.col("own"), F.col("following"), k).alias("near_next"),
        )
    )
