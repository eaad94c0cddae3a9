"""Personal data: base patterns and boosted candidates.

Base spans are the matches of four patterns that pass a check.  Generators with
high recall propose further, possibly overlapping spans: numbers that stand
inside a longer failed match, or masked addresses.  Trees boosted on format and
context features score them, and a threshold calibrated on held-back documents
selects the ones to add.  Everything runs on built-in column functions; only
counts per feature vector, whose number is bounded by the bins, reach the
driver, where the trees are fitted.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The kinds in their order.
KINDS = ("email", "ip", "card", "phone")
# Stand-ins for a separator between digits and a dot between labels, one for one.
SEP, DOT = "\ue000", "\ue001"

_NAME = rf"[A-Za-z0-9._%+\-{DOT}]"
_EMAIL = rf"(?:\G|(?<!{_NAME})){_NAME}++@[A-Za-z0-9-]++{DOT}[A-Za-z0-9\-{DOT}]++"
_IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = rf"[0-9{SEP}]{{16,}}+"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_BYTE = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"

# Generators: kind, pattern.
GENERATORS = (
    (
        1,
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?(?:\(at\)|\[at\]|@)\x20?"
        r"[A-Za-z0-9-]{1,63}(?:\x20?(?:\(dot\)|\[dot\]|\.)\x20?[A-Za-z0-9-]{1,63}){1,4}",
    ),
    (3, r"(?<![0-9])[0-9]{12,19}(?![0-9])"),
    (3, r"(?<![0-9])(?:[0-9]{4}[\x20-]){3}[0-9]{4}(?![0-9])"),
    (
        4,
        r"(?:\+[0-9]{1,3}[\x20-]?)?\(?(?<![0-9])[0-9]{2,4}\)?[\x20.-][0-9]{3}[\x20.-]?[0-9]{4}"
        r"(?![0-9])",
    ),
)
FEATURES = ("kind", "digits", "separators", "plus", "masked", "checksum", "before", "behind")


def found(text: Column, pattern: str) -> Column:
    """Matches from left to right with their places, as code points from 0.

    A text lies between its matches, so places are running sums of lengths.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.arrays_zip(F.split(text, pattern).alias("gap"), matches.alias("hit"))
    none = F.array().cast("array<struct<start:int,end:int>>")

    def step(acc, x):
        start = acc["at"] + F.char_length(x["gap"])
        end = start + F.char_length(x["hit"])
        span = F.struct(start.alias("start"), end.alias("end"))
        return F.when(
            x["hit"].isNotNull(),
            F.struct(end.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans")),
        ).otherwise(acc)

    begin = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    return F.when(F.size(matches) == 0, none).otherwise(
        F.aggregate(pairs, begin, step, lambda acc: acc["spans"])
    )


def _cut(text: Column, span: Column) -> Column:
    return F.substring(text, span["start"] + 1, span["end"] - span["start"])


def _digits(part: Column) -> Column:
    return F.regexp_replace(part, "[^0-9]", "")


def _checked(kind: int, part: Column) -> Column:
    if kind == 2:
        return part.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    n = F.char_length(_digits(part))
    if kind == 3:
        return n.between(16, 19) & F.call_function("luhn_check", _digits(part))
    return n.between(8, 15) if kind == 4 else F.lit(True)


def _passes(kind: int, text: Column):
    return lambda span: _checked(kind, _cut(text, span))


def _of_kind(kind: int, spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"], s["end"]))


def _count(kind: int) -> Column:
    return F.size(F.filter(F.col("_base"), lambda s: s["kind"] == kind)).cast("long")


def with_base(df: DataFrame, text_col: str) -> DataFrame:
    """Adds ``_base``, the sorted base spans as (kind, start, end), of a text without nulls."""
    text = F.col(text_col)
    no_spans = F.array().cast("array<struct<start:int,end:int>>")
    has_digit = text.rlike("[0-9]")
    dotted = F.regexp_replace(
        F.translate(text, DOT, "·"), r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", DOT
    )
    joined = F.regexp_replace(
        F.translate(text, SEP, "·"), r"(?<=[0-9])[\x20-](?=[0-9])", SEP
    )
    sources = [
        (F.contains(text, F.lit("@")), dotted, _EMAIL),
        (has_digit, text, _IP),
        (has_digit, joined, _CARD),
        (F.contains(text, F.lit("+")) & has_digit, text, _PHONE),
    ]
    # Every copy and every list of matches is a column of its own, computed once.
    for kind, (when, source, pattern) in enumerate(sources, 1):
        df = df.withColumn(f"_copy{kind}", F.when(when, source).otherwise(""))
        spans = F.coalesce(found(F.col(f"_copy{kind}"), pattern), no_spans)
        df = df.withColumn(f"_spans{kind}", spans)
    parts = [_of_kind(k, F.filter(F.col(f"_spans{k}"), _passes(k, text))) for k in range(1, 5)]
    df = df.withColumn("_base", F.sort_array(F.concat(*parts)))
    return df.drop(*[f"_copy{k}" for k in range(1, 5)], *[f"_spans{k}" for k in range(1, 5)])


def _side(char: Column) -> Column:
    """Class of a neighbouring character: 0 edge or space, 1 letter, 2 digit, 3 other."""
    return (
        F.when(char.rlike(r"^\s?$"), 0)
        .when(char.rlike(r"^\p{L}"), 1)
        .when(char.rlike("^[0-9]"), 2)
        .otherwise(3)
    )


def with_candidates(df: DataFrame, text_col: str) -> DataFrame:
    """Adds ``_candidates``: generated spans with their features.

    ``base`` says whether the span is a base span, ``apart`` whether it
    overlaps none.
    """
    text = F.col(text_col)
    useful = text.rlike("[0-9]") | text.rlike(r"\[at\]|\(at\)|@")
    lists = []
    for i, (kind, pattern) in enumerate(GENERATORS):
        source = F.when(useful, text).otherwise("")
        df = df.withColumn(f"_made{i}", found(source, pattern))
        lists.append(_of_kind(kind, F.col(f"_made{i}")))
    df = df.withColumn("_made", F.array_distinct(F.concat(*lists)))

    def described(c):
        part = _cut(text, c)
        digits = _digits(part)
        left = F.when(c["start"] == 0, "").otherwise(F.substring(text, c["start"], F.lit(1)))
        right = F.substring(text, c["end"] + 1, F.lit(1))
        overlaps = F.exists(
            F.col("_base"), lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])
        )
        return F.struct(
            c["kind"],
            c["start"],
            c["end"],
            F.least(F.char_length(digits), F.lit(20)).alias("digits"),
            F.least(
                F.char_length(F.regexp_replace(part, r"[^\x20().-]", "")), F.lit(9)
            ).alias("separators"),
            F.startswith(part, F.lit("+")).cast("int").alias("plus"),
            part.rlike(r"[(\[](?:at|dot)[)\]]").cast("int").alias("masked"),
            F.call_function("luhn_check", digits).cast("int").alias("checksum"),
            _side(left).alias("before"),
            _side(right).alias("behind"),
            F.array_contains(F.col("_base"), c).alias("base"),
            (~overlaps).alias("apart"),
        )

    df = df.withColumn("_candidates", F.transform(F.col("_made"), described))
    return df.drop("_made", *[f"_made{i}" for i in range(len(GENERATORS))])


@dataclass
class Trees:
    """Boosted trees of depth two and the threshold of each kind."""

    bias: float = 0.0
    # (feature, cut, feature left, cut, two values, feature right, cut, two values)
    trees: list[tuple] = field(default_factory=list)
    thresholds: dict[int, float] = field(default_factory=dict)

    def margin(self, candidate: Column) -> Column:
        total = F.lit(self.bias)
        for name, cut, left, right in self.trees:
            sides = [
                F.when(candidate[n] <= c, F.lit(low)).otherwise(F.lit(high))
                for n, c, low, high in (left, right)
            ]
            total = total + F.when(candidate[name] <= cut, sides[0]).otherwise(sides[1])
        return total

    def margins(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.bias)
        for tree in self.trees:
            out += _evaluate(tree, x)
        return out


def _evaluate(tree: tuple, x: np.ndarray) -> np.ndarray:
    name, cut, left, right = tree
    sides = [
        np.where(x[:, FEATURES.index(n)] <= c, low, high) for n, c, low, high in (left, right)
    ]
    return np.where(x[:, FEATURES.index(name)] <= cut, *sides)


def _best_cut(x, gradient, weight, penalty):
    """The split of these rows with the largest gain: feature, cut and both values."""
    best = (-1.0, FEATURES[0], 0, 0.0, 0.0)
    for f, name in enumerate(FEATURES):
        for cut in np.unique(x[:, f]) if len(x) else []:
            low = x[:, f] <= cut
            sums = [(gradient[m].sum(), weight[m].sum()) for m in (low, ~low)]
            gain = sum(g * g / (h + penalty) for g, h in sums)
            if gain > best[0]:
                best = (gain, name, int(cut), *(float(g / (h + penalty)) for g, h in sums))
    return best


def boost(
    x: np.ndarray, hits: np.ndarray, rows: np.ndarray, rounds: int, rate: float, penalty: float = 2.0
) -> Trees:
    """Newton boosting on distinct feature vectors with their counts."""
    model = Trees()
    if not rows.sum():
        return model
    share = (hits.sum() + 1) / (rows.sum() + 2)
    model.bias = float(np.log(share / (1 - share)))
    margin = np.full(len(x), model.bias)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        gradient, weight = hits - rows * p, rows * p * (1 - p)
        _, name, cut, _, _ = _best_cut(x, gradient, weight, penalty)
        low = x[:, FEATURES.index(name)] <= cut
        sides = [_best_cut(x[m], gradient[m], weight[m], penalty) for m in (low, ~low)]
        tree = (name, cut, *((n, c, rate * a, rate * b) for _, n, c, a, b in sides))
        model.trees.append(tree)
        margin = margin + _evaluate(tree, x)
    return model


def fit(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rounds: int = 12,
    rate: float = 0.5,
    precision: float = 0.99,
) -> Trees:
    """Fits trees and thresholds on the candidates of all texts.

    A candidate that is a base span counts as a hit, one that overlaps none
    and fails its checksum or stands inside a word or number as a miss; the
    rest is open and not learned from.  Documents with crc32(id) mod 5 = 0 only
    calibrate: a kind's threshold is the lowest score from which at least
    ``precision`` of their candidates are hits, with 20 hits or more; without
    one the kind adds nothing.
    """
    base = df.select(
        F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")).alias("_crc"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"),
    )
    c = F.col("c")
    miss = c["apart"] & (
        ((c["checksum"] == 0) & (c["kind"] == 3)) | c["before"].isin(1, 2) | c["behind"].isin(1, 2)
    )
    counts = (
        with_candidates(with_base(base, "_text"), "_text")
        .select((F.col("_crc") % 5 == 0).alias("held"), F.explode("_candidates").alias("c"))
        .where(c["base"] | miss)
        .groupBy("held", *[c[f].alias(f) for f in FEATURES])
        .agg(F.sum(c["base"].cast("long")).alias("hits"), F.count(F.lit(1)).alias("rows"))
        .collect()
    )
    counts.sort()
    x = np.array([[r[f] for f in FEATURES] for r in counts], np.int64).reshape(-1, len(FEATURES))
    hits = np.array([r["hits"] for r in counts], float)
    rows = np.array([r["rows"] for r in counts], float)
    held = np.array([r["held"] for r in counts], bool)
    model = boost(x[~held], hits[~held], rows[~held], rounds, rate)
    margin = model.margins(x)
    for kind in range(1, 5):
        here = held & (x[:, 0] == kind)
        order = np.argsort(-margin[here])
        good, all_rows = np.cumsum(hits[here][order]), np.cumsum(rows[here][order])
        enough = np.flatnonzero((good >= 20) & (good >= precision * all_rows))
        if len(enough):
            model.thresholds[kind] = float(margin[here][order][enough[-1]])
    return model


def with_spans(df: DataFrame, model: Trees, text_col: str) -> DataFrame:
    """Adds ``_base`` and ``_spans``: base spans, and all spans with the added ones.

    An added span overlaps no base span and reaches its kind's threshold; the
    longest wins among added spans that overlap.
    """
    df = with_candidates(with_base(df, text_col), text_col)

    def chosen(c):
        cuts = F.lit(False)
        for kind, cut in sorted(model.thresholds.items()):
            # A number whose checksum fails is never a card.
            cuts = cuts | (
                (c["kind"] == kind) & (model.margin(c) >= cut)
                & ((c["kind"] != 3) | (c["checksum"] == 1))
            )
        return c["apart"] & cuts

    df = df.withColumn("_added", F.filter(F.col("_candidates"), chosen))
    added = F.col("_added")
    alone = F.filter(
        added,
        lambda c: ~F.exists(
            added,
            lambda d: (d["start"] < c["end"]) & (c["start"] < d["end"])
            & (
                ((d["end"] - d["start"]) > (c["end"] - c["start"]))
                | (
                    ((d["end"] - d["start"]) == (c["end"] - c["start"]))
                    & (F.struct(d["kind"], d["start"]) < F.struct(c["kind"], c["start"]))
                )
            ),
        ),
    )
    more = F.transform(alone, lambda c: F.struct(c["kind"], c["start"], c["end"]))
    spans = F.when(F.size(added) == 0, F.col("_base")).otherwise(
        F.sort_array(F.concat(F.col("_base"), more))
    )
    return df.withColumn("_spans", spans).drop("_candidates", "_added")


def spans_text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.get(names, s["kind"] - 1), s["start"], s["end"])
        ),
        ",",
    )


def find(
    df: DataFrame, model: Trees, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Counts of base spans by kind, their digest, and all spans of every text.

    A map over whole texts without a shuffle.  A null text is empty; null and
    repeated ids stay; an empty table gives no rows; other columns are ignored.
    """
    base = df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"),
    )
    rows = with_spans(base, model, "_text")
    counts = [_count(k).alias(f"n_{name}") for k, name in enumerate(KINDS, 1)]
    return rows.select(
        "doc_id",
        *counts,
        F.sha2(spans_text(F.col("_base")).cast("binary"), 256).alias("base_sha256"),
        spans_text(F.col("_spans")).alias("spans"),
    )


def redact(df: DataFrame, model: Trees, text_col: str = "text") -> DataFrame:
    """The rows with every span replaced by its kind in brackets; nulls stay null.

    Overlapping spans are replaced together, by the kind of the first.  Other
    columns are kept as they are, whatever their names.
    """
    # The caller's columns go by numbers, so that no working name meets them.
    numbers = [f"c{i}" for i in range(len(df.columns))]
    own = F.col(f"c{df.columns.index(text_col)}")
    rows = with_spans(
        df.toDF(*numbers).withColumn("_text", F.coalesce(own, F.lit(""))), model, "_text"
    )
    text = F.col("_text")
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    by_place = F.sort_array(
        F.transform(
            F.col("_spans"),
            lambda s: F.struct(s["start"], (-s["end"]).alias("back"), s["kind"], s["end"]),
        )
    )

    def step(acc, s):
        gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        return F.when(
            s["start"] >= acc["at"],
            F.struct(
                s["end"].alias("at"),
                F.concat(acc["out"], gap, F.get(names, s["kind"] - 1)).alias("out"),
            ),
        ).otherwise(
            F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))
        )

    done = F.aggregate(
        by_place,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        step,
        lambda acc: F.concat(
            acc["out"], F.substring(text, acc["at"] + 1, F.greatest(F.char_length(text), F.lit(0)))
        ),
    )
    clean = F.when(F.size("_spans") == 0, own).otherwise(done)
    columns = [
        (clean if name == text_col else F.col(n)).alias(name)
        for n, name in zip(numbers, df.columns, strict=True)
    ]
    return rows.select(*columns)
