"""Toxicity scores by a convolutional text classifier.

Words are embedded by hashing the word and its first letters; filters of
several widths slide over the embedded text, each keeps its maximum, and a
logistic layer turns the maxima into a score.  The network is trained in numpy
on a bounded sample of labelled rows.  All labelled rows that it did not learn
from, a fifth of them at least, calibrate the score and a threshold for each
language, weighted so that the classes have their shares of all labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatmetrics.llm.common import Memo, ship, written
from beatmetrics.llm.langid import learning_sample
from beatmetrics.llm.packing import slices

BUCKETS = 1 << 15
HEAD = 5
WIDTHS = (1, 2, 3)
FILTERS = 6
SIZE = 12
DEFAULT_THRESHOLD = 0.3
# Margins are counted in bins of this width, up to the limit on both sides.
BIN = 1 / 32
LIMIT = 40.0
# ASCII letters, digits and all bytes of other characters make words.
_TO_WORDS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def _bucket(word: bytes) -> int:
    """Both hash values of a word in one number: of the whole and of its head."""
    whole = xxhash.xxh3_64_intdigest(word) % BUCKETS
    head = xxhash.xxh3_64_intdigest(b"^" + word.decode(errors="ignore")[:HEAD].encode())
    return whole << 32 | head % BUCKETS + BUCKETS


_PLACES = Memo(_bucket)


def word_places(text: str | None) -> np.ndarray:
    """For every word the two rows of the embedding table, as (n, 2)."""
    words = text.lower().encode().translate(_TO_WORDS).split() if text else []
    both = np.fromiter(map(_PLACES.__getitem__, words), np.int64, len(words))
    return np.stack([both >> 32, both & 0xFFFFFFFF], axis=1)


@dataclass
class Network:
    table: np.ndarray  # (2 * BUCKETS, SIZE): words, then heads
    kernels: list[np.ndarray]  # one (width, SIZE, FILTERS) per width
    shifts: list[np.ndarray]
    output: np.ndarray
    bias: float
    scale: tuple[float, float] = (1.0, 0.0)
    thresholds: dict[str, float] = field(default_factory=dict)

    def pooled(self, places: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Per text the maxima of all filters, and where they stand.

        Texts are laid end to end with blank words between and around them, so
        that every window lies in one text or touches blanks.
        """
        pad = max(WIDTHS)
        lengths = np.array([len(p) for p in places])
        starts = np.cumsum(lengths + pad) - lengths - pad
        words = np.full((int((lengths + pad).sum()), 2), -1, np.int64)
        for at, p in zip(starts, places, strict=True):
            words[at : at + len(p)] = p
        x = self.table[words[:, 0]] + self.table[words[:, 1]]
        x[words[:, 0] < 0] = 0
        best, where = [], []
        for kernel, shift in zip(self.kernels, self.shifts, strict=True):
            width = len(kernel)
            out = x @ kernel[0]
            for j in range(1, width):
                out[:-j] += x[j:] @ kernel[j]
            out += shift
            top = np.maximum.reduceat(out, starts, axis=0)
            best.append(np.maximum(top, 0))
            where.append((out, top, width))
        self._last = (words, starts, lengths + pad, x, where)
        return np.concatenate(best, axis=1), starts

    def margin(self, places: list[np.ndarray]) -> np.ndarray:
        return self.pooled(places)[0] @ self.output + self.bias

    def margins(self, texts: list[str | None]) -> np.ndarray:
        """Margins; texts are taken in groups that stay small in memory."""
        out, group, words = [], [], 0
        for text in [*texts, None]:
            place = word_places(text)
            if group and words + len(place) > 30_000:
                out.append(self.margin(group))
                group, words = [], 0
            group.append(place)
            words += len(place)
        out.append(self.margin(group))
        return np.concatenate(out)[:-1]

    def probability(self, margins: np.ndarray) -> np.ndarray:
        a, b = self.scale
        return 1 / (1 + np.exp(-np.clip(a * margins + b, -40, 40)))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        return self.probability(self.margins(texts))

    def train(self, places: list[np.ndarray], y: np.ndarray, epochs: int, rate: float) -> None:
        """Stochastic gradient descent with momentum-free Adagrad steps."""
        order = np.random.default_rng(11)
        sums = {
            "table": np.full(len(self.table), 1e-4),
            "kernels": [np.full_like(k, 1e-4) for k in self.kernels],
            "output": np.full_like(self.output, 1e-4),
        }
        for _ in range(epochs):
            shuffled = order.permutation(len(y))
            for i in range(0, len(y), 16):
                rows = shuffled[i : i + 16]
                pooled, _ = self.pooled([places[r] for r in rows])
                p = 1 / (1 + np.exp(-np.clip(pooled @ self.output + self.bias, -40, 40)))
                error = (p - y[rows]) / len(rows)
                back = np.outer(error, self.output) * (pooled > 0)
                step = pooled.T @ error
                sums["output"] += step**2
                self.output -= (rate * step / np.sqrt(sums["output"])).astype(np.float32)
                self.bias -= rate * float(error.sum())
                self._step_filters(back, sums, rate)

    def _step_filters(self, back: np.ndarray, sums: dict, rate: float) -> None:
        words, starts, lengths, x, where = self._last
        places, changes = [], []
        for w, (out, top, width) in enumerate(where):
            kernel = self.kernels[w]
            change = np.zeros_like(kernel)
            for t, (a, n) in enumerate(zip(starts, lengths, strict=True)):
                block = out[a : a + n]
                for f in range(FILTERS):
                    g = back[t, w * FILTERS + f]
                    if g:
                        at = a + int((block[:, f] == top[t, f]).argmax())
                        span = slice(at, at + width)
                        seen = x[span]
                        change[: len(seen), :, f] += g * seen
                        self.shifts[w][f] -= rate * g
                        places.append(words[span])
                        changes.append(g * kernel[: len(seen), :, f])
            sums["kernels"][w] += change**2
            kernel -= (rate * change / np.sqrt(sums["kernels"][w])).astype(np.float32)
        if places:
            at, step = np.concatenate(places), np.concatenate(changes)
            keep = at[:, 0] >= 0
            at, step = at[keep], step[keep]
            for column in (0, 1):
                np.add.at(sums["table"], at[:, column], (step**2).mean(axis=1))
                slow = np.sqrt(sums["table"][at[:, column]])[:, None]
                np.add.at(self.table, at[:, column], (-0.3 * rate * step / slow).astype(np.float32))


def start(places: list[np.ndarray], y: np.ndarray) -> Network:
    """A network whose first embedding axis holds the log-odds of each hash value.

    The other axes and the filters are small random numbers.
    """
    random = np.random.default_rng(3)
    table = random.normal(0, 0.1, (2 * BUCKETS, SIZE)).astype(np.float32)
    counts = np.zeros((2, 2 * BUCKETS))
    for p, label in zip(places, y, strict=True):
        counts[int(label), np.unique(p)] += 1
    n = np.array([(y == 0).sum(), (y == 1).sum()]) + 2.0
    share = (counts + 2.0 * n[:, None] / n.sum()) / n[:, None]
    table[:, 0] = np.log(share[1] / share[0])
    kernels = [
        random.normal(0, 0.1, (w, SIZE, FILTERS)).astype(np.float32) for w in WIDTHS
    ]
    for kernel in kernels:
        kernel[:, 0, :] = np.abs(kernel[:, 0, :]) + 1.0 / len(kernel)
    shifts = [np.full(FILTERS, -1.0, np.float32) for _ in WIDTHS]
    output = np.full(len(WIDTHS) * FILTERS, 0.1, np.float32)
    return Network(table, kernels, shifts, output, -1.0)


def logistic(margins: np.ndarray, y: np.ndarray, rows: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a calibrated logistic curve (Newton steps, smoothed targets).

    ``rows`` says how many rows each margin and class stands for.
    """
    n1, n0 = rows[y == 1].sum(), rows[y == 0].sum()
    if not n1 or not n0:
        return 1.0, 0.0
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margins, np.ones_like(margins)], axis=1).astype(np.float64)
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (rows * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        slope = x.T @ (rows * (p - target)) + 1e-3 * (w - [1.0, 0.0])
        w -= np.clip(np.linalg.solve(h, slope), -2, 2)
    return float(w[0]), float(w[1])


def best_threshold(scores: np.ndarray, y: np.ndarray, rows: np.ndarray) -> float:
    """The cut with the best F1 score, midway between the scores around it."""
    s, at = np.unique(-scores, return_inverse=True)
    s = -s
    toxic = np.bincount(at, rows * (y == 1), len(s))
    hits = np.cumsum(toxic)
    f1 = 2 * hits / (np.cumsum(np.bincount(at, rows, len(s))) + toxic.sum())
    at = int(f1.argmax())
    below = s[at + 1] if at + 1 < len(s) else 0.0
    return float(np.clip((s[at] + below) / 2, 0.05, 0.95))


def fit(
    documents: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str | None = "lang",
    label_col: str = "toxic",
    per_class: int = 3000,
    epochs: int = 4,
    least_positives: int = 20,
    rate: float = 0.05,
) -> Network:
    """Learns from at most ``per_class`` labelled rows of each class.

    A fifth of the ids, by hash, is never learned from.  Scale and thresholds
    come from all labelled rows without those learned from, whatever the size.
    Languages with ``least_positives`` held-back toxic rows get a threshold of
    their own, others the default.  Repeated labels of an id count as their
    maximum; rows without a label or an id are not learned from.
    """
    ship(documents.sparkSession)
    lang = F.col(lang_col).cast("string") if lang_col else F.lit(None).cast("string")
    texts = documents.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(text_col).cast("string").alias("text"),
        lang.alias("lang"),
    ).where("id IS NOT NULL")
    marks = (
        labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("y"))
        .where("id IS NOT NULL AND y IN (0, 1)")
        .groupBy("id")
        .agg(F.max("y").alias("y"))
    )
    marks = written(marks, "labels")
    labelled = texts.select("id").distinct().join(marks, "id")
    free = labelled.where(F.pmod(F.xxhash64("id", F.lit("held back")), F.lit(5)) != 4)
    chosen = written(learning_sample(free, "y", per_class, "id", max_classes=2), "sample")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [word_places(t.as_py()).astype("<i4").tobytes() for t in batch.column(3)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(data, pa.binary())],
                names=["id", "lang", "y", "words"],
            )

    rows = (
        # Two classes of at most per_class rows.
        texts.join(F.broadcast(chosen), "id")
        .select("id", "lang", F.col("y").cast("int").alias("y"), "text")
        .mapInArrow(run, "id long, lang string, y int, words binary")
        .toArrow()
        .to_pylist()
    )
    rows.sort(key=lambda r: (xxhash.xxh3_64_intdigest(str(r["id"])), r["words"]))
    places = [np.frombuffer(r["words"], "<i4").reshape(-1, 2) for r in rows]
    y = np.array([r["y"] for r in rows], np.int64)
    network = start(places, y)
    network.train(places, y, epochs, rate)
    network._last = None
    calibrate(network, *margin_counts(network, texts, marks, chosen), least_positives)
    return network


def margin_counts(
    network: Network, texts: DataFrame, marks: DataFrame, chosen: DataFrame
) -> tuple[DataFrame, dict[int, float]]:
    """Rows (lang, bin, y, n) of the labelled rows not learned from, and weights of the classes.

    All texts are scored where they are read; only their ids, languages and
    bins meet the labels.  A weight is all labelled rows of a class by those
    counted.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1000):
                margins = network.margins(batch.column(1).to_pylist())
                bins = np.rint(np.clip(margins, -LIMIT, LIMIT) / BIN).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(2), pa.array(bins)], names=["id", "lang", "bin"]
                )

    used = chosen.select("id", F.lit(True).alias("used"))
    counts = written(
        texts.select("id", "text", "lang")
        .mapInArrow(run, "id long, lang string, bin int")
        .join(marks, "id")
        # Two classes of at most per_class ids.
        .join(F.broadcast(used), "id", "left")
        .groupBy("lang", "bin", F.col("y").cast("int").alias("y"), F.col("used").isNull().alias("held"))
        .agg(F.count(F.lit(1)).alias("n")),
        "margins",
    )
    held = F.sum(F.when(F.col("held"), F.col("n")))
    shares = counts.groupBy("y").agg(F.sum("n").alias("n"), held.alias("held")).collect()
    weights = {r["y"]: r["n"] / r["held"] for r in shares if r["held"]}
    return counts.where("held").drop("held"), weights


def calibrate(
    network: Network, counts: DataFrame, weights: dict[int, float], least_positives: int
) -> None:
    """Sets scale and thresholds from counts (lang, bin, y, n) of held-back rows."""

    def arrays(rows: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        y = np.array([r["y"] for r in rows], np.int64)
        n = np.array([r["n"] * weights[r["y"]] for r in rows], np.float64)
        return np.array([r["bin"] for r in rows]) * BIN, y, n

    # At most two rows per bin.
    rows = counts.groupBy("bin", "y").agg(F.sum("n").alias("n")).orderBy("bin", "y").collect()
    if not rows:
        return
    network.scale = logistic(*arrays(rows))
    # The network holds a threshold of each of these languages; each has at most two rows per bin.
    known = (
        counts.where("lang <> '' AND y = 1").groupBy("lang").agg(F.sum("n").alias("toxic"))
        .where(F.col("toxic") >= least_positives)
    )
    by_lang: dict[str, list] = {}
    for r in counts.join(known, "lang").orderBy("lang", "bin", "y").toLocalIterator():
        by_lang.setdefault(r["lang"], []).append(r)
    for name, own in by_lang.items():
        margins, y, n = arrays(own)
        network.thresholds[name] = best_threshold(network.probability(margins), y, n)


def score(
    df: DataFrame,
    network: Network,
    id_col: str = "doc_id",
    text_col: str = "text",
    name: str = "score",
) -> DataFrame:
    """Rows (doc_id, score), one per row of the table, by whole texts alone.

    A null or empty text has the score of a text without words.  A map without
    a shuffle: null and repeated ids stay, other columns are ignored.
    """
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1000):
                scores = network.scores(batch.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(scores.astype(np.float64))], names=[id_col, name]
                )

    return df.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        run, f"`{id_col}` long, `{name}` double"
    )


def keep_clean(
    df: DataFrame, network: Network, text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """The rows, unchanged, that score below the threshold of their language."""
    ship(df.sparkSession)
    text, lang = df.columns.index(text_col), df.columns.index(lang_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1000):
                scores = network.scores(batch.column(text).to_pylist())
                cuts = [
                    network.thresholds.get(x.as_py(), DEFAULT_THRESHOLD)
                    for x in batch.column(lang)
                ]
                yield batch.filter(pa.array(scores < np.array(cuts)))

    return df.mapInArrow(run, df.schema)
