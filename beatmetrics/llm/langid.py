"""Language identification by sparse multinomial logistic regression.

Features are hashed character 1- to 3-grams of the lower-cased text, with
everything that is no letter as a space, weighted by TF-IDF.  Document
frequencies cover all learning rows; the weights come from a bounded sample by
follow-the-regularised-leader with L1 and L2 penalties, one step per document
and coordinate, and a temperature fitted on held-back rows turns the margins
into probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beatmetrics.llm.common import ship
from beatmetrics.llm.packing import slices

BITS = 16
SCALE = 32.0
UNKNOWN = "und"
_LETTERS: list[np.ndarray] = []


def letter_codes(text: str) -> np.ndarray:
    """Code points of the lower-cased text, 32 for everything but letters."""
    if not _LETTERS:
        kinds = np.zeros(0x110000, bool)
        kinds[[i for i in range(0x110000) if chr(i).isalpha()]] = True
        _LETTERS.append(kinds)
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(_LETTERS[0][codes], codes, np.uint32(32))


def grams(text: str | None) -> np.ndarray | None:
    """Hashed 1-, 2- and 3-grams of a text; None without a letter."""
    codes = letter_codes(text) if text else np.empty(0, np.uint32)
    if not (codes != 32).any():
        return None
    one = codes * np.uint32(0x9E3779B1)
    two = (one[:-1] ^ (codes[1:] + np.uint32(0x7F4A7C15))) * np.uint32(0x85EBCA6B)
    three = (two[:-1] ^ (codes[2:] + np.uint32(0x165667B1))) * np.uint32(0xC2B2AE35)
    return np.concatenate([one, two, three]) >> np.uint32(32 - BITS)


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # one row per hashed gram, IDF and scale included
    bias: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        """The likeliest language and its probability."""
        found = grams(text)
        if found is None or not self.langs:
            return UNKNOWN, 0.0
        margins = self.weights[found].sum(axis=0, dtype=np.float64) / len(found) + self.bias
        p = softmax(margins / self.temperature)
        best = int(p.argmax())
        return self.langs[best], float(p[best])


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def document_frequencies(df: DataFrame, text_col: str) -> tuple[np.ndarray, int]:
    """In how many texts each hashed gram stands, over all rows.

    Every task sends at most one row per gram, so what comes together is
    bounded by the number of hash values.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen, docs = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, bool), 0
        for batch in batches:
            for text in batch.column(0):
                found = grams(text.as_py())
                if found is not None:
                    docs += 1
                    seen[:] = False
                    seen[found] = True
                    counts += seen
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, -1)), pa.array(np.append(counts[used], docs))],
            names=["gram", "docs"],
        )

    rows = (
        df.select(F.col(text_col).cast("string"))
        .mapInArrow(run, "gram long, docs long")
        .groupBy("gram")
        .agg(F.sum("docs").alias("docs"))
        .toArrow()
    )
    total = np.zeros((1 << BITS) + 1, np.int64)
    total[rows["gram"].to_numpy()] = rows["docs"].to_numpy()
    return total[:-1], int(total[-1])


def learning_sample(
    df: DataFrame, class_col: str, per_class: int, id_col: str, max_classes: int = 500
) -> DataFrame:
    """Ids of up to ``per_class`` rows of each class, the first by a hash of the id.

    The classes are counted first, so that a cut of the hash leaves about twice
    as many rows of each as are wanted, however many there are.  More than
    ``max_classes`` are an error: none is left out in silence.
    """
    rows = df.groupBy(class_col).count().limit(max_classes + 1).collect()
    if len(rows) > max_classes:
        raise ValueError(f"more than {max_classes} values of {class_col!r}; raise max_classes")
    if not rows:
        return df.select(id_col, class_col).limit(0)
    shares = F.create_map(
        *[F.lit(x) for r in rows for x in (r[0], min(1.0, (2 * per_class + 200) / r[1]))]
    )
    place = F.xxhash64(F.col(id_col))
    order = Window.partitionBy(class_col).orderBy("_hash", id_col)
    return (
        df.select(id_col, class_col, place.alias("_hash"))
        .where((F.col("_hash").cast("double") / 2.0**64 + 0.5) <= shares[F.col(class_col)])
        .withColumn("_place", F.row_number().over(order))
        .where(F.col("_place") <= per_class)
        .select(id_col, class_col)
    )


def fit(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = 800,
    epochs: int = 4,
    max_languages: int = 500,
) -> Model:
    """Learns from the rows with a language and an id.

    At most ``per_language`` rows of each language train the weights; document
    frequencies are counted over all rows.  The model holds a weight per gram
    and language on the driver, so more than ``max_languages`` are an error.
    """
    ship(df.sparkSession)
    rows = df.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(text_col).cast("string").alias("text"),
        F.col(lang_col).cast("string").alias("lang"),
    ).where("lang IS NOT NULL AND id IS NOT NULL AND text IS NOT NULL")
    frequency, docs = document_frequencies(rows, "text")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = grams(text)
                if found is not None:
                    used, n = np.unique(found, return_counts=True)
                    share = (n / len(found)).astype("<f4").tobytes()
                    out.append((lang, used.astype("<u4").tobytes(), share))
            columns = list(zip(*out, strict=True)) if out else [[], [], []]
            kinds = [pa.string(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["lang", "grams", "shares"],
            )

    chosen = learning_sample(rows, "lang", per_language, "id", max_languages).select("id")
    sample = (
        # Bounded by the parameters of the sample.
        rows.join(F.broadcast(chosen), "id", "left_semi")
        .select("lang", "text")
        .mapInArrow(counted, "lang string, grams binary, shares binary")
        .toArrow()
        .to_pylist()
    )
    langs = sorted({r["lang"] for r in sample})
    idf = np.log((1 + docs) / (1 + frequency)) + 1
    x = [
        (np.frombuffer(r["grams"], "<u4"), np.frombuffer(r["shares"], "<f4"))
        for r in sorted(sample, key=lambda r: (r["lang"], r["grams"], r["shares"]))
    ]
    y = np.array(sorted(langs.index(r["lang"]) for r in sample), np.int64)
    x = [(g, SCALE * s * idf[g]) for g, s in x]
    weights, bias, temperature = train(x, y, len(langs), epochs)
    table = (SCALE * idf[:, None] * weights).astype(np.float32)
    return Model(langs, table, bias, temperature)


def train(
    x: list[tuple[np.ndarray, np.ndarray]],
    y: np.ndarray,
    n_langs: int,
    epochs: int,
    alpha: float = 0.3,
    beta: float = 1.0,
    l1: float = 0.02,
    l2: float = 0.01,
) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights, bias and temperature; every fifth row only fits the temperature."""
    size = 1 << BITS
    z, n = np.zeros((size + 1, n_langs)), np.zeros((size + 1, n_langs))

    def current(at):
        keep = np.sign(z[at]) * np.maximum(np.abs(z[at]) - l1, 0)
        return -keep / ((beta + np.sqrt(n[at])) / alpha + l2)

    order = np.random.default_rng(7)
    held = np.arange(len(y)) % 5 == 4
    rows = np.flatnonzero(~held)
    x = [(np.append(g, size), np.append(v, 1.0)) for g, v in x]  # the last is the bias
    for _ in range(epochs):
        for i in order.permutation(rows):
            at, value = x[i]
            w = current(at)
            error = softmax(value @ w)
            error[y[i]] -= 1
            gradient = np.outer(value, error)
            grown = n[at] + gradient**2
            z[at] += gradient - (np.sqrt(grown) - np.sqrt(n[at])) / alpha * w
            n[at] = grown
    w = current(np.arange(size + 1))
    margins = np.array([v @ w[g] for g, v in (x[i] for i in np.flatnonzero(held))])
    temperature, least = 1.0, np.inf
    for t in np.geomspace(0.05, 20, 60) if len(margins) else []:
        p = softmax(margins / t)[np.arange(len(margins)), y[held]]
        loss = -np.log(np.maximum(p, 1e-12)).mean()
        if loss < least:
            temperature, least = float(t), loss
    return w[:-1], w[-1], temperature


def predict(
    df: DataFrame,
    model: Model,
    text_col: str = "text",
    names: tuple[str, str] = ("lang_pred", "score"),
    id_col: str = "doc_id",
) -> DataFrame:
    """Rows (doc_id, language, probability), one per row of the table.

    The language is ``und`` and the probability 0 when the text is null or has
    no letter, or nothing was learned.  A map over whole texts without a
    shuffle; null and repeated ids stay, other columns are ignored.
    """
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 2000):
                found = [model.predict(t.as_py()) for t in batch.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array([f[0] for f in found], pa.string()),
                        pa.array([f[1] for f in found], pa.float64()),
                    ],
                    names=[id_col, *names],
                )

    return df.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        run, f"`{id_col}` long, `{names[0]}` string, `{names[1]}` double"
    )


def keep_identified(
    df: DataFrame, model: Model, least: float = 0.3, text_col: str = "text"
) -> DataFrame:
    """The rows, unchanged, whose language is known with probability ``least`` or more.

    Rows without a letter go.  All columns are kept as they are.
    """
    ship(df.sparkSession)
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 2000):
                found = [model.predict(t.as_py()) for t in batch.column(at)]
                yield batch.filter(pa.array([x != UNKNOWN and p >= least for x, p in found]))

    return df.mapInArrow(run, df.schema)
