"""Shared helpers: written tables, code for the workers, shingles of words."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession

from beatmetrics.sources.scratch import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read again; cuts the lineage.

    A lost executor costs nothing here: the files are on shared storage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.written_to = path
    return table


def release(*tables: DataFrame) -> None:
    """Empties tables of :func:`written` that no later step reads, to free the shared folder.

    Everything made from them must be written by then: it could not be made anew.
    """
    for table in tables:
        nothing = table.sparkSession.range(0).select("id")
        nothing.write.mode("overwrite").parquet(table.written_to)


def ship(spark: SparkSession) -> None:
    """Sends the package to the Python workers, once per Spark context."""
    context = spark.sparkContext
    if getattr(context, "_beatmetrics_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as archive:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(package)))
    path = os.path.join(tempfile.mkdtemp(), "beatmetrics_code.zip")
    with open(path, "wb") as out:
        out.write(data.getvalue())
    context.addPyFile(path)
    context._beatmetrics_shipped = True


# A worker keeps its memory between stages, so what it remembers is bounded in bytes:
# keys up to this length, and as many of them as a limit allows.
KEY_MAX_BYTES = 64


class Memo(dict):
    """A dict that computes absent values and starts anew when it is full.

    Values of long keys are computed each time and not kept.
    """

    def __init__(self, compute, limit: int = 150_000):
        super().__init__()
        self.compute = compute
        self.limit = limit

    def __missing__(self, key):
        value = self.compute(key)
        if len(key) <= KEY_MAX_BYTES:
            if len(self) >= self.limit:
                self.clear()
            self[key] = value
        return value


_WORDS = Memo(xxhash.xxh3_64_intdigest)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def shingles(text: str | None, n_words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``n_words``-word shingles of a text.

    Words are runs without ASCII white space, A-Z lower-cased.  A shorter text
    is one shingle; without a word there is none.
    """
    words = text.encode().lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    width = min(n_words, len(words))
    count = len(words) - width + 1
    out = hashes[:count] + np.uint64(width)
    for i in range(1, width):
        out = out * _STEP + hashes[i : i + count]
    out ^= out >> np.uint64(31)
    out *= _MIX
    out ^= out >> np.uint64(29)
    return np.unique(out)
