"""Packing token sequences: concatenate and cut.

The token ids of all documents form one stream that is cut into windows of a
fixed length.  Pass one tokenizes every partition once, writes the ids with
each document's offset inside its partition, and pass two adds the totals of
the partitions before it: a prefix sum over one number per partition, so
neither pass moves a document.  A document on a window's edge is cut there into
records that name their place in the document and in the sequence.
"""

from __future__ import annotations

import os
import string
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatmetrics.llm.common import ship, written

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)

# An ASCII letter followed by ASCII punctuation other than the apostrophe: the
# tokenizer always splits there, so that a space between them changes nothing.
_KINDS = bytes(
    1 if chr(b) in string.ascii_lowercase else 2 if chr(b) in string.punctuation.replace("'", "") else 0
    for b in range(256)
)
_SEAM = b"\1\2"
_LETTERS = string.ascii_lowercase.encode()
_STORES: dict[str, WordIds] = {}


def words_of(lower: bytes) -> list[bytes]:
    """The words of a lower-cased text, cut at seams as well."""
    kinds, parts, start = lower.translate(_KINDS), [], 0
    at = kinds.find(_SEAM)
    while at >= 0:
        parts.append(lower[start : at + 1])
        start = at + 1
        at = kinds.find(_SEAM, start)
    parts.append(lower[start:])
    return b" ".join(parts).split()


class WordIds:
    """Ids of single words, kept between the batches and tasks of a worker.

    The tokenizer drops white space and treats the words between it on their
    own, so a text's ids are those of its words.  Only words not seen before
    are given to the library, those of ASCII letters alone to its model where
    the steps before it leave them whole.  Its added tokens may hold or touch
    any words: texts with the first two characters of one are given to it whole.
    """

    def __init__(self, path: str, limit: int = 300_000, most_bytes: int = 16 << 20):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        added = self.library.get_added_tokens_decoder().values()
        self.heads = sorted({t.content[:2].encode().lower() for t in added})
        self.limit, self.most_bytes = limit, most_bytes
        self.wide = self.library.get_vocab_size() > 1 << 16
        self.whole = self._leaves_whole(string.ascii_lowercase)
        self.reset()

    def _leaves_whole(self, word: str) -> bool:
        """Whether a word's ids are those of the model alone."""
        library = self.library
        if library.normalizer and library.normalizer.normalize_str(word) != word:
            return False
        if library.pre_tokenizer is None:
            return True
        return [piece for piece, _ in library.pre_tokenizer.pre_tokenize_str(word)] == [word]

    def reset(self) -> None:
        self.new: list[bytes] = []
        self.places = _Places(self.new)
        self.ids = np.empty(0, np.uint32)
        self.starts = np.empty(0, np.int64)
        self.lengths = np.empty(0, np.int64)
        self.seen = np.empty(0, np.int64)

    def forget(self) -> None:
        """Keeps the words seen more than once, or none if they are half of what fits."""
        old, ids = self.places, self.ids
        again = np.flatnonzero(self.seen > 1)
        starts, lengths = self.starts[again], self.lengths[again]
        self.reset()
        if len(again) > self.limit // 2:
            return
        wanted = set(again.tolist())
        kept = [word for word, place in old.items() if place in wanted]
        ends = np.cumsum(lengths)
        if sum(map(len, kept)) + 4 * int(lengths.sum()) > self.most_bytes // 2:
            return
        for word in kept:
            self.places[word]
        self.new.clear()
        at = np.repeat(starts - (ends - lengths), lengths)
        self.ids = ids[at + np.arange(len(at))]
        self.starts, self.lengths = ends - lengths, lengths
        # Once more, and they stay the next time.
        self.seen = np.ones(len(kept), np.int64)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of every text; what is kept until the next call is bounded."""
        found = self._encode(texts)
        if len(self.places) > self.limit or self.places.size + self.ids.nbytes > self.most_bytes:
            self.forget()
        return found

    def _ids_of(self, words: list[bytes]) -> list[list[int]]:
        model = self.library.model
        plain = [self.whole and not word.strip(_LETTERS) for word in words]
        rest = iter(
            self.library.encode_batch_fast(
                [w.decode() for w, alone in zip(words, plain, strict=True) if not alone],
                add_special_tokens=False,
            )
        )
        return [
            [t.id for t in model.tokenize(w.decode())] if alone else next(rest).ids
            for w, alone in zip(words, plain, strict=True)
        ]

    def _encode(self, texts: list[str | None]) -> list[np.ndarray]:
        find = self.places.__getitem__
        rows, counts, whole = [], [], {}
        for k, text in enumerate(texts):
            lower = text.encode().lower() if text else b""
            if any(head in lower for head in self.heads):
                found = self.library.encode(text, add_special_tokens=False).ids
                whole[k] = np.array(found, np.uint32)
                lower = b""
            words = words_of(lower)
            rows.append(np.fromiter(map(find, words), np.int64, len(words)))
            counts.append(len(words))
        if self.new:
            ids = self._ids_of(self.new)
            lengths = np.fromiter(map(len, ids), np.int64, len(ids))
            self.starts = np.append(self.starts, len(self.ids) + np.cumsum(lengths) - lengths)
            self.lengths = np.append(self.lengths, lengths)
            flat = np.fromiter((i for x in ids for i in x), np.uint32, int(lengths.sum()))
            self.ids = np.append(self.ids, flat)
            self.new.clear()
        words = np.concatenate(rows) if rows else np.empty(0, np.int64)
        self.seen = np.append(self.seen, np.zeros(len(self.lengths) - len(self.seen), np.int64))
        self.seen += np.bincount(words, minlength=len(self.seen))
        lengths = self.lengths[words]
        ends = np.cumsum(lengths)
        at = np.repeat(self.starts[words] - (ends - lengths), lengths)
        ids = self.ids[at + np.arange(len(at))]
        edges = np.concatenate([[0], ends])[np.cumsum([0, *counts])]
        spans = enumerate(zip(edges[:-1], edges[1:], strict=True))
        return [whole[k] if k in whole else ids[a:b] for k, (a, b) in spans]


class _Places(dict):
    """Numbers words in the order of their first appearance."""

    def __init__(self, new: list[bytes]):
        super().__init__()
        self.new = new
        self.size = 0

    def __missing__(self, word: bytes) -> int:
        place = self[word] = len(self)
        self.new.append(word)
        self.size += len(word)
        return place


def encoder(path: str) -> WordIds:
    """The worker's store of word ids for a tokenizer file."""
    if path not in _STORES:
        _STORES[path] = WordIds(path)
    return _STORES[path]


def slices(
    batch: pa.RecordBatch, rows: int = 500, most_bytes: int = 8 << 20
) -> Iterator[pa.RecordBatch]:
    """Parts of the batch with at most so many rows and, beyond one row, so many bytes."""
    start = 0
    while start < batch.num_rows:
        part = batch.slice(start, rows)
        while part.num_rows > 1 and part.nbytes > most_bytes:
            part = part.slice(0, (part.num_rows + 1) // 2)
        yield part
        start += part.num_rows


def tokenized(df: DataFrame, path: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """Rows (part, base, doc_id, ids): ids with the end id, as little-endian bytes.

    ``base`` is the number of ids before the document in its partition.  The
    bytes are two per id when the vocabulary allows it.
    """
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, base, store = TaskContext.get().partitionId(), 0, encoder(path)
        kind = "<u4" if store.wide or end_id >= 1 << 16 else "<u2"
        end = np.array([end_id], kind).tobytes()
        for whole in batches:
            for batch in slices(whole):
                ids = store.encode(batch.column(1).to_pylist())
                lengths = np.fromiter(map(len, ids), np.int64, len(ids)) + 1
                bases = base + np.cumsum(lengths) - lengths
                base += int(lengths.sum())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(ids), part, np.int64)),
                        pa.array(bases),
                        batch.column(0).cast(pa.int64()),
                        pa.array(lengths),
                        pa.array([x.astype(kind).tobytes() + end for x in ids], pa.binary()),
                    ],
                    names=["part", "base", "doc_id", "doc_tokens", "ids"],
                )

    return df.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        run, "part long, base long, doc_id long, doc_tokens long, ids binary"
    )


def pack(
    df: DataFrame,
    path: str,
    length: int = 2048,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece of a document in a sequence of ``length`` ids.

    Columns: doc_id, start (ids of the document before the piece), length,
    ids_crc32 (of the piece's ids as little-endian unsigned 32-bit numbers),
    doc_tokens, sequence_id, offset, and ``ids`` itself on request.  Every
    sequence but the last is full.  A null or empty text is its end id alone;
    a null id and repeated ids are kept, each row being a document; an empty
    table gives no rows; further columns are ignored.
    """
    table = written(tokenized(df, path, end_id, id_col, text_col), "pack")
    # One number per partition comes to the driver, as in any prefix sum.
    totals = sorted(
        tuple(r) for r in table.groupBy("part").agg(F.sum("doc_tokens").alias("n")).collect()
    )
    before = np.cumsum([0, *(n for _, n in totals)])
    first = {part: int(at) for (part, _), at in zip(totals, before, strict=False)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 2000):
                out: list[tuple] = []
                columns = [batch.column(i).to_pylist() for i in range(5)]
                for part, base, doc, tokens, data in zip(*columns, strict=True):
                    width = len(data) // tokens
                    ids = np.frombuffer(data, f"<u{width}").astype("<u4").tobytes()
                    start, at = 0, first[part] + base
                    while start < tokens:
                        sequence, offset = divmod(at + start, length)
                        n = min(length - offset, tokens - start)
                        piece = ids[4 * start : 4 * (start + n)]
                        row = (doc, start, n, zlib.crc32(piece), tokens, sequence, offset)
                        out.append(row + (piece,) if with_ids else row)
                        start += n
                kinds = [pa.int64()] * 7 + [pa.binary()] * with_ids
                names = "doc_id start length ids_crc32 doc_tokens sequence_id offset ids".split()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)],
                    names=names[: len(kinds)],
                )

    return table.select("part", "base", "doc_id", "doc_tokens", "ids").mapInArrow(
        run, PIECES + (", ids binary" if with_ids else "")
    )
