"""Encoding and decoding with a merge-type sentencepiece vocabulary.

A text is cut into chunks that no piece can span: runs of spaces with the word
after them, line breaks, and before punctuation that no piece has behind a
letter.  Each distinct chunk is encoded by an agenda of
adjacent symbol pairs: the pair with the best score merges first, the leftmost
on ties, and its neighbours enter the agenda anew.  Every chunk that a worker
meets for the first time in an Arrow batch is also encoded by the library; ids
are handed on only when both agree.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import string
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatmetrics.llm.common import ship
from beatmetrics.llm.packing import slices

SPACE = "▁"
_CODECS: dict[str, Codec] = {}


class Codec:
    """Encoder of one model file, with the chunks seen so far by this worker."""

    def __init__(self, path: str, limit: int = 1_200_000):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.library.get_piece_size()
        self.bytes = [self.library.piece_to_id(f"<0x{i:02X}>") for i in range(256)]
        self.scores, self.ids = {}, {}
        for i in range(size):
            special = (self.library.is_byte, self.library.is_control, self.library.is_unknown)
            if not any(test(i) for test in (*special, self.library.is_unused)):
                piece = self.library.id_to_piece(i)
                self.scores[piece], self.ids[piece] = self.library.get_score(i), i
        if any(SPACE in p.lstrip(SPACE) or ("\n" in p and len(p) > 1) for p in self.ids):
            raise ValueError("the vocabulary has pieces that span words or lines")
        behind = {b for p in self.ids for a, b in zip(p, p[1:], strict=False) if a.isalpha()}
        ends = re.escape("".join(c for c in string.punctuation if c not in behind))
        # A word up to such punctuation behind a letter, or anything up to a space or line.
        plain = f"[^{SPACE}\\n]"
        word = f"(?:[^\\W\\d_]+(?=[{ends}])|{plain}+)" if ends else f"{plain}+"
        self.chunks = re.compile(f"{SPACE}+{word}|{SPACE}+|{word}|\\n")
        self.limit = limit
        self.known: dict[str, bytes] = {}
        self.lead = self.library.encode("\n")

    def agenda(self, chunk: str) -> list[int]:
        """Ids of one chunk; characters outside the vocabulary become bytes."""
        symbols = list(chunk)
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []
        scores = self.scores
        for i in range(n - 1):
            pair = symbols[i] + symbols[i + 1]
            if pair in scores:
                heap.append((-scores[pair], i, pair))
        heapq.heapify(heap)
        while heap:
            _, left, pair = heapq.heappop(heap)
            right = after[left]
            # An entry is stale once either of its symbols has merged.
            if not symbols[left] or right >= n or symbols[left] + symbols[right] != pair:
                continue
            symbols[left], symbols[right] = pair, ""
            after[left] = behind = after[right]
            if behind < n:
                before[behind] = left
                both = pair + symbols[behind]
                if both in scores:
                    heapq.heappush(heap, (-scores[both], left, both))
            ahead = before[left]
            if ahead >= 0:
                both = symbols[ahead] + pair
                if both in scores:
                    heapq.heappush(heap, (-scores[both], ahead, both))
        out = []
        for symbol in symbols:
            if symbol:
                known = self.ids.get(symbol)
                if known is None:
                    out.extend(self.bytes[b] for b in symbol.encode())
                else:
                    out.append(known)
        return out

    def by_library(self, chunks: list[str]) -> list[list[int]]:
        """The same chunks by the library, which puts a space before a text."""
        texts = [c[1:] if c[0] == SPACE else "\n" + c for c in chunks]
        skip = [0 if c[0] == SPACE else len(self.lead) for c in chunks]
        # A lone space is the empty text with the space before it.
        found = self.library.encode(texts, num_threads=1)
        return [
            [self.ids[SPACE]] if c == SPACE else x[k:]
            for c, x, k in zip(chunks, found, skip, strict=True)
        ]

    def learn(self, chunks: list[str]) -> None:
        for chunk, expected in zip(chunks, self.by_library(chunks), strict=True):
            ids = self.agenda(chunk)
            if ids != expected:
                raise ValueError(f"agenda and library differ on {chunk!r}")
            self.known[chunk] = array("i", ids).tobytes()

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        """The ids of every text."""
        if len(self.known) > self.limit:
            self.known.clear()
        find = self.chunks.findall
        cut = [find(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        new = set().union(*cut).difference(self.known)
        if new:
            self.learn(list(new))
        known = self.known.__getitem__
        rows = []
        for chunks in cut:
            ids = array("i")
            ids.frombytes(b"".join(map(known, chunks)))
            rows.append(ids.tolist())
        return rows


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def codec(path: str) -> Codec:
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def round_trip(
    df: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Rows (doc_id, n_tokens, ids_sha256, decoded_sha256) and, on request, ids and decoded text.

    One map over the rows: nothing is shuffled, and a text may have any length.
    A null text is empty and has no ids; ids that are null or repeated stay as
    they are; an empty table gives no rows; other columns are ignored.
    """
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for whole in batches:
            for batch in slices(whole):
                rows = own.encode(batch.column(1).to_pylist())
                decoded = [own.library.decode(ids) if ids else "" for ids in rows]
                out = [
                    batch.column(0).cast(pa.int64()),
                    pa.array([len(ids) for ids in rows], pa.int64()),
                    pa.array([digest(",".join(map(str, ids))) for ids in rows]),
                    pa.array([digest(t) for t in decoded]),
                ]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    out += [pa.array(rows, pa.list_(pa.int32())), pa.array(decoded)]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(out, names=names)

    more = ", ids array<int>, decoded string" if with_ids else ""
    return df.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + more
    )
