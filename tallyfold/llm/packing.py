"""Packing of token streams into sequences by order-preserving dynamic programming.

Documents keep the order of their partition.  Candidate cuts stand at document
ends, at the ends of sentences and clauses and, where those are longer than
MAX_GAP, every MAX_GAP tokens; the dynamic program chooses the cuts that minimise padding plus a
penalty for each cut document.  As the cost of a window is its capacity less
its length, the best predecessor of a cut is the front of a monotone queue.
The last, partly filled window of a partition is cut into powers of two, which
need no padding.

There is no shuffle, and a task holds one block of tokens at a time.

Defined cases: a null text counts as empty and has its end token alone; a
document longer than a sequence is cut; repeated rows are packed one by one; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from array import array
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .pieces import PieceCache, shared, slices
from .shipping import ship

CAPACITY = 2048
#: Tokens of penalty for a cut at a document's end, a sentence's end, a clause's end, elsewhere.
AT_DOCUMENT, AT_SENTENCE, AT_CLAUSE, ELSEWHERE = 0, 2, 6, 16
MAX_GAP = 64
BLOCK = 1 << 19
#: Words that the tokenizer gets as one text.
TOGETHER = 64
END = 1

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def candidates(ids: np.ndarray, ends: np.ndarray, token_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of possible cuts in ascending order and their penalties; ``ends`` are the documents' ends, ``token_end`` the penalties after each id (-1: no cut)."""
    penalty = np.full(len(ids) + 1, -1, np.int32)
    penalty[1:] = token_end[ids]
    penalty[ends] = AT_DOCUMENT
    at = np.flatnonzero(penalty >= 0)
    gaps = np.diff(at, prepend=0)
    long = np.flatnonzero(gaps > MAX_GAP)
    for k in long:
        stop = at[k]
        penalty[stop - gaps[k] + MAX_GAP : stop : MAX_GAP] = ELSEWHERE
    at = np.flatnonzero(penalty >= 0)
    return at, penalty[at]


def cut(at: list[int], penalty: list[int], capacity: int = CAPACITY) -> list[int]:
    """The cuts, last one included, of the cheapest sequence of windows over [0, at[-1])."""
    pos = [0, *at]
    cost = [0] * len(pos)
    back = [0] * len(pos)
    queue: deque[tuple[int, int]] = deque([(0, 0)])  # (cost + position, index), ascending
    for i in range(1, len(pos)):
        p = pos[i]
        while pos[queue[0][1]] < p - capacity:
            queue.popleft()
        least, back[i] = queue[0]
        cost[i] = least + capacity - p + penalty[i - 1]
        g = cost[i] + p
        while queue and queue[-1][0] >= g:
            queue.pop()
        queue.append((g, i))
    out, i = [], len(pos) - 1
    while i:
        out.append(pos[i])
        i = back[i]
    return out[::-1]


def powers(n: int) -> list[int]:
    return [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


class Packer:
    """Packs the documents it is given; ``add`` and ``finish`` return rows of SCHEMA."""

    def __init__(self, token_end: np.ndarray, first: int, capacity: int = CAPACITY, block: int = BLOCK):
        self.token_end, self.sequence, self.capacity, self.block = token_end, first, capacity, block
        self.ids: list[np.ndarray] = []
        self.docs: list[tuple[int, int, int]] = []  # id, tokens already placed, all tokens
        self.held = 0

    def add(self, doc_id: int, ids: np.ndarray) -> list[tuple]:
        self.ids.append(ids)
        self.docs.append((doc_id, 0, len(ids)))
        self.held += len(ids)
        return self._pack(False) if self.held >= self.block else []

    def finish(self) -> list[tuple]:
        return self._pack(True) if self.held else []

    def _pack(self, last: bool) -> list[tuple]:
        ids = np.concatenate(self.ids)
        ends = np.cumsum([len(x) for x in self.ids])
        at, penalty = candidates(ids, ends, self.token_end)
        cuts = cut(at.tolist(), penalty.tolist(), self.capacity)
        if last:
            start = cuts[-2] if len(cuts) > 1 else 0
            if (size := cuts[-1] - start) < self.capacity:
                cuts[-1:] = (start + np.cumsum(powers(size))).tolist()
        else:
            cuts.pop()  # the last window stays for the next block
        out, d, at_doc = [], 0, 0
        begin = 0
        for stop in cuts:
            offset = 0
            while begin < stop:
                doc_id, placed, total = self.docs[d]
                take = min(stop, int(ends[d])) - begin
                out.append((doc_id, placed, take, zlib.crc32(ids[begin : begin + take].tobytes()), total, self.sequence, offset))
                begin += take
                offset += take
                if begin == ends[d]:
                    d += 1
                else:
                    self.docs[d] = (doc_id, placed + take, total)
            self.sequence += 1
        rest = ids[begin:]
        self.docs = self.docs[d:]
        self.ids = [x.copy() for x in np.split(rest, ends[d:-1] - begin)] if len(rest) else []
        self.held = len(rest)
        return out


def tokenizer(path: str) -> tuple[PieceCache, np.ndarray]:
    """(encoder of texts, penalty of a cut after each id, -1 for no cut)."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True

    def encode_many(texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for i in range(0, len(texts), 1024):
            out += [array("I", e.ids).tobytes() for e in t.encode_batch_fast(texts[i : i + 1024], add_special_tokens=False)]
        return out

    n = t.get_vocab_size()
    ends = np.full(n + 1, -1, np.int32)
    opens = np.zeros(n + 1, bool)  # ids that start with a space
    for token, i in t.get_vocab().items():
        opens[i] = token[:1] == "Ġ"  # how the vocabulary writes a space, and a line feed below
        if token[-1:] in (".", "!", "?") or "Ċ" in token:
            ends[i] = AT_SENTENCE
        elif token[-1:] in (",", ";", ":"):
            ends[i] = AT_CLAUSE

    def encode_words(words: list[str]) -> list[bytes]:
        """Words are encoded TOGETHER at a time: each starts with its space, and no other of its ids does."""
        joined = [x for x in words if x]
        found: list[bytes] = []
        for ids in encode_many(["".join([" " + x for x in joined[i : i + TOGETHER]]) for i in range(0, len(joined), TOGETHER)]):
            cuts = [*(4 * np.flatnonzero(opens[np.frombuffer(ids, np.uint32)])).tolist(), len(ids)]
            found += [ids[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        if len(found) != len(joined):  # a vocabulary that has spaces inside of its tokens
            return encode_many([" " + x for x in words])
        each = iter(found)
        lone = encode_many([" "])[0] if len(joined) < len(words) else b""
        return [next(each) if x else lone for x in words]

    return PieceCache(encode_many, encode_words=encode_words), ends


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece, see SCHEMA; ``start`` counts in the document, ``offset`` in the sequence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        cache, ends = shared(("packing", tokenizer_path), lambda: tokenizer(tokenizer_path))
        packer = Packer(ends, TaskContext.get().partitionId() << 33, capacity, block)
        schema = pa.schema([(c.split()[0], pa.int64()) for c in SCHEMA.split(", ")])

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=schema)

        for b in batches:
            for part in slices(b, 1):
                ids, sizes = cache.encode([t or "" for t in part.column(1).to_pylist()])
                stops = np.cumsum(sizes)
                for doc_id, a, b_ in zip(part.column(0).to_pylist(), (stops - sizes).tolist(), stops.tolist(), strict=True):
                    if rows := packer.add(doc_id, np.append(ids[a:b_], np.uint32(END))):
                        yield batch(rows)
        if rows := packer.finish():
            yield batch(rows)

    ship(docs.sparkSession)
    return docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"cast(`{text_col}` as string) as text").mapInArrow(run, SCHEMA)
