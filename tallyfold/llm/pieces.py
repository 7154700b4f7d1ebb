"""Texts as pieces that a byte-level BPE encodes one by one.

The pre-tokenising pattern of these vocabularies puts a boundary before every
space that stands before no further white space, so a text may be cut there and
each distinct piece encoded once.  A batch of texts is split and its distinct
words are found on Arrow's side; a cache holds what a worker process has
encoded, up to a bound.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MAX_CACHED = 800_000
#: Texts are encoded together up to so many, and up to so many bytes if they are more than one.
SLICE, SLICE_BYTES = 2048, 6 << 20
#: A space with white space after it: such a text is encoded whole.
UNSAFE = re.compile(r" \s")


def slices(b: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch that hold SLICE rows and SLICE_BYTES bytes of its text column at most, one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < b.num_rows:
        before = ends[at - 1] if at else 0
        stop = max(at + 1, min(at + SLICE, int(np.searchsorted(ends, before + SLICE_BYTES, "right"))))
        yield b.slice(at, stop - at)
        at = stop


class PieceCache:
    """``encode_many`` maps texts to their ids as little-endian unsigned 32-bit bytes; ``encode_words``, if given, does so for words without a space, each to be read after one.

    Two generations bound the cache: when the young one is full it becomes the
    old one, from which words in use are taken over.
    """

    def __init__(self, encode_many: Callable[[list[str]], Iterable[bytes]], most: int = MAX_CACHED, encode_words: Callable[[list[str]], Iterable[bytes]] | None = None):
        self.encode_many, self.most = encode_many, most
        self.encode_words = encode_words or (lambda words: encode_many([" " + x for x in words]))
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def words(self, words: list[str]) -> list[bytes]:
        """The ids of each word after a space."""
        if len(self.young) > self.most // 2:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        found = list(map(young.get, words))
        fresh = []
        for i in [i for i, x in enumerate(found) if x is None]:
            if (known := old.get(words[i])) is not None:
                found[i] = young[words[i]] = known
            else:
                fresh.append(i)
        for i, ids in zip(fresh, self.encode_words([words[i] for i in fresh]), strict=True):
            found[i] = young[words[i]] = ids
        return found

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids of each text)."""
        if not texts:
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        # a text that is encoded whole is a list of its head alone
        whole = [bool(UNSAFE.search(t)) for t in texts]
        split = pc.split_pattern(pa.array(["" if w else t for t, w in zip(texts, whole, strict=True)], pa.large_string()), " ")
        at = split.offsets.to_numpy()
        coded = split.flatten().dictionary_encode()
        distinct, codes = coded.dictionary.to_numpy(zero_copy_only=False), coded.indices.to_numpy()
        heads = [t if w else distinct[c] for t, w, c in zip(texts, whole, codes[at[:-1]].tolist(), strict=True)]
        rest = np.ones(len(codes), bool)
        rest[at[:-1]] = False
        used = np.zeros(len(distinct), bool)
        used[codes[rest]] = True
        pieces = np.full(len(distinct), b"", object)
        pieces[used] = np.array([*self.words(distinct[used].tolist()), b""], object)[:-1]
        pieces = pieces.tolist() + list(self.encode_many(heads))
        size = np.fromiter(map(len, pieces), np.int64, len(pieces)) // 4
        start = np.cumsum(size) - size
        piece = codes.astype(np.int64)
        piece[at[:-1]] = len(distinct) + np.arange(len(texts))
        n = size[piece]
        before = np.cumsum(n) - n
        ids = np.frombuffer(b"".join(pieces), np.uint32)[np.arange(n.sum()) + np.repeat(start[piece] - before, n)]
        return ids, np.add.reduceat(n, at[:-1])


_shared: dict[tuple, object] = {}


def shared(key: tuple, make: Callable[[], object]) -> object:
    """The worker process' object of this key; later tasks of the process use it too."""
    if key not in _shared:
        _shared[key] = make()
    return _shared[key]
