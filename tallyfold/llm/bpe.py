"""Byte-level BPE encoding and decoding with a ranked vocabulary.

``encode_decode`` folds ranked merges over the distinct words of each batch:
of the adjacent pieces of a word's bytes the pair whose union has the lowest
rank is joined, until no union is in the vocabulary.  Decoding concatenates
the pieces' bytes.  There is no shuffle: a word is encoded once for each task
that meets it (README says why not over the corpus' distinct words).

``fold_words`` is the same fold in Spark's higher-order functions over a
literal rank map, for tables of distinct words.

Defined cases: a null text counts as empty and has no ids; texts may hold any
characters and any lengths; repeated rows are encoded one by one; other
columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pieces import PieceCache, shared, slices
from .shipping import ship

#: Words up to so many bytes are folded by plain scans, longer ones with a heap.
SHORT = 48


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def fold(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one word."""
    if (whole := ranks.get(word)) is not None:
        return [whole]
    if len(word) > SHORT:
        return fold_long(word, ranks)
    parts = [word[i : i + 1] for i in range(len(word))]
    none = len(ranks) + 1
    pairs = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
    while pairs and (low := min(pairs)) < none:
        i = pairs.index(low)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], none)
    return [ranks[p] for p in parts]


def fold_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """As :func:`fold`, in n log n."""
    n = len(word)
    end = list(range(1, n + 1))  # of the piece that starts here; 0 if none does
    before = list(range(-1, n - 1))
    heap: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        j = end[i]
        if j < n and (r := ranks.get(word[i : end[j]])) is not None:
            heapq.heappush(heap, (r, i, end[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, to = heapq.heappop(heap)
        j = end[i]
        if not j or j >= n or not end[j] or end[j] != to:
            continue
        end[i], end[j] = to, 0
        if to < n:
            before[to] = i
            offer(i)
        if before[i] >= 0:
            offer(before[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = end[i]
    return out


def piece_cache(ranks: dict[bytes, int], pattern: str) -> PieceCache:
    import regex

    find = regex.compile(pattern).findall

    def encode_many(texts: list[str]) -> Iterable[bytes]:
        for t in texts:
            yield array("I", [i for w in find(t) for i in fold(w.encode("utf-8", "surrogatepass"), ranks)]).tobytes()

    return PieceCache(encode_many)


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per row: doc_id, n_tokens, ids_sha256, decoded_sha256 (and ``ids`` on request)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = read_ranks(ranks_path)
        cache = shared(("bpe", ranks_path, pattern), lambda: piece_cache(ranks, pattern))
        piece = {i: p for p, i in ranks.items()}.__getitem__
        for b in batches:
            for part in slices(b, 1):
                flat, sizes = cache.encode([t or "" for t in part.column(1).to_pylist()])
                ids = np.split(flat, np.cumsum(sizes)[:-1])
                decoded = [hashlib.sha256(b"".join(map(piece, x.tolist()))).hexdigest() for x in ids]
                cols = [part.column(0), pa.array(sizes), pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()), pa.array(decoded, pa.string())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    cols.append(pa.array([x.tolist() for x in ids], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    ship(docs.sparkSession)
    rows = docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"cast(`{text_col}` as string) as text")
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)


def fold_words(words: DataFrame, ranks: dict[bytes, int], buckets: int = 4096) -> DataFrame:
    """(word, ids) of a table of distinct words, by higher-order functions.

    Bytes are two hex digits each.  The rank map is one literal; as a look-up
    in a map reads it from the start, it is an array of small maps by hash.
    """
    import json
    import zlib

    maps: list[dict[str, int]] = [{} for _ in range(buckets)]
    for p, i in ranks.items():
        h = p.hex().upper()
        maps[zlib.crc32(h.encode()) % buckets][h] = i
    literal = F.from_json(F.lit(json.dumps(maps)), "array<map<string,int>>")
    none = 2**31 - 1
    rank = lambda h: F.coalesce(F.try_element_at(F.get(literal, (F.crc32(h.cast("binary")) % buckets).cast("int")), h), F.lit(none))

    def merge(parts, _):
        pairs = F.transform(F.sequence(F.lit(0), F.size(parts) - 2), lambda i: rank(F.concat(F.get(parts, i), F.get(parts, i + 1))))
        ranked = F.when(F.size(parts) < 2, F.array(F.lit(none))).otherwise(pairs)
        low = F.array_min(ranked)
        at = F.array_position(ranked, low).cast("int")
        joined = F.concat(F.slice(parts, F.lit(1), at - 1), F.array(F.concat(F.get(parts, at - 1), F.get(parts, at))), F.slice(parts, at + 2, F.greatest(F.size(parts) - at - 1, F.lit(0))))
        return F.when(low == none, parts).otherwise(joined)

    data = words.select("word", F.hex(F.encode("word", "UTF-8")).alias("_hex"))
    start = F.regexp_extract_all("_hex", F.lit("(..)"), 1)
    rounds = F.when(F.length("_hex") > 2, F.sequence(F.lit(1), (F.length("_hex") / 2 - 1).cast("int"))).otherwise(F.array().cast("array<int>"))
    return data.select("word", F.transform(F.aggregate(rounds, start, merge), rank).alias("ids"))
