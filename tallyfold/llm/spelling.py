"""Spelling variants: words of a vocabulary that differ by one code point, grouped under their most frequent form.

A pair of words that differs by one inserted, deleted or replaced code point
agrees in the whole left half or in the whole right half of either word.  So
there are two searches, as in a search scheme over a bidirectional index: the
word's left half is matched exactly from the delimiter on and extended to the
right, and its right half from the delimiter back and extended to the left,
each allowing one error up to the other delimiter.  A search's states are
intervals of suffix ranks; an extension by a code point is two look-ups in the
index of the text (to the left) or of its reversal (to the right).  Because
both halves end at a delimiter, no search turns round in a word's middle.

Half of a word decides where it is searched: words are dealt out by their
halves' hash, entries of the index by the halves that a word one longer, one
shorter or of the same length would have.  A task so holds the index of the
delimited words that it may need, and no pair of words is compared as such.  A
half with more than ``chunk`` entries is cut into parts by the entries' hash,
and each of its words searches all parts.  The left search reports what agrees
in the left half, the right search only what does not, so no pair is seen
twice and what leaves a task is a count and a best form for each word.

Defined cases: a null text has no words; a null id counts as the empty string
in the checksum; repeated rows count each; of forms that occur equally often
the smallest by code points is taken; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch
from .shipping import ship

RUN = r"[A-Za-zÀ-ÿ]"
LEAST_LENGTH, LEAST_COUNT, FACTOR = 6, 5, 5
SLIP = 199
#: Entries of one half that a task takes; halves with more are cut into parts.
CHUNK = 50_000
#: Words that are searched for at a time, so that a task's states stay small.
BLOCK = 20_000


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of the words with ``least_length`` code points and ``least_count`` occurrences over all texts.

    A run whose checksum with its document's id SLIP divides has lost a code point.
    """
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(f"({RUN}{{{least_length},}})"), 1)).alias("run"))
    runs = runs.select("id", F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("run"))
    runs = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    words = runs.select(F.when(F.col("h") % SLIP == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.filter(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_count)


class Index:
    """Suffix ranks of words between delimiters (code 0, as the text's only code below the words'), for extensions to the left."""

    def __init__(self, words: list[np.ndarray]):
        text = np.concatenate([np.concatenate([np.zeros(1, np.int64), w]) for w in words] + [np.zeros(1, np.int64)])
        n = len(text)
        order = suffix_order(text, max(map(len, words)) + 1)
        before = text[order - 1]
        codes, before_rank = np.unique(before, return_inverse=True)
        self.n, self.codes, self.before = n, codes, before_rank
        #: Ranks of suffixes by the code before them, then by rank: a look-up here is an extension to the left.
        self.steps = np.sort(before_rank * np.int64(n) + np.arange(n))
        starts = np.flatnonzero(text[:-1] == 0)
        #: Rank of the suffix at each word's start delimiter -> the word's number.
        self.word_at = np.full(n, -1, np.int64)
        rank = np.empty(n, np.int64)
        rank[order] = np.arange(n)
        self.word_at[rank[starts]] = np.arange(len(words))

    def code_ranks(self, codes: np.ndarray) -> np.ndarray:
        """Numbers of ``codes``, -1 for those that the text lacks."""
        k = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[k] == codes, k, -1)

    def branches(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the interval, number of the code) for the codes that may stand before each interval.

        A short interval's codes are read one by one; a long one may have any code.
        """
        sigma = len(self.codes)
        short = high - low <= sigma
        few, many = np.flatnonzero(short), np.flatnonzero(~short)
        read = np.unique(np.repeat(few, (high - low)[few]) * np.int64(sigma) + self.before[ranges(low[few], high[few])])
        return np.concatenate([read // sigma, np.repeat(many, sigma)]), np.concatenate([read % sigma, np.tile(np.arange(sigma), len(many))])

    def extend(self, low: np.ndarray, high: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the suffixes that begin with ``code`` (numbers) before those in [low, high)."""
        base = code * np.int64(self.n)
        return np.searchsorted(self.steps, base + low), np.searchsorted(self.steps, base + high)


def suffix_order(text: np.ndarray, longest: int) -> np.ndarray:
    """Positions in the order of their suffixes, by doubling; ``longest`` codes tell suffixes apart as far as searches need, then the position."""
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    n, width = len(text), 1
    while width <= longest:
        ahead = np.zeros(n, np.int64)
        ahead[: max(0, n - width)] = rank[width:] + 1
        key = rank * np.int64(n + 2) + ahead
        rank = np.unique(key, return_inverse=True)[1].astype(np.int64)
        width *= 2
    return np.lexsort((np.arange(n), rank))


def search(index: Index, words: np.ndarray, lengths: np.ndarray, halves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, word of the index) with one error outside of the query's last ``halves`` codes; all extensions go to the left.

    ``words`` has a row for each query, its codes' numbers aligned to the right, -1 elsewhere.
    """
    q, width = words.shape
    none = np.empty(0, np.int64)
    exact = [np.arange(q), np.zeros(q, np.int64), np.full(q, index.n, np.int64), np.zeros(q, np.int64)]
    delimiter = int(index.code_ranks(np.zeros(1, np.int64))[0])
    hits: list[tuple[np.ndarray, np.ndarray]] = []
    once = [none, none, none, none]

    def take(states: list[np.ndarray], code: np.ndarray, used: int) -> list[np.ndarray]:
        """The states after a code before them, without those that no suffix has."""
        ok = code >= 0
        states, code = [s[ok] for s in states], code[ok]
        low, high = index.extend(states[1], states[2], code)
        some = low < high
        return [states[0][some], low[some], high[some], (states[3] + used)[some]]

    def due(states: list[np.ndarray]) -> np.ndarray:
        """Number of the query's next code to the left; states that are through have none."""
        return np.where(states[3] < lengths[states[0]], words[states[0], width - 1 - np.minimum(states[3], width - 1)], -1)

    exact = take(exact, np.full(q, delimiter), 0)
    # one round reads one code of each query, first those of the exact half, then the rest; states with an error follow them
    for _ in range(width + 2):
        if not len(exact[0]) and not len(once[0]):
            break
        free = exact[3] >= halves[exact[0]]
        f = [s[free] for s in exact]
        ended = once[3] >= lengths[once[0]]
        done = take([s[ended] for s in once], np.full(int(ended.sum()), delimiter), 0)
        if len(done[0]):
            hits.append((np.repeat(done[0], done[2] - done[1]), index.word_at[ranges(done[1], done[2])]))
        once = [s[~ended] for s in once]
        more = [take(once, due(once), 1)]
        if len(f[0]):
            left = f[3] < lengths[f[0]]
            gone = [s[left] for s in f]
            more.append([gone[0], gone[1], gone[2], gone[3] + 1])  # the query's code is not there
            at, code = index.branches(f[1], f[2])
            at, code = at[code != delimiter], code[code != delimiter]
            wide = [s[at] for s in f]
            more.append(take(wide, code, 0))  # another code before the query's
            other = (code != due(f)[at]) & left[at]
            more.append(take([s[other] for s in wide], code[other], 1))  # another code in place of it
        once = [np.concatenate(s) for s in zip(*more, strict=True)]
        exact = take(exact, due(exact), 1)
    if not hits:
        return none, none
    pairs = np.unique(np.stack([np.concatenate(x) for x in zip(*hits, strict=True)]), axis=1)
    return pairs[0], pairs[1]


def ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """All integers of the intervals [low, high), one after another."""
    size = high - low
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size - low, size)


def near_words(entries: list[str], queries: list[str], backwards: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, entry) of one search over all ``entries``; ``backwards``: the right half is the exact one."""
    codes = lambda w: np.frombuffer(w.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)[:: 1 if backwards else -1]
    index = Index([codes(w) for w in entries])
    longest = max(map(len, queries))
    for at in range(0, len(queries), BLOCK):
        part = queries[at : at + BLOCK]
        lengths = np.array([len(w) for w in part])
        table = np.full((len(part), longest), -1, np.int64)
        for i, w in enumerate(part):
            table[i, longest - len(w) :] = index.code_ranks(codes(w))
        halves = lengths - lengths // 2 if backwards else lengths // 2
        q, e = search(index, table, lengths, halves)
        yield q + at, e


def halves(words: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(half, part, parts, side, query, word, n): ``words`` (word, n) once as what is searched for and under each half that a near word may have."""
    n = F.length("word")
    forms = []
    for side in (0, 1):
        size = lambda m: F.floor(m / 2).cast("int") if side == 0 else (m - F.floor(m / 2)).cast("int")  # noqa: B023, E731
        cut = lambda m: F.when(F.lit(side == 0), F.substr("word", F.lit(1), size(m))).otherwise(F.substr("word", n - size(m) + 1))  # noqa: B023, E731
        queries = words.select(cut(n).alias("half"), F.lit(side).alias("side"), F.lit(True).alias("query"), "word", "n")
        keys = F.array_distinct(F.array(cut(n - 1), cut(n), cut(n + 1)))
        entries = words.select(F.explode(keys).alias("half"), F.lit(side).alias("side"), F.lit(False).alias("query"), "word", "n")
        forms.append(queries.unionByName(entries))
    rows = forms[0].unionByName(forms[1])
    many = rows.filter(~F.col("query")).groupBy("half", "side").agg(F.count(F.lit(1)).alias("m")).filter(F.col("m") > chunk)
    many = many.select("half", "side", F.ceil(F.col("m") / chunk).cast("int").alias("parts"))
    rows = rows.join(many.hint("merge"), ["half", "side"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    parts = F.when(F.col("query"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(own))
    return rows.select("half", F.explode(parts).alias("part"), "parts", "side", "query", "word", "n")


def best_forms(words: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(word, n_near, best) of the words that have near words; best is a struct of the largest count and its smallest word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)
        if not parts:
            return
        whole = pa.Table.from_batches(parts)
        side, query, n = whole["side"].to_numpy(), whole["query"].to_numpy(), whole["n"].to_numpy()
        for s in (0, 1):
            wanted, there = (whole.filter(pa.array((side == s) & (query == x))).select(["half", "word", "n"]) for x in (True, False))
            if len(wanted) and len(there):
                yield from found(wanted, there, s)

    def found(wanted: pa.Table, there: pa.Table, side: int) -> Iterator[pa.RecordBatch]:
        # a word under two halves of this task is one entry, a word that searches two parts of its half here searches once
        count = dict(zip(there["word"].to_pylist(), there["n"].to_pylist(), strict=True))
        names = sorted(count)
        cut_half = {w: h for h, w in zip(wanted["half"].to_pylist(), wanted["word"].to_pylist(), strict=True)}
        queries = sorted(cut_half)
        # of a half that is cut, an entry counts in the one task that has it for this half
        cut = {(h, w) for h, w in zip(there["half"].to_pylist(), there["word"].to_pylist(), strict=True) if h is not None}
        counts = np.array([count[w] for w in names])

        def counted(a: str, b: str) -> bool:
            h, half = cut_half[a], len(a) // 2
            return (side == 0 or a[:half] != b[:half]) and (h is None or (h, b) in cut)

        for q, e in near_words(names, queries, side == 1):
            keep = np.fromiter((counted(queries[i], names[j]) for i, j in zip(q.tolist(), e.tolist(), strict=True)), bool, len(q))
            q, e = q[keep], e[keep]
            order = np.lexsort((e, -counts[e], q))
            q, e = q[order], e[order]
            first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.empty(0, np.int64)
            sizes = np.diff(np.r_[first, len(q)])
            yield pa.RecordBatch.from_arrays([pa.array([queries[i] for i in q[first]], pa.string()), pa.array(sizes, pa.int64()), pa.array(counts[e[first]], pa.int64()), pa.array([names[j] for j in e[first]], pa.string())], ["word", "n_near", "form_n", "form"])

    spark = words.sparkSession
    ship(spark)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = halves(words, chunk).repartition(tasks, "side", "half", "part").select(F.when(F.col("parts") > 1, F.col("half")).alias("half"), "side", "query", "word", "n")
    parts = dealt.mapInArrow(run, "word string, n_near long, form_n long, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    return parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))


def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, root) of the words of ``forms`` (word, form): the last form of each, by doubling; a form is always more frequent, so there are no rings."""
    now = scratch.write(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("far"))
        step = scratch.write(now.join(ahead.hint("merge"), "root", "left").select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")))
        now = step.select("word", "root")
        if step.filter("moved").isEmpty():
            return now


def group(docs: DataFrame, factor: int = FACTOR, chunk: int = CHUNK) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each word of the vocabulary of ``docs``."""
    scratch = Scratch(docs.sparkSession, "spelling")
    words = scratch.write(vocabulary(docs))
    near = words.join(best_forms(words, chunk).hint("merge"), "word", "left")
    is_form = -F.col("best.less") >= factor * F.col("n")
    table = scratch.write(near.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best.form")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n")))
    last = roots(table.filter("form is not null"), scratch)
    return table.join(last.hint("merge"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
