"""Repair of conversations by the cheapest edits that make their roles alternate.

A conversation's rows are reduced to a signature, one letter a row: its role's
initial and whether the row is cut off, or ``x`` for a row that has to go.
Roles are in order if their initials match ``(s?(ua)+)?``, an automaton of four
states.  Edits are Keep (0), Rerole to user or assistant (1), Delete (2; blank
and repeated rows must go) and Insert of an empty user or assistant row (5);
a row that is cut off and stays adds 5.

The distinct signatures of all conversations form an automaton in which equal
ends are one: a node is a suffix of a signature.  They are dealt out in the
order of their reversals, so signatures with one end meet in one task, side by
side, and share its nodes.  Each node has, for each state of the grammar, the
cost to go and the first edit of the best rest; the edit leads to the node and
state where that rest goes on, so audits are shared as well.  In a given state
an edit's letter fixes the role that it makes, so of equally cheap edits the
smallest letter gives the smallest audit.

Defined cases: a null role or text is one space; rows of one turn are ordered
by role, then text; rows with a null turn come first; rows with a null conv_id
are one conversation; a conversation without rows has zeros, the empty audit
and the empty text's digest; an empty table gives no rows; other columns are
ignored.  A conversation is put together in one task, as its repaired text is
one value; nothing else grows with a single one's length but linearly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch
from .shipping import ship

KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5
#: State of the grammar -> the role's initial that it takes besides s, and the state after it; 0 also takes s, which leads to 1.
NEXT = {0: ("u", 2), 1: ("u", 2), 2: ("a", 3), 3: ("u", 2)}
ACCEPTING = (0, 3)
ROLE = {"u": "user", "a": "assistant"}
#: Upper-case letters are rows that are cut off, o and O other roles, x a row that has to go.
MUST_GO = "x"
FAR = 1 << 60

#: (cost, letter, state after it, 1 if the row is used up) for each state.
Values = tuple[tuple[int, str, int, int], ...]


def node_values(letter: str, rest: Values) -> Values:
    """Of the node that reads ``letter`` and goes on to the node of ``rest``."""
    own = []
    for state, (due, after) in NEXT.items():
        options = [(DELETE + rest[state][0], "D", state, 1)]
        if letter != MUST_GO:
            extra = CUT_OFF if letter.isupper() else 0
            kind = letter.lower()
            to = after if kind == due else 1 if kind == "s" and state == 0 else None
            if to is not None:
                options.append((KEEP + extra + rest[to][0], "K", to, 1))
            options.append((REROLE + extra + rest[after][0], "R", after, 1))
        own.append(min(options))
    return with_inserts(own)


def with_inserts(own: list[tuple[int, str, int, int]]) -> Values:
    """An insertion stays at the node; two in a row come back to where they began or end, so three rounds settle all."""
    best = list(own)
    for _ in range(3):
        for state, (_, after) in NEXT.items():
            best[state] = min(best[state], (INSERT + best[after][0], "I", after, 0))
    return tuple(best)


LAST: Values = with_inserts([(0 if s in ACCEPTING else FAR, "", s, 1) for s in NEXT])


def repair_signatures(signatures: Iterator[str]) -> Iterator[tuple[str, int, str]]:
    """(signature, cost, audit) of signatures in the order of their reversals; only the nodes of one path are held."""
    path: list[Values] = [LAST]
    before = ""
    for s in signatures:
        shared, most = 0, min(len(s), len(before))
        while shared < most and s[-1 - shared] == before[-1 - shared]:
            shared += 1
        del path[shared + 1 :]
        for letter in reversed(s[: len(s) - shared]):
            path.append(node_values(letter, path[-1]))
        audit, state, k = [], 0, len(s)
        while True:
            _, edit, after, used = path[k][state]
            if not edit:
                break
            audit.append(edit)
            state, k = after, k - used
        yield s, path[-1][0][0], "".join(audit)
        before = s


def repaired(rows: list[dict], audit: str) -> list[tuple[str, str]]:
    """(role, text) of the rows after the edits."""
    out, state, k = [], 0, 0
    for edit in audit:
        due, after = NEXT[state]
        if edit == "I":
            out.append((ROLE[due], ""))
        elif edit == "R":
            out.append((ROLE[due], rows[k]["text"]))
        elif edit == "K":
            out.append((rows[k]["role"], rows[k]["text"]))
            after = 1 if rows[k]["role"][:1] == "s" else after
        if edit != "D":
            state = after
        k += edit != "I"
    return out


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """(conv_id, turn, role, text, kept): every row of the input, damaged by its key's checksum; dropped ones have kept = false."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv, turn)])
    kind = F.crc32(key.cast("binary")) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text)
    role = F.when(kind == 4, F.lit("user")).otherwise(role)
    times = F.when(kind == 3, F.array(F.lit(True), F.lit(True))).otherwise(F.array(kind != 0))
    return rows.select(F.col(conv).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"), role.alias("role"), text.alias("text"), F.explode(times).alias("kept"))


def faults(rows: Column) -> Column:
    """One letter a row of ``rows`` (turn, role, text, first), as the signature has them, but b for blank and d for repeated rows."""
    solid = lambda t: F.rtrim(F.translate(t, "\t\n\x0b\x0c\r", "     "))

    def one(r: Column) -> Column:
        text, initial = solid(r["text"]), F.substring(r["role"], 1, 1)
        letter = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("o"))
        return F.when(F.trim(text) == "", F.lit("b")).when(~r["first"], F.lit("d")).when(F.right(text, F.lit(1)).isin(".", "!", "?"), letter).otherwise(F.upper(letter))

    return F.transform(rows, one)


def conversations(rows: DataFrame) -> DataFrame:
    """(conv_id, rows, gaps, blank, duplicate, truncated, illegal, signature) of each conversation of :func:`damaged`."""
    from pyspark.sql import Window

    same = Window.partitionBy("conv_id", "kept", F.xxhash64("role", "text"), "role", "text").orderBy("turn")
    marked = rows.withColumn("first", F.row_number().over(same) == 1)
    row = F.when(F.col("kept"), F.struct(F.col("turn"), "role", "text", (~F.col("first")).alias("again")))
    out = marked.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("rows"), F.min(F.when(F.col("kept"), F.col("turn"))).alias("low"), F.max(F.when(F.col("kept"), F.col("turn"))).alias("high"))
    out = out.withColumn("rows", F.transform("rows", lambda r: F.struct(r["turn"].alias("turn"), r["role"].alias("role"), r["text"].alias("text"), (~r["again"]).alias("first"))))
    turns = F.size(F.array_distinct(F.filter(F.transform("rows", lambda r: r["turn"]), lambda t: t.isNotNull())))
    out = out.withColumn("gaps", F.coalesce(F.col("high") - F.col("low") + 1 - turns, F.lit(0).cast("long")))
    out = out.withColumn("marks", faults(F.col("rows")))
    count = lambda keep: F.size(F.filter("marks", keep)).cast("long")
    roles = F.transform("rows", lambda r: F.substring(r["role"], 1, 1))
    pairs = F.when(F.size("rows") > 1, F.zip_with(F.slice(roles, F.lit(1), F.size("rows") - 1), F.slice(roles, F.lit(2), F.size("rows") - 1), lambda a, b: F.concat(a, b))).otherwise(F.array().cast("array<string>"))
    return out.select(
        "conv_id", "rows", "gaps",
        count(lambda m: m == "b").alias("blank"), count(lambda m: m == "d").alias("duplicate"), count(lambda m: m.isin("S", "U", "A", "O")).alias("truncated"),
        F.size(F.filter(pairs, lambda p: ~p.isin("su", "ua", "au"))).cast("long").alias("illegal"),
        F.translate(F.array_join("marks", ""), "bd", MUST_GO * 2).alias("signature"),
    )


def audits(signatures: DataFrame) -> DataFrame:
    """(signature, cost, audit) of each distinct signature, by the automaton of shared ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = (s for b in batches for s in b.column(0).to_pylist())
        part: list[tuple[str, int, str]] = []
        size = 0
        for x in repair_signatures(texts):
            part.append(x)
            size += len(x[0]) + len(x[2]) + 64
            if size > 4_000_000:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*part, strict=True)], ["signature", "cost", "audit"])
                part, size = [], 0
        if part:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*part, strict=True)], ["signature", "cost", "audit"])

    ship(signatures.sparkSession)
    tasks = int(signatures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ends = signatures.select("signature").distinct().select("signature", F.reverse("signature").alias("end"))
    return ends.repartitionByRange(tasks, "end").sortWithinPartitions("end").select("signature").mapInArrow(run, "signature string, cost long, audit string")


def edited(convs: DataFrame) -> DataFrame:
    """``convs`` (conv_id, rows, ..., audit) with ``repaired_sha256`` for ``rows``."""
    keep = [c for c in convs.columns if c != "rows"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            digests = []
            for rows, audit in zip(b.column("rows"), b.column("audit"), strict=True):
                text = "\n".join(f"{r}:{t}" for r, t in repaired(rows.as_py(), audit.as_py()))
                digests.append(hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest())
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(digests, pa.string())], [*keep, "repaired_sha256"])

    ship(convs.sparkSession)
    return convs.mapInArrow(run, ", ".join(f"{c} {t}" for c, t in convs.dtypes if c != "rows") + ", repaired_sha256 string")


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (:func:`damaged`, or any conv_id, turn, role, text, kept)."""
    scratch = Scratch(rows.sparkSession, "conversation-repair")
    convs = scratch.write(conversations(rows))
    found = scratch.write(audits(convs))
    return edited(convs.join(found.hint("merge"), "signature").drop("signature"))
