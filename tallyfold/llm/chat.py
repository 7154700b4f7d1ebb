"""Reply trees to formatted conversations.

Messages point to their parent.  The paths from the root to each leaf are found
by iterative self-joins over ids only; branches of a tree are ranked by score,
and the chosen paths are joined with the texts once.

Template: a turn is ``[role] text [/role]``, an assistant's turn is followed
by ``</s>``.  Texts and roles are escaped so that they hold neither ``[`` nor
``<``: the escapes are ``\\b`` for a backslash, ``\\l`` for ``[`` and ``\\g``
for ``<``, and in roles ``\\r`` for ``]`` and ``\\s`` for ``/``.  So no text can form a control string, and the original is got
back exactly.

Defined cases: a null text counts as empty and a null role as the empty role;
rows of one turn are ordered by role, then text, and each is a turn of its
own; rows without a conversation's number are one conversation, without a
number as well; a message whose parent is missing is a root; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch

LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("["), F.lit("\\l")), F.lit("<"), F.lit("\\g"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("\\l"), F.lit("[")), F.lit("\\g"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(F.replace(escape(role), F.lit("]"), F.lit("\\r")), F.lit("/"), F.lit("\\s"))


def unescape_role(tag: Column) -> Column:
    return unescape(F.replace(F.replace(tag, F.lit("\\r"), F.lit("]")), F.lit("\\s"), F.lit("/")))


def chains(rows: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Linear conversations as reply trees: each message answers the one before it."""
    w = Window.partitionBy("tree").orderBy("turn", "role", "text")
    rows = rows.select(F.col(conv).alias("tree"), F.col(turn).alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    node = F.row_number().over(w).cast("long")
    return rows.withColumn("node", node).withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1)).withColumn("score", F.lit(0.0)).drop("turn")


def nodes_table(rows: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """:func:`chains`, written out once, as node numbers and texts are read by separate joins.

    ``tree`` is the conversation's number as text, ``null`` for rows without one, which no number reads as, so that joins meet it.
    """
    return Scratch(rows.sparkSession, "chat-nodes").write(chains(rows, conv, turn).withColumn("tree", F.coalesce(F.col("tree").cast("string"), F.lit("null"))))


def paths(nodes: DataFrame) -> DataFrame:
    """(tree, leaf, node, up): each leaf with each message on its way to the root, ``up`` steps above it.

    ``nodes`` has tree, node and parent; a node of a tree is unique.  Self-joins
    of the parents give the ancestors 2, 4, 8 ... steps above, for as long as
    there are any; from the farthest to the nearest these extend the leaves'
    paths.  So the rounds grow with the logarithm of the depth, and no more
    rows are made than the paths have.
    """
    scratch = Scratch(nodes.sparkSession, "reply-paths")
    ids = nodes.select("tree", "node", "parent")
    known = ids.select("tree", F.col("node").alias("parent"))
    jumps = [scratch.write(ids.filter("parent is not null").join(known.hint("merge"), ["tree", "parent"]).select("tree", "node", F.col("parent").alias("to")))]
    while not jumps[-1].isEmpty():
        far = jumps[-1].select("tree", F.col("node").alias("to"), F.col("to").alias("far"))
        jumps.append(scratch.write(jumps[-1].join(far.hint("merge"), ["tree", "to"]).select("tree", "node", F.col("far").alias("to"))))
    answered = jumps[0].select("tree", F.col("to").alias("node")).distinct()
    found = scratch.write(ids.select("tree", "node").join(answered.hint("merge"), ["tree", "node"], "left_anti").select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("up")))
    for k in range(len(jumps) - 2, -1, -1):
        more = found.join(jumps[k].hint("merge"), ["tree", "node"]).select("tree", "leaf", F.col("to").alias("node"), (F.col("up") + (1 << k)).alias("up"))
        found = found.unionByName(scratch.write(more))
    return found


def best(nodes: DataFrame, steps: DataFrame, top: int | None = None) -> DataFrame:
    """(tree, leaf, score, size, rank) of the branches; only ranks up to ``top`` if given.

    A branch's score is the mean of its messages'; ties go to the longer, then to the smaller leaf.
    """
    scored = steps.join(nodes.select("tree", "node", "score").hint("merge"), ["tree", "node"])
    branches = scored.groupBy("tree", "leaf").agg(F.avg("score").alias("score"), F.count(F.lit(1)).alias("size"))
    if top == 1:  # combined before the shuffle, so that a tree of very many branches is no task of its own
        first = branches.groupBy("tree").agg(F.min(F.struct((-F.col("score")).alias("s"), (-F.col("size")).alias("n"), "leaf")).alias("b"))
        return first.select("tree", "b.leaf", (-F.col("b.s")).alias("score"), (-F.col("b.n")).alias("size"), F.lit(1).alias("rank"))
    w = Window.partitionBy("tree").orderBy(F.desc("score"), F.desc("size"), "leaf")
    out = branches.withColumn("rank", F.row_number().over(w))
    return out if top is None else out.filter(F.col("rank") <= top)


#: Messages that a conversation has at most, so that its number and a message's make one.
MOST_TURNS = 1_000_000


def shared_roots(rows: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Conversations that open with the same text as one reply tree: that text is the root, each conversation a branch.

    (tree, node, parent, role, text, score): ``tree`` is the smallest conversation's number, the score a text's length.
    Conversations without a number are left out.
    """
    scratch = Scratch(rows.sparkSession, "shared-roots")
    c = scratch.write(chains(rows.filter(F.col(conv).isNotNull()), conv, turn))
    roots = c.filter("node = 1").select(F.col("tree").alias("conv"), F.sha2("text", 256).alias("key"), "role", "text")
    first = scratch.write(roots.groupBy("key").agg(F.min(F.struct("conv", "role", "text")).alias("f")).select("key", F.col("f.conv").alias("tree"), F.col("f.role").alias("role"), F.col("f.text").alias("text")))
    of = roots.select("conv", "key").join(first.select("key", "tree").hint("merge"), "key").select("conv", "tree")
    number = lambda conv, k: F.col(conv) * MOST_TURNS + k
    later = c.filter("node > 1").select(F.col("tree").alias("conv"), "node", "role", "text").join(of.hint("merge"), "conv")
    parent = F.when(F.col("node") == 2, number("tree", F.lit(1))).otherwise(number("conv", F.col("node") - 1))
    score = F.length("text").cast("double").alias("score")
    later = later.select("tree", number("conv", F.col("node")).alias("node"), parent.alias("parent"), "role", "text", score)
    return scratch.write(first.select("tree", number("tree", F.lit(1)).alias("node"), F.lit(None).cast("long").alias("parent"), "role", "text", score).unionByName(later))


def turn_text(role: Column, text: Column) -> Column:
    r = escape_role(role)
    return F.concat(F.lit("["), r, F.lit("] "), escape(text), F.lit(" [/"), r, F.lit("]"), F.when(role == LOSS_ROLE, F.lit("</s>")).otherwise(F.lit("")))


def format_paths(nodes: DataFrame, steps: DataFrame, chosen: DataFrame) -> DataFrame:
    """(tree, leaf, formatted, loss_spans): the chosen branches with their texts; spans are (start, length) in code points."""
    picked = steps.join(chosen.select("tree", "leaf").hint("merge"), ["tree", "leaf"], "left_semi")
    turns = picked.join(nodes.select("tree", "node", "role", "text").hint("merge"), ["tree", "node"])
    turns = turns.select("tree", "leaf", F.struct((-F.col("up")).alias("pos"), turn_text(F.col("role"), F.col("text")).alias("s")).alias("t"))
    whole = turns.groupBy("tree", "leaf").agg(F.array_join(F.transform(F.sort_array(F.collect_list("t")), lambda t: t["s"]), "").alias("formatted"))
    return whole.withColumn("loss_spans", loss_spans(F.col("formatted")))


def parsed(formatted: Column) -> Column:
    """array<struct<role, tag, raw, size>> read from formatted text; ``tag`` and ``raw`` are role and text as they stand there."""
    pieces = F.filter(F.split(formatted, r"(?=\[[^/\[\]][^\[\]]*\] |\[\] )"), lambda x: x != "")
    role = lambda x: F.substring_index(F.substring(x, 2, 2**31 - 1), "] ", 1)

    def one(x: Column) -> Column:
        r = role(x)
        inner = F.regexp_extract(x, r"(?s)^\[[^\]]*\] ([^\[]*) \[/", 1)
        return F.struct(unescape_role(r).alias("role"), r.alias("tag"), inner.alias("raw"), F.length(x).cast("long").alias("size"))

    return F.transform(pieces, one)


def loss_spans(formatted: Column) -> Column:
    """Spans of the assistant's texts, from the formatted text itself."""
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        span = F.struct((acc["at"] + F.length(t["tag"]) + 3).cast("long").alias("start"), F.length(t["raw"]).cast("long").alias("length"))
        spans = F.when(t["role"] == LOSS_ROLE, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.struct((acc["at"] + t["size"]).alias("at"), spans.alias("spans"))

    return F.aggregate(parsed(formatted), zero, step)["spans"]
