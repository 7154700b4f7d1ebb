"""Reference lists held against what is known, by ordered rules; the first that matches classifies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import distance_m
from .select import among


def first_rule(rows: DataFrame, key: str, *matches: tuple[DataFrame, str]) -> DataFrame:
    """(key, status): of the rules (rows of ``key``, status) in order the first that has the row, else ``absent``."""
    ranked = None
    for i, (m, status) in enumerate(matches):
        part = m.select(key).distinct().select(key, F.struct(F.lit(i).alias("rank"), F.lit(status).alias("status")).alias("_r"))
        ranked = part if ranked is None else ranked.union(part)
    best = ranked.groupBy(key).agg(F.min("_r").alias("_r"))
    return rows.select(key).join(best, key, "left").select(key, F.coalesce("_r.status", F.lit("absent")).alias("status"))


def expected_status(expected: DataFrame, events: DataFrame, signals: DataFrame) -> DataFrame:
    """(expected_id, status) of expected events (expected_id, bank_key, place_key, label_key, is_plan).

    Events (event_seq, bank_key, place_key, label_key, date_status) in order of
    event_seq: the first of the bank with the place, or else the branch label,
    decides by its date_status.  Then a label that is an event's place, a plan
    in the bank's signals, a mention in a signal's text, and nothing.
    """
    # each rule is an equi-join on bank and name, so that a bank with very many rows is no task of its own; of a name only its first event is met
    known = lambda theirs, ours: events.filter(F.col(theirs).isNotNull()).groupBy("bank_key", F.col(theirs).alias(ours)).agg(F.min(F.struct("event_seq", "date_status")).alias("_e")).select("bank_key", ours, "_e.*").hint("merge")
    labelled = expected.filter("label_key <> ''")
    by_place = expected.join(known("place_key", "place_key"), ["bank_key", "place_key"]).select("expected_id", "event_seq", F.lit(0).alias("how"), "date_status")
    by_label = labelled.join(known("label_key", "label_key"), ["bank_key", "label_key"]).select("expected_id", "event_seq", F.lit(1).alias("how"), "date_status")
    direct = by_place.union(by_label).groupBy("expected_id").agg(F.min(F.struct("event_seq", "how", "date_status")).alias("_d"))
    as_place = labelled.join(known("place_key", "label_key"), ["bank_key", "label_key"], "left_semi").select("expected_id")
    texts = signals.select("bank_key", "text_key", "plan_like").distinct()
    plan = expected.filter("is_plan").join(texts.filter("plan_like").select("bank_key").distinct(), "bank_key", "left_semi").select("expected_id")
    named = expected.select("expected_id", "bank_key", F.explode(F.array_distinct(F.filter(F.array("place_key", "label_key"), lambda k: k != ""))).alias("k"))
    names = named.select(F.struct("bank_key", "k").alias("item_id"), "bank_key", "k").distinct()  # each name is looked for once
    told = texts.select("bank_key", F.col("text_key").alias("t")).distinct().withColumn("doc_id", F.sha2(F.concat_ws("|", "bank_key", "t"), 256))
    met = text_mentions(names, told, ["bank_key"]).select("item_id.*").distinct()
    said = named.join(met.hint("merge"), ["bank_key", "k"], "left_semi").select("expected_id")
    rest = first_rule(expected, "expected_id", (as_place, "label_as_place"), (plan, "plan"), (said, "mentioned"))
    return rest.join(direct, "expected_id", "left").select("expected_id", F.coalesce("_d.date_status", "status").alias("status"))


def _grams(c: Column, n: Column | int) -> Column:
    """Distinct pieces of ``n`` characters."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.when(F.length(c) >= n, F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - n + 1), lambda i: F.substr(c, i, n)))).otherwise(F.array().cast("array<string>"))


def held_labels(listed: DataFrame, events: DataFrame, least: int) -> DataFrame:
    """(bank_key, label_key, e_label) where one label of the bank holds the other and the event's has ``least`` characters.

    Labels meet as equal ones: the pieces of a label that are as long as labels
    of the other side are, and these.  Each label of a bank is taken once, so
    what meets are the pairs of labels that hold, however many rows have them.
    """
    ours = listed.filter("label_key <> ''").select("bank_key", "label_key").distinct()
    theirs = events.filter(F.length("e_label") >= least).select("bank_key", "e_label").distinct()

    def holding(outer: DataFrame, whole: str, inner: DataFrame, part: str) -> DataFrame:
        sizes = inner.agg(F.sort_array(F.collect_set(F.length(part))).alias("_sizes"))  # one row; its array is as long as labels are
        pieces = outer.crossJoin(F.broadcast(sizes)).select("bank_key", whole, F.explode(F.flatten(F.transform("_sizes", lambda n: _grams(F.col(whole), n)))).alias(part))
        return pieces.join(inner.hint("merge"), ["bank_key", part]).select("bank_key", "label_key", "e_label")

    return holding(ours, "label_key", theirs, "e_label").union(holding(theirs, "e_label", ours, "label_key")).distinct()


def on_map(listed: DataFrame, events: DataFrame, signals: DataFrame | None = None, exact_m: float = 500, containment: int = 8) -> DataFrame:
    """(listed_id, event_seq, status) of listed rows (listed_id, bank_key, place_key, label_key, department, lat, lon).

    The first event (event_seq, bank_key, e_place, e_original, e_label, e_lat,
    e_lon) of the bank that has the place as its own or original one, or a
    label that equals or holds the row's or is held by it (``containment``
    characters at least), makes it present: ``exact`` within ``exact_m``
    metres, ``present_on_map``, or ``present_unlocated`` without coordinates.
    Else a signal (bank_key, department) makes it ``present_department``, and
    nothing ``needs_research``.  Blank names match nothing.
    """
    # of a name only its first event is met, so that rows of one name are no pairs
    known = lambda theirs: events.filter(f"{theirs} <> ''").groupBy("bank_key", theirs).agg(F.min(F.struct("event_seq", "e_lat", "e_lon")).alias("_e"))
    by = lambda ours, theirs: listed.filter(f"{ours} <> ''").join(known(theirs).withColumnRenamed(theirs, ours).hint("merge"), ["bank_key", ours]).select("listed_id", "_e")
    held = held_labels(listed, events, containment).join(known("e_label").hint("merge"), ["bank_key", "e_label"]).groupBy("bank_key", "label_key").agg(F.min("_e").alias("_e"))
    held = listed.select("listed_id", "bank_key", "label_key").join(held.hint("merge"), ["bank_key", "label_key"]).select("listed_id", "_e")
    met = by("place_key", "e_place").union(by("place_key", "e_original")).union(by("label_key", "e_label")).union(held)
    first = met.groupBy("listed_id").agg(F.min("_e").alias("_f"))
    found = listed.join(first.hint("merge"), "listed_id", "left")
    apart = distance_m("lat", "lon", "_f.e_lat", "_f.e_lon")
    status = F.when(F.col("_f").isNull(), None).when(F.col("_f.e_lat").isNull() | F.col("_f.e_lon").isNull(), "present_unlocated").when(apart < exact_m, "exact").otherwise("present_on_map")
    out = found.select("listed_id", "bank_key", "department", F.col("_f.event_seq").alias("event_seq"), status.alias("_status"))
    if signals is not None:
        some = signals.select("bank_key", "department").distinct().withColumn("_signal", F.lit("present_department"))
        out = out.join(some.hint("merge"), ["bank_key", "department"], "left")
    else:
        out = out.withColumn("_signal", F.lit(None).cast("string"))
    return out.select("listed_id", "event_seq", F.coalesce("_status", "_signal", F.lit("needs_research")).alias("status"))


def text_mentions(items: DataFrame, docs: DataFrame, on: list[str] = []) -> DataFrame:  # noqa: B006
    """(item_id, doc_id) where the text ``t`` of ``docs`` holds the text ``k`` of ``items``, both with single spaces, and the columns ``on`` are equal; blank items are nowhere.

    An item's words but the first and last are whole words of a text that holds
    it.  So an item of four words or more meets texts by its second and third
    word in a row, one of three by its second.  One of two meets them by the
    words that begin with its second, and one of one by pieces of words; how
    long these are the items say.  What meets is then tested for the whole item.
    """
    w = F.split("k", " ")
    kind = F.when(F.size(w) >= 4, "g").when(F.size(w) == 3, "w").when(F.size(w) == 2, "p").otherwise("s")
    token = F.when(F.size(w) >= 4, F.concat_ws(" ", F.get(w, 1), F.get(w, 2))).when(F.size(w) > 1, F.get(w, 1)).otherwise(F.get(w, 0))
    asked = items.filter("k <> ''").select("item_id", "k", *on, F.concat(kind, F.lit(" "), token).alias("_token"))
    size = lambda kind: F.sort_array(F.collect_set(F.when(F.col("_token").startswith(kind), F.length("_token") - 2)))
    has = lambda kind: F.coalesce(F.bool_or(F.col("_token").startswith(kind)), F.lit(False))
    sizes = asked.agg(size("p").alias("_p"), size("s").alias("_s"), has("g").alias("_has_g"), has("w").alias("_has_w"))  # one row; its arrays are as long as words are
    words = F.array_distinct(F.split("t", " "))
    grams = F.zip_with(F.split("t", " "), F.slice(F.split("t", " "), F.lit(2), F.size(F.split("t", " "))), lambda x, y: F.concat_ws(" ", x, y))
    tagged = lambda kind, found: F.transform(found, lambda x: F.concat(F.lit(f"{kind} "), x))
    begins = F.flatten(F.transform("_p", lambda n: F.transform(F.filter("_w", lambda x: F.length(x) >= n), lambda x: F.substr(x, F.lit(1), n))))
    pieces = F.flatten(F.transform("_s", lambda n: F.flatten(F.transform(F.filter("_w", lambda x: F.length(x) >= n), lambda x: _grams(x, n)))))
    said = docs.withColumn("_w", words).withColumn("_g", grams).crossJoin(F.broadcast(sizes))  # one row
    some = lambda c, found: F.when(F.col(c), found).otherwise(F.array().cast("array<string>"))
    all_ = F.concat(some("_has_g", tagged("g", F.col("_g"))), some("_has_w", tagged("w", F.col("_w"))), tagged("p", begins), tagged("s", pieces))
    found = said.select("doc_id", *on, F.explode(F.array_distinct(all_)).alias("_token"))
    pairs = among(found, "_token", asked).join(asked.hint("merge"), [*on, "_token"]).select("doc_id", "item_id", "k").distinct()
    return docs.select("doc_id", "t").join(pairs.hint("merge"), "doc_id").filter("contains(t, k)").select("item_id", "doc_id")


def has_evidence(rows: DataFrame, signals: DataFrame, on: list[str]) -> DataFrame:
    return rows.join(signals, on, "left_semi")


def override(rows: DataFrame, key: str, source: str, rules: DataFrame, fields: dict[str, str | None]) -> DataFrame:
    """``rows`` with fields set by rules (pattern, rule_pos, and the fields): of those whose pattern the source contains, the last that sets a field.

    ``rules`` is a hand-written list, small by nature; ``fields`` has defaults.
    """
    renamed = rules.select("pattern", "rule_pos", *[F.col(f).alias(f"_{f}") for f in fields])
    met = rows.select(key, source).join(F.broadcast(renamed), F.contains(F.lower(F.col(source)), F.lower("pattern")))
    picked = met.groupBy(key).agg(*[F.max_by(f"_{f}", F.when(F.col(f"_{f}").isNotNull(), F.col("rule_pos"))).alias(f"_{f}") for f in fields])
    kept = [c for c in rows.columns if c not in fields]
    old = lambda f: [F.col(f)] if f in rows.columns else []
    return rows.join(picked, key, "left").select(*kept, *[F.coalesce(*old(f), f"_{f}", F.lit(d)).alias(f) for f, d in fields.items()])


def override_rows(rows: DataFrame, key: str, rules: DataFrame, fields: list[str]) -> DataFrame:
    """``rows`` (with bank_key, place_key, label_key) with fields set by row rules of the same bank and place, and label where the rule has one: the last rule that sets a field.

    Fields that no rule sets stay; ``rules`` is a hand-written list joined on its keys.
    """
    renamed = rules.select("bank_key", "place_key", F.col("label_key").alias("_label"), "rule_pos", *[F.col(f).alias(f"_{f}") for f in fields])
    met = rows.select(key, "bank_key", "place_key", "label_key").join(renamed.hint("merge"), ["bank_key", "place_key"]).filter("coalesce(_label, '') = '' or _label = label_key")
    picked = met.groupBy(key).agg(*[F.max_by(f"_{f}", F.when(F.col(f"_{f}").isNotNull(), F.col("rule_pos"))).alias(f"_{f}") for f in fields])
    return rows.join(picked, key, "left").select(*[c for c in rows.columns if c not in fields], *[F.coalesce(f"_{f}", f).alias(f) for f in fields])


def default_reliability(reliability: Column, url: Column) -> Column:
    """What rules set, else medium for a row with a URL and low for one without."""
    return F.coalesce(reliability, F.when(F.trim(F.coalesce(url, F.lit(""))) != "", "medium").otherwise("low"))


def summary(rows: DataFrame, statuses: DataFrame) -> DataFrame:
    """(status, n, share) for every status of the dimension, 0 where none has it; share in percent of all rows."""
    counts = rows.groupBy("status").agg(F.count(F.lit(1)).alias("_n"))
    total = rows.agg(F.count(F.lit(1)).alias("_t"))
    out = statuses.select("status").join(counts, "status", "left").crossJoin(F.broadcast(total))  # one row
    return out.select("status", F.coalesce("_n", F.lit(0)).alias("n"), F.round(100 * F.coalesce("_n", F.lit(0)) / F.greatest("_t", F.lit(1)), 1).alias("share"))
