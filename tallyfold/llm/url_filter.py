"""URL filter: hand-written rules, and gradient-boosted trees where no rule fits.

Rules have a host and a path; one fits its host and all subdomains if the
URL's path starts with the rule's, and the longest wins (of equal ones that
with the longer host).  The trees see lexical features of the URL and
statistics of its host's suffixes: how many labelled URLs share the suffix and
what part of them is to be blocked, smoothed towards the shorter suffix.  The
statistics cover all labelled URLs.  For the rows that the trees are fitted on
they leave out the row's own fold, so that a label does not explain itself.

The trees are fitted on a sample of ``sample`` labelled URLs, taken by the
URLs' hash; that bound is the only one.  All URLs are judged.

Defined cases: a null URL counts as empty; without ``://`` host and path are
empty and no rule fits; a URL with several labels is to be blocked if half of
them say so; repeated rows are judged one by one and alike; without labelled
URLs all is allowed that no rule blocks, and with labels of one kind all has
that kind's verdict; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch

#: Labelled URLs that the trees are fitted on, about.
SAMPLE = 20_000
FOLDS = 5
TREES, DEPTH = 20, 4
#: Weight, in URLs, of the shorter suffix in a suffix's rate.
PRIOR = 20.0
#: Suffixes of a host that have statistics, by number of labels; 0 is the empty suffix, which all share.
LEVELS = (0, 1, 2, 99)

LEXICAL = ["url_length", "host_length", "path_length", "query_length", "host_labels", "depth", "digit_ratio", "entropy", "n_params", "hyphens", "escapes", "secure", "fragment"]
SUFFIX = [f"{what}_{k}" for k in range(1, len(LEVELS)) for what in ("rate", "count")]

Rule = tuple[str, str, str]


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(df: DataFrame, url: str = "url") -> DataFrame:
    """Adds host and path."""
    text = F.coalesce(F.col(url).cast("string"), F.lit(""))
    at = F.locate("://", text)
    rest = F.when(at > 0, F.substr(text, at + 3)).otherwise(F.lit(""))
    return df.withColumn("host", ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0))).withColumn("path", F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def ruled(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds rule and rule_verdict, both null where no rule of ``rules`` (verdict, host, path) fits."""
    host, path = F.col("host"), F.col("path")
    first = lambda rule: (-len(rule[1]) - len(rule[2]), -len(rule[1]), rule)
    fits = [(F.lit(f"{h}{p}"), F.lit(verdict), ((host == h) | host.endswith(f".{h}")) & path.startswith(p)) for verdict, h, p in sorted(rules, key=first)]
    none = F.lit(None).cast("string")
    pick = lambda k: F.coalesce(none, *[F.when(f[2], f[k]) for f in fits])
    return df.withColumn("rule", pick(0)).withColumn("rule_verdict", pick(1))


def entropy(text: Column) -> Column:
    """Bits a character, by the text's own frequencies of characters."""
    n = F.length(text)
    share = lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n
    bits = F.transform(F.array_distinct(F.split(text, "")), lambda c: -share(c) * F.log2(share(c)))
    return F.when(n == 0, F.lit(0.0)).otherwise(F.aggregate(bits, F.lit(0.0), lambda a, b: a + b))


def lexical(df: DataFrame, url: str = "url") -> DataFrame:
    """Adds the columns of LEXICAL to a table with host and path."""
    text = F.coalesce(F.col(url).cast("string"), F.lit(""))
    query = F.regexp_extract(text, r"^[^?#]*\?([^#]*)", 1)
    filled = lambda parts: F.size(F.filter(parts, lambda x: x != "")).cast("double")
    count = lambda c: (F.length(text) - F.length(F.translate(text, c, ""))).cast("double")
    return df.withColumns({
        "url_length": F.length(text).cast("double"), "host_length": F.length("host").cast("double"), "path_length": F.length("path").cast("double"), "query_length": F.length(query).cast("double"),
        "host_labels": filled(F.split("host", r"\.")), "depth": filled(F.split("path", "/")),
        "digit_ratio": count("0123456789") / F.greatest(F.length(text), F.lit(1)), "entropy": entropy(text), "n_params": filled(F.split(query, "&")),
        "hyphens": count("-"), "escapes": count("%"), "secure": F.startswith(text, F.lit("https:")).cast("double"), "fragment": F.contains(text, F.lit("#")).cast("double"),
    })


def suffixes(host: Column) -> Column:
    """array<struct<level, suffix>> of a host."""
    return F.array(*[F.struct(F.lit(k).alias("level"), F.substring_index(host, ".", -n).alias("suffix")) if n else F.struct(F.lit(0).alias("level"), F.lit("").alias("suffix")) for k, n in enumerate(LEVELS)])


def fold_of(url: Column) -> Column:
    return F.pmod(F.xxhash64(url, F.lit("fold")), F.lit(FOLDS)).cast("int")


def labelled_urls(urls: DataFrame, labels: DataFrame) -> DataFrame:
    """(url, host, path, fold, block) of each distinct labelled URL; ``labels`` has key and block, ``urls`` url and key."""
    said = labels.groupBy("key").agg(F.sum("block").alias("yes"), F.count(F.lit(1)).alias("all"))
    named = urls.select(F.coalesce("url", F.lit("")).alias("url"), "key").distinct()
    both = named.join(said.hint("merge"), "key").groupBy("url").agg((2 * F.sum("yes") >= F.sum("all")).cast("double").alias("block"))
    return split_url(both).withColumn("fold", fold_of(F.col("url")))


def suffix_counts(labelled: DataFrame) -> DataFrame:
    """(level, suffix, fold, n, blocked) over all labelled URLs."""
    one = labelled.select("fold", "block", F.explode(suffixes(F.col("host"))).alias("s")).select("s.level", "s.suffix", "fold", "block")
    return one.groupBy("level", "suffix", "fold").agg(F.count(F.lit(1)).alias("n"), F.sum("block").alias("blocked"))


def host_statistics(hosts: DataFrame, counts: DataFrame) -> DataFrame:
    """(host, fold) of ``hosts`` with the columns of SUFFIX; a fold's own URLs are left out, with fold -1 none are."""
    keys = hosts.select("host", "fold", F.explode(suffixes(F.col("host"))).alias("s")).select("host", F.col("fold").alias("own"), "s.level", "s.suffix")
    met = keys.join(counts.hint("merge"), ["level", "suffix"], "left")
    other = F.col("fold") != F.col("own")
    sums = []
    for k in range(len(LEVELS)):
        here = other & (F.col("level") == k)
        sums += [F.coalesce(F.sum(F.when(here, F.col("n"))), F.lit(0)).alias(f"n{k}"), F.coalesce(F.sum(F.when(here, F.col("blocked"))), F.lit(0.0)).alias(f"b{k}")]
    out = met.groupBy("host", F.col("own").alias("fold")).agg(*sums)
    rate = F.when(F.col("n0") > 0, F.col("b0") / F.col("n0")).otherwise(F.lit(0.0))
    for k in range(1, len(LEVELS)):
        out = out.withColumn(f"rate_{k}", (F.col(f"b{k}") + PRIOR * rate) / (F.col(f"n{k}") + PRIOR)).withColumn(f"count_{k}", F.log1p(F.col(f"n{k}")))
        rate = F.col(f"rate_{k}")
    return out.select("host", "fold", *SUFFIX)


def featured(urls: DataFrame, counts: DataFrame) -> DataFrame:
    """``urls`` (host, path, fold, ...) with ``features``; statistics are worked out once for each host and fold, then joined."""
    from pyspark.ml.feature import VectorAssembler

    stats = Scratch(urls.sparkSession, "url-hosts").write(host_statistics(urls.select("host", "fold").distinct(), counts))
    both = lexical(urls).join(stats.hint("merge"), ["host", "fold"])
    return VectorAssembler(inputCols=LEXICAL + SUFFIX, outputCol="features").transform(both).drop(*LEXICAL, *SUFFIX)


def fit(labelled: DataFrame, counts: DataFrame, sample: int = SAMPLE) -> Model | str:
    """The trees, or the verdict for all URLs if there are not two kinds of labels to learn from."""
    from pyspark.ml.classification import GBTClassifier

    n = labelled.count()
    taken = labelled if n <= sample else labelled.filter(F.pmod(F.xxhash64("url"), F.lit(1 << 30)) < int((1 << 30) * sample / n))
    rows = Scratch(labelled.sparkSession, "url-sample").write(featured(taken, counts).select("features", "block"))
    kinds = [r[0] for r in rows.groupBy("block").count().select("block").collect()]
    if len(kinds) < 2:
        return "block" if kinds == [1.0] else "allow"
    return GBTClassifier(featuresCol="features", labelCol="block", maxIter=TREES, maxDepth=DEPTH, seed=11).fit(rows)


def scored(model: Model | str, urls: DataFrame, counts: DataFrame) -> DataFrame:
    """``urls`` (host, path, ...) with ``score``, the trees' probability that the URL is to be blocked."""
    from pyspark.ml.functions import vector_to_array

    if isinstance(model, str):
        return urls.withColumn("score", F.lit(float(model == "block")))
    out = model.transform(featured(urls.withColumn("fold", F.lit(-1)), counts))
    return out.withColumn("score", vector_to_array("probability")[1]).drop("fold", "features", "rawPrediction", "probability", "prediction")


def judge(pages: DataFrame, labels: DataFrame, key: Column, rules: list[Rule], sample: int = SAMPLE) -> DataFrame:
    """(page_id, url, host, path, rule, verdict, score) of every row of ``pages`` (page_id, url).

    ``labels`` has key and block (1.0 or 0.0); the column ``key`` over ``pages`` says which label a URL has.
    """
    scratch = Scratch(pages.sparkSession, "url-filter")
    urls = pages.select("page_id", F.col("url").cast("string").alias("url"), key.alias("key"))
    labelled = scratch.write(labelled_urls(urls, labels))
    counts = scratch.write(suffix_counts(labelled))
    model = fit(labelled, counts, sample)
    out = scored(model, ruled(split_url(urls.drop("key")), rules), counts)
    own = F.when(F.col("score") >= 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return out.select("page_id", "url", "host", "path", "rule", F.coalesce("rule_verdict", own).alias("verdict"), "score")
