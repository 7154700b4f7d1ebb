"""Rule bitmask ledger for document quality.

Every rule is evaluated once per document; its outcome is a bit of ``bits``
beside the measurements.  A policy is a version with a mask: a document is
kept under it if no masked bit is set.  Ablations count, from the ledger
alone, what each rule rejects by itself and what it alone decides.

Defined cases: a null or empty text has no words, all measures 0, and fails
``short``; repeated rows are measured one by one; an empty table gives no
rows; other columns pass through :func:`ledger` only if named in ``keep``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: \x20 and \x09-\x0D, the characters between words.
SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

#: rule -> condition over the measurements; the position is the bit.
RULES: dict[str, str] = {
    "short": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "symbols": "100 * n_symbols > 25 * n_words",
    "duplicate_lines": "100 * n_dup_lines > 50 * n_lines",
    "long_words": "word_chars > 25 * n_words",
}
BITS = {name: 1 << i for i, name in enumerate(RULES)}
BASE = BITS["short"] | BITS["repeated_windows"]
#: version -> mask of the rules that reject.
POLICIES = {"base": BASE, "v1": BASE | BITS["symbols"], "v2": sum(BITS.values())}
CURRENT = "v2"


def split_words(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _measure_windows(df: DataFrame) -> DataFrame:
    """Adds n_repeat_words: words in 3-word windows that occur twice or more in the text.

    Windows are 64-bit hashes.  For sorting they are packed with their
    position into one long, so the sort is over primitives: the position takes
    as many low bits as the text needs, and neighbours that agree in the rest
    are compared by the whole hash.
    """
    h = F.col("_w")
    df = df.withColumn("_h", F.transform("_words", lambda w: F.xxhash64(w)))
    n = F.size("_words")
    hh = F.col("_h")
    window = lambda i: F.xxhash64(F.get(hh, i), F.get(hh, i + 1), F.get(hh, i + 2))
    df = df.withColumn("_w", F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), window)).otherwise(F.array().cast("array<bigint>")))
    df = df.withColumn("_b", F.length(F.bin(F.size("_w"))))
    df = df.withColumn("_mask", F.expr("shiftleft(1L, _b) - 1"))
    packed = F.when(F.size(F.array_distinct(h)) == F.size(h), F.array().cast("array<bigint>")).otherwise(F.sort_array(F.transform(h, lambda x, i: x.bitwiseAND(F.bitwise_not(F.col("_mask"))).bitwiseOR(i.cast("long")))))
    df = df.withColumn("_p", packed)
    p, mask = F.col("_p"), F.col("_mask")
    whole = lambda x: F.get(h, x.bitwiseAND(mask).cast("int"))
    same = lambda x, i: F.coalesce(whole(x) == whole(F.get(p, i - 1)), F.lit(False)) | F.coalesce(whole(x) == whole(F.get(p, i + 1)), F.lit(False))
    df = df.withColumn("_at", F.sort_array(F.transform(F.filter(p, same), lambda x: x.bitwiseAND(mask).cast("int"))))
    at = F.col("_at")
    covered = F.aggregate(F.transform(at, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - x, F.lit(3))).cast("long")), F.lit(0).cast("long"), lambda a, x: a + x)
    return df.withColumn("n_repeat_words", covered)


def measure(docs: DataFrame, text_col: str = "text", keep: list[str] = ["doc_id"]) -> DataFrame:  # noqa: B006
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = docs.select(*keep, text.alias("_text"))
    df = df.withColumn("_words", split_words(F.col("_text")))
    lines = F.filter(F.split(F.col("_text"), "\n"), lambda x: F.translate(x, SPACE, "") != "")
    df = df.withColumn("_lines", lines)
    df = df.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.translate("_text", SPACE, "")).cast("long"),
        "n_symbols": (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
    })
    df = _measure_windows(df)
    return df.select(*keep, "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def ledger(docs: DataFrame, text_col: str = "text", keep: list[str] = ["doc_id"]) -> DataFrame:  # noqa: B006
    """The measurements and ``bits`` of every row."""
    bits = None
    for name, rule in RULES.items():
        bit = F.when(F.expr(rule), F.lit(BITS[name])).otherwise(F.lit(0))
        bits = bit if bits is None else bits.bitwiseOR(bit)
    return measure(docs, text_col, keep).withColumn("bits", bits)


def verdict(led: DataFrame, policy: str = CURRENT, name: str = "kept") -> DataFrame:
    return led.withColumn(name, F.col("bits").bitwiseAND(F.lit(POLICIES[policy])) == 0)


def ablations(led: DataFrame, policies: dict[str, int] = POLICIES) -> DataFrame:
    """Per policy and rule: rejected by the policy, failing the rule, and rejected by this rule alone."""
    aggs = []
    for version, mask in policies.items():
        under = F.col("bits").bitwiseAND(F.lit(mask))
        for rule, bit in BITS.items():
            if mask & bit:
                aggs.append(F.struct(F.lit(version).alias("policy"), F.lit(rule).alias("rule"), F.count_if(under != 0).alias("rejected"), F.count_if(under.bitwiseAND(F.lit(bit)) != 0).alias("failing"), F.count_if(under == bit).alias("alone")))
    return led.agg(F.array(*aggs).alias("a")).select(F.inline("a"))
