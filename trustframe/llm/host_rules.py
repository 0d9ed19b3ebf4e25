"""Host-level quality rules with an empirical beta prior.

Each document gets counts from its whole text and a set of failed rules. Rule
failures are summed per host; a host's failure rate is shrunk towards the rate of
all hosts by a beta prior whose strength is estimated from the hosts (method
of moments), so a host with three bad pages out of four is not judged like one with
3,000 out of 4,000. A host is bad for a rule if the lower 5 % point of its posterior lies
above the prior's mean, so that it fails the rule more often than all hosts together, beyond
what chance gives. Documents there that fail the rule are dropped; on other hosts a soft
failure is tolerated.

DataFrame functions only; every count is made inside its own row, so texts
are never exploded or shuffled. What is shuffled is one row per host and rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustframe.llm.frames import free_names
from trustframe.session import cut_lineage

WS = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
#: standard deviations of a host's posterior between its mean and its lower 5 % point
LOWER = 1.645
#: soft rules: name -> SQL condition of failure (integers only)
RULES = {
    "symbols": "10 * n_symbols > n_words",
    "dup_lines": "10 * n_dup_lines > 3 * n_lines",
    "word_length": "word_chars > 12 * n_words or word_chars < 2 * n_words",
    "repeats": "20 * n_repeat_words > n_words",
}


def words(text: Column) -> Column:
    return F.filter(F.split(text, WS, -1), lambda w: w != "")


def _covered(grams: Column, n: int) -> Column:
    """Words covered by the grams (hashes in text order) that occur twice or
    more: equal neighbours after sorting, back in text order, then the gaps."""
    pairs = F.array_sort(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def again(p: Column) -> Column:
        at = F.filter(F.transform(p, lambda x, k: F.when(
            ((k > 0) & (p[F.greatest(k - 1, F.lit(0))].h == x.h)) | ((k < F.size(p) - 1) & (p[F.least(k + 1, F.size(p) - 1)].h == x.h)), x.i)),
            lambda x: x.isNotNull())
        return F.transform(F.array(F.array_sort(at)), lambda a: F.aggregate(
            F.transform(a, lambda x, k: F.when(k == F.size(a) - 1, F.lit(n)).otherwise(
                F.least(F.lit(n), a[F.least(k + 1, F.size(a) - 1)] - x))),
            F.lit(0).cast("long"), lambda s, x: s + x))[0]
    return F.transform(F.array(pairs), again)[0]


def counts(docs: DataFrame, text_col: str = "text", window: int = 5) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words
    (long). A null text has none of anything."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    hashed = F.transform(words(text), lambda w: F.xxhash64(w))
    out = docs.select("*", hashed.alias("__w"), lines.alias("__l"), text.alias("__t"))
    grams = F.when(F.size("__w") >= window, F.transform(
        F.sequence(F.lit(0), F.size("__w") - window),
        lambda i: F.xxhash64(*[F.get("__w", i + k) for k in range(window)]))).otherwise(F.array().cast("array<long>"))
    out = out.select("*", grams.alias("__g"))
    return out.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.size("__w").cast("long").alias("n_words"),
        F.length(F.translate("__t", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length("__t") - F.length(F.translate("__t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("__l").cast("long").alias("n_lines"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        F.when(F.size(F.array_distinct("__g")) == F.size("__g"), F.lit(0).cast("long"))
         .otherwise(_covered(F.col("__g"), window)).alias("n_repeat_words"))


def host_verdicts(failures: DataFrame, lower: float = LOWER) -> DataFrame:
    """(host, rule, n, fails, rate, low, bad) from ``failures`` (host, one 0/1
    column per rule of RULES).

    With hosts' rates p_i = x_i / n_i, the prior's mean m is that of all rows
    and its strength s = m (1 - m) / v - 1, v the variance of the p_i between
    hosts beyond what binomial draws give (each host weighs by its rows; s is
    kept within 1 and 1e6). The posterior is beta(x + m s, n - x + (1 - m) s): rate is its mean
    (x + m s) / (n + s), low the rate less ``lower`` standard deviations, sqrt(rate (1 - rate) / (n + s + 1))
    each; bad is low > m. A null host is a host."""
    per = failures.groupBy("host").agg(F.count("*").alias("n"), *[F.sum(r).alias(r) for r in RULES])
    stack = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("fails")) for r in RULES]))
    per = cut_lineage(per.select("host", "n", stack.alias("x")).select("host", "n", "x.rule", "x.fails"))
    # sums of integers up to the last step, so the result has one value whatever the order of rows
    p2 = (F.col("fails").cast("decimal(38,0)") * F.col("fails") * 1_000_000 / F.col("n")).cast("decimal(38,6)")
    all_ = per.groupBy("rule").agg(F.sum("n").cast("double").alias("N"), F.sum("fails").cast("double").alias("X"),
                                   F.sum(p2).cast("double").alias("S"), F.count("*").cast("double").alias("H"))
    m = F.col("X") / F.col("N")
    spread = F.col("S") / 1e6 / F.col("N") - m * m       # weighted variance of the rates
    within = m * (1 - m) * F.col("H") / F.col("N")       # of it, expected from drawing
    v = F.greatest(spread - within, F.lit(1e-9))
    s = F.greatest(F.lit(1.0), F.least(F.lit(1e6), m * (1 - m) / v - 1))
    prior = all_.select("rule", m.alias("m"), s.alias("s"))
    rate = (F.col("fails") + F.col("m") * F.col("s")) / (F.col("n") + F.col("s"))
    x = per.join(F.broadcast(prior), "rule").select("*", rate.alias("rate"))
    low = F.col("rate") - F.lit(lower) * F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("n") + F.col("s") + 1))
    return x.select("host", "rule", "n", "fails", "rate", low.alias("low"), (low > F.col("m")).alias("bad"))


def apply_host_rules(docs: DataFrame, host: Column, text_col: str = "text", columns: list[str] | None = None,
                     lower: float = LOWER) -> DataFrame:
    """``columns`` of docs (all by default), the counts, base_failed, host_failed
    (rules failed by the document and bad on its host) and kept.

    base_failed: fewer than 10 words, or over a fifth of them in repeated
    5-word windows. kept: neither base_failed nor any host_failed. Null texts
    have no words and fail the base; documents without a host share one. Clashing
    names get a leading "_"."""
    columns = docs.columns if columns is None else columns
    if text_col in columns:
        raise ValueError("the text is not carried; join it by id")
    own = [f"__c{i}" for i in range(len(columns))]  # so that no column of docs clashes with a count
    src = docs.select(*[F.col(f"`{c}`").alias(o) for c, o in zip(columns, own)], F.col(f"`{text_col}`").alias("__text"),
                      host.alias("__host"))
    # read by the host sums and by the join back: written once, without texts
    per = cut_lineage(counts(src, "__text").drop("__text"))
    flags = [F.when(F.expr(c) & (F.col("n_words") > 0), 1).otherwise(0).alias(r) for r, c in RULES.items()]
    bad = host_verdicts(per.select(F.col("__host").alias("host"), *flags), lower).where("bad")
    bad = bad.groupBy("host").agg(F.collect_set("rule").alias("__bad"))
    failed = F.array_compact(F.array(*[F.when(F.expr(c) & (F.col("n_words") > 0), F.lit(r)) for r, c in sorted(RULES.items())]))
    out = per.join(bad, per["__host"].eqNullSafe(bad["host"]), "left")
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    both = F.array_intersect(failed, F.coalesce("__bad", F.array().cast("array<string>")))
    made = {"n_words": F.col("n_words"), "word_chars": F.col("word_chars"), "n_symbols": F.col("n_symbols"),
            "n_lines": F.col("n_lines"), "n_dup_lines": F.col("n_dup_lines"), "n_repeat_words": F.col("n_repeat_words"),
            "base_failed": base, "host_failed": F.array_join(both, ","), "kept": ~base & (F.size(both) == 0)}
    names = free_names(docs.select(*[F.col(f"`{c}`") for c in columns]), *made)
    return out.select(*[F.col(o).alias(c) for c, o in zip(columns, own)],
                      *[c.alias(n) for c, n in zip(made.values(), names)])
