"""URL rules by hashed expressions.

A rule is a host and a path prefix with a verdict. It fits its host and all
subdomains where the url's path starts with the rule's. The *shape* of a rule is
the number of its host's labels and the length of its path; a url has one
expression for each shape it is long enough for: the suffix of its host with so many
labels and the prefix of its path with so many characters. Rules and
expressions meet by an equi-join on the first hex digits of the expression's SHA-256; a
meeting counts only where the whole digests agree. Among the confirmed
rules the longest (host and path together) wins, then the one with the longer
host, then "block" over "allow".

DataFrame functions only. Where the rule table is small (rows and bytes are
checked), one broadcast join per shape looks a url up inside its own row: no
shuffle, and no row is multiplied, since the rules of one hash prefix travel as an
array. Beyond that the expressions are exploded under row ids and joined by
shuffle; an expression that many urls share is spread by a salt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustframe.llm.frames import free_names, local_ranks
from trustframe.session import cut_lineage

#: hex digits of the join key (32 bits)
PREFIX = 8
#: limits of the broadcast way: rules, bytes of their hosts and paths, shapes (one join each)
MAX_RULES, MAX_RULE_BYTES, MAX_SHAPES = 200_000, 32 << 20, 32
#: the shuffled way spreads expressions that hold more than 1/HOT of all
HOT = 1024
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://`` up to ``/``, ``?`` or ``#``, A-Z in lower case) and
    path (from there up to ``?`` or ``#``). Null or without ``://``: both empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), path


def _labels(host: Column) -> Column:
    return F.size(F.split(host, "\\.", -1))


def _digest(host: Column, path: Column, labels, length) -> Column:
    """Of an expression; the shape in front keeps host and path apart."""
    labels, length = (F.lit(x) if isinstance(x, int) else x for x in (labels, length))
    return F.sha2(F.concat(labels.cast("string"), F.lit(":"), length.cast("string"), F.lit(":"), host, path).cast("binary"), 256)


def compile_rules(rules: DataFrame, prefix: int = PREFIX) -> DataFrame:
    """rules (host, path, verdict) as (labels, length, key, digest, rule, verdict, rank),
    written once. Hosts lose upper case; a null path is empty; a rule with no host or with a
    verdict other than allow and block is left out, repeated rules count once. ``rank``
    orders rules that fit one url."""
    host = F.translate(F.col("host"), _UPPER, _LOWER)
    r = rules.select(host.alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
    r = r.where((F.col("host") != "") & F.col("verdict").isin("allow", "block")).distinct()
    r = r.select("*", _labels(F.col("host")).alias("labels"), F.length("path").alias("length"))
    r = r.select("*", _digest(F.col("host"), F.col("path"), F.col("labels"), F.col("length")).alias("digest"))
    rank = F.struct((F.length("host") + F.col("length")).alias("size"), F.length("host").alias("host"),
                    (F.col("verdict") == "block").alias("block"))
    return cut_lineage(r.select("labels", "length", F.substring("digest", 1, prefix).alias("key"), "digest",
                                F.concat("host", "path").alias("rule"), "verdict", rank.alias("rank")))


def _fits(host: Column, path: Column, labels, length) -> Column:
    return (_labels(host) >= labels) & (F.length(path) >= length)


def _expression(host: Column, path: Column, labels, length) -> Column:
    """Digest of the url's expression of a shape."""
    if isinstance(labels, int):
        return _digest(F.substring_index(host, ".", -labels), F.substring(path, 1, length), labels, length)
    suffix = F.array_join(F.slice(F.split(host, "\\.", -1), -labels, labels), ".")
    return _digest(suffix, F.substring(path, F.lit(1), length), labels, length)


def _in_row(src: DataFrame, compiled: DataFrame, shapes: list[tuple[int, int]], prefix: int) -> DataFrame:
    """``__hit`` by one broadcast join per shape."""
    per = compiled.groupBy("labels", "length", "key").agg(F.collect_list(F.struct("rank", "verdict", "rule", "digest")).alias("rules"))
    host, path = F.col("__host"), F.col("__path")
    src = src.select("*", *[F.when(_fits(host, path, n, k), _expression(host, path, n, k)).alias(f"__d{i}") for i, (n, k) in enumerate(shapes)])
    hits = []
    for i, (n, k) in enumerate(shapes):
        mine = per.where((F.col("labels") == n) & (F.col("length") == k)).select(F.col("key").alias(f"__k{i}"), F.col("rules").alias(f"__r{i}"))
        src = src.join(F.broadcast(mine), F.substring(f"__d{i}", 1, prefix) == F.col(f"__k{i}"), "left")
        # the key is only a part of the digest: confirm the whole
        hits.append(F.array_max(F.expr(f"filter(__r{i}, c -> c.digest = __d{i})")))
    return src.select("*", F.array_max(F.array(*hits)).alias("__hit"))


def _by_shuffle(src: DataFrame, compiled: DataFrame, shapes: list[tuple[int, int]], prefix: int) -> DataFrame:
    """``__hit`` by exploded expressions under row ids, joined by shuffle."""
    base = local_ranks(src, None, "__part", "__place")
    shape = F.explode(F.array(*[F.struct(F.lit(n).alias("n"), F.lit(k).alias("k")) for n, k in shapes])).alias("s")
    e = base.select("__part", "__place", "__host", "__path", shape).where(_fits(F.col("__host"), F.col("__path"), F.col("s.n"), F.col("s.k")))
    e = e.select("__part", "__place", _expression(F.col("__host"), F.col("__path"), F.col("s.n"), F.col("s.k")).alias("d"))
    e = e.withColumn("key", F.substring("d", 1, prefix))
    n = cut_lineage(e.groupBy("key").agg(F.count("*").alias("n")))
    many = max(1, (n.agg(F.sum("n")).first()[0] or 0) // HOT)
    # fewer than HOT keys hold more than 1/HOT of all expressions
    hot = F.broadcast(n.where(F.col("n") > many).select("key", F.ceil(F.col("n") / many).cast("int").alias("parts")))
    parts = F.coalesce("parts", F.lit(1))
    e = e.join(hot, "key", "left").select("__part", "__place", "d", "key", F.pmod("__place", parts).cast("int").alias("salt"))
    r = compiled.join(hot, "key", "left").select("key", "rank", "verdict", "rule", "digest", F.explode(F.sequence(F.lit(0), parts - 1)).alias("salt"))
    hits = (e.join(r, ["key", "salt"]).where("d = digest").groupBy("__part", "__place")
             .agg(F.max(F.struct("rank", "verdict", "rule")).alias("__hit")))
    return base.join(hits, ["__part", "__place"], "left")


def judge(pages: DataFrame, rules: DataFrame, url_col: str = "url", columns: list[str] | None = None, default: str = "allow",
          prefix: int = PREFIX, max_rules: int = MAX_RULES) -> DataFrame:
    """``columns`` of pages (all by default), host, path, rule (its host and path; null
    where none fits) and verdict (the rule's, else ``default``), one row per row of pages.

    A null url, an empty one and one without ``://`` have an empty host and path, which no rule fits;
    repeated rows are judged each; without rules all get the default. A very long url costs one
    expression per shape, like any other. Clashing names get a leading "_"."""
    columns = pages.columns if columns is None else columns
    host, path = host_and_path(F.col(f"`{url_col}`"))
    src = pages.select(*[F.col(f"`{c}`").alias(f"__c{i}") for i, c in enumerate(columns)], host.alias("__host"), path.alias("__path"))
    compiled = compile_rules(rules, prefix)
    n, size = compiled.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("rule")), F.lit(0))).first()
    # one row per number of labels and length of path
    shapes = sorted((r[0], r[1]) for r in compiled.select("labels", "length").distinct().collect())
    if not shapes:
        out = src.withColumn("__hit", F.lit(None).cast("struct<verdict: string, rule: string>"))
    elif n <= max_rules and size <= MAX_RULE_BYTES and len(shapes) <= MAX_SHAPES:
        out = _in_row(src, compiled, shapes, prefix)
    else:
        out = _by_shuffle(src, compiled, shapes, prefix)
    made = [F.col("__host"), F.col("__path"), F.col("__hit.rule"), F.coalesce("__hit.verdict", F.lit(default))]
    names = free_names(pages.select(*[F.col(f"`{c}`") for c in columns]), "host", "path", "rule", "verdict")
    return out.select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(columns)], *[c.alias(m) for c, m in zip(made, names)])
