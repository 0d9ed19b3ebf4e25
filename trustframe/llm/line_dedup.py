"""Removal of repeated runs of lines by winnowing.

Lines are hashed. Of every ``run`` consecutive lines the one with the smallest
hash (the first, on ties) is a fingerprint, so any repeated run of that many
lines has a fingerprint in common with its earlier copy, wherever the two
stand. A line of ``long_words`` words or more is a fingerprint by itself.
Fingerprints that occur at one position only are dropped after an aggregation.

Positions are joined next. A fingerprint's first position alone would not do (its
line may stand there among other lines), and joining all its positions would be all
pairs of a frequent line. So each fingerprint is widened to the windows of ``run``
lines around it, equal windows form a class, and each position is joined with its class's
first one: one row per position. Windows are equal if 128 bits of their lines agree.

From there matches are extended both ways: those of one document that lie on one diagonal
(the same earlier document, the same distance) and touch are one run. Every
line of a later run is deleted. A repeated line that is neither in a repeated
window nor long stays.

DataFrame functions only. What is exploded and shuffled are hashes, one row per window;
frequent lines are pre-aggregated and joined with AQE's skew handling.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustframe.llm.frames import free_names
from trustframe.session import cut_lineage

_WORD = "[^\\x20\\x09-\\x0D]"
_SPACE = "[\\x20\\x09-\\x0D]"
_NO_ID = (1 << 63) - 1  # a null id sorts after every id


def lines_of(text: Column) -> Column:
    """\\n-split lines; lines without a word stay with the line before them."""
    return F.split(text, f"\\n(?=[^\\n]*{_WORD})", -1)


def _hashes(lines: Column, long_words: int) -> Column:
    """Per line two hashes of 64 bits and whether it has ``long_words`` words."""
    many = f"^{_SPACE}*+(?:{_WORD}++{_SPACE}++){{{long_words - 1}}}{_WORD}"
    bare = F.transform(lines, lambda x: F.regexp_replace(x, f"(?s)^{_SPACE}+|{_SPACE}+$", ""))
    return F.transform(bare, lambda x: F.struct(F.xxhash64(x).alias("h"), F.xxhash64(F.lit(1), x).alias("g"),
                                                ((F.length(x) >= 2 * long_words - 1) & x.rlike(many)).alias("long")))


def _windows(lines: Column, run: int) -> Column:
    """Per window of ``run`` lines, and per long line: start, number of lines, 128 bits, fingerprint and its place."""
    at = lambda i, k: [F.get(lines, i + j)[k] for j in range(run)]
    low = lambda i: F.array_min(F.array(*[F.struct(x.alias("f"), (i + j).alias("at")) for j, x in enumerate(at(i, "h"))]))
    row = lambda i, n, w, v, low: F.struct(i.alias("i"), F.lit(n).alias("n"), w.alias("w"), v.alias("v"), low.alias("low"))
    whole = F.when(F.size(lines) >= run, F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(lines) - run)), lambda i: row(
        i, run, F.xxhash64(*at(i, "h")), F.xxhash64(F.lit(1), *at(i, "g")), low(i))))
    one = lambda i: F.get(lines, i)
    long = F.transform(F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: one(i)["long"]), lambda i: row(
        i, 1, one(i)["h"], one(i)["g"], F.struct(one(i)["h"].alias("f"), i.alias("at"))))
    return F.concat(F.coalesce(whole, F.slice(long, 1, 0)), long)


def repeated_runs(docs: DataFrame, run: int = 2, long_words: int = 50) -> DataFrame:
    """(ord, th, runs) from (ord, th, text): the runs of lines that repeat an earlier one, as
    structs (from_ord, from_th, shift, start, end): lines start to end - 1 equal the lines
    ``shift`` further up in the document (from_ord, from_th). Runs from different places may overlap."""
    h = docs.where("text <> ''").select("ord", "th", _hashes(lines_of(F.col("text")), long_words).alias("h"))
    rows = cut_lineage(h.select("ord", "th", F.explode(_windows(F.col("h"), run)).alias("x")).select(
        "ord", "th", "x.i", "x.n", "x.w", "x.v", F.col("x.low.f").alias("f"), F.col("x.low.at").alias("at")))
    place = F.struct("ord", "th", "at")
    shared = rows.groupBy("f").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a <> b").select("f")
    near = rows.join(shared, "f", "left_semi").select("ord", "th", "i", "n", "w", "v")
    here = F.struct("ord", "th", "i")
    first = near.groupBy("w", "v", "n").agg(F.min(here).alias("a"), F.max(here).alias("b")).where("a <> b").select("w", "v", "n", "a")
    later = near.join(first, ["w", "v", "n"]).where(here > F.col("a"))
    match = F.struct(F.col("a.ord").alias("o"), F.col("a.th").alias("t"), (F.col("i") - F.col("a.i")).alias("d"), "i", "n")
    m = later.groupBy("ord", "th").agg(F.sort_array(F.collect_set(match)).alias("m"))
    # a run starts at a match that does not touch the one before it on its diagonal
    x, before = (lambda k: F.get("m", k)), (lambda k: F.get("m", k - 1))
    heads = F.filter(F.sequence(F.lit(0), F.size("m") - 1), lambda k: (k == 0) | (x(k)["o"] != before(k)["o"]) | (
        x(k)["t"] != before(k)["t"]) | (x(k)["d"] != before(k)["d"]) | (x(k)["i"] > before(k)["i"] + before(k)["n"]))
    m = m.withColumn("s", F.concat(heads, F.array(F.size("m"))))
    return m.select("ord", "th", F.transform(F.sequence(F.lit(0), F.size("s") - 2), lambda k: F.struct(
        x(F.get("s", k))["o"].alias("from_ord"), x(F.get("s", k))["t"].alias("from_th"), x(F.get("s", k))["d"].alias("shift"),
        x(F.get("s", k))["i"].alias("start"), F.array_max(F.transform(
            F.slice("m", F.get("s", k) + 1, F.get("s", k + 1) - F.get("s", k)), lambda y: y["i"] + y["n"])).alias("end"))).alias("runs"))


def remove_repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: int = 2,
                         columns: list[str] | None = None, long_words: int = 50) -> DataFrame:
    """``columns`` of docs (all by default), n_lines, n_removed (long) and kept_text:
    the text without the later runs of ``run`` lines or more, or of one line of ``long_words``
    words or more, that equal an earlier one, in an earlier document or further up.

    Documents go by id (null last), then by a hash of the text; rows equal in both are one
    document and get the same result; ids must be numbers. A very long text is one row. Lines are compared without white space at
    their ends; a null text has no lines. Clashing names get a leading "_"."""
    columns = docs.columns if columns is None else columns
    own = [f"__c{i}" for i in range(len(columns))]
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    keyed = docs.select(*[F.col(f"`{c}`").alias(o) for c, o in zip(columns, own)], text.alias("text"),
                        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(_NO_ID)).alias("ord"), F.xxhash64(text).alias("th"))
    runs = repeated_runs(keyed.select("ord", "th", "text"), run, long_words)
    marks = runs.select("ord", "th", F.array_sort(F.array_distinct(F.flatten(F.transform(
        "runs", lambda r: F.sequence(r["start"], r["end"] - 1))))).alias("gone"))
    x = keyed.join(marks, ["ord", "th"], "left").withColumn("l", F.when(F.col("text") == "", F.array().cast("array<string>")).otherwise(lines_of(F.col("text"))))
    # between the lines that go
    s = F.col("gone")
    edges = F.concat(F.array(F.lit(-1)), s, F.array(F.size("l")))
    parts = F.transform(F.sequence(F.lit(0), F.size(s)), lambda k: F.slice(
        "l", F.get(edges, k) + 2, F.get(edges, k + 1) - F.get(edges, k) - 1))
    x = x.withColumn("k", F.when(s.isNull(), F.col("l")).otherwise(F.flatten(parts)))
    names = free_names(docs.select(*[F.col(f"`{c}`") for c in columns]), "n_lines", "n_removed", "kept_text")
    return x.select(*[F.col(o).alias(c) for c, o in zip(columns, own)], F.size("l").cast("long").alias(names[0]),
                    (F.size("l") - F.size("k")).cast("long").alias(names[1]), F.array_join("k", "\n").alias(names[2]))
