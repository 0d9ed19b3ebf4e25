"""Audit of how filters interact over every order of application.

Each document gets a mask of the filters it fails. Documents are counted per
part, mask and label, so what follows works on *cells*: at most 32 masks x 4 labels a
part for five filters. Every cell is then folded across the array of all
orders with higher-order functions: ``transform`` walks the orders, ``aggregate`` walks
one order's filters and carries whether the cell's documents are still there; it
yields one struct of weighted counts per order and step (600 for five filters). The
structs are merged per part by elementwise sums, partially before the shuffle.

The order array is a literal of the plan: its size depends on the number of
filters alone.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WS = "[\\x20\\x09-\\x0D]+"
FILTERS = "ABCDE"
_BLANKS = " \t\n\x0b\x0c\r"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def text_failures(text: Column) -> Column:
    """Bits A to D of a text's mask (bit 0: A). A null text is empty; an empty one has no words
    and fails A alone."""
    text = F.coalesce(text, F.lit(""))
    inner = F.btrim(text, F.lit(_BLANKS))
    words = F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, WS, -1))
    n = F.size(words).cast("long")
    upper = F.octet_length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = [n < 200, 100 * F.size(F.array_distinct(words)) < 50 * n, 100 * upper.cast("long") > 3 * F.length(text),
             text.rlike("[#$%&*|]")]
    out = F.lit(0)
    for i, f in enumerate(fails):
        out = out + F.when(f, F.lit(1 << i)).otherwise(F.lit(0))
    return out


def cells(docs: DataFrame, labels: DataFrame, part: Column, failures=text_failures, copy_bit: int = 4,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(part, mask, good, toxic, n): documents by part, failed filters and label. ``failures`` gives the
    mask of a text; bit ``copy_bit`` is set where a document with a smaller id has the same text.

    A document is good or toxic if any row of ``labels`` with its id says so. Rows with a null id have no label, no
    copy of them counts as earlier, and they are no one's copy; equal rows share their id and are not each other's
    copies. Texts are compared by SHA-256. Every shuffle is preceded by a partial aggregation: a text or an id that
    holds a third of all rows is one row per task after it."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    d = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(part, F.lit("")).alias("part"), failures(text).alias("m"),
                    F.unhex(F.sha2(text.cast("binary"), 256)).alias("t"))
    d = d.groupBy("id", "part", "m", "t").agg(F.count("*").alias("n"))
    flag = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)))
    lab = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("lid")).agg(flag("quality").alias("good"), flag("toxic").alias("toxic"))
    d = d.join(lab, d["id"] == lab["lid"], "left").select(
        "id", "part", "m", "t", "n", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))
    # per text: how many rows of each kind stand under its smallest id, which is no copy
    has = F.col("id").isNotNull()
    d = d.groupBy("t", "part", "m", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min("id").alias("low"), F.min_by(F.when(has, F.col("n")), F.col("id")).alias("n_low"),
        F.sum(F.when(has, 0).otherwise(F.col("n"))).alias("n_null"))
    # a text has one row per part and label now
    d = d.withColumn("first", F.min("low").over(Window.partitionBy("t")))
    own = F.coalesce(F.when(F.col("low") == F.col("first"), F.col("n_low")), F.lit(0)) + F.col("n_null")
    two = F.explode(F.array(F.struct(F.col("m").alias("mask"), own.alias("n")),
                            F.struct(F.col("m").bitwiseOR(F.lit(1 << copy_bit)).alias("mask"), (F.col("n") - own).alias("n"))))
    return (d.select("part", "good", "toxic", two.alias("x")).where("x.n > 0")
             .groupBy("part", "x.mask", "good", "toxic").agg(F.sum("x.n").alias("n")))


def fold(cell: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Cells as one row per part, order and step: the counts of the step's filter."""
    orders = F.array(*[F.array(*[F.lit(filters.index(f)) for f in p]) for p in permutations(filters)])
    zero = F.lit(0).cast("long")
    n, good, toxic = F.col("n"), F.when(F.col("good"), F.col("n")).otherwise(zero), F.when(F.col("toxic"), F.col("n")).otherwise(zero)

    def step(acc: Column, f: Column) -> Column:
        """acc: (alive, structs so far); one filter further."""
        fails = F.get(F.array(*[F.col("mask").bitwiseAND(F.lit(1 << i)) != 0 for i in range(len(filters))]), f)
        alone = F.get(F.array(*[F.col("mask") == F.lit(1 << i) for i in range(len(filters))]), f)
        here = acc["alive"] & fails
        after = acc["alive"] & ~fails
        one = F.struct(F.when(after, n).otherwise(zero).alias("kept"), F.when(here, n).otherwise(zero).alias("removed"),
                       F.when(fails & ~acc["alive"], n).otherwise(zero).alias("redundant"), F.when(alone, n).otherwise(zero).alias("unique_fails"),
                       F.when(here, good).otherwise(zero).alias("good_lost"), F.when(here, toxic).otherwise(zero).alias("toxic_lost"))
        return F.struct(after.alias("alive"), F.concat(acc["steps"], F.array(one)).alias("steps"))

    kind = "array<struct<" + ", ".join(f"{c}: bigint" for c in COUNTS) + ">>"
    start = F.struct(F.lit(True).alias("alive"), F.array().cast(kind).alias("steps"))
    walked = F.flatten(F.transform(orders, lambda o: F.aggregate(o, start, step, lambda acc: acc["steps"])))
    k = len(filters)
    rows = cell.select("part", F.posexplode(walked).alias("pos", "x"))
    merged = rows.groupBy("part", "pos").agg(*[F.sum(f"x.{c}").alias(c) for c in COUNTS])
    names = F.array(*[F.lit("".join(p)) for p in permutations(filters)])
    return merged.select("part", F.get(names, F.floor(F.col("pos") / k).cast("int")).alias("filter_order"),
                         (F.col("pos") % k + 1).cast("int").alias("step"), *COUNTS)


def audit(docs: DataFrame, labels: DataFrame, part: Column, filters: str = FILTERS, failures=text_failures, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """part, filter_order, step, the counts of COUNTS and shapley (what the step's filter removes,
    summed over all orders): one row per part, order and step, zeros included.

    ``filters`` names the bits of the mask; the last one is "same text as a smaller id". A null part is the
    empty string. Null and empty texts are equal; an empty table has no parts and no rows. Other columns of docs
    and labels are not read, so their names can't clash."""
    c = cells(docs.select(F.col(f"`{id_col}`").alias("id"), part.alias("part"), F.col(f"`{text_col}`").alias("text")),
              labels.select("doc_id", "quality", "toxic"), F.col("part"), failures, len(filters) - 1, "id", "text")
    f = fold(c, filters).withColumn("__f", F.expr("substring(filter_order, step, 1)"))
    # one row per order in each window
    whole = F.sum("removed").over(Window.partitionBy("part", "__f"))
    return f.select("part", "filter_order", "step", *COUNTS, whole.alias("shapley"))
