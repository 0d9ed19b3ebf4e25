"""Mixing sources to target weights: hierarchical budgets and token prefixes.

The sources form a tree: domain, language, source (the leaf). Weights are given
on each level. A budget of tokens flows down from the root: a node's children
share it by weight, but none gets more than it can supply (its tokens times
the epochs allowed); what a short child leaves goes to its siblings by weight,
and only what all siblings cannot supply is left to the level above, as a
node's supply is the sum of its children's. So shortages are met by siblings before
ancestors. Each leaf then takes its documents in the order of a seeded hash, one
permutation per epoch: whole epochs first, then the prefix whose tokens come
nearest to the rest of its budget.

All shares are exact integers (largest remainder), so the result does not
depend on the order of rows or on partitions. A leaf that holds a third of all rows
is not sorted in one task: its hash order is cut into ranges, the ranges'
tokens are summed first, and only the range where the prefix ends is summed row by row.

DataFrame functions throughout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trustframe.llm.frames import free_names
from trustframe.session import cut_lineage

LEVELS = ("domain", "lang", "source")
RANGE_DIGITS = 3  # hash order is cut into 16^3 ranges per leaf and epoch
_D = "decimal(38,0)"


def n_tokens(text: Column) -> Column:
    """Words of the text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def _share(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Water-filling among siblings: ``nodes`` has parent columns, ``name``,
    supply, weight and the parent's budget; adds own ``budget``.

    Sorted by supply / weight, a child is short if its supply is at most its
    share of what the children before it leave. The others share the rest by
    weight, rounded down, and the largest remainders get the tokens left over."""
    w = Window.partitionBy(*parent)
    by = w.orderBy((F.col("supply") / F.col("weight")).asc(), F.col(name).asc())
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    x = (nodes.withColumn("spent", F.coalesce(F.sum("supply").over(before), F.lit(0)).cast(_D))
         .withColumn("w_left", (F.sum("weight").over(w) - F.coalesce(F.sum("weight").over(before), F.lit(0))).cast(_D))
         .withColumn("short", F.col("supply").cast(_D) * F.col("w_left") <= (F.col("up") - F.col("spent")) * F.col("weight")))
    x = (x.withColumn("rest", (F.col("up") - F.sum(F.when(F.col("short"), F.col("supply")).otherwise(0)).over(w)).cast(_D))
         .withColumn("w_rest", F.sum(F.when(~F.col("short"), F.col("weight")).otherwise(0)).over(w).cast(_D)))
    part = F.col("rest") * F.col("weight")
    x = (x.withColumn("part", F.when(F.col("short"), F.col("supply").cast("long"))
                      .otherwise(((part - part % F.col("w_rest")) / F.col("w_rest")).cast("long")))
         .withColumn("rem", F.when(F.col("short"), F.lit(-1)).otherwise(part % F.col("w_rest")).cast(_D)))
    extra = F.greatest(F.lit(0), F.least(F.col("up"), F.sum("supply").over(w)) - F.sum("part").over(w))
    turn = F.row_number().over(w.orderBy(F.col("rem").desc(), F.col(name).asc()))
    return x.withColumn("budget", F.col("part") + F.when(~F.col("short") & (turn <= extra), 1).otherwise(0)).drop(
        "spent", "w_left", "short", "rest", "w_rest", "part", "rem", "up", "supply", "weight")


def _eq(a: list[str], b: list[str]) -> Column:
    cond = F.lit(True)
    for x, y in zip(a, b):
        cond = cond & F.col(x).eqNullSafe(F.col(y))
    return cond


def leaf_budgets(supply: DataFrame, share: tuple[int, int], max_epochs: int, weight: dict[str, Column]) -> DataFrame:
    """(domain, lang, source, budget) from ``supply`` (domain, lang, source,
    tokens). ``weight``: each level's integer weight (1 or more) as an expression over the
    level's and its ancestors' columns; the root's budget is share[0] / share[1]
    of all tokens, rounded down."""
    leaves = cut_lineage(supply.withColumn("supply", F.col("tokens") * max_epochs))
    total = leaves.agg(F.sum("tokens")).first()[0] or 0  # one number
    a = leaves.groupBy("domain").agg(F.sum("supply").alias("supply"))
    a = _share(a.withColumn("weight", weight["domain"]).withColumn("up", F.lit(total * share[0] // share[1])).withColumn("root", F.lit(0)),
               ["root"], "domain").select(F.col("domain").alias("d"), F.col("budget").alias("up"))
    b = leaves.groupBy("domain", "lang").agg(F.sum("supply").alias("supply"))
    b = b.join(a, _eq(["domain"], ["d"])).drop("d").withColumn("weight", weight["lang"])
    b = _share(b, ["domain"], "lang").select(F.col("domain").alias("d"), F.col("lang").alias("l"), F.col("budget").alias("up"))
    c = leaves.join(b, _eq(["domain", "lang"], ["d", "l"])).drop("d", "l").withColumn("weight", weight["source"])
    return _share(c, ["domain", "lang"], "source").select(*LEVELS, "tokens", "budget")


def select_mix(docs: DataFrame, domain: Column, weight: dict[str, Column], share: tuple[int, int], max_epochs: int = 4,
               seed: int = 42, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
               source_col: str = "source", columns: list[str] | None = None) -> DataFrame:
    """``columns`` of docs (all by default), once for every epoch that selects the
    row, with epoch (int), tokens and leaf_budget (long).

    Order within an epoch: md5 of seed, epoch and id, then md5 of the text. Rows
    equal in id and text are alike and go together, as one entry. An entry
    on the edge is taken if the leaf comes at least as near to its budget with it as
    without. A null domain, language or source is a branch of its own; a row
    without tokens is taken if it comes before the edge. Clashing names get a
    leading "_"."""
    columns = docs.columns if columns is None else columns
    own = [f"__c{i}" for i in range(len(columns))]  # so that no column of docs clashes
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(*[F.col(f"`{c}`").alias(o) for c, o in zip(columns, own)],
                       F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"),
                       F.md5(text.cast("binary")).alias("th"), n_tokens(text).alias("tokens"), domain.alias("domain"),
                       F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{source_col}`").alias("source"))
    # ids, hashes and counts, written once: the passes below don't read the texts again
    thin = cut_lineage(rows.select("id", "th", "tokens", *LEVELS))
    supply = thin.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"))
    budgets = cut_lineage(leaf_budgets(supply, share, max_epochs, weight)
                          .select(*[F.col(c).alias(f"b_{c}") for c in LEVELS], F.col("tokens").alias("all_tokens"), "budget"))
    small = budgets.count() * max_epochs <= 100_000  # leaves, not rows

    def epochs(x: DataFrame) -> DataFrame:
        """A row for each epoch that the leaf needs; ``need``: tokens to take in it."""
        b = F.broadcast(budgets) if small else budgets
        x = x.join(b, _eq(list(LEVELS), [f"b_{c}" for c in LEVELS])).drop(*[f"b_{c}" for c in LEVELS])
        e = F.filter(F.sequence(F.lit(0), F.lit(max_epochs - 1)), lambda e: F.col("all_tokens") * e < F.col("budget"))
        x = x.withColumn("epoch", F.explode(e)).withColumn("need", F.col("budget") - F.col("all_tokens") * F.col("epoch"))
        key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epoch").cast("string"), "id").cast("binary"))
        return x.withColumn("key", key).withColumn("range", F.substring("key", 1, RANGE_DIGITS))

    at = [*LEVELS, "epoch"]

    def joined(x: DataFrame, y: DataFrame, prefix: str, how: str) -> DataFrame:
        y = y.select(*[F.col(c).alias(prefix + c) for c in at], *[c for c in y.columns if c not in at])
        return x.join(F.broadcast(y) if small else y, _eq(at, [prefix + c for c in at]), how).drop(*[prefix + c for c in at])

    partial = epochs(thin).where("need < all_tokens")
    per = partial.groupBy(*at, "range").agg(F.sum("tokens").alias("t"), F.first("need").alias("need"))
    w = Window.partitionBy(*at).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("before", F.coalesce(F.sum("t").over(w), F.lit(0)))
    # the prefix ends in the last range that starts below its need
    ends = per.where("before < need").groupBy(*at).agg(F.max(F.struct("range", "before")).alias("end"))
    cut = joined(partial, ends, "e_", "inner").where("range = end.range")
    entry = cut.groupBy(*at, "key", "th").agg(F.sum("tokens").alias("t"), F.first("need").alias("need"), F.first("end.before").alias("start"))
    run = Window.partitionBy(*at).orderBy("key", "th").rowsBetween(Window.unboundedPreceding, -1)
    entry = entry.withColumn("before", F.col("start") + F.coalesce(F.sum("t").over(run), F.lit(0)))
    last = entry.where("before < need and 2 * before + t <= 2 * need").groupBy(*at).agg(F.max(F.struct("key", "th")).alias("last"))
    # where the first entry of the last range is too long, the prefix ends before the range
    edges = joined(ends, last, "l_", "left").select(*at, F.coalesce("last", F.struct(F.col("end.range").alias("key"), F.lit("").alias("th"))).alias("last"))
    out = joined(epochs(rows), cut_lineage(edges), "x_", "left")
    out = out.where((F.col("need") >= F.col("all_tokens")) | (F.struct("key", "th") <= F.col("last")))
    names = free_names(docs.select(*[F.col(f"`{c}`") for c in columns]), "epoch", "tokens", "leaf_budget")
    return out.select(*[F.col(o).alias(c) for c, o in zip(columns, own)], F.col("epoch").cast("int").alias(names[0]),
                      F.col("tokens").alias(names[1]), F.col("budget").alias(names[2]))
