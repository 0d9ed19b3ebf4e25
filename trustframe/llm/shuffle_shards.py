"""Uniform shuffle into shards of exact sizes by a hypergeometric
communication matrix.

1. Each writing task permutes its rows locally (a seeded hash of a row's columns and
   of its number orders them, so equal rows part too) and writes them once; (part, rank) names a row from then on.
2. Under a uniform shuffle, the number of rows that each part sends to each shard
   is a random table with fixed margins: the parts' counts and the shards'
   sizes. It is drawn exactly by halving: the rows that a range of parts sends to
   each shard are split between its two halves by a multivariate hypergeometric
   draw, shard after shard, each draw by inversion from the mode. The draws of
   one level are independent rows of a DataFrame, so a level is one narrow
   projection.
3. A row's rank in its part's permutation and the part's running counts give the
   shard: that is the exchange. A second seeded hash permutes the rows inside
   each shard; the slot is the place in that order, counted per (shard, hash
   range) first so that no task sorts a whole shard.

DataFrame functions only. The matrix has parts x shards cells, held as one
array of shards per part.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trustframe.llm.frames import free_names, local_ranks
from trustframe.session import cut_lineage

#: beyond so many standard deviations from the mode a double holds no mass
REACH = 12


def _uniform(*key: Column) -> Column:
    """In (0, 1), from a hash of the key."""
    return (F.shiftrightunsigned(F.xxhash64(*key), 12).cast("double") + 0.5) / float(1 << 52)


def _ln_fact(n: Column) -> Column:
    """ln n!, to double precision: Stirling's series at n + 8, less the factors added."""
    x = n.cast("double") + 9.0
    extra = F.log(x - 1) + F.log(x - 2) + F.log(x - 3) + F.log(x - 4) + F.log(x - 5) + F.log(x - 6) + F.log(x - 7) + F.log(x - 8)
    return ((x - 0.5) * F.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x * x * x)
            + 1 / (1260 * x * x * x * x * x) - extra)


def hypergeometric(good: Column, bad: Column, draws: Column, u: Column) -> Column:
    """Rows of ``good`` among ``draws`` from good + bad without replacement, by
    inversion: probabilities are summed from the mode outwards until they pass
    ``u``. Every input is a long but u, a double in (0, 1)."""
    lo = F.greatest(F.lit(0).cast("long"), draws - bad)
    hi = F.least(good, draws)
    n = (good + bad).cast("double")
    mode = F.greatest(lo, F.least(hi, F.floor((draws + 1).cast("double") * (good + 1).cast("double") / (n + 2)).cast("long")))
    sd = F.sqrt(draws.cast("double") * (good / n) * (bad / n) * ((n - draws) / F.greatest(n - 1, F.lit(1.0))))
    steps = F.least(F.greatest(hi - mode, mode - lo), F.ceil(REACH * sd).cast("long") + 16)
    p0 = F.exp(_ln_fact(good) + _ln_fact(bad) + _ln_fact(draws) + _ln_fact(good + bad - draws)
               - _ln_fact(good + bad) - _ln_fact(mode) - _ln_fact(good - mode) - _ln_fact(draws - mode) - _ln_fact(bad - draws + mode))
    # bound once: the walk below names them at every step
    bound = F.struct(good.alias("g"), bad.alias("b"), draws.alias("d"), u.alias("u"), mode.alias("m"), steps.alias("s"), p0.alias("p"))

    def walk(x: Column) -> Column:
        start = F.struct((x.u - x.p).alias("left"), x.p.alias("up"), x.p.alias("down"),
                         F.when(x.u < x.p, x.m).alias("k"))

        def step(a: Column, i: Column) -> Column:
            k1, k2 = x.m + i, x.m - i
            up = F.when((k1 <= x.g) & (k1 <= x.d), a.up * (x.g - k1 + 1) * (x.d - k1 + 1) / (k1 * (x.b - x.d + k1))).otherwise(F.lit(0.0))
            down = F.when((k2 >= 0) & (x.b - x.d + k2 >= 0),
                          a.down * ((k2 + 1) * (x.b - x.d + k2 + 1)) / ((x.g - k2) * (x.d - k2))).otherwise(F.lit(0.0))
            p = F.struct(up.alias("up"), down.alias("down"))

            def settle(q: Column) -> Column:
                return F.struct((a.left - q.up - q.down).alias("left"), q.up.alias("up"), q.down.alias("down"),
                                F.coalesce(a.k, F.when(a.left < q.up, k1).when(a.left < q.up + q.down, k2)).alias("k"))
            return F.when(a.k.isNotNull(), a).otherwise(F.transform(F.array(p), settle)[0])
        walked = F.aggregate(F.when(x.s >= 1, F.sequence(F.lit(1).cast("long"), x.s)).otherwise(F.array().cast("array<long>")),
                             start, step)
        return F.coalesce(walked.k, x.m)
    return F.transform(F.array(bound), walk)[0]


def _split(cells: Column, total: Column, left: Column, seed: int, node: Column) -> Column:
    """The left half's share of each shard's rows: ``left`` of ``total`` rows are
    drawn without replacement from shards holding ``cells``."""
    start = F.struct(total.cast("long").alias("rest"), left.cast("long").alias("need"),
                     F.array().cast("array<long>").alias("out"))

    def draw(a: Column, c: Column) -> Column:
        u = _uniform(F.lit(seed), node, F.size(a.out))
        x = (F.when((a.need == 0) | (c == 0), F.lit(0).cast("long"))
             .when(a.need == a.rest, c).when(c == a.rest, a.need)
             .otherwise(hypergeometric(c, a.rest - c, a.need, u)))
        return F.transform(F.array(x), lambda k: F.struct(
            (a.rest - c).alias("rest"), (a.need - k).alias("need"), F.array_append(a.out, k).alias("out")))[0]
    return F.aggregate(cells, start, draw)["out"]


def communication_matrix(counts: DataFrame, shards: int, seed: int) -> DataFrame:
    """(part, cells): rows that each part sends to each shard, from
    ``counts`` (part, n). Shard s holds ceil((N - s) / shards) rows, so sizes differ by
    at most one."""
    line = counts.agg(F.sort_array(F.collect_list(F.struct("part", F.col("n").cast("long").alias("n")))).alias("parts"))
    total = F.aggregate("parts", F.lit(0).cast("long"), lambda a, x: a + x.n)
    sizes = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)),
                        lambda s: F.floor((F.col("total") - s + (shards - 1)) / shards).cast("long"))
    at = (line.where(F.size("parts") > 0).withColumn("total", total)
          .select("parts", "total", F.lit(0).cast("long").alias("node"), sizes.alias("cells")))
    levels = max(0, (int(counts.count()) - 1).bit_length())
    for level in range(levels):
        half = F.ceil(F.size("parts") / 2).cast("int")
        mine = at.select("parts", "total", "node", "cells", half.alias("half"))
        mine = mine.withColumn("lp", F.slice("parts", F.lit(1), F.col("half")))
        mine = mine.withColumn("ln", F.aggregate("lp", F.lit(0).cast("long"), lambda a, x: a + x.n))
        mine = mine.withColumn("lc", F.when(F.size("parts") > 1, _split(F.col("cells"), F.col("total"), F.col("ln"), seed, F.col("node") + (1 << 40) * level))
                               .otherwise(F.col("cells")))
        # written: else the next level would draw this one again for each use
        mine = cut_lineage(mine)
        a = F.struct(F.col("lp").alias("parts"), F.col("ln").alias("total"), (F.col("node") * 2).alias("node"), F.col("lc").alias("cells"))
        rest = F.when(F.size("parts") > 1, F.slice("parts", F.col("half") + 1, F.size("parts") - F.col("half"))).otherwise(F.slice("parts", 1, 0))
        b = F.struct(rest.alias("parts"), (F.col("total") - F.col("ln")).alias("total"), (F.col("node") * 2 + 1).alias("node"),
                     F.zip_with("cells", "lc", lambda x, y: x - y).alias("cells"))
        at = mine.select(F.explode(F.array(a, b)).alias("x")).select("x.*").where(F.size("parts") > 0)
        if level >= 6:
            at = at.repartition("node")
    return at.select(F.col("parts")[0]["part"].alias("part"), "cells")


def shuffle_into_shards(docs: DataFrame, shards: int, seed: int = 42, columns: list[str] | None = None,
                        rows_per_range: int = 100_000) -> DataFrame:
    """``columns`` of docs (all by default) with shard and slot (long, from 0 without gaps).

    Every row of docs gets one (shard, slot), repeated rows and rows of nulls
    too; shard sizes differ by at most one; all assignments are equally likely.
    The result depends on how the input is cut into tasks and on the order in which
    a task reads its rows; the numbering is committed once. An empty table gives an empty result. Names
    that clash get a leading "_"."""
    columns = docs.columns if columns is None else columns
    part, rank, shard, slot = free_names(docs, "__part", "__rank", "shard", "slot")
    src = docs.select(*[F.col(f"`{c}`") for c in columns])
    order = F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in columns], F.monotonically_increasing_id())
    rows = local_ranks(src, order, part, rank)
    counts = cut_lineage(rows.groupBy(F.col(part).alias("part")).agg(F.count("*").alias("n")))
    matrix = cut_lineage(communication_matrix(counts, shards, seed + 1))
    # first rank that goes to each shard, per part
    ends = F.aggregate("cells", F.array(F.lit(0).cast("long")), lambda a, c: F.array_append(a, F.element_at(a, -1) + c))
    starts = matrix.select(F.col("part").alias(part), ends.alias("__ends"))
    n_parts = counts.count()
    if n_parts * (shards + 2) * 8 <= 8 << 20:
        starts = F.broadcast(starts)
    to = F.size(F.filter("__ends", lambda e: e <= F.col(rank))) - 1
    sized = cut_lineage(counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))).first()["n"]
    span = max(1, -(-sized // (shards * rows_per_range)))  # hash ranges of a shard
    key = F.xxhash64(F.lit(seed + 2), F.col(part), F.col(rank))

    def placed(names):
        x = rows.select(*[F.col(f"`{c}`") for c in names], part, rank).join(starts, part)
        return x.select(*[F.col(f"`{c}`") for c in names], to.cast("int").alias(shard), key.alias("__key"),
                        F.pmod(key, F.lit(span)).cast("int").alias("__range"))
    sizes = placed([]).groupBy(shard, "__range").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy(shard).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = cut_lineage(sizes.select(shard, "__range", F.coalesce(before, F.lit(0)).alias("__before")))
    if shards * span * 32 <= 8 << 20:
        offsets = F.broadcast(offsets)
    place = F.row_number().over(Window.partitionBy(shard, "__range").orderBy("__key"))
    out = placed(columns).withColumn("__place", place).join(offsets, [shard, "__range"])
    return out.select(*[F.col(f"`{c}`") for c in columns], shard,
                      (F.col("__before") + F.col("__place") - 1).cast("long").alias(slot))
