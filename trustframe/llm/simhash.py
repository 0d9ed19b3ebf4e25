"""SimHash near-duplicates by anchor-point covering.

Fingerprints that differ in at most ``d`` bits are found exactly, without
comparing all pairs. The 64 bits are cut into ``blocks`` parts; of a linked
pair, at least one part differs in at most ``t = d // blocks`` bits. In each
part the words of a covering code are the anchors: the Hamming code on the
part's first 15 bits (31 bits when the parts have 32) and every value of the
bits left, so each point lies within R = 1 of an anchor. A fingerprint is
replicated to every anchor within R + t of it; the anchor nearest to it is its
home. For a linked pair x, y that part puts y within R + t of x's home, so
comparing, per anchor, the fingerprints at home there with all that came there
meets every link.

Work per anchor: equal fingerprints are one row beforehand; an anchor that is
home to many (a crowd of near copies) deals its home rows to several salts and
sends its visitors to each; a task emits a spanning forest of the links that it
finds, never all pairs. Components come from star rounds over those forests.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustframe.llm.frames import components, free_names, local_ranks
from trustframe.llm.textarrays import LOWER, slices, split_words, text_bytes
from trustframe.session import cut_lineage

BITS = 64
_CHUNK = 1 << 20


# ---- fingerprints ---------------------------------------------------------

def _fingerprints(col: pa.Array, k: int) -> np.ndarray:
    """One uint64 per text; the whole text is read, in slices of whole texts."""
    buf, offs = text_bytes(col)
    out = np.zeros(len(offs) - 1, np.uint64)
    for lo, hi in slices(offs, _CHUNK):
        w = split_words(buf[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], LOWER)
        if not len(w.start):
            continue
        # words of a text one space apart
        non = np.zeros(len(w.buf) + 1, np.int8)
        np.add.at(non, w.start, 1)
        np.add.at(non, w.end, -1)
        inside = np.cumsum(non[:-1]).astype(bool)
        length = w.end - w.start
        keep = inside.copy()
        gap = w.end[:-1][np.diff(w.text_of()) == 0]
        keep[gap] = True
        b = w.buf.copy()
        b[gap] = 0x20
        data = b[keep].tobytes()
        at = np.cumsum(keep) - 1
        start = at[w.start]
        end = start + length
        n = w.counts
        shingles = np.where(n == 0, 0, np.maximum(n - k + 1, 1))
        text = np.repeat(np.arange(hi - lo), shingles)
        first = w.first[:-1][text] + np.arange(len(text)) - np.repeat(np.cumsum(shingles) - shingles, shingles)
        last = np.minimum(first + k, w.first[1:][text]) - 1
        s, e = start[first], end[last]
        ones = np.zeros((hi - lo, BITS), np.int64)
        digest = xxhash.xxh64_intdigest
        for a in range(0, len(s), 1 << 18):  # bounds memory for very long texts
            z = min(a + (1 << 18), len(s))
            h = np.fromiter((digest(data[i:j], 42) for i, j in zip(s[a:z].tolist(), e[a:z].tolist())),
                            np.uint64, z - a)
            bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            t = text[a:z]
            heads = np.flatnonzero(np.r_[True, t[1:] != t[:-1]])
            ones[t[heads]] += np.add.reduceat(bits, heads, axis=0, dtype=np.int64)
        out[lo:hi] = np.packbits(2 * ones > shingles[:, None], axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def with_fingerprint(docs: DataFrame, text_col: str = "text", k: int = 4, name: str = "fp",
                     columns: list[str] | None = None) -> DataFrame:
    """``columns`` of docs (all by default) and ``name``: the SimHash of the
    text's k-word shingles as a signed long. A null or empty text has 0."""
    columns = docs.columns if columns is None else columns
    src = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*columns, text_col])])
    schema = docs.select(*[F.col(f"`{c}`") for c in columns]).schema.add(name, "long")

    def run(batches):
        for b in batches:
            fp = _fingerprints(b.column(text_col), k).view(np.int64)
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in columns], pa.array(fp)], [*columns, name])

    return src.mapInArrow(run, schema)


# ---- covering code --------------------------------------------------------
#: fingerprints from which on two parts are cheaper than three
MANY = 200_000_000


def _hamming(values: np.ndarray, m: int) -> np.ndarray:
    """Syndrome in the Hamming code of length 2^m - 1: 0 for code words, else
    the (1-based) bit whose flip gives the nearest code word."""
    s = np.zeros(len(values), np.int64)
    for bit in range((1 << m) - 1):
        s ^= np.where((values >> bit) & 1 == 1, bit + 1, 0)
    return s


@lru_cache
def _layout(blocks: int) -> tuple[tuple[int, int, int], ...]:
    """(first bit, bits, m of the Hamming code) of each part."""
    cuts = [round(i * BITS / blocks) for i in range(blocks + 1)]
    return tuple((a, b - a, 5 if b - a >= 31 else 4) for a, b in zip(cuts, cuts[1:]))


@lru_cache
def _flips(n: int, at_most: int) -> np.ndarray:
    """Every mask of n bits with at most so many ones."""
    masks = [0]
    level = [0]
    for _ in range(at_most):
        level = sorted({m | 1 << b for m in level for b in range(n) if not m >> b & 1})
        masks += level
    return np.array(masks, np.int64)


def _homes(fp: np.ndarray, part: tuple[int, int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(low bits, bits above, syndrome, home anchor) of each fingerprint's part; the home is the nearest code word."""
    first, bits, m = part
    n = (1 << m) - 1
    x = ((fp >> np.uint64(first)) & np.uint64((1 << bits) - 1)).astype(np.int64)
    low, high = x & ((1 << n) - 1), x >> n
    synd = _hamming(low, m)
    return low, high, synd, np.where(synd > 0, low ^ (1 << np.maximum(synd - 1, 0)), low) | (high << n)


def anchors(fp: np.ndarray, part: tuple[int, int, int], reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, home?) for every anchor within ``reach`` of each
    fingerprint's part. An anchor of the part is a Hamming code word in the low
    bits and any value above."""
    _, bits, m = part
    n = (1 << m) - 1
    low, high, synd, home = _homes(fp, part)
    rows, found = [], []
    up = _flips(bits - n, min(reach, bits - n))
    up_d = np.bitwise_count(up)
    # code words within r of low: flips f with syndrome(f) == syndrome(low)
    for r in range(reach + 1):
        flips = _flips(n, r)
        flips = flips[np.bitwise_count(flips) == r]
        by = _hamming(flips, m)
        order = np.argsort(by, kind="stable")
        flips, count = flips[order], np.bincount(by, minlength=n + 1)
        base = np.cumsum(count) - count
        k = count[synd]
        row = np.repeat(np.arange(len(low)), k)
        near = low[row] ^ flips[np.repeat(base[synd], k) + np.arange(len(row)) - np.repeat(np.cumsum(k) - k, k)]
        for u in up[up_d <= reach - r]:
            rows.append(row)
            found.append(near | ((high[row] ^ u) << n))
    row, anchor = np.concatenate(rows), np.concatenate(found)
    return row, anchor, anchor == home[row]


def _anchor_rows(fps: DataFrame, d: int, blocks: int) -> DataFrame:
    parts, reach = _layout(blocks), 1 + d // blocks

    def run(batches):
        for b in batches:
            fp_all = np.asarray(b.column("fp")).view(np.uint64)
            for at in range(0, len(fp_all), 4096):
                fp = fp_all[at:at + 4096]
                for i, part in enumerate(parts):
                    row, anchor, home = anchors(fp, part, reach)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchor * len(parts) + i), pa.array(fp[row].view(np.int64)), pa.array(home)],
                        ["anchor", "fp", "home"])

    return fps.select("fp").mapInArrow(run, "anchor long, fp long, home boolean")


def _home_counts(fps: DataFrame, blocks: int) -> DataFrame:
    """(anchor, count) of home rows: one row a fingerprint and part, summed in its task before the shuffle."""
    parts = _layout(blocks)

    def run(batches):
        for b in batches:
            fp = np.asarray(b.column("fp")).view(np.uint64)
            for i, part in enumerate(parts):
                key, n = np.unique(_homes(fp, part)[3] * len(parts) + i, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], ["anchor", "n"])

    return fps.select("fp").mapInArrow(run, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("count"))


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node of its component) that span the links a-b."""
    nodes, idx = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = idx[:len(a)], idx[len(a):]
    lab = np.arange(len(nodes))
    while True:
        low = np.minimum(lab[u], lab[v])
        new = lab.copy()
        np.minimum.at(new, lab[u], low)
        np.minimum.at(new, lab[v], low)
        np.minimum.at(new, u, low)
        np.minimum.at(new, v, low)
        new = new[new]
        if (new == lab).all():
            break
        lab = new
    far = lab != np.arange(len(nodes))
    return nodes[far], nodes[lab[far]]


def _compare(d: int):
    """Home rows come first within (anchor, salt); visitors are compared with
    them in slices, so memory holds one salt's homes and a slice of pairs."""
    def run(batches):
        hk, hf = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        ha = np.zeros(0, np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            key = np.asarray(b.column("anchor"))
            salt = np.asarray(b.column("salt")).astype(np.int64)
            fp = np.asarray(b.column("fp")).view(np.uint64)
            home = b.column("home").to_numpy(zero_copy_only=False)
            # number the (anchor, salt) groups of carried homes and this batch in order
            k_all, s_all = np.concatenate([hk, key]), np.concatenate([ha, salt])
            grp = np.cumsum(np.r_[False, (k_all[1:] != k_all[:-1]) | (s_all[1:] != s_all[:-1])])
            hg = np.concatenate([grp[:len(hk)], grp[len(hk):][home]])
            homes = np.concatenate([hf, fp[home]])
            vg = grp[len(hk):]
            lo, hi = np.searchsorted(hg, vg), np.searchsorted(hg, vg, "right")
            n = hi - lo
            ends = np.cumsum(n)
            at, ea, eb = 0, [], []
            while at < len(n):
                z = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + (1 << 20), "right")))
                row = np.repeat(np.arange(at, z), n[at:z])
                if len(row):
                    other = homes[lo[row] + np.arange(len(row)) - np.repeat(ends[at:z] - n[at:z] - (ends[at - 1] if at else 0), n[at:z])]
                    own = fp[row]
                    hit = (np.bitwise_count(own ^ other) <= d) & (own != other)
                    ea.append(own[hit].view(np.int64))
                    eb.append(other[hit].view(np.int64))
                    if sum(map(len, ea)) > 1 << 20:
                        ea, eb = map(lambda x: [x], _forest(np.concatenate(ea), np.concatenate(eb)))
                at = z
            if ea and sum(map(len, ea)):
                u, v = _forest(np.concatenate(ea), np.concatenate(eb))
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])
            keep = hg == grp[-1]
            hf = homes[keep]
            hk, ha = np.full(len(hf), key[-1]), np.full(len(hf), salt[-1])
    return run


def links(fps: DataFrame, d: int = 4, blocks: int | None = None, home_rows: int = 2048, many: int = MANY) -> DataFrame:
    """Edges (u, v) that connect the distinct fingerprints ``fps`` (column fp:
    long; a written table, since it is read three times) exactly as "at most d bits
    apart" does. ``blocks`` trades replicas for comparisons, the links are the same:
    3 makes about 46 anchor rows a fingerprint, over some 500,000 anchors; 2 about 340, over some
    500 million, so that each meets few others. By default 2 from ``many`` fingerprints on, where with 3
    the home rows of an anchor would pass a thousand. An anchor with more than ``home_rows`` home rows is split."""
    if blocks is None:
        blocks = 3 if fps.count() < many else 2
    rows = _anchor_rows(fps, d, blocks)
    hot = cut_lineage(_home_counts(fps, blocks).where(F.col("count") > home_rows)
                      .select("anchor", F.ceil(F.col("count") / home_rows).cast("int").alias("salts")))
    n_hot = hot.count()
    if n_hot:
        hot = F.broadcast(hot) if n_hot <= 100_000 else hot
        one = F.pmod(F.xxhash64("fp"), F.col("salts")).cast("int")
        rows = rows.join(hot, "anchor", "left").select(
            "anchor", "fp", "home",
            F.when(F.col("salts").isNull(), F.array(F.lit(0)))
             .otherwise(F.sequence(F.lit(0), F.col("salts") - 1)).alias("to"), one.alias("own"))
        rows = rows.select("anchor", "fp", (F.col("home")).alias("h"), F.explode("to").alias("salt"), "own")
        # a home row is compared from its own salt; elsewhere it comes as a visitor
        rows = rows.select("anchor", "salt", "fp", (F.col("h") & (F.coalesce("own", F.lit(0)) == F.col("salt"))).alias("home"))
    else:
        rows = rows.select("anchor", F.lit(0).alias("salt"), "fp", "home")
    near = rows.repartition("anchor", "salt").sortWithinPartitions("anchor", "salt", F.desc("home"))
    return near.mapInArrow(_compare(d), "u long, v long")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, d: int = 4,
            blocks: int | None = None, extra: list[str] | None = None) -> DataFrame:
    """(id, fp, component_id, root, *extra) for every row of docs: component_id is the smallest
    id among the rows whose fingerprints are reachable over links of at most ``d``
    bits; root, the smallest of these fingerprints, tells components apart even
    where an id is repeated with another text.

    Null or empty texts have fingerprint 0 and are linked like any other.
    Repeated rows share a fingerprint; a null id never names a component unless
    all ids of the component are null. ``docs`` may have any other columns."""
    extra = extra or []
    own = cut_lineage(with_fingerprint(docs, text_col, k, "__fp", [id_col, *extra]))
    own = own.select(F.col(f"`{id_col}`").alias("__id"), F.col("__fp").alias("fp"), *[F.col(f"`{c}`") for c in extra])
    fps = cut_lineage(own.groupBy("fp").agg(F.min("__id").alias("rep")))
    comp = components(links(fps, d, blocks))
    root = fps.join(comp, fps.fp == comp.node, "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    # one row per fingerprint that has links gets its component's smallest id
    smallest = root.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = root.join(smallest, "root").select("fp", "component_id", "root")
    return own.join(named, "fp").select(F.col("__id").alias(id_col), "fp", "component_id", "root", *extra)


def fingerprint_hex(fp) -> F.Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, d: int = 4,
             blocks: int | None = None) -> DataFrame:
    """The columns of docs for one row of each component: the row with the
    smallest id (nulls last; of rows with that id, the first written)."""
    part, rank = free_names(docs, "__part", "__rank")
    rows = local_ranks(docs, None, part, rank)
    cls = classes(rows, id_col, text_col, k, d, blocks, extra=[part, rank])
    key = F.struct(F.coalesce(F.col(f"`{id_col}`"), F.lit((1 << 63) - 1)).alias("i"), F.col(part), F.col(rank))
    first = cls.withColumn("__key", key).groupBy("root").agg(F.min("__key").alias("__key"))
    kept = first.select(F.col(f"__key.{part}").alias(part), F.col(f"__key.{rank}").alias(rank))
    return rows.join(kept, [part, rank], "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
