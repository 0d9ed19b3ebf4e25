"""Ranked lexical search with the Best Position Algorithm.

Every task turns its texts, slice by slice, into an index segment: for each term of
the queries a list of the slice's documents, by descending impact (the term's part of
the score), and each document's place in every list. A query reads its lists in
parallel from the top (sorted access). Each document met is scored whole by looking its
place up in all the lists (direct access), and each place that is seen this way,
however deep, is marked. A list's *best position* ends its unbroken run of seen
places: a document not met yet stands behind it in every list, so the sum of the
impacts there bounds its score, more tightly than the places last read would. A query
stops when the bound is strictly below the score of its k-th best; at equality a
document with a smaller id could still come.

The k-th best score of a task's earlier slices is carried on, so later segments stop
earlier. What leaves a task is k rows per query at most; they are merged in two
levels, so no group grows with the number of documents. Term weights need the number of
documents, of terms and of each term's documents over the whole table: a first pass over the texts.

Queries are searched in blocks that bound what is broadcast; each block reads the
documents twice.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trustframe.llm.textarrays import PLAIN, Words, ranges, slices, split_words, text_bytes

#: bytes of text in a segment; a longer text is read in pieces
SLICE = 8 << 20
#: cells (terms of a query x documents) of a segment's table of places
CELLS = 1 << 25
#: queries and terms of a block
BLOCK_ITEMS, BLOCK_TERMS = 4096, 1 << 18
#: first depth of sorted access; doubled with every round
STEP = 64
#: tasks whose results are merged together at the first level
FAN_IN = 256


def terms(text: str | None) -> set[bytes]:
    """Distinct terms of a text: runs of ASCII letters (in lower case), digits and all other characters beyond ASCII."""
    return set(PLAIN[np.frombuffer((text or "").encode(), np.uint8)].tobytes().split())


@dataclass
class Queries:
    """A block of queries over one vocabulary."""
    vocabulary: list[bytes]
    queries: list[np.ndarray]                     # each query's terms, as places in the vocabulary
    words: Words = field(init=False)
    sorted_hash: np.ndarray = field(init=False)
    order: np.ndarray = field(init=False)

    def __post_init__(self):
        buf = np.frombuffer(b" ".join(self.vocabulary), np.uint8)
        self.words = split_words(buf, np.array([0, len(buf)]))
        h = self.words.strong_hashes()
        self.order = np.argsort(h)
        self.sorted_hash = h[self.order]

    def find(self, w: Words) -> np.ndarray:
        """Each word's place in the vocabulary or -1; equal by bytes, not by hash alone."""
        h = w.strong_hashes()
        at = np.searchsorted(self.sorted_hash, h)
        at[at == len(self.order)] = 0
        hit = np.flatnonzero(self.sorted_hash[at] == h)
        place = self.order[at[hit]]
        ok = w.equal(hit, self.words, place)
        found = np.full(len(h), -1, np.int64)
        found[hit[ok]] = place[ok]
        return found


def _blocks(items: DataFrame) -> Iterator[tuple[list, Queries]]:
    """The ids of each block of items (id, text) and its queries. Rows with one id are one query."""
    ids, sets, size = [], [], 0

    def done():
        vocabulary = sorted(set().union(*sets))
        place = {t: i for i, t in enumerate(vocabulary)}
        return ids, Queries(vocabulary, [np.array(sorted(place[t] for t in s), np.int64) for s in sets])

    for r in items.orderBy("id").toLocalIterator():
        t = terms(r["text"])
        if ids and ids[-1] == r["id"]:
            sets[-1] |= t
        else:
            if ids and (len(ids) >= BLOCK_ITEMS or size + len(t) > BLOCK_TERMS):
                yield done()
                ids, sets, size = [], [], 0
            ids.append(r["id"])
            sets.append(t)
        size += len(t)
    if ids:
        yield done()


def _cuts(buf: np.ndarray, lo: int, hi: int, size: int) -> Iterator[tuple[int, int]]:
    """Pieces of a text that end between terms."""
    while lo < hi:
        end = min(lo + size, hi)
        while end < hi:
            gap = PLAIN[buf[end:min(end + 4096, hi)]] == 0x20
            if gap.any():
                end += int(gap.argmax())
                break
            end += len(gap)
        yield lo, end
        lo = end


def _segments(q: Queries, buf: np.ndarray, offs: np.ndarray, max_docs: int, size: int):
    """(first text, terms of each text, text, query term, times) by slices of whole texts;
    (text, term) pairs ascending."""
    v = max(1, len(q.vocabulary))
    for a, b in slices(offs, size):
        if b - a == 1 and offs[b] - offs[a] > 2 * size:
            n, tf = 0, np.zeros(v, np.int64)
            for lo, hi in _cuts(buf, int(offs[a]), int(offs[b]), size):
                w = split_words(buf[lo:hi], np.array([0, hi - lo]), PLAIN)
                n += len(w.start)
                known = q.find(w)
                tf += np.bincount(known[known >= 0], minlength=v)
            t = np.flatnonzero(tf)
            yield a, np.array([n]), np.zeros(len(t), np.int64), t, tf[t]
            continue
        for lo in range(a, b, max_docs):
            hi = min(lo + max_docs, b)
            w = split_words(buf[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], PLAIN)
            known = q.find(w)
            cell, tf = np.unique((w.text_of() * v + known)[known >= 0], return_counts=True)
            yield lo, w.counts, cell // v, cell % v, tf


def statistics(docs: DataFrame, shared, max_docs: int, size: int) -> DataFrame:
    """(term, n): documents that hold each query term; term -1: documents with any term, -2: all terms."""
    def run(batches):
        q = shared.value
        df, n_docs, n_terms = np.zeros(len(q.vocabulary) + 1, np.int64), 0, 0
        for b in batches:
            for _, n, _, t, _ in _segments(q, *text_bytes(b.column("text")), max_docs, size):
                df += np.bincount(t, minlength=len(df))
                n_docs, n_terms = n_docs + int((n > 0).sum()), n_terms + int(n.sum())
        t = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(t, [-1, -2]), pa.int64()),
                                          pa.array(np.append(df[t], [n_docs, n_terms]), pa.int64())], ["term", "n"])
    return docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))


def best_positions(docs: np.ndarray, impact: np.ndarray, lo: np.ndarray, hi: np.ndarray, n_docs: int, tie: np.ndarray, k: int,
                   floor: int = 0, step: int = STEP, trace: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The k best documents of the lists [lo[i], hi[i]) of ``docs``, each by descending ``impact``: (document,
    score), scores above 0 and not below ``floor``, by descending score, then ascending ``tie``. ``trace`` gets
    the numbers of documents met and of places the bound left unread."""
    size = hi - lo
    lo, size = lo[size > 0], size[size > 0]
    got_d, got_s = np.zeros(0, np.int64), np.zeros(0, np.int64)
    need = max(floor, 1)
    if not len(lo) or int(impact[lo].sum()) < need:
        return got_d, got_s
    base = np.cumsum(size) - size
    every = ranges(lo, size)
    place = np.full((len(lo), n_docs), -1, np.int32)
    place[np.repeat(np.arange(len(lo)), size), docs[every]] = np.arange(len(every)) - np.repeat(base, size)
    seen, met = np.zeros(len(every), bool), np.zeros(n_docs, bool)
    best = np.zeros(len(lo), np.int64)  # first place not seen
    depth = 0
    while True:
        # sorted access: the next places of all lists
        at = np.maximum(best, depth)
        d = np.unique(docs[ranges(lo + at, np.clip(depth + step - at, 0, np.maximum(size - at, 0)))])
        d = d[~met[d]]
        met[d] = True
        # direct access: their places in all lists
        p = place[:, d]
        i, j = np.nonzero(p >= 0)
        at = p[i, j]
        seen[base[i] + at] = True
        score = np.zeros(len(d), np.int64)
        np.add.at(score, j, impact[lo[i] + at])
        ok = score >= need
        got_d, got_s = np.concatenate([got_d, d[ok]]), np.concatenate([got_s, score[ok]])
        if len(got_d) > k:
            top = np.lexsort((tie[got_d], -got_s))[:k]
            got_d, got_s = got_d[top], got_s[top]
        if len(got_d) == k:
            need = max(need, int(got_s.min()))
        for x in np.flatnonzero(best < size):
            run = seen[base[x] + best[x]:base[x] + size[x]]
            first = int(run.argmin())
            best[x] = size[x] if run[first] else best[x] + first
        open_ = best < size
        if not open_.any() or int(impact[(lo + best)[open_]].sum()) < need:
            break
        depth, step = depth + step, 2 * step
    if trace is not None:
        trace["met"] = trace.get("met", 0) + int(met.sum())
        trace["unread"] = trace.get("unread", 0) + int((size - best).sum())
    top = np.lexsort((tie[got_d], -got_s))
    return got_d[top], got_s[top]


def _keep_best(rows: pa.Table, k: int) -> pa.Table:
    """The k best rows of each item: by descending score, then ascending id, null last."""
    at = pc.sort_indices(rows, [("item", "ascending"), ("score", "descending"), ("id", "ascending")])
    rows = rows.take(at)
    item = rows.column("item").to_numpy()
    first = np.searchsorted(item, item)
    return rows.filter(pa.array(np.arange(len(item)) - first < k))


def _candidates(docs: DataFrame, shared, weights: np.ndarray, n_docs: int, n_terms: int, k: int, max_docs: int, size: int) -> DataFrame:
    """(item, score, id, task): at most k rows per item and task."""
    def run(batches):
        q = shared.value
        floor, kept, fresh = np.zeros(len(q.queries), np.int64), [], 0
        for b in batches:
            ids = b.column("id")
            tie = np.empty(b.num_rows, np.int64)
            tie[pc.sort_indices(ids).to_numpy()] = np.arange(b.num_rows)
            for first, n, d, t, tf in _segments(q, *text_bytes(b.column("text")), max_docs, size):
                # whole numbers of any size: 90 n N can pass 64 bits
                m = (90 * n_docs * n.astype(object) // n_terms + 10).astype(np.int64)
                part = weights[t] * (1_000_000_000 * tf // (1000 * tf + 8 * m[d]))
                order = np.lexsort((-part, t))
                d, part = d[order], part[order]
                ends = np.searchsorted(t[order], np.arange(len(q.vocabulary) + 1))
                for i, of in enumerate(q.queries):
                    x, s = best_positions(d, part, ends[of], ends[of + 1], len(n), tie[first:first + len(n)], k, int(floor[i]))
                    if len(x):
                        kept.append((i, s, ids.take(pa.array(first + x))))
                        fresh += len(x)
                if fresh >= 4 * k * len(q.queries):
                    kept, fresh = [_merge(kept, k, floor)], 0
        if kept:
            out = _merge(kept, k, floor)
            task = pa.array(np.full(out.num_rows, TaskContext.get().partitionId()), pa.int32())
            yield from out.append_column("task", task).combine_chunks().to_batches()

    schema = docs.select("id").schema
    out = "item int, score long, id " + schema["id"].dataType.simpleString() + ", task int"
    return docs.select("id", "text").mapInArrow(run, out)


def _merge(kept: list, k: int, floor: np.ndarray) -> pa.Table:
    """One table of the tables and (item, scores, ids) in ``kept``; raises ``floor`` to each item's k-th score."""
    tables = [x if isinstance(x, pa.Table) else pa.table(
        {"item": pa.array(np.full(len(x[1]), x[0], np.int32)), "score": pa.array(x[1], pa.int64()), "id": x[2]}) for x in kept]
    out = _keep_best(pa.concat_tables(tables), k)
    item, score = out.column("item").to_numpy(), out.column("score").to_numpy()
    last = np.flatnonzero(np.arange(len(item)) - np.searchsorted(item, item) == k - 1)
    floor[item[last]] = score[last]
    return out


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", size: int = SLICE) -> DataFrame:
    """The k best rows of docs for each item: item_id, rank (from 1), doc_id, score.

    A row's score sums, over the item's distinct terms, w * (10^9 tf div (1000 tf + 8 m)); w = floor(1000 ln((2 N + 2) /
    (2 df + 1))), m = 10 + 90 n N div L, with N rows that have a term, L their terms, n a row's terms. Only scores
    above 0; equal ones by ascending doc_id, null last; equal rows are ranked each. A null or empty text has no
    terms and is in no result; an item without terms has no rows. Items with one id are one query; a null id is an
    id. Texts are read whole, in pieces beyond 2 ``size`` bytes. Only the named columns are read, so others can't clash."""
    spark = docs.sparkSession
    d = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    it = items.select(F.col(f"`{item_col}`").alias("id"), F.col(f"`{item_text_col}`").alias("text"))
    found = spark.createDataFrame([], "item_id " + it.schema["id"].dataType.simpleString() + ", rank int, doc_id "
                                  + d.schema["id"].dataType.simpleString() + ", score long")
    by = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    for ids, q in _blocks(it):
        if not q.vocabulary:
            continue
        shared = spark.sparkContext.broadcast(q)
        max_docs = max(1, CELLS // max(len(x) for x in q.queries))
        n = {r["term"]: r["n"] for r in statistics(d, shared, max_docs, size).collect()}  # one row per query term
        if not n.get(-1):
            continue
        w = np.array([math.floor(1000 * math.log((2 * n[-1] + 2) / (2 * n.get(t, 0) + 1))) for t in range(len(q.vocabulary))], np.int64)
        c = _candidates(d, shared, w, n[-1], n[-2], k, max_docs, size)
        for group in (["item", F.floor(F.col("task") / FAN_IN)], ["item"]):
            c = c.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*by))).where(F.col("rank") <= k)
        names = spark.createDataFrame(list(enumerate(ids)), "item int, item_id " + it.schema["id"].dataType.simpleString())
        found = found.unionByName(c.join(F.broadcast(names), "item").select("item_id", "rank", F.col("id").alias("doc_id"), "score"))
    return found
