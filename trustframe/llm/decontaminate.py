"""Benchmark decontamination with a BM25 index of the test items.

Test items are the documents of an inverted index; every training passage is a
query. A passage is a window of words, twice as long as the longest item of
its index shard and half overlapping, so each copy of an item lies whole in one
passage. Scores are BM25, divided by the item's score against itself (1: all
its terms are there). An index shard holds, for each term, its postings
with their impacts, and the largest impact in each block of items. Queries are
answered batch by batch as block-max WAND does it: the sums of a passage's
block maxima bound its scores in each block; only blocks whose bound reaches
the threshold are opened, and there every item is scored in full. All items at
or above the threshold are retrieved, without a limit on their number.

A retrieved item is verified on the passage: at least 0.8 of its distinct
5-word shingles occur there, and at least half of those of its question and half of
those of its answer (an item without such columns is halved by words).

The index grows with the test items alone. It is built in the driver from the
collected items in shards of ``SHARD`` items, whose postings are broadcast; the
number and the bytes of the items are checked first. Words are compared by a 64-bit hash that no two words of
up to 8 bytes share.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType, LongType

from trustframe.llm.textarrays import PLAIN, Words, ranges, slices, split_words, text_bytes, window_hash, window_sums

K1, B = 1.2, 0.75
THRESHOLD = 0.6
OVERLAP, PART_OVERLAP, SHINGLE = 0.8, 0.5, 5
SHARD, BLOCK = 4096, 16
MAX_BYTES = 256 << 20
_SLICE = 1 << 19


@dataclass
class Shard:
    """Index of some items. Terms are 64-bit hashes, sorted; row i of a CSR
    array is term i's."""
    items: list              # item ids
    terms: np.ndarray
    post_at: np.ndarray      # terms + 1
    post_item: np.ndarray    # item number, ascending within a term
    post_impact: np.ndarray  # BM25 part over the item's own score
    block_at: np.ndarray     # terms + 1
    block_id: np.ndarray
    block_max: np.ndarray
    block_post: np.ndarray   # entries + 1: each (term, block)'s first posting
    shingle_at: np.ndarray   # items + 1
    shingles: np.ndarray     # each item's distinct shingle hashes
    part: np.ndarray         # bit 1: in the question, bit 2: in the answer
    passage: int             # words of half a passage
    id_type: DataType = LongType()


def _shingles(w: Words, sums: np.ndarray, lo: int, hi: int) -> np.ndarray:
    n = max(1, hi - lo - SHINGLE + 1)
    at = lo + np.arange(n)
    return np.unique(window_hash(sums, at, np.minimum(at + SHINGLE, hi)))


@dataclass
class Stats:
    """What BM25 weighs by, over all items of all shards."""
    n: int             # items with a word
    words: int         # their words
    terms: np.ndarray  # term hashes, ascending
    df: np.ndarray     # items that hold each

    def frequency(self, terms: np.ndarray) -> np.ndarray:
        return self.df[np.searchsorted(self.terms, terms)]


def statistics(parsed: list) -> Stats:
    rows = [r for r in parsed if r is not None]
    terms, df = np.unique(np.concatenate([np.unique(r[0]) for r in rows] or [np.zeros(0, np.uint64)]), return_counts=True)
    return Stats(len(rows), sum(len(r[0]) for r in rows), terms, df)


def parse_items(questions: list[str], answers: list[str | None]) -> list:
    """(term hashes, shingle hashes, halves) of each item, None for one without words. ``answers[i]`` None: the question's
    words are halved."""
    rows = []
    for q, a in zip(questions, answers):
        both = [x or "" for x in (q, a)]
        buf, offs = text_bytes(pa.array([" ".join(both).strip(), both[0]]))
        w = split_words(buf, offs, PLAIN)
        n = int(w.counts[0])
        if not n:
            rows.append(None)
            continue
        cut = int(w.counts[1]) if a is not None else -(-n // 2)
        h = w.strong_hashes()[:n]
        sums = window_sums(h)
        allsh = _shingles(w, sums, 0, n)
        # shingles that start in a half belong to it
        inq = _shingles(w, sums, 0, cut) if cut else np.zeros(0, np.uint64)
        ina = _shingles(w, sums, cut, n) if cut < n else np.zeros(0, np.uint64)
        part = np.isin(allsh, inq) * 1 + np.isin(allsh, ina) * 2
        # a half shorter than a shingle has one of its own
        for half, bit in ((inq, 1), (ina, 2)):
            more = half[~np.isin(half, allsh)]
            allsh, part = np.concatenate([allsh, more]), np.concatenate([part, np.full(len(more), bit + 4)])
        rows.append((h, allsh, part))
    return rows


def build_shard(ids: list, parsed: list, stats: Stats | None = None) -> Shard | None:
    """Index of the parsed items, weighed by ``stats`` (by default their own)."""
    stats = stats or statistics(parsed)
    keep = [i for i, r in enumerate(parsed) if r is not None]
    rows = [parsed[i] for i in keep]
    if not keep:
        return None
    n_items = len(keep)
    length = np.array([len(r[0]) for r in rows])
    term, item = np.concatenate([r[0] for r in rows]), np.repeat(np.arange(n_items), length)
    terms, t = np.unique(term, return_inverse=True)
    cell, tf = np.unique(t * n_items + item, return_counts=True)
    p_term, p_item = cell // n_items, cell % n_items
    df = stats.frequency(terms)
    idf = np.log(1 + (stats.n - df + 0.5) / (df + 0.5))
    norm = K1 * (1 - B + B * length * stats.n / stats.words)
    impact = idf[p_term] * tf * (K1 + 1) / (tf + norm[p_item])
    impact = (impact / np.bincount(p_item, weights=impact)[p_item]).astype(np.float32)
    blocks = n_items // BLOCK + 1
    block_of = p_term * blocks + p_item // BLOCK  # ascending, as postings are sorted
    bcell, binv = np.unique(block_of, return_inverse=True)
    bmax = np.zeros(len(bcell), np.float32)
    np.maximum.at(bmax, binv, impact)
    at = lambda x: np.searchsorted(x, np.arange(len(terms) + 1))
    return Shard([ids[i] for i in keep], terms, at(p_term), p_item, impact, at(bcell // blocks), bcell % blocks, bmax,
                 np.append(np.searchsorted(block_of, bcell), len(block_of)),
                 np.cumsum([0] + [len(r[1]) for r in rows]), np.concatenate([r[1] for r in rows]),
                 np.concatenate([r[2] for r in rows]).astype(np.int8), int(length.max()))


def build_index(items: DataFrame, id_col: str = "item_id", text_col: str = "text", question_col: str | None = None,
                answer_col: str | None = None, max_items: int = 1_000_000) -> list[Shard]:
    """Shards over all items; document frequencies and lengths are those of all items, so a score does not depend
    on the shard. The index is built in the driver: more than ``max_items`` items, or more than ``MAX_BYTES`` bytes of them,
    raise (split the items and search each part against all passages). Ids are kept as they are, of any type, null too."""
    q, a = question_col or text_col, answer_col
    size = F.sum(sum((F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)) for c in (q, a) if c), F.lit(0)).cast("long"))
    n, size = items.agg(F.count("*"), F.coalesce(size, F.lit(0))).first()
    if n > max_items or size > MAX_BYTES:
        raise ValueError(f"{n} test items of {size} bytes; the broadcast index is bounded to {max_items} and {MAX_BYTES}")
    cols = [F.col(f"`{id_col}`").alias("i"), F.col(f"`{q}`").alias("q"),
            (F.coalesce(F.col(f"`{a}`"), F.lit("")) if a else F.lit(None).cast("string")).alias("a")]
    src = items.select(*cols)
    rows = sorted(src.collect(), key=lambda r: (r.i is not None, r.i if r.i is not None else 0, r.q or ""))
    parsed = parse_items([r.q for r in rows], [r.a for r in rows])
    stats = statistics(parsed)
    found = []
    for at in range(0, len(rows), SHARD):
        s = build_shard([r.i for r in rows[at:at + SHARD]], parsed[at:at + SHARD], stats)
        if s is not None:
            s.id_type = src.schema["i"].dataType
            found.append(s)
    return found


def retrieve(s: Shard, pid: np.ndarray, term: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(passage, item number, score) of every pair that reaches the threshold, from
    the distinct (passage, term) pairs, sorted by passage."""
    empty = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    if not len(pid):
        return empty
    slack = 1 - 1e-4  # sums are in single precision
    blocks = int(s.block_id.max()) + 1
    n_p = int(pid[-1]) + 1
    # bounds: sums of block maxima
    k = s.block_at[term + 1] - s.block_at[term]
    at = ranges(s.block_at[term], k)
    cell = np.repeat(pid, k) * blocks + s.block_id[at]
    bound = np.bincount(cell, weights=s.block_max[at], minlength=n_p * blocks)
    open_ = bound >= threshold * slack
    opened = np.flatnonzero(open_)
    if not len(opened):
        return empty
    # postings inside the opened blocks only
    keep = open_[cell]
    at = at[keep]
    row = (np.cumsum(open_) - 1)[cell[keep]]
    k = s.block_post[at + 1] - s.block_post[at]
    post = ranges(s.block_post[at], k)
    score = np.bincount(np.repeat(row, k) * BLOCK + s.post_item[post] % BLOCK, weights=s.post_impact[post],
                        minlength=len(opened) * BLOCK)
    hit = np.flatnonzero(score >= threshold * slack)
    c = opened[hit // BLOCK]
    return c // blocks, c % blocks * BLOCK + hit % BLOCK, score[hit]


def _matches(shards: list[Shard], buf: np.ndarray, offs: np.ndarray, threshold: float):
    """(text, item id, score, overlap, question part, answer part, first word of the passage),
    the best passage of each (text, item)."""
    w = split_words(buf, offs, PLAIN)
    if not len(w.start):
        return []
    h = w.strong_hashes()
    text = w.text_of()
    sums = window_sums(h)
    best = {}
    for s in shards:
        t = np.searchsorted(s.terms, h)
        t[t == len(s.terms)] = 0
        known = np.flatnonzero(s.terms[t] == h)
        if not len(known):
            continue
        # passage p of a text: words [p * step, (p + 2) * step)
        step = s.passage
        per = np.maximum(1, -(-w.counts // step) - 1)
        base = np.cumsum(per) - per
        x = text[known]
        p = (known - w.first[x]) // step
        one = base[x] + np.minimum(p, per[x] - 1)
        two = np.where(p >= 1, base[x] + p - 1, one)
        two = np.minimum(two, base[x] + per[x] - 1)
        code = np.unique(np.concatenate([one, two]) * len(s.terms) + np.tile(t[known], 2))
        pid, term = code // len(s.terms), code % len(s.terms)
        op, it, score = retrieve(s, pid, term, threshold)
        owner = np.searchsorted(base, op, "right") - 1
        for a, i, sc, o in zip(op.tolist(), it.tolist(), score.tolist(), owner.tolist()):
            lo = int(w.first[o] + (a - base[o]) * step)
            hi = int(min(lo + 2 * step, w.first[o + 1]))
            want, part = s.shingles[s.shingle_at[i]:s.shingle_at[i + 1]], s.part[s.shingle_at[i]:s.shingle_at[i + 1]]
            size = min(SHINGLE, hi - lo)
            at = lo + np.arange(hi - lo - size + 1)
            have = [window_hash(sums, at, at + size)]
            if (part & 4).any() or len(want) < SHINGLE:  # parts shorter than a shingle
                for k in range(1, min(SHINGLE, hi - lo + 1)):
                    at = lo + np.arange(hi - lo - k + 1)
                    have.append(window_hash(sums, at, at + k))
            found = np.isin(want, np.concatenate(have))
            whole = part & 4 == 0
            share = lambda m: float(found[m].mean()) if m.any() else 1.0
            got = (share(whole), share(part & 1 > 0), share(part & 2 > 0))
            if got[0] < OVERLAP or min(got[1:]) < PART_OVERLAP:
                continue
            key, value = (o, s.items[i]), (got[0], min(1.0, sc), got[1], got[2], -(lo - int(w.first[o])))
            best[key] = max(best.get(key, value), value)
    return [(o, i, v[1], v[0], v[2], v[3], -v[4]) for (o, i), v in sorted(best.items(), key=lambda x: x[0][0])]


def _shared(docs: DataFrame, shards: list[Shard]):
    return docs.sparkSession.sparkContext.broadcast(shards)


def find_leaks(docs: DataFrame, index: list[Shard], id_col: str = "doc_id", text_col: str = "text",
               threshold: float = THRESHOLD) -> DataFrame:
    """One row for each row of docs and test item found in its whole text: id,
    item_id, score, overlap, question_overlap, answer_overlap, first_word (of
    the passage, within the text). A null or empty text holds no item; every
    repeated row has its own rows; equal items under several ids are all named; very long texts are searched whole,
    passage by passage. The id column keeps its name unless it is one of the others, then it gets a leading "_"."""
    shared = _shared(docs, index)
    kind = index[0].id_type if index else LongType()
    made = ["item_id", "score", "overlap", "question_overlap", "answer_overlap", "first_word"]
    arrow = to_arrow_type(kind)

    def run(batches):
        for b in batches:
            buf, offs = text_bytes(b.column("text"))
            for lo, hi in slices(offs, _SLICE):
                m = _matches(shared.value, buf[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], threshold)
                if m:
                    c = list(zip(*m))
                    yield pa.RecordBatch.from_arrays(
                        [b.column("id").take(pa.array([lo + x for x in c[0]])), pa.array(c[1], arrow),
                         *[pa.array(x, pa.float64()) for x in c[2:6]], pa.array(c[6], pa.int32())],
                        ["id", *made])

    src = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    schema = src.select("id").schema
    schema = schema.add("item_id", kind)
    for name in ("score double", "overlap double", "question_overlap double", "answer_overlap double", "first_word integer"):
        schema = schema.add(*name.split())
    return src.mapInArrow(run, schema).withColumnRenamed("id", "_" * (id_col.lower() in made) + id_col)


def drop_leaks(docs: DataFrame, index: list[Shard], text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs in which no test item is found, columns unchanged."""
    shared = _shared(docs, index)

    def run(batches):
        for b in batches:
            buf, offs = text_bytes(b.column(text_col))
            keep = np.ones(b.num_rows, bool)
            for lo, hi in slices(offs, _SLICE):
                for m in _matches(shared.value, buf[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], threshold):
                    keep[lo + m[0]] = False
            yield b.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
