"""Convolutional toxicity classifier, trained in numpy.

A word's vector is the sum of hashed embeddings of the word and of its first 3,
5 and 7 bytes. Filters of widths 1, 2 and 3 run over the whole text; each
filter's output is max-pooled over ``SEGMENTS`` equal stretches of the text, and
the ``TOP`` largest maxima count, in order, so a text with several toxic
passages differs from one with a single odd word. The pooled maxima and the log
of the length go through one hidden layer to a logit.

The score is a calibrated probability, moved so that 0.7 is the cut with the best
F1 on the labelled training-side rows that the fit did not use. Each language also gets
its own cut, found the same way among its rows of these; a language with fewer than
``MIN_PER_LANG`` positives or negatives there uses 0.7. Language, source, id and labels are not inputs of a
score.

The fit uses a sample of labelled rows, bounded by ``max_rows``; it is the only part
that runs in the driver, besides the cuts, which it reads off counts by language, label and
bin of the logit. Scoring is one pass over the table in Arrow batches.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trustframe.llm.frames import free_names
from trustframe.llm.textarrays import PLAIN, U64, _R, _powers, mix, slices, split_words, text_bytes
from trustframe.session import cut_lineage

PREFIXES = (3, 5, 7)
BUCKETS, DIM, FILTERS, WIDTHS, SEGMENTS, TOP, HIDDEN = 1 << 16, 16, 12, (1, 2, 3), 6, 3, 16
TAIL = max(WIDTHS) - 1
PAD = TAIL + 1  # so that a filter on the row of an empty text sees padding only
CUT, MIN_PER_LANG = 0.7, 30
#: bins of a logit: width, and the number on each side of 0
BIN, BINS = 1 / 128, 8192
_SLICE = 1 << 19


@dataclass
class Model:
    emb: np.ndarray                 # BUCKETS + 1 rows; the last is the padding, zero
    conv: list[np.ndarray]          # per width: (width * DIM, FILTERS)
    bias: list[np.ndarray]
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    scale: float = 1.0
    shift: float = 0.0
    cuts: dict[str, float] = field(default_factory=dict)  # by language

    def params(self) -> list[np.ndarray]:
        return [*self.conv, *self.bias, self.w1, self.b1, self.w2, self.b2]


def new_model(seed: int) -> Model:
    r = np.random.default_rng(seed)
    g = lambda *s, scale: (r.standard_normal(s) * scale).astype(np.float32)
    emb = g(BUCKETS + 1, DIM, scale=0.1)
    emb[-1] = 0
    n = len(WIDTHS) * FILTERS * TOP + 1
    return Model(emb, [g(k * DIM, FILTERS, scale=(k * DIM) ** -0.5) for k in WIDTHS], [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
                 g(n, HIDDEN, scale=n ** -0.5), np.zeros(HIDDEN, np.float32), g(HIDDEN, 1, scale=HIDDEN ** -0.5), np.zeros(1, np.float32))


def encode(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, ids): rows[i] is text i's first row of ids, an array of 1 + len(PREFIXES) bucket
    numbers per word; every text ends with PAD padding rows."""
    w = split_words(buf, offs, PLAIN)
    n = len(w.start)
    ids = np.full((n, 1 + len(PREFIXES)), BUCKETS, np.int32)
    if n:
        ids[:, 0] = w.hashes() % U64(BUCKETS)
        with np.errstate(over="ignore"):
            p = np.empty(len(w.buf) + 1, np.uint64)
            p[0] = 0
            np.cumsum((w.buf.astype(np.uint64) + U64(1)) * _powers(_R, len(w.buf)), out=p[1:])
            inv = _powers(_R, len(w.buf), True)[w.start]
            for i, k in enumerate(PREFIXES):
                e = np.minimum(w.start + k, w.end)
                ids[:, i + 1] = mix((p[e] - p[w.start]) * inv + U64(k << 32)) % U64(BUCKETS)
    rows = w.first + np.arange(len(w.first)) * PAD
    out = np.full((n + PAD * (len(offs) - 1), ids.shape[1]), BUCKETS, np.int32)
    out[np.arange(n) + w.text_of() * PAD] = ids
    return rows, out


def _forward(m: Model, rows: np.ndarray, ids: np.ndarray, keep: bool = False):
    """Logits; with ``keep`` also what the backward pass needs."""
    size = np.diff(rows) - PAD
    n = len(size)
    x = m.emb[ids[:, 0]]
    for i in range(1, ids.shape[1]):
        x = x + m.emb[ids[:, i]]
    # stretches of each text; one of no words takes the row where it starts
    start = (rows[:-1, None] + (size[:, None] * np.arange(SEGMENTS)) // SEGMENTS)
    stop = np.maximum(rows[:-1, None] + (size[:, None] * np.arange(1, SEGMENTS + 1)) // SEGMENTS, start + 1)
    edges = np.stack([start.ravel(), stop.ravel()], 1).ravel()
    pooled, args = [], []
    for k, w, b in zip(WIDTHS, m.conv, m.bias):
        a = sum(x[j: len(x) - TAIL + j] @ w[j * DIM:(j + 1) * DIM] for j in range(k))
        a = np.concatenate([a, np.zeros((TAIL, FILTERS), np.float32)])
        # the gap rows between stretches come as odd segments and are dropped
        mx = np.maximum.reduceat(a, np.minimum(edges, len(a) - 1), axis=0)[::2].reshape(n, SEGMENTS, FILTERS)
        order = np.argsort(-mx, axis=1)[:, :TOP]
        top = np.take_along_axis(mx, order, 1)
        if keep:
            seg = np.full(len(a), -1)
            s, t = start.ravel(), stop.ravel()
            seg[_spread(s, t)] = np.repeat(np.arange(len(s)), t - s)
            inside = np.flatnonzero(seg >= 0)
            hit_r, hit_c = np.nonzero(a[inside] == mx.reshape(-1, FILTERS)[seg[inside]])
            arg = np.zeros((n * SEGMENTS, FILTERS), np.int64)
            arg[seg[inside[hit_r]], hit_c] = inside[hit_r]
            args.append(np.take_along_axis(arg.reshape(n, SEGMENTS, FILTERS), order, 1))
        pooled.append(np.maximum(top + b, 0).reshape(n, -1))
    z = np.concatenate([*pooled, np.log1p(size)[:, None].astype(np.float32) / 8], 1)
    pre = z @ m.w1 + m.b1
    h = np.maximum(pre, 0)
    out = (h @ m.w2 + m.b2)[:, 0]
    return (out, (x, args, z, pre, h)) if keep else out


def _spread(s: np.ndarray, t: np.ndarray) -> np.ndarray:
    n = t - s
    return np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n - s, n)


def logits(m: Model, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    out = np.zeros(len(offs) - 1)
    for lo, hi in slices(offs, _SLICE):
        out[lo:hi] = _forward(m, *encode(buf[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]))
    return out


def train(texts: pa.Array, y: np.ndarray, seed: int = 7, steps: int = 1600, batch: int = 16, rate: float = 0.1) -> Model:
    """Adagrad on the logistic loss, classes weighted alike. Gradients reach only
    the words that the pooling chose."""
    m = new_model(seed)
    buf, offs = text_bytes(texts)
    r = np.random.default_rng(seed)
    pos = max(1, int(y.sum()))
    weight = np.where(y > 0, len(y) / (2 * pos), len(y) / (2 * max(1, len(y) - pos))).astype(np.float32)
    acc = [np.full_like(p, 1e-2) for p in m.params()]
    acc_e = np.full((BUCKETS + 1, 1), 1e-3, np.float32)
    coded = [encode(buf[offs[i]:offs[i + 1]], offs[i:i + 2] - offs[i])[1] for i in range(len(y))]
    for _ in range(max(1, round(steps * batch / max(1, len(y))))):
        perm = r.permutation(len(y))
        for at in range(0, len(perm), batch):
            pick = perm[at:at + batch]
            ids = np.concatenate([coded[i] for i in pick])
            rows = np.cumsum([0] + [len(coded[i]) for i in pick])
            out, (x, args, z, pre, h) = _forward(m, rows, ids, keep=True)
            g = (weight[pick] * (1 / (1 + np.exp(-np.clip(out, -30, 30))) - y[pick]) / len(pick)).astype(np.float32)[:, None]
            gh = (g @ m.w2.T) * (pre > 0)
            gz = gh @ m.w1.T
            grads_w, grads_b, touched, grad_x = [], [], [], []
            for i, k in enumerate(WIDTHS):
                part = z[:, i * TOP * FILTERS:(i + 1) * TOP * FILTERS].reshape(-1, TOP, FILTERS)
                gp = gz[:, i * TOP * FILTERS:(i + 1) * TOP * FILTERS].reshape(-1, TOP, FILTERS) * (part > 0)
                d, t, f = np.nonzero(gp)
                v, p = gp[d, t, f], args[i][d, t, f]
                grads_b.append(gp.sum((0, 1)))
                gw = np.zeros_like(m.conv[i])
                for j in range(k):
                    xe = np.zeros((FILTERS, DIM), np.float32)
                    np.add.at(xe, f, v[:, None] * x[p + j])
                    gw[j * DIM:(j + 1) * DIM] = xe.T
                    touched.append(p + j)
                    grad_x.append(v[:, None] * m.conv[i][j * DIM:(j + 1) * DIM].T[f])
                grads_w.append(gw)
            grads = [*grads_w, *grads_b, z.T @ gh, gh.sum(0), h.T @ g, g.sum(0)]
            for q, a, dq in zip(m.params(), acc, grads):
                a += dq * dq
                q -= rate * dq / np.sqrt(a)
            if touched:
                pos_, gx = np.concatenate(touched), np.concatenate(grad_x)
                b = ids[pos_].ravel()
                u, inv = np.unique(b, return_inverse=True)
                ge = np.zeros((len(u), DIM), np.float32)
                np.add.at(ge, inv, np.repeat(gx, ids.shape[1], 0))
                acc_e[u] += (ge * ge).mean(1, keepdims=True)
                m.emb[u] -= rate * ge / np.sqrt(acc_e[u])
                m.emb[-1] = 0
    return m


def _best_cut(score: np.ndarray, y: np.ndarray, w: np.ndarray) -> float:
    """The cut with the largest F1: halfway between the neighbours it parts."""
    order = np.argsort(-score, kind="stable")
    s, tp, fp = score[order], np.cumsum((y * w)[order]), np.cumsum(((1 - y) * w)[order])
    f1 = 2 * tp / (tp + fp + (y * w).sum())
    last = np.r_[s[:-1] != s[1:], True]  # cuts fall between different scores
    i = int(np.argmax(np.where(last, f1, -1)))
    return float((s[i] + s[i + 1]) / 2) if i + 1 < len(s) else float(s[i]) - 1e-6


def calibrate(m: Model, z: np.ndarray, y: np.ndarray, w: np.ndarray, lang: list[str | None], n: np.ndarray) -> None:
    """Sets scale and shift (Platt's fit, then the best cut moved to CUT) and the languages' cuts.
    An entry stands for ``n`` rows, which weigh ``w`` together."""
    if 0 < y.sum() < len(y):
        a, b, zs = 1.0, 0.0, float(max(1.0, np.abs(z).max()))
        x = z / zs
        pos, neg = (w * y).sum(), (w * (1 - y)).sum()
        t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
        for _ in range(100):  # Newton, two parameters, a little ridge
            p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
            r = w * (p - t)
            g = np.array([(r * x).sum() + 1e-3 * a, r.sum()])
            q = w * p * (1 - p) + 1e-6
            h = np.array([[(q * x * x).sum() + 1e-3, (q * x).sum()], [(q * x).sum(), q.sum()]])
            step = np.clip(np.linalg.solve(h, g), -2, 2)
            a, b = max(a - step[0], 1e-3), b - step[1]
        m.scale = a / zs
        cut = _best_cut(z, y, w)
        m.shift = float(np.log(CUT / (1 - CUT)) - m.scale * cut)
    s = scores(m, z)
    langs = np.array([x or "" for x in lang])
    m.cuts = {}
    for x in np.unique(langs):
        k = langs == x
        if x and (n * y)[k].sum() >= MIN_PER_LANG and (n * (1 - y))[k].sum() >= MIN_PER_LANG:
            m.cuts[str(x)] = _best_cut(s[k], y[k], w[k])


def scores(m: Model, z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(m.scale * z + m.shift, -500, 500)))


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 6000, seed: int = 7, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang", label_col: str = "toxic", max_bytes: int = 256 << 20, max_broadcast: int = 4_000_000) -> Model:
    """Model from labelled rows whose crc32(id) mod 3 is not 1. Of each class, about half of
    ``max_rows`` at most are drawn by a hash of the id, and four in five of them fitted; all
    others, drawn or not, choose the scale and the cuts. Only labelled rows are scored for them: the ids of the
    labels go to the rows where there are at most ``max_broadcast`` of them. The drawn texts hold ``max_bytes`` at most,
    whole texts in the order of the hash; an id beyond that, or with a text over a 64th of it, is not fitted. Of rows with one id one is used.
    Rows without id or label are not used; without both classes the
    model gives every text the share of the class there is."""
    lab = (labels.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{label_col}`").cast("int").alias("y"))
           .where(F.col("i").isNotNull() & F.col("y").isin(0, 1)).where(~held_out(F.col("i"))).groupBy("i").agg(F.max("y").alias("y")))
    n = {r.y: r["n"] for r in lab.groupBy("y").agg(F.count("*").alias("n")).collect()}
    u = F.pmod(F.xxhash64(F.lit(seed), "i"), F.lit(1_000_000))
    rates = {y: min(1.0, max_rows / 2 / max(1, n.get(y, 0))) for y in (0, 1)}
    pick = lab.where(u < F.when(F.col("y") == 1, rates[1] * 1e6).otherwise(rates[0] * 1e6))
    # at most about max_rows ids: the texts of the whole table are not shuffled for them
    src = docs.select(F.col(f"`{id_col}`").alias("i"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("t"), F.col(f"`{lang_col}`").cast("string").alias("g"))
    one = F.xxhash64("t", "g")  # of the rows of an id, the one with the smallest
    drawn = cut_lineage(src.join(F.broadcast(pick), "i").groupBy("i", "y").agg(F.min_by(F.struct("t", "g"), one).alias("x"))
                        .select("i", "y", "x.t", "x.g", u.alias("u"), F.octet_length("x.t").alias("b")))
    # a running sum over the sizes of about max_rows rows
    fits = (drawn.where(F.col("b") <= max_bytes // 64).select("i", F.sum("b").over(Window.orderBy("u", "i")).alias("held")).where(F.col("held") <= max_bytes).select("i"))
    got = drawn.join(F.broadcast(fits), "i", "left_semi").select("i", "y", "t", "g").toArrow()
    order = np.argsort(np.array([str(x) for x in got["i"].to_pylist()], dtype=object), kind="stable")
    got = got.take(pa.array(order))
    y = np.asarray(got["y"].to_pylist(), np.float32)
    texts = got["t"].combine_chunks()
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.chunk(0) if texts.num_chunks else pa.array([], pa.string())
    if not 0 < y.sum() < len(y):
        m = new_model(seed)
        m.scale, m.shift = 0.0, float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
        return m
    back = np.random.default_rng(seed).permutation(len(y)) % 5 == 0
    m = train(texts.filter(pa.array(~back)), y[~back], seed)
    fitted = docs.sparkSession.createDataFrame([(i,) for i, b in zip(got["i"].to_pylist(), back) if not b], pick.select("i").schema)
    others = lab.join(F.broadcast(fitted), "i", "left_anti")
    todo = src.where(F.col("i").isNotNull() & ~held_out(F.col("i"))).withColumn("h", one)
    if sum(n.values()) <= max_broadcast:  # beyond, narrow scores are joined rather than texts shuffled
        todo = todo.join(F.broadcast(others.select("i")), "i", "left_semi")
    rest = (_logit_bins(todo, m).groupBy("i").agg(F.min(F.struct("h", "g", "k")).alias("x")).join(others, "i")
            .groupBy("x.g", "x.k", "y").agg(F.count("*").alias("n")).orderBy("g", "k", "y").toArrow())
    z, n_at, of = (np.asarray(rest[c].to_pylist(), float) for c in ("k", "n", "y"))
    # each class weighs what all its labelled rows do
    used = {c: float((y[~back] == c).sum()) for c in (0, 1)}
    left = {c: float(n_at[of == c].sum()) for c in (0, 1)}
    w = n_at * np.where(of > 0, *((left[c] + used[c]) / max(1.0, left[c]) for c in (1, 0)))
    calibrate(m, z * BIN, of, w, rest["g"].to_pylist(), n_at)
    return m


def _logit_bins(rows: DataFrame, model: Model) -> DataFrame:
    """(i, h, g, k) from (i, h, g, t): k is the bin of the text's logit."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            k = np.clip(np.rint(logits(shared.value, *text_bytes(b.column("t"))) / BIN), -BINS, BINS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column("i"), b.column("h"), b.column("g"), pa.array(k)], ["i", "h", "g", "k"])
    return rows.mapInArrow(run, rows.select("i", "h", "g").schema.add("k", "integer"))


def score(docs: DataFrame, model: Model, text_col: str = "text", lang_col: str = "lang", columns: list[str] | None = None) -> DataFrame:
    """``columns`` of docs (all by default), score, predicted (score >= 0.7), cut (the
    language's) and rejected (score >= cut). Null texts score as empty ones. Clashing
    names get a leading "_"."""
    columns = docs.columns if columns is None else columns
    src = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*columns, text_col, lang_col])])
    outs = free_names(src, "score", "predicted", "cut", "rejected")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.select(*[F.col(f"`{c}`") for c in columns]).schema
    for name, kind in zip(outs, ("double", "integer", "double", "boolean")):
        schema = schema.add(name, kind)

    def run(batches):
        m = shared.value
        for b in batches:
            s = scores(m, logits(m, *text_bytes(b.column(text_col))))
            cut = np.array([m.cuts.get(x, CUT) for x in b.column(lang_col).to_pylist()], float)
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in columns], pa.array(s), pa.array((s >= CUT).astype(np.int32)),
                                              pa.array(cut), pa.array(s >= cut)], [*columns, *outs])
    return src.mapInArrow(run, schema)
