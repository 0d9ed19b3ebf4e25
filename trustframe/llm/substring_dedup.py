"""Exact removal of long repeats by recompression.

A repeat is a window of ``n`` consecutive words (n odd) that also starts in a
document with a smaller id. Windows are found through the symbols of a
recompression of the texts rather than one by one:

* Each text is a string of word names. In a round every symbol gets a side,
  left or right, by a hash of its name and the round, and each adjacent
  (left, right) pair becomes one symbol named by its two parts. Names are
  64-bit hashes of what they stand for, so a pair has the same name in every
  task without a dictionary that would have to be shuffled. Runs of one token
  never pair (equal names lie on one side); their windows are all equal
  and are told apart only by position.
* A round's decision about two neighbours depends on these two alone, so a
  round can disturb at most one symbol at each end of a repeat. Symbols are
  held to at most 2, 3 and 6 words after rounds 1, 2 and 3. At n = 13 the ends
  lose at most 1 + 2 + 3 = 6 words, so the symbol over a window's middle word
  is the same in every occurrence of that window, and inside it.
* Each symbol occurrence is named by the words that all windows with their
  middle in it have in common. Equal windows therefore meet under one name.
  Under that name each of its windows adds a 32-bit hash of its full word
  sequence, which verifies the repeat (96 bits together).

Occurrences are packed into binary rows, one for each slice of texts and hash
bucket, about 9 bytes a word, and shuffled once. Before that, a slice
settles by itself what repeats inside it, so a license text in a third of all
documents sends one row a slice, not one a document. What comes back is one
long for each symbol with a repeated window; it is joined to the documents,
and the whole text is cut in one more pass.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustframe.llm.frames import free_names
from trustframe.llm.textarrays import U64, mix, ranges, slices, split_words, text_bytes, window_hash, window_sums

N_WORDS = 13
#: most words in a symbol after each round, for windows of 13 words
ROUND_WORDS = (2, 3, 6)
_NO_ID = (1 << 63) - 1  # a null id sorts after every id
_SLICE = 1 << 22
BUCKET_BYTES, MAX_BUCKETS = 20 << 20, 1 << 14


def recompress(name: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first word, words) of each symbol after the rounds. ``name``: word
    names; ``text``: the text of each word (pairs never cross texts)."""
    start = np.arange(len(name))
    size = np.ones(len(name), np.int64)
    for r, cap in enumerate(ROUND_WORDS):
        if len(name) < 2:
            break
        side = (mix(name + U64(r + 1)) & U64(1)).astype(bool)
        pair = ~side[:-1] & side[1:] & (text[:-1] == text[1:]) & (size[:-1] + size[1:] <= cap)
        left = np.flatnonzero(pair)
        with np.errstate(over="ignore"):
            name = name.copy()
            name[left] = mix(name[left] * U64(0x9E3779B97F4A7C15) + mix(name[left + 1]))
        size[left] += size[left + 1]
        keep = np.ones(len(name), bool)
        keep[left + 1] = False
        name, text, start, size = name[keep], text[keep], start[keep], size[keep]
    return start, size


def _pack(buckets: int, ids, marks, h, first, doc, thash, done):
    """Rows (bucket, payload) of one slice.

    ids: 64-bit names; marks: first word << 4 | one-word symbol << 3 | windows;
    h: a 32-bit hash for each window (a one-word symbol needs none: its name is
    the window's); first/doc/thash: each text's first word, id and text hash;
    done: marks that are settled already."""
    shift = U64(64 - buckets.bit_length() + 1)
    order = np.argsort(ids, kind="stable")
    count = np.where(marks & 8, 0, marks & 7)
    at = np.cumsum(count) - count
    ids, marks = ids[order], marks[order]
    h = h[ranges(at[order], count[order])].astype("<u4")
    cum = np.r_[0, np.cumsum(count[order])]
    b = (ids >> shift).astype(np.int64) if buckets > 1 else np.zeros(len(ids), np.int64)
    edge = np.searchsorted(b, np.arange(buckets + 1))
    # settled marks go along, dealt evenly
    done_edge = np.linspace(0, len(done), buckets + 1).astype(np.int64)
    for i in range(buckets):
        lo, hi = edge[i], edge[i + 1]
        d = done[done_edge[i]:done_edge[i + 1]]
        if lo == hi and not len(d):
            continue
        used = np.unique(np.searchsorted(first, np.concatenate([marks[lo:hi], d]) >> 4, "right") - 1)
        texts = zlib.compress(b"".join(np.diff(x[used], prepend=x.dtype.type(0)).tobytes() for x in (first, doc))
                              + thash[used].astype("<u4").tobytes(), 1)
        head = np.array([hi - lo, cum[hi] - cum[lo], len(d), len(used)], "<i8")
        yield i, b"".join([head.tobytes(), ids[lo:hi].astype("<u8").tobytes(), marks[lo:hi].astype("<u4").tobytes(),
                           h[cum[lo]:cum[hi]].tobytes(), d.astype("<u4").tobytes(), texts])


def _unpack(p: bytes):
    n, w, d, t = (int(x) for x in np.frombuffer(p, "<i8", 4))
    at = 32

    def take(kind, k):
        nonlocal at
        x = np.frombuffer(p, kind, k, at)
        at += x.nbytes
        return x
    ids, marks, h, done = take("<u8", n), take("<u4", n), take("<u4", w), take("<u4", d)
    texts = zlib.decompress(p[at:])
    first, doc = np.cumsum(np.frombuffer(texts, "<i8", 2 * t).reshape(2, t), axis=1)
    return ids, marks.astype(np.int64), h, done.astype(np.int64), first, doc, np.frombuffer(texts, "<u4", t, 16 * t)


def _parse(n: int, buckets: int):
    half = n // 2

    def run(batches):
        for batch in batches:
            buf, offs = text_bytes(batch.column("text"))
            all_doc, all_hash = np.asarray(batch.column("id")), np.asarray(batch.column("thash"))
            for lo, hi in slices(offs, _SLICE):
                w = split_words(buf[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])
                text = w.text_of()
                if not len(text):
                    continue
                if len(text) >> 28:
                    raise ValueError("a text has 2^28 words or more")
                name = w.strong_hashes()
                doc = all_doc[lo:hi]
                sums = window_sums(name)
                start, size = recompress(name, text)
                # middles of whole windows only
                t = text[start]
                a = np.maximum(start, w.first[t] + half)
                z = np.minimum(start + size, w.first[t + 1] - half)
                ok = z > a
                t, a, z, s0, s1 = t[ok], a[ok], z[ok], start[ok], (start + size)[ok]
                if not len(a):
                    continue
                # the words that the windows of all of the symbol's middles share; a symbol at
                # a text's end has fewer middles there but the same name elsewhere
                core = window_hash(sums, np.maximum(s1 - 1 - half, 0), np.minimum(s0 + half + 1, len(name)))
                count = z - a
                mid = ranges(a, count)
                full = window_hash(sums, mid - half, mid + half + 1)
                off = mid - np.repeat(s0, count)
                with np.errstate(over="ignore"):
                    ext = core + np.add.reduceat(mix(full + off.astype(U64)), np.cumsum(count) - count)
                # within the slice: occurrences equal in all windows to one of a smaller id are settled
                order = np.argsort(ext, kind="stable")
                head = np.flatnonzero(np.r_[True, ext[order][1:] != ext[order][:-1]])
                least = np.minimum.reduceat(doc[t][order], head)
                settled = np.empty(len(ext), bool)
                settled[order] = doc[t][order] > np.repeat(least, np.diff(np.r_[head, len(ext)]))
                one = s1 - s0 == 1
                marks = a << 4 | np.where(one, 8, 0) | count
                open_ = ~settled
                h = (full >> U64(32))[np.repeat(open_ & ~one, count)]
                rows = list(_pack(buckets, core[open_], marks[open_], h, w.first[:-1].astype(np.int64), doc,
                                  all_hash[lo:hi], marks[settled]))
                for at in range(0, len(rows), 64):
                    part = rows[at:at + 64]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[0] for r in part], pa.int32()), pa.array([r[1] for r in part], pa.binary())],
                        ["bucket", "payload"])
    return run


def _settle(payloads: list[bytes]) -> pa.RecordBatch | None:
    """Marks (id, text hash, first word << 8 | windows as bits) of one bucket."""
    parts = [_unpack(p) for p in payloads]
    ids, marks, hs = (np.concatenate([p[i] for p in parts]) for i in (0, 1, 2))
    which = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
    # the text of each occurrence, over all payloads
    base = np.cumsum([0] + [len(p[4]) for p in parts])
    text = np.concatenate([np.searchsorted(p[4], p[1] >> 4, "right") - 1 for p in parts]) + base[which]
    first, doc, thash = (np.concatenate([p[i] for p in parts]) for i in (4, 5, 6))
    count = marks & 7
    occ = np.repeat(np.arange(len(ids)), count)
    full = np.zeros(len(occ), np.uint32)
    full[(marks & 8 == 0)[occ]] = hs
    hs = full
    ident = mix(ids[occ] + hs.astype(U64) * U64(0x9E3779B97F4A7C15))
    order = np.argsort(ident, kind="stable")
    key, hh, d = ids[occ][order], hs[order], doc[text][occ][order]
    if len(order):
        head = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (hh[1:] != hh[:-1])])
        least = np.minimum.reduceat(d, head)
        repeated = np.empty(len(order), bool)
        repeated[order] = d > np.repeat(least, np.diff(np.r_[head, len(order)]))
    else:
        repeated = np.zeros(0, bool)
    bit = np.arange(len(occ)) - (np.cumsum(count) - count)[occ]
    mask = np.bincount(occ, weights=repeated * (1 << bit), minlength=len(ids)).astype(np.int64)
    hit = mask > 0
    done = np.concatenate([p[3] for p in parts])
    done_which = np.repeat(np.arange(len(parts)), [len(p[3]) for p in parts])
    done_text = np.concatenate([np.searchsorted(p[4], p[3] >> 4, "right") - 1 for p in parts]) + base[done_which]
    t = np.concatenate([text[hit], done_text])
    word = np.concatenate([marks[hit] >> 4, done >> 4]) - first[t]
    bits = np.concatenate([mask[hit], (1 << (done & 7)) - 1])
    if not len(t):
        return None
    return pa.RecordBatch.from_arrays([pa.array(doc[t]), pa.array(thash[t].astype(np.int64)), pa.array(word << 8 | bits)],
                                      ["id", "thash", "mark"])


def _find(batches):
    """Rows come sorted by bucket; one bucket's payloads are held at a time."""
    held, bucket = [], None
    for b in batches:
        for k, p in zip(b.column("bucket").to_pylist(), b.column("payload").to_pylist()):
            if k != bucket and held:
                out = _settle(held)
                if out is not None:
                    yield out
                held = []
            bucket = k
            held.append(p)
    if held:
        out = _settle(held)
        if out is not None:
            yield out


def _cut(n: int, columns: list[str], outs: list[str], text_col: str, marks_col: str):
    half = n // 2

    def run(batches):
        for b in batches:
            buf, offs = text_bytes(b.column(text_col))
            marks = b.column(marks_col)
            flat, m_offs = np.asarray(marks.values), np.asarray(marks.offsets)
            if marks.null_count:
                lens = marks.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            else:
                lens = np.diff(m_offs)
            words, removed, kept = [], [], []
            for lo, hi in slices(offs, _SLICE):
                w = split_words(buf[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])
                m = flat[ranges(m_offs[lo:hi], lens[lo:hi])]
                base = np.repeat(w.first[:-1], lens[lo:hi])
                cover = np.zeros(len(w.start) + 1, np.int64)
                for j in range(max(ROUND_WORDS)):
                    mid = (base + (m >> 8) + j)[(m >> j) & 1 == 1]
                    np.add.at(cover, mid - half, 1)
                    np.add.at(cover, mid + half + 1, -1)
                gone = np.cumsum(cover[:-1]) > 0
                n_gone = np.r_[0, np.cumsum(gone)]
                data = w.buf.tobytes()
                left = np.flatnonzero(~gone)
                s, e = w.start[left].tolist(), w.end[left].tolist()
                edge = np.searchsorted(left, w.first)
                for i in range(hi - lo):
                    words.append(int(w.first[i + 1] - w.first[i]))
                    removed.append(int(n_gone[w.first[i + 1]] - n_gone[w.first[i]]))
                    kept.append(b" ".join([data[x:y] for x, y in zip(s[edge[i]:edge[i + 1]], e[edge[i]:edge[i + 1]])]))
            sha = [hashlib.sha256(x).hexdigest() for x in kept]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in columns], pa.array(words, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(sha, pa.string()), pa.array([x.decode() for x in kept], pa.string())], [*columns, *outs])
    return run


def _text_hash(text_col: str):
    """Tells rows of one id and different texts apart."""
    return F.xxhash64(F.col(f"`{text_col}`")).bitwiseAND(F.lit(0xFFFFFFFF))


def repeated_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N_WORDS,
                   buckets: int | None = None) -> DataFrame:
    """(id, thash, marks): where windows of ``n`` words start again. ``buckets`` (a power of two)
    bounds what one task holds at a time: about 9 bytes a word of the corpus over buckets. By default it follows
    the counted bytes of the texts, ``BUCKET_BYTES`` of text a bucket, ``MAX_BUCKETS`` at most (16,384 buckets of
    20 MB: some 0.3 TB of text; beyond that a bucket grows with the corpus)."""
    if buckets is None:
        size = docs.agg(F.sum(F.octet_length(F.col(f"`{text_col}`")).cast("long"))).first()[0] or 0
        buckets = min(MAX_BUCKETS, 1 << max(6, (-(-size // BUCKET_BYTES) - 1).bit_length()))
    if n != N_WORDS:
        raise ValueError("the rounds' bounds are set for windows of 13 words")
    src = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(_NO_ID)).alias("id"),
                      _text_hash(text_col).alias("thash"), F.col(f"`{text_col}`").alias("text"))
    packed = src.mapInArrow(_parse(n, buckets), "bucket int, payload binary")
    found = packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        _find, "id long, thash long, mark long")
    return found.groupBy("id", "thash").agg(F.collect_list("mark").alias("marks"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N_WORDS,
                   buckets: int | None = None, columns: list[str] | None = None) -> DataFrame:
    """``columns`` of docs (all by default) and n_words, n_removed, kept_sha256, kept_text:
    the text without every word covered by a window of ``n`` words that also
    starts in a document with a smaller id.

    Null texts have no words; a text of 2^28 words or more raises; ids are numbers. Words are compared by a 64-bit hash
    that no two words of up to 8 bytes share. Rows with one id are one document: their windows
    don't remove each other's; a null id counts as larger than every id.
    Kept words are joined by one space. Clashing names get a leading "_"."""
    columns = docs.columns if columns is None else columns
    marks = repeated_words(docs, id_col, text_col, n, buckets)
    kid, kh, mk, *outs = free_names(docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*columns, text_col])]), "__id", "__thash", "__marks", "n_words", "n_removed", "kept_sha256", "kept_text")
    left = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*columns, text_col])],
                       F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(_NO_ID)).alias(kid),
                       _text_hash(text_col).alias(kh))
    marks = marks.select(F.col("id").alias(kid), F.col("thash").alias(kh), F.col("marks").alias(mk))
    joined = left.join(marks, [kid, kh], "left").drop(kid, kh)
    schema = docs.select(*[F.col(f"`{c}`") for c in columns]).schema
    for name, kind in zip(outs, ("long", "long", "string", "string")):
        schema = schema.add(name, kind)
    return joined.mapInArrow(_cut(n, columns, outs, text_col, mk), schema)
