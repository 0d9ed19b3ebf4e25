"""op1, op5, op6, op7, op8 against brute force on edge rows."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from conftest import SF_SMALL
from trustframe.llm import host_rules, line_dedup, secret_scan, simhash, substring_dedup
from .conftest import edge_rows, lists

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BIG = 1 << 63


def docs_of(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


# ---- op1 ----

def brute_secrets(text):
    rules = [("assign", re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A), 2, 8),
             ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16), ("hex", re.compile(r"[0-9a-f]+"), 0, 32)]
    got = [(m.start(), k, m.end()) for k, (_, p, g, least) in enumerate(rules) for m in p.finditer(text or "") if len(m[g]) >= least]
    return ",".join(f"{rules[k][0]}:{s}:{e}" for s, k, e in sorted(got))


def test_secrets_equal_brute_force(spark, edge):
    small = spark.createDataFrame([(i, t) for i, t in enumerate([
        "ſecret = abcdefghij", "API_KEY='k-1/2+3.4=5'", "secret=x secret=12345678", "deadbeef" * 5, "AKIA12345678901" "234Z", "Toks tokentoken:abcdefgh",
        "ghp_" + "a" * 36, "x://user:pa55@host", "-----BEGIN RSA PRIVATE KEY-----"])], "doc_id long, text string")
    for d in (edge.select("doc_id", "text"), small, docs_of(spark, SF_SMALL).select("doc_id", "text")):
        got = secret_scan.find_secrets(d).select("text", secret_scan.spans(F.col("secrets"), ["assign", "access", "hex"]).alias("s")).collect()
        assert len(got) == d.count()
        assert all(r.s == brute_secrets(r.text) for r in got)
    kinds = {s.kind for r in secret_scan.find_secrets(small).collect() for s in r.secrets}
    assert {"github", "url_password", "private_key"} <= kinds


def test_secret_columns_empty_table_and_redaction(edge, none):
    d = secret_scan.find_secrets(edge)
    assert d.columns == [*edge.columns, "_secrets"] and d.count() == edge.count()
    assert secret_scan.find_secrets(none).count() == 0
    clean = secret_scan.redact(edge)
    assert clean.columns == edge.columns
    assert secret_scan.find_secrets(clean).where(F.size("_secrets") > 0).count() == 0


def test_trigram_queries():
    q = secret_scan.trigram_query
    assert q(r"AKIA[A-Z0-9]+") == ("and", (b"aki", b"kia"))
    assert q(r"[0-9a-f]+") is True and q(r"(abc)?x") is True and q(r"ab|cdef") is True
    assert q(r"(?:abcd|wxyz)+1") == ("or", (("and", (b"abc", b"bcd")), ("and", (b"wxy", b"xyz")))) or q(r"(?:abcd|wxyz)+1")[0] == "or"
    # a query never refuses a text that the rule matches
    for r in secret_scan.RULES:
        for t in ("password: abcdefgh", "api_key=abcdefgh", "AKIA" + "A" * 16, "ghp_" + "b" * 40, "xoxb-1234567890ab", "a://b:cde@f"):
            if re.search(r.pattern, t):
                buf, offs = secret_scan.text_bytes(secret_scan.pa.array([t]))
                query = q(r.pattern)
                post = secret_scan.postings(buf, offs, sorted(secret_scan.wanted(query)) or [b"zzz"])
                assert secret_scan.candidates(query, post, 1).tolist() == [0]


# ---- op5 ----

def brute_fp(text, k=4):
    w = (text or "").encode().lower().split()
    g = [b" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))] if w else []
    ones = [sum(xxhash.xxh64_intdigest(s, 42) >> b & 1 for s in g) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(g))


def linked(fps, d):
    par = {f: f for f in fps}

    def top(x):
        while par[x] != x:
            x = par[x]
        return x
    keys = sorted(par)
    arr = np.array(keys, np.uint64)
    for i, a in enumerate(keys):
        for j in np.flatnonzero(np.bitwise_count(arr[i + 1:] ^ arr[i]) <= d):
            u, v = top(a), top(keys[i + 1 + j])
            par[max(u, v)] = min(u, v)
    return {f: top(f) for f in keys}


@pytest.mark.parametrize("which", ["edge", "table"])
def test_simhash_components_equal_brute_force(spark, edge, which):
    d = edge if which == "edge" else docs_of(spark, SF_SMALL)
    rows = [(r.doc_id, r.text) for r in d.select("doc_id", "text").collect()]
    fps = [brute_fp(t) for _, t in rows]
    root = linked(set(fps), 4)
    least = {}
    for (i, _), f in zip(rows, fps):
        if i is not None:
            least[root[f]] = min(least.get(root[f], i), i)
    want = sorted([(i, f"{f:016x}", least.get(root[f])) for (i, _), f in zip(rows, fps)], key=str)
    got = simhash.classes(d).withColumn("h", simhash.fingerprint_hex(F.col("fp")))
    assert lists(got, "doc_id", "h", "component_id") == want
    kept = simhash.keep_one(d)
    assert kept.columns == d.columns
    assert kept.count() == len(set(root.values()))


@pytest.mark.parametrize("blocks,home,many", [(3, 2048, 0), (2, 2048, 0), (3, 2, 0), (None, 2048, 100), (None, 2, 10**6)])
def test_anchor_links_lose_nothing(spark, blocks, home, many):
    r = np.random.default_rng(1)
    x = {int(v) for v in r.integers(0, 1 << 63, 60)}
    for v in list(x):
        for _ in range(8):
            y = v
            for b in r.choice(64, r.integers(1, 6), replace=False):
                y ^= 1 << int(b)
            x.add(y)
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    df = spark.createDataFrame([(signed(v),) for v in sorted(x)], "fp long").repartition(3)
    edges = simhash.links(df, 4, blocks, home, many).collect()
    want = linked(x, 4)
    par = {v: v for v in x}

    def top(a):
        while par[a] != a:
            a = par[a]
        return a
    for e in edges:
        u, v = top(e.u % (1 << 64)), top(e.v % (1 << 64))
        par[max(u, v)] = min(u, v)
    assert {v: top(v) for v in x} == want


def test_simhash_empty(none):
    assert simhash.classes(none).count() == 0 and simhash.keep_one(none).count() == 0


# ---- op6 ----

def brute_repeats(rows, n=13):
    first, words = {}, []
    for i, t in rows:
        w = WORD.findall(t or "")
        words.append(w)
        for j in range(len(w) - n + 1):
            g = tuple(w[j:j + n])
            first[g] = min(first.get(g, BIG), BIG if i is None else i)
    out = []
    for (i, _), w in zip(rows, words):
        gone = [False] * len(w)
        for j in range(len(w) - n + 1):
            if first[tuple(w[j:j + n])] < (BIG if i is None else i):
                gone[j:j + n] = [True] * n
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("buckets", [1, 64])
def test_repeats_equal_brute_force(spark, edge, buckets):
    for d in (edge, docs_of(spark, SF_SMALL)):
        rows = [(r.doc_id, r.text) for r in d.select("doc_id", "text").collect()]
        got = substring_dedup.remove_repeats(d, buckets=buckets, columns=["doc_id"])
        assert lists(got, "doc_id", "n_words", "n_removed", "kept_sha256") == brute_repeats(rows)


def test_repeats_small_alphabet(spark):
    import random
    r = random.Random(2)
    rows = []
    for i in range(150):
        w = [r.choice("abc") for _ in range(r.randrange(0, 50))]
        if r.random() < 0.4:
            w += ["a"] * r.randrange(5, 40)
        rows.append((i, " ".join(w)))
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = substring_dedup.remove_repeats(d, columns=["doc_id"])
    assert lists(got, "doc_id", "n_words", "n_removed", "kept_sha256") == brute_repeats(rows)


def test_repeats_columns_and_empty(edge, none):
    d = substring_dedup.remove_repeats(edge)
    assert d.columns == [*edge.columns, "_n_words", "n_removed", "kept_sha256", "_kept_text"]
    assert d.count() == edge.count() and substring_dedup.remove_repeats(none).count() == 0


# ---- op7 ----

def brute_lines(rows, run, long_words=50):
    split = lambda t: [] if not t else re.split(r"\n(?=[^\n]*[^\x20\x09-\x0D])", t)
    clean = lambda x: x.strip(" \t\n\x0b\x0c\r")
    order = sorted({(BIG if i is None else i, t or "") for i, t in rows},
                   key=lambda p: (p[0], brute_th(p[1])))
    seen, result = set(), {}
    for p in order:
        ls = split(p[1])
        gone = [False] * len(ls)
        for j in range(len(ls) - run + 1):
            g = tuple(clean(x) for x in ls[j:j + run])
            if g in seen:
                gone[j:j + run] = [True] * run
            seen.add(g)
        for j, x in enumerate(ls):
            if len(WORD.findall(x)) >= long_words:
                if clean(x) in seen:
                    gone[j] = True
                seen.add(clean(x))
        result[p] = (len(ls), sum(gone), "\n".join(x for x, z in zip(ls, gone) if not z))
    return sorted([(i, *result[(BIG if i is None else i, t or "")]) for i, t in rows], key=str)


def brute_th(t):
    h = xxhash.xxh64_intdigest(t.encode(), 42)
    return h - (1 << 64) if h >> 63 else h


@pytest.mark.parametrize("run,long_words", [(2, 50), (3, 50), (3, 6), (1, 50)])
def test_line_runs_equal_brute_force(spark, edge, run, long_words):
    for d in (edge, docs_of(spark, SF_SMALL)):
        rows = [(r.doc_id, r.text) for r in d.select("doc_id", "text").collect()]
        got = line_dedup.remove_repeated_runs(d, run=run, columns=["doc_id"], long_words=long_words)
        assert lists(got, "doc_id", "n_lines", "n_removed", "kept_text") == brute_lines(rows, run, long_words)


def test_line_runs_extend_both_ways(spark):
    """Each run is as long as it can be on its diagonal, and its lines are those of its source."""
    long = " ".join(f"w{i}" for i in range(50))
    texts = {1: "a\nb\nc\nd\ne\nf", 2: "x\nb\nc\nd\ny\ne\nf\nz", 3: f"q\n{long}\nr", 4: f"{long}", 5: f"s\n{long} more\nt", 6: "c\nx\ny",
             7: "b\nc\nd\ny\ne"}
    d = spark.createDataFrame([(k, k, t) for k, t in texts.items()], "ord long, th long, text string")
    got = {r.ord: sorted((x.from_ord, x["shift"], x.start, x.end) for x in r.runs) for r in line_dedup.repeated_runs(d).collect()}
    assert got == {2: [(1, 0, 1, 4), (1, 1, 5, 7)], 4: [(3, -1, 0, 1)], 7: [(1, -1, 0, 3), (2, -1, 2, 5)]}
    out = {r.doc_id: r.kept_text for r in line_dedup.remove_repeated_runs(d.withColumnRenamed("ord", "doc_id").drop("th")).collect()}
    assert out[2] == "x\ny\nz" and out[4] == "" and out[5] == texts[5] and out[6] == texts[6] and out[7] == ""


def test_line_runs_columns_and_empty(edge, none):
    d = line_dedup.remove_repeated_runs(edge)
    assert d.columns == [*edge.columns, "n_lines", "n_removed", "_kept_text"] and d.count() == edge.count()
    assert line_dedup.remove_repeated_runs(none).count() == 0


# ---- op8 ----

def brute_counts(text):
    t = text or ""
    w = WORD.findall(t)
    g = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    cover = {i + k for i in range(len(w) - 4) if g[tuple(w[i:i + 5])] > 1 for k in range(5)}
    ls = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(ls) - len(set(ls)), len(cover)


def test_host_counts_equal_brute_force(spark, edge):
    for d in (edge.drop("n_words"), docs_of(spark, SF_SMALL)):
        got = host_rules.counts(d.select("text")).collect()
        assert all((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_counts(r.text) for r in got)


def test_host_verdicts_shrink_and_apply(spark):
    good = "plain words of a page that is long enough to pass every rule there"
    bad = "a # b $ c % d & e * f | g < h > i # j k l m n"
    rows = [("tiny", bad)] * 3 + [("tiny", good)]
    rows += [("junk", bad)] * 80 + [("junk", good)] * 20
    for h in range(30):
        rows += [(f"h{h}", good)] * 20
    d = spark.createDataFrame([(i, h, t) for i, (h, t) in enumerate(rows)], "doc_id long, source string, text string")
    out = host_rules.apply_host_rules(d, F.col("source"), columns=["doc_id", "source"]).toPandas()
    kept = out.groupby("source").kept.mean()
    assert kept["junk"] == 0.2          # the pages that fail the rule go, the clean ones stay
    assert (kept.drop(["junk", "tiny"]) == 1).all()
    v = host_rules.host_verdicts(d.select(F.col("source").alias("host"), *[
        (F.col("text") == bad).cast("int").alias(r) for r in host_rules.RULES])).where("rule = 'symbols'").toPandas().set_index("host")
    assert 0 < v.rate["h0"] < v.rate["tiny"] < 0.75 and v.rate["junk"] > 0.7
    assert v.bad["junk"] and not v.bad["h0"] and (v.low < v.rate).all()


def test_hosts_that_fail_like_all_others_are_not_bad(spark):
    """Equal hosts: none is bad, however many documents fail. One host above the rest at a rate far
    below one half: bad. One failing page is no verdict on its host."""
    def verdicts(fails):
        rows = [(f"h{h}", int(i < x)) for h, x in enumerate(fails) for i in range(200)] + [("one", 1)]
        d = spark.createDataFrame(rows, "host string, f int").select("host", *[F.col("f").alias(r) for r in host_rules.RULES])
        v = host_rules.host_verdicts(d).where("rule = 'symbols'").toPandas().set_index("host")
        return set(v.index[v.bad])
    assert verdicts([140] * 20) == set()
    assert verdicts([8, 9, 10, 11, 12] * 4) == set()
    assert verdicts([10] * 20 + [60]) == {"h20"}


def test_host_columns_and_empty(edge, none):
    cols = [c for c in edge.columns if c != "text"]
    d = host_rules.apply_host_rules(edge, F.col("source"), columns=cols)
    assert d.columns[:len(cols)] == cols and "_n_words" in d.columns and d.count() == edge.count()
    assert host_rules.apply_host_rules(none, F.col("source"), columns=cols).count() == 0
    assert len(edge_rows()) == edge.count()


def test_windows_of_long_words_that_differ_stay(spark):
    parity = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    other = parity.translate(str.maketrans("ab", "ba"))
    text = " ".join(f"w{i}" for i in range(6)) + " %s " + " ".join(f"w{i}" for i in range(6, 12))
    docs = spark.createDataFrame([(1, text % parity), (2, text % other), (3, text % parity)], "doc_id long, text string")
    got = substring_dedup.remove_repeats(docs, columns=["doc_id"]).select("doc_id", "n_removed").collect()
    assert sorted(map(tuple, got)) == [(1, 0), (2, 0), (3, 13)]


def test_buckets_follow_the_counted_bytes(spark, monkeypatch):
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.sequence(F.col("id"), F.col("id") + 60)).alias("text"))
    want = sorted(map(tuple, substring_dedup.remove_repeats(docs, buckets=1, columns=["doc_id"]).collect()))
    monkeypatch.setattr(substring_dedup, "BUCKET_BYTES", 16)
    assert sorted(map(tuple, substring_dedup.remove_repeats(docs, columns=["doc_id"]).collect())) == want
    assert substring_dedup.remove_repeats(docs.limit(0), columns=["doc_id"]).count() == 0
