"""op2, op3, op4, op9, op10 and the pipeline on edge rows and small tables."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF_SMALL
from oracle import compare, duck
from trustframe.llm import decontaminate, html_text, mixing, queries, shuffle_shards, toxicity


def read(spark, name):
    return spark.read.parquet(f"{SF_SMALL}/{name}.parquet")


# ---- op2 ----

def test_lines_leave_out_what_is_not_the_article():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header>
    <div id="menu">Home</div><div class="cookie-notice">We use</div><script>var a="</p><p>x";</script><!-- <p>no</p> -->
    <article><header><h1>Ti&eacute;  <i>x</i>y</h1></header><p>One<br>two&nbsp;&amp; three <form>f<input></form></p>
    <table><tr><td>a<td>b</table><div class="ad">buy</div><p hidden>h</p><ul><li>l1<li>l2</ul></article>
    <section id="comments"><p>nice</p></section><aside>s</aside><footer>f</footer><p cla"""
    ls = html_text.page_lines(page)
    assert html_text.main_text(ls, []) == "Tié xy\nOne two & three\na\nb\nl1\nl2"
    for odd in ("", "<", "a < b <", "<p", "<!-- x", "<script>x", "</div></p>x", "<p title='a>b'>t", "<a href=\"x>y", "&am &#x41; &bogus;"):
        html_text.page_lines(odd)
    assert html_text.page_lines("1 < 2 <b>x</b>") == [("1 < 2 x", 0)]


def test_article_text_survives_common_markup():
    body = "<h1>Title</h1><p>" + "The text of the article, with many words in it. " * 4 + "</p>"
    want = ["Title", ("The text of the article, with many words in it. " * 4).strip()]
    text = lambda page: html_text.main_text(html_text.page_lines(page), []).split("\n")
    foot = "<div class='site-footer'>foot</div><div class='related-posts'>more</div><div class='nav2 share-buttons'>s</div>"
    for page in (f"<div class='content-sidebar-wrap'><article>{body}</article></div>", f"<article class='post has-comments'>{body}</article>",
                 f"<div class='no-sidebar'><article>{body}</article></div>", f"<div class='sidebar widget'><main>{body}</main></div>",
                 f"<article class='widget'>{body}</article>", f"<main>{body}</main><article>teaser card</article>",
                 f"<p><b>x</b><div class='sidebar'><p><i></i><article>{body}</article></div>",
                 f"<div class='content'>{body}<article>teaser</article></div>"):
        got = text(page + foot)
        assert got[:2] == want and set(got[2:]) <= {"teaser"}, page
    assert text("<article><section id='social-history'><p>a</p></section><h2 id='related-work'>b</h2><h2 id='copyright-law'>c</h2>"
                "<h3 class='related'>d</h3></article>") == ["a", "b", "c", "d"]
    # main's lines outside its article stay, and main with a teaser keeps its body
    assert text(f"<main><h1>Head</h1><article>{body}</article></main>{foot}") == ["Head", *want]
    assert text(f"<main>{body}<article>teaser</article></main>") == [*want, "teaser"]
    # still left out: what is named as boilerplate, marked or not
    assert text(f"<main>{body}<div id='comments'><article>first</article><article>second</article></div>"
                "<div class='sidebar'><article>teaser</article></div><div class='cookie-notice'>c</div></main>") == want
    assert text(f"<div class='sidebar'><article>{body}<div class='share'>s</div></article></div>") == want
    assert text(f"<div>top</div><div class='wrap content'><p>crumbs</p><article>{body}</article></div>") == want


@pytest.mark.parametrize("name", [
    "commentlist", "reader-comments", "user-comments", "comment-thread", "responses", "ad-300x250", "google-ad", "adsbygoogle", "sponsored-content",
    "cookiebanner", "cookie-notice-eu", "wp-sidebar", "related-reading", "newsletter-signup-cta", "author-box"])
@pytest.mark.parametrize("tag", ["article", "div"])
def test_named_boilerplate_goes_from_marked_and_plain_pages(name, tag):
    page = f"<{tag}><p>first words</p><div class='{name}'><p>gone</p></div><p>last words</p></{tag}>"
    assert html_text.main_text(html_text.page_lines(page), []) == "first words\nlast words"


def test_names_of_topics_and_source_code_stay():
    page = ("<article><section id='cookie-recipes'><p>a</p></section><div class='no-comments'><p>b</p></div><pre><code>x = 1 <span class='token comment'># c</span>"
            "</code></pre><section id='newsletter-history'><p>d</p></section><div class='layout-sidebar-right'><p>e</p></div></article>")
    assert html_text.main_text(html_text.page_lines(page), []) == "a\nb\nx = 1 # c\nd\ne"


def lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def test_alignment_is_a_longest_common_subsequence():
    r = np.random.default_rng(0)
    for _ in range(60):
        a, b = r.integers(0, 6, r.integers(0, 14)), r.integers(0, 6, r.integers(0, 14))
        got = html_text.shared_lines(a, b)
        assert got.sum() == lcs(a.tolist(), b.tolist())
    a = np.arange(3000)
    b = np.r_[np.arange(1, 3000)[::-1][:5], np.arange(10, 2990), 7]
    assert html_text.shared_lines(np.r_[9999, a], np.r_[b, 8888]).sum() >= 2980


def test_alignment_of_long_pages_is_exact(monkeypatch):
    # one more early copy of a line that repeats shifts all its later pairs
    a = np.stack([np.arange(1, 1101), np.zeros(1100, np.int64)], 1).ravel()
    assert html_text.shared_lines(np.r_[-1, a, -2], np.r_[-3, 0, a, -4]).sum() == 2200
    monkeypatch.setattr(html_text, "CELLS", 3)
    r = np.random.default_rng(5)
    for _ in range(80):
        a, b = r.integers(0, 7, r.integers(0, 40)), r.integers(0, 7, r.integers(0, 40))
        got = html_text.shared_lines(a, b)
        rest = iter(b.tolist())
        assert got.sum() == lcs(a.tolist(), b.tolist()) and all(v in rest for v in a[got].tolist())
    a, b = np.r_[r.integers(0, 3, 200), 9], r.integers(0, 3, 300)  # masks of frequent lines
    assert html_text.shared_lines(a, b).sum() == lcs(a.tolist(), b.tolist())


def test_template_lines_of_the_nearest_page_go(spark):
    page = lambda body, menu: f"<div>{menu}</div><div>Acme News</div>{body}<div>All rights</div>"
    rows = [(1, "http://h.example/a/1", page("<p>first story</p><p>more</p>", "Home About")),
            (2, "http://h.example/a/2", page("<p>second story</p>", "Home About")),
            (3, "http://h.example/z/1", page("<p>third story</p>", "Other menu")),
            (4, "http://other.example/a/1", page("<p>alone</p>", "Home About")),
            (5, "http://copy.example/1", "<p>same</p>"), (6, "http://copy.example/2", "<p>same</p>"),
            (7, None, None), (None, "", ""), (8, "x y", "<p>z</p>"), (8, "x y", "<p>z</p>"),
            (9, "http://m.example/1", "<article><p>license</p><p>own</p></article><p>foot</p>"),
            (10, "http://m.example/2", "<article><p>license</p></article><p>foot</p>")]
    df = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id long, url string, html string, text string, n_shared int").repartition(4)
    out = html_text.extract(df)
    assert out.columns == ["page_id", "url", "html", "text", "n_shared", "_text", "_n_shared"] and out.count() == len(rows)
    got = {r.page_id: r._text for r in out.collect()}
    assert got[1] == "first story\nmore" and got[2] == "second story"
    assert got[3] == "Other menu\nthird story"           # nearest is a/2; its menu is its own
    assert got[4] == "Home About\nAcme News\nalone\nAll rights"
    assert got[5] == got[6] == "same"                    # a copy is not a template
    assert got[7] == got[None] == "" and got[8] == "z"
    assert got[9] == "license\nown" and got[10] == "license"
    assert html_text.extract(df.limit(0)).count() == 0


def brute_pages(rows):
    """Texts by sorting each host's pages in plain Python; line alignment by a plain table."""
    import hashlib
    from urllib.parse import urlsplit

    def common(a, b):
        k = 0
        while k < min(len(a), len(b)) and a[k] == b[k]:
            k += 1
        return k

    def align(a, b):  # numbers in a
        t = {(i, j): 0 for i in range(-1, len(a)) for j in range(-1, len(b))}
        for i in range(len(a)):
            for j in range(len(b)):
                t[i, j] = t[i - 1, j - 1] + 1 if a[i] == b[j] else max(t[i - 1, j], t[i, j - 1])
        i, j, got = len(a) - 1, len(b) - 1, set()
        while i >= 0 and j >= 0:
            if a[i] == b[j]:
                got.add(i)
                i, j = i - 1, j - 1
            elif t[i - 1, j] >= t[i, j - 1]:
                i -= 1
            else:
                j -= 1
        return got
    site = {}
    for url, page in set(rows):
        u = urlsplit(url)
        site.setdefault(u.netloc, []).append((u.path, hashlib.md5(f"{len(url)}:{url}{page}".encode()).hexdigest(), url, page))
    out = {}
    for ps in site.values():
        ps.sort()
        for k, (path, _, url, page) in enumerate(ps):
            ls = [t for t, _ in html_text.page_lines(page)]
            sides = [ps[j] for j in (k - 1, k + 1) if 0 <= j < len(ps)]
            left = list(range(len(ls)))
            if sides:
                near = max(sides, key=lambda s: common(s[0], path))
                folder = lambda s: path[:common(s[0], path)].rpartition("/")[0]
                for s in [near] + [s for s in sides if s is not near and folder(s) == folder(near)]:
                    hit = align([ls[i] for i in left], [t for t, _ in html_text.page_lines(s[3])])
                    left = [left[i] for i in sorted(hit)]
            else:
                left = []
            kept = [t for i, t in enumerate(ls) if i not in left]
            out[url, page] = ("\n".join(kept or ls), len(left))
    return out


def test_pairing_and_deletion_equal_brute_force(spark):
    r = np.random.default_rng(8)
    rows = []
    for i in range(160):
        host, section = f"h{int(r.integers(0, 4)) ** 2}.example", "abc"[int(r.integers(0, 3))]
        own = [f"word{i} {j}" for j in range(int(r.integers(1, 4)))] if i % 5 else [f"copied {i % 3}"] * 2
        body = ["Home", f"Section {section}", *own, *["License"] * int(r.integers(0, 2)), f"By the {section} desk", "All rights"]
        rows.append((f"http://{host}/{section}/{int(r.integers(0, 99)):02}", "".join(f"<p>{x}</p>" for x in body)))
    rows += rows[:20]
    d = spark.createDataFrame(rows, "url string, html string").repartition(7)
    want = brute_pages(rows)
    got = html_text.extract(d).collect()
    assert len(got) == len(rows) and all((x.text, x.n_shared) == want[x.url, x.html] for x in got)
    assert sum(x.n_shared > 2 for x in got) > 50


def test_neighbouring_copies_keep_their_article(spark):
    page = lambda body: f"<p>Menu</p>{body}<p>Foot</p>"
    rows = [("http://h.example/n/1", page("<p>one</p>")), ("http://h.example/n/2", page("<p>copied</p><p>text</p>")),
            ("http://h.example/n/3", page("<p>copied</p><p>text</p>")), ("http://h.example/n/4", page("<p>four</p>"))]
    got = {x.url[-1]: x.text for x in html_text.extract(spark.createDataFrame(rows, "url string, html string")).collect()}
    assert got == {"1": "one", "2": "copied\ntext", "3": "copied\ntext", "4": "four"}


def test_template_at_the_ends_of_marked_articles_goes(spark):
    page = lambda body: f"<article><p>By the desk</p>{body}<p>Read more of this series</p></article>"
    own = ["<p>first story, at length</p><p>shared words</p><p>its end, at length</p>", "<p>second story, at length</p><p>shared words</p><p>more of it</p>",
           "<p>third story, at length</p><p>shared words</p><p>and the last of it</p>"]
    rows = [(f"http://h.example/n/{i}", page(x)) for i, x in enumerate(own)]
    rows += [(f"http://c.example/n/{i}", "<article><p>copied text</p></article>") for i in range(3)]
    got = {x.url: x.text for x in html_text.extract(spark.createDataFrame(rows, "url string, html string")).collect()}
    assert got["http://h.example/n/1"] == "second story, at length\nshared words\nmore of it"  # the shared line amid it stays
    assert got["http://h.example/n/0"].startswith("By the desk")  # one neighbour alone decides nothing inside a mark
    assert {got[f"http://c.example/n/{i}"] for i in range(3)} == {"copied text"}


def test_pages_table_gives_its_articles(spark):
    got = queries.QUERIES["op2_page_differencing"](spark, SF_SMALL).collect()
    pages = {r.page_id: r.html for r in read(spark, "pages").collect()}
    assert len(got) == len(pages)
    import html
    for r in got:
        body = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<br>", " ", re.sub("</?b>", "", x))).split()) for x in re.split("</?(?:p|h1)>", body)]
        assert r.text == "\n".join(x for x in parts if x) and r.n_chars == len(r.text)


# ---- op3 ----

def norm(t):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    return re.sub(r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]", " ", t).split(" ")


def grams(t):
    w = [x for x in norm(t) if x]
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


@pytest.mark.parametrize("shard", [4096, 7])
def test_leaks_equal_shingle_search(spark, shard, monkeypatch):
    monkeypatch.setattr(decontaminate, "SHARD", shard)
    items, docs = read(spark, "benchmark"), read(spark, "documents").select("doc_id", "text")
    r = np.random.default_rng(4)
    plant = []
    for i, row in enumerate(items.limit(25).collect()):
        w = row.text.split()
        if i % 3 == 1:
            w[r.integers(len(w))] = "changed"  # one word differs: five shingles of it are lost
        if i % 3 == 2:
            w = [x.upper() for x in w]
        plant.append((10_000 + i, " ".join(["filler words stand here"] * int(r.integers(0, 60)) + w + ["and", "after"] * int(r.integers(0, 90)))))
    docs = docs.unionByName(spark.createDataFrame(plant, "doc_id long, text string"))
    got = decontaminate.find_leaks(docs, decontaminate.build_index(items)).collect()
    want = set()
    its = {x.item_id: grams(x.text) for x in items.collect()}
    for d in docs.collect():
        g = grams(d.text)
        want |= {(d.doc_id, i) for i, s in its.items() if len(s & g) / len(s) >= 0.8}
    assert {(x.doc_id, x.item_id) for x in got} == want and len(got) == len(want) > 20
    assert all(0.6 <= x.score <= 1 and min(x.question_overlap, x.answer_overlap) >= 0.5 for x in got)


def test_block_max_retrieval_is_exact():
    r = np.random.default_rng(2)
    texts = [" ".join(f"w{k}" for k in r.zipf(1.3, r.integers(3, 40)) % 400) for _ in range(120)]
    s = decontaminate.build_shard(list(range(120)), decontaminate.parse_items(texts, [None] * 120))
    pairs = sorted({(p, int(t)) for p in range(40) for t in r.integers(0, len(s.terms), 60)})
    pid, term = (np.array(x) for x in zip(*pairs))
    for threshold in (0.05, 0.3, 0.6):
        op, it, _ = decontaminate.retrieve(s, pid, term, threshold)
        full = np.zeros((40, len(s.items)))
        for p, t in pairs:
            a, b = s.post_at[t], s.post_at[t + 1]
            full[p, s.post_item[a:b]] += s.post_impact[a:b]
        sure = {(int(p), int(i)) for p, i in zip(*np.nonzero(full >= threshold + 1e-3))}
        may = {(int(p), int(i)) for p, i in zip(*np.nonzero(full >= threshold * (1 - 1e-3)))}
        assert sure <= set(zip(op.tolist(), it.tolist())) <= may


def test_leaks_edges(spark, edge, none):
    items = spark.createDataFrame([(1, "alpha beta gamma delta one two three four five six"), (2, "a b"), (3, None), (4, ""), (None, "solo item with no id here ok"),
                                   (1, "alpha beta gamma delta one two three four five six")], "item_id long, text string")
    index = decontaminate.build_index(items)
    docs = spark.createDataFrame([(1, "x Alpha, beta gamma\ndelta one two three four five six."), (1, None), (2, "b a b"), (None, "solo item with no id here ok"), (3, "")],
                                 "doc_id long, text string")
    got = sorted({(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, index).collect()}, key=str)
    assert got == sorted([(1, 1), (2, 2), (None, None)], key=str)
    assert decontaminate.drop_leaks(docs, index).count() == 2
    kept = decontaminate.drop_leaks(edge, index)
    assert kept.columns == edge.columns and kept.count() <= edge.count()
    assert decontaminate.find_leaks(none, index).count() == 0 and decontaminate.drop_leaks(none, index).count() == 0
    empty = decontaminate.build_index(items.limit(0))
    assert empty == [] and decontaminate.drop_leaks(docs, empty).count() == 5
    qa = spark.createDataFrame([(7, "what is the answer to all", "it is forty two of course yes")], "item_id long, q string, a string")
    index = decontaminate.build_index(qa, question_col="q", answer_col="a")
    docs = spark.createDataFrame([(1, "well what is the answer to all it is forty two of course yes"), (2, "what is the answer to all and nothing else")],
                                 "doc_id long, text string")
    assert [r.doc_id for r in decontaminate.find_leaks(docs, index).collect()] == [1]
    with pytest.raises(ValueError):
        decontaminate.build_index(items, max_items=2)


def test_scores_do_not_depend_on_the_shard(spark, monkeypatch):
    items, docs = read(spark, "benchmark"), read(spark, "documents").select("doc_id", "text").unionByName(
        read(spark, "benchmark").select((F.col("item_id") + 5000).alias("doc_id"), F.concat(F.lit("before it "), "text", F.lit(" and more after")).alias("text")))
    got = []
    for shard in (7, 4096, 1):
        monkeypatch.setattr(decontaminate, "SHARD", shard)
        index = decontaminate.build_index(items)
        assert len(index) == -(-items.count() // shard)
        got.append({(r.doc_id, r.item_id): (round(r.score, 4), r.overlap) for r in decontaminate.find_leaks(docs, index).collect()})
    # a passage is as long as its shard's longest item allows, so the best passage of a pair may differ; its overlap not
    assert got[0].keys() == got[1].keys() == got[2].keys() and len(got[0]) >= items.count()
    assert {k: v[1] for k, v in got[0].items()} == {k: v[1] for k, v in got[1].items()}
    parsed = decontaminate.parse_items([r.text for r in items.collect()], [None] * items.count())
    stats = decontaminate.statistics(parsed)
    whole = decontaminate.build_shard(list(range(len(parsed))), parsed, stats)
    for at in range(0, len(parsed), 7):
        s = decontaminate.build_shard(list(range(at, at + 7)), parsed[at:at + 7], stats)
        for i, item in enumerate(s.items):
            one = np.sort(s.post_impact[s.post_item == i])
            assert np.allclose(one, np.sort(whole.post_impact[whole.post_item == whole.items.index(item)]))


def test_leaks_with_text_ids_and_clashing_names(spark):
    items = spark.createDataFrame([("q1", "one two three four five six"), (None, "seven eight nine ten eleven twelve")], "item_id string, text string")
    docs = spark.createDataFrame([("d", "zero one two three four five six seven eight nine ten eleven twelve")], "score string, text string")
    got = decontaminate.find_leaks(docs, decontaminate.build_index(items), id_col="score")
    assert got.columns == ["_score", "item_id", "score", "overlap", "question_overlap", "answer_overlap", "first_word"]
    assert sorted(((r["_score"], r.item_id) for r in got.collect()), key=str) == [("d", "q1"), ("d", None)]


#: words that agree under any polynomial modulo 2^64
PARITY = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
OTHER = PARITY.translate(str.maketrans("ab", "ba"))


def test_long_words_that_differ_are_no_leak(spark):
    items = spark.createDataFrame([(1, f"one two {PARITY} three four five")], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"one two {PARITY} three four five"), (2, f"one two {OTHER} three four five")], "doc_id long, text string")
    assert [r.doc_id for r in decontaminate.find_leaks(docs, decontaminate.build_index(items)).collect()] == [1]


# ---- op4 ----

def test_classifier_learns_and_thresholds_by_language(spark):
    r = np.random.default_rng(1)
    rows, labels = [], []
    for i in range(900):
        w = [f"w{k}" for k in r.integers(0, 300, r.integers(5, 80))]
        toxic = int(i % 5 == 0)
        if toxic:
            for _ in range(3):
                w.insert(int(r.integers(len(w))), ["vile", "nasty", "foul"][r.integers(3)])
        rows.append((i, " ".join(w), "en" if i % 2 else "de"))
        labels.append((i, toxic))
    rows += [(2000, None, "en"), (2001, "", None), (2001, "", None), (None, "vile nasty foul " * 8, "fr")]
    labels += [(2000, None), (None, 1), (3000, 1)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    m = toxicity.fit(d, spark.createDataFrame(labels, "doc_id long, toxic int"))
    out = toxicity.score(d, m).toPandas()
    assert len(out) == len(rows) and ((out.score >= 0) & (out.score <= 1)).all()
    seen = out[out.doc_id < 900]
    held = seen[[zlib.crc32(str(int(i)).encode()) % 3 == 1 for i in seen.doc_id]]
    right = (held.predicted == (held.doc_id % 5 == 0).astype(int)).mean()
    assert right > 0.95
    assert out[out.doc_id.isna()].score.iloc[0] > 0.7
    # the score does not depend on id, language or batch
    other = toxicity.score(d.select((F.col("doc_id") + 7).alias("doc_id"), "text", F.lit("xx").alias("lang")).repartition(5), m).toPandas()
    assert np.allclose(sorted(out.score), sorted(other.score), atol=1e-6)


def test_only_labelled_rows_choose_the_cuts(spark, monkeypatch):
    r = np.random.default_rng(3)
    rows = [(i, " ".join(f"w{k}" for k in r.integers(0, 200, 20)) + (" vile nasty" if i % 3 == 0 else ""), "en") for i in range(900)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)] + [(5000, 1)], "doc_id long, toxic int")
    scored, real = [], toxicity._logit_bins
    monkeypatch.setattr(toxicity, "_logit_bins", lambda x, m: (scored.append(x.count()), real(x, m))[1])
    a, b = toxicity.fit(d, labels, max_rows=100), toxicity.fit(d, labels, max_rows=100, max_broadcast=0)
    usable = [i for i in range(300) if zlib.crc32(str(i).encode()) % 3 != 1]
    assert scored[0] < len(usable) < scored[1] and (a.scale, a.shift, a.cuts) == (b.scale, b.shift, b.cuts)
    # the bound on the drawn bytes leaves out whole texts: over a 64th of it, or beyond the sum
    assert toxicity.fit(d, labels, max_rows=100, max_bytes=64 * 160).scale > 0
    assert toxicity.fit(d, labels, max_rows=100, max_bytes=64).scale == 0


def test_cuts_use_all_rows_outside_the_fit(spark):
    r = np.random.default_rng(2)
    rows, labels = [], []
    for i in range(1200):
        toxic = i % 3 == 0
        w = [f"w{k}" for k in r.integers(0, 200, 20)] + (["vile", "nasty"] if toxic else [])
        rows.append((i, " ".join(w), "fr" if i % 8 == 0 else "en"))
        labels.append((i, int(toxic)))
    rows += [(2, "another text of a repeated id", "en")] * 400
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    m = toxicity.fit(d, spark.createDataFrame(labels, "doc_id long, toxic int"), max_rows=120)
    # about 33 of the 50 positives of fr are on the training side; a fifth of 60 drawn would be no 30
    assert set(m.cuts) == {"en", "fr"}
    out = toxicity.score(d.where("doc_id <> 2"), m).toPandas()
    assert (out.rejected == (out.doc_id % 3 == 0)).mean() > 0.9


def test_classifier_edges(spark, edge, none):
    lab = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    for labels in (lab, lab.limit(0), lab.where("toxic = 1")):
        m = toxicity.fit(edge, labels)
        out = toxicity.score(edge, m)
        assert out.columns == [*edge.columns, "_score", "predicted", "cut", "_rejected"]
        assert out.where("_score between 0 and 1").count() == edge.count()
    assert toxicity.score(none, m).count() == 0
    assert toxicity.fit(none, lab).scale == 0


def test_gradient_matches_differences():
    texts = pa.array(["vile words of the day", "a calm text", "", "nasty nasty stuff here now"])
    y = np.array([1, 0, 0, 1], np.float32)
    m = toxicity.train(texts, y, steps=60, batch=4)
    z = toxicity.logits(m, *toxicity.text_bytes(texts))
    assert z[[0, 3]].min() > z[[1, 2]].max()


# ---- op9 ----

def test_mix_on_edge_rows(spark, edge, none):
    w = {"domain": F.lit(1), "lang": F.expr("CASE lang WHEN 'en' THEN 3 ELSE 1 END"), "source": F.lit(1)}
    out = mixing.select_mix(edge, F.lit("d"), w, (1, 2), 2)
    assert out.columns == [*edge.columns, "_epoch", "_tokens", "leaf_budget"]
    assert mixing.select_mix(none, F.lit("d"), w, (1, 2), 2).count() == 0
    everything = mixing.select_mix(edge, F.lit("d"), w, (2, 1), 2)
    assert everything.count() == 2 * edge.count()  # a budget of all supply takes every row in every epoch


def test_shortages_go_to_siblings_first(spark):
    supply = spark.createDataFrame([("a", "x", "s1", 10), ("a", "x", "s2", 1000), ("a", "y", "s3", 1000), ("b", "x", "s4", 20), ("b", "y", "s5", 30)],
                                   "domain string, lang string, source string, tokens long")
    one = {k: F.lit(1) for k in mixing.LEVELS}
    got = {r.source: r.budget for r in mixing.leaf_budgets(supply, (400, 2060), 1, one).collect()}
    # b supplies 50 of its 200; a takes 350, 175 for each language; s1's shortage stays in a, x
    assert got == {"s1": 10, "s2": 165, "s3": 175, "s4": 20, "s5": 30}
    got = mixing.leaf_budgets(supply, (7, 2060), 1, one).collect()
    assert sum(r.budget for r in got) == 7


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_sql(spark, name):
    msg = compare(queries.QUERIES[name](spark, SF_SMALL).toPandas(), duck(SF_SMALL).execute(queries.ORACLE[name]).df())
    assert msg is None, msg


# ---- op10 ----

@pytest.mark.parametrize("g,b,d", [(7, 5, 6), (100, 900, 300), (3, 2, 5), (5, 100_000, 40_000)])
def test_hypergeometric_draws(spark, g, b, d):
    n = 20_000
    cols = [F.lit(v).cast("long") for v in (g, b, d)]
    x = spark.range(n).select(shuffle_shards.hypergeometric(*cols, shuffle_shards._uniform(F.lit(11), F.col("id"))).alias("x")).toPandas().x.values
    ln = lambda p, q: math.lgamma(p + 1) - math.lgamma(q + 1) - math.lgamma(p - q + 1)
    assert x.min() >= max(0, d - b) and x.max() <= min(g, d)
    chi = df = 0
    for k in range(max(0, d - b), min(g, d) + 1):
        e = n * math.exp(ln(g, k) + ln(b, d - k) - ln(g + b, d))
        if e >= 10:
            chi, df = chi + ((x == k).sum() - e) ** 2 / e, df + 1
    assert chi <= df + 5 * math.sqrt(2 * df)


def test_matrix_margins(spark):
    counts = spark.createDataFrame([(p, n) for p, n in enumerate([5, 0, 17, 1, 100, 33, 8])], "part int, n long")
    m = {r.part: r.cells for r in shuffle_shards.communication_matrix(counts, 9, 3).collect()}
    assert {p: sum(c) for p, c in m.items()} == dict(enumerate([5, 0, 17, 1, 100, 33, 8]))
    sizes = np.sum(list(m.values()), axis=0)
    assert sizes.max() - sizes.min() <= 1 and sizes.sum() == 164 and min(min(c) for c in m.values()) >= 0


def test_shards_are_exact_and_whole(spark, edge, none):
    out = shuffle_shards.shuffle_into_shards(edge, 7, rows_per_range=3)
    assert out.columns == [*edge.columns, "_shard", "_slot"]
    by = defaultdict(list)
    rows = out.collect()
    for r in rows:
        by[r._shard].append(r._slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert Counter(map(str, (r[:-2] for r in rows))) == Counter(map(str, (tuple(r) for r in edge.collect())))
    assert shuffle_shards.shuffle_into_shards(none, 7).count() == 0
    assert shuffle_shards.shuffle_into_shards(edge.limit(2), 7).count() == 2


def test_shards_mix_uniformly(spark):
    d = spark.range(4000, numPartitions=5).withColumnRenamed("id", "doc_id")
    seen = np.zeros((5, 8))
    for seed in range(3):
        for r in shuffle_shards.shuffle_into_shards(d, 8, seed=seed).collect():
            seen[r.doc_id // 800, r.shard] += 1
    assert abs(seen - 300).max() < 75  # 300 a cell, about 15 standard deviation


def test_repeated_rows_part(spark):
    d = spark.range(2000, numPartitions=4).select((F.col("id") - F.col("id") % 2).alias("doc_id"))
    by = defaultdict(list)
    for r in shuffle_shards.shuffle_into_shards(d, 8).collect():
        by[r.doc_id].append(r.shard)
    together = sum(a == b for a, b in by.values())
    assert len(by) == 1000 and abs(together - 125) < 55  # 1 in 8, about 10 standard deviation


# ---- the pipeline ----

def test_pipeline_stages(spark):
    docs = read(spark, "documents")
    labels = {r.doc_id: r.toxic for r in read(spark, "labels").collect()}
    ids = {}
    import tempfile
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_SMALL)
        path = tempfile.mkdtemp(prefix="pipe-") + "/" + name
        out.write.parquet(path)
        new = spark.read.parquet(path)
        if name != "shard":
            assert new.columns == docs.columns
        ids[name] = Counter(r.doc_id for r in new.select("doc_id").collect())
        docs = new
    assert sum(labels.get(i, 0) for i in ids["toxicity"]) <= 0.5 * sum(labels.values())
    assert max(ids["simhash"].values()) == 1 and set(ids["simhash"]) <= set(ids["toxicity"])
    assert set(ids["mix"]) <= set(ids["decontaminate"]) <= set(ids["simhash"])
    assert ids["shard"] == ids["mix"] and {"shard", "slot"} <= set(docs.columns)


def test_pipeline_edges(spark, edge, none):
    for docs in (edge, none):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF_SMALL)
            assert out.columns[:len(docs.columns)] == docs.columns
            assert out.count() <= 2 * max(1, docs.count())


def test_pipeline_runs(spark):
    assert corpus_pipeline.run(spark, SF_SMALL).count() > 0
