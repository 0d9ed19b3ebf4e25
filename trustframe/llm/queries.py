"""The queries of this subpackage: one ``opN_<name>`` for each operator, over its
whole table with production parameters, and the DuckDB SQL of those that SQL
can state. ``corpus_pipeline.py`` adds ``pipeline``."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustframe.session import ensure_checkpoint_dir
from trustframe.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prepare(spark: SparkSession) -> None:
    """Tasks import this package from where the driver does, unless it is
    installed; intermediate tables go to the session's checkpoint folder."""
    env = spark.sparkContext.environment
    if _ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (_ROOT, env.get("PYTHONPATH", "")) if x)
    ensure_checkpoint_dir(spark)


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@register("op5_simhash_anchors")
def _op5(spark, sf_dir):
    """SimHash components of all documents (4-word shingles, at most 4 bits)."""
    from trustframe.llm import simhash
    c = simhash.classes(table(spark, sf_dir, "documents"), k=4, d=4)
    return c.select("doc_id", simhash.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


_OP6_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT doc_id, i, md5(array_to_string(w[i:i+12], ' ')) AS gram FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
f AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY gram) AS m FROM g) WHERE doc_id > m),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM f),
x AS (SELECT doc_id, p, w[p] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d)),
k AS (SELECT x.doc_id, count(c.p) AS gone, string_agg(word, ' ' ORDER BY x.p) FILTER (c.p IS NULL) AS kept
      FROM x LEFT JOIN c ON c.doc_id = x.doc_id AND c.p = x.p GROUP BY x.doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(gone, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""


@register("op6_recompression", _OP6_SQL)
def _op6(spark, sf_dir):
    """Every word covered by a 13-word window that an earlier document has goes."""
    from trustframe.llm import substring_dedup
    d = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), columns=["doc_id"])
    return d.select("doc_id", "n_words", "n_removed", "kept_sha256")


@register("op10_hypergeometric")
def _op10(spark, sf_dir):
    """All documents, shuffled uniformly into 40 shards whose counts differ by at most one."""
    from trustframe.llm import shuffle_shards
    text = F.coalesce("text", F.lit(""))
    d = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    s = shuffle_shards.shuffle_into_shards(d, 40)
    return s.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard"))


_OP8_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT rid, i, ws[i:i+4] AS gram FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS n FROM g) WHERE n > 1),
c AS (SELECT rid, sum(least(5, coalesce(nxt - i, 5))) AS n
      FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM r) GROUP BY rid),
f AS (SELECT d.rid, doc_id, source, len(ws)::BIGINT AS n_words,
             length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
             coalesce(c.n, 0)::BIGINT AS n_repeat_words
      FROM d JOIN w USING (rid) LEFT JOIN c USING (rid)),
x AS (SELECT *, (n_words > 0 AND 10 * n_symbols > n_words)::INT AS symbols,
             (n_words > 0 AND 10 * n_dup_lines > 3 * n_lines)::INT AS dup_lines,
             (n_words > 0 AND (word_chars > 12 * n_words OR word_chars < 2 * n_words))::INT AS word_length,
             (n_words > 0 AND 20 * n_repeat_words > n_words)::INT AS repeats FROM f),
h AS (UNPIVOT (SELECT source, count(*) AS n, sum(symbols)::BIGINT AS symbols, sum(dup_lines)::BIGINT AS dup_lines,
                      sum(word_length)::BIGINT AS word_length, sum(repeats)::BIGINT AS repeats FROM x GROUP BY source)
      ON symbols, dup_lines, word_length, repeats INTO NAME rule VALUE fails),
a AS (SELECT rule, sum(fails) / sum(n) AS m, sum(fails * fails * 1.0 / n) / sum(n) AS q, count(*) * 1.0 / sum(n) AS hn FROM h GROUP BY rule),
p AS (SELECT rule, m, greatest(1.0, least(1e6, m * (1 - m) / greatest(q - m * m - m * (1 - m) * hn, 1e-9) - 1)) AS s FROM a),
q AS (SELECT source, rule, n, m, s, (fails + m * s) / (n + s) AS rate FROM h JOIN p USING (rule)),
b AS (SELECT source, rule FROM q WHERE rate - 1.645::DOUBLE * sqrt(rate * (1 - rate) / (n + s + 1)) > m),
z AS (SELECT rid, string_agg(u.rule, ',' ORDER BY u.rule) AS host_failed
      FROM (UNPIVOT (SELECT rid, source, symbols, dup_lines, word_length, repeats FROM x)
            ON symbols, dup_lines, word_length, repeats INTO NAME rule VALUE v) u
      JOIN b ON b.source IS NOT DISTINCT FROM u.source AND b.rule = u.rule WHERE v = 1 GROUP BY rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND host_failed IS NULL AS kept,
       coalesce(host_failed, '') AS host_failed
FROM x LEFT JOIN z USING (rid)
"""


@register("op8_host_rules", _OP8_SQL)
def _op8(spark, sf_dir):
    """Quality counts and verdicts of all documents; the source is the host."""
    from trustframe.llm import host_rules
    q = host_rules.apply_host_rules(table(spark, sf_dir, "documents"), F.col("source"), columns=["doc_id"])
    return q.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "host_failed")


#: the mixture of the query and of the pipeline
MIX_SEED, MIX_EPOCHS, MIX_SHARE = 42, 3, (4, 5)
_MIX_DOMAIN = """CASE WHEN source RLIKE '^src[0-9]+$' THEN
    element_at(array('web', 'books', 'code', 'wiki'), CAST(substring(source, 4) AS INT) % 4 + 1) ELSE 'other' END"""
_MIX_WEIGHT = {"domain": "CASE domain WHEN 'web' THEN 8 WHEN 'books' THEN 5 WHEN 'code' THEN 4 WHEN 'wiki' THEN 2 ELSE 1 END",
               "lang": "CASE lang WHEN 'en' THEN 6 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END",
               "source": "CASE WHEN source = 'src0' THEN 2 ELSE 1 END"}


def mix(docs: DataFrame, share: tuple[int, int] = MIX_SHARE, max_epochs: int = MIX_EPOCHS,
        columns: list[str] | None = None) -> DataFrame:
    from trustframe.llm import mixing
    return mixing.select_mix(docs, F.expr(_MIX_DOMAIN), {k: F.expr(v) for k, v in _MIX_WEIGHT.items()}, share, max_epochs,
                             MIX_SEED, columns=columns)


def _share_sql(nodes: str, parent: str, name: str) -> str:
    over = f"OVER (PARTITION BY {parent})"
    by = f"(PARTITION BY {parent} ORDER BY supply / weight, {name} NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return f"""SELECT *, part + CASE WHEN NOT short AND row_number() OVER (PARTITION BY {parent} ORDER BY rem DESC, {name} NULLS FIRST)
             <= greatest(0, least(up, sum(supply) {over}) - sum(part) {over}) THEN 1 ELSE 0 END AS budget
    FROM (SELECT *, CASE WHEN short THEN supply ELSE (rest * weight) // w_rest END AS part,
                 CASE WHEN short THEN -1 ELSE (rest * weight) % w_rest END AS rem
          FROM (SELECT *, up - sum(CASE WHEN short THEN supply ELSE 0 END) {over} AS rest,
                       sum(CASE WHEN short THEN 0 ELSE weight END) {over} AS w_rest
                FROM (SELECT *, supply * (sum(weight) {over} - coalesce(sum(weight) OVER {by}, 0))
                             <= (up - coalesce(sum(supply) OVER {by}, 0)) * weight AS short FROM ({nodes}) a) b) c) d"""


_OP9_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(doc_id::VARCHAR, '') AS id, md5(coalesce(text, '')) AS th, lang, source,
       len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::HUGEINT AS tokens,
       CASE WHEN regexp_matches(source, '^src[0-9]+$') THEN
         (['web', 'books', 'code', 'wiki'])[substring(source, 4)::INT % 4 + 1] ELSE 'other' END AS domain FROM documents),
s AS (SELECT domain, lang, source, sum(tokens)::HUGEINT AS all_tokens, sum(tokens)::HUGEINT * @EPOCHS AS supply FROM d GROUP BY ALL),
t AS (SELECT (sum(all_tokens) * @NUM) // @DEN AS up FROM s),
a0 AS (SELECT domain, sum(supply)::HUGEINT AS supply, any_value(t.up)::HUGEINT AS up, (@WD)::HUGEINT AS weight, 0 AS root FROM s, t GROUP BY domain),
a AS (@A),
b0 AS (SELECT s.domain, s.lang, sum(s.supply)::HUGEINT AS supply, any_value(a.budget)::HUGEINT AS up, (@WL)::HUGEINT AS weight
       FROM s JOIN a ON a.domain IS NOT DISTINCT FROM s.domain GROUP BY s.domain, s.lang),
b AS (@B),
c0 AS (SELECT s.*, b.budget::HUGEINT AS up, (@WS)::HUGEINT AS weight FROM s JOIN b
       ON b.domain IS NOT DISTINCT FROM s.domain AND b.lang IS NOT DISTINCT FROM s.lang),
c AS (@C),
e AS (SELECT d.*, c.all_tokens, c.budget, e.epoch, c.budget - c.all_tokens * e.epoch AS need, md5('@SEED:' || e.epoch || ':' || id) AS key
      FROM d JOIN c ON c.domain IS NOT DISTINCT FROM d.domain AND c.lang IS NOT DISTINCT FROM d.lang AND c.source IS NOT DISTINCT FROM d.source
      JOIN range(@EPOCHS) e(epoch) ON c.all_tokens * e.epoch < c.budget),
g AS (SELECT domain, lang, source, epoch, key, th, sum(tokens) AS t, any_value(need) AS need, any_value(all_tokens) AS all_tokens
      FROM e GROUP BY ALL),
p AS (SELECT *, coalesce(sum(t) OVER (PARTITION BY domain, lang, source, epoch ORDER BY key, th
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM g)
SELECT e.doc_id, e.domain, e.lang, e.source, e.epoch::INT AS epoch, e.tokens::BIGINT AS tokens, e.budget::BIGINT AS leaf_budget
FROM e JOIN p ON p.domain IS NOT DISTINCT FROM e.domain AND p.lang IS NOT DISTINCT FROM e.lang AND p.source IS NOT DISTINCT FROM e.source
  AND p.epoch = e.epoch AND p.key = e.key AND p.th = e.th
WHERE p.need >= p.all_tokens OR (p.before < p.need AND 2 * p.before + p.t <= 2 * p.need)
"""
for _k, _v in (("@A", _share_sql("SELECT * FROM a0", "root", "domain")), ("@B", _share_sql("SELECT * FROM b0", "domain", "lang")),
               ("@C", _share_sql("SELECT * FROM c0", "domain, lang", "source")), ("@WD", _MIX_WEIGHT["domain"]),
               ("@WL", _MIX_WEIGHT["lang"]), ("@WS", _MIX_WEIGHT["source"]), ("@EPOCHS", str(MIX_EPOCHS)), ("@NUM", str(MIX_SHARE[0])),
               ("@DEN", str(MIX_SHARE[1])), ("@SEED", str(MIX_SEED))):
    _OP9_SQL = _OP9_SQL.replace(_k, _v)


@register("op9_source_mix", _OP9_SQL)
def _op9(spark, sf_dir):
    """The documents of each epoch that fill the budgets of the domain-language-source tree."""
    d = table(spark, sf_dir, "documents").withColumn("domain", F.expr(_MIX_DOMAIN))
    return mix(d, columns=["doc_id", "domain", "lang", "source"])


@register("op3_bm25_leaks")
def _op3(spark, sf_dir):
    """Benchmark items found in the documents: one row per document and item."""
    from trustframe.llm import decontaminate
    index = decontaminate.build_index(table(spark, sf_dir, "benchmark"))
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), index)


@register("op4_toxicity_cnn")
def _op4(spark, sf_dir):
    """Toxicity score of all documents, learned from two thirds of the labels."""
    from trustframe.llm import toxicity
    d = table(spark, sf_dir, "documents")
    model = toxicity.fit(d, table(spark, sf_dir, "labels"))
    s = toxicity.score(d, model, columns=["doc_id"])
    return s.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted",
                    F.col("cut").alias("language_cut"), F.col("rejected").alias("above_language_cut"))


@register("op1_trigram_secrets")
def _op1(spark, sf_dir):
    """Secrets in all documents: base counts and digest, and every span."""
    from trustframe.llm import secret_scan as ss
    d = ss.find_secrets(table(spark, sf_dir, "documents"), columns=["doc_id"])
    base = [r.kind for r in ss.BASE]
    n = [F.expr(f"CAST(size(filter(secrets, s -> s.kind = '{k}')) AS BIGINT)").alias(f"n_{k}") for k in base]
    return d.select("doc_id", *n, F.sha2(ss.spans(F.col("secrets"), base).cast("binary"), 256).alias("base_sha256"),
                    ss.spans(F.col("secrets")).alias("spans"))


@register("op2_page_differencing")
def _op2(spark, sf_dir):
    """Main text of every page."""
    from trustframe.llm import html_text
    t = html_text.extract(table(spark, sf_dir, "pages"), columns=["page_id", "url"])
    return t.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_shared")


_OP7_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT doc_id, CASE WHEN text = '' THEN [] ELSE string_split(
        regexp_replace(text, '\n([^\n]*[^\x20\x09-\x0D])', chr(57344) || '\1', 'g'), chr(57344)) END AS ls FROM d),
x AS (SELECT doc_id, i, ls[i] AS line, regexp_replace(ls[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS t,
             len(list_filter(regexp_split_to_array(ls[i], '[\x20\x09-\x0D]+'), lambda w: w <> '')) >= 50 AS is_long
      FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM l)),
w AS (SELECT *, lead(t) OVER (PARTITION BY doc_id ORDER BY i) AS t2 FROM x),
r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY t, t2 ORDER BY doc_id, i) > 1 AS again FROM w WHERE t2 IS NOT NULL),
o AS (SELECT doc_id, i, row_number() OVER (PARTITION BY t ORDER BY doc_id, i) > 1 AS again FROM w WHERE is_long),
g AS (SELECT w.doc_id, w.i, line, coalesce(a.again, false) OR coalesce(b.again, false) OR coalesce(c.again, false) AS gone
      FROM w LEFT JOIN r a ON a.doc_id = w.doc_id AND a.i = w.i LEFT JOIN r b ON b.doc_id = w.doc_id AND b.i = w.i - 1
             LEFT JOIN o c ON c.doc_id = w.doc_id AND c.i = w.i)
SELECT l.doc_id, len(ls)::BIGINT AS n_lines, coalesce(sum(gone::INT), 0)::BIGINT AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM l LEFT JOIN g ON g.doc_id = l.doc_id GROUP BY l.doc_id, ls
"""


@register("op7_winnowed_lines", _OP7_SQL)
def _op7(spark, sf_dir):
    """All documents without later copies of runs of two and more lines, and of lines of 50 and more words."""
    from trustframe.llm import line_dedup
    d = line_dedup.remove_repeated_runs(table(spark, sf_dir, "documents"), run=2, columns=["doc_id"], long_words=50)
    return d.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


#: (host, path, verdict)
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]
_OP13_SQL = r"""
WITH r AS (SELECT * FROM (VALUES @RULES) r(h, p, v)),
x AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
u AS (SELECT host, path, arg_max({'rule': h || p, 'verdict': v}, length(h || p)) AS best
      FROM (SELECT DISTINCT host, path FROM x) JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY host, path)
SELECT page_id, x.host, x.path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict
FROM x LEFT JOIN u ON x.host = u.host AND x.path = u.path
""".replace("@RULES", ", ".join(str(r) for r in URL_RULES))


@register("op13_url_rules", _OP13_SQL)
def _op13(spark, sf_dir):
    """Verdict on the url of every page."""
    from trustframe.llm import url_filter
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules, columns=["page_id"])


_OP11_SQL = r"""
WITH lab AS (SELECT doc_id, max(coalesce(quality = 1, false)::INT) AS good, max(coalesce(toxic = 1, false)::INT) AS toxic FROM labels GROUP BY doc_id),
w AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS low,
             list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
m AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
             (len(ws) < 200)::INT + 2 * (100 * len(list_distinct(ws)) < 50 * len(ws))::INT
             + 4 * (100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 3 * length(text))::INT
             + 8 * regexp_matches(text, '[#$%&*|]')::INT + 16 * coalesce(w.doc_id > low, false)::INT AS mask
      FROM w LEFT JOIN lab USING (doc_id)),
c AS (SELECT part, mask, good, toxic, count(*) AS n FROM m GROUP BY ALL),
l AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) l(f, b)),
o AS (SELECT l1.f || l2.f || l3.f || l4.f || l5.f AS filter_order, [l1.b, l2.b, l3.b, l4.b, l5.b] AS bits
      FROM l l1, l l2, l l3, l l4, l l5 WHERE l1.b + l2.b + l3.b + l4.b + l5.b = 31 AND l1.b | l2.b | l3.b | l4.b | l5.b = 31),
s AS (SELECT filter_order, step, bits[step] AS b, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS earlier FROM (SELECT *, unnest([1, 2, 3, 4, 5]) AS step FROM o)),
r AS (SELECT part, filter_order, step, b,
             sum(n) FILTER (mask & (earlier | b) = 0) AS kept, sum(n) FILTER (mask & earlier = 0 AND mask & b <> 0) AS removed,
             sum(n) FILTER (mask & earlier <> 0 AND mask & b <> 0) AS redundant, sum(n) FILTER (mask = b) AS unique_fails,
             sum(n) FILTER (mask & earlier = 0 AND mask & b <> 0 AND good = 1) AS good_lost,
             sum(n) FILTER (mask & earlier = 0 AND mask & b <> 0 AND toxic = 1) AS toxic_lost
      FROM c, s GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost,
       coalesce(toxic_lost, 0)::BIGINT AS toxic_lost, coalesce(sum(removed) OVER (PARTITION BY part, b), 0)::BIGINT AS shapley
FROM r
"""


@register("op11_filter_audit", _OP11_SQL)
def _op11(spark, sf_dir):
    """What five filters remove from all documents, per language, in all 120 orders."""
    from trustframe.llm import filter_audit
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), F.col("lang"))


_OP12_SQL = r"""
WITH a AS (SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
t AS (SELECT count(*) AS nn, sum(len(ts))::BIGINT AS ll FROM a WHERE len(ts) > 0),
p AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(ts) AS term FROM a) GROUP BY ALL),
q AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)),
w AS (SELECT term, floor(1000 * ln((2 * any_value(nn) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, t GROUP BY term),
x AS (SELECT a.rid, a.doc_id, 10 + ((90 * len(ts) * nn) // ll)::BIGINT AS m FROM a, t),
s AS (SELECT item_id, rid, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
      FROM q JOIN p USING (term) JOIN w USING (term) JOIN x USING (rid) GROUP BY item_id, rid)
SELECT item_id, rank::INT AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s JOIN x USING (rid) WHERE score > 0) WHERE rank <= 10
"""


@register("op12_lexical_search", _OP12_SQL)
def _op12(spark, sf_dir):
    """The ten best of all documents for each benchmark item."""
    from trustframe.llm import lexical_search
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10)
