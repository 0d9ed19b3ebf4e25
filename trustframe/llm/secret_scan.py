"""Secret scan with a trigram index.

Every rule is a regular expression. Its Boolean trigram query is derived from the
expression's syntax tree: literals that follow each other are joined into strings,
alternatives give ORs, sequences ANDs, and what may be absent or is any of a large
class asks for nothing. The texts of a batch are indexed as one segment: the trigrams
that some rule asks for get sorted posting lists of texts. A rule's query is answered
by intersecting and uniting postings, and only the candidates are verified with
the expression. A rule without mandatory trigrams is verified on every text.

Trigrams are bytes of the UTF-8 text with A-Z folded, so a query holds for either
case. Segments are batches of whole texts: no index row crosses a task, nothing is
shuffled, and a lost task rebuilds its own segments only.
"""

from __future__ import annotations

import re
import re._constants as C  # the syntax tree of the standard library's own parser
import re._parser as parser
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from trustframe.llm.frames import free_names
from trustframe.llm.textarrays import LOWER, slices, text_bytes

_MAX_EXACT = 64   # strings followed at once; beyond, the query is weaker but still right
_SLICE = 1 << 22


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches whose ``group`` has at least ``least`` characters."""
    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The kinds asked for, in their order
BASE = (
    Rule("assign", r"((?ai:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    # runs of 32 and more: the same spans as [0-9a-f]+ with shorter ones left out
    Rule("hex", r"[0-9a-f]{32,}"),
)
#: further credentials with a fixed form
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,255}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,250}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("url_password", r"://[^\s:/@]{1,64}:[^\s:/@]{3,64}@"),
)
RULES = BASE + MORE

# ---- trigram queries: True, ("and", parts) or ("or", parts); a str is one trigram ----


def _and(*qs):
    parts = []
    for q in qs:
        if q is True:
            continue
        parts += q[1] if isinstance(q, tuple) and q[0] == "and" else [q]
    parts = list(dict.fromkeys(parts))
    return True if not parts else parts[0] if len(parts) == 1 else ("and", tuple(parts))


def _or(qs):
    qs = list(dict.fromkeys(qs))
    if not qs or any(q is True for q in qs):
        return True
    # a AND b is no choice beside a
    parts = [set(q[1]) if isinstance(q, tuple) and q[0] == "and" else {q} for q in qs]
    qs = [q for q, p in zip(qs, parts) if not any(o < p for o in parts)]
    return qs[0] if len(qs) == 1 else ("or", tuple(qs))


def _ask(strings) -> object:
    """Some string of these is in the text."""
    def one(s: str):
        b = s.lower().encode()
        return _and(*[b[i:i + 3] for i in range(len(b) - 2)]) if s.isascii() else True
    return _or([one(s) for s in strings])


def _walk(tree) -> tuple[set[str] | None, object]:
    """(every string it can match, if few; else None, query that any match fulfils)."""
    now, query = {""}, True

    def flush():
        nonlocal now, query
        query = _and(query, _ask(now))
        now = {""}
    exact = True
    for op, arg in tree:
        found, q = None, True
        if op is C.LITERAL:
            found = {chr(arg).lower()}
        elif op is C.IN and len(arg) <= 8 and all(o is C.LITERAL for o, _ in arg):
            found = {chr(a).lower() for _, a in arg}
        elif op is C.SUBPATTERN:
            found, q = _walk(arg[-1])
        elif op is C.BRANCH:
            sides = [_walk(s) for s in arg[1]]
            if all(s[0] is not None for s in sides):
                found = set().union(*[s[0] for s in sides])
            q = _or([_and(s[1], _ask(s[0])) if s[0] is not None else s[1] for s in sides])
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT):
            lo, hi, sub = arg
            inner, inner_q = _walk(sub)
            if inner is not None and hi == 1:
                found = inner | {""} if lo == 0 else inner
            elif inner is not None and lo == hi and lo <= 8:
                found = {""}
                for _ in range(lo):
                    found = {a + b for a in found for b in inner} if len(found) * len(inner) <= _MAX_EXACT else None
                    if found is None:
                        break
            if found is None and lo > 0:
                q = _and(inner_q, _ask(inner)) if inner is not None else inner_q
        elif op is C.AT:
            found = {""}
        if found is not None and len(now) * len(found) <= _MAX_EXACT:
            now = {a + b for a in now for b in found}
            continue
        exact = False
        flush()
        if found is not None and len(found) <= _MAX_EXACT:
            now = found
        else:
            query = _and(query, q if found is None else _ask(found))
    if exact:
        return now, True
    flush()
    return None, query


def trigram_query(pattern: str):
    """The query of a pattern; True if it has no mandatory trigram."""
    strings, q = _walk(parser.parse(pattern))
    return _and(q, _ask(strings)) if strings is not None else q


def wanted(q) -> set[bytes]:
    if q is True:
        return set()
    return {q} if isinstance(q, bytes) else set().union(*[wanted(x) for x in q[1]])


# ---- index of a segment ----

def postings(buf: np.ndarray, offs: np.ndarray, grams: list[bytes]) -> dict[bytes, np.ndarray]:
    """Sorted text numbers for each of these trigrams."""
    code = {int.from_bytes(g, "big"): i for i, g in enumerate(grams)}
    table = np.full(1 << 24, -1, np.int16)
    table[list(code)] = list(code.values())
    b = LOWER[buf].astype(np.int32)
    at = np.zeros(0, np.int64)
    if len(b) >= 3:
        which = table[b[:-2] << 16 | b[1:-1] << 8 | b[2:]]
        at = np.flatnonzero(which >= 0)
    text = np.searchsorted(offs, at, "right") - 1
    ok = at + 3 <= offs[text + 1]
    pairs = np.unique(which[at[ok]].astype(np.int64) * len(offs) + text[ok]) if len(at) else at
    edge = np.searchsorted(pairs, np.arange(len(grams) + 1) * len(offs))
    return {g: pairs[edge[i]:edge[i + 1]] - i * len(offs) for i, g in enumerate(grams)}


def candidates(q, post: dict[bytes, np.ndarray], n: int) -> np.ndarray:
    if q is True:
        return np.arange(n)
    if isinstance(q, bytes):
        return post[q]
    parts = [candidates(x, post, n) for x in q[1]]
    out = parts[0]
    for p in parts[1:] if q[0] == "or" else sorted(parts[1:], key=len):
        out = np.union1d(out, p) if q[0] == "or" else np.intersect1d(out, p, assume_unique=True)
    return out


def verify(rule: Rule, expr: re.Pattern, text: str) -> list[tuple[int, int]]:
    return [m.span() for m in expr.finditer(text) if m.end(rule.group) - m.start(rule.group) >= rule.least]


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text",
                 columns: list[str] | None = None) -> DataFrame:
    """``columns`` of docs (all by default) and secrets: an array of (kind, start,
    end, value) by start, then in the rules' order; offsets are code points, the end
    exclusive. The whole text is searched; a null or empty text has no secret.
    A clashing name gets a leading "_"."""
    columns = docs.columns if columns is None else columns
    out, = free_names(docs.select(*[F.col(f"`{c}`") for c in columns]), "secrets")
    queries = [trigram_query(r.pattern) for r in rules]
    grams = sorted(set().union(*[wanted(q) for q in queries]))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.string())]))

    def run(batches):
        exprs = [re.compile(r.pattern) for r in rules]
        for b in batches:
            col = b.column(text_col)
            buf, offs = text_bytes(col)
            found = [[] for _ in range(b.num_rows)]
            for lo, hi in slices(offs, _SLICE):
                part, o = buf[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
                post = postings(part, o, grams)
                data = part.tobytes()
                texts: dict[int, str] = {}
                for k, (rule, q, expr) in enumerate(zip(rules, queries, exprs)):
                    for i in candidates(q, post, hi - lo).tolist():
                        t = texts.get(i)
                        if t is None:
                            t = texts[i] = data[o[i]:o[i + 1]].decode()
                        for s, e in verify(rule, expr, t):
                            found[lo + i].append((s, k, e, t[s:e]))
            rows = [[{"kind": rules[k].kind, "start": s, "end": e, "value": v} for s, k, e, v in sorted(f)] for f in found]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in columns], pa.array(rows, kind)], [*columns, out])

    src = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*columns, text_col])])
    schema = src.select(*[F.col(f"`{c}`") for c in columns]).schema.add(
        out, DataType.fromDDL("array<struct<kind:string,start:int,end:int,value:string>>"))
    return src.mapInArrow(run, schema)


def spans(secrets: Column, kinds: list[str] | None = None) -> Column:
    """kind:start:end of each secret (of these kinds), comma-joined."""
    if kinds is not None:
        secrets = F.filter(secrets, lambda s: s.kind.isin(kinds))
    return F.array_join(F.transform(secrets, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """docs with each secret in the text replaced by ``mask`` (overlapping ones by one)."""
    name, = free_names(docs, "__secrets")
    d = find_secrets(docs.withColumn(name, F.lit(0)), rules, text_col, docs.columns)
    s = d.columns[-1]
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(a: Column, x: Column) -> Column:
        text = F.col(f"`{text_col}`")
        return F.when(x.end <= a.at, a).otherwise(F.struct(
            x.end.alias("at"), F.when(x.start < a.at, a.out).otherwise(
                F.concat(a.out, F.substr(text, a.at + 1, x.start - a.at), F.lit(mask))).alias("out")))
    cut = F.aggregate(F.col(f"`{s}`"), start, step, lambda a: F.concat(a.out, F.substr(F.col(f"`{text_col}`"), a.at + 1)))
    return d.withColumn(text_col, cut).select(*[F.col(f"`{c}`") for c in docs.columns])
