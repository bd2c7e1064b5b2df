"""Secret scan over a trigram inverted index, with DataFrame functions only.

Each rule's pattern is read once on the driver and turned into a Boolean query
over trigrams: every match must contain all trigrams of at least one clause.
One scan posts, for all trigrams that some rule asks for, the rows that hold
them; a rule's candidates are the rows in the postings of all trigrams of a
clause; the pattern then verifies candidates.  Rules whose matches need no
trigram are verified on every row.  Trigrams are taken from lower-cased text,
so rules that ignore case use the same index.

Empty cases: a null or empty text has no spans and the hash of an empty
string; an empty table gives no rows; rows repeated with one id and text get
equal results each.
"""

from __future__ import annotations

import re._constants as C
import re._parser as P
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.llm import spans as S
from fleetpulse.llm.common import documents, id_key, text_hash

MAX_TEXTS = 64             # alternatives followed for one pattern element; more: any text


@dataclass(frozen=True)
class Rule:
    """A kind, its pattern, and what a match must fulfil besides.

    ``pattern`` is the rule as stated (the trigram query comes from it);
    ``java`` may state the same matches in a form that needs no stack.
    """

    kind: str
    pattern: str
    java: str | None = None
    value_group: int = 0
    min_length: int = 0


# The base rules, in the order of their kinds.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = (
    Rule("assign", ASSIGN, value_group=2, min_length=8),
    # a run shorter than the minimum holds no match, so the minimum may stand in the pattern
    Rule("access", r"AKIA[A-Z0-9]+", java=r"AKIA[A-Z0-9]{12,}+"),
    Rule("hex", r"[0-9a-f]+", java=r"[0-9a-f]{32,}+"),
)
# Public formats of further credentials.
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("code_host", r"(?:ghp|gho|ghu|ghs|ghr)_[A-Za-z0-9]{36}"),
    Rule("chat_bot", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("map_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("pay_key", r"(?:sk|rk)_live_[A-Za-z0-9]{16,}"),
    Rule("bearer", r"(?i:bearer)\x20+[A-Za-z0-9._~+/-]{20,}"),
)

Query = tuple[frozenset[str], ...]


def _texts(node, flags: int) -> tuple[set[str] | None, list[frozenset[str]]]:
    """What one parsed element can be: all its texts (None: unbounded), and
    trigram sets of which every match contains one."""
    op, arg = node
    if op is C.LITERAL:
        return {chr(arg).lower()}, []
    if op is C.IN:
        chars: set[str] = set()
        for kind, x in arg:
            if kind is C.LITERAL:
                chars.add(chr(x).lower())
            elif kind is C.RANGE and x[1] - x[0] < MAX_TEXTS:
                chars |= {chr(c).lower() for c in range(x[0], x[1] + 1)}
            else:
                return None, []
        return (chars if len(chars) <= 8 else None), []
    if op is C.SUBPATTERN:
        return _sequence(arg[3])
    if op is C.BRANCH:
        parts = [_sequence(x) for x in arg[1]]
        if all(t is not None for t, _ in parts):
            return set().union(*(t for t, _ in parts)), []
        # without a query for some branch there is none for the whole
        if all(t is not None and min(map(len, t)) > 2 or q for t, q in parts):
            return None, [c for t, q in parts for c in (q or [trigrams(x) for x in t])]
        return None, []
    if op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT):
        low, high, inner = arg
        texts, query = _sequence(inner)
        if texts is not None and high <= 2:
            options = {""} if low == 0 else set()
            once = {""}
            for n in range(1, int(high) + 1):
                once = {a + b for a in once for b in texts}
                options |= once if n >= low else set()
            return options, []
        return None, (query if low else [])
    if op is C.AT:
        return {""}, []
    return None, []


def trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def _sequence(nodes) -> tuple[set[str] | None, list[frozenset[str]]]:
    """A run of elements: joined texts while they stay few, else the best
    (most trigrams in its weakest clause) of the queries met on the way."""
    best: list[frozenset[str]] = []
    joined: set[str] | None = {""}
    whole = True

    def close(texts: set[str]) -> None:
        nonlocal best
        clauses = [trigrams(t) for t in sorted(texts)]
        if all(clauses) and (not best or min(map(len, clauses)) > min(map(len, best))):
            best = clauses

    for node in nodes:
        texts, query = _texts(node, 0)
        if texts is not None and len(joined) * len(texts) <= MAX_TEXTS:
            joined = {a + b for a in joined for b in texts}
            continue
        close(joined)
        whole = False
        joined = texts if texts is not None and len(texts) <= MAX_TEXTS else {""}
        if query and (not best or min(map(len, query)) > min(map(len, best))):
            best = query
    if whole:
        return joined, []
    close(joined)
    return None, best


def trigram_query(pattern: str) -> Query:
    """Clauses of trigrams: a match contains all trigrams of some clause.
    Empty: the pattern has matches without a mandatory trigram."""
    texts, query = _sequence(P.parse(pattern))
    clauses = [trigrams(t) for t in texts] if texts is not None else query
    if not clauses or not all(clauses):
        return ()
    # a clause that asks for more than another one adds no rows
    return tuple(sorted({c for c in clauses if not any(d < c for d in clauses)}, key=sorted))


def row_key(docs: DataFrame) -> DataFrame:
    return docs.withColumns({"__id": id_key(), "__th": text_hash()})


def postings(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """The inverted index: (trigram, row) for every trigram the rules ask for."""
    wanted = sorted({t for r in rules for c in trigram_query(r.pattern) for t in c})
    held = F.array_compact(F.array(*[F.when(F.contains("__low", F.lit(t)), F.lit(t)) for t in wanted]))
    rows = row_key(docs).select("__id", "__th", F.lower("text").alias("__low"))
    return rows.select("__id", "__th", F.explode(held).alias("trigram"))


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Rows and the kinds that may match there: in all postings of a clause."""
    spark = index.sparkSession
    clauses = [(r.kind, n, t, len(c)) for r in rules for n, c in enumerate(trigram_query(r.pattern)) for t in sorted(c)]
    asked = spark.createDataFrame(clauses, "kind string, clause int, trigram string, size int")
    return (index.distinct().join(F.broadcast(asked), "trigram")
            .groupBy("__id", "__th", "kind", "clause").agg(F.count("*").alias("n"), F.max("size").alias("size"))
            .filter("n = size").groupBy("__id", "__th").agg(F.collect_set("kind").alias("__kinds")))


def verified(rule: Rule) -> str:
    """SQL for the rule's spans in the column ``text``."""
    keep = None
    if rule.min_length:
        group = f"regexp_extract({{}}, {S.literal(rule.pattern)}, {rule.value_group})"
        keep = lambda v: f"length({group.format(v)}) >= {rule.min_length}"
    return S.spans("text", rule.kind, rule.java or rule.pattern, keep)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """(``doc_id``, ``text``) with one array of spans for each rule, in columns
    named after the kinds."""
    found = candidates(postings(docs, rules), rules)
    rows = row_key(docs).withColumn("text", F.coalesce("text", F.lit("")))
    # a row's id and text hash are the key, so no key is hot
    joined = rows.join(found, ["__id", "__th"], "left")
    cols = [f"CASE WHEN array_contains(__kinds, '{r.kind}') THEN {verified(r)} ELSE {S.NONE} END AS {r.kind}"
            if trigram_query(r.pattern) else f"{verified(r)} AS {r.kind}" for r in rules]
    return joined.selectExpr("doc_id", *cols)


def by_position(kinds: list[str]) -> str:
    """SQL for all spans by start, then kind in the given order."""
    ranked = [f"transform({k}, x -> named_struct('start', x.start, 'rank', {i}, 'kind', x.kind, 'end', x.end))"
              for i, k in enumerate(kinds)]
    return f"array_sort(concat({', '.join(ranked)}))"


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of all rules in every document."""
    rules = BASE + MORE
    out = scan(documents(spark, sf_dir), rules)
    base, every = by_position([r.kind for r in BASE]), by_position([r.kind for r in rules])
    return out.select("doc_id", *[F.size(r.kind).cast("long").alias(f"n_{r.kind}") for r in BASE],
                      F.sha2(S.listed(base), 256).alias("base_sha256"), S.listed(every).alias("spans"))
