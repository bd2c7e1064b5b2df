"""Personal data: base patterns, and terms that give protected values away.

Base spans are e-mail addresses, IP addresses, card numbers and phone numbers.
Each base value is a protected entity.  Terms of the texts that hold it
disclose it as far as they point to it in the whole corpus: with c(t, e) texts
that hold both term t and entity e, c(t) texts that hold t, c(e) texts that
hold e and N texts, all of them distinct, the disclosure is PMI(t; e) / IC(e), where
PMI = log2((c(t, e) / c(e)) / ((c(t) + 1) / (N + 1))) and IC = log2(N / c(e)):
near 1 if the term occurs nowhere but with the entity.  The term's share of
the texts is smoothed by one, so that rare terms count a little less; no
number of texts is asked for, as most values stand in one text only.  Terms
from GENERALISE on are replaced by a general word, from REMOVE on they are
taken out, at each of their places in the texts that hold that entity.

Cases: a null or empty text has no spans and the hash of an empty string;
rows that repeat a text count as one text; ties at a threshold are at or
above it; a document without base spans never changes, and neither do terms
where an entity stands in every text, as it can't be disclosed; a very long
text, or one with very many matches, takes time near its length; an empty
table gives no rows.  All steps are DataFrame and SQL functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.llm import spans as S
from fleetpulse.llm.common import documents, free_names, id_key, stored, text_hash

# The base kinds and their order.
KINDS = ("email", "ip", "card", "phone")
ACTIONS = ("generalise", "remove")
GENERALISE, REMOVE = 0.5, 0.8
BROADCAST_TERMS = 1_000_000    # more terms than this are joined, not broadcast
TERM = r"(?<![\p{L}\p{N}])\p{L}{3,}+(?![\p{L}\p{N}])"
TERMS = f"transform(regexp_extract_all(text, {S.literal(TERM)}, 0), w -> lower(w))"
ANY = " OR ".join(f"size({k}) > 0" for k in KINDS)
NO_TERMS = "CAST(array() AS array<struct<start:int,end:int,action:int>>)"

OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"


def _digits(v: str) -> str:
    return f"regexp_replace({v}, '[^0-9]', '')"


def _luhn(v: str) -> str:
    """16 to 19 digits whose Luhn sum is divisible by 10."""
    d = f"reverse({_digits(v)})"
    twice = "2 * CAST(substring(d, i, 1) AS int)"
    total = f"""aggregate(transform(sequence(1, length(d)), i -> CASE WHEN i % 2 = 1 THEN CAST(substring(d, i, 1) AS int)
        WHEN {twice} > 9 THEN {twice} - 9 ELSE {twice} END), 0, (a, b) -> a + b)"""
    return f"get(transform(array({d}), d -> CASE WHEN length(d) BETWEEN 16 AND 19 THEN {total} % 10 = 0 ELSE false END), 0)"


def base_spans() -> dict[str, str]:
    """SQL for each kind's spans of the column ``text``.

    A match may start only where its first run of characters starts or the
    last match ended, as any other start leads to the same end; long runs then
    take linear time.
    """
    return {
        "email": S.spans("text", "email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++"
                         r"(?:\.[A-Za-z0-9-]++)++", needs="@"),
        "ip": S.spans("text", "ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
                      lambda v: f"{v} RLIKE '^{OCTET}(?:[.]{OCTET}){{3}}$'", needs="."),
        "card": S.spans("text", "card", r"[0-9](?:[\x20-]?[0-9])++", _luhn),
        "phone": S.spans("text", "phone", r"\+[0-9][\x20().0-9-]+[0-9]",
                         lambda v: f"length({_digits(v)}) BETWEEN 8 AND 15", needs="+"),
    }


def found(docs: DataFrame) -> DataFrame:
    """Base spans of each distinct (id, text), by kind, as a stored table; with
    the text itself (``held``) where it has any."""
    rows = docs.select(id_key().alias("__id"), text_hash().alias("__th"),
                       F.coalesce("text", F.lit("")).alias("text"))
    spans = rows.selectExpr("__id", "__th", "text", *[f"{sql} AS {k}" for k, sql in base_spans().items()])
    return stored(spans.selectExpr("__id", "__th", *KINDS, f"CASE WHEN {ANY} THEN text END AS held"), "pii")


def mentions(base: DataFrame) -> DataFrame:
    """The entities of each text (``__th``, ``entity``, ``c_e``).

    Entities that stand in exactly the same texts disclose alike, so they are
    one here: however many values a text holds that no other text has, they
    make one row, and terms and entities of a text don't multiply.
    """
    spans = base.filter(ANY).select("__th", F.explode(F.concat(*KINDS)).alias("s"))
    value = F.when(F.col("s.kind").isin("card", "phone"), F.regexp_replace("s.value", "[^0-9]", "")
                   ).otherwise(F.lower("s.value"))
    held = spans.select("__th", F.xxhash64("s.kind", value).alias("value")).distinct()
    # hashes of the set of its texts
    texts = held.groupBy("value").agg(F.count("*").alias("c_e"), F.bit_xor(F.xxhash64("__th", F.lit(1))).alias("x"),
                                      F.bit_xor(F.xxhash64("__th", F.lit(2))).alias("y"))
    return (held.join(texts, "value").select("__th", F.xxhash64("c_e", "x", "y").alias("entity"), "c_e")
            .dropDuplicates(["__th", "entity"]))


def distinct_terms(texts: DataFrame) -> DataFrame:
    """The different terms of each text of (``__th``, ``text``), once for all
    copies.  They are shuffled as one string a text."""
    words = F.expr(f"array_join(array_distinct({TERMS}), ' ')")
    each = texts.select("__th", words.alias("words")).dropDuplicates(["__th"]).filter("words <> ''")
    return each.select("__th", F.explode(F.split("words", " ")).alias("w")).select("__th", F.xxhash64("w").alias("term"))


def term_counts(docs: DataFrame) -> DataFrame:
    """How many distinct texts hold each term, over the whole corpus."""
    return (distinct_terms(docs.select(text_hash().alias("__th"), "text"))
            .groupBy("term").agg(F.count("*").alias("c_t")))


def disclosing(docs: DataFrame, base: DataFrame) -> DataFrame:
    """(__th, term, action) for terms at or over a threshold for any entity of
    a text."""
    n = base.select("__th").distinct().count()
    said = stored(mentions(base), "entities")
    most = said.agg(F.max("c_e")).first()[0] or 1
    counts = stored(term_counts(docs), "term_counts")
    # c(t, e) <= c(e), so a term in more texts is under the threshold for every
    # entity; with few entities these are the terms that most texts share
    rare = F.col("c_t") + 1 <= (n + 1) * (most / max(n, 1)) ** GENERALISE * (1 + 1e-6)
    common = counts.filter(~rare).select("term")
    if common.count() <= BROADCAST_TERMS:
        common = F.broadcast(common)
    terms = (distinct_terms(base.filter("held IS NOT NULL").select("__th", F.col("held").alias("text")))
             .join(common, "term", "left_anti"))
    pairs = stored(terms.join(said, "__th"), "pairs")
    together = pairs.groupBy("entity", "term").agg(F.count("*").alias("c_te"), F.first("c_e").alias("c_e"))
    scored = (together.join(counts.filter(rare), "term").withColumn("n", F.lit(n))
              .withColumn("ic", F.log2(F.col("n") / F.col("c_e")))
              .withColumn("pmi", F.log2(F.col("c_te") * (F.col("n") + 1) / ((F.col("c_t") + 1) * F.col("c_e")))))
    share = F.when(F.col("ic") > 0, F.col("pmi") / F.col("ic"))
    flagged = (scored.withColumn("share", F.round(share, 9)).filter(F.col("share") >= GENERALISE)
               .select("entity", "term", (F.col("share") >= REMOVE).cast("int").alias("action")))
    return pairs.join(flagged, ["entity", "term"]).groupBy("__th", "term").agg(F.max("action").alias("action"))


def all_spans(docs: DataFrame) -> DataFrame:
    """Each distinct (id, text) with its base spans by kind and ``terms``:
    structs of start, end and action, clear of all base spans."""
    rows = found(docs)
    base = rows.select("__id", "__th", *KINDS).dropDuplicates(["__id", "__th"])
    acts = disclosing(docs, rows).groupBy("__th").agg(
        F.map_from_entries(F.collect_list(F.struct("term", "action"))).alias("acts"))
    texts = rows.filter("held IS NOT NULL").select("__id", "__th", "held").dropDuplicates(["__id", "__th"])
    p = S.literal(TERM)
    sizes = "transform(m, (w, i) -> named_struct('gap', length(get(g, i)), 'size', length(w)))"
    placed = ("filter(zip_with(m, {starts}, (w, s) -> named_struct('start', s, 'end', s + length(w), "
              "'action', acts[xxhash64(lower(w))])), x -> x.action IS NOT NULL)").format(starts=S.starts(sizes))
    places = S.bound(f"regexp_extract_all(held, {p}, 0)", "m", S.bound(f"split(held, {p}, -1)", "g", placed))
    terms = texts.join(acts, "__th").selectExpr("__id", "__th", f"{places} AS terms")
    joined = base.join(terms, ["__id", "__th"], "left")
    free = (f"filter(coalesce(terms, {NO_TERMS}), t -> NOT exists(concat(email, ip, card, phone), "
            "s -> s.start < t.end AND t.start < s.end))")
    return joined.selectExpr("__id", "__th", *KINDS, f"{free} AS terms")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and disclosing-term spans of every document."""
    docs = documents(spark, sf_dir)
    spans = all_spans(docs)
    base = S.listed("concat(email, ip, card, phone)")
    acts = [f"transform(filter(terms, t -> t.action = {i}), t -> named_struct('kind', '{a}', 'start', t.start, 'end', t.end))"
            for i, a in enumerate(ACTIONS)]
    rest = S.listed(f"concat({', '.join(acts)})")
    rows = docs.select("doc_id", id_key().alias("__id"), text_hash().alias("__th"))
    return rows.join(spans, ["__id", "__th"]).select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS], F.sha2(base, 256).alias("base_sha256"),
        F.concat_ws(",", F.nullif(base, F.lit("")), F.nullif(rest, F.lit(""))).alias("spans"),
        F.size("terms").cast("long").alias("n_terms"))


def sanitised(docs: DataFrame) -> DataFrame:
    """``docs`` with base spans masked by their kind, disclosing terms
    generalised or removed; overlapping spans are masked as one."""
    spans = all_spans(docs)
    marks = "concat(" + ", ".join(
        [f"transform({k}, s -> named_struct('start', s.start, 'end', s.end, 'mark', '[{k.upper()}]'))" for k in KINDS]
        + ["transform(terms, t -> named_struct('start', t.start, 'end', t.end, "
           "'mark', CASE t.action WHEN 0 THEN '[TERM]' ELSE '' END))"]) + ")"
    names = free_names(docs, "__id", "__th", "__marks")
    marked = spans.selectExpr("__id", "__th", f"array_sort({marks}) AS __marks").filter("size(__marks) > 0").toDF(*names)
    rows = docs.withColumns(dict(zip(names, (id_key(), text_hash()))))
    new = f"CASE WHEN {names[2]} IS NULL THEN text ELSE {S.masked('text', names[2])} END"
    out = rows.join(marked, names[:2], "left").withColumn("text", F.expr(new)).select(*docs.columns)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)
                          ) if "n_chars" in docs.columns else out


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pipeline's stage: every document, sanitised."""
    return sanitised(docs)
