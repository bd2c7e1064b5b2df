"""Pipeline stages against brute force, user columns whose names the stages use
themselves, empty tables, and texts with very many matches."""

import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetpulse.llm import common, decontaminate, licenses, near_dedup, pii, secrets, simhash, spans, toxicity
from tests.conftest import SF001
from tests.llm.test_operators import EDGE, shingles, words

ALNUM = "[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CLASHES = ("n", "__id", "__th", "__marks", "__wordless", "first", "cls", "score", "band")


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """The smallest tables, odd rows, and columns with names that stages use."""
    root = str(tmp_path_factory.mktemp("corpus"))
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    odd = spark.createDataFrame([(i, t, None, None, None) for i, t in EDGE if len(t or "") < 25000], docs.schema)
    own = {c: F.concat(F.lit(f"{c}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))) for c in CLASHES}
    docs.unionByName(odd).withColumns(own).write.parquet(f"{root}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF001}/{name}.parquet").write.parquet(f"{root}/{name}.parquet")
    return root


def check_columns(before, after):
    """A stage returns its input's columns, with the user's own values."""
    assert after.columns == before.columns
    for r in after.collect():
        for c in CLASHES:
            assert r[c] == f"{c}-{'none' if r.doc_id is None else r.doc_id}"


def pairs(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def test_near_dedup_stage(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    rows = sorted({(r.doc_id is None, r.doc_id or 0, r.text) for r in docs.collect() if words(r.text or "")},
                  key=lambda r: (r[0], r[1], common.UPPER, r[2]))
    sets = [shingles(words(t), 5) for _, _, t in rows]
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 80 * (len(a) + len(sets[j]) - both) and group[i] != group[j]:
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    out = near_dedup.dedup_stage(spark, docs, corpus)
    check_columns(docs, out)
    kept = [r for r in out.collect() if words(r.text or "")]
    at = {}
    for (none, i, t), g in zip(rows, group):
        at[None if none else i, t] = g
    # one of each group, and it has the group's least id
    assert Counter(at[r.doc_id, r.text] for r in kept) == Counter(set(group))
    least = {}
    for (none, i, _), g in zip(rows, group):
        least[g] = min(least.get(g, (True, 0)), (none, i))
    assert all((r.doc_id is None, r.doc_id or 0) == least[at[r.doc_id, r.text]] for r in kept)
    wordless = lambda df: pairs(df.filter("text IS NULL OR length(trim(regexp_replace(text, '\\\\s', ''))) = 0"))
    assert wordless(out) == wordless(docs)


def test_decontamination_stage(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    items = [shingles(words(r.text, ALNUM), 5) for r in spark.read.parquet(f"{corpus}/benchmark.parquet").collect()]
    out = decontaminate.decontaminate_stage(spark, docs, corpus)
    check_columns(docs, out)

    def clean(t):
        own = shingles(words(t or "", ALNUM), 5)
        return not any(s and len(s & own) >= 0.8 * len(s) for s in items)

    assert pairs(out) == Counter({k: n for k, n in pairs(docs).items() if clean(k[1])})


def test_toxicity_stage(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    out = toxicity.toxicity_stage(spark, docs, corpus)
    check_columns(docs, out)
    labels = spark.read.parquet(f"{corpus}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.fit(docs.select("doc_id", "text"), labels)
    reader = model.reader()
    low = lambda t: model.score(reader.words(t or "")) < toxicity.THRESHOLD
    assert pairs(out) == Counter({k: n for k, n in pairs(docs).items() if low(k[1])})


def test_pii_stage(spark, corpus):
    """Base spans are masked and every other place is a term's or unchanged."""
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    out = pii.pii_stage(spark, docs, corpus)
    check_columns(docs, out)
    found = {(r["__id"], r["__th"]): r for r in pii.all_spans(docs.select("doc_id", "text")).collect()}
    keys = docs.select("doc_id", "text", common.id_key().alias("i"), common.text_hash().alias("h")).collect()
    want = Counter()
    for r in keys:
        text = r.text
        if text is not None:
            own = found[r.i, r.h]
            marks = sorted([(s.start, s.end, f"[{k.upper()}]") for k in pii.KINDS for s in own[k]]
                           + [(t.start, t.end, ("[TERM]", "")[t.action]) for t in own.terms])
            made, at = [], 0
            for a, e, mark in marks:
                if a >= at:
                    made += [text[at:a], mark]
                at = max(at, e)
            text = "".join(made) + text[at:]
        want[r.doc_id, text] += 1
    assert pairs(out) == want


def test_empty_pipeline(spark, tmp_path):
    import corpus_pipeline
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF001}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


# --- decontamination ---------------------------------------------------------

def test_scattered_parts_count(spark):
    """Items whose quarters stand far apart in a document: all found, with all
    of their shingles."""
    common.python_tasks(spark)
    rng = random.Random(2)
    word = lambda: f"w{rng.randrange(10**6)}"
    items = [[word() for _ in range(44)] for _ in range(120)]
    docs = []
    for n, item in enumerate(items):
        text = []
        for q in range(4):
            text += [word() for _ in range(400)] + item[11 * q:11 * q + 11]
        docs.append((n, " ".join(text + [word() for _ in range(50)])))
    # quarters lose the shingles over their joints: 7 of 11 stay each, so ask for less
    table = spark.createDataFrame([(n, " ".join(i)) for n, i in enumerate(items)], "item_id long, text string")
    got = decontaminate.contained(spark.createDataFrame(docs, "doc_id long, text string"), table, least=0.6)
    want = {(n, n, len(shingles(item, 5) & shingles(docs[n][1].split(), 5))) for n, item in enumerate(items)}
    assert {(r["__id"], r.item, r.n_shared) for r in got.collect()} == want


def test_short_and_repeated_items(spark):
    common.python_tasks(spark)
    items = spark.createDataFrame([(1, "Alpha beta"), (2, "one two three four"), (3, "alpha BETA"), (4, "the one long item of words"),
                                   (4, "the one long item of words"), (5, ""), (6, None), (7, "solo")], "item_id long, text string")
    docs = spark.createDataFrame([(10, "x alpha beta y"), (11, "alpha gamma beta"), (12, "zero one two three four five six seven"),
                                  (13, "see the one long item of words here"), (14, "alpha"), (15, "alpha beta"), (16, None),
                                  (17, "Solo"), (18, "beta alpha beta " * 3000)], "doc_id long, text string")
    got = {(r["__id"], r.item, r.n_shared, r.containment) for r in decontaminate.contained(docs, items).collect()}
    assert got == {(10, 1, 1, 1.0), (10, 3, 1, 1.0), (12, 2, 1, 1.0), (13, 4, 2, 1.0), (15, 1, 1, 1.0), (15, 3, 1, 1.0),
                   (17, 7, 1, 1.0), (18, 1, 1, 1.0), (18, 3, 1, 1.0)}
    only = items.filter("item_id IN (5, 6)")
    assert decontaminate.contained(docs, only).count() == 0


def test_filter_follows_the_number_of_items(spark):
    """Of unrelated windows, under a tenth passes with 20,000 items' keys."""
    keys = spark.range(20_000 * decontaminate.SAMPLES).select(F.xxhash64("id").alias("key"))
    flt = decontaminate.key_filter(keys)
    own = keys.limit(1000).toPandas()["key"].to_numpy().view(np.uint64)
    assert len(flt.has(own)) == 1000
    other = np.random.default_rng(1).integers(0, 1 << 63, 4000 * decontaminate.SAMPLES, dtype=np.uint64) * np.uint64(2)
    passed = flt.has(other) // decontaminate.SAMPLES
    assert len(np.unique(passed)) < 0.1 * 4000


# --- spans of very long texts ----------------------------------------------------

def test_very_many_matches(spark):
    """A hundred thousand matches in one text: spans, masking and scan take
    seconds, and all places are right."""
    n = 100_000
    text = " ".join(f"user{i}@mail{i % 7}.org" for i in range(n))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    start = time.time()
    row = docs.selectExpr(f"{pii.base_spans()['email']} AS found").first().found
    at = [m.span() for m in re.finditer(r"\S+", text)]
    assert [(s.start, s.end) for s in row] == at
    marks = "transform(found, s -> named_struct('start', s.start, 'end', s.end, 'mark', '[EMAIL]'))"
    masked = docs.selectExpr("text", f"{pii.base_spans()['email']} AS found").selectExpr("text", f"{marks} AS marks")
    assert masked.selectExpr(f"{spans.masked('text', 'marks')} AS t").first().t == " ".join(["[EMAIL]"] * n)
    assert time.time() - start < 60


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 15, 16, 17, 100])
def test_spans_and_masks_of_any_number(spark, n):
    rng = random.Random(n)
    text = "é" + "".join(rng.choice(["é", " ", "日本"]) + "x" * rng.randrange(1, 4) for _ in range(n)) + " end"
    docs = spark.createDataFrame([(text,)], "text string")
    got = docs.selectExpr(f"{spans.spans('text', 'k', 'x+')} AS s").first().s
    want = [(m.start(), m.end()) for m in re.finditer("x+", text)]
    assert [(s.start, s.end) for s in got] == want and all(text[s.start:s.end] == s.value for s in got)
    # spans that overlap: the earlier one stays, and what starts in it is left out
    marks = sorted((a, a + rng.randrange(1, 5), f"<{i}>") for i, a in enumerate(rng.randrange(len(text)) for _ in range(n)))
    marks = [(a, min(e, len(text)), m) for a, e, m in marks]
    made, at = [], 0
    for a, e, m in marks:
        if a >= at:
            made += [text[at:a], m]
        at = max(at, e)
    df = spark.createDataFrame([(text, marks)], "text string, marks array<struct<start:int,end:int,mark:string>>")
    assert df.selectExpr(f"{spans.masked('text', 'marks')} AS t").first().t == "".join(made) + text[at:]


def test_entities_of_the_same_texts_are_one(spark):
    """Ten thousand values in one text make no product with its terms, and
    disclose as one value does."""
    text = " ".join(f"u{i}@h{i}.org word{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676 % 26)}" for i in range(10_000))
    docs = spark.createDataFrame([(1, text), (2, "other words here")] + [(i, f"the plain text {i}") for i in range(3, 60)],
                                 "doc_id long, text string")
    rows = pii.found(docs)
    assert pii.mentions(rows).count() == 1
    one = docs.withColumn("text", F.regexp_replace("text", r"^u0@h0\.org (.*)$", "u0@h0.org $1"))
    flagged = {r.term for r in pii.disclosing(one, rows).collect()}
    single = spark.createDataFrame([(1, re.sub(r"u[1-9]\d*@\S+ ", "", text))] + [(i, f"the plain text {i}") for i in range(2, 60)],
                                   "doc_id long, text string")
    assert {r.term for r in pii.disclosing(single, pii.found(single)).collect()} == flagged and len(flagged) > 5000


def test_all_secret_rules(spark):
    """Every rule on planted secrets between other text equals its pattern."""
    rng = random.Random(6)
    pick = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    alnum = "abcXYZ019"
    plants = [lambda: f"password = '{pick(alnum, 9)}'", lambda: "AKIA" + pick("ABC0", 14), lambda: pick("abcdef012", 34),
              lambda: "-----BEGIN RSA PRIVATE KEY-----", lambda: "-----BEGIN PRIVATE KEY-----",
              lambda: f"eyJ{pick(alnum, 9)}.eyJ{pick(alnum, 9)}.{pick(alnum, 9)}", lambda: "ghp_" + pick(alnum, 36),
              lambda: "xoxb-" + pick("0123-a", 12), lambda: "AIza" + pick(alnum, 35), lambda: "sk_live_" + pick(alnum, 18),
              lambda: "Bearer  " + pick(alnum, 24), lambda: "eyJshort", lambda: "sk_test_" + pick(alnum, 18), lambda: "token"]
    texts = [" ".join(rng.choice(["é", "plain", rng.choice(plants)()]) for _ in range(rng.randrange(12))) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rules = secrets.BASE + secrets.MORE
    low = {"access": 16, "hex": 32}
    seen = Counter()
    for r in secrets.scan(docs, rules).collect():
        for rule in rules:
            found = [m for m in re.finditer(rule.pattern, texts[r.doc_id])
                     if (len(m.group(2)) >= 8 if rule.kind == "assign" else len(m.group()) >= low.get(rule.kind, 0))]
            assert [(s.start, s.end) for s in r[rule.kind]] == [m.span() for m in found], rule.kind
            seen[rule.kind] += len(found)
    assert set(seen) == {r.kind for r in rules} and min(seen.values()) > 0


# --- licenses ----------------------------------------------------------------------

def brute_licenses(text):
    """Labels and score from all hits, one text at a time."""
    w = words(text, ALNUM)
    labels, score = set(), 0.0
    for phrase, label in licenses.PHRASES:
        t = phrase.split()
        most = 0
        for d in range(-len(t), len(w)):
            most = max(most, sum(0 <= d + q < len(w) - 1 and w[d + q:d + q + 2] == t[q:q + 2] for q in range(len(t) - 1)))
        if most == len(t) - 1:
            labels.add(label)
        score = max(score, most / (len(t) - 1) if most == len(t) - 1 else min(most / (len(t) - 1), 0.99))
    for notice, label in licenses.NOTICES:
        t = notice.split()
        m = len(t)
        hits = sorted((p - q, p, q) for q in range(m - 1) for p in range(len(w) - 1) if w[p:p + 2] == t[q:q + 2])
        parts, last = [], None
        for d, p, q in hits:
            if last is None or d - last > licenses.APART * m:
                parts.append([])
            parts[-1].append((p, q))
            last = d
        most = max((len({q for p, q in part if start <= p and p - start + 2 <= licenses.STRETCH * m})
                    for part in parts for start, _ in part), default=0) / (m - 1)
        if most >= licenses.COVERED:
            labels.add(label)
        score = max(score, 1.0 if most >= licenses.COVERED else min(most, 0.99))
    return ",".join(sorted(labels)), round(score, 9)


def test_license_labels_equal_brute_force(spark):
    """Notices with words put in, left out or moved, repeated ones, and mixtures."""
    rng = random.Random(8)
    notices = [t.split() for t, _ in (*licenses.NOTICES, *licenses.PHRASES)]
    mit, bsd = licenses.NOTICES[0][0].split(), licenses.NOTICES[4][0].split()
    put_in = lambda t, at: " ".join(t[:at] + ["quite", "other", "words"] + t[at:])
    fixed = [put_in(mit, 9), put_in(bsd, 10), " ".join(bsd[10:] + bsd[:10]), " ".join(mit * 30), "of this software and " * 40]
    texts = list(fixed) + ["", "mit", "license mit license"]
    for _ in range(150):
        text = []
        for _ in range(rng.randrange(1, 4)):
            t = list(rng.choice(notices))
            for _ in range(rng.randrange(6)):
                at = rng.randrange(max(1, len(t)))
                t = t[:at] + rng.choice([["x"], [], ["of", "the"], t[at:at + 1] * 2]) + t[at + 1:]
            text += t + ["filler"] * rng.randrange(25)
        texts.append(" ".join(text))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["__id"]: (r.labels, round(r.score, 9)) for r in licenses.scan(docs).collect()}
    assert got == {n: brute_licenses(t) for n, t in enumerate(texts)}
    assert [got[n][0] for n in range(4)] == ["mit-text", "bsd", "bsd", "mit-text"]


# --- fingerprints ------------------------------------------------------------------

def brute_fingerprint(text):
    """Signed bits of weighted word pairs."""
    import xxhash
    seed = lambda x: x & (1 << 64) - 1
    one = lambda w, start=42: xxhash.xxh64_intdigest(w.encode(), seed(start))
    w = [x for x in re.split("[ \t-\r]+", text) if x]
    pairs = [(one(x), len(x)) for x in w] if len(w) < 2 else [(one(b, one(a)), len(a) + len(b)) for a, b in zip(w, w[1:])]
    total, bits = sum(n for _, n in pairs), 0
    for k in range(64):
        if 2 * sum(n for h, n in pairs if h >> k & 1) > total:
            bits |= 1 << k
    return f"{bits:016x}"


def test_fingerprints_equal_brute_force(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet").filter("length(coalesce(text, '')) < 4000").select("doc_id", "text")
    texts = docs.select("text").distinct().withColumn("t", F.coalesce("text", F.lit("")))
    got = simhash.fingerprints(texts.select("t").distinct(), ["t"], "t").withColumn("f", simhash.as_text("fingerprint"))
    rows = got.collect()
    assert len(rows) > 100 and {r.t: r.f for r in rows} == {r.t: brute_fingerprint(r.t) for r in rows}


# --- toxicity ----------------------------------------------------------------------

def test_readers_test_skips_nothing(spark):
    """Stretches that the quick test leaves out decode to no telling word."""
    rng = random.Random(4)
    weights = {"idiot": 3.0, "^scum": 2.5, "hate": 2.0, "losers": 3.0}
    grams = {g: 20.0 for w in ("idiot", "scum", "hate", "losers", "house", "the") for g in toxicity.word_grams(w)}
    model = toxicity.Model(weights, -3.0, grams)
    reader = model.reader()
    chars = toxicity.CharModel(grams)
    told = 0
    for _ in range(4000):
        word = rng.choice(["idiot", "scum", "scummy", "hate", "losers", "house", "th3 h0use"])
        written = "".join(rng.choice([c, c, c + c, *[k for k, v in toxicity.LEET.items() if c in v], c + rng.choice(" .-½")])
                          for c in word)
        want = {w for w in toxicity.restore(written, chars).split() if model.value(w) > 0}
        assert set(reader.reading(written)) == want, written
        told += bool(want)
    assert told > 1000


def test_long_stretches_take_linear_time(spark):
    model = toxicity.Model({"idiot": 3.0}, -3.0, {g: 5.0 for g in toxicity.word_grams("idiot")})
    start = time.time()
    assert model.reader().words("x1d10t" + "aB3" * 30_000) == set()
    assert model.reader().words("a" * 300 + "4 1d10t") == {"idiot"}
    assert time.time() - start < 20


def test_sample_moves_only_its_texts(spark, corpus):
    """Labels are broadcast, and a text labelled for several ids counts once."""
    docs = spark.createDataFrame([(i, f"text {i % 3}") for i in range(30)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(30)] * 2, "doc_id long, toxic int")
    assert toxicity.fit(docs, labels).intercept == pytest.approx(min(-1.0, np.log(1.5 / 2.5)) - 1.0)


def test_toxicity_learns_from_all_labels(spark, monkeypatch):       # F2, F3
    """More labelled rows than the former sample: every one counts, and sums
    over blocks of feature sets give the same weights as one block."""
    n = 45_000
    docs = spark.range(n).selectExpr("id AS doc_id", "CASE WHEN id % 9 = 0 THEN concat('you idiot ', id) WHEN id % 9 = 1 THEN"
                                     " concat('total scum idiot ', id) ELSE concat('a fine house ', id) END AS text")
    labels = docs.selectExpr("doc_id", "CAST(doc_id % 9 < 2 AS INT) AS toxic")
    copies = docs.filter("doc_id < 90").selectExpr("doc_id + 1000000 AS doc_id", "text")
    model = toxicity.fit(docs.union(copies), labels.union(labels.limit(5)))
    assert model.intercept == pytest.approx(min(-1.0, np.log((n / 4.5 + 0.5) / (n * 7 / 9 + 0.5))) - 1.0, rel=1e-12)
    assert "idiot" in model.weights
    monkeypatch.setattr(toxicity, "KEPT_WORDS", 10)
    monkeypatch.setattr(toxicity, "BLOCK", 1)
    monkeypatch.setattr(toxicity, "STEPS", 10)
    few = [d.filter("doc_id < 300") for d in (docs, labels)]
    many = toxicity.fit(*few)
    monkeypatch.setattr(toxicity, "BLOCK", 50_000)
    one = toxicity.fit(*few)
    assert many.weights == one.weights and many.grams == one.grams and many.intercept == one.intercept and one.weights
