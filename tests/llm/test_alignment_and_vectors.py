"""Tokenizer alignment, nearest neighbours and hard negatives against brute
force, with odd rows: nulls, ties, repeats, long texts, extra columns."""

import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fleetpulse.llm import align, ann, common, negatives
from fleetpulse.llm.vectors import first_of_each
from tests.conftest import SF001

ODD_TEXTS = [(-1, None), (-2, ""), (-3, " "), (-4, "a▁b"), (-5, "<|endoftext|> <s> <0x41> \x00 \t\n  x"), (None, "null id é🎉"),
             (-6, "same words same words"), (-6, "same words same words"), (-7, "antidisestablishment " * 9000),
             (-8, "日本語のテキスト" * 300), (-9, "1234567890" * 2000)]


@pytest.fixture(scope="module")
def texts(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("texts"))
    odd = spark.createDataFrame(ODD_TEXTS, "doc_id long, text string")
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").union(odd)
    (docs.withColumns({c: F.lit("clash") for c in ("pairs", "times", "n_a", "__row", "pair")})
     .write.parquet(f"{root}/documents.parquet"))
    return root


def token_bytes():
    a, b = Tokenizer.from_file(P.path(align.A_FILE)), sentencepiece.SentencePieceProcessor(model_file=P.path(align.B_FILE))
    a.encode_special_tokens = True
    own = align.byte_characters()
    return (a, b, lambda i: bytes(own[c] for c in a.id_to_token(i)),
            lambda i: bytes([int(b.id_to_piece(i)[1:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())


def spans(parts):
    out, at = [], 0
    for p in parts:
        out.append((at, at + len(p)))
        at += len(p)
    return out


def test_alignment_equals_brute_force(spark, texts):
    a, b, a_bytes, b_bytes = token_bytes()
    rows, counts = [], Counter()
    for r in common.documents(spark, texts).collect():
        want = b" " + (r.text or "").encode()
        ia = a.encode(" " + (r.text or ""), add_special_tokens=False).ids
        ib = b.encode(r.text or "")
        pa_, pb = [a_bytes(i) for i in ia], [b_bytes(i) for i in ib]
        if not r.text or b"".join(pa_) != want or b"".join(pb) != want:
            ia, ib, pa_, pb = [], [], [], []
        sa, sb = spans(pa_), spans(pb)
        links, j0 = [], 0
        for x, (s, e) in zip(ia, sa):
            while j0 < len(sb) and sb[j0][1] <= s:
                j0 += 1
            j = j0
            while j < len(sb) and sb[j][0] < e:
                links.append((x, ib[j]))
                j += 1
        cuts = sorted({e for _, e in sa} & {e for _, e in sb})
        groups, lo = [], 0
        at = {"a": 0, "b": 0}
        for c in cuts:
            part = []
            for key, ids, sp in (("a", ia, sa), ("b", ib, sb)):
                first = at[key]
                while at[key] < len(sp) and sp[at[key]][1] <= c:
                    at[key] += 1
                part.append(",".join(map(str, ids[first:at[key]])))
            groups.append("|".join(part))
        counts.update(links)
        text = ";".join(groups)
        rows.append((r.doc_id, len(ia), len(ib), len(cuts), links, hashlib.sha256(text.encode()).hexdigest() if ia else ""))
    best = defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    want = Counter((d, na, nb, ng, len(ln), sum(counts[p] == best[p[1]] for p in ln), sum(counts[p] for p in ln), h)
                   for d, na, nb, ng, ln, h in rows)
    got = align.op11_align(spark, texts)
    assert Counter(map(tuple, got.collect())) == want


def test_rare_pairs_are_joined(spark, texts, monkeypatch):
    """With few pairs looked up in the tasks, the join gives the same sums."""
    whole = Counter(map(tuple, align.op11_align(spark, texts).collect()))
    monkeypatch.setattr(align, "HOT_SHARE", 1e-3)
    assert Counter(map(tuple, align.op11_align(spark, texts).collect())) == whole


def test_alignment_gives_its_groups(spark, texts):
    docs = common.documents(spark, texts)
    common.python_tasks(spark)
    for r in align.alignments(docs, P.path(align.A_FILE), P.path(align.B_FILE)).collect():
        assert len(r.a_to) == len(r.b_to) and (not r.a_ids or (r.a_to[-1], r.b_to[-1]) == (len(r.a_ids), len(r.b_ids)))


def test_diagonal_runs_on_random_ends():
    rng = np.random.default_rng(3)
    for _ in range(200):
        n = int(rng.integers(1, 400))
        cuts = [np.unique(np.append(rng.choice(np.arange(1, n + 1), int(rng.integers(1, n + 1))), n)) for _ in range(2)]
        g = align.align(*cuts)
        both = np.intersect1d(*cuts)
        assert (cuts[0][g.a_to - 1] == both).all() and (cuts[1][g.b_to - 1] == both).all()
        starts = [np.concatenate(([0], c[:-1])) for c in cuts]
        want = {(i, j) for i in range(len(cuts[0])) for j in range(len(cuts[1]))
                if max(starts[0][i], starts[1][j]) < min(cuts[0][i], cuts[1][j])}
        assert set(zip(g.link_a.tolist(), g.link_b.tolist())) == want and len(g.link_a) == len(want)


VECTORS = "vec_id long, embedding array<float>, label int, score string, bucket int, part int, rank int, probe int"


@pytest.fixture(scope="module")
def vectors(spark, tmp_path_factory):
    """Random and clustered vectors with equal ones, and rows that take no part."""
    rng = np.random.default_rng(5)
    own = rng.normal(size=(1500, 24))
    own[300:700] = own[7] + 0.02 * own[300:700]            # near copies
    own[700:1000] = own[8]                                 # equal ones
    own[1100:1200] *= 3.0
    rows = [(i, [float(np.float32(x)) for x in v], int(i * 7 % 3)) for i, v in enumerate(own)]
    rows += [(5000, None, 1), (5050, [0.0] * 24, 1), (5100, [float("nan")] + [1.0] * 23, 2), (5150, [None] + [1.0] * 23, 2),
             (5200, [float("inf")] * 24, 0), (5250, [], 0), (None, [1.0] * 24, 0), (5300, [1.0] * 10, None),
             (5350, [1.0, 2.0], 1), (100, rows[100][1], rows[100][2]), (101, rows[101][1], rows[101][2])]
    root = str(tmp_path_factory.mktemp("vectors"))
    spark.createDataFrame([(*r, "clash", 1, 1, 1, 1) for r in rows], VECTORS).repartition(5).write.parquet(f"{root}/embeddings.parquet")
    return root, rows


def usable(rows, zero):
    out = {}
    for i, v, label in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and (zero or any(v)):
            out[i] = (np.array(v + [0.0] * (24 - len(v))), label)
    return out


def brute_nearest(rows, k=5):
    own = usable(rows, zero=False)
    ids = np.array(sorted(own))
    x = np.stack([own[i][0] for i in ids])
    norm = np.sqrt((x * x).sum(axis=1))
    out = {}
    for q in ids[ids % 50 == 0]:
        v = own[q][0]
        score = np.round((x * v).sum(axis=1) / norm / np.sqrt((v * v).sum()), 10)
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != q][:k]
        out[int(q)] = [(int(ids[i]), float(score[i])) for i in order]
    return out


def near(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out[r.query_id].append((r.vec_id, round(r.score, 10)))
    return dict(out)


def test_few_buckets_are_exact(spark, vectors):
    assert near(ann.op12_ann(spark, vectors[0])) == brute_nearest(vectors[1])


def test_recall_with_many_buckets(spark, vectors):
    common.python_tasks(spark)
    rows = spark.read.parquet(f"{vectors[0]}/embeddings.parquet")
    got, want = near(ann.nearest(rows, F.col("vec_id") % 50 == 0, bucket_rows=12)), brute_nearest(vectors[1])
    hit = sum(score >= want[q][-1][1] for q in want for _, score in got[q])
    assert hit >= 0.9 * sum(map(len, want.values()))
    # the equal and the near copies lie in the same buckets
    assert got[700] == want[700] and got[750] == want[750]


def test_large_buckets_are_split(spark, vectors, monkeypatch):
    monkeypatch.setattr(ann, "CHUNK", 16)
    assert near(ann.op12_ann(spark, vectors[0])) == brute_nearest(vectors[1])


def test_rotations_keep_lengths_and_spread():
    x = np.random.default_rng(1).normal(size=(50, 24))
    h = ann.Hashing(24, 1 << 11)
    assert sum(h.bits) == 11 and h.tables > 4 and h.buckets == 1 << 11
    assert np.allclose(np.linalg.norm(ann.hadamard(np.pad(x, ((0, 0), (0, 8)))), axis=1), np.linalg.norm(x, axis=1))
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    assert (h.probed(unit, 0)[:, 0] == h.bucket(unit, 0)).all()       # a vector's own bucket is its first probe
    assert (h.bucket(unit, 0) == h.bucket(np.round(unit, 6), 0)).mean() > 0.95


def brute_negatives(rows):
    own = usable([r for r in rows if r[2] is not None], zero=True)
    q = {i: [int(math.floor(256 * x)) for x in v] for i, (v, _) in own.items()}
    label = {i: (l + 1) % 10 if i % 7 == 0 else l for i, (_, l) in own.items()}
    dot = lambda a, b: sum(x * y for x, y in zip(q[a], q[b]))
    out = set()
    for a in (i for i in own if i % 50 == 0):
        scores = sorted(((-dot(a, i), i) for i in own if i != a))
        for s, p in [(-s, i) for s, i in scores if label[i] == label[a]][:5]:
            far = [(-t, i) for t, i in scores if label[i] != label[a] and 50 * s <= -100 * t <= 95 * s][:3]
            out |= {(a, p, n + 1, i, s, t) for n, (t, i) in enumerate(far)}
    return out


def test_negatives_equal_brute_force(spark, vectors):
    got = [tuple(r) for r in negatives.op13_hard_negatives(spark, vectors[0]).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_negatives(vectors[1])


def test_negatives_in_chunks(spark, vectors):
    common.python_tasks(spark)
    rows = spark.read.parquet(f"{vectors[0]}/embeddings.parquet").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    got = negatives.hard_negatives(rows, F.col("vec_id") % 50 == 0, chunk=5)
    assert {tuple(r) for r in got.collect()} == brute_negatives(vectors[1])


@pytest.mark.parametrize("scale", [1.0, 1e-3, 1e6, 1e9])
def test_threshold_pairs_are_exact(scale):
    rng = np.random.default_rng(8)
    y = negatives.quantised(rng.normal(size=(400, 40)) * scale * np.linspace(2, 0.01, 40))
    a = negatives.quantised(rng.normal(size=(30, 40)) * scale)
    index = negatives.Index(np.arange(400), np.zeros(400), y)
    exact = negatives.big_scores(a, y)
    for share in (0.9, 0.5, 0.2, 0.0, -0.5):
        low = np.array([int(share * s) for s in exact.max(axis=1).tolist()])
        i, j, score = index.pairs(a, low)
        want = {(p, r) for p, r in zip(*np.nonzero(exact >= low[:, None]))}
        assert set(zip(i, j)) == want and (score == exact[i, j]).all()


def test_index_leaves_out_dimensions(monkeypatch):
    """With a high bound, most of the products are never made."""
    rng = np.random.default_rng(9)
    y = negatives.quantised(rng.normal(size=(2000, 64)) * np.linspace(3, 0.001, 64) ** 2)
    index, made = negatives.Index(np.arange(2000), np.zeros(2000), y), []
    keep = np.searchsorted
    monkeypatch.setattr(np, "searchsorted", lambda v, x, **kw: made.append(int(keep(v, x, **kw))) or made[-1])
    top = negatives.big_scores(y[:4], y).max(axis=1)
    index.pairs(y[:4], (0.9 * top).astype(np.int64))
    assert sum(made) < 0.5 * 4 * 2000


def test_first_of_each():
    got = first_of_each(np.array([1, 0, 1, 1, 1]), np.array([5, 1, 5, 9, 2]), np.array([4, 7, 3, 3, 8]), 2)
    assert got.tolist() == [1, 3, 0]
