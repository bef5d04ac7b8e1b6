import hashlib
import itertools
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkwright.llm import centroids, filter_audit, queries
from tests.conftest import SF001
from tests.llm import brute

# ------------------------------------------------------------------ filter audit


def fails(text):
    t, w = text or "", brute.words(text)
    return {f for f, bad in (("A", len(w) < 50), ("B", 100 * len(set(w)) < 65 * len(w)),
                             ("C", 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t)),
                             ("D", re.search(r"[#$%&*|]", t) is not None)) if bad}


def plain_audit(docs, labels):
    """docs: (id, text, source); every document goes through every order one filter at a time."""
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    own = [(s or "", fails(t) | ({"E"} if i is not None and least[t or ""] < i else set()), labels.get(i, (0, 0))) for i, t, s in docs]
    want = {}
    for part in {p for p, _, _ in own}:
        mine, shapley = [x for x in own if x[0] == part], Counter()
        rows = {}
        for order in map("".join, itertools.permutations("ABCDE")):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                shapley[f] += len(gone)
                rows[order, step] = (len(left), len(gone), sum(f in x[1] for x in mine) - len(gone), sum(x[1] == {f} for x in mine),
                                     sum(x[2][0] for x in gone), sum(x[2][1] for x in gone))
        want |= {(part, o, k): (*v, shapley[o[k - 1]]) for (o, k), v in rows.items()}
    return want


def as_dict(df):
    return {(r.part, r.filter_order, r.step): tuple(r[c] for c in filter_audit.COLUMNS) for r in df.collect()}


def test_audit_matches_one_document_at_a_time(spark):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    labels = {r.doc_id: (int(r.quality == 1), int(r.toxic == 1)) for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()}
    got = queries.op11_filter_audit(spark, SF001)
    assert as_dict(got) == plain_audit(docs, labels)


def test_audit_edges(spark, edge, edge_rows, nothing):
    labels = spark.createDataFrame([(1, 1, None), (8, 1, 0), (8, 0, 1), (None, 1, 1), (99, 1, 1), (12, None, 1)],
                                   "doc_id long, quality int, toxic int")
    sources = [(r.doc_id, r.text, r.source) for r in edge.collect()]
    known = {1: (1, 0), 8: (1, 1), 12: (0, 1)}
    want = plain_audit(sources, known)
    assert as_dict(filter_audit.audit(edge, labels)) == want
    assert as_dict(filter_audit.audit(edge.drop("labels").withColumn("mask", F.lit(1)), labels.limit(0))) == plain_audit(sources, {})
    assert filter_audit.audit(nothing, labels).count() == 0
    assert {p for p, _, _ in want} == {"", "a", "b", "c"}


def test_min_plus_ranks():
    tables = filter_audit.Orders(3)
    for m in range(8):
        for k, order in enumerate(itertools.permutations(range(3))):
            want = next((s for s, f in enumerate(order) if m >> f & 1), 3)
            assert tables.rank[m, k] == want


def test_failures_count_code_points_and_ascii_words():
    for text in ("", "a\x1cb c \x85 d", "ÄÖÜ" * 40 + " A B", "word " * 49, "word " * 50, "A" * 5 + "b" * 95, "A" * 6 + "b" * 94, "x|y"):
        bits = filter_audit.failures(text.encode())
        assert {f for k, f in enumerate("ABCD") if bits >> k & 1} == fails(text)


# ------------------------------------------------------------------ centroid clustering

def plain_clusters(rows, k=40, rounds=5, size=64):
    keep = [(i, [math.floor(256 * x) for x in map(float, v)]) for i, v in rows
            if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    cents = [v for _, v in sorted((hashlib.sha256(f"2:{'null' if i is None else i}".encode()).hexdigest(), v) for i, v in keep)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cents))
    for _ in range(rounds):
        own = defaultdict(list)
        for _, v in keep:
            own[nearest(v)[1]].append(v)
        cents = [[sum(x) // len(own[n]) for x in zip(*own[n])] if own[n] else c for n, c in enumerate(cents)]
    last = [(i, *nearest(v)) for i, v in keep]
    inertia = Counter()
    for _, d, n in last:
        inertia[n] += d
    return Counter((i, n, d, inertia[n], sum(inertia.values()), brute.sha(",".join(map(str, cents[n])))) for i, d, n in last)


def test_clusters_match_plain_integers(spark):
    table = spark.read.parquet(f"{SF001}/embeddings.parquet")
    want = plain_clusters([(r.vec_id, r.embedding) for r in table.collect()])
    got = Counter(map(tuple, queries.op13_centroid_clustering(spark, SF001).collect()))
    assert got == want and sum(got.values()) == 500


@pytest.mark.parametrize("parts", [1, 9])
def test_cluster_ties_repeats_and_odd_vectors(spark, parts):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 3) / 256]) for i in range(200)]  # few places: ties everywhere
    rows += [(7, [0.0, 0.0, 0.0])] * 50 + [(None, [0.5, -0.5, 0.25])] * 2
    rows += [(300, None), (301, [1.0, 2.0]), (302, [1.0, None, 2.0]), (303, [float("nan")] * 3), (304, [float("inf"), 0.0, 0.0]),
             (305, []), (306, [-0.001, 0.001, 0.9999])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("cluster", F.lit("x")).repartition(parts)
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    for k, rounds in ((40, 5), (3, 2), (1, 1), (1000, 0)):
        got = Counter(map(tuple, centroids.cluster(df, k, rounds, size=3).collect()))
        assert got == plain_clusters(rows, k, rounds, 3)


def test_large_components_are_exact(spark):
    rows = [(1, [1e30, 0.0]), (2, [1e30, 1.0]), (3, [-3e38, 2.0]), (4, [5e5, 7.0]), (5, [6e5, -7.0]), (6, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    stored = [(r.vec_id, r.embedding) for r in df.collect()]
    want = Counter({(i, n, min(d, 2**63 - 1), min(a, 2**63 - 1), min(b, 2**63 - 1), h): c
                    for (i, n, d, a, b, h), c in plain_clusters(stored, 3, 4, 2).items()})
    assert Counter(map(tuple, centroids.cluster(df, 3, 4, size=2).collect())) == want


def test_clusters_of_nothing(spark):
    df = spark.createDataFrame([(1, None), (2, [1.0])], "vec_id long, embedding array<float>")
    out = centroids.cluster(df)
    assert out.count() == 0 and out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert centroids.cluster(df.limit(0)).count() == 0


def test_sign_tests_agree_with_distances():
    rng = np.random.default_rng(4)
    c = [list(map(int, x)) for x in rng.integers(-3, 4, (12, 4))]
    c[5] = c[2]  # equal centroids: the smaller number wins
    v = rng.integers(-4, 5, (500, 4))
    number, distance = centroids.Bisectors(c).nearest(v)
    d = ((v[:, None, :] - np.array(c)[None]) ** 2).sum(axis=2)
    assert np.array_equal(number, d.argmin(axis=1)) and np.array_equal(distance, d.min(axis=1))
