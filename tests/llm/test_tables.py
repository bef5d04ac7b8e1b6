import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkwright.llm import mixing, neighbours, queries, shards
from sparkwright.llm.common import Words
from tests.conftest import SF001, SF01
from tests.llm import brute


# ------------------------------------------------------------------ neighbours

def exact(rows, asked, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], dtype=np.float64)
    out = {}
    for n, i in enumerate(ids):
        if asked(i):
            s = (x * x[n]).sum(axis=1)
            order = [m for m in np.lexsort((ids, -s)) if ids[m] != i][:k]
            out[int(i)] = [(int(ids[m]), s[m]) for m in order]
    return out


def found(df):
    out = defaultdict(list)
    for r in df.orderBy("query_id", "rank").collect():
        out[r.query_id].append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_recall_on_embeddings(spark):
    table = spark.read.parquet(f"{SF01}/embeddings.parquet")
    want = exact([(r.vec_id, r.embedding) for r in table.collect()], lambda i: i % 20 == 0, 20)
    got = found(queries.op4_nearest_neighbours(spark, SF01))
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    hits = [len({a for a, _ in got[q]} & {a for a, _ in want[q]}) for q in want]
    assert sum(hits) / (20 * len(want)) >= 0.9


@pytest.mark.parametrize("limits", [(20_000, 20_000), (7, 3)])
def test_all_buckets_give_the_exact_answer(spark, monkeypatch, limits):
    monkeypatch.setattr(neighbours, "CHUNK", limits[0])
    monkeypatch.setattr(neighbours, "SLICE", limits[1])
    rng = np.random.default_rng(1)
    rows = [(k, [float(x) for x in np.float32(rng.normal(size=5) * (1 + k % 3))]) for k in range(60)]
    rows += [(100 + k, [1.0, 2.0, 0.5, 0.0, 0.0]) for k in range(60)]  # one very common vector
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1)).repartition(5)
    got = found(neighbours.search(df, F.col("vec_id") % 4 == 0, k=6, tables=2, probes=64))
    assert got == exact(rows, lambda i: i % 4 == 0, 6)  # ties to the smaller id, scores to the last bit


def test_odd_vectors_and_few_candidates(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.9, 0.1]), (2, [-1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [1.0, None]),
            (20, [float("nan"), 1.0]), (40, [0.5, 0.5, 0.5]), (None, [1.0, 1.0]), (60, [float("inf"), 0.0]), (1, [0.9, 0.1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = found(neighbours.search(df, F.col("vec_id") % 20 == 0, k=20, tables=1, probes=1))
    fine = [(0, [1, 0, 0]), (1, list(map(float, np.float32([0.9, 0.1]))) + [0]), (2, [-1, 0, 0]), (40, [0.5] * 3)]
    assert got == exact(fine, lambda i: i % 20 == 0, 20)  # all candidates, if fewer than k
    assert neighbours.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert neighbours.search(df.where("vec_id = 0"), F.col("vec_id") % 20 == 0).count() == 0


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(0).normal(size=(9, 16))
    assert np.allclose((neighbours.turned(x, 3, 1) ** 2).sum(axis=1), (x * x).sum(axis=1))


# ------------------------------------------------------------------ mixing

def frame(spark, n):
    return spark.createDataFrame([(*k, v) for k, v in n.items()], "source string, lang string, topic string, n_tokens long")


def target_tables(spark, want):
    return {d: spark.createDataFrame(list(v.items()), f"{d} string, target double") for d, v in want.items()}


def drawn_share(rows):
    return sum(r.n_tokens * r.probability for r in rows) / sum(r.n_tokens for r in rows)


@pytest.mark.parametrize("far", [False, True])
def test_marginals_meet_the_targets(spark, monkeypatch, far):
    rng = np.random.default_rng(3)
    n = {(s, c, t): int(rng.integers(1, 1000)) for s in "abcd" for c in "xy" for t in "mnp"}
    want = {"source": dict(zip("abcd", (0.4, 0.3, 0.2, 0.1))), "lang": dict(x=0.7, y=0.3), "topic": dict(m=0.5, n=0.25, p=0.25)}
    if far:
        monkeypatch.setattr(mixing, "MOST_CELLS", 3)
    rows = frame(spark, n)
    got = mixing.with_probability(rows, mixing.probabilities(rows, target_tables(spark, want), 0.05)).collect()
    assert drawn_share(got) == pytest.approx(0.05, rel=1e-6)
    for d, shares in want.items():
        assert drawn_shares(got, d) == pytest.approx(shares, rel=1e-5)
    # nothing is whole at this budget: odds ratios of the observed table stay
    p = {(r.source, r.lang, r.topic): r.probability for r in got}
    assert max(p.values()) < 1
    assert p["a", "x", "m"] * p["b", "y", "m"] == pytest.approx(p["a", "y", "m"] * p["b", "x", "m"], rel=1e-5)


def drawn_shares(rows, d):
    out = Counter()
    for r in rows:
        out[r[d]] += r.n_tokens * r.probability
    return {v: x / sum(out.values()) for v, x in out.items()}


@pytest.mark.parametrize("budget", [0.3, 0.6, 0.9])
def test_drawn_marginals_meet_the_targets(spark, budget):
    """Of the draw itself, not of the raked mass: no cell gives more than it has, none is short for it, and
    the budget stays when a value has too little."""
    n = {("a", "x", "m"): 10, ("a", "y", "m"): 4000, ("b", "x", "m"): 3000, ("b", "y", "m"): 900, ("b", "y", "n"): 2500, ("a", "x", "n"): 1500}
    want = {"source": dict(a=0.55, b=0.45), "lang": dict(x=0.45, y=0.55), "topic": dict(m=0.6, n=0.4)}
    rows = frame(spark, n)
    got = mixing.with_probability(rows, mixing.probabilities(rows, target_tables(spark, want), budget)).collect()
    assert len(got) == len(n) and all(0 < r.probability <= 1 for r in got)
    assert drawn_share(got) == pytest.approx(budget, rel=1e-6)
    if budget < 0.8:
        for d, shares in want.items():
            assert drawn_shares(got, d) == pytest.approx(shares, rel=1e-5)
    else:  # 10,719 tokens: a, x and n have less than their shares and are drawn whole
        assert drawn_shares(got, "topic")["n"] == pytest.approx(4000 / (0.9 * 11910), rel=1e-3)


@pytest.mark.parametrize("far", [False, True])
def test_scarce_value_does_not_lower_the_budget(spark, monkeypatch, far):
    n = {(f"s{i}", f"l{j}", "t"): 1_000_000 for i in range(4) for j in range(4)} | {("odd", "l0", "t"): 1}
    if far:
        monkeypatch.setattr(mixing, "MOST_CELLS", 3)
    rows = frame(spark, n)
    got = mixing.with_probability(rows, mixing.probabilities(rows)).collect()
    assert drawn_share(got) == pytest.approx(0.7, rel=1e-6)
    assert next(r.probability for r in got if r.source == "odd") == pytest.approx(1.0, rel=1e-4)


def test_unmet_targets_are_reported(spark):
    n = {("a", "x", "m"): 10, ("b", "x", "m"): 990, ("b", "y", "m"): 1000}
    rows = frame(spark, n)
    targets = target_tables(spark, {"source": dict(a=0.5, b=0.5), "lang": dict(x=0.5, y=0.5), "topic": dict(m=1.0)})
    got = {(r.dimension, r.value): r for r in mixing.report(rows, mixing.probabilities(rows, targets), targets).collect()}
    a, b = got["source", "a"], got["source", "b"]
    assert (a.tokens, a.target) == (10, 0.5) and a.drawn == pytest.approx(10 / 1400, rel=1e-4)
    assert a.missed == pytest.approx(0.5 - a.drawn) and b.drawn + a.drawn == pytest.approx(1)
    assert got["lang", "x"].missed == pytest.approx(0, abs=1e-5)


def test_values_without_a_target_are_not_drawn(spark, monkeypatch):
    n = {("a", "x", "m"): 100, ("b", "x", "m"): 300, ("c", "x", "m"): 600}
    rows = frame(spark, n)
    targets = target_tables(spark, {"source": dict(a=0.5, b=0.5, c=0.0), "lang": dict(x=1.0), "topic": dict(m=1.0)})
    for most in (100, 1):
        monkeypatch.setattr(mixing, "MOST_CELLS", most)
        got = {r.source: r.probability for r in mixing.probabilities(rows, targets).collect()}
        assert got == pytest.approx(dict(a=1.0, b=1.0, c=0.0))  # 400 usable tokens are less than the budget


def test_fill_is_the_largest_common_factor():
    rng = np.random.default_rng(5)
    for _ in range(200):
        n = rng.integers(1, 50, 12).astype(float)
        mass, code = n * rng.random(12) + 1e-9, rng.integers(0, 3, 12)
        has = np.bincount(code, weights=n, minlength=3)
        need = has * rng.random(3)
        got = mixing.fill(n, mass, need, code)
        assert np.all(got <= n) and np.allclose(np.bincount(code, weights=got, minlength=3), need)
        for g in range(3):  # one factor for all that are not whole, and the whole ones would exceed it
            own = code == g
            f = got[own & (got < n)] / mass[own & (got < n)]
            if len(f):
                assert np.allclose(f, f[0]) and np.all(f[0] * mass[own & (got >= n)] >= n[own & (got >= n)] * (1 - 1e-9))


def test_drawn_marginals_of_the_documents(spark):
    """Sources and languages have enough tokens of each value and meet their tempered shares; topics do
    not, and every scarce topic is drawn (nearly) whole."""
    rows = queries.op9_source_mixing(spark, SF01).collect()
    assert drawn_share(rows) == pytest.approx(0.7, rel=1e-6)
    tokens = {d: Counter() for d in ("source", "lang", "topic")}
    for r in rows:
        for d in tokens:
            tokens[d][r[d]] += r.n_tokens
    whole = sum(tokens["lang"].values())
    for d in ("source", "lang"):
        t = {k: v ** mixing.POWER for k, v in tokens[d].items()}
        assert drawn_shares(rows, d) == pytest.approx({k: v / sum(t.values()) for k, v in t.items()}, rel=1e-4)
    for value, share in drawn_shares(rows, "topic").items():
        if value != "prose":
            assert share * 0.7 * whole == pytest.approx(tokens["topic"][value], rel=1e-3)


def test_contradicting_targets_keep_the_budget(spark):
    rows = frame(spark, {("a", "x", "m"): 10, ("b", "x", "m"): 20, ("c", "y", "m"): 300})
    got = mixing.with_probability(rows, mixing.probabilities(rows)).collect()  # sources a and b against language x
    assert len(got) == 3 and all(0 < r.probability <= 1 for r in got) and drawn_share(got) == pytest.approx(0.7)


def test_mixing_edges(spark, edge, edge_rows, nothing):
    rows = mixing.sample(edge).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in edge_rows)
    by = {(r.doc_id, r.n_tokens): r for r in rows}
    assert by[1, 1].n_tokens == 1 and by[3, 1].lang == "(none)" and by[4, 2].source == "(none)"
    assert all(0 < r.probability <= 1 for r in rows)
    kept = mixing.keep_sampled(edge)
    assert kept.columns == edge.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in rows if r.selected)
    assert mixing.sample(nothing).count() == 0 and mixing.keep_sampled(nothing).count() == 0


def test_draws_follow_the_probabilities(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"),
                                      F.when(F.col("id") % 4 == 0, "x").otherwise("y").alias("source"), F.lit("en").alias("lang"))
    got = {r.source: r for r in mixing.sample(docs).groupBy("source").agg(
        F.avg(F.col("selected").cast("double")).alias("rate"), F.max("probability").alias("p")).collect()}
    for r in got.values():
        assert abs(r.rate - r.p) < 0.02
    assert got["x"].p > got["y"].p  # the smaller source is drawn more densely


# ------------------------------------------------------------------ shards

def test_shards_match_brute_force(spark, edge, edge_rows, nothing):
    for n in (16, 3):
        rows = sorted(((zlib.crc32((t or "").encode()), len((t or "").encode()) + 1, i is not None, i or 0, i)
                       for i, t in edge_rows))
        total, at, slots, want = sum(r[1] for r in rows), 0, Counter(), Counter()
        for crc, size, _, _, i in rows:
            shard = (2 * at + size) * n // (2 * total)
            want[i, size, crc, shard, slots[shard]] += 1
            slots[shard] += 1
            at += size
        assert Counter(map(tuple, shards.byte_shards(shards.sizes(edge), n).collect())) == want
    assert shards.byte_shards(shards.sizes(nothing)).count() == 0


def test_shards_are_balanced_and_contiguous(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    rows = sorted(shards.byte_shards(shards.sizes(docs.repartition(7)), 16).collect(), key=lambda r: (r.text_crc32, r.size, r.doc_id))
    assert [r.shard for r in rows] == sorted(r.shard for r in rows)
    # equal texts share a shard, but for groups that one of the 15 cuts goes through
    groups = defaultdict(set)
    for r in rows:
        groups[r.text_crc32, r.size].add(r.shard)
    assert sum(len(s) > 1 for s in groups.values()) <= 15 and sum(1 for s in groups.values()) < len(rows) - 30
    total, largest = Counter(), max(r.size for r in rows)
    for r in rows:
        total[r.shard] += r.size
    assert len(total) == 16 and max(total.values()) - min(total.values()) <= 2 * largest
    one_key = spark.range(5000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    got = shards.byte_shards(shards.sizes(one_key), 4).groupBy("shard").agg(F.count("*").alias("n"), F.max("slot").alias("m"))
    assert {(r.n, r.m) for r in got.collect()} == {(1250, 1249)}


# ------------------------------------------------------------------ words, queries, pipeline

def test_words_match_the_pattern(edge_rows):
    texts = [t or "" for _, t in edge_rows]
    w = Words(texts)
    for k, t in enumerate(texts):
        own = [w.data[a:b].decode() for a, b in zip(w.start[w.first[k]:w.first[k + 1]], w.end[w.first[k]:w.first[k + 1]])]
        assert own == brute.words(t)
    h, seen = w.hashes(), {}
    for a, b, x in zip(w.start, w.end, h):
        assert seen.setdefault(w.data[a:b], x) == x
    assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_its_sql(spark, duck, name):
    df = queries.JOBS[name](spark, SF01)
    want = duck.execute(queries.ORACLE[name]).fetchall()
    names = [d[0] for d in duck.description]
    assert sorted(names) == sorted(df.columns)
    got = Counter(tuple(r) for r in df.select(*names).collect())
    assert got == Counter(map(tuple, want))


def test_pipeline_matches_brute_force(spark):
    import hashlib
    from array import array

    import corpus_pipeline
    import public_tokenizers
    from tokenizers import Tokenizer

    from sparkwright.llm import preference
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    ranking = preference.train(docs, spark.read.parquet(f"{SF001}/labels.parquet"))
    rows = sorted(docs.collect(), key=lambda r: r.doc_id)
    rows = [r for r, s in zip(rows, ranking.score(preference.features([r.text or "" for r in rows]))) if s >= preference.CUT]
    label = brute.classes([brute.fingerprint(r.text) for r in rows])
    rows = [r for k, r in enumerate(rows) if label[k] == k]
    gone = brute.covered([(r.doc_id, r.text) for r in rows])
    texts = {}
    for r, g in zip(rows, gone):
        at = [m.span() for m in brute.SPACE_WORD.finditer(r.text)]
        ends = [a for a, _ in at[1:]] + [len(r.text)]
        texts[r.doc_id] = r.text if not g else r.text[:at[0][0]] + "".join(
            r.text[at[k][0]:ends[k]] for k in range(len(at)) if k not in g)
    cells, keys = defaultdict(int), {}
    import re
    for r in rows:
        t = texts[r.doc_id]
        topic = next((n for n, p in mixing.TOPICS if re.search(p, t.lower())), "prose")
        keys[r.doc_id] = (r.source or "(none)", r.lang or "(none)", topic)
        cells[keys[r.doc_id]] += len(brute.words(t)) + 1
    chance = brute.mixed(cells, mixing.BUDGET, mixing.POWER, mixing.SWEEPS)
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for r in rows:
        k = keys[r.doc_id]
        u = int(hashlib.md5(f"{r.doc_id}:mix".encode()).hexdigest()[:13], 16) / 16**13
        if u < chance[k]:
            ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
            want[r.doc_id, len(ids), brute.sha(array("I", ids).tobytes()), brute.sha(library.decode(ids, skip_special_tokens=False))] += 1
    got = Counter(map(tuple, corpus_pipeline.run(spark, SF001).collect()))
    assert got == want and len(want) > 60
    assert [n for n, _ in corpus_pipeline.STAGES][-1] == "bpe_encoding"


def test_pipeline_stages_keep_the_columns(spark, edge, nothing):
    import corpus_pipeline
    for docs in (edge, nothing):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF001)
            assert out.columns == corpus_pipeline.COLUMNS
            assert out.count() <= docs.count()
