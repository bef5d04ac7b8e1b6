import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkwright.llm import jaccard, queries
from tests.conftest import SF001, SF01
from tests.llm import brute


def shingles(text, length=5):
    w = brute.words(brute.lower(text))
    return {tuple(w[k:k + length]) for k in range(len(w) - length + 1)} or ({tuple(w)} if w else set())


def plain(rows, length=5, percent=80):
    """(doc_id, n, component) by comparing all pairs that share a shingle."""
    sets = [shingles(t, length) for _, t in rows]
    holders = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            holders[x].append(k)
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    shared = Counter()
    for own in holders.values():
        own = [k for k in own if rows[k][0] is not None]
        for a in range(len(own)):
            for b in range(a):
                shared[own[b], own[a]] += 1
    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            up[find(b)] = find(a)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    same = {frozenset(s): least[find(k)] for k, s in enumerate(sets) if rows[k][0] is not None and s}
    return Counter((i, len(s), least[find(k)] if i is not None else same.get(frozenset(s)) if s else None)
                   for k, ((i, _), s) in enumerate(zip(rows, sets)))


def got(df):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


def test_join_matches_all_pairs(spark):
    for folder in (SF001, SF01):
        rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
        want = plain(rows)
        assert got(queries.op12_jaccard_join(spark, folder)) == want
    assert sum(1 for i, _, c in want if i != c) > 50


def mutated(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"z{rng.randrange(10**6)}"
    return out


@pytest.fixture(scope="module")
def hard():
    """Chains, dense groups, a passage that fills a quarter to all of a text, lengths in and out of reach."""
    rng = random.Random(11)
    rows, i = [], 0

    def add(words):
        nonlocal i
        rows.append((i, " ".join(words)))
        i += 1
    passage = [f"p{k}" for k in range(40)]
    for k in range(60):  # boilerplate with a tail of its own: near and far from each other
        add(passage + [f"t{k}_{x}" for x in range(rng.choice((1, 2, 4, 6, 10, 40)))])
    for _ in range(6):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(30, 200))]
        chain = base
        for _ in range(12):
            chain = mutated(rng, chain, rng.randrange(0, 4))
            add(chain)
            add(mutated(rng, base, rng.randrange(0, 5)))
            add(chain[:len(chain) - rng.randrange(0, 30)])
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("limits", [(1_000_000, 300_000), (300, 150)])
@pytest.mark.parametrize("length, percent", [(5, 80), (3, 60), (1, 100), (2, 90)])
def test_join_of_hard_groups(spark, monkeypatch, hard, limits, length, percent):
    """Also with components cut into many slices and stars into many parts."""
    monkeypatch.setattr(jaccard, "SLICE", limits[0])
    monkeypatch.setattr(jaccard, "STAR", limits[1])
    df = spark.createDataFrame(hard, "doc_id long, text string").repartition(5)
    assert got(jaccard.near_duplicates(df, length, percent)) == plain(hard, length, percent)


def test_join_edges(spark, edge, edge_rows, nothing):
    out = jaccard.near_duplicates(edge.withColumn("key", F.lit(1)))
    assert got(out) == plain(edge_rows)
    assert jaccard.near_duplicates(nothing).count() == 0
    one_word = spark.createDataFrame([(3, "Hello"), (2, "hello"), (1, "hello world"), (4, "a b c d E"), (5, "A b c d e")], "doc_id long, text string")
    assert got(jaccard.near_duplicates(one_word)) == Counter([(3, 1, 2), (2, 1, 2), (1, 1, 1), (4, 1, 4), (5, 1, 4)])


def test_repeated_ids_with_different_texts_stay_apart(spark):
    rows = [(1, "a b c d e f"), (1, "u v w x y z"), (2, "u v w x y z"), (3, "a b c d e f")]
    out = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got(out) == plain(rows)


def test_merge_skip_counts_lists():
    rng = random.Random(3)
    for _ in range(200):
        lists = [sorted(rng.sample(range(30), rng.randrange(0, 12))) for _ in range(rng.randrange(1, 15))]
        place, ranges = [], []
        for x in lists:
            ranges.append((len(place), len(place) + len(x)))
            place += x
        need = rng.randrange(1, 8)
        count = Counter(d for x in lists for d in x)
        assert list(jaccard.merge_skip(place, ranges, need)) == sorted((d, n) for d, n in count.items() if n >= need)


def test_divide_skip_finds_what_counting_finds():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, rng.integers(5, 50))) for _ in range(80)]
    index = jaccard.Index(sets)
    for q in sets:
        for least in (3, len(q) // 2 + 1, len(q)):
            want = {k for k in range(10, 70) if len(np.intersect1d(q, sets[k])) >= least}
            found = {k for k, n, rest in index.search(q, least, 10, 70) if n + index.probe(k, rest) >= least}
            assert found == want


def test_shingles_that_agree_in_their_short_form_lose_no_partner(monkeypatch):
    """Counted together, they get a class that is too high, never one that is too low; the same in all blocks."""
    import pyarrow as pa
    texts = [["a b c d e f g", "p q r s t u", "x y z"], ["b c d e f g h", "k l m n o"], ["a b c d e f g", "x y z"]]

    def classes():
        blocks = [jaccard.Block(pa.table({"doc_id": [10 * k + j for j in range(len(t))], "text": t}), 5, 3) for k, t in enumerate(texts)]
        asked = [(k, *row) for k, b in enumerate(blocks) for row in b.asked()]
        out = {}
        for part in {a[1] for a in asked}:
            own = [a for a in asked if a[1] == part]
            reply = jaccard._frequencies(pa.table({"block": [a[0] for a in own], "part": [a[1] for a in own],
                                                   "tokens": pa.array([a[2] for a in own], pa.binary()), "counts": pa.array([a[3] for a in own], pa.binary())}))
            for r in reply.to_pylist():
                out.setdefault(r["block"], {})[r["part"]] = r["classes"]
        found = {}
        for k, b in enumerate(blocks):
            for token, c in zip(b.sets.tokens[b.used], b.classes(out[k])):
                assert found.setdefault(int(token), int(c)) == int(c)
        return found
    right = classes()
    assert Counter(c > 0 for c in right.values()) == Counter({True: 4, False: 4})
    monkeypatch.setattr(jaccard, "short_form", lambda tokens, groups: bytes(5 * len(tokens)))
    merged = classes()
    assert merged.keys() == right.keys() and all(merged[t] >= c for t, c in right.items())


def test_sets_are_distinct_shingles():
    texts = ["", "one", "a b c d", "a b c d e", "x y " * 50, "The THE the the the the"]
    s = jaccard.Sets(texts, 5)
    assert s.size.tolist() == [len(shingles(t)) for t in texts]
    keys = s.keys()
    assert keys[0] is None and len(set(keys)) == len(texts)


@pytest.mark.parametrize("scan, limits, length, percent", [(0, (1_000_000, 300_000), 5, 80), (1_000, (300, 150), 2, 60), (10**9, (300, 150), 5, 80)])
def test_every_link_is_counted(spark, monkeypatch, hard, scan, limits, length, percent):
    """Links inside connected groups too, those of copies once each; by merging, by counting, and cut into slices."""
    for name, v in zip(("SLICE", "STAR", "SCAN"), (*limits, scan)):
        monkeypatch.setattr(jaccard, name, v)
    rows = hard + [(1000 + k, hard[k % 7][1]) for k in range(20)] + [hard[3], (None, hard[5][1]), (5000, ""), (5001, None)]
    sets = [shingles(t, length) for _, t in rows]
    want = Counter()
    for (i, _), s in zip(rows, sets):
        n = sum(1 for (j, _), o in zip(rows, sets) if s and o and j is not None and 100 * len(s & o) >= percent * len(s | o))
        want[i, n - 1 if i is not None and s else 0] += 1
    out = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), length, percent)
    assert Counter((r.doc_id, r.n_links) for r in out.collect()) == want
