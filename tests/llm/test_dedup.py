import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from sparkwright.llm import simhash, substrings
from sparkwright.llm.components import connected_components
from tests.llm import brute


def text_of(rng, vocabulary, n):
    return " ".join(rng.choice(vocabulary) for _ in range(n))


@pytest.fixture(scope="module")
def passages():
    rng = random.Random(3)
    vocabulary = [f"v{k}" for k in range(40)] + ["the"] * 60
    shared = [text_of(rng, vocabulary, n) for n in (13, 14, 20, 60, 12, 5)]
    rows = []
    for i in range(120):
        parts = [text_of(rng, vocabulary, rng.randint(0, 30)) for _ in range(3)]
        for _ in range(rng.randint(0, 3)):
            parts.insert(rng.randint(0, 3), rng.choice(shared))
        rows.append((rng.randint(0, 100), rng.choice([" ", "\n", " \t "]).join(parts)))
    return rows + [(200 + k, shared[3]) for k in range(40)]


def check_substrings(df, rows, size=13):
    want = Counter()
    for (i, t), gone in zip(rows, brute.covered(rows, size)):
        w = brute.words(t)
        want[i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)] += 1
    got = Counter()
    for r in df.collect():
        got[r.doc_id, r.n_words, r.n_removed, r.text] += 1
        assert sum(s.words for s in r.spans) == r.n_removed
    assert got == want


@pytest.mark.parametrize("limits", [(2_000_000, 6_000_000, 16_384), (50, 400, 8)])
def test_substring_dedup_matches_brute_force(spark, passages, monkeypatch, limits):
    for name, v in zip(("GROUP", "BLOCK", "MOST_PREFIXES"), limits):
        monkeypatch.setattr(substrings, name, v)
    df = spark.createDataFrame(passages, "doc_id long, text string").repartition(4)
    check_substrings(substrings.remove_repeats(df, 13), passages)


@pytest.mark.parametrize("hashes", [1, 3, 1 << 62])
def test_substring_repeats_are_compared_by_words(passages, monkeypatch, hashes):
    """Paths of few different hashes: neither a block's nodes nor a group's tree may mix them up."""
    path = substrings.Suffixes.path
    monkeypatch.setattr(substrings.Suffixes, "path", lambda self: path(self) % np.uint64(hashes) << np.uint64(64 - substrings.BITS))
    monkeypatch.setattr(substrings, "CHUNK", 500)
    rows = passages + [(None, passages[-1][1])]
    tables = [pa.table({"doc_id": [i for i, _ in part], "text": [t for _, t in part]}) for part in (rows[k::5] for k in range(5))]
    blocks = [substrings.Block(t, 13, {}, 2) for t in tables]
    asked = [(k, *x) for k, b in enumerate(blocks) for x in b.sieved()]
    among = [{} for _ in blocks]
    for g in range(2):
        out = substrings.sieve(pa.table(dict(zip(("block", "part", "fingers"), zip(*[x for x in asked if x[1] == g])))))
        for r in out.to_pylist():
            among[r["block"]][g] = r["among"]
    told = [(k, *x) for k, b in enumerate(blocks) for x in b.told(among[k])]
    later = [{} for _ in blocks]
    names = ("block", "part", "among", "documents", "counts", "words")
    for g in range(2):
        out = substrings.answers(pa.table(dict(zip(names, zip(*[x for x in told if x[1] == g])))), 13)
        for r in out.to_pylist():
            later[r["block"]][g] = (r["among"], r["later"])
    whole = brute.covered([r for r in rows if r[0] is not None], 13) + [set()]
    for k, b in enumerate(blocks):
        gone = b.covered(b.marked(later[k]))
        first = b.s.words.first
        for j, want in enumerate(whole[k::5]):
            assert set(np.flatnonzero(gone[first[j]:first[j + 1]]).tolist()) == set(want)


@pytest.mark.parametrize("hashes", [1, 3, 1 << 62])
def test_substring_blocks_may_be_read_in_another_order_each_time(monkeypatch, hashes):
    """Every step builds its blocks from rows in an order of its own (as an exchange between machines hands them over)."""
    path = substrings.Suffixes.path
    monkeypatch.setattr(substrings.Suffixes, "path", lambda self: path(self) % np.uint64(hashes) << np.uint64(64 - substrings.BITS))
    rng = random.Random(9)
    words = [f"v{k}" for k in range(400)]
    shared = [text_of(rng, words, 30) for _ in range(12)]
    rows = [(k, " ".join(x for _ in range(4) for x in (rng.choice(shared), text_of(rng, words, rng.randint(0, 3))))) for k in rng.sample(range(90), 60)]
    rows += [rows[3], (rows[4][0], rows[5][1]), (None, rows[6][1])]

    def step():
        order = [rng.sample(rows[k::3], len(rows[k::3])) for k in range(3)]
        return [substrings.Block(pa.table({"doc_id": [i for i, _ in part], "text": [t for _, t in part]}), 13, {}, 2) for part in order]

    def exchanged(found, names, group):
        out = [{} for _ in range(3)]
        for g in range(2):
            for r in group(pa.table(dict(zip(names, zip(*[x for x in found if x[1] == g]))))).to_pylist():
                out[r["block"]][g] = r
        return out
    among = exchanged([(k, *x) for k, b in enumerate(step()) for x in b.sieved()], ("block", "part", "fingers"), substrings.sieve)
    told = [(k, *x) for k, b in enumerate(step()) for x in b.told({g: r["among"] for g, r in among[k].items()})]
    later = exchanged(told, ("block", "part", "among", "documents", "counts", "words"), lambda t: substrings.answers(t, 13))
    got, want = Counter(), Counter()
    for k, b in enumerate(step()):
        gone = b.covered(b.marked({g: (r["among"], r["later"]) for g, r in later[k].items()}))
        for j, (i, t) in enumerate(zip(b.ids.to_pylist(), b.texts)):
            got[i, t, tuple(np.flatnonzero(gone[b.s.words.first[j]:b.s.words.first[j + 1]]).tolist())] += 1
    for (i, t), gone in zip(rows, brute.covered(rows, 13)):
        want[i, t, tuple(sorted(gone))] += 1
    assert got == want


def test_substring_dedup_edges(spark, edge, edge_rows, nothing):
    check_substrings(substrings.remove_repeats(edge, 13), edge_rows)
    assert substrings.remove_repeats(nothing, 13).count() == 0
    layout = {(r.doc_id, r.n_removed): r for r in substrings.remove_repeats(edge, 13, keep_layout=True, carry=("lang",)).collect()}
    assert layout[3, 0].text == " \t\n " and layout[3, 0].lang is None  # untouched texts keep their layout
    # fourteen common words start in document 5, so two windows of document 6 go
    assert layout[6, 14].text == "head of six " and layout[8, 14].text == ""


def test_prefix_groups_are_of_variable_length(spark):
    rows = [(k, " ".join(["the"] * 20 + [f"u{k}_{j}" for j in range(200)])) for k in range(50)]
    table = substrings.prefix_table(spark.createDataFrame(rows, "doc_id long, text string"), 13, 0.13)
    # 50 x (21 - length) of 50 x 208 suffixes start with that many "the": over 0.065 of all up to length 7
    assert sorted(table) == [3, 4, 5, 6, 7]
    rows = [(k, " ".join(["the"] * 100)) for k in range(50)]
    table = substrings.prefix_table(spark.createDataFrame(rows, "doc_id long, text string"), 13, 0.13)
    assert sorted(table) == list(range(3, 14)) and all(len(v) == 1 for v in table.values())


def test_simhash_edges(spark, edge, edge_rows, nothing):
    got = Counter((r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in simhash.near_duplicates(edge).collect())
    fps = [brute.fingerprint(t) for _, t in edge_rows]
    ids = [k for k, (i, _) in enumerate(edge_rows) if i is not None]
    label = brute.classes([fps[k] for k in ids])
    least = {}
    for k, c in zip(ids, label):
        least[c] = min(least.get(c, 10**9), edge_rows[k][0])
    of = {fps[k]: least[c] for k, c in zip(ids, label)}
    assert got == Counter((i, f, of.get(f)) for (i, _), f in zip(edge_rows, fps))
    assert simhash.near_duplicates(nothing).count() == 0
    kept = simhash.keep_one(edge)
    assert kept.columns == edge.columns
    ids_kept = [r.doc_id for r in kept.select("doc_id").collect()]
    assert sorted(x for x in ids_kept if x is not None) == sorted(set(least.values()))
    assert ids_kept.count(None) == 1  # "no id here"; the other null copies document 7


@pytest.mark.parametrize("node", [100_000, 30])
def test_trie_links_match_brute_force(spark, monkeypatch, node):
    monkeypatch.setattr(simhash, "NODE", node)
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(30)]
    values = set(base)
    for b in base[:6]:  # dense classes, and chains of them
        for _ in range(120):
            x = b
            for _ in range(rng.randint(1, 5)):
                x ^= 1 << rng.randrange(64)
            values.add(x)
    values |= {0, 1, 3, 7, 15, 2**64 - 1, 2**63}
    values = sorted(values)
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    reps = spark.createDataFrame(list(zip(signed, range(len(values)))), "fp long, rep long")
    edges = simhash.links(reps)
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert [got.get(k, k) for k in range(len(values))] == brute.classes(values)
    assert edges.count() < 8 * len(values)  # a forest per task, not all pairs


def test_trie_join_splits_by_bits():
    rng = np.random.default_rng(2)
    v = np.sort(np.unique(rng.integers(0, 2**63, 3000).astype(np.uint64) & np.uint64((1 << 20) - 1)))
    whole = np.array([[0, len(v)]])
    label = simhash.trie_join(v, whole, whole, 0, 1)
    assert label.tolist() == brute.classes([int(x) for x in v], 1)


def test_components_of_a_long_chain_and_a_hub(spark):
    pairs = [(k, k + 1) for k in range(60)] + [(100, 100 + k) for k in range(80)] + [(5, 5), (None, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert got == {k: 0 for k in range(61)} | {100 + k: 100 for k in range(80)}


def test_keep_one_leaves_clashing_columns_alone(spark):
    rows = [(1, "the same words here", "x", 5), (1, "the same words here", "y", 6), (2, "the same words here", "z", 7), (3, None, "n", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row_a string, __row long").withColumnRenamed("__row", "ROW_B")
    kept = sorted(map(tuple, simhash.keep_one(docs).collect()))
    assert [r[0] for r in kept] == [1, 3] and set(kept) <= set(rows) and simhash.keep_one(docs).columns == docs.columns


def test_repeated_rows_are_joined_once(spark):
    """keep_one on 3,000 copies of a row: no operator makes more than a few rows of each."""
    docs = spark.createDataFrame([(1, "one text of it", "en", "a")] * 3000 + [(2, "quite another one here", "en", "a")],
                                 "doc_id long, text string, lang string, source string").repartition(4)
    kept = simhash.keep_one(docs)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2]

    def rows(node):
        metrics = node.metrics()
        own = [metrics.apply("numOutputRows").value()] if metrics.contains("numOutputRows") else []
        for part in ("executedPlan", "plan"):
            if node.nodeName() in ("AdaptiveSparkPlan",) and part == "executedPlan" or part == "plan" and "QueryStage" in node.nodeName():
                own += rows(getattr(node, part)())
        kids = node.children()
        return own + [x for k in range(kids.size()) for x in rows(kids.apply(k))]
    plan = kept._jdf.queryExecution().executedPlan()
    kept._jdf.collectToPython()
    assert 0 < max(rows(plan)) <= 3 * 3001


def test_frequent_prefixes_are_found_over_many_small_slices(spark):
    """A prefix of a share of all suffixes is in the table however the rows are dealt; none under half the share is."""
    from pyspark.sql import functions as F
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(
        F.when(F.col("id") % 4 == 0, F.lit("often used words ")).otherwise(F.concat(F.lit("r"), F.col("id").cast("string"), F.lit(" "))),
        F.array_join(F.transform(F.sequence(F.lit(1), F.lit(16)), lambda k: F.concat(F.lit("w"), F.col("id").cast("string"), F.lit("x"), k.cast("string"))), " ")).alias("text"))
    whole = substrings.prefix_table(docs.coalesce(1), 13, 0.02)
    for parts in (3, 200):
        assert {k: v.tolist() for k, v in substrings.prefix_table(docs.repartition(parts), 13, 0.02).items()} == {k: v.tolist() for k, v in whole.items()}
    assert len(whole[3]) == 1 and substrings.prefix_table(docs, 13, 1.5) == {}
