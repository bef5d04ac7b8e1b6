import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sparkwright.operators import graph, similarity
from sparkwright.plans import graph_jobs
from tests.conftest import SF01


def test_bfs_level_counts_match_probe(spark):
    d = graph.bfs(graph_jobs.order_graph(spark, SF01), 1, 10)
    counts = dict(Counter(r["distance"] for r in d.collect()))
    assert [counts[k] for k in sorted(counts)] == [1, 27, 1999, 73]


def test_bfs_distance_differs_by_at_most_one_along_edges(spark):
    e = graph_jobs.order_graph(spark, SF01)
    d = graph.bfs(e, 1, 10)
    j = (e.join(d.select(F.col("id").alias("src"), F.col("distance").alias("ds")), "src")
          .join(d.select(F.col("id").alias("dst"), F.col("distance").alias("dd")), "dst"))
    assert j.filter(F.abs(F.col("ds") - F.col("dd")) > 1).count() == 0


def _brute_bfs(edges, start, rounds):
    near = defaultdict(set)
    for a, b in edges:
        near[a].add(b)
    seen, front = {start: 0}, {start}
    for d in range(1, rounds + 1):
        front = {b for a in front for b in near[a]} - set(seen)
        seen |= dict.fromkeys(front, d)
    return seen


def test_bfs_directed_with_hubs_loops_and_repeats(spark, monkeypatch):
    monkeypatch.setattr(graph, "HUB", 7)  # most nodes lie in several buckets
    rnd = random.Random(5)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(500)] + [(0, k) for k in range(1, 120)] + [(4, 4), (0, 1)]
    df = spark.createDataFrame(edges + [(None, 3), (3, None)], "src long, dst long")
    for start, rounds in ((0, 10), (17, 3), (999, 4), (5, 0)):
        got = {r["id"]: r["distance"] for r in graph.bfs(df, start, rounds).collect()}
        assert got == _brute_bfs(edges, start, rounds)
    to_target = {r["id"]: r["distance"] for r in graph.bfs(df, 0, 10, target=0).collect()}
    assert to_target == {0: 0}


def _scans(node, table, exchanged=False):
    """For every scan of ``table`` in a plan, whether it is exchanged on the way to its join."""
    name = node.nodeName()
    exchanged = "Join" not in name and (exchanged or name.startswith(("Exchange", "BroadcastExchange")))
    below = [x for k in range(node.children().size()) for x in _scans(node.children().apply(k), table, exchanged)]
    return below + [exchanged] * (node.children().isEmpty() and table in node.toString())


def test_bfs_rounds_exchange_neither_edges_nor_visited(spark):
    df = spark.range(5000).select((F.col("id") % 700).alias("src"), F.col("id").alias("dst"))
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    tables = graph.SearchTables(df, 1)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        tables.advance(0)
        plan = tables.neighbours(1)._jdf.queryExecution().executedPlan()
        text = plan.toString()
        assert text.count("Scan parquet") >= 4 and tables.names["edges"] in text
        # edges and visited nodes (as the frontier, looked up among the hubs, and as what is left out) are joined where they lie
        assert _scans(plan, tables.names["edges"]) == [False]
        assert _scans(plan, tables.names["visited"]) == [False, False]
        assert text.count("SortMergeJoin") == 3
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
        tables.close()


def test_copies_go_with_their_last_holder(spark):
    import os

    from sparkwright import session
    folder = session.ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    with session.copies.scope(spark):
        n = graph.bfs(graph_jobs.order_graph(spark, SF01), 1, 3).count()
        assert n > 1 and set(os.listdir(folder)) - before
    assert set(os.listdir(folder)) == before
    with pytest.raises(ZeroDivisionError), session.copies.scope(spark):  # also on failure
        session.write_shared(spark.range(3), "x")
        1 / 0
    assert set(os.listdir(folder)) == before
    with session.copies.scope(spark):  # a second reader keeps it
        df = session.write_shared(spark.range(3), "x")
        path, = session.copies.blocks[-1]
        session.copies.hold(path)
    assert df.count() == 3
    session.copies.release(spark, path)
    assert set(os.listdir(folder)) == before


def test_parse_adjacency_multiline_and_bad_lines(spark):
    lines = spark.createDataFrame([("1 2 3",), ("2 1",), ("1 4",), ("x y",), ("5",)], "value string")
    e = sorted(tuple(r) for r in graph.parse_adjacency(lines).collect())
    assert e == [(1, 2), (1, 3), (1, 4), (2, 1)]
    deg = {r["id"]: r["degree"] for r in graph.degree(graph.parse_adjacency(lines)).collect()}
    assert deg == {1: 3, 2: 1}


def _brute(rows):
    by_user = defaultdict(dict)
    for u, i, x in rows:
        by_user[u][i] = x
    acc = defaultdict(lambda: [0.0, 0.0, 0.0, 0])
    for items in by_user.values():
        for a in items:
            for b in items:
                if a < b:
                    s = acc[(a, b)]
                    s[0] += items[a] * items[b]
                    s[1] += items[a] ** 2
                    s[2] += items[b] ** 2
                    s[3] += 1
    out = {}
    for k, (xy, xx, yy, n) in acc.items():
        den = math.sqrt(xx) * math.sqrt(yy)
        out[k] = (round(xy / den if den else 0.0, 9), n)
    return out


def test_cosine_pairs_blocked_matches_brute_force(spark):
    rnd = random.Random(11)
    rows = set()
    for i in range(60):                       # a hot user rating every item
        rows.add((0, i))
    for _ in range(700):
        rows.add((rnd.randint(1, 80), rnd.randint(0, 59)))
    data = [(u, i, float(rnd.randint(0, 5))) for u, i in sorted(rows)]
    df = spark.createDataFrame(data, "u long, i long, r double")
    got = {(r["item_a"], r["item_b"]): (round(r["score"], 9), r["strength"])
           for r in similarity.cosine_pairs(df, "u", "i", "r").collect()}
    assert got == _brute(data)


def test_similar_to_matches_pairs(spark):
    r = graph_jobs.ratings(spark, SF01)
    pairs = similarity.cosine_pairs(r, "o_custkey", "l_suppkey", "rating")
    t = 7
    exp = (pairs.filter((F.col("item_a") == t) | (F.col("item_b") == t))
           .select(F.when(F.col("item_a") == t, F.col("item_b")).otherwise(F.col("item_a")).alias("other"),
                   "score", "strength"))
    exp = {row["other"]: (round(row["score"], 9), row["strength"]) for row in exp.collect()}
    got = similarity.similar_to(r, "o_custkey", "l_suppkey", "rating", t, -2.0, 0, k=1000).collect()
    assert {row["other"]: (round(row["score"], 9), row["strength"]) for row in got} == exp


def test_cosine_pairs_slices_heavy_users(spark):
    rnd = random.Random(5)
    rows = {(0, i) for i in range(40)} | {(1, i) for i in range(0, 40, 2)}
    for _ in range(200):
        rows.add((rnd.randint(2, 30), rnd.randint(0, 39)))
    data = [(u, i, float(rnd.randint(1, 5))) for u, i in sorted(rows)]
    df = spark.createDataFrame(data, "u long, i long, r double")
    got = {(r["item_a"], r["item_b"]): (round(r["score"], 9), r["strength"])
           for r in similarity.cosine_pairs(df, "u", "i", "r").collect()}
    assert got == _brute(data)


def test_cosine_pairs_of_string_ids_nulls_and_thresholds(spark):
    rows = [("u1", "x", 1.0), ("u1", "y", 2.0), ("u2", "x", 2.0), ("u2", "y", 4.0), ("u2", "z", 1.0), ("u3", "z", 0.0),
            ("u3", "y", 1.0), (None, "x", 1.0), ("u4", None, 1.0), ("u1", "z", None)]
    df = spark.createDataFrame(rows, "u string, i string, r double")
    got = {(r["item_a"], r["item_b"]): (round(r["score"], 9), r["strength"])
           for r in similarity.cosine_pairs(df, "u", "i", "r").collect()}
    assert got == {("x", "y"): (1.0, 2), ("x", "z"): (1.0, 1), ("y", "z"): (round(4 / 17 ** 0.5, 9), 2)}
    some = similarity.cosine_pairs(df, "u", "i", "r", min_score=0.975, min_strength=1).collect()
    assert [(r["item_a"], r["item_b"]) for r in some] == [("x", "y")]


def _skewed_ratings():
    rnd = random.Random(23)
    rows = {(u, i): float(rnd.randrange(1, 6)) for u in range(5) for i in range(80)}  # five users rate everything
    for u in range(5, 60):
        base = rnd.randrange(0, 70, 10)
        rows |= {(u, base + rnd.randrange(10)): float(rnd.randrange(1, 6)) for _ in range(rnd.randrange(1, 12))}
    return [(f"u{u}", i, x) for (u, i), x in rows.items()]


@pytest.mark.parametrize("grid", [2_000, 3])
@pytest.mark.parametrize("strength", [0, 1, 4, 5, 8, 50])
def test_pruned_pairs_equal_all_pairs(spark, monkeypatch, grid, strength):
    """Thresholds below, at and above the number of users that rate everything; also with every user in a grid."""
    monkeypatch.setattr(similarity, "GRID", grid)
    rows = _skewed_ratings()
    df = spark.createDataFrame(rows + [(None, 1, 2.0), ("u1", None, 1.0), ("u59", 79, None)], "u string, i int, x double").repartition(4)
    want = {k: v for k, v in _brute(rows).items() if v[1] > strength and v[0] > 0.8}
    pruned = similarity.PrunedPairs(df, "u", "i", "x", strength)
    got = {(r["item_a"], r["item_b"]): (round(r["score"], 9), r["strength"]) for r in pruned.pairs(0.8).collect()}
    assert got == want
    report = pruned.report().first()
    assert report["pairs_strong"] == sum(1 for v in _brute(rows).values() if v[1] > strength)
    assert report["pairs_formed"] <= report["pairs_of_all"] and report["pairs_strong"] <= report["pairs_open"]
    if strength >= 5:  # the five users' 15,800 pairs are not formed
        assert report["pairs_formed"] < report["pairs_of_all"] // 10


@pytest.mark.parametrize("kind", ["long", "int", "string"])
def test_pairs_in_many_small_blocks(spark, monkeypatch, kind):
    """Also negative and large ids, users of one part and of many, groups of a few pairs, and blocks that add up."""
    from sparkwright.operators import pair_sums
    monkeypatch.setattr(pair_sums, "BLOCK", 40)
    monkeypatch.setattr(pair_sums, "GROUP", 30)
    monkeypatch.setattr(similarity, "GRID", 7)
    big = 2**31 - 50 if kind == "int" else 2**62
    rows = {(u, (i - 40) * 3 if i < 75 else big + i - 75): x for (u, i), x in {(r[0], r[1]): r[2] for r in _skewed_ratings()}.items()}
    rows = [(u, f"{i:+021d}" if kind == "string" else i, x) for (u, i), x in rows.items()]
    df = spark.createDataFrame(rows, f"u string, i {kind}, x double").repartition(3)
    out = similarity.cosine_pairs(df, "u", "i", "x")
    assert dict(out.dtypes)["item_a"] == df.schema["i"].dataType.simpleString()
    assert {(r["item_a"], r["item_b"]): (round(r["score"], 9), r["strength"]) for r in out.collect()} == _brute(rows)


def test_pairs_of_repeated_ratings_are_those_of_a_join(spark):
    df = spark.createDataFrame([(1, 5, 2.0), (1, 5, 3.0), (1, 6, 1.0)], "u int, i int, x double")
    row, = similarity.cosine_pairs(df, "u", "i", "x").collect()
    assert (row["item_a"], row["item_b"], row["strength"], round(row["score"], 9)) == (5, 6, 2, round(5 / 26 ** 0.5, 9))


def test_pair_sums_travel_packed(spark):
    """No row of a pair is exchanged, and a packed pair of ratings takes a fraction of its 56 bytes."""
    import numpy as np
    import pyarrow as pa

    from sparkwright.operators import pair_sums
    df = spark.createDataFrame([(1, 5, 2.0), (1, 6, 1.0)], "u long, i long, x double")
    for out in (similarity.cosine_pairs(df, "u", "i", "x"), similarity.PrunedPairs(df, "u", "i", "x", 0)._candidates()):
        assert "hashpartitioning(item_a" not in out._jdf.queryExecution().toString()
    rng = np.random.default_rng(4)
    n = 40_000
    user, item = np.divmod(np.unique(rng.integers(0, 1000, n) * 20_000 + rng.integers(0, 20_000, n)), 20_000)
    none = np.zeros(len(user), dtype=np.int32)
    block = pa.table({"_u": user, "_i": item, "_x": rng.integers(1, 51, len(user)).astype(float), "_p": none, "_pa": none, "_pb": none})
    packed = list(pair_sums.block_rows(block, 10))
    found = [pair_sums.unpack(x) for _, x in packed]
    pairs = sum(int(n.sum()) for _, _, n, _ in found)
    assert pairs == sum(int(d) * (int(d) - 1) // 2 for d in np.bincount(user))
    assert all((a < b).all() for a, b, _, _ in found)
    assert sum(len(x) for _, x in packed) < 10 * pairs


def _packed_by_group(tables, groups):
    import pyarrow as pa

    from sparkwright.operators import pair_sums
    sent = defaultdict(list)
    for t in tables:
        for g, p in pair_sums.block_rows(t, groups):
            sent[g].append(p)
    return {g: pa.table({"packed": pa.array(p, pa.binary())}) for g, p in sent.items()}


def test_groups_sum_only_common_pairs_of_items_dealt_over_groups(monkeypatch):
    """Blocks of users that agree and that do not meet in the groups; an item of all users lies in several groups; rows of
    pairs that are not common enough end at their count."""
    import numpy as np
    import pyarrow as pa

    from sparkwright.operators import pair_sums
    rng = np.random.default_rng(8)
    rows = {(u, int(i)): float(rng.integers(1, 9)) for u in range(300) for i in [0, *rng.integers(1, 120, 5)]}
    rows |= {(u, i): float(u % 7 + i) for u in range(300, 330) for i in range(8)}
    tables = []
    for users in (range(150), range(150, 300), range(300, 330)):
        own = [(u, i, x) for (u, i), x in rows.items() if u in users]
        user, item, x = (np.array(c) for c in zip(*own))
        none = np.zeros(len(own), dtype=np.int32)
        tables.append(pa.table({"_u": user, "_i": item, "_x": x, "_s": np.where(item == 0, 6, 1).astype(np.int32), "_p": none, "_pa": none, "_pb": none}))
    want = _brute([(u, i, x) for (u, i), x in rows.items()])
    added, summed = pair_sums.added, []
    monkeypatch.setattr(pair_sums, "added", lambda key, n, numbers: (summed.append(len(key)), added(key, n, numbers))[1])
    for some in (tables, tables[:2]):
        sent = _packed_by_group(some, 12)
        kept = want if some is tables else _brute([(u, i, x) for (u, i), x in rows.items() if u < 300])
        for least in (1, 9, 10_000):
            summed.clear()
            got, groups_of_0 = {}, set()
            for g, packed in sent.items():
                for r in pair_sums.group_sums(packed, least).to_pylist():
                    pair = (r["item_a"], r["item_b"])
                    assert pair not in got
                    got[pair] = (round(r["sxy"] / (math.sqrt(r["sxx"]) * math.sqrt(r["syy"])), 9), r["strength"])
                    if pair[0] == 0:
                        groups_of_0.add(g)
            assert got == {k: v for k, v in kept.items() if v[1] >= least}
            assert least > 9 or len(groups_of_0) > 3
            if some is not tables and least == 9:  # in the first blocks few pairs but those of item 0 are common
                assert sum(summed) < sum(v[1] for v in kept.values()) / 2
            if some is not tables and least == 10_000:
                assert not summed
