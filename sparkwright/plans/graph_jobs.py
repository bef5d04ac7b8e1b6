"""Graph and similarity jobs.

Stand-ins: the graph -> every line item links its part and its supplier (both
directions; a supplier's node id is -1 minus its key); names -> p_name and s_name.
Ratings -> (user = o_custkey, item = l_suppkey, rating = mean l_quantity of
that customer's lines from that supplier).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkwright.functions import scalar
from sparkwright.operators import agg, graph, joins, similarity, topk
from sparkwright.sources.tables import table

START_NODE = 1
TARGET_NODE = 14
MAX_ROUNDS = 10
SIM_TARGET = 1
MIN_SCORE = 0.8
MIN_STRENGTH = 50
MIN_PAIR_SCORE = 0.5
MIN_PAIR_STRENGTH = 1
TOP_K = 10


def order_graph(spark, root):
    li = table(spark, root, "lineitem")
    return graph.undirected(li.select(F.col("l_partkey").alias("src"), (-1 - F.col("l_suppkey")).alias("dst")))


def node_names(spark, root):
    part = table(spark, root, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    supp = table(spark, root, "supplier").select((-1 - F.col("s_suppkey")).alias("id"), F.col("s_name").alias("name"))
    return part.unionByName(supp)


def ratings(spark, root):
    li = table(spark, root, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity")
    o = table(spark, root, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return li.join(o, "l_orderkey").groupBy("o_custkey", "l_suppkey") \
        .agg(F.avg("l_quantity").alias("rating"))


def node_degree(spark, root):
    """Number of neighbour entries of every node (connections over all its lines)."""
    return graph.degree(order_graph(spark, root))


def most_connected(spark, root):
    """The node with most connections (ties to the larger id), with its name."""
    d = graph.degree(order_graph(spark, root))
    best = agg.max_row(d, ["degree", "id"])
    return joins.with_names(best, node_names(spark, root), "id", "name", missing="error", small_left=True) \
        .select("id", "name", "degree")


def top10_connected(spark, root):
    """Ten most connected nodes, ranked, with names (one join for all ten)."""
    d = graph.degree(order_graph(spark, root))
    best = topk.top_k(d, ["degree"], TOP_K, tie_break=["id"])
    named = joins.with_names(best, node_names(spark, root), "id", "name", missing="error", small_left=True)
    return topk.with_rank(named, [F.col("degree").desc(), F.col("id")], "rank") \
        .select(F.col("rank").cast("bigint").alias("rank"), "id", "name", "degree")


def degrees_of_separation(spark, root):
    """Breadth-first distance of every node reachable from the start within 10 rounds."""
    return graph.bfs(order_graph(spark, root), START_NODE, MAX_ROUNDS)


def degrees_hit(spark, root):
    """Distance to the target and how many edges from the previous level hit it."""
    e = order_graph(spark, root)
    d = graph.bfs(e, START_NODE, MAX_ROUNDS, target=TARGET_NODE)
    return graph.hit_count(e, d, TARGET_NODE)


def item_similarity(spark, root):
    """Cosine similarity and strength of the item pairs above the thresholds."""
    s = similarity.cosine_pairs(ratings(spark, root), "o_custkey", "l_suppkey", "rating",
                                min_score=MIN_PAIR_SCORE, min_strength=MIN_PAIR_STRENGTH)
    return s.select("item_a", "item_b", scalar.round_half_away("score", 6).alias("score"), "strength")


def similar_pairs(spark, root):
    """Item pairs above score and strength, from a join that leaves out the users with most ratings, with names."""
    s = similarity.similar_pairs(ratings(spark, root), "o_custkey", "l_suppkey", "rating", MIN_SCORE, MIN_STRENGTH)
    names = table(spark, root, "supplier").select(F.col("s_suppkey").alias("item_a"), F.col("s_name").alias("name_a"))
    s = joins.with_names(s, names, "item_a", "name_a", missing="error")
    s = joins.with_names(s, names.toDF("item_b", "name_b"), "item_b", "name_b", missing="error")
    return s.select("item_a", "name_a", "item_b", "name_b", scalar.round_half_away("score", 6).alias("score"), "strength")


def similar_pairs_report(spark, root):
    """How many pairs the plain join would form, how many are formed, completed and above the strength."""
    return similarity.PrunedPairs(ratings(spark, root), "o_custkey", "l_suppkey", "rating", MIN_STRENGTH).report()


def similar_to_item(spark, root):
    """Top items similar to one item, above score and strength thresholds, ranked, with names."""
    s = similarity.similar_to(ratings(spark, root), "o_custkey", "l_suppkey", "rating",
                              SIM_TARGET, MIN_SCORE, MIN_STRENGTH, TOP_K)
    names = table(spark, root, "supplier").select(F.col("s_suppkey").alias("other"), F.col("s_name").alias("name"))
    named = joins.with_names(s, names, "other", "name", missing="error", small_left=True)
    return topk.with_rank(named, [F.col("score").desc(), F.col("strength").desc(), F.col("other")], "rank").select(
        F.col("rank").cast("bigint").alias("rank"), "other", "name",
        scalar.round_half_away("score", 6).alias("score"), "strength")


JOBS = {
    "node_degree": node_degree,
    "most_connected": most_connected,
    "top10_connected": top10_connected,
    "degrees_of_separation": degrees_of_separation,
    "degrees_hit": degrees_hit,
    "item_similarity": item_similarity,
    "similar_pairs": similar_pairs,
    "similar_pairs_report": similar_pairs_report,
    "similar_to_item": similar_to_item,
}

_EDGES = """edges AS (
    SELECT l_partkey AS src, -1 - l_suppkey AS dst FROM lineitem UNION ALL SELECT -1 - l_suppkey, l_partkey FROM lineitem),
    names AS (SELECT p_partkey AS id, p_name AS name FROM part UNION ALL SELECT -1 - s_suppkey, s_name FROM supplier)"""
_DEG = f"WITH {_EDGES}, deg AS (SELECT src AS id, count(*) AS degree FROM edges GROUP BY src)"
_BFS = f"""WITH RECURSIVE {_EDGES},
    bfs(id, d) AS (SELECT CAST({START_NODE} AS BIGINT), 0
                   UNION SELECT e.dst, b.d + 1 FROM bfs b JOIN edges e ON e.src = b.id
                   WHERE b.d < {MAX_ROUNDS}),
    dist AS (SELECT id, min(d) AS distance FROM bfs GROUP BY id)"""
_RATINGS = """r AS (SELECT o_custkey AS u, l_suppkey AS i, avg(l_quantity) AS x
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)"""
_SCORE = ("CASE WHEN sqrt(sum(x * x)) * sqrt(sum(y * y)) <> 0 "
          "THEN sum(x * y) / (sqrt(sum(x * x)) * sqrt(sum(y * y))) ELSE 0 END")
_PAIR_SCORE = ("CASE WHEN sqrt(sum(a.x * a.x)) * sqrt(sum(b.x * b.x)) <> 0 "
               "THEN sum(a.x * b.x) / (sqrt(sum(a.x * a.x)) * sqrt(sum(b.x * b.x))) ELSE 0 END")

ORACLE = {
    "node_degree": f"{_DEG} SELECT id, degree FROM deg",
    "most_connected": f"""{_DEG}
        SELECT d.id, p.name, d.degree FROM deg d JOIN names p ON p.id = d.id
        ORDER BY d.degree DESC, d.id DESC LIMIT 1""",
    "top10_connected": f"""{_DEG}
        SELECT row_number() OVER (ORDER BY d.degree DESC, d.id) AS rank, d.id, p.name, d.degree
        FROM (SELECT * FROM deg ORDER BY degree DESC, id LIMIT {TOP_K}) d
        JOIN names p ON p.id = d.id""",
    "degrees_of_separation": f"{_BFS} SELECT id, distance FROM dist",
    "degrees_hit": f"""{_BFS}
        SELECT t.id, t.distance, CAST((SELECT count(*) FROM edges e JOIN dist p ON p.id = e.src
               WHERE e.dst = {TARGET_NODE} AND p.distance = t.distance - 1) AS BIGINT) AS hits
        FROM dist t WHERE t.id = {TARGET_NODE}""",
    "item_similarity": f"""WITH {_RATINGS},
        p AS (SELECT a.i AS item_a, b.i AS item_b, a.x AS x, b.x AS y FROM r a JOIN r b
              ON a.u = b.u AND a.i < b.i)
        SELECT item_a, item_b, round({_SCORE}, 6) AS score, count(*) AS strength
        FROM p GROUP BY 1, 2 HAVING {_SCORE} > {MIN_PAIR_SCORE} AND count(*) > {MIN_PAIR_STRENGTH}""",
    "similar_pairs": f"""WITH {_RATINGS},
        p AS (SELECT a.i AS item_a, b.i AS item_b, {_PAIR_SCORE} AS score, count(*) AS strength
              FROM r a JOIN r b ON a.u = b.u AND a.i < b.i GROUP BY 1, 2)
        SELECT item_a, n.s_name AS name_a, item_b, o.s_name AS name_b, round(score, 6) AS score, strength
        FROM p JOIN supplier n ON n.s_suppkey = item_a JOIN supplier o ON o.s_suppkey = item_b
        WHERE score > {MIN_SCORE} AND strength > {MIN_STRENGTH}""",
    "similar_pairs_report": f"""WITH {_RATINGS},
        e AS (SELECT * FROM r WHERE i IN (SELECT i FROM r GROUP BY i HAVING count(*) > {MIN_STRENGTH})),
        d AS (SELECT u, count(*) AS d, row_number() OVER (ORDER BY count(*) DESC, u) <= {MIN_STRENGTH} AS heavy FROM e GROUP BY u),
        p AS (SELECT a.i AS i, b.i AS j, count(*) AS n, count(*) FILTER (NOT heavy) AS light
              FROM e a JOIN e b ON a.u = b.u AND a.i < b.i JOIN d ON d.u = a.u GROUP BY 1, 2),
        h AS (SELECT i, count(*) FILTER (heavy) AS h FROM e JOIN d USING (u) GROUP BY i)
        SELECT (SELECT CAST(sum(c * (c - 1) // 2) AS BIGINT) FROM (SELECT count(*) AS c FROM r GROUP BY u)) AS pairs_of_all,
          (SELECT CAST(coalesce(sum(d * (d - 1) // 2), 0) AS BIGINT) FROM d WHERE NOT heavy) AS pairs_formed,
          (SELECT count(*) FROM p JOIN h a ON a.i = p.i JOIN h b ON b.i = p.j WHERE light > 0 AND light + least(a.h, b.h) > {MIN_STRENGTH}) AS pairs_open,
          (SELECT count(*) FROM p WHERE n > {MIN_STRENGTH}) AS pairs_strong""",
    "similar_to_item": f"""WITH {_RATINGS},
        p AS (SELECT b.i AS other, a.x AS x, b.x AS y FROM r a JOIN r b
              ON a.u = b.u AND a.i = {SIM_TARGET} AND b.i <> {SIM_TARGET}),
        s AS (SELECT other, {_SCORE} AS score, count(*) AS strength FROM p GROUP BY 1)
        SELECT row_number() OVER (ORDER BY score DESC, strength DESC, other) AS rank, other, s_name AS name,
               round(score, 6) AS score, strength FROM s JOIN supplier ON s_suppkey = other
        WHERE score > {MIN_SCORE} AND strength > {MIN_STRENGTH} ORDER BY rank LIMIT {TOP_K}""",
}
