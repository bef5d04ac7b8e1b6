"""Graph operators: adjacency parsing, degree, breadth-first search."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwright.session import copies, shared_path, write_shared

#: Edges of a node beyond which it is dealt over several buckets.
HUB = 100_000


def parse_adjacency(lines: DataFrame, col: str = "value") -> DataFrame:
    """Whitespace adjacency lines 'id n1 n2 ...' to (src, dst) edge rows.

    An id may appear on several lines; each line adds its neighbours.
    Lines without a parsable id are dropped.
    """
    toks = F.split(F.trim(F.col(col)), r"\s+")
    rows = lines.select(F.element_at(toks, 1).try_cast("bigint").alias("src"),
                        F.slice(toks, 2, F.greatest(F.size(toks) - 1, F.lit(0))).alias("nbrs"))
    return rows.filter(F.col("src").isNotNull()) \
        .select("src", F.explode("nbrs").alias("dst")) \
        .select("src", F.col("dst").try_cast("bigint").alias("dst")).filter(F.col("dst").isNotNull())


def undirected(edges: DataFrame) -> DataFrame:
    """Both directions of every edge."""
    return edges.select("src", "dst").unionByName(
        edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))


def degree(edges: DataFrame, name: str = "degree") -> DataFrame:
    """Number of neighbour entries per node (G2); partial counts per task."""
    return edges.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias(name))


class SearchTables:
    """The tables of one breadth-first search, written under the checkpoint folder.

    ``edges`` (src, part, dst) is bucketed by (src, part) and written once; a node with more than ``HUB`` edges has
    several parts, so no bucket holds a hub whole. ``visited`` (id, distance) is bucketed by id and
    partitioned by distance; a round appends its level. Both have as many buckets as a shuffle has partitions, so
    neither is exchanged again.
    """

    def __init__(self, edges: DataFrame, start):
        self.spark = spark = edges.sparkSession
        self.n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.names = {k: f"sparkwright_{k}_{uuid.uuid4().hex}" for k in ("edges", "visited")}
        self.paths = {k: shared_path(spark, k) for k in self.names}
        e = write_shared(edges.select(F.col("src").cast("bigint").alias("src"), F.col("dst").cast("bigint").alias("dst"))
                         .dropna().distinct(), "distinct-edges")
        self.hubs = write_shared(e.groupBy("src").agg(F.ceil(F.count(F.lit(1)) / HUB).cast("int").alias("parts"))
                                 .where("parts > 1"), "hubs")
        part = F.pmod(F.xxhash64("dst"), F.coalesce("parts", F.lit(1)).cast("bigint")).cast("int")
        e = e.join(self.hubs, "src", "left").select("src", part.alias("part"), "dst").repartition(self.n, "src", "part")
        self._save(e, "edges", "src", "part")
        first = spark.range(1).select(F.lit(start).cast("bigint").alias("id"), F.lit(0).alias("distance"))
        self._save(first, "visited", "id")

    def _save(self, df: DataFrame, name: str, *by: str) -> None:
        writer = df.write.format("parquet").mode("append").option("path", self.paths[name]).bucketBy(self.n, *by)
        if name == "visited":
            writer = writer.partitionBy("distance")
        writer.saveAsTable(self.names[name])

    def visited(self) -> DataFrame:
        return self.spark.table(self.names["visited"]).select("id", "distance")

    def level(self, distance: int) -> DataFrame:
        return self.visited().where(F.col("distance") == distance)

    def neighbours(self, distance: int) -> DataFrame:
        """Nodes first reached from the level ``distance``. What is exchanged is the level (to the edges' buckets,
        once per part of a hub) and its neighbours (to the buckets of ``visited``)."""
        front = self.level(distance).select(F.col("id").alias("src")).join(self.hubs, "src", "left").select(
            "src", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part"))
        return (self.spark.table(self.names["edges"]).join(front, ["src", "part"]).select(F.col("dst").alias("id")).distinct()
                .join(self.visited().select("id"), "id", "left_anti"))

    def advance(self, distance: int) -> None:
        """Write the level after ``distance``."""
        self._save(self.neighbours(distance).withColumn("distance", F.lit(distance + 1)), "visited", "id")

    def close(self) -> None:
        """Forget the tables; the edges' folder goes now, that of ``visited`` with its block."""
        for name in self.names.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        copies.release(self.spark, self.paths["edges"])


def bfs(edges: DataFrame, start, max_iter: int = 10, target=None) -> DataFrame:
    """Breadth-first distances from ``start`` (G1): (id, distance) for every
    node reached within ``max_iter`` rounds; stops early on an empty frontier
    or once ``target`` is reached. Edges with a null end are left out.

    The edges are written once as a bucketed table, and so are the visited nodes, one level per round
    (:class:`SearchTables`): a round exchanges its frontier and the frontier's neighbours, never the edges or
    the visited nodes. Every level is in the shared folder, so a lost executor costs the current round.
    """
    tables = SearchTables(edges, start)
    try:
        for d in range(0 if target is not None and start == target else max_iter):
            tables.advance(d)
            # one small job per round: size of the new level and whether the target is in it
            hit = F.max((F.col("id") == F.lit(target)).cast("int")) if target is not None else F.lit(0)
            new = tables.level(d + 1).agg(F.count(F.lit(1)).alias("n"), hit.alias("hit")).first()
            if new["n"] == 0 or (new["hit"] or 0) > 0:
                break
        # by path: the table's name is dropped, its files stay with the block
        return tables.spark.read.schema("id bigint, distance int").parquet(tables.paths["visited"])
    finally:
        tables.close()


def hit_count(edges: DataFrame, distances: DataFrame, target) -> DataFrame:
    """How many edges from the previous level point at ``target`` (G1 hit count)."""
    dt = distances.filter(F.col("id") == target).select("id", "distance")
    found = dt.first()  # one row, or none if the target was not reached
    level = found["distance"] - 1 if found else -1
    prev = distances.filter(F.col("distance") == level).select(F.col("id").alias("src"))
    hits = edges.filter(F.col("dst") == target).join(prev, "src") \
        .groupBy(F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("hits"))
    return dt.join(hits, "id", "left").select("id", "distance",
                                              F.coalesce("hits", F.lit(0)).alias("hits"))
