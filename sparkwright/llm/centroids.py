"""Centroid clustering by a bisector tournament over integer vectors.

Every component x becomes floor(256 x), so all arithmetic is exact. For two centroids i < j the
bisector is a plane with an integer normal n = 2 (c_j - c_i) and threshold t = |c_j|^2 - |c_i|^2:
n . v - t is |v - c_i|^2 - |v - c_j|^2, so j is nearer if it is positive, i if it is negative, and
zero favours i, the smaller number. Normals and thresholds of all pairs are computed once per
task. A vector starts with centroid 0 and meets 1, 2, ..., k - 1 in turn; each of the k - 1 sign
tests eliminates one of two, and the survivor's distance is computed exactly.

A round reads the vectors once and returns one row per task, cluster and component: counts and sums,
which Spark adds up; nothing but k x d sums reaches the driver. The vectors are not shuffled.

Range: components up to 2^27 in size (after scaling) use 64-bit integers; vectors with larger ones
use Python's integers. Sums travel in four limbs of 40 bits, so they are exact as well.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwright.llm.common import bound_batches

SCALE, SMALL = 256, 1 << 27
#: Bits of a limb and limbs of a sum; rows of a tournament at a time; largest long.
LIMB, LIMBS, CHUNK, MOST = 40, 4, 4096, 2**63 - 1


def kept(batch: pa.RecordBatch, size: int) -> tuple[pa.Array, np.ndarray]:
    """(ids, vectors as doubles) of the rows whose vector has ``size`` components, all finite."""
    ids, lists = batch.column(0), batch.column(1)
    rows = np.flatnonzero(np.asarray(lists.value_lengths().fill_null(-1)) == size)
    x = lists.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
    with np.errstate(invalid="ignore"):
        fine = np.all(np.abs(x) < 2.0**128, axis=1)  # false for nulls (read as NaN), NaN and infinity
    return ids.take(pa.array(rows[fine])), x[fine]


def scaled(x: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, floor(256 x)): 64-bit integers of the small vectors, then Python integers of the rest."""
    y = x * SCALE  # exact: a power of two
    small = np.all(np.abs(y) < SMALL, axis=1)
    for rows, kind in ((np.flatnonzero(small), np.int64), (np.flatnonzero(~small), object)):
        if len(rows):
            z = np.floor(y[rows])
            yield rows, z.astype(np.int64) if kind is np.int64 else np.array(
                [[int(v) for v in row] for row in z], dtype=object)


class Bisectors:
    """Normals and thresholds of all pairs of centroids (lists of Python integers)."""

    def __init__(self, centroids: list[list[int]]):
        big = max((abs(v) for c in centroids for v in c), default=0) >= SMALL
        self.centroids = np.array(centroids, dtype=object if big else np.int64)
        norms = (self.centroids * self.centroids).sum(axis=1)
        self.normals = 2 * (self.centroids[None, :, :] - self.centroids[:, None, :])
        self.thresholds = norms[None, :] - norms[:, None]

    def nearest(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, squared distance) for every row of integers."""
        number, distance = np.zeros(len(v), dtype=np.int64), np.zeros(len(v), dtype=v.dtype)
        for at in range(0, len(v), CHUNK):
            part = v[at:at + CHUNK]
            best = np.zeros(len(part), dtype=np.int64)
            for j in range(1, len(self.centroids)):
                side = (self.normals[best, j] * part).sum(axis=1) - self.thresholds[best, j]
                best[side > 0] = j
            off = part - self.centroids[best]
            number[at:at + CHUNK], distance[at:at + CHUNK] = best, (off * off).sum(axis=1)
        return number, distance


def start(vectors: DataFrame, k: int, size: int, seed: str) -> list[list[int]]:
    """The k kept vectors with smallest SHA-256 of seed and id, in that order (ties: by components;
    a null id hashes as the word null)."""
    def run(batches: Iterator[pa.RecordBatch]):
        best: list[tuple[str, list[int]]] = []
        for b in batches:
            ids, x = kept(b, size)
            hashes = [hashlib.sha256(f"{seed}{'null' if i is None else i}".encode()).hexdigest() for i in ids.to_pylist()]
            for rows, v in scaled(x):
                best += [(hashes[r], list(map(int, c))) for r, c in zip(rows, v)]
            best = sorted(best)[:k]
        yield pa.RecordBatch.from_arrays(
            [pa.array([h for h, _ in best], pa.string()), pa.array([",".join(map(str, c)) for _, c in best], pa.string())],
            ["hash", "components"])
    first = vectors.mapInArrow(run, "hash string, components string").orderBy("hash", "components").limit(k).collect()
    return [c for _, c in sorted((r.hash, [int(v) for v in r.components.split(",")]) for r in first)]


def moved(vectors: DataFrame, centroids: list[list[int]], size: int) -> list[list[int]]:
    """One round: the floor of the exact mean of each centroid's vectors; empty ones stay."""
    def run(batches: Iterator[pa.RecordBatch]):
        planes = Bisectors(centroids)
        n, sums = np.zeros(len(centroids), dtype=np.int64), np.zeros((len(centroids), size), dtype=object)
        for b in batches:
            for _, v in scaled(kept(b, size)[1]):
                number, _ = planes.nearest(v)
                for c in np.unique(number):
                    own = v[number == c]
                    n[c] += len(own)
                    sums[c] += own.sum(axis=0).astype(object)
        used = np.flatnonzero(n)
        limbs = [[(int(s) >> LIMB * l) & ((1 << LIMB) - 1) if l < LIMBS - 1 else int(s) >> LIMB * l
                  for c in used for s in sums[c]] for l in range(LIMBS)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(used, size), pa.int32()), pa.array(np.tile(np.arange(size), len(used)), pa.int32()),
             pa.array(np.repeat(n[used], size), pa.int64()), *[pa.array(x, pa.int64()) for x in limbs]],
            ["cluster", "place", "n", *[f"s{l}" for l in range(LIMBS)]])
    parts = vectors.mapInArrow(run, "cluster int, place int, n long, " + ", ".join(f"s{l} long" for l in range(LIMBS)))
    out = [list(c) for c in centroids]
    for r in parts.groupBy("cluster", "place").agg(F.sum("n").alias("n"), *[
            F.sum(f"s{l}").alias(f"s{l}") for l in range(LIMBS)]).collect():  # k x size rows
        out[r.cluster][r.place] = sum(r[f"s{l}"] << LIMB * l for l in range(LIMBS)) // r.n
    return out


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, size: int = 64, seed: str = "2:",
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept vector.

    Kept are vectors of exactly ``size`` components, none null, NaN, infinite or of 2^128 or more. k vectors start
    as centroids 0, 1, ... (:func:`start`; all of them, if fewer are kept); each of ``rounds`` rounds assigns
    every vector to the nearest (squared Euclidean distance, ties to the smaller number) and moves every
    non-empty centroid to the floor of its vectors' mean; a last assignment follows. Repeated rows count
    as often as they occur; a null id stays null. A distance or inertia above the largest long is given as
    that (components above 2^27 only). No kept vector: no rows. Other columns are left behind.
    """
    bound_batches(vectors.sparkSession)
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").alias("vector"))
    centroids = start(rows, k, size, seed)
    if not centroids:
        return vectors.sparkSession.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, "
                                                        "inertia long, centroid_sha256 string")
    for _ in range(rounds):
        centroids = moved(rows, centroids, size)

    def run(batches: Iterator[pa.RecordBatch]):
        planes = Bisectors(centroids)
        for b in batches:
            ids, x = kept(b, size)
            for part, v in scaled(x):
                number, distance = planes.nearest(v)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(part)), pa.array(number, pa.int32()),
                     pa.array([min(int(d), MOST) for d in distance], pa.int64())], ["vec_id", "cluster", "distance"])
    placed = rows.mapInArrow(run, "vec_id long, cluster int, distance long")
    sums = placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()  # k rows
    own = {r.cluster: int(r.s) for r in sums}
    facts = vectors.sparkSession.createDataFrame(
        [(c, min(own.get(c, 0), MOST), min(sum(own.values()), MOST),
          hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for c in range(len(centroids))],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle_sql(k: int = 40, rounds: int = 5, size: int = 64, seed: str = "2:") -> str:
    """The query op13 in DuckDB's SQL: distances as sums over (vector, centroid, place)."""
    parts = [f"""
x AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, embedding FROM embeddings WHERE len(embedding) = {size}
    AND len(list_filter(embedding, lambda v: v IS NOT NULL AND isfinite(v))) = {size}),
v AS MATERIALIZED (SELECT rid, place, floor({SCALE} * embedding[place]::double)::bigint AS v
    FROM x, range(1, {size + 1}) p(place)),
c0 AS MATERIALIZED (SELECT number, place, v AS c FROM (SELECT rid, row_number() OVER (
    ORDER BY sha256('{seed}' || vec_id::varchar)) - 1 AS number FROM x) JOIN v USING (rid) WHERE number < {k})"""]
    for r in range(rounds + 1):
        parts.append(f"""
d{r} AS (SELECT rid, number, sum((v - c) * (v - c))::bigint AS d FROM v JOIN c{r} USING (place) GROUP BY rid, number),
a{r} AS MATERIALIZED (SELECT rid, min(d) AS d, min_by(number, (d, number)) AS number FROM d{r} GROUP BY rid)""")
        if r < rounds:
            parts.append(f"""
c{r + 1} AS MATERIALIZED (SELECT number, place, coalesce(m, c) AS c FROM c{r} LEFT JOIN (
    SELECT number, place, (sum(v) - ((sum(v) % count(*)) + count(*)) % count(*)) // count(*) AS m
    FROM v JOIN a{r} USING (rid) GROUP BY number, place) USING (number, place))""")
    return f"""WITH {",".join(parts)}
SELECT vec_id, number::int AS cluster, d AS distance, sum(d) OVER (PARTITION BY number)::bigint AS cluster_inertia,
       sum(d) OVER ()::bigint AS inertia, digest AS centroid_sha256
FROM a{rounds} JOIN x USING (rid) JOIN (SELECT number, sha256(string_agg(c::bigint::varchar, ',' ORDER BY place)) AS digest
     FROM c{rounds} GROUP BY number) USING (number)"""
