"""Approximate nearest neighbours by cross-polytope hashing.

Largest inner product becomes largest cosine by one more coordinate: a vector x gets
sqrt(M^2 - |x|^2), with M the largest norm in the table, a query gets 0. Vectors are padded to a
power of two and turned by three rounds of random signs and a fast Hadamard transform; a table's
bucket is the signed axis nearest to the turned vector. A query probes, in every table, the
``probes`` axes nearest to it. In a bucket, all probing queries meet all its vectors exactly (inner
products of the original vectors, in double precision) and each query keeps its best ``k`` there;
the best ``k`` over all its buckets are the answer, so nothing is cut before the exact ranking.

A bucket that holds very many vectors or queries is cut into a grid of vector chunks times query
slices, each a task of its own (bucket counts: at most tables x 2 x dimensions rows, broadcast).
Equal vectors of a chunk are ranked once: only the k + 1 smallest ids of one vector can be among
anyone's best k.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkwright.llm.common import bound_batches, materialise

#: Vectors and queries that one task holds; entries of a block of inner products.
CHUNK, SLICE, BLOCK = 20_000, 20_000, 2_000_000


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows, scaled to keep lengths."""
    rows, n = x.shape
    step = 1
    while step < n:
        x = x.reshape(rows, n // (2 * step), 2, step)
        x = np.stack((x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]), axis=2).reshape(rows, n)
        step *= 2
    return x / np.sqrt(n)


def turned(x: np.ndarray, table: int, seed: int) -> np.ndarray:
    signs = np.random.default_rng([seed, table]).choice([-1.0, 1.0], size=(3, x.shape[1]))
    for s in signs:
        x = hadamard(x * s)
    return x


def axes(x: np.ndarray, n: int) -> np.ndarray:
    """The n nearest signed axes of each row, nearest first: 2 * axis, plus one if negative."""
    both = np.stack((x, -x), axis=2).reshape(len(x), -1)
    n = min(n, both.shape[1])
    return np.argsort(-both, axis=1, kind="stable")[:, :n]


def usable(vector: Column) -> Column:
    """Not null, all components finite and not null, some component not zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column, dims: int) -> np.ndarray:
    """Rows of a list column as doubles; shorter vectors count as padded by zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = np.asarray(column.value_lengths()).astype(np.int64)
    flat = np.asarray(column.flatten()).astype(np.float64)
    if len(size) and (size == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(size), dims))
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def _hash(batches: Iterator[pa.RecordBatch], dims: int, most_norm: float, tables: int, probes: int,
          seed: int) -> Iterator[pa.RecordBatch]:
    wide = 1 << int(dims).bit_length()  # a power of two above dims: room for the added coordinate
    for big in batches:
        for at in range(0, big.num_rows, 4096):
            b = big.slice(at, 4096)
            ids, query = b.column(0), np.asarray(b.column(2))
            x = _matrix(b.column(1), dims)
            norm = np.sqrt((x * x).sum(axis=1))
            base = np.zeros((len(x), wide))
            base[:, :dims] = x / most_norm
            base[:, dims] = np.sqrt(np.maximum(0, 1 - (norm / most_norm) ** 2))
            asked = np.flatnonzero(query)
            flat = base[asked].copy()
            flat[:, dims] = 0
            for t in range(tables):
                own = axes(turned(base, t, seed), 1)[:, 0]
                probe = axes(turned(flat, t, seed), probes)
                row = np.r_[np.arange(len(x)), np.repeat(asked, probe.shape[1])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(row), t, np.int32)),
                     pa.array(np.r_[own, probe.ravel()].astype(np.int32)),
                     pa.array(np.arange(len(row)) >= len(x)),
                     ids.take(pa.array(row)), b.column(1).take(pa.array(row))],
                    ["table", "bucket", "asks", "vec_id", "vector"])


def _best(rows: pa.Table, dims: int, k: int) -> pa.Table:
    """Each query's best k of one chunk: by exact inner product, ties to the smaller id."""
    asks = np.asarray(rows.column("asks"))
    ids = rows.column("vec_id").to_numpy()
    q_rows, c_rows = np.flatnonzero(asks), np.flatnonzero(~asks)
    out_q, out_c, out_s = [], [], []
    if len(q_rows) and len(c_rows):
        c_rows = c_rows[np.argsort(ids[c_rows], kind="stable")]
        c = _matrix(rows.column("vector").take(pa.array(c_rows)), dims) + 0.0  # no negative zeros
        raw = np.ascontiguousarray(c).view(np.dtype((np.void, 8 * dims))).ravel()
        _, same = np.unique(raw, return_inverse=True)
        order = np.argsort(same, kind="stable")
        start = np.flatnonzero(np.diff(same[order], prepend=-1))
        place = np.arange(len(c)) - np.repeat(start, np.diff(np.r_[start, len(c)]))
        c_rows_kept = np.sort(order[place <= k])
        c, c_id = c[c_rows_kept], ids[c_rows][c_rows_kept]
        q_all = _matrix(rows.column("vector").take(pa.array(q_rows)), dims)
        step = max(1, BLOCK // len(c))
        for at in range(0, len(q_rows), step):
            q, q_id = q_all[at:at + step], ids[q_rows[at:at + step]]
            score = q @ c.T
            score[c_id == q_id[:, None]] = -np.inf
            slack = 1e-9 * np.abs(score[np.isfinite(score)]).max(initial=1.0)
            for i in range(len(q)):
                s = score[i]
                near = (np.flatnonzero(s >= np.partition(s, len(s) - k)[len(s) - k] - slack)
                        if len(s) > k else np.arange(len(s)))
                near = near[np.isfinite(s[near])]
                exact = (c[near] * q[i]).sum(axis=1)  # the same sum for equal vectors
                top = np.lexsort((c_id[near], -exact))[:k]
                out_q.append(np.full(len(top), q_id[i]))
                out_c.append(c_id[near][top])
                out_s.append(exact[top])
    join = lambda x, t: np.concatenate(x).astype(t) if x else np.empty(0, t)
    return pa.table({"query_id": join(out_q, np.int64), "vec_id": join(out_c, np.int64),
                     "score": join(out_s, np.float64)})


def _find(rows: DataFrame, dims: int, norm: float, k: int, tables: int, probes: int, seed: int) -> DataFrame:
    """(query_id, vec_id, score): the best k of every query in each cell of each bucket it probes."""
    element = rows.schema["vector"].dataType.simpleString()
    hashed = rows.select("vec_id", "vector", "query").mapInArrow(
        lambda b: _hash(b, dims, norm, tables, probes, seed),
        f"table int, bucket int, asks boolean, vec_id long, vector {element}")
    sizes = hashed.groupBy("table", "bucket").agg(F.count_if(~F.col("asks")).alias("n"),
                                                  F.count_if("asks").alias("m"))
    grid = sizes.where("n > 0 and m > 0").select(
        "table", "bucket", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks"),
        F.ceil(F.col("m") / SLICE).cast("int").alias("parts"))
    own = F.xxhash64("vec_id")
    dealt = hashed.join(F.broadcast(grid), ["table", "bucket"]).withColumn("cell", F.explode(F.when(
        F.col("asks"), F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda c: F.struct(
            c.alias("chunk"), F.pmod(own, F.col("parts")).cast("int").alias("part"))))
        .otherwise(F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda p: F.struct(
            F.pmod(own, F.col("chunks")).cast("int").alias("chunk"), p.alias("part"))))))
    return dealt.groupBy("table", "bucket", "cell").applyInArrow(
        lambda t: _best(t, dims, k), "query_id long, vec_id long, score double")


def search(vectors: DataFrame, is_query: Column, k: int = 20, tables: int = 12, probes: int = 18,
           seed: int = 1, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank from 1, vec_id, score): for each row where ``is_query``, its k best found
    among all other ids, largest inner product first, ties to the smaller id.

    Vectors that are null, zero or hold a null or non-finite component take no part, nor do null
    ids. Of rows that share an id the smallest vector stands for it. Shorter vectors count as
    padded by zeros. No vectors: no rows. Other columns are left behind.
    """
    bound_batches(vectors.sparkSession)
    rows = (vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"),
                           F.col(f"`{vector_col}`").alias("vector"), is_query.alias("query"))
            .where(F.col("vec_id").isNotNull() & usable(F.col("vector"))))
    rows = rows.groupBy("vec_id").agg(F.min("vector").alias("vector"),
                                      F.max(F.coalesce("query", F.lit(False))).alias("query"))
    rows = materialise(rows, "vectors")
    size = rows.agg(F.max(F.size("vector")).alias("dims"), F.sqrt(F.max(F.aggregate(
        "vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))).alias("norm")).first()
    dims, norm = size.dims or 1, size.norm or 1.0
    element = rows.schema["vector"].dataType.simpleString()
    found = materialise(_find(rows, dims, norm, k, tables, probes, seed), "found")
    # a query that met fewer than k others probes every bucket of one table, which is all vectors
    met = found.groupBy("query_id").agg(F.count_distinct("vec_id").alias("met")).where(F.col("met") >= k)
    short = rows.where("query").join(met, F.col("vec_id") == F.col("query_id"), "left_anti")
    others = (rows.drop("query").join(short.select("vec_id", F.lit(True).alias("query")), "vec_id", "left")
              .withColumn("query", F.coalesce("query", F.lit(False))))
    if not short.isEmpty():
        found = found.union(_find(others, dims, norm, k, 1, 1 << 31, seed))
    # the same pair has the same score in every table
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
