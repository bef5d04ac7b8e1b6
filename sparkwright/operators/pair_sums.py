"""Sums over the common users of item pairs, formed in blocks of users and added up in groups of pairs.

A self-join that adds up (item, item) pairs moves a row with two ids and four sums for nearly every pair of
ratings, as few of a task's users rate the same pair, and its hash tables grow with the pairs. Here users are dealt
into blocks of about ``BLOCK`` pairs. A block sends each group of pairs one packed row: of every rating the later ones
of its user, items as differences, numbers as byte planes, a few bytes of a pair instead of 56 (or, if its users agree,
the sums of its pairs). A group of about ``GROUP`` pairs unpacks its rows and counts its pairs by one sort; sums are made of
those alone that are common often enough. The numbers of blocks and groups grow with the pairs, so neither grows itself. A user
with very many ratings is dealt as a grid of cells: the items in parts, every pair of parts a cell; an item in very
many pairs is dealt over several groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkwright.session import write_shared

#: Pairs of ratings formed in a block and added up in a group.
BLOCK, GROUP = 3_000_000, 3_000_000
#: An item with more pairs than this share of a group is dealt over several.
SHARE = 8
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_COLUMNS = ("sxy", "sxx", "syy")


def coded(df: DataFrame, name: str) -> tuple[DataFrame, DataFrame | None]:
    """``df`` with whole numbers in the order of the values in the column, and the table (value, code) if they are not
    the values themselves."""
    if isinstance(df.schema[name].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return df.withColumn(name, F.col(name).cast("long")), None
    values = df.select(F.col(name).alias("value")).distinct().orderBy("value")
    values = write_shared(values.withColumn("code", F.monotonically_increasing_id()), "codes")
    out = df.join(values, df[name] == values.value).drop("value", name).withColumnRenamed("code", name)
    return out.select(*df.columns), values


def planes(values: np.ndarray) -> bytes:
    """Numbers as byte planes: small and round ones leave planes of zeros, which compress away."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def unplanes(data: bytes, kind: str) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def pack(first: np.ndarray, runs: np.ndarray, step: np.ndarray, own: list[np.ndarray], each: list[np.ndarray]) -> bytes:
    """Runs of pairs: their first items and lengths, the steps between second items, the numbers of runs and of pairs."""
    data = b"".join(map(planes, (first, runs, step, *own, *each)))
    head = np.array([len(first), len(step), step.itemsize, len(own), len(each), len(data)], dtype="<i8").tobytes()
    return head + pa.Codec("zstd", 1).compress(data, asbytes=True)


def unpack_runs(packed: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """(first items, lengths) of the runs, second items of the pairs, numbers of runs and of pairs."""
    n_runs, size, width, n_own, n_each, length = np.frombuffer(packed[:48], dtype="<i8").tolist()
    data = pa.decompress(packed[48:], length, codec="zstd", asbytes=True)
    lengths = [8 * n_runs] * 2 + [width * size] + [8 * n_runs] * n_own + [8 * size] * n_each
    cut = np.cumsum([0, *lengths])
    part = [data[a:b] for a, b in zip(cut[:-1], cut[1:])]
    first, runs = unplanes(part[0], "<i8"), unplanes(part[1], "<i8")
    # within a run differences from the one before, at its start from the first item
    total = np.cumsum(unplanes(part[2], f"<u{width}").astype(np.int64))
    start = np.cumsum(runs) - runs
    second = total + np.repeat(first - np.r_[0, total][start], runs)
    return first, runs, second, [unplanes(p, "<f8") for p in part[3:3 + n_own]], [unplanes(p, "<f8") for p in part[3 + n_own:]]


def unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """First and second items of the pairs, how often they are common, and their numbers: two ratings or three sums."""
    first, runs, second, own, each = unpack_runs(packed)
    if own:
        return np.repeat(first, runs), second, np.ones(len(second), dtype=np.int64), [np.repeat(own[0], runs), *each]
    return np.repeat(first, runs), second, each[0].astype(np.int64), each[1:]


def added(key: np.ndarray, n: np.ndarray, numbers: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(first place of each distinct key, counts, sums), by key."""
    order = np.argsort(key)
    run = key[order]
    start = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
    del run
    return order[start], np.add.reduceat(n[order], start), [np.add.reduceat(x[order], start) for x in numbers]


def formed(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(row of a, row of b) of the pairs of a block; those of one a follow each other, b ascending."""
    user, pa_, pb, part, item = (rows.column(c).to_numpy() for c in ("_u", "_pa", "_pb", "_p", "_i"))
    order = np.lexsort((item, pb, pa_, user))
    cell = np.flatnonzero(np.r_[True, (np.diff(user[order]) != 0) | (np.diff(pa_[order]) != 0) | (np.diff(pb[order]) != 0)])
    size = np.diff(np.r_[cell, len(order)])
    k = np.arange(len(order))
    later = np.repeat(cell + size, size) - k - 1  # rows of the cell with a larger item
    a = np.repeat(k, later)
    b = np.arange(len(a)) - np.repeat(np.cumsum(later) - later, later) + a + 1
    a, b = order[a], order[b]
    if (pa_ != pb).any():  # of a cell of two parts, pairs across
        once = (item[a] != item[b]) & ((pa_[a] == pb[a]) | (part[a] != part[b]))
    else:
        once = item[a] != item[b]
    return (a, b) if once.all() else (a[once], b[once])


def groups_of(first: np.ndarray, second: np.ndarray, shares: np.ndarray, groups: int) -> np.ndarray:
    """The group of each pair: that of its first item, or of one of the item's shares."""
    share = np.zeros(len(first), dtype=np.uint64)
    if (many := np.flatnonzero(shares > 1)).size:
        share[many] = ((second[many].astype(np.uint64) * _A) >> np.uint64(33)) % shares[many].astype(np.uint64)
    mixed = (first.astype(np.uint64) * _A + share) * _B
    return ((mixed ^ (mixed >> np.uint64(32))) % np.uint64(groups)).astype(np.uint16 if groups < 1 << 16 else np.int64)


def agreed(item: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray | None:
    """A key of every pair, if there are at most half as many pairs of items as of rows."""
    items, code, often = np.unique(item, return_inverse=True, return_counts=True)
    if 2 * (1 / often[code])[a].sum() > len(a):  # a pair is common at most as often as its first item
        return None
    key = code[a] * len(items) + code[b]
    ordered = np.sort(key)
    return key if 2 * (1 + np.count_nonzero(ordered[1:] != ordered[:-1])) <= len(key) else None


def block_rows(rows: pa.Table, groups: int) -> Iterator[tuple[int, bytes]]:
    """(group, packed pairs) of a block."""
    a, b = formed(rows)
    if not len(a):
        return
    item, x = rows.column("_i").to_numpy(), rows.column("_x").to_numpy()
    shares = rows.column("_s").to_numpy() if "_s" in rows.column_names else np.ones(len(item), dtype=np.int64)
    n = None
    if (key := agreed(item, a, b)) is not None:  # sums are shorter
        at, n, sums = added(key, np.ones(len(key), dtype=np.int64), [x[a] * x[b], x[a] * x[a], x[b] * x[b]])
        a, b = a[at], b[at]
    del key
    if (shares > 1).any():
        group = groups_of(item[a], item[b], shares[a], groups)
    else:
        group = groups_of(item, item, shares, groups)[a]
    order = np.argsort(group, kind="stable")
    group, a, b = group[order], a[order], b[order]
    second = item[b]
    start = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (group[1:] != group[:-1])]) if n is None else \
        np.flatnonzero(np.r_[True, (item[a[1:]] != item[a[:-1]]) | (group[1:] != group[:-1])])
    step = np.diff(second, prepend=0)
    first = item[a[start]]
    step[start] = second[start] - first
    runs = np.diff(np.r_[start, len(a)])
    step = step.view(np.uint64)
    step = step.astype(next(k for k in (np.uint16, np.uint32, np.uint64) if int(step.max()) <= np.iinfo(k).max))
    own, each = ([x[a[start]]], [x[b]]) if n is None else ([], [v[order] for v in (n.astype(float), *sums)])
    cut = np.flatnonzero(np.r_[True, group[1:] != group[:-1], True])
    for lo, hi, r, s in zip(cut[:-1], cut[1:], np.searchsorted(start, cut[:-1]), np.searchsorted(start, cut[1:])):
        yield int(group[lo]), pack(first[r:s], runs[r:s], step[lo:hi], [v[r:s] for v in own], [v[lo:hi] for v in each])


def keys(first: np.ndarray, runs: np.ndarray, second: np.ndarray) -> np.ndarray:
    """One number of each pair, in runs of a first item."""
    heads, code = np.unique(first, return_inverse=True)
    least = second.min()
    width = int(second.max()) - int(least) + 1
    if len(heads) * width < 1 << 62:
        second = second - least
    else:
        tails, second = np.unique(second, return_inverse=True)
        width = len(tails)
    key = np.repeat(code * width, runs) + second
    return key.astype(np.uint32) if len(heads) * width < 1 << 32 else key


def group_sums(rows: pa.Table, least: int = 1) -> pa.Table:
    """The sums of a group's pairs, of those with ``least`` common users."""
    parts = [unpack_runs(p) for p in rows.column("packed").to_pylist()]
    first, runs, second = (np.concatenate([p[k] for p in parts]) for k in range(3))
    key = keys(first, runs, second)
    some = slice(None)
    if all(own for *_, own, _ in parts):
        x, y = np.concatenate([p[3][0] for p in parts]), np.concatenate([p[4][0] for p in parts])
        del parts
        run = np.repeat(np.arange(len(first)), runs)
        if least > 1:
            ordered = np.sort(key)
            start = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1], True])
            enough = np.diff(start) >= least
            if 2 * np.count_nonzero(enough) < len(enough):  # rows of the others need no sums
                wanted = ordered[start[:-1][enough]]
                if len(wanted):
                    at = np.searchsorted(wanted, key)
                    at[at == len(wanted)] = 0
                    some = np.flatnonzero(wanted[at] == key)
                else:
                    some = np.arange(0)
            del ordered
        key, second, run, y = key[some], second[some], run[some], y[some]
        first, x = first[run], x[run]
        n, numbers = np.ones(len(key), dtype=np.int64), [x * y, x * x, y * y]
    else:
        found = [(r, (x := np.repeat(own[0], r)) * (y := each[0]), x * x, y * y, np.ones(len(y))) if own else (r, *each[1:], each[0])
                 for _, r, _, own, each in parts]
        del parts
        first, n = np.repeat(first, runs), np.concatenate([f[4] for f in found]).astype(np.int64)
        numbers = [np.concatenate([f[k] for f in found]) for k in (1, 2, 3)]
        del found
    if len(key):
        at, n, numbers = added(key, n, numbers)
        if least > 1:
            at, numbers, n = at[enough := n >= least], [v[enough] for v in numbers], n[enough]
        first, second = first[at], second[at]
    sums = pa.table({"item_a": first, "item_b": second, **dict(zip(_COLUMNS, numbers)), "strength": n})
    return pa.Table.from_batches(sums.to_batches(max_chunksize=100_000), sums.schema)


def pair_sums(ratings: DataFrame, grid: int, least: int = 1) -> DataFrame:
    """(item_a, item_b, sxy, sxx, syy, strength) of every item pair a < b with ``least`` common users: the sums of xy, xx and
    yy over the common users, and their number. ``ratings`` (_u, _i, _x, _d) without nulls, one row per (_u, _i), _d the number
    of the user's ratings in it, are read more than once. A user with more than ``grid`` ratings is dealt as a grid."""
    spark, kind = ratings.sparkSession, ratings.schema["_i"].dataType
    weights = write_shared(ratings.groupBy("_i").agg(F.sum(F.col("_d") - 1).alias("_w")), "weights")
    n_pairs = (weights.agg(F.sum("_w")).first()[0] or 0) // 2
    fewest = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks, groups = max(fewest, -(-n_pairs // BLOCK)), max(fewest, -(-n_pairs // GROUP))
    share = max(1, GROUP // SHARE)
    popular = weights.where(F.col("_w") > share).select("_i", F.ceil(F.col("_w") / share).cast("int").alias("_s"))
    r, _ = coded(ratings.select("_u", "_i", "_x", "_d").join(popular, "_i", "left"), "_u")
    r, items = coded(r.withColumn("_s", F.coalesce("_s", F.lit(1))), "_i")
    parts = F.ceil(F.col("_d") / grid).cast("int")
    cells = F.transform(F.sequence(F.lit(0), parts - 1), lambda t: F.struct(F.least(t, F.col("_p")).alias("a"), F.greatest(t, F.col("_p")).alias("b")))
    many = r.where(F.col("_d") > grid).withColumn("_p", F.pmod(F.xxhash64("_i"), parts.cast("bigint")).cast("int")).select("*", F.explode(cells).alias("_c"))
    one = r.where(F.col("_d") <= grid).select("*", *[F.lit(0).alias(c) for c in ("_p", "_pa", "_pb")])
    dealt = one.unionByName(many.select(*r.columns, "_p", F.col("_c.a").alias("_pa"), F.col("_c.b").alias("_pb"))).select(
        F.pmod(F.xxhash64("_u", "_pa", "_pb"), F.lit(blocks)).cast("int").alias("block"), "_u", "_i", "_x", "_s", "_p", "_pa", "_pb")

    def form(rows: pa.Table) -> pa.Table:
        out = list(block_rows(rows, groups))
        return pa.table({"part": pa.array([g for g, _ in out], pa.int32()), "packed": pa.array([p for _, p in out], pa.binary())})

    def add(rows: pa.Table) -> pa.Table:
        return group_sums(rows, least)

    packed = dealt.repartition(blocks, "block").groupBy("block").applyInArrow(form, "part int, packed binary")
    sums = packed.repartition(groups, "part").groupBy("part").applyInArrow(
        add, "item_a long, item_b long, sxy double, sxx double, syy double, strength long")
    for name in ("item_a", "item_b"):
        if items is not None:
            sums = sums.join(items.select(F.col("code").alias(name), F.col("value").alias(f"{name}_")), name).drop(name).withColumnRenamed(f"{name}_", name)
        else:
            sums = sums.withColumn(name, F.col(name).cast(kind))
    return sums.select("item_a", "item_b", *_COLUMNS, "strength")
