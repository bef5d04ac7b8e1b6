"""SimHash near-dedup: fingerprints, and links by a self-join of a binary trie of fingerprints.

Only distinct fingerprints are joined (copies of a text collapse first). Two fingerprints within
``most`` bits of one another agree in one of most + 1 equal blocks of bits; for each block, the
bits are rotated so that it comes first, and the trie node below that block is joined with
itself. A node pair splits by the next bit into up to four child pairs; a pair of different bits
costs one unit of the error budget, and a pair without budget is pruned. Small node pairs are
compared leaf by leaf. The nodes of one task are all traversed together, level by level, as
arrays of ranges of the sorted fingerprints (a trie node is such a range).

A node with more than ``NODE`` fingerprints is cut into slices and every pair of slices becomes a
task of its own, so a node that holds a third of all fingerprints is spread and joined whole.
A task returns a spanning forest of its links, not all pairs; node pairs whose leaves already
stand in one class are skipped. Classes across tasks come from connected components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwright.llm.common import bound_batches, fresh_names, ids_and_texts, materialise, shuffle_partitions
from sparkwright.llm.components import connected_components

BITS = 64
#: Fingerprints of a trie node that one task joins; rows of a task.
NODE, TASK_ROWS = 100_000, 400_000
#: Leaf pairs below which a node pair is compared directly; node pairs and leaf pairs at a time.
LEAVES, CHUNK, PAIRS = 64, 100_000, 2_000_000


# ---------------------------------------------------------------- fingerprints

def shingle_hashes(text: str, length: int, seed: int = 42) -> bytes:
    """XXH64 of each shingle (big-endian, 8 bytes each), repeats included."""
    import xxhash
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes.lower() and split() are ASCII only
    if not words:
        return b""
    joined = b" ".join(words)
    if len(words) <= length:
        return xxhash.xxh64_digest(joined, seed)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(sizes + 1) - 1
    begin = end - sizes
    digest = xxhash.xxh64_digest
    return b"".join([digest(joined[a:b], seed)
                     for a, b in zip(begin[:len(words) - length + 1].tolist(), end[length - 1:].tolist())])


def fingerprint(hashes: bytes) -> int:
    """A bit is set if it is set in over half the hashes; none: zero."""
    n = len(hashes) // 8
    ones, step = np.zeros(BITS, dtype=np.int64), 1 << 19
    for at in range(0, len(hashes), step):
        bits = np.unpackbits(np.frombuffer(hashes[at:at + step], dtype=np.uint8)).reshape(-1, BITS)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint as a long) of every whole text; a null text has no words."""
    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            fp = [fingerprint(shingle_hashes(t, shingle)) for t in map(str, b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp, pa.int64())], ["doc_id", "fp"])
    return ids_and_texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, fp long")


# ---------------------------------------------------------------- trie self-join

class Classes:
    """Union of array positions; ``label`` is the smallest position of each class."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.label[a], self.label[b]
            open_ = x != y
            if not open_.any():
                return
            a, b, x, y = a[open_], b[open_], x[open_], y[open_]
            np.minimum.at(self.label, np.maximum(x, y), np.minimum(x, y))
            while True:
                jumped = self.label[self.label]
                if np.array_equal(jumped, self.label):
                    break
                self.label = jumped


def _products(a0, a1, b0, b1):
    """All (i, j) with i in [a0, a1) and j in [b0, b1), for arrays of ranges."""
    wide = b1 - b0
    n = (a1 - a0) * wide
    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    w = np.repeat(wide, n)
    return np.repeat(a0, n) + k // w, np.repeat(b0, n) + k % w


def trie_join(value: np.ndarray, left: np.ndarray, right: np.ndarray, begin: int, most: int) -> np.ndarray:
    """Class label of every position of ``value`` under links of at most ``most`` differing bits.

    ``left`` and ``right`` are arrays of (from, to) ranges, the node pairs to join; within a range
    values are sorted, and all values of a pair of ranges agree in their first ``begin`` bits.
    """
    classes = Classes(len(value))
    zeros: dict[int, np.ndarray] = {}

    def middle(lo, hi, bit):
        if bit not in zeros:
            zeros[bit] = np.r_[0, np.cumsum(1 - ((value >> np.uint64(BITS - 1 - bit)) & np.uint64(1)).astype(np.int32))]
        return lo + zeros[bit][hi] - zeros[bit][lo]

    def compare(a0, a1, b0, b1):
        n = np.cumsum((a1 - a0) * (b1 - b0))
        for part in np.split(np.arange(len(n)), np.searchsorted(n, np.arange(PAIRS, n[-1] if len(n) else 0, PAIRS))):
            if len(part):
                i, j = _products(a0[part], a1[part], b0[part], b1[part])
                near = (np.bitwise_count(value[i] ^ value[j]) <= most) & (i != j)
                classes.join(i[near], j[near])

    todo = [(begin, left[:, 0], left[:, 1], right[:, 0], right[:, 1], np.full(len(left), most))]
    while todo:
        bit, a0, a1, b0, b1, budget = todo.pop()
        small = ((a1 - a0) * (b1 - b0) <= LEAVES) | (bit >= BITS)
        compare(a0[small], a1[small], b0[small], b1[small])
        a0, a1, b0, b1, budget = (x[~small] for x in (a0, a1, b0, b1, budget))
        if len(a0):  # skip pairs of nodes whose leaves are all in one class
            lo, hi = np.c_[a0, b0], np.c_[a1, b1]
            ends = np.c_[lo.ravel(), hi.ravel()].ravel()
            label = np.r_[classes.label, 0]
            low = np.minimum.reduceat(label, ends)[::2].reshape(-1, 2)
            high = np.maximum.reduceat(label, ends)[::2].reshape(-1, 2)
            alive = low.min(axis=1) != high.max(axis=1)
            a0, a1, b0, b1, budget = (x[alive] for x in (a0, a1, b0, b1, budget))
        if not len(a0):
            continue
        same = (a0 == b0) & (a1 == b1)
        am, bm = middle(a0, a1, bit), middle(b0, b1, bit)
        child = [(a0, am, b0, bm, budget, np.ones_like(same)), (am, a1, bm, b1, budget, np.ones_like(same)),
                 (a0, am, bm, b1, budget - 1, np.ones_like(same)), (am, a1, b0, bm, budget - 1, ~same)]
        parts = [np.concatenate(x) for x in zip(*child)]
        ok = parts[5] & (parts[4] >= 0) & (parts[1] > parts[0]) & (parts[3] > parts[2])
        parts = [x[ok] for x in parts[:5]]
        for at in range(0, len(parts[0]), CHUNK):
            todo.append((bit + 1, *(x[at:at + CHUNK] for x in parts)))
    return classes.label


def _link_single_bits(value: np.ndarray, lo: np.ndarray, hi: np.ndarray, begin: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of one differing bit inside large ranges: they join dense classes early."""
    a, b = [], []
    for x, y in zip(lo.tolist(), hi.tolist()):
        v = value[x:y]
        for bit in range(begin, BITS):
            flip = v ^ np.uint64(1 << (BITS - 1 - bit))
            at = np.minimum(np.searchsorted(v, flip), len(v) - 1)
            hit = np.flatnonzero(v[at] == flip)
            a.append(x + hit)
            b.append(x + at[hit])
    return (np.concatenate(a), np.concatenate(b)) if a else (np.empty(0, int), np.empty(0, int))


def _join_task(batches: Iterator[pa.RecordBatch], begin: int, most: int) -> Iterator[pa.RecordBatch]:
    """Rows (node, side, value, rep) of whole node pairs; side 0 joins itself, or side 1 with 2."""
    if held := [b for b in batches if b.num_rows]:
        table = pa.Table.from_batches(held)
        node, side, value, rep = (table.column(c).to_numpy() for c in ("node", "side", "value", "rep"))
        value = value.view(np.uint64)
        order = np.lexsort((value, side, node))
        node, side, value, rep = node[order], side[order], value[order], rep[order]
        cut = np.flatnonzero(np.r_[True, (node[1:] != node[:-1]) | (side[1:] != side[:-1]), True])
        lo, hi, s, k = cut[:-1], cut[1:], side[cut[:-1]], node[cut[:-1]]
        own = s == 0
        paired = np.flatnonzero((s[:-1] == 1) & (s[1:] == 2) & (k[:-1] == k[1:])) if len(s) > 1 else np.empty(0, int)
        left = np.r_[np.c_[lo, hi][own], np.c_[lo, hi][paired]]
        right = np.r_[np.c_[lo, hi][own], np.c_[lo, hi][paired + 1]]
        label = trie_join(value, left, right, begin, most)
        linked = np.flatnonzero(label != np.arange(len(label)))
        yield pa.RecordBatch.from_arrays([pa.array(rep[linked]), pa.array(rep[label[linked]])], ["u", "v"])


def links(reps: DataFrame, most: int = 3) -> DataFrame:
    """Edges (u, v) whose components are those of all fingerprint pairs within ``most`` bits.

    ``reps``: (fp, rep), distinct fingerprints, each with an id that stands for it.
    """
    width = BITS // (most + 1)
    turned = reps.select("rep", F.explode(F.array(*[F.struct(
        F.lit(r).alias("turn"), F.expr(f"shiftleft(fp, {r * width}) | shiftrightunsigned(fp, {BITS - r * width})"
                                       if r else "fp").alias("value")) for r in range(most + 1)])).alias("x"))
    rows = turned.select("rep", "x.value", F.col("x.turn").alias("turn"),
                         F.shiftrightunsigned("x.value", BITS - width).alias("key"))
    sizes = rows.groupBy("turn", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / NODE).cast("int")
    rows = rows.join(sizes, ["turn", "key"]).withColumn("parts", parts).withColumn(
        "slice", F.pmod(F.xxhash64("value"), F.col("parts")).cast("int"))
    # a row of slice s meets every slice: pair (i, j) with i <= j; alone (parts = 1) it has pair (0, 0)
    pairs = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda t: F.struct(
        F.least("slice", t).alias("i"), F.greatest("slice", t).alias("j"),
        F.when(F.col("slice") == t, 0).when(F.col("slice") < t, 1).otherwise(2).alias("side")))
    tasks = rows.select("rep", "value", "turn", "key", F.explode(pairs).alias("p")).select(
        F.xxhash64("turn", "key", "p.i", "p.j").alias("node"), F.col("p.side").cast("int").alias("side"),
        "value", "rep")
    n = max(shuffle_partitions(reps.sparkSession), -(-reps.count() * (most + 1) // TASK_ROWS))
    return tasks.repartition(n, "node").mapInArrow(lambda b: _join_task(b, width, most), "u long, v long")


def near_duplicates(docs: DataFrame, shingle: int = 3, most: int = 3, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id): component_id is the smallest doc_id reachable over links of at
    most ``most`` differing bits, itself included.

    Texts without words have fingerprint zero and link like others. A row with a null doc_id takes
    the component of its fingerprint if a document with an id has that fingerprint, else null; it
    makes no links. Repeated rows give one row each; an empty table gives none.
    """
    fps = materialise(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    reps = materialise(fps.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("rep")), "distinct")
    classes = connected_components(links(reps, most))
    named = reps.join(classes, reps.rep == classes.node, "left").select(
        "fp", F.coalesce("component", "rep").alias("component_id"))
    return fps.join(named, "fp", "left").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, most: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each near-duplicate class, with all columns of ``docs`` as they are.

    The row with the class's smallest doc_id stays (of several rows with that id, the one with the smallest digest).
    Rows with a null doc_id are in their class like others; one of them stays only if the class has no row with
    an id. Rows are told apart by 128 bits of all their columns; fully repeated rows are one.
    """
    own = docs.columns
    one, two = fresh_names(own, "row_a", "row_b")
    columns = [F.col(f"`{c}`") for c in own]
    marked = docs.withColumns({one: F.xxhash64(*columns), two: F.xxhash64(F.lit(1), *columns)})
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            fp = [fingerprint(shingle_hashes(t, shingle)) for t in map(str, b.column(3))]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(fp, pa.int64())], ["id", "a", "b", "fp"])
    rows = materialise(marked.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(one).alias("a"), F.col(two).alias("b"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
        .mapInArrow(run, "id long, a long, b long, fp long"), "row-fingerprints")
    # fingerprints stand for themselves; the smallest row of each, then of each class
    first = rows.groupBy("fp").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "a", "b")).alias("first"))
    classes = connected_components(links(rows.select("fp", F.col("fp").alias("rep")).distinct(), most))
    best = (first.join(classes, first.fp == classes.node, "left").groupBy(F.coalesce("component", "fp")).agg(F.min("first").alias("first"))
            .select(F.col("first.a").alias(one), F.col("first.b").alias(two)))
    kept = marked.join(best, [one, two], "left_semi").dropDuplicates([one, two])
    return kept.select(*columns)
