"""N-gram Jaccard join by T-occurrence search over inverted lists (DivideSkip).

A document is the set of its distinct shingles. Two sets of sizes m and n with Jaccard similarity of at least t
share at least T = t / (1 + t) (m + n) shingles, so a set's partners occur in at least T of the
inverted lists of its shingles. DivideSkip sets the L longest of these lists apart, merges the short
ones with a heap that jumps over documents seen too rarely (fewer than T - L times), and probes the long ones
by binary search for the documents that remain.

Most sets have no partner, and their number must not matter:

1. Counting. Documents are dealt into blocks; a block asks once for each of its distinct shingles how many
   sets have it (a shingle of a third of all documents gives one entry per block), and groups of shingles
   answer with a frequency class of one byte. A set with more than n - T shingles that no other set has is
   alone; only the others go on, one copy of each set. Copies are told apart by 128-bit digests.
2. Short lists. In the order of frequency classes (rare first), two partners share one of their first
   n - T + 1 shingles: these are the lists that are always short. A list with one set ends here.
3. Stars. Every set is compared with one partner, the smallest key in its short lists. The sets that link with one
   leader are a class, which is searched as a whole. Lists whose sets are all in one class are closed.
4. Search. The other lists join sets into candidate components, each searched for links between classes. A class or
   component with more than ``SLICE`` shingles is cut by length class and hash, and every pair of slices with lengths in
   reach of each other becomes a task; so none is dropped, and no task grows with the data.

Every pair of sets that may link meets in exactly one task, and every link is counted there, once for each copy of the
other set. What leaves a task is a count per set and a spanning forest of its links, which gives connected components,
so a group of near copies takes no room for its pairs. In a task, lists with few entries are merged by DivideSkip; where they
have many (near copies of each other), the entries are counted in one array (ScanCount).
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwright.llm.common import Words, ids_and_texts, materialise, mix64, shuffle_partitions, window_hashes
from sparkwright.llm.components import connected_components

#: Bytes of text of a block and of a group of shingles; shingles of a slice of a component.
BLOCK, GROUP, SLICE = 4_000_000, 12_000_000, 250_000
#: Shingles of the members that a star's task compares with its leader.
STAR = 300_000
#: DivideSkip's trade between merging and probing: L = T / (MU log2(longest list) + 1).
MU = 0.0085
#: Entries of a query's lists up to which they are merged; more are counted in an array.
SCAN = 1_000
_TOKEN, _KEY = 0x9E3779B97F4A7C15, np.uint64(0xD6E8FEB86659FD93)


class Need:
    """Similarity ``percent`` / 100 in whole numbers."""

    def __init__(self, percent: int):
        if not 0 < percent <= 100:
            raise ValueError("percent must be from 1 to 100")
        self.percent = percent

    def least(self, n):
        """Shared shingles that a set of n must have with any partner."""
        return -(-self.percent * n // 100)

    def shared(self, m, n):
        """Shared shingles that sets of m and n must have."""
        return -(-self.percent * (m + n) // (100 + self.percent))

    def in_reach(self, m, n):
        return (100 * m >= self.percent * n) & (100 * n >= self.percent * m)


# ---------------------------------------------------------------- sets of shingles

class Sets:
    """Distinct shingles of each text: ``tokens[first[i]:first[i + 1]]``, ascending."""

    def __init__(self, texts: list[str], length: int):
        w = Words(texts, lower=True)
        h, count = w.hashes(7), np.diff(w.first)
        token = window_hashes(h, length, _TOKEN)
        at = np.arange(len(token))
        inside = w.text[at] == w.text[at + length - 1] if len(at) else np.zeros(0, dtype=bool)
        owner, token = w.text[at][inside], token[inside]
        short = np.flatnonzero((count > 0) & (count < length))  # the whole sequence, as one
        whole = [window_hashes(h[w.first[i]:w.first[i + 1]], int(count[i]), _TOKEN)[0] for i in short]
        owner = np.r_[owner, short]
        token = np.r_[token, np.array(whole, dtype=np.uint64)]
        order = np.lexsort((token, owner))
        owner, token = owner[order], token[order]
        new = np.r_[True, (owner[1:] != owner[:-1]) | (token[1:] != token[:-1])][:len(owner)]
        self.owner, self.tokens = owner[new], token[new]
        self.first = np.searchsorted(self.owner, np.arange(len(texts) + 1))
        self.size = np.diff(self.first)

    def keys(self) -> list[bytes | None]:
        """128-bit digests of the sets (sums of mixed shingles); none of an empty set."""
        if not len(self.tokens):
            return [None] * len(self.size)
        full = np.flatnonzero(self.size)
        halves = [mix64(np.add.reduceat(mix64(self.tokens ^ salt), self.first[full]) + self.size[full].astype(np.uint64))
                  for salt in (_KEY, ~_KEY)]
        out: list[bytes | None] = [None] * len(self.size)
        for i, a, b in zip(full.tolist(), *(x.astype(">u8") for x in halves)):
            out[i] = a.tobytes() + b.tobytes()
        return out


class Block:
    """A block of documents: its sets, and its distinct shingles by group with the number of its distinct sets."""

    def __init__(self, rows: pa.Table, length: int, groups: int):
        self.ids, self.groups = rows.column("doc_id").combine_chunks(), groups
        self.sets = s = Sets(rows.column("text").to_pylist(), length)
        self.keys = s.keys()
        seen: set[bytes] = set()
        self.own = np.zeros(len(self.keys), dtype=bool)  # first row of each set; rows without an id make none
        for i, (key, known) in enumerate(zip(self.keys, np.asarray(self.ids.is_valid()))):
            if known and key is not None and key not in seen:
                seen.add(key)
                self.own[i] = True
        self.used = self.own[s.owner]
        token, self.of, count = np.unique(s.tokens[self.used], return_inverse=True, return_counts=True)
        group = (token % np.uint64(groups)).astype(np.int64)
        self.order = np.argsort(group, kind="stable")
        self.token, self.count, self.group = token[self.order], count[self.order], group[self.order]
        self.cut = np.flatnonzero(np.diff(self.group, prepend=-1, append=-2)) if len(token) else np.zeros(1, int)

    def asked(self) -> Iterator[tuple[int, bytes, bytes]]:
        for a, b in zip(self.cut[:-1], self.cut[1:]):
            yield int(self.group[a]), short_form(self.token[a:b], self.groups), np.minimum(self.count[a:b], 255).astype(np.uint8).tobytes()

    def classes(self, answers: dict[int, bytes]) -> np.ndarray:
        """Frequency class of each shingle of the block's sets (0: no other set has it)."""
        found = np.zeros(len(self.token), dtype=np.uint8)
        for a, b in zip(self.cut[:-1], self.cut[1:]):
            found[a:b] = np.frombuffer(answers[int(self.group[a])], dtype=np.uint8)
        by_token = np.empty_like(found)
        by_token[self.order] = found
        return by_token[self.of]


def short_form(tokens: np.ndarray, groups: int) -> bytes:
    """Five bytes of each shingle beside its group. Two shingles of one group that agree in them are counted
    together, by all sets alike: such a class is too high, never too low, and no partner is lost."""
    return np.ascontiguousarray((tokens // np.uint64(groups)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _frequencies(rows: pa.Table) -> pa.Table:
    """One group of shingles: the frequency class of every shingle of every block."""
    tokens = []
    for t in rows.column("tokens").to_pylist():
        wide = np.zeros((len(t) // 5, 8), dtype=np.uint8)
        wide[:, :5] = np.frombuffer(t, dtype=np.uint8).reshape(-1, 5)
        tokens.append(wide.view("<u8").ravel())
    counts = [np.frombuffer(c, dtype=np.uint8) for c in rows.column("counts").to_pylist()]
    _, of = np.unique(np.concatenate(tokens), return_inverse=True)
    total = np.bincount(of, weights=np.concatenate(counts))
    # quarter steps of the logarithm: one byte, the same for all sets, which is all that an order needs
    found = np.minimum(255, np.ceil(4 * np.log2(total))).astype(np.uint8)[of]
    ends = np.cumsum([len(t) for t in tokens])
    return pa.table({"block": rows.column("block"), "part": rows.column("part"),
                     "classes": pa.array([found[e - len(t):e].tobytes() for e, t in zip(ends, tokens)], pa.binary())})


def shared_sets(docs: DataFrame, length: int, need: Need, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, key, alone, tokens): every document's set size and digest. ``tokens`` has the set, rare shingles
    first and those of no other set left out (``alone`` many), once per block for sets that may have a partner."""
    texts = ids_and_texts(docs, id_col, text_col)
    n_bytes = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = shuffle_partitions(docs.sparkSession)
    groups, blocks = max(parts, -(-n_bytes // GROUP)), max(parts, -(-n_bytes // BLOCK))
    dealt = texts.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))

    def ask(rows: pa.Table) -> pa.Table:
        block, out = rows.column("block")[0].as_py(), list(Block(rows, length, groups).asked())
        return pa.table({"block": pa.array([block] * len(out), pa.int32()), "part": pa.array([x[0] for x in out], pa.int32()),
                         "tokens": pa.array([x[1] for x in out], pa.binary()), "counts": pa.array([x[2] for x in out], pa.binary())})

    def tell(rows: pa.Table, replies: pa.Table) -> pa.Table:
        b = Block(rows, length, groups)
        rank = b.classes(dict(zip(replies.column("part").to_pylist(), replies.column("classes").to_pylist())))
        owner, token = b.sets.owner[b.used], b.sets.tokens[b.used]
        alone = np.bincount(owner[rank == 0], minlength=len(b.keys))
        may = b.own & (alone <= b.sets.size - need.least(b.sets.size))
        order = np.lexsort((token, rank, owner))
        order = order[(rank[order] > 0) & may[owner[order]]]
        owner, token = owner[order], token[order]
        cut = np.searchsorted(owner, np.arange(len(b.keys) + 1))
        return pa.table({"doc_id": b.ids, "n": pa.array(b.sets.size, pa.int64()), "key": pa.array(b.keys, pa.binary()),
                         "alone": pa.array(alone, pa.int64()),
                         "tokens": pa.array([token[cut[i]:cut[i + 1]].tobytes() if m else None for i, m in enumerate(may)], pa.binary())})

    asked = dealt.groupBy("block").applyInArrow(ask, "block int, part int, tokens binary, counts binary")
    replies = asked.groupBy("part").applyInArrow(_frequencies, "block int, part int, classes binary")
    return dealt.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(
        tell, "doc_id long, n long, key binary, alone long, tokens binary")


# ---------------------------------------------------------------- T-occurrence search

def merge_skip(place: list[int], lists: list[tuple[int, int]], need: int) -> Iterator[tuple[int, int]]:
    """(document, lists that hold it) for documents in at least ``need`` of the lists; a list is a
    range (from, to) of ``place``, ascending."""
    heap = [(place[a], a, b) for a, b in lists if a < b]
    heapify(heap)
    while len(heap) >= need:
        top, popped = heap[0][0], []
        while heap and heap[0][0] == top:
            popped.append(heappop(heap))
        if len(popped) >= need:
            yield top, len(popped)
            ahead = top + 1
        else:  # any document before the need-th smallest head occurs too rarely: jump there
            while len(popped) < need - 1 and heap:
                popped.append(heappop(heap))
            if not heap:
                return
            ahead = heap[0][0]
        for _, a, b in popped:
            a = bisect_left(place, ahead, a + 1, b) if place[a] < ahead else a
            if a < b:
                heappush(heap, (place[a], a, b))


class Index:
    """Inverted lists of sets given as arrays of shingle numbers."""

    def __init__(self, sets: list[np.ndarray]):
        self.m = len(sets)
        owner = np.repeat(np.arange(self.m), [len(s) for s in sets])
        self.entry = np.sort(np.concatenate(sets) * self.m + owner)  # by shingle, then document
        self.where = self.entry % self.m
        self.place = self.where.tolist()

    def search(self, query: np.ndarray, least: int, lo: int, hi: int) -> Iterator[tuple[int, int, np.ndarray]]:
        """DivideSkip: (document, short lists that hold it, shingles of the long lists) for the
        documents lo .. hi - 1 that may occur in ``least`` lists."""
        a = np.searchsorted(self.entry, query * self.m + lo)
        b = np.searchsorted(self.entry, query * self.m + hi)
        full = np.flatnonzero(b > a)
        if len(full) < least:
            return
        full = full[np.argsort((b - a)[full], kind="stable")]
        longest = int((b - a)[full[-1]])
        apart = min(least - 1, int(least / (MU * math.log2(longest) + 1))) if longest > 1 else least - 1
        short, long_ = full[:len(full) - apart], full[len(full) - apart:]
        for document, n in merge_skip(self.place, list(zip(a[short].tolist(), b[short].tolist())), least - apart):
            yield document, n, query[long_]

    def probe(self, document: int, shingles: np.ndarray) -> int:
        """How many of the shingles' lists hold the document, by binary search in each."""
        at = np.minimum(np.searchsorted(self.entry, shingles * self.m + document), len(self.entry) - 1)
        return int((self.entry[at] == shingles * self.m + document).sum())


    def matches(self, query: np.ndarray, least: int, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, shingles shared with the query) for the documents lo .. hi - 1 that share at least ``least``."""
        a = np.searchsorted(self.entry, query * self.m + lo)
        size = np.searchsorted(self.entry, query * self.m + hi) - a
        total = int(size.sum())
        if total > SCAN:
            at = np.repeat(a - (np.cumsum(size) - size), size) + np.arange(total)
            n = np.bincount(self.where[at] - lo, minlength=hi - lo)
            found = np.flatnonzero(n >= least)
            return found + lo, n[found]
        found = [(k, n + self.probe(k, rest)) for k, n, rest in self.search(query, least, lo, hi)] if total >= least else []
        k, n = (np.array([x[c] for x in found], dtype=np.int64) for c in range(2))
        return k[n >= least], n[n >= least]


def join_sets(left: list[int], right: list[int] | None, tokens: list[np.ndarray], size: np.ndarray, labels: list[bytes],
              copies: np.ndarray, need: Need) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """(links of each set, a spanning forest of them) between the sets ``left`` and ``right`` (None: ``left`` with itself),
    given by their numbers, whose ``labels`` differ. A link counts once for each of the other set's ``copies``.
    Sets of one label are connected already; their links are counted elsewhere.

    ``tokens`` leave out what no other set has; ``size`` counts it.
    """
    _, of = np.unique(np.concatenate(tokens), return_inverse=True)
    number = np.split(of.astype(np.int64), np.cumsum([len(t) for t in tokens])[:-1])
    _, label = np.unique(np.array([x.hex() for x in labels]), return_inverse=True)
    root, n_links, forest = label.copy(), np.zeros(len(tokens), dtype=np.int64), []
    placed = np.array(left if right is None else right)
    index = Index([number[i] for i in placed])
    for at, i in enumerate(left):
        lo = at + 1 if right is None else 0
        if lo >= len(placed):
            continue
        k, n = index.matches(number[i], int(need.least(size[i])), lo, len(placed))
        j = placed[k]
        j = j[(label[j] != label[i]) & need.in_reach(size[i], size[j]) & (n >= need.shared(size[i], size[j]))]
        n_links[i] += copies[j].sum()
        n_links[j] += copies[i]
        for r, first in zip(*np.unique(root[j], return_index=True)):
            if r != root[i]:
                forest.append((i, int(j[first])))
                root[root == r] = root[i]
    return n_links, forest


def _join_node(rows: pa.Table, need: Need) -> pa.Table:
    """A task: sets of side 0 among themselves, and those of side 1 with those of side 2. Rows (u, v) of links, and (u, n)
    of sets with n links."""
    side, key = rows.column("side").to_numpy(), rows.column("key").to_pylist()
    tokens = [np.frombuffer(t, dtype=np.uint64) for t in rows.column("tokens").to_pylist()]
    size, labels, copies = rows.column("n").to_numpy(), rows.column("label").to_pylist(), rows.column("copies").to_numpy()
    n_links, links = np.zeros(len(key), dtype=np.int64), []
    own, one, two = ([int(i) for i in np.flatnonzero(side == s)] for s in range(3))
    for left, right in ((own, None), (one, two)):
        if len(own) > 1 if right is None else one and two:
            n, forest = join_sets(left, right, tokens, size, labels, copies, need)
            n_links += n
            links += forest
    some = np.flatnonzero(n_links).tolist()
    return pa.table({"u": pa.array([key[i] for i, _ in links] + [key[i] for i in some], pa.binary()),
                     "v": pa.array([key[j] for _, j in links] + [None] * len(some), pa.binary()),
                     "n": pa.array([None] * len(links) + n_links[some].tolist(), pa.int64())})


def _joined(tasks: DataFrame, need: Need, parts: int) -> DataFrame:
    """Links and counts found by the tasks; dealt over ``parts`` partitions, as their work is more than their bytes say."""
    return tasks.select("node", "side", "key", "label", "n", "copies", "tokens").repartition(parts, "node").groupBy("node").applyInArrow(
        lambda rows: _join_node(rows, need), "u binary, v binary, n long")


def _short_lists(batches: Iterator[pa.RecordBatch], need: Need) -> Iterator[pa.RecordBatch]:
    """(token, key): the lists that are always short."""
    for b in batches:
        token, keys = [], []
        for key, n, alone, t in zip(*(b.column(k).to_pylist() for k in range(4))):
            first = np.frombuffer(t, dtype=np.int64)[:max(0, n - need.least(n) + 1 - alone)]
            token.append(first)
            keys += [key] * len(first)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(token) if token else [], pa.int64()),
                                          pa.array(keys, pa.binary())], ["token", "key"])


def _stars(lists: DataFrame, sets: DataFrame, need: Need) -> DataFrame:
    """(node, side, key, label, n, copies, tokens): tasks that compare sets with the smallest key of their short lists."""
    leads = lists.groupBy("token").agg(F.min("key").alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1")
    pairs = lists.join(leads.drop("n"), "token").groupBy("key").agg(F.min("leader").alias("leader")).where("leader != key")
    pairs = materialise(pairs, "stars")
    # a leader of many members is sent to one task for each STAR shingles of them
    sizes = pairs.join(sets.select("key", "held"), "key").groupBy("leader").agg(
        F.ceil(F.sum("held") / STAR).cast("long").alias("parts"))
    members = pairs.join(sizes, "leader").select(
        F.xxhash64("leader", F.pmod(F.xxhash64("key"), F.col("parts"))).alias("node"), F.lit(2).alias("side"), "key")
    leaders = sizes.select(F.col("leader").alias("key"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")).select(
        F.xxhash64("key", "part").alias("node"), F.lit(1).alias("side"), "key")
    return members.unionByName(leaders).join(sets, "key").withColumn("label", F.col("key"))


def _components(open_: DataFrame, sets: DataFrame) -> DataFrame:
    """(key, group, label, sets' columns): the sets of the open lists (token, key, label) by candidate component."""
    edges = open_.join(open_.groupBy("token").agg(F.min("key").alias("u")), "token").select("u", F.col("key").alias("v"))
    members = connected_components(edges.where("u != v").distinct()).select(F.col("node").alias("key"), F.col("component").alias("group"))
    return members.join(open_.select("key", "label").distinct(), "key").join(sets, "key")


def _classes(stars: DataFrame, sets: DataFrame) -> DataFrame:
    """(key, group, label, sets' columns): the sets that link with one leader (stars: u leader, v set), and the leader unless
    it links with one itself; each with a label of its own, so that all links are counted."""
    labels = stars.select(F.col("v").alias("key"), F.col("u").alias("group"))
    leaders = stars.select(F.col("u").alias("key"), F.col("u").alias("group")).distinct().join(labels.select("key"), "key", "left_anti")
    of = F.concat(F.lit(b"class "), "group")  # a component may have the name of a class
    return labels.unionByName(leaders).join(sets, "key").withColumns({"label": F.col("key"), "group": of})


def _tasks(found: DataFrame, need: Need) -> DataFrame:
    """(node, side, key, label, n, copies, tokens): the search tasks of groups of sets."""
    whole = found.groupBy("group").agg(F.sum("held").alias("group_held"))
    # lengths in reach of each other are in one class or in neighbouring ones (the base is a little above 1 / similarity)
    base = 1.01 * 100 / need.percent
    by_length = found.withColumn("span", F.floor(F.log(base, "n")).cast("int")).join(whole, "group")
    small = by_length.where(F.col("group_held") <= SLICE).select(
        F.xxhash64("group").alias("node"), F.lit(0).alias("side"), "key", "label", "n", "copies", "tokens")
    large = by_length.where(F.col("group_held") > SLICE)
    spans = large.groupBy("group", "span").agg(F.ceil(F.sum("held") / SLICE).cast("int").alias("parts"))
    beside = spans.select("group", (F.col("span") + 1).alias("span"), F.col("parts").alias("below"))
    above = spans.select("group", (F.col("span") - 1).alias("span"), F.col("parts").alias("above"))
    cut = large.join(spans.join(beside, ["group", "span"], "left").join(above, ["group", "span"], "left"), ["group", "span"])
    cut = cut.withColumn("slice", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int"))

    def pair(span, i, j, side):
        return F.struct(F.xxhash64("group", span, i, j).alias("node"), side.cast("int").alias("side"))
    # with slices of its own length class: (i, j), i <= j; with those of the next: (this, other); of the last: (other, this)
    same = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda t: pair(
        F.concat(F.col("span").cast("string"), F.lit("=")), F.least("slice", t), F.greatest("slice", t),
        F.when(F.col("slice") == t, F.lit(0)).when(F.col("slice") < t, F.lit(1)).otherwise(F.lit(2))))
    none = F.array().cast("array<struct<node:bigint,side:int>>")
    up = F.when(F.col("above").isNull(), none).otherwise(F.transform(F.sequence(F.lit(0), F.col("above") - 1), lambda t: pair(
        F.concat(F.col("span").cast("string"), F.lit("<")), F.col("slice"), t, F.lit(1))))
    down = F.when(F.col("below").isNull(), none).otherwise(F.transform(F.sequence(F.lit(0), F.col("below") - 1), lambda t: pair(
        F.concat((F.col("span") - 1).cast("string"), F.lit("<")), t, F.col("slice"), F.lit(2))))
    cut = cut.select(F.explode(F.concat(same, up, down)).alias("p"), "key", "label", "n", "copies", "tokens")
    return small.unionByName(cut.select("p.node", "p.side", "key", "label", "n", "copies", "tokens"))


def near_duplicates(docs: DataFrame, length: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, n_links, component_id) of every document: component_id is the smallest doc_id reachable over links
    of sets with a Jaccard similarity of at least ``percent`` / 100, itself included; n_links counts all other documents (rows with
    an id) that it links with, copies too.

    A-Z are read as a-z; shingles are ``length`` words, a shorter text is one shingle, a text without words (or null) has none
    and links with nothing. Documents with equal sets are in one component. A row with a null doc_id makes no links; it
    takes the component of its set if a document with an id has that set, else null. Repeated rows give one row each; an
    empty table gives none. Shingles are compared by 64-bit hashes, sets by 128-bit digests of them.
    """
    need = Need(percent)
    found = materialise(shared_sets(docs, length, need, id_col, text_col), "sets")
    reps = materialise(found.where("doc_id is not null and key is not null").groupBy("key").agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "copies")
    sets = materialise(found.where("tokens is not null").groupBy("key").agg(
        F.first("n").alias("n"), F.first("alone").alias("alone"), F.first("tokens").alias("tokens"))
        .withColumn("held", F.octet_length("tokens") / 8).join(reps.drop("rep"), "key"), "distinct")
    lists = sets.select("key", "n", "alone", "tokens").mapInArrow(lambda b: _short_lists(b, need), "token long, key binary")
    held = sets.select("key", "n", "held", "copies", "tokens")
    parts = max(shuffle_partitions(docs.sparkSession), int(held.agg(F.sum("held")).first()[0] or 0) // STAR)
    lists = materialise(lists, "lists")
    stars = materialise(_joined(_stars(lists, held, need), need, parts).where("v is not null").select("u", "v"), "star-links")  # one link of a set at most, v to its leader u
    labelled = lists.join(stars.select(F.col("v").alias("key"), F.col("u").alias("leader")), "key", "left").select(
        "token", "key", F.coalesce("leader", "key").alias("label"))
    mixed = labelled.groupBy("token").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a != b").select("token")
    open_ = materialise(labelled.join(mixed, "token", "left_semi"), "open")
    # two sets of one class meet in the class, two of different classes in the component of an open list
    work = [materialise(x, "groups") for x in (_classes(stars, held), _components(open_, held))]
    search = materialise(_joined(_tasks(work[0], need).unionByName(_tasks(work[1], need)), need, parts), "links")
    links = stars.unionByName(search.where("v is not null").select("u", "v"))

    classes = connected_components(links)
    linked = reps.join(classes, reps.key == classes.node).select("key", "component", "rep")
    least = linked.groupBy("component").agg(F.min("rep").alias("component_id"))
    n_links = search.where("v is null").groupBy(F.col("u").alias("key")).agg(F.sum("n").alias("n_links"))
    named = (reps.join(linked.join(least, "component").select("key", "component_id"), "key", "left").join(n_links, "key", "left")
             .select("key", F.coalesce("component_id", "rep").alias("component_id"),
                     (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    counted = F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(F.col("n_links"))
    full = found.where("key is not null").join(named, "key", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce(counted, F.lit(0)).cast("long").alias("n_links"), "component_id")
    return full.unionByName(found.where("key is null").select(
        "doc_id", F.col("n").alias("n_shingles"), F.lit(0).cast("long").alias("n_links"), F.col("doc_id").alias("component_id")))
