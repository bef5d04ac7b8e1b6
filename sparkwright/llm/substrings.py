"""Substring dedup by prefix-partitioned suffix trees, truncated at the repeat length.

Every word position that has ``size`` words of its document ahead starts a suffix. Suffixes are
split into groups by a prefix of variable length: three words, and one more as long as the prefix
is frequent (an eighth of a group, or 1 / MOST_PREFIXES of all suffixes if that is more); groups are packed so that
one holds about ``GROUP`` suffixes and fits in memory. Prefixes are counted over the whole corpus: a slice leaves
out those below half that share of its own suffixes, so no frequent prefix loses more than half its count,
and the table keeps all that reach half the share in all, at most 2 MOST_PREFIXES of a length.

A group's subtree needs its nodes of depth ``size`` only, which decide here (repeats of at least
``size`` words): a node is a path of ``size`` words, and its leaves are the suffixes that start with them. Paths are
compared by their words. A node whose leaves come from several documents is a repeat; its smallest document keeps
the words, the suffixes of every other document there are marked. Runs of marked suffixes in a
document are its maximal repeats, and their words go.

How it is laid out: documents are dealt into blocks of about ``BLOCK`` bytes by a hash, and each
block builds its own nodes first, so it asks about a path once, however many copies it holds (a
path that a third of all documents share gives one row per block, not one per document). Words of all
paths would be ``size`` times the input, so a sieve goes first: a block sends each group one packed
row with ``BITS`` bits of each path and gets back which occur more than once there. Equal paths give equal
bits, so no repeat is lost, and others that pass by chance only cost their transport. The paths that
pass travel with their words and their smallest document, and the group's tree gives back one
bit each. The block then marks its suffixes and cuts the texts. Texts are shuffled once; all
three steps read that exchange.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwright.llm.common import Words, bound_batches, materialise, mix64, shuffle_partitions

#: Suffixes in a group, bytes of text in a block, frequent prefixes of one length (twice as many at most).
GROUP, BLOCK, MOST_PREFIXES = 2_000_000, 3_000_000, 16_384
#: Bytes of a word and its space, for the number of groups.
WORD = 6
SHORTEST = 3
#: Bits of a path that the sieve compares: many more values than a group has suffixes.
BITS = 28
#: Bytes of paths that a tree takes in at a time.
CHUNK = 64_000_000
_PATH, _PREFIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class Suffixes:
    """Suffixes of a list of texts: places of their first words, paths and group prefixes."""

    def __init__(self, texts: list[str], size: int, use: np.ndarray | None = None):
        self.words = w = Words(texts)
        self.hash, self.size = w.hashes(), size
        at = np.arange(max(0, len(w) - size + 1))
        ok = w.text[at] == w.text[at + size - 1]
        if use is not None:
            ok &= use[w.text[at]]
        self.at = at[ok]
        self.text = w.text[self.at]

    def path(self) -> np.ndarray:
        h = np.zeros(len(self.at), dtype=np.uint64)
        for k in range(self.size):
            h = h * _PATH + self.hash[self.at + k]
        return mix64(h)

    def nodes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(path hash, first suffix) of each distinct path, and the path of each suffix. Suffixes
        with one hash are compared word by word; those that differ become paths of their own."""
        path = self.path()
        _, first, of = np.unique(path, return_index=True, return_inverse=True)
        word = np.asarray(self.words.spaced()[0].dictionary_encode().indices)
        again = np.ones(len(path), dtype=bool)
        again[first] = False
        again = np.flatnonzero(again)
        here, there = self.at[again], self.at[first[of[again]]]
        differ = np.zeros(len(again), dtype=bool)
        for k in range(self.size):
            differ |= word[here + k] != word[there + k]
        if differ.any():
            rows = np.flatnonzero(np.isin(of, of[again[differ]]))
            inside = np.unique(word[self.at[rows][:, None] + np.arange(self.size)], axis=0, return_inverse=True)[1]
            of[rows] = len(first) + inside.ravel()
            _, first, of = np.unique(of, return_index=True, return_inverse=True)
        return path[first], first, of

    def prefixes(self, among: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, rows, prefix hashes) from SHORTEST words to ``size``; the caller sends back
        which of these rows go on to the next length."""
        rows = np.arange(len(self.at)) if among is None else among
        h = np.zeros(len(rows), dtype=np.uint64)
        for k in range(min(SHORTEST, self.size) - 1):
            h = h * _PREFIX + self.hash[self.at[rows] + k]
        for length in range(min(SHORTEST, self.size), self.size + 1):
            h = h * _PREFIX + self.hash[self.at[rows] + length - 1]
            more = yield length, rows, mix64(h)
            rows, h = rows[more], h[more]
            if not len(rows):
                return


def _count(batches: Iterator[pa.RecordBatch], size: int, share: float) -> Iterator[pa.RecordBatch]:
    """(length, prefix, n) for prefixes with more than half the share of a slice; length 0 counts suffixes."""
    for b in batches:
        for at in range(0, b.num_rows, step := max(1, int(b.num_rows * 2 * BLOCK / max(1, b.nbytes)))):
            s = Suffixes(b.slice(at, step).column(1).to_pylist(), size)
            lengths, keys, counts = [0], [0], [len(s.at)]
            walk, more = s.prefixes(), None
            while len(s.at):
                try:
                    length, rows, h = walk.send(more)
                except StopIteration:
                    break
                u, inv, n = np.unique(h, return_inverse=True, return_counts=True)
                often = n > len(s.at) * share / 2
                lengths += [length] * int(often.sum())
                keys += u[often].view(np.int64).tolist()
                counts += n[often].tolist()
                more = often[inv]
            yield pa.RecordBatch.from_arrays(
                [pa.array(lengths, pa.int32()), pa.array(keys, pa.int64()), pa.array(counts, pa.int64())],
                ["length", "prefix", "n"])


def prefix_table(texts: DataFrame, size: int, share: float) -> dict[int, np.ndarray]:
    """Prefixes by length, over all documents: all that start at least ``share`` of the suffixes, none that
    starts under half of that (so at most 2 / share of a length)."""
    if share > 1:
        return {}
    counted = materialise(texts.mapInArrow(lambda b: _count(b, size, share), "length int, prefix long, n long")
                          .groupBy("length", "prefix").agg(F.sum("n").alias("n")), "prefixes")
    n = counted.where("length = 0").agg(F.sum("n")).first()[0] or 0
    table: dict[int, list[int]] = {}
    for r in counted.where((F.col("length") > 0) & (F.col("n") >= n * share / 2)).collect():
        table.setdefault(r.length, []).append(r.prefix)
    return {k: np.sort(np.array(v, dtype=np.int64).view(np.uint64)) for k, v in table.items()}


def _among(values: np.ndarray, table: np.ndarray | None) -> np.ndarray:
    if table is None or not len(table):
        return np.zeros(len(values), dtype=bool)
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values


class Block:
    """The distinct paths of a block of documents, each with the block's smallest document and its
    prefix group; ``order`` lists them by (group, ``BITS`` bits of the path), the order of the packed rows.

    Every step builds the block anew, and an exchange may hand over its rows in another order each time. Answers are
    matched to paths by their order, so that goes by ``place``: where a path would first stand if the rows were sorted."""

    def __init__(self, rows: pa.Table, size: int, table: dict[int, np.ndarray], groups: int):
        self.ids = rows.column("doc_id").combine_chunks()
        self.known = ~np.asarray(self.ids.is_null())
        self.number = np.asarray(self.ids.fill_null(0)).astype(np.int64)
        self.texts = rows.column("text").to_pylist()
        self.s = s = Suffixes(self.texts, size, self.known)
        owner = self.number[s.text]
        path, first, self.of = s.nodes()
        self.first, self.finger = s.at[first], path >> np.uint64(64 - BITS)
        self.least, self.place = (np.full(len(first), np.iinfo(np.int64).max) for _ in range(2))
        np.minimum.at(self.least, self.of, owner)
        np.minimum.at(self.place, self.of, s.at + self._moved()[s.text])
        group = np.zeros(len(first), dtype=np.uint64)
        walk, more = s.prefixes(first), None
        where = np.arange(len(first))
        while len(first):
            try:
                length, _, h = walk.send(more)
            except StopIteration:
                break
            where = where if more is None else where[more]
            group[where] = h
            more = _among(h, table.get(length))
        group %= np.uint64(groups)
        key = group << np.uint64(BITS) | self.finger
        self.order = np.argsort(key, kind="stable")
        same = np.diff(key[self.order]) == 0
        tied = np.flatnonzero(np.r_[False, same] | np.r_[same, False]) if len(key) else np.zeros(0, dtype=np.int64)
        rows = self.order[tied]
        self.order[tied] = rows[np.lexsort((self.place[rows], key[rows]))]
        g = group[self.order].astype(np.int64)
        cut = np.flatnonzero(np.diff(g, prepend=-1, append=np.iinfo(np.int64).max))
        #: group: its part of ``order``
        self.parts = {int(g[a]): self.order[a:b] for a, b in zip(cut[:-1], cut[1:])}

    def _moved(self) -> np.ndarray:
        """How far the words of each row move if the rows are sorted by document and text."""
        order = np.array(sorted(range(len(self.texts)), key=lambda k: (not self.known[k], self.number[k], self.texts[k])), dtype=np.int64)
        first = self.s.words.first
        begin = np.empty(len(order), dtype=np.int64)
        begin[order] = np.cumsum(np.r_[0, np.diff(first)[order]])[:-1]
        return begin - first[:-1]

    def sieved(self) -> Iterator[tuple[int, bytes]]:
        """(group, ``BITS`` bits of each path), sorted, as differences."""
        for g, rows in self.parts.items():
            yield g, packed(planes(np.diff(self.finger[rows].astype(np.int64), prepend=0), 4), 1)

    def _passed(self, g: int, among: bytes) -> np.ndarray:
        """The group's paths that passed the sieve, by (smallest document, place)."""
        rows = self.parts[g]
        rows = rows[np.unpackbits(np.frombuffer(among, dtype=np.uint8), count=len(rows)).astype(bool)]
        return rows[np.lexsort((self.place[rows], self.least[rows]))]

    def told(self, sieve: dict[int, bytes]) -> Iterator[tuple[int, bytes, bytes, bytes, bytes]]:
        """(group, which paths passed, documents, paths of each, words of the paths)
        with documents as differences, in byte planes (small numbers leave planes of zeros, which
        compress away). Every word of a path has a space behind it."""
        _, begin, data = self.s.words.spaced()
        for g, among in sieve.items():
            rows = self._passed(g, among)
            if not len(rows):
                continue
            d = self.least[rows]
            run = np.flatnonzero(np.r_[True, d[1:] != d[:-1]])
            at = self.first[rows]
            words = b"".join([data[a:b] for a, b in zip(begin[at].tolist(), begin[at + self.s.size].tolist())])
            yield (g, among, planes(np.diff(d[run], prepend=0)), planes(np.diff(np.r_[run, len(rows)])),
                   packed(words, 6))

    def marked(self, answers: dict[int, tuple[bytes, bytes]]) -> np.ndarray:
        """Which suffixes go: those whose path starts in a smaller document. ``answers``: of each
        group, which paths passed and which of these start in a smaller document of another block."""
        bits = np.zeros(len(self.first), dtype=bool)
        for g, (among, later) in answers.items():
            rows = self._passed(g, among)
            bits[rows] = np.unpackbits(np.frombuffer(later, dtype=np.uint8), count=len(rows)).astype(bool)
        return bits[self.of] | (self.number[self.s.text] > self.least[self.of])

    def covered(self, marked: np.ndarray) -> np.ndarray:
        """Words covered by a marked suffix's first ``size`` words."""
        step = np.zeros(len(self.s.words) + 1, dtype=np.int32)
        np.add.at(step, self.s.at[marked], 1)
        np.add.at(step, self.s.at[marked] + self.s.size, -1)
        return np.cumsum(step[:-1]) > 0


def packed(data: bytes, level: int) -> bytes:
    return len(data).to_bytes(8, "little") + pa.Codec("zstd", level).compress(data, asbytes=True)


def unpacked(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def planes(values: np.ndarray, width: int = 8) -> bytes:
    return np.ascontiguousarray(values.astype(f"<i{width}")).view(np.uint8).reshape(-1, width).T.tobytes()


def unplanes(data: bytes, width: int = 8) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(f"<i{width}").ravel()


def sieve(rows: pa.Table) -> pa.Table:
    """One group: for every path of every block, whether its ``BITS`` bits occur more than once."""
    fingers = [np.cumsum(unplanes(unpacked(x), 4)) for x in rows.column("fingers").to_pylist()]
    sizes = list(map(len, fingers))
    finger = np.concatenate(fingers)
    del fingers
    order = np.argsort(finger)
    leaf = finger[order]
    same = leaf[1:] == leaf[:-1]
    more = np.empty(len(finger), dtype=bool)
    more[order] = np.r_[False, same] | np.r_[same, False]
    ends = np.cumsum(sizes)
    bits = [np.packbits(more[e - n:e]).tobytes() for e, n in zip(ends, sizes)]
    return pa.table({"block": rows.column("block"), "part": rows.column("part"), "among": pa.array(bits, pa.binary())})


class Tree:
    """Nodes of depth ``size`` by the words of their paths. Paths come in chunks; only distinct
    ones are kept, in order of arrival, so a node keeps its number."""

    def __init__(self, size: int):
        self.size, self.paths = size, pa.array([], pa.large_binary())
        self.wait: list[pa.Array] = []
        self.wait_bytes, self.codes = 0, []

    def add(self, words: bytes) -> None:
        spaces = np.flatnonzero(np.frombuffer(words, dtype=np.uint8) == 0x20)
        ends = np.r_[0, spaces[self.size - 1::self.size] + 1].astype(np.int64)
        self.wait.append(pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(words)]))
        self.wait_bytes += len(words)
        if self.wait_bytes > CHUNK:
            self.take_in()

    def take_in(self) -> None:
        known = len(self.paths)
        coded = pa.concat_arrays([self.paths, *self.wait]).dictionary_encode()
        self.paths, self.wait, self.wait_bytes = coded.dictionary, [], 0
        self.codes.append(np.asarray(coded.indices)[known:].astype(np.int32))

    def nodes(self) -> np.ndarray:
        """The node of every path added, in order."""
        self.take_in()
        return np.concatenate(self.codes)


def answers(rows: pa.Table, size: int) -> pa.Table:
    """One group: for every path of every block, whether a smaller document has it."""
    tree, owners, sizes = Tree(size), [], []
    for docs, counts, words in zip(*(rows.column(c).to_pylist() for c in ("documents", "counts", "words"))):
        tree.add(unpacked(words))
        owners.append(np.repeat(np.cumsum(unplanes(docs)), unplanes(counts)))
        sizes.append(len(owners[-1]))
    node, owner = tree.nodes(), np.concatenate(owners)
    least = np.full(len(tree.paths), np.iinfo(np.int64).max)
    np.minimum.at(least, node, owner)
    later = owner > least[node]
    ends = np.cumsum(sizes)
    bits = [np.packbits(later[e - n:e]).tobytes() for e, n in zip(ends, sizes)]
    return pa.table({"block": rows.column("block"), "part": rows.column("part"), "among": rows.column("among"),
                     "later": pa.array(bits, pa.binary())})


def remove_repeats(docs: DataFrame, size: int = 13, keep_layout: bool = False,
                   id_col: str = "doc_id", text_col: str = "text",
                   carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_words, n_removed, spans, text): words covered by a run of ``size`` words that
    also starts in a document with a smaller id are removed; judged on the input, not on what is
    left. ``spans`` lists the removed ranges (first word, number of words). ``text`` holds the kept
    words joined by one space, or with ``keep_layout`` the text with the removed words (and the
    white space after each) cut out, unchanged if none is.

    Null texts have no words. A document with a null id stays whole and removes nothing from
    others. Rows of one id do not remove words from one another. Copies of a row are judged alike.
    An empty table gives no rows. Other columns are left behind, but for those in ``carry``.
    """
    bound_batches(docs.sparkSession)
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
                        *[F.col(f"`{c}`").alias(f"carry_{k}") for k, c in enumerate(carry)])
    n_bytes = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    table = prefix_table(texts.select("doc_id", "text"), size, max(GROUP / 8 / max(1, n_bytes / WORD), 1 / MOST_PREFIXES))
    parts = shuffle_partitions(docs.sparkSession)
    groups, blocks = max(parts, -(-n_bytes // (GROUP * WORD))), max(parts, -(-n_bytes // BLOCK))
    dealt = texts.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))

    def ask(rows: pa.Table) -> pa.Table:
        out = list(Block(rows, size, table, groups).sieved())
        return pa.table({"block": pa.array([rows.column("block")[0].as_py()] * len(out), pa.int32()),
                         "part": pa.array([x[0] for x in out], pa.int32()),
                         "fingers": pa.array([x[1] for x in out], pa.binary())})

    def tell(rows: pa.Table, replies: pa.Table) -> pa.Table:
        out = list(Block(rows, size, table, groups).told(dict(zip(*(replies.column(c).to_pylist() for c in ("part", "among"))))))
        names = ("part", "among", "documents", "counts", "words")
        kinds = (pa.int32(), *[pa.binary()] * 4)
        return pa.table({"block": pa.array([rows.column("block")[0].as_py()] * len(out), pa.int32())}
                        | {c: pa.array([x[k] for x in out], kind) for k, (c, kind) in enumerate(zip(names, kinds))})

    def decide(rows: pa.Table) -> pa.Table:
        return answers(rows, size)

    def cut(rows: pa.Table, replies: pa.Table) -> pa.Table:
        b = Block(rows, size, table, groups)
        part, among, later = (replies.column(c).to_pylist() for c in ("part", "among", "later"))
        gone = b.covered(b.marked(dict(zip(part, zip(among, later)))))
        w, n_words, n_gone, spans, kept = b.s.words, [], [], [], []
        total = np.r_[0, np.cumsum(gone)]
        for i, text in enumerate(b.texts):
            lo, hi = int(w.first[i]), int(w.first[i + 1])
            out = int(total[hi] - total[lo])
            n_words.append(hi - lo)
            n_gone.append(out)
            g = gone[lo:hi]
            edge = np.flatnonzero(np.diff(g.view(np.int8), prepend=0, append=0)) if out else ()
            spans.append([{"first_word": int(x), "words": int(y - x)} for x, y in zip(edge[::2], edge[1::2])])
            if keep_layout and not out:
                kept.append(text)
            elif keep_layout:
                begin = w.start[lo:hi]
                after = np.r_[begin[1:], w.base[i + 1] - 1]
                kept.append((w.data[w.base[i]:begin[0]] + b"".join(
                    w.data[x:y] for x, y in zip(begin[~g], after[~g]))).decode("utf-8"))
            else:
                own = w.data[w.base[i]:w.base[i + 1]].split()
                kept.append(b" ".join([own[k] for k in np.flatnonzero(~g)] if out else own).decode("utf-8"))
        return pa.table({"doc_id": b.ids, "n_words": pa.array(n_words, pa.int64()),
                         "n_removed": pa.array(n_gone, pa.int64()),
                         "spans": pa.array(spans, pa.list_(pa.struct([("first_word", pa.int64()),
                                                                      ("words", pa.int64())]))),
                         "text": pa.array(kept, pa.string())}
                        | {f"carry_{k}": rows.column(f"carry_{k}") for k in range(len(carry))})

    asked = dealt.groupBy("block").applyInArrow(ask, "block int, part int, fingers binary")
    passed = asked.groupBy("part").applyInArrow(sieve, "block int, part int, among binary")
    told = dealt.groupBy("block").cogroup(passed.groupBy("block")).applyInArrow(
        tell, "block int, part int, among binary, documents binary, counts binary, words binary")
    replies = told.groupBy("part").applyInArrow(decide, "block int, part int, among binary, later binary")
    kinds = "".join(f", carry_{k} {texts.schema[f'carry_{k}'].dataType.simpleString()}" for k in range(len(carry)))
    out = dealt.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(
        cut, "doc_id long, n_words long, n_removed long, "
             "spans array<struct<first_word: bigint, words: bigint>>, text string" + kinds)
    return out.withColumnsRenamed({f"carry_{k}": c for k, c in enumerate(carry)})
