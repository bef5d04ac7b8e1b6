"""Filter interaction audit: what each filter removes, in every order of the filters.

A document's failures are a mask of filters. Documents are summed by (part, mask, quality, toxicity),
at most 4 x 2^f rows of a part, and the audit works on those sums alone. The mask matrix M has 0
where a mask fails a filter and infinity elsewhere; the position matrix P has, for each order, the
place of every filter (the inverse permutation). Their min-plus product

    R[mask, order] = min over filters of (M[mask, filter] + P[order, filter])

is the step at which documents of the mask are removed (infinity: never). Scattering the sums by R
gives what each step removes and loses; a mask that fails a step's filter and has a smaller R is
redundant there.

Copies are found by SHA-256 of the text: the smallest id of each digest is matched back on (digest,
id), so a text repeated a billion times makes no hot key.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwright.llm.common import bound_batches, materialise

#: Thresholds of the filters A to D (words, percent of distinct words, percent of capitals) and the symbols of D.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, SYMBOLS = 50, 65, 5, rb"[#$%&*|]"
FILTERS = "ABCDE"
_CAPITALS, _CONTINUATION = bytes(range(65, 91)), bytes(range(0x80, 0xC0))
_HAS_SYMBOL = re.compile(SYMBOLS).search


def failures(text: bytes) -> int:
    """Bits of the filters A to D that a text fails; split() of bytes splits at ASCII white space."""
    words = text.split()
    points = len(text.translate(None, _CONTINUATION))
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    return ((len(words) < LEAST_WORDS) | (100 * len(set(words)) < LEAST_DISTINCT * len(words)) << 1
            | (100 * capitals > MOST_CAPITALS * points) << 2 | (_HAS_SYMBOL(text) is not None) << 3)


def masks(docs: DataFrame, test: Callable[[bytes], int] = failures, n_tests: int = 4, part_col: str = "source",
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, part, mask, n): documents by id, part and failed filters; the filter after the ``n_tests`` of
    ``test`` is "identical to the text of a smaller id". Null ids are no smaller and have no smaller ones."""
    bound_batches(docs.sparkSession)
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"),
                       F.sha2(text, 256).alias("digest"), text.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            found = [test(t.as_buffer().to_pybytes()) for t in b.column(3)]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(found, pa.int32())],
                                             ["doc_id", "part", "digest", "mask"])
    rows = rows.mapInArrow(run, "doc_id long, part string, digest string, mask int")
    # read twice below: rows of one id and text are one row with their number
    rows = materialise(rows.groupBy("doc_id", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("n")), "masks")
    first = rows.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn(
        "first", F.lit(True))
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return rows.join(first, ["digest", "doc_id"], "left").select(
        "doc_id", "part", F.when(copy, F.col("mask") + F.lit(1 << n_tests)).otherwise(F.col("mask")).alias("mask"), "n")


def sums(masked: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic). Labels are (doc_id, quality, toxic); of repeated ids any 1 counts;
    ids without labels are neither good nor toxic."""
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("bad"))
    return masked.join(known, "doc_id", "left").groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good") == 1, F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("bad") == 1, F.col("n")).otherwise(0)).alias("toxic"))


class Orders:
    """All orders of ``n`` filters, and the removal step of every mask in each."""

    def __init__(self, n: int):
        self.orders = np.array(list(itertools.permutations(range(n))))  # filter at each step
        self.position = np.argsort(self.orders, axis=1)  # step of each filter
        self.fails = (np.arange(1 << n)[:, None] >> np.arange(n) & 1).astype(bool)
        never = np.where(self.fails, 0, n)  # n: no step, the infinity of these positions
        self.rank = np.minimum((never[:, None, :] + self.position[None, :, :]).min(axis=2), n)

    def scattered(self, weight: np.ndarray) -> np.ndarray:
        """[order, step]: weight of the masks removed there; the last column is what stays."""
        out = np.zeros((len(self.orders), self.orders.shape[1] + 1), dtype=np.int64)
        np.add.at(out, (np.arange(len(self.orders))[None, :], self.rank), weight[:, None])
        return out

    def audit(self, weight: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> dict[str, np.ndarray]:
        """Columns [order, step] of one part, from document sums by mask."""
        n = self.orders.shape[1]
        gone = self.scattered(weight)[:, :n]
        # failing[mask, order, step]: the mask fails the filter of that step
        failing = self.fails[:, self.orders]
        earlier = failing & (self.rank[:, :, None] < np.arange(n))
        alone = np.array([weight[1 << f] for f in range(n)])
        by_filter = np.take_along_axis(gone, self.position, axis=1).sum(axis=0)
        return {"kept": weight.sum() - np.cumsum(gone, axis=1), "removed": gone,
                "redundant": np.einsum("m,mos->os", weight, earlier.astype(np.int64)),
                "unique_fails": alone[self.orders], "good_lost": self.scattered(good)[:, :n],
                "toxic_lost": self.scattered(toxic)[:, :n], "shapley": by_filter[self.orders]}


COLUMNS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit(docs: DataFrame, labels: DataFrame, filters: str = FILTERS, test: Callable[[bytes], int] = failures,
          part_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley).

    One row per part, order of the filters and step, zeros included. kept: documents after the step; removed: here;
    redundant: failing the step's filter but removed earlier; unique_fails: failing this filter alone;
    good_lost and toxic_lost: labelled so and removed here; shapley: removed by the step's filter,
    summed over all orders. ``test`` gives the bits of all filters but the last, which is "copy of a smaller id".

    Null texts are empty; a null part is the empty string; repeated rows count as often as they occur. An
    empty table gives no rows.
    """
    masked = masks(docs, test, len(filters) - 1, part_col, id_col, text_col)
    by_part = sums(masked, labels).groupBy("part").agg(
        F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("sums"))  # at most 2^filters entries

    def run(batches: Iterator[pa.RecordBatch]):
        tables = Orders(len(filters))
        names = ["".join(filters[f] for f in o) for o in tables.orders]
        n = len(filters)
        for b in batches:
            for part, entries in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                weight = np.zeros((3, 1 << n), dtype=np.int64)
                for e in entries:
                    weight[:, e["mask"]] += (e["n"], e["good"], e["toxic"])
                found = tables.audit(*weight)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * (len(names) * n), pa.string()), pa.array(np.repeat(names, n), pa.string()),
                     pa.array(np.tile(np.arange(1, n + 1), len(names)), pa.int32()),
                     *[pa.array(found[c].ravel(), pa.int64()) for c in COLUMNS]],
                    ["part", "filter_order", "step", *COLUMNS])
    return by_part.mapInArrow(run, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COLUMNS))


def oracle_sql() -> str:
    """The query op11 in DuckDB's SQL."""
    letters = "(VALUES ('A'), ('B'), ('C'), ('D'), ('E'))"
    names = "abcde"
    order = " || ".join(f"{n}.f" for n in names)
    tables = ", ".join(f"{letters} {n}(f)" for n in names)
    apart = " AND ".join(f"{x}.f <> {y}.f" for x, y in itertools.combinations(names, 2))
    return f"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, max((quality = 1)::int) AS good, max((toxic = 1)::int) AS bad FROM labels GROUP BY doc_id),
d AS (SELECT row_number() OVER () AS rid, part, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad,
    CASE WHEN len(w) < {LEAST_WORDS} THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(w)) < {LEAST_DISTINCT} * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > {MOST_CAPITALS} * length(t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '{SYMBOLS.decode()}') THEN 'D' ELSE '' END
    || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails FROM t LEFT JOIN l USING (doc_id)),
m AS MATERIALIZED (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(bad) AS bad FROM d GROUP BY part, fails),
o AS MATERIALIZED (SELECT {order} AS o FROM {tables} WHERE {apart}),
s AS (SELECT part, o, step, o[step] AS f FROM (SELECT DISTINCT part FROM m), o, range(1, 6) r(step)),
g AS (SELECT s.part, s.o, s.step, s.f, n, good, bad, m.fails, list_min(list_transform(
    string_split(m.fails, ''), lambda x: CASE WHEN x = '' THEN 9 ELSE instr(s.o, x) END)) AS gone
    FROM s JOIN m ON s.part = m.part),
a AS MATERIALIZED (SELECT part, o, step, f, sum(CASE WHEN coalesce(gone, 9) > step THEN n ELSE 0 END)::bigint AS kept,
    sum(CASE WHEN gone = step THEN n ELSE 0 END)::bigint AS removed,
    sum(CASE WHEN gone < step AND contains(fails, f) THEN n ELSE 0 END)::bigint AS redundant,
    sum(CASE WHEN fails = f THEN n ELSE 0 END)::bigint AS unique_fails,
    sum(CASE WHEN gone = step THEN good ELSE 0 END)::bigint AS good_lost,
    sum(CASE WHEN gone = step THEN bad ELSE 0 END)::bigint AS toxic_lost FROM g GROUP BY part, o, step, f)
SELECT part, o AS filter_order, step::int AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, f)::bigint AS shapley FROM a"""
