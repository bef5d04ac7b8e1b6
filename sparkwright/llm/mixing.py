"""Mixing sources to target weights by iterative proportional fitting (raking).

Token totals of all documents are summed into cells (source, language, topic). The tokens to draw of
each cell are raked: scaled in turn so that their marginals meet the targets of each dimension,
sweep after sweep. No cell gives more tokens than it has (:func:`fill`): a cell that would is kept
whole and the others of its value are scaled further. A document is kept with the probability of its
cell by a hash of its id, so the draw is repeatable and needs no order.

The budget (share of all tokens to draw) is kept whatever the targets are:

* a value whose target is more than it has gives all it has, and the other values of its dimension
  share the rest in proportion to their targets (:func:`needs`; :func:`report` lists what is missed);
* every sweep ends with a scaling of the whole table to the budget, so targets that no draw meets
  together (or cells too small for them) cost weights, not tokens;
* only values with target zero can lower it: what the other cells have is then the most.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkwright.llm.common import SPACE_WORDS, materialise

DIMENSIONS = ("source", "lang", "topic")
#: Share of all tokens to draw; power that tempers the observed marginals into targets; sweeps.
BUDGET, POWER, SWEEPS = 0.7, 0.7, 300
#: Cells up to which the cell table is raked on the driver and broadcast (counted first; above,
#: the same sweeps run as aggregates and joins, until a sweep changes no cell by more than CLOSE of it).
MOST_CELLS, CLOSE = 100_000, 1e-7

#: Topics by the first pattern found in the lower-cased text; no pattern: prose.
TOPICS = (("legal", r"license|copyright|rights reserved|public domain"),
          ("contact", r"[a-z0-9._-]+@[a-z0-9-]+[.][a-z]|\+?[0-9][0-9 ()-]{7,}[0-9]"),
          ("table", r"[|].*[|]"),
          ("markup", r"[#*$%&]{3}"))


def topic_of(text: Column) -> Column:
    out, low = F.lit("prose"), F.lower(text)
    for name, pattern in reversed(TOPICS):
        out = F.when(low.rlike(pattern), F.lit(name)).otherwise(out)
    return out


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, source, lang, topic, n_tokens): tokens are words and one end mark; null source or
    language is the value '(none)'; a null text is empty."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), *_keys(text))


def _keys(text: Column) -> list[Column]:
    words = F.regexp_count(text, F.lit(SPACE_WORDS)).cast("long")
    return [F.coalesce(F.col("source").cast("string"), F.lit("(none)")).alias("source"),
            F.coalesce(F.col("lang").cast("string"), F.lit("(none)")).alias("lang"),
            topic_of(text).alias("topic"), (words + 1).alias("n_tokens")]


def tempered(cells: DataFrame, dimension: str, power: float = POWER) -> DataFrame:
    """Target shares of a dimension: observed tokens to the given power, made to sum to 1."""
    t = cells.groupBy(dimension).agg(F.sum("tokens").alias("t")).select(
        dimension, F.pow(F.col("t").cast("double"), F.lit(power)).alias("target"))
    whole = t.agg(F.sum("target")).first()[0] or 1.0
    return t.select(dimension, (F.col("target") / F.lit(whole)).alias("target"))


def fill(tokens: np.ndarray, mass: np.ndarray, need: np.ndarray, code: np.ndarray) -> np.ndarray:
    """min(tokens, factor * mass) with one factor per group ``code`` so that group g sums to
    need[g] (or to all its tokens, if it has less)."""
    full = np.zeros(len(mass), dtype=bool)
    groups = len(need)
    while True:
        left = need - np.bincount(code, weights=np.where(full, tokens, 0), minlength=groups)
        open_ = np.bincount(code, weights=np.where(full, 0, mass), minlength=groups)
        factor = np.divide(left, open_, out=np.zeros(groups), where=open_ > 0)
        more = ~full & (factor[code] * mass > tokens)
        if not more.any():
            return np.where(full, tokens, factor[code] * mass)
        full |= more


def needs(own: np.ndarray, target: np.ndarray, whole: float) -> np.ndarray:
    """Tokens to draw of each value of a dimension: in proportion to the targets, none above what
    the value has; together ``whole``."""
    return fill(own, target, np.array([whole]), np.zeros(len(own), dtype=np.int64))


class Cells:
    """The cell table on the driver and the targets of each dimension's values that occur in it
    (made to sum to 1; values without a target have 0, and nothing is drawn of their cells)."""

    def __init__(self, cells: DataFrame, targets: dict[str, DataFrame]):
        self.table = cells.select(*DIMENSIONS, F.col("tokens").cast("long")).toArrow()
        self.tokens = self.table.column("tokens").to_numpy().astype(np.float64)
        self.codes, self.targets, self.values = [], [], []
        for d in targets:
            values = self.table.column(d).combine_chunks().dictionary_encode()
            given = {r[d]: float(r["target"] or 0) for r in targets[d].select(d, "target").collect()}
            target = np.array([given.get(v, 0.0) for v in values.dictionary.to_pylist()])
            if len(target) and not target.sum() > 0:
                raise ValueError(f"no value of {d} that occurs has a target")
            self.codes.append(values.indices.to_numpy(zero_copy_only=False).astype(np.int64))
            self.targets.append(target / target.sum())
            self.values.append(values.dictionary.to_pylist())
        self.usable = np.ones(len(self.tokens), dtype=bool)
        for code, target in zip(self.codes, self.targets):
            self.usable &= target[code] > 0
        self.has = np.where(self.usable, self.tokens, 0.0)

    def needs(self, budget: float) -> list[np.ndarray]:
        whole = min(budget * self.tokens.sum(), self.has.sum())
        return [needs(np.bincount(c, weights=self.has, minlength=len(t)), t, whole)
                for c, t in zip(self.codes, self.targets)]

    def drawn(self, budget: float, sweeps: int = SWEEPS) -> np.ndarray:
        """Tokens to draw of each cell."""
        whole = np.array([min(budget * self.tokens.sum(), self.has.sum())])
        wanted = self.needs(budget)
        mass, one = self.has, np.zeros(len(self.has), dtype=np.int64)
        for _ in range(sweeps):
            for code, need in zip(self.codes, wanted):
                mass = fill(self.has, mass, need, code)
            mass = fill(self.has, mass, whole, one)
        return mass

    def probabilities(self, budget: float) -> np.ndarray:
        return np.minimum(1.0, self.drawn(budget) / self.tokens) if len(self.tokens) else self.tokens


def _fill_far(cells: DataFrame, by: str) -> DataFrame:
    """:func:`fill` on a table (..., ``by``, tokens, mass, need_<by>): each step sums by group."""
    factors = None
    while True:
        if factors is None:
            now = cells.withColumn("_f", F.lit(0.0))
        else:
            now = cells.join(factors, by)
        full = F.col("_f") * F.col("mass") > F.col("tokens")
        sums = now.groupBy(by, "_f").agg(
            F.first(f"need_{by}").alias("need"), F.sum(F.when(full, F.col("tokens")).otherwise(0.0)).alias("whole"),
            F.sum(F.when(full, F.lit(0.0)).otherwise(F.col("mass"))).alias("open"))
        # a group that is whole keeps its factor; factors only grow
        new = F.when(F.col("open") > 0, (F.col("need") - F.col("whole")) / F.col("open")).otherwise(F.col("_f"))
        step = materialise(sums.select(by, "_f", F.greatest(new, F.col("_f")).alias("_g")), "factors")
        factors = step.select(by, F.col("_g").alias("_f"))
        if step.where("_g > _f * (1 + 1e-13)").limit(1).count() == 0:
            out = cells.join(factors, by).withColumn("mass", F.least("tokens", F.col("_f") * F.col("mass")))
            return materialise(out.drop("_f"), "cells")


def _probabilities_far(cells: DataFrame, targets: dict[str, DataFrame], budget: float) -> DataFrame:
    """The sweeps over a cell table too large for the driver, as aggregates and joins of tables."""
    now = cells.select(*DIMENSIONS, F.col("tokens").cast("double").alias("tokens"))
    everything = now.agg(F.sum("tokens")).first()[0]
    for d, t in targets.items():
        now = now.join(t.select(d, F.col("target").cast("double").alias(f"target_{d}")).where(f"target_{d} > 0"), d)
    now = materialise(now, "usable")
    whole = min(budget * everything, now.agg(F.sum("tokens")).first()[0])
    wanted = now.withColumn("all", F.lit(0)).withColumn("need_all", F.lit(whole))
    for d in targets:
        own = now.groupBy(d).agg(F.sum("tokens").alias("tokens"), F.first(f"target_{d}").alias("mass"))
        need = _fill_far(own.withColumn("all", F.lit(0)).withColumn("need_all", F.lit(whole)), "all")
        wanted = wanted.join(need.select(d, F.col("mass").alias(f"need_{d}")), d)
    now = materialise(wanted.withColumn("mass", F.col("tokens")), "cells")
    for _ in range(SWEEPS):
        before = now
        for by in [*targets, "all"]:
            now = _fill_far(now, by)
        moved = now.join(before.select(*DIMENSIONS, F.col("mass").alias("was")), list(DIMENSIONS))
        if moved.where(F.abs(F.col("mass") - F.col("was")) > CLOSE * F.col("was")).limit(1).count() == 0:
            break
    found = now.select(*DIMENSIONS, F.least(F.lit(1.0), F.col("mass") / F.col("tokens")).alias("probability"))
    return cells.select(*DIMENSIONS).join(found, list(DIMENSIONS), "left").na.fill(0.0, ["probability"])


def cells_of(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens"))


def probabilities(rows: DataFrame, targets: dict[str, DataFrame] | None = None, budget: float = BUDGET) -> DataFrame:
    """(source, lang, topic, probability) of every cell of ``rows`` (as :func:`keyed` gives them).

    The drawn tokens are ``budget`` of all tokens. ``targets`` (dimension -> rows (value, target)) are
    met as far as the cells allow; they default to the tempered marginals of ``rows`` themselves.
    """
    cells = materialise(cells_of(rows), "cells")
    if targets is None:
        targets = {d: tempered(cells, d) for d in DIMENSIONS}
    if cells.count() > MOST_CELLS:
        return materialise(_probabilities_far(cells, targets, budget), "probabilities")
    table = Cells(cells, targets)
    found = table.table.select(list(DIMENSIONS)).append_column(
        "probability", pa.array(table.probabilities(budget), pa.float64()))
    return rows.sparkSession.createDataFrame(found)


def report(rows: DataFrame, cells: DataFrame, targets: dict[str, DataFrame] | None = None) -> DataFrame:
    """(dimension, value, tokens, target, drawn, missed): expected share of the draw of each value
    beside its target, and target minus drawn share; ``cells`` as :func:`probabilities` gives them."""
    drawn = materialise(with_probability(rows, cells).groupBy(*DIMENSIONS).agg(
        F.sum("n_tokens").alias("tokens"), F.sum(F.col("n_tokens") * F.col("probability")).alias("mass")), "drawn")
    whole = drawn.agg(F.sum("mass")).first()[0] or 1.0
    out = None
    for d in DIMENSIONS:
        target = (targets or {}).get(d)
        target = tempered(drawn, d) if target is None else target.select(d, "target")
        part = drawn.groupBy(d).agg(F.sum("tokens").alias("tokens"), (F.sum("mass") / F.lit(whole)).alias("drawn")).join(
            target, d, "left").select(F.lit(d).alias("dimension"), F.col(d).alias("value"), "tokens",
                                      F.coalesce("target", F.lit(0.0)).alias("target"), "drawn")
        out = part if out is None else out.unionByName(part)
    return out.withColumn("missed", F.col("target") - F.col("drawn"))


def draw(doc_id: Column) -> Column:
    """Uniform in [0, 1) from the id (52 bits of an MD5); null ids draw alike."""
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":mix"))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(16**13))


def with_probability(rows: DataFrame, cells: DataFrame) -> DataFrame:
    small = cells.count() <= MOST_CELLS
    return rows.join(F.broadcast(cells) if small else cells, list(DIMENSIONS))


def sample(docs: DataFrame, targets: dict[str, DataFrame] | None = None, budget: float = BUDGET) -> DataFrame:
    """(doc_id, source, lang, topic, n_tokens, probability, selected) of every document.

    Repeated ids of one cell are drawn alike; an empty table gives no rows.
    """
    rows = materialise(keyed(docs), "keyed")  # read twice: once for the cells, once for the draw
    return with_probability(rows, probabilities(rows, targets, budget)).withColumn(
        "selected", draw(F.col("doc_id")) < F.col("probability"))


def keep_sampled(docs: DataFrame, targets: dict[str, DataFrame] | None = None, budget: float = BUDGET) -> DataFrame:
    """The drawn rows of ``docs``, all columns as they are."""
    own = docs.columns
    cells = probabilities(keyed(docs), targets, budget).select(
        *[F.col(d).alias(f"__{d}") for d in DIMENSIONS], "probability")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("__row"), *[
        k.alias(f"__{d}") for d, k in zip(DIMENSIONS, _keys(text))])
    small = cells.count() <= MOST_CELLS
    joined = marked.join(F.broadcast(cells) if small else cells, [f"__{d}" for d in DIMENSIONS])
    return joined.where(draw(F.col("__row.doc_id")) < F.col("probability")).select("__row.*")


def oracle_sql(budget: float = BUDGET, power: float = POWER, sweeps: int = SWEEPS) -> str:
    """The query op9 in DuckDB's SQL. A group's factor is the largest of the factors with its first
    0, 1, 2, ... rows (by share already drawn) kept whole: it grows while the next row would go above its tokens, and
    falls afterwards."""
    topic = "'prose'"
    for name, pattern in reversed(TOPICS):
        topic = f"CASE WHEN regexp_matches(lower(t), '{pattern}') THEN '{name}' ELSE {topic} END"
    dims = ", ".join(DIMENSIONS)

    def filled(table: str, by: str, key: str, need: str) -> str:
        order = f"PARTITION BY {by} ORDER BY mass / tokens DESC, {key}"
        return (f"(SELECT * EXCLUDE (f, mass), least(tokens, mass * max(f) OVER (PARTITION BY {by})) AS mass FROM (SELECT *, "
                f"({need} - coalesce(sum(tokens) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) "
                f"/ sum(mass) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS f FROM {table}))")

    targets = [f"s_{d} AS (SELECT 0 AS one, {d}, sum(tokens) AS tokens, pow(sum(tokens), {power}) AS mass, {budget}::double * any_value(everything) AS whole "
               f"FROM cells GROUP BY {d}), need_{d} AS MATERIALIZED (SELECT {d}, mass AS need_{d} FROM {filled(f's_{d}', 'one', d, 'whole')})"
               for d in DIMENSIONS]
    sweep = "it"
    for d in DIMENSIONS:
        sweep = filled(sweep, d, dims, f"need_{d}")
    sweep = filled(sweep, "one", dims, "whole")
    columns = f"k, one, {dims}, tokens, whole, {', '.join(f'need_{d}' for d in DIMENSIONS)}, mass"
    return f"""
WITH RECURSIVE k AS (SELECT doc_id, coalesce(source, '(none)') AS source, coalesce(lang, '(none)') AS lang, {topic} AS topic,
                  len(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+'))::bigint + 1 AS n_tokens
           FROM (SELECT *, coalesce(text, '') AS t FROM documents)),
cells AS MATERIALIZED (SELECT *, sum(tokens) OVER () AS everything FROM (
    SELECT {dims}, sum(n_tokens)::double AS tokens FROM k GROUP BY {dims})),
{", ".join(targets)},
it AS (SELECT 0 AS k, 0 AS one, {dims}, tokens, {budget}::double * everything AS whole, {', '.join(f'need_{d}' for d in DIMENSIONS)}, tokens AS mass
       FROM cells {' '.join(f'JOIN need_{d} USING ({d})' for d in DIMENSIONS)}
       UNION ALL SELECT {columns.replace('k, ', 'k + 1, ', 1)} FROM {sweep} WHERE k < {sweeps}),
p AS (SELECT {dims}, least(1.0::double, mass / tokens) AS probability FROM it WHERE k = {sweeps})
SELECT doc_id, {dims}, n_tokens, round(probability, 9) AS probability,
       ('0x' || substr(md5(coalesce(doc_id::varchar, '') || ':mix'), 1, 13))::bigint::double / {16**13}::double < probability AS selected
FROM k JOIN p USING ({dims})"""
