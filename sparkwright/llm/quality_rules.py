"""Quality rules: a threshold table compiled into one Spark projection, without user functions.

Every metric is a built-in expression over the text of its row; every rule is one line of
:data:`RULES` (metric, least, most). :func:`apply_rules` compiles the table into conditions; no
row leaves its task (no shuffle).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
#: Words in a repeated window.
WINDOW = 8

#: Common words of the supported languages (fixed values, compared as written).
STOP_WORDS = ("the", "of", "and", "to", "a", "in", "is", "that", "for", "it",
              "der", "die", "das", "und", "von", "ist", "mit", "den", "für", "ein",
              "le", "la", "les", "de", "et", "des", "un", "une", "est", "pour",
              "el", "los", "las", "que", "y", "en", "por", "con", "no", "al")


@dataclass(frozen=True)
class Rule:
    """A document passes if least <= metric <= most (None: no bound)."""
    name: str
    metric: str
    least: float | None = None
    most: float | None = None


#: The threshold table. Ratios are per word or per line with a word.
RULES = (
    Rule("too_short", "n_words", 20, None),
    Rule("repeated_words", "100 * n_repeat_words - 30 * n_words", None, 0),
    Rule("word_length", "word_chars / n_words", 2.0, 16.0),
    Rule("symbols", "n_symbols / n_words", None, 0.10),
    Rule("exclamations", "n_exclaims / n_words", None, 0.30),
    Rule("stop_words", "n_stop_kinds", 1, None),
    Rule("duplicate_lines", "n_dup_lines / n_lines", None, 0.50),
    Rule("bullet_lines", "n_bullet_lines / n_lines", None, 0.90),
)
#: The rules of the base verdict.
BASE = ("too_short", "repeated_words")


def words_of(text: Column) -> Column:
    """Words [^\\x20\\x09-\\x0D]+ of a text."""
    return F.array_remove(F.split(text, SPACE), "")


def metrics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the counts of every text (null: no words), all by built-in functions."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    base = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text"))
    cut = base.select(
        "doc_id", words_of(F.col("text")).alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD)).alias("lines"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace("text", r"[^!]+", "")).cast("long").alias("n_exclaims"))
    n = F.size("words")
    hashed = cut.select(
        "doc_id", "n_symbols", "n_exclaims", n.cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size(F.array_intersect("words", F.array(*map(F.lit, STOP_WORDS)))).cast("long")
        .alias("n_stop_kinds"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("lines", lambda x: x.rlike(r"^\s*[-*•]"))).cast("long")
        .alias("n_bullet_lines"),
        F.when(n >= WINDOW, F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)),
                                        lambda i: F.xxhash64(F.slice("words", i, WINDOW))))
        .otherwise(F.array().cast("array<bigint>")).alias("windows"))
    # only texts that repeat a window sort their windows
    ordered = hashed.withColumn("windows", F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    places = ordered.withColumn("places", F.when(F.col("windows").isNotNull(), F.sort_array(
        F.transform(F.expr("""filter(windows, (e, k) -> (k > 0 and windows[k - 1].h = e.h)
                              or (k < size(windows) - 1 and windows[k + 1].h = e.h))"""),
                    lambda e: e["i"])))).drop("windows")
    covered = F.expr(f"""aggregate(transform(places, (p, k) ->
        if(k + 1 < size(places), least({WINDOW}, places[k + 1] - p), {WINDOW})), 0L, (a, x) -> a + x)""")
    return places.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("places")


def failed(rule: Rule) -> Column:
    """True if a row fails the rule; a ratio without a denominator passes."""
    top, _, under = rule.metric.partition("/")
    value, tests = f"(({top}) / nullif({under}, 0))" if under else f"({top})", []
    if rule.least is not None:
        tests.append(f"{value} < {rule.least}D" if isinstance(rule.least, float) else f"{value} < {rule.least}")
    if rule.most is not None:
        tests.append(f"{value} > {rule.most}D" if isinstance(rule.most, float) else f"{value} > {rule.most}")
    return F.coalesce(F.expr(" or ".join(tests)), F.lit(False))


def apply_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Metrics, failed_rules (names in table order, comma-joined), base_failed and kept per row.

    Null and empty texts have no words and fail ``too_short``; repeated rows are judged each on
    its own; other columns of ``docs`` are left behind; an empty table gives no rows.
    """
    m = metrics(docs, id_col, text_col)
    names = F.filter(F.array(*[F.when(failed(r), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull())
    out = m.withColumn("_failed", names)
    base = F.lit(False)
    for r in rules:
        if r.name in BASE:
            base = base | failed(r)
    return out.select("doc_id", *[c for c in m.columns if c != "doc_id"],
                      F.array_join("_failed", ",").alias("failed_rules"),
                      base.alias("base_failed"), (F.size("_failed") == 0).alias("kept"))


def oracle_sql(rules: tuple[Rule, ...] = RULES) -> str:
    """The query op7 in DuckDB's SQL."""
    def test(r: Rule) -> str:
        top, _, under = r.metric.partition("/")
        value = f"({top})::double / nullif({under}, 0)" if under else f"({top})"
        parts = [f"{value} < {r.least}"] * (r.least is not None) + [f"{value} > {r.most}"] * (r.most is not None)
        return f"coalesce({' or '.join(parts)}, false)"
    names = ", ".join(f"case when {test(r)} then '{r.name}' end" for r in rules)
    base = " or ".join(test(r) for r in rules if r.name in BASE)
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, doc_id, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
      FROM d),
p AS (SELECT rid, i, list_aggregate(words[i:i + {WINDOW - 1}], 'string_agg', ' ') AS win
      FROM (SELECT rid, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM w)),
g AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS n FROM p),
r AS (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM g WHERE n > 1),
c AS (SELECT rid, sum(least({WINDOW}, coalesce(nxt - i, {WINDOW})))::bigint AS n_repeat_words FROM r GROUP BY rid),
m AS (SELECT doc_id, len(words)::bigint AS n_words,
             coalesce(length(list_aggregate(words, 'string_agg', '')), 0)::bigint AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::bigint AS n_symbols,
             length(regexp_replace(text, '[^!]+', '', 'g'))::bigint AS n_exclaims,
             len(list_filter(list_distinct(words), lambda x: list_contains([{stop}], x)))::bigint AS n_stop_kinds,
             len(lines)::bigint AS n_lines,
             (len(lines) - len(list_distinct(lines)))::bigint AS n_dup_lines,
             len(list_filter(lines, lambda x: regexp_matches(x, '^\\s*[-*•]')))::bigint AS n_bullet_lines,
             coalesce(n_repeat_words, 0)::bigint AS n_repeat_words
      FROM w LEFT JOIN c USING (rid)),
v AS (SELECT *, list_filter([{names}], lambda x: x IS NOT NULL) AS failed, {base} AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       len(failed) = 0 AS kept, coalesce(list_aggregate(failed, 'string_agg', ','), '') AS failed_rules
FROM v"""
