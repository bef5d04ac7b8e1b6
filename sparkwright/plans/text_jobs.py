"""Text jobs over whole documents: word counts, entropy, cleaning, sentiment, reposts.

Stand-ins: the book -> documents.text (every line of every document); posts
-> conversations.text; reposts -> documents, where the repost count is the
number of line breaks in the text and the arrival order is doc_id.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkwright.functions import scalar
from sparkwright.operators import agg, text
from sparkwright.sources.tables import table


def word_count(spark, root):
    """Occurrences of each space-separated word of every line (JVM split rules)."""
    docs = table(spark, root, "documents")
    return text.word_counts(text.words(docs, "text", " "), name="n")


def word_count_regex(spark, root):
    """Occurrences of each lower-cased word, splitting on non-word runs."""
    docs = table(spark, root, "documents")
    return text.word_counts(text.words(docs, "text", r"\W+", lower=True), name="n")


def word_count_sorted(spark, root):
    """As word_count_regex without stop words, ascending by count then word."""
    docs = table(spark, root, "documents")
    w = text.drop_words(text.words(docs, "text", r"\W+", lower=True))
    return text.word_counts(w, name="n").orderBy("n", "word")


def doc_entropy(spark, root):
    """Shannon entropy (bits) of each document's whitespace-separated words."""
    docs = table(spark, root, "documents")
    return text.doc_entropy(docs, "doc_id", "text", "entropy") \
        .select("doc_id", scalar.round_half_away("entropy", 6).alias("entropy"))


def clean_text(spark, root):
    """Post text with mentions, links and non-alphanumerics removed."""
    conv = table(spark, root, "conversations")
    return conv.select("conv_id", "turn", text.clean_post("text").alias("clean"))


def sentiment(spark, root):
    """Polarity and class of every post (lexicon mean over cleaned words)."""
    conv = table(spark, root, "conversations")
    p = text.polarity(text.clean_post("text"))
    return conv.select("conv_id", "turn", scalar.round_half_away(p, 6).alias("polarity"),
                       text.sentiment_class(p).alias("sentiment"))


def sentiment_share(spark, root):
    """Count and percentage of posts per sentiment class, classes without posts included."""
    s = sentiment(spark, root)
    classes = spark.createDataFrame([(c,) for c in text.SENTIMENTS], "sentiment string")
    counts = classes.join(agg.count_values(s, "sentiment", "n"), "sentiment", "left").fillna(0, ["n"])
    return agg.share(counts, "n", "share").select(
        "sentiment", "n", scalar.round_half_away("share", 6).alias("share"))


def dedupe_reposts(spark, root):
    """Rows kept by the repost rule: no reposts, or first copy of the text."""
    docs = table(spark, root, "documents").select(
        "doc_id", "text", (F.size(F.split("text", "\n", -1)) - 1).cast("bigint").alias("reposts"))
    return text.dedupe_reposts(docs, "text", "reposts", "doc_id").select("doc_id", "reposts")


JOBS = {
    "word_count": word_count,
    "word_count_regex": word_count_regex,
    "word_count_sorted": word_count_sorted,
    "doc_entropy": doc_entropy,
    "clean_text": clean_text,
    "sentiment": sentiment,
    "sentiment_share": sentiment_share,
    "dedupe_reposts": dedupe_reposts,
}

_LINES = r"""lines AS (
  SELECT unnest(CASE WHEN text = '' THEN []::VARCHAR[]
                     WHEN contains(text, chr(13))
                       THEN regexp_split_to_array(regexp_replace(text, '(?:\r\n|\r|\n)\z', ''), '\r\n|\r|\n')
                     ELSE string_split(regexp_replace(text, '\n\z', ''), chr(10)) END) AS line
  FROM documents)"""


def _split_sql(col, sep):
    stripped = f"regexp_replace({col}, '(?:{sep})+\\z', '')"
    return (f"CASE WHEN {col} = '' THEN [''] WHEN {stripped} = '' THEN []::VARCHAR[] "
            f"ELSE regexp_split_to_array({stripped}, '{sep}') END")


_WS = scalar.PY_WHITESPACE
_PY_SPLIT = (f"CASE WHEN regexp_replace(text, '^{_WS}+|{_WS}+\\z', '', 'g') = '' THEN []::VARCHAR[] "
             f"ELSE regexp_split_to_array(regexp_replace(text, '^{_WS}+|{_WS}+\\z', '', 'g'), '{_WS}+') END")
_CLEAN = (r"trim(regexp_replace(regexp_replace(text, '(@[A-Za-z0-9]+)|([^0-9A-Za-z \t])|([\pL\pN_]+://\S+)', ' ', 'g'), "
          r"'[ \t]+', ' ', 'g'))")
# the lexicon and the cleaning pattern, written out so that the SQL checks them
_LEX = ("('awful', -1.0), ('bad', -0.7), ('best', 1.0), ('better', 0.5), ('bien', 0.5), ('bon', 0.6), "
        "('bueno', 0.6), ('error', -0.3), ('excellent', 1.0), ('free', 0.4), ('good', 0.7), ('great', 0.8), "
        "('gut', 0.6), ('happy', 0.8), ('hate', -0.8), ('junk', -0.4), ('love', 0.5), ('mal', -0.5), "
        "('malo', -0.7), ('mauvais', -0.7), ('new', 0.14), ('nice', 0.6), ('poor', -0.4), ('problem', -0.3), "
        "('right', 0.29), ('sad', -0.5), ('schlecht', -0.7), ('terrible', -1.0), ('well', 0.2), ('worst', -1.0), "
        "('wrong', -0.5)")
_POL = f"""pol AS (
  SELECT c.conv_id, c.turn, coalesce(avg(l.p), 0.0) AS p
  FROM (SELECT conv_id, turn, {_CLEAN} AS clean FROM conversations) c
  LEFT JOIN (SELECT conv_id, turn, unnest(string_split(lower({_CLEAN}), ' ')) AS w FROM conversations) t
    ON t.conv_id = c.conv_id AND t.turn = c.turn
  LEFT JOIN (VALUES {_LEX}) l(w, p) ON l.w = t.w
  GROUP BY c.conv_id, c.turn)"""
_CLASS = "CASE WHEN p > 0 THEN 'positive' WHEN p = 0 THEN 'neutral' ELSE 'negative' END"
_STOP = ", ".join(f"'{w}'" for w in text.STOP_WORDS)

ORACLE = {
    "word_count": f"""WITH {_LINES},
        w AS (SELECT unnest({_split_sql('line', ' ')}) AS word FROM lines)
        SELECT word, count(*) AS n FROM w GROUP BY word""",
    "word_count_regex": f"""WITH {_LINES},
        w AS (SELECT lower(unnest({_split_sql('line', chr(92) + 'W+')})) AS word FROM lines)
        SELECT word, count(*) AS n FROM w GROUP BY word""",
    "word_count_sorted": f"""WITH {_LINES},
        w AS (SELECT lower(unnest({_split_sql('line', chr(92) + 'W+')})) AS word FROM lines)
        SELECT word, count(*) AS n FROM w WHERE word NOT IN ({_STOP}) GROUP BY word""",
    "doc_entropy": f"""WITH t AS (SELECT doc_id, unnest({_PY_SPLIT}) AS w FROM documents),
        c AS (SELECT doc_id, w, count(*) AS c FROM t GROUP BY ALL),
        tot AS (SELECT doc_id, sum(c) AS t FROM c GROUP BY doc_id),
        e AS (SELECT c.doc_id, sum(c.c / tot.t * log2(tot.t / c.c)) AS h
              FROM c JOIN tot USING (doc_id) GROUP BY c.doc_id)
        SELECT d.doc_id, round(coalesce(e.h, 0.0), 6) AS entropy
        FROM documents d LEFT JOIN e USING (doc_id)""",
    "clean_text": f"SELECT conv_id, turn, {_CLEAN} AS clean FROM conversations",
    "sentiment": f"""WITH {_POL}
        SELECT conv_id, turn, round(p, 6) AS polarity, {_CLASS} AS sentiment FROM pol""",
    "sentiment_share": f"""WITH {_POL},
        s AS (SELECT k.sentiment, count(pol.p) AS n FROM (VALUES ('positive'), ('neutral'), ('negative')) k(sentiment)
              LEFT JOIN pol ON {_CLASS} = k.sentiment GROUP BY 1)
        SELECT sentiment, n, round(100.0 * n / sum(n) OVER (), 6) AS share FROM s""",
    "dedupe_reposts": """WITH d AS (
          SELECT doc_id, text, len(string_split(text, chr(10))) - 1 AS reposts FROM documents),
        f AS (SELECT text, min(doc_id) AS first_id FROM d GROUP BY text)
        SELECT d.doc_id, d.reposts FROM d JOIN f ON d.text IS NOT DISTINCT FROM f.text
        WHERE d.reposts = 0 OR d.doc_id = f.first_id""",
}
