"""Quality classifier: Bradley-Terry ranking of documents from preference pairs.

A document's latent score is linear in features of its text. A pair of a label-1 and a label-0
document says that the first is preferred; the weights minimise the logistic loss of the score
differences (the probability that i beats j is 1 / (1 + exp(s_j - s_i))). The threshold is the
quantile of the training scores that tells the labels apart best; the reported score is
1 / (1 + exp(-(s - threshold) - logit(CUT))), so that it is CUT at the threshold.

Training uses at most ``SAMPLE`` labelled rows (those with the smallest hash of their id) and
``PAIRS`` pairs; both bounds are parameters. Features look at the text only. Every document is
scored where it is read, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkwright.llm.common import Words, bound_batches, ids_and_texts

#: Labelled rows and preference pairs of a fit, at most; the score that predicts label 1.
SAMPLE, PAIRS, CUT = 20_000, 200_000, 0.3
RIDGE, STEPS = 1e-3, 30
#: Weight of a rejected label 1 against an accepted label 0 when the threshold is chosen.
KEEP = 4.0
BATCH = 3_000_000

FEATURES = ("log_words", "word_length", "repeated_next", "distinct", "capitals", "symbols", "exclaims", "digits",
            "spaces", "short_lines", "longest_word", "top_next")


def _table(characters: str) -> np.ndarray:
    t = np.zeros(256, dtype=np.uint8)
    t[[ord(c) for c in characters]] = 1
    return t


_COUNTED = {"capitals": _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), "symbols": _table("#*$%&|<>{}[]~^=_@\\/+"),
            "exclaims": _table("!"), "digits": _table("0123456789"), "lines": _table("\n")}


def features(texts: list[str]) -> np.ndarray:
    """One row of FEATURES per text; an empty text gives zeros."""
    w = Words(texts)
    h, n = w.hashes(), np.diff(w.first).astype(np.float64)
    size = np.diff(w.base).astype(np.float64)
    raw = np.frombuffer(w.data, np.uint8, int(w.base[-1]))
    count = {}
    for name, table in _COUNTED.items():
        total = np.r_[0, np.cumsum(table[raw], dtype=np.int64)]
        count[name] = (total[w.base[1:]] - total[w.base[:-1]]).astype(np.float64)
    some = np.maximum(n, 1)
    per_text = lambda values: np.bincount(w.text, weights=values, minlength=len(texts))
    length = (w.end - w.start).astype(np.float64)
    again = np.r_[(h[1:] == h[:-1]) & (w.text[1:] == w.text[:-1]), False] if len(h) else np.zeros(0, bool)
    order = np.lexsort((h, w.text))
    first = np.ones(len(h), dtype=bool)
    first[1:] = (h[order][1:] != h[order][:-1]) | (w.text[order][1:] != w.text[order][:-1])
    distinct = np.bincount(w.text[order][first], minlength=len(texts))
    # how often the most frequent pair of neighbouring words occurs
    pair = np.r_[h[1:] * np.uint64(3) + h[:-1], np.uint64(0)][:len(h)]
    inside = np.r_[w.text[1:] == w.text[:-1], False][:len(h)]
    owner, pair = w.text[inside], pair[inside]
    order = np.lexsort((pair, owner))
    owner, pair = owner[order], pair[order]
    start = np.flatnonzero(np.r_[True, (pair[1:] != pair[:-1]) | (owner[1:] != owner[:-1])]) if len(pair) else np.empty(0, int)
    top = np.zeros(len(texts))
    np.maximum.at(top, owner[start], np.diff(np.r_[start, len(pair)]))
    longest = np.zeros(len(texts))
    np.maximum.at(longest, w.text, length)
    share = lambda x, of: np.log1p(100 * x / of)
    out = np.stack([
        np.log1p(n), per_text(length) / some, share(per_text(again), some),
        distinct / np.power(some, 0.9), share(count["capitals"], size), share(count["symbols"], size),
        share(count["exclaims"], size), share(count["digits"], size), (size - per_text(length)) / size,
        share(count["lines"], some), np.log1p(longest), share(np.maximum(top - 1, 0), some)], axis=1)
    out[n == 0] = 0
    return out


@dataclass(frozen=True)
class Ranking:
    """Latent score: (features - mean) / scale times weights; zero weights if nothing was learned."""
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def latent(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        shift = np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(self.latent(x) - self.threshold + shift, -500, 500)))


def fit(x: np.ndarray, label: np.ndarray, pairs: int = PAIRS, seed: int = 7) -> Ranking:
    """Newton steps on the pairwise logistic loss with a ridge. Without both labels: no preference,
    and every text is at the cut."""
    d = x.shape[1]
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(good) or not len(bad):
        return Ranking(np.zeros(d), np.ones(d), np.zeros(d), 0.0)
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    z = np.clip((x - mean) / scale, -8, 8)
    rng = np.random.default_rng(seed)
    diff = z[rng.choice(good, pairs)] - z[rng.choice(bad, pairs)]
    w = np.zeros(d)
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(np.clip(diff @ w, -500, 500)))  # probability that the worse one wins
        gradient = -(diff * p[:, None]).mean(axis=0) + RIDGE * w
        hessian = (diff * (p * (1 - p))[:, None]).T @ diff / pairs + RIDGE * np.eye(d)
        step = np.linalg.solve(hessian, gradient)
        w = w - step * min(1.0, 4 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    s = z @ w
    order = np.argsort(s, kind="stable")
    wrong_below = np.r_[0, np.cumsum(label[order] == 1)]  # cut after k lowest: label 1 among them
    wrong_above = (label == 0).sum() - np.r_[0, np.cumsum(label[order] == 0)]
    # the quantile of least error, a lost good document counting more than a kept bad one
    cost = KEEP * wrong_below / len(good) + wrong_above / len(bad)
    k = np.flatnonzero(cost <= cost.min() + 1e-12)
    k = int(k[len(k) // 2])
    ordered = s[order]
    threshold = ((ordered[k - 1] + ordered[k]) / 2 if 0 < k < len(s) else ordered[0] - 1 if k == 0 else ordered[-1] + 1)
    return Ranking(mean, scale, w, float(threshold))


def held_out(doc_id: Column) -> Column:
    """Rows that no fit may learn from: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        step = max(1, int(b.num_rows * BATCH / max(1, b.nbytes)))
        for at in range(0, b.num_rows, step):
            yield b.slice(at, step)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Ranking:
    """Fit on at most ``sample`` labelled documents that are not held out (of several labels of an
    id the smallest counts; of several texts the smallest)."""
    usable = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("quality"))
              .where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.min("quality").alias("quality"))
              .orderBy(F.xxhash64("doc_id", F.lit("sample")), "doc_id").limit(sample))

    def run(batches):
        for b in _pieces(batches):
            x = features(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(list(x), pa.list_(pa.float64()))],
                                             ["doc_id", "quality", "x"])
    kind = usable.schema["quality"].dataType.simpleString()
    rows = (ids_and_texts(docs).join(F.broadcast(usable), "doc_id").select("doc_id", "text", "quality")
            .mapInArrow(run, f"doc_id long, quality {kind}, x array<double>")
            .groupBy("doc_id").agg(F.min(F.struct("quality", "x")).alias("r")).select("doc_id", "r.quality", "r.x")
            .orderBy("doc_id").collect())  # at most ``sample`` short rows
    if not rows:
        return fit(np.empty((0, len(FEATURES))), np.empty(0))
    return fit(np.array([r.x for r in rows]), np.array([r.quality for r in rows]))


def score(docs: DataFrame, ranking: Ranking, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every whole text; null texts are read as empty, rows stay one for one."""
    def run(batches):
        for b in _pieces(batches):
            s = ranking.score(features(b.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64())], ["doc_id", "score"])
    return ids_and_texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")


def keep_good(docs: DataFrame, ranking: Ranking) -> DataFrame:
    """Rows that score at least CUT, with all columns as they are; null texts are scored as empty."""
    bound_batches(docs.sparkSession)
    at = docs.columns.index("text")

    def run(batches):
        for b in _pieces(batches):
            texts = [t or "" for t in b.column(at).to_pylist()]
            yield b.filter(pa.array(ranking.score(features(texts)) >= CUT))
    return docs.mapInArrow(run, docs.schema)
