"""Toxicity by cumulative-link ordinal regression on sparse text features.

P(grade <= j) = sigmoid(t_j - w.x): one weight vector shared by all thresholds
t_0 < t_1 < ...  The model is fitted with an L1 penalty on a bounded sample of
labelled documents and scores every document; its output is the expected
severity grade.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evallens.llm.common import random_key, stored

TERM, NOT_WORD = re.compile(r"\w+"), re.compile(r"\W")
PIECE = 1 << 20
CACHED_WORDS = 1 << 16
# Bounds of the training sample: labelled rows per class, and features.
SAMPLE_ROWS, SAMPLE_TERMS = 3000, 512
GRADES = 4  # 0: not toxic; 1 to 3: mild, strong, severe
PENALTY = 3e-4
PREFIXES = (3, 4, 5, 6)


def words_of(text: str) -> Counter:
    """Lower-cased words of the whole text with their counts."""
    counts: Counter = Counter()
    at = 0
    while at < len(text):
        stop = at + PIECE
        if stop < len(text):  # end the piece between two words
            m = NOT_WORD.search(text, stop)
            stop = m.start() if m else len(text)
        counts.update(TERM.findall(text[at:stop].lower()))
        at = stop
    return counts


def features_of(word: str) -> list[str]:
    """A word and its beginnings (marked by ^)."""
    return [word, *["^" + word[:k] for k in PREFIXES if len(word) >= k]]


@dataclass
class Model:
    """Per feature the weights of its presence and of log(1 + its occurrences per 1000 words), and the ordered thresholds."""

    weights: dict[str, tuple[float, float]]
    thresholds: list[float]

    def probabilities(self, score: np.ndarray) -> np.ndarray:
        """P(grade = 0), P(grade = 1), ... per score."""
        below = 1 / (1 + np.exp(np.clip(score[:, None] - np.array(self.thresholds)[None, :], -500, 500)))
        return np.diff(np.column_stack([np.zeros(len(score)), below, np.ones(len(score))]), axis=1)

    def score(self, text: str | None, cache: dict) -> float | None:
        """w.x of a text; None without words.  `cache` keeps the weighted features of words met before."""
        words = words_of(text or "")
        n = sum(words.values())
        if not n:
            return None
        counts: dict[str, int] = {}
        for word, c in words.items():
            own = cache.get(word)
            if own is None:
                own = tuple(f for f in features_of(word) if f in self.weights)
                if len(cache) < CACHED_WORDS:
                    cache[word] = own
            for f in own:
                counts[f] = counts.get(f, 0) + c
        return sum(self.weights[f][0] + self.weights[f][1] * math.log1p(1000 * c / n) for f, c in sorted(counts.items()))


def fit_cumulative_link(rows: np.ndarray, cols: np.ndarray, vals: np.ndarray, y: np.ndarray, features: int,
                        grades: int, penalty: float, steps: int = 600) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) of the L1-penalised cumulative-link model, by accelerated proximal gradient steps.

    The sparse matrix is given by (rows, cols, vals).  Weights are not negative:
    evidence adds up, and common words cannot outweigh it.  Thresholds are a first
    one and positive gaps, so they stay ordered.
    """
    n, k = len(y), grades - 1
    w, a, gap = np.zeros(features), 0.0, np.full(k - 1, 1.0)
    share = np.clip(np.cumsum(np.bincount(y, minlength=grades))[:k] / n, 0.02, 0.98)
    t0 = np.log(share / (1 - share))
    a, gap = t0[0], np.maximum(np.diff(t0), 0.05)

    def value(w, a, gap):
        t = a + np.concatenate([[0.0], np.cumsum(gap)])
        s = np.bincount(rows, vals * w[cols], minlength=n)
        f = 1 / (1 + np.exp(np.clip(s[:, None] - t[None, :], -500, 500)))
        f = np.column_stack([np.zeros(n), f, np.ones(n)])
        p = np.maximum(f[np.arange(n), y + 1] - f[np.arange(n), y], 1e-12)
        d = f * (1 - f)
        up, lo = d[np.arange(n), y + 1] / p, d[np.arange(n), y] / p
        gs = (up - lo) / n  # d loss / d score
        gt = np.zeros((n, k + 2))
        gt[np.arange(n), y + 1] -= up / n
        gt[np.arange(n), y] += lo / n
        gt = gt[:, 1:-1].sum(axis=0)
        tail = np.cumsum(gt[::-1])[::-1]
        return -np.log(p).mean(), np.bincount(cols, vals * gs[rows], minlength=features), gt.sum(), tail[1:]

    size, momentum = 1.0, 1.0
    zw, za, zg = w, a, gap
    for _ in range(steps):
        loss, gw, ga, gg = value(zw, za, zg)
        while True:
            nw = zw - size * gw
            nw = np.maximum(nw - size * penalty, 0)
            na, ng = za - size * ga, np.maximum(zg - size * gg, 1e-3)
            dw, da, dg = nw - zw, na - za, ng - zg
            bound = loss + gw @ dw + ga * da + gg @ dg + (dw @ dw + da * da + dg @ dg) / (2 * size)
            if value(nw, na, ng)[0] <= bound + 1e-12 or size < 1e-8:
                break
            size /= 2
        nxt = (1 + np.sqrt(1 + 4 * momentum ** 2)) / 2
        mix = (momentum - 1) / nxt
        zw, za, zg = nw + mix * (nw - w), na + mix * (na - a), np.maximum(ng + mix * (ng - gap), 1e-3)
        moved = np.abs(nw - w).max(initial=0) + abs(na - a)
        w, a, gap, momentum = nw, na, ng, nxt
        if moved < 1e-6:
            break
    return w, a + np.concatenate([[0.0], np.cumsum(gap)])


def severity_grades(evidence: np.ndarray, toxic: np.ndarray, grades: int = GRADES) -> np.ndarray:
    """Grades from a yes/no label: 0 for documents that are not toxic; toxic ones are cut
    into equal parts by their evidence (the score of a yes/no fit)."""
    cuts = np.quantile(evidence[toxic == 1], np.arange(1, grades - 1) / (grades - 1))
    grade = np.where(toxic == 1, 1 + (evidence[:, None] > cuts[None, :]).sum(axis=1), 0)
    return np.searchsorted(np.unique(grade), grade)  # no empty grade


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, terms: int = SAMPLE_TERMS,
        penalty: float = PENALTY, seed: str = "toxicity") -> Model | None:
    """Model fitted on at most `rows` labelled documents of each class and `terms` features.

    The sample is the least hash keys of each class.  An id that has several texts is
    sampled with one of them, that of the least MD5.  The features are the words
    and word beginnings whose document rates differ most between the classes (in
    standard errors).  The labels say yes or no; a toxic document's grade comes
    from its evidence in a first yes/no fit.  None if a class has no usable document.
    """
    spark = docs.sparkSession
    docs = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    lab = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    # Labels may name documents that are not there: the sample is drawn from those that are.
    lab = lab.join(docs.where(F.length("text") > 0).select("doc_id").distinct(), "doc_id").withColumn("key", random_key(F.col("doc_id"), seed=seed))
    sample = lab.where("toxic = 0").orderBy("key").limit(rows).unionByName(lab.where("toxic = 1").orderBy("key").limit(rows))
    sample = stored(sample.select("doc_id", "toxic"), "toxicity-sample")
    size = dict(sample.groupBy("toxic").count().collect())
    if len(size) < 2:
        return None
    text = docs.where(F.length("text") > 0).join(F.broadcast(sample), "doc_id")  # at most 2 * rows ids
    text = text.groupBy("doc_id", "toxic").agg(F.min_by("text", F.md5("text")).alias("text"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for doc_id, t, toxic in zip(pdf["doc_id"], pdf["text"], pdf["toxic"]):
                words, c = words_of(t or ""), Counter()
                for word, k in words.items():
                    for f in features_of(word):
                        c[f] += k
                if c:
                    yield pd.DataFrame({"doc_id": doc_id, "toxic": toxic, "words": sum(words.values()), "term": list(c), "n": list(c.values())})

    found = stored(text.mapInPandas(count, "doc_id long, toxic int, words long, term string, n long"), "toxicity-terms")
    rate = lambda k: F.count_if(F.col("toxic") == k) / F.lit(float(size[k]))
    both = F.count(F.lit(1)) / F.lit(float(size[0] + size[1]))
    spread = F.sqrt(F.greatest(both * (1 - both), F.lit(1e-9)) * F.lit(1 / size[0] + 1 / size[1]))
    ranked = found.groupBy("term").agg(((rate(1) - rate(0)) / spread).alias("z"), F.count(F.lit(1)).alias("df")).where(F.col("df") >= 5)
    top = [r.term for r in ranked.orderBy(F.desc(F.abs("z")), "term").limit(terms).collect()]
    if not top:
        return None
    known = spark.createDataFrame([(t, i) for i, t in enumerate(top)], "term string, i int")
    data = found.join(F.broadcast(known), "term").select("doc_id", "i", "n").toPandas().sort_values(["doc_id", "i"])
    docs_ = found.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.max("words").alias("words")).toPandas().sort_values("doc_id")
    toxic, words = docs_["toxic"].to_numpy().astype(np.int64), docs_["words"].to_numpy()
    if toxic.min() == toxic.max():
        return None
    doc = np.searchsorted(docs_["doc_id"].to_numpy(), data["doc_id"].to_numpy())
    term, n, k = data["i"].to_numpy().astype(np.int64), data["n"].to_numpy(), len(top)
    rows_, cols = np.concatenate([doc, doc]), np.concatenate([term, term + k])
    vals = np.concatenate([np.ones(len(n)), np.log1p(1000 * n / words[doc])])
    w, _ = fit_cumulative_link(rows_, cols, vals, toxic, 2 * k, 2, penalty)
    grade = severity_grades(np.bincount(rows_, vals * w[cols], minlength=len(toxic)), toxic)
    w, thresholds = fit_cumulative_link(rows_, cols, vals, grade, 2 * k, int(grade.max()) + 1, penalty)
    return Model({t: (float(w[i]), float(w[i + k])) for i, t in enumerate(top) if w[i] or w[i + k]}, [float(t) for t in thresholds])


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, model: Model | None = None, **how) -> DataFrame:
    """`docs` with severity (expected grade), grade (most probable), p_toxic (chance of a grade above 0) and rejected.

    rejected: p_toxic >= `threshold`.  The model is fitted to `labels` (doc_id,
    toxic) unless one is given.  NULL and empty texts, and all texts if there is no
    usable label of one class: severity 0, not rejected.  Labels that repeat a
    doc_id: toxic if one says so.  Whole texts are read, in pieces; the weights
    are the only data sent to the tasks, two per feature.
    Columns of `docs` with the names of the new ones are replaced.
    """
    m = model or fit(docs, labels, **how)
    cache: dict = {}

    @F.pandas_udf("severity double, grade int, p_toxic double")
    def score(texts: pd.Series) -> pd.DataFrame:
        if m is None:
            return pd.DataFrame({"severity": 0.0, "grade": np.int32(0), "p_toxic": 0.0}, index=range(len(texts)))
        s = [m.score(t, cache) for t in texts]
        p = m.probabilities(np.array([0.0 if x is None else x for x in s], dtype=np.float64))
        p[[x is None for x in s]] = np.eye(p.shape[1])[0]
        return pd.DataFrame({"severity": p @ np.arange(p.shape[1]), "grade": p.argmax(axis=1).astype(np.int32), "p_toxic": 1 - p[:, 0]})

    names = ("severity", "grade", "p_toxic", "rejected")
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in names]
    out = docs.select(F.struct(*kept).alias("doc"), score(F.col("text").cast("string")).alias("tox"))
    return out.select("doc.*", *[F.col(f"tox.{c}") for c in names[:3]], (F.col("tox.p_toxic") >= threshold).alias("rejected"))
