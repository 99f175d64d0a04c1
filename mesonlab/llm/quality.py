"""Quality classifier by positive-unlabelled learning: trusted positives, plain
documents as unlabelled ones and an estimated class prior; minimises the
non-negative unbiased risk."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mesonlab.llm.common import crc_mod, table, word_hashes

#: Rows of a kind (positive, unlabelled) that the model is fitted on, at most.
SAMPLE_ROWS = 8_000
THRESHOLD = 0.7
EPOCHS, BATCH, HIDDEN, STEPS_AT_LEAST = 60, 512, 24, 15
_PRINTABLE = [c for c in range(33, 127) if not chr(c).isalnum()]
#: What a text is measured by; none of it depends on the language's words.
N_FEATURES = len(_PRINTABLE) + 16


def features(texts) -> np.ndarray:
    """One row of N_FEATURES for each whole text; a null text counts as empty."""
    texts = ["" if t is None else t for t in texts]
    out = np.zeros((len(texts), N_FEATURES))
    for i, t in enumerate(texts):
        raw = t.encode("utf-8")
        n = max(len(raw), 1)
        seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
        words = max(seen[32] + seen[9] + seen[10] + seen[13], 0) + 1
        out[i, :len(_PRINTABLE)] = np.log1p(100 * seen[_PRINTABLE] / words)
        upper, lower, digit = seen[65:91].sum(), seen[97:123].sum(), seen[48:58].sum()
        out[i, len(_PRINTABLE):len(_PRINTABLE) + 9] = (
            upper / n, lower / n, digit / n, seen[128:].sum() / n, seen[_PRINTABLE].sum() / n, seen[10] / words,
            np.log1p(n), n / words / 10, upper / max(upper + lower, 1))
    at = len(_PRINTABLE) + 9
    for first, hashes, offsets in word_hashes(texts, "nonspace"):
        same = np.zeros(len(hashes) + 1)
        same[1:len(hashes)] = hashes[1:] == hashes[:-1]
        again = np.concatenate(([0.0], np.cumsum(same)))
        for k in range(len(offsets) - 1):
            lo, hi = offsets[k], offsets[k + 1]
            if hi == lo:
                continue
            own, count = np.unique(hashes[lo:hi], return_counts=True)
            m = hi - lo
            share = np.sort(count)[::-1] / m
            pairs = np.unique(hashes[lo:hi - 1] ^ (hashes[lo + 1:hi] >> np.uint64(1))) if m > 1 else own
            out[first + k, at:at + 7] = ((again[hi] - again[lo + 1]) / m if m > 1 else 0, len(own) / m, np.log(len(own)) / np.log(m + 1),
                                         share[0], share[:5].sum(), len(pairs) / max(m - 1, 1), np.log1p(m))
    return out


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(np.clip((x - self.mean) / self.scale, -8, 8) @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -30, 30)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, seed: int = 7) -> Model:
    """Adam on the non-negative risk  prior*R_p^+ + max(0, R_u^- - prior*R_p^-)
    with the logistic loss; where the second part is negative, its gradient is
    followed backwards, as the estimator asks."""
    rng = np.random.default_rng(seed)
    both = np.concatenate([positive, unlabelled])
    model = Model(both.mean(0), both.std(0) + 1e-6, rng.normal(0, N_FEATURES ** -0.5, (N_FEATURES, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN ** -0.5, HIDDEN), 0.0)
    xp, xu = (np.clip((x - model.mean) / model.scale, -8, 8) for x in (positive, unlabelled))
    params = [model.w1, model.b1, model.w2, np.zeros(1)]
    m1, m2 = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for epoch in range(EPOCHS):
        rate = 0.01 * (1 - epoch / EPOCHS) + 1e-4
        for _ in range(max(len(xu) // BATCH, STEPS_AT_LEAST)):
            p, u = xp[rng.integers(0, len(xp), BATCH)], xu[rng.integers(0, len(xu), BATCH)]
            x = np.concatenate([p, u])
            hidden = np.tanh(x @ params[0] + params[1])
            score = 1 / (1 + np.exp(-np.clip(hidden @ params[2] + params[3], -30, 30)))
            sp, su = score[:BATCH], score[BATCH:]
            rest = -np.log1p(-su * (1 - 1e-9)).mean() + prior * np.log1p(-sp * (1 - 1e-9)).mean()  # R_u^- - prior * R_p^-
            sign = 1.0 if rest >= 0 else -1.0
            # d/dlogit of softplus(-z) is score - 1, of softplus(z) it is score
            gp = (prior * (sp - 1) if sign > 0 else 0) - sign * prior * sp
            gu = sign * su
            g = np.concatenate([gp, gu]) / BATCH
            back = np.outer(g, params[2]) * (1 - hidden ** 2)
            grads = [x.T @ back + 1e-4 * params[0], back.sum(0), hidden.T @ g + 1e-4 * params[2], np.array([g.sum()])]
            step += 1
            for k, grad in enumerate(grads):
                m1[k] = 0.9 * m1[k] + 0.1 * grad
                m2[k] = 0.999 * m2[k] + 0.001 * grad ** 2
                params[k] -= rate * (m1[k] / (1 - 0.9 ** step)) / (np.sqrt(m2[k] / (1 - 0.999 ** step)) + 1e-8)
    model.w1, model.b1, model.w2, model.b2 = params[0], params[1], params[2], float(params[3][0])
    return model


def _share(key: Column, share: float) -> Column:
    """True for about this share of the keys, always the same ones."""
    return F.pmod(F.xxhash64(key.cast("string"), F.lit("quality")), F.lit(1 << 30)) < F.lit(int(min(share, 1.0) * (1 << 30)))


def train(docs: DataFrame, labels: DataFrame, learn: Callable[[Column], Column], sample_rows: int = SAMPLE_ROWS) -> Model | float:
    """The model, fitted on at most about ``sample_rows`` documents labelled 1 and as many of
    all documents, as the unlabelled set, of the keys for which ``learn`` holds. Just the
    class prior if no document is labelled 1. The prior is the share of 1 among the labelled
    documents. Of an id that repeats, the smallest text counts."""
    key = F.col("doc_id")
    known = labels.select(key, F.col("quality")).where(learn(key) & F.col("quality").isNotNull())
    marks = known.groupBy("doc_id").agg(F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("mark"))
    keys = docs.select(key).where(learn(key)).distinct().join(marks, "doc_id", "left")
    total, labelled, ones = keys.agg(F.count("*"), F.count("mark"), F.count(F.when(F.col("mark") == 1, 1))).first()
    prior = min(max(ones / labelled, 0.01), 0.99) if labelled else 0.5
    if not ones:
        return prior
    kinds = F.array(F.when((F.col("mark") == 1) & _share(key, sample_rows / ones), 1), F.when(_share(key, sample_rows / total), 0))
    chosen = keys.select(key, F.explode(F.array_compact(kinds)).alias("kind"))  # about 2 * sample_rows, whatever the input
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "kind").agg(F.min("text").alias("text"))  # one of an id's texts
    rows = texts.select("kind", F.pandas_udf(_measured, "array<double>")("text").alias("x")).toPandas()
    x = {k: np.array(rows.x[rows.kind == k].tolist()).reshape(-1, N_FEATURES) for k in (0, 1)}
    return fit(x[1], x[0], prior) if len(x[0]) and len(x[1]) else prior


def _measured(texts: pd.Series) -> pd.Series:
    return pd.Series(list(features(texts)))


def score_documents(docs: DataFrame, model: Model | float, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``docs`` with a score of 0 to 1 (higher: better); null texts score as empty
    ones. One narrow pass over whole texts; a column named ``out_col`` is replaced."""
    keep = [F.col(f"`{c}`") for c in docs.columns if c != out_col]
    if isinstance(model, float):
        return docs.select(*keep, F.lit(model).alias(out_col))

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(model.scores(features(texts)))
    return docs.select(*keep, F.pandas_udf(score, "double")(F.col(f"`{text_col}`")).alias(out_col))


def learned_keys(key: Column) -> Column:
    """Keys whose labels may be learned from; a null key's never are."""
    return F.coalesce(crc_mod(key, 4) != 2, F.lit(False))


def op5_quality(spark, sf_dir: str) -> DataFrame:
    """Quality score of every whole text of ``documents``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_documents(docs, train(docs, table(spark, sf_dir, "labels"), learned_keys))
    return scored.select("doc_id", F.coalesce(crc_mod(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
