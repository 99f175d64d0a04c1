"""Language identification: sparse multinomial logistic regression on TF-IDF
character n-grams, trained with follow-the-regularised-leader and an elastic
net, its confidence calibrated by a temperature."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mesonlab.llm.common import crc_mod, table

#: Rows that the model is fitted on, at most (about); a fifth of them calibrates it.
SAMPLE_ROWS = 5_000
#: Rows that each language has in the sample, about, if it has as many.
LANGUAGE_ROWS = 200
#: Languages whose shares of the sample may be broadcast; more are joined.
MOST_LANGUAGES = 100_000
BITS, ORDERS = 14, (1, 2, 3)
ALPHA, BETA, L1, L2, EPOCHS, BATCH = 1.0, 1.0, 2e-3, 1e-3, 4, 128
UNKNOWN = "und"
#: A letter, in training and prediction: Unicode category L.
_LETTER = regex.compile(r"\p{L}")
_MUL = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_SLICE = 1 << 18


def ngram_counts(text: str) -> np.ndarray:
    """Counts of the hashed character 1- to 3-grams of the whole lower-cased text
    (in slices that overlap, so memory doesn't follow the text's length)."""
    out = np.zeros(1 << BITS, np.int64)
    text = text.lower()
    for at in range(0, max(len(text), 1), _SLICE):
        part = np.frombuffer(text[max(at - 2, 0):at + _SLICE].encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
        new = 0 if at == 0 else 2
        h = np.zeros(len(part), np.uint64)
        for n in ORDERS:
            h = h[:len(part) - n + 1] * _MUL[1] + part[n - 1:] * _MUL[0] if n > 1 else part * _MUL[0]
            if len(h) <= 0:
                break
            fresh = h[max(new - n + 1, 0):]
            mixed = (fresh ^ (fresh >> np.uint64(29))) * _MUL[2] + np.uint64(n)
            out += np.bincount((mixed >> np.uint64(64 - BITS)).astype(np.int64), minlength=1 << BITS)
    return out


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray
    weights: np.ndarray      # (features, langs), mostly zero
    bias: np.ndarray
    temperature: float = 1.0

    def vector(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(counts)
        x = np.log1p(counts[at]) * self.idf[at]
        return at, x / max(np.sqrt((x * x).sum()), 1e-12)

    def logits(self, counts: np.ndarray) -> np.ndarray:
        at, x = self.vector(counts)
        return x @ self.weights[at] + self.bias

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        e = np.exp(z - z.max(-1, keepdims=True))
        return e / e.sum(-1, keepdims=True)

    def predict(self, text: str | None) -> tuple[str, float]:
        if text is None or not _LETTER.search(text) or not self.langs:
            return UNKNOWN, 0.0
        p = self.probabilities(self.logits(ngram_counts(text)))
        k = int(p.argmax())
        return self.langs[k], float(p[k])


def fit(rows: list[tuple[str, np.ndarray, np.ndarray]], seed: int = 3) -> Model:
    """From (lang, feature numbers, counts) of each text. Per-coordinate FTRL: the
    weights follow from the sums z and n in closed form, L1 sets most to zero."""
    langs = sorted({r[0] for r in rows})
    if not langs:
        return Model([], np.zeros(1 << BITS), np.zeros((1 << BITS, 0)), np.zeros(0))
    rng = np.random.default_rng(seed)
    rows = [rows[i] for i in rng.permutation(len(rows))]
    have = np.zeros(1 << BITS)
    for _, at, _ in rows:
        have[at] += 1
    model = Model(langs, np.log((1 + len(rows)) / (1 + have)) + 1, np.zeros((1 << BITS, len(langs))), np.zeros(len(langs)))
    data = []
    for lang, at, count in rows:
        x = np.log1p(count) * model.idf[at]
        data.append((langs.index(lang), at, x / max(np.sqrt((x * x).sum()), 1e-12)))
    held = max(len(data) // 5, 1) if len(data) > 4 else 0
    learn, check = data[held:], data[:held]
    z, n = np.zeros_like(model.weights), np.zeros_like(model.weights)
    zb, nb = np.zeros(len(langs)), np.zeros(len(langs))
    for _ in range(EPOCHS):
        for lo in range(0, len(learn), BATCH):
            part = learn[lo:lo + BATCH]
            at = np.concatenate([r[1] for r in part])
            x = np.concatenate([r[2] for r in part])
            row = np.repeat(np.arange(len(part)), [len(r[1]) for r in part])
            own, where = np.unique(at, return_inverse=True)
            zo, no = z[own], n[own]
            w = np.where(np.abs(zo) <= L1, 0.0, -(zo - np.sign(zo) * L1) / ((BETA + np.sqrt(no)) / ALPHA + L2))
            bias = -zb / ((BETA + np.sqrt(nb)) / ALPHA)
            contribution = x[:, None] * w[where]
            logits = np.stack([np.bincount(row, contribution[:, k], len(part)) for k in range(len(langs))], 1) + bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(part)), [r[0] for r in part]] -= 1
            error = x[:, None] * p[row]
            grad = np.stack([np.bincount(where, error[:, k], len(own)) for k in range(len(langs))], 1)
            sigma = (np.sqrt(no + grad ** 2) - np.sqrt(no)) / ALPHA
            z[own] = zo + grad - sigma * w
            n[own] = no + grad ** 2
            gb = p.sum(0)
            zb, nb = zb + gb - (np.sqrt(nb + gb ** 2) - np.sqrt(nb)) / ALPHA * bias, nb + gb ** 2
    model.weights = np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))
    model.bias = -zb / ((BETA + np.sqrt(nb)) / ALPHA)
    if check and len(langs) > 1:
        logits = np.stack([x @ model.weights[at] + model.bias for _, at, x in check])
        target = np.array([k for k, _, _ in check])
        losses = []
        for t in (grid := np.geomspace(0.05, 10, 60)):
            model.temperature = t
            losses.append(-np.log(model.probabilities(logits)[np.arange(len(target)), target] + 1e-12).mean())
        model.temperature = float(grid[int(np.argmin(losses))])
    return model


def _counted(texts: pd.Series) -> pd.DataFrame:
    at, count = [], []
    for t in texts:
        c = ngram_counts(t)
        own = np.flatnonzero(c) if _LETTER.search(t) else np.zeros(0, np.int64)
        at.append(own.astype(np.int32))
        count.append(c[own].astype(np.int32))
    return pd.DataFrame({"at": at, "n": count})


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fitted on about ``sample_rows`` whole texts of ``docs`` (doc_id, text, lang) at
    most, and more of languages that have fewer than LANGUAGE_ROWS of these; chosen by a
    hash of the key. Rows without text, letter or lang don't count."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    n = docs.where(F.col("lang").isNotNull()).count()
    share = min(sample_rows / max(n, 1), 1.0)
    shares = docs.groupBy("lang").agg(F.greatest(F.lit(share), F.lit(float(LANGUAGE_ROWS)) / F.count("*")).alias("share"))  # a row per language
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("language")), F.lit(1 << 30))
    shares = F.broadcast(shares) if shares.count() <= MOST_LANGUAGES else shares
    chosen = rows.join(shares, "lang").where(place < F.floor(F.least("share", F.lit(1.0)) * F.lit(1 << 30)))
    got = chosen.select("lang", F.pandas_udf(_counted, "at array<int>, n array<int>")("text").alias("f")).select("lang", "f.at", "f.n").where(F.size("at") > 0).toPandas()
    return fit([(lang, np.asarray(at, np.int64), np.asarray(c, np.float64)) for lang, at, c in sorted(zip(got.lang, got["at"], got.n), key=lambda r: (r[0], len(r[1]), int(np.sum(r[2]))))])


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` (``und`` for a text that is null or has no letter)
    and ``score``, the calibrated probability (0 for ``und``). One narrow pass over
    whole texts; columns with these names are replaced."""
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([model.predict(t) for t in texts], columns=["lang_pred", "score"])
    keep = [F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score")]
    got = F.pandas_udf(predict, "lang_pred string, score double")(F.col(f"`{text_col}`")).alias("__lang")
    return docs.select(*keep, got).select(*keep, "__lang.lang_pred", "__lang.score")


def op10_language(spark, sf_dir: str) -> DataFrame:
    """Language of every whole text of ``documents``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(crc_mod(F.col("doc_id"), 4) == 2, F.lit(False))
    model = train(docs.where(F.coalesce(crc_mod(F.col("doc_id"), 4) != 2, F.lit(False))))
    return identify(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
