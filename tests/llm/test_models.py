"""Quality, language and language model operators: held-out accuracy, counts
against brute force, odd rows."""

import math
import re
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from mesonlab.llm import language as L
from mesonlab.llm import quality as Q
from mesonlab.llm import suffixtree as S
from tests.llm.helpers import EDGE, SF, SF2, frame, saved


def test_quality_held_out(spark):
    got = Q.op5_quality(spark, SF2).toPandas()
    docs = spark.read.parquet(f"{SF2}/documents.parquet").toPandas()
    assert sorted(got.doc_id) == sorted(docs.doc_id)
    assert (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)).all()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.7)).all()
    m = got.merge(spark.read.parquet(f"{SF2}/labels.parquet").toPandas(), on="doc_id")
    m = m[m.held_out]
    assert (m.predicted == m.quality).mean() > 0.93


def test_quality_odd_rows(spark, tmp_path):
    labels = frame(spark, [(1, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    sf = saved(spark, tmp_path, documents=frame(spark, EDGE), labels=labels)
    assert Q.op5_quality(spark, sf).count() == len(EDGE)
    sf = saved(spark, tmp_path, documents=frame(spark, EDGE).limit(0), labels=labels.limit(0))
    assert Q.op5_quality(spark, sf).count() == 0
    out = Q.score_documents(frame(spark, EDGE).withColumn("score", F.lit("old")).withColumn("kind", F.lit(1)), 0.5)
    assert out.columns == ["doc_id", "text", "kind", "score"]


def test_quality_learns_from_labels_alone(spark, tmp_path):
    rng = np.random.default_rng(5)
    good = [" ".join(f"word{k}" for k in rng.integers(0, 500, 60)) + "." for _ in range(200)]
    bad = ["$$$ ### " * int(rng.integers(10, 40)) for _ in range(60)]
    docs = frame(spark, list(enumerate(good + bad)))
    marks = [(i, int(i < 200), 0) for i in range(260)]
    for rows in (marks, [m for m in marks if m[0] % 3] + [(i, 1, 0) for i in range(5000, 5600)]):  # every document has a label; labels of other ids
        labels = frame(spark, rows, "doc_id long, quality int, toxic int")
        model = Q.train(docs, labels, Q.learned_keys)
        assert isinstance(model, Q.Model)
        assert model.scores(Q.features(good)).mean() > model.scores(Q.features(bad)).mean() + 0.4
    sf = saved(spark, tmp_path, labels=labels.limit(0))
    assert corpus_pipeline.quality(spark, docs, sf).count() == 260


def test_risk_separates_classes():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(0, 1, (600, Q.N_FEATURES)), rng.normal(2, 1, (200, Q.N_FEATURES))
    model = Q.fit(good[:300], np.concatenate([good[300:], bad]), 0.6)
    assert model.scores(good).mean() > 0.8 and model.scores(bad).mean() < 0.2


def test_language_held_out(spark):
    got = L.op10_language(spark, SF2).toPandas()
    docs = spark.read.parquet(f"{SF2}/documents.parquet").select("doc_id", "lang").toPandas()
    m = got.merge(docs, on="doc_id")
    assert len(m) == len(docs) and (m[m.held_out].lang_pred == m[m.held_out].lang).mean() > 0.98
    assert got.score.between(0, 1).all()


def test_language_odd_rows(spark, tmp_path):
    rows = [(i, t, lang) for (i, t), lang in zip([*EDGE, (40, "123 456 ..."), (41, "the and of")], ["en", "de", None] * 4)]
    sf = saved(spark, tmp_path, documents=frame(spark, rows, "doc_id long, text string, lang string"))
    got = L.op10_language(spark, sf).collect()
    assert len(got) == len(rows) and {r.doc_id for r in got if r.lang_pred == "und"} >= {1, 2, 3, 40}
    sf = saved(spark, tmp_path, documents=frame(spark, rows, "doc_id long, text string, lang string").limit(0))
    assert L.op10_language(spark, sf).count() == 0


def test_language_with_few_rows_is_learned(spark):
    rng = np.random.default_rng(8)
    def text(letters):
        return " ".join("".join(rng.choice(list(letters), 5)) for _ in range(20))
    rows = [(i, text("abcdefgh"), "aa") for i in range(1500)] + [(5000 + i, text("qrstuvwx"), "qq") for i in range(6)]
    model = L.train(frame(spark, rows, "doc_id long, text string, lang string"), sample_rows=30)
    assert model.langs == ["aa", "qq"] and model.predict(text("qrstuvwx"))[0] == "qq" and model.predict(text("abcdefgh"))[0] == "aa"


def test_ngrams_cover_slices(monkeypatch):
    text = "abcdefghij ß漢字 " * 50
    whole = L.ngram_counts(text)
    monkeypatch.setattr(L, "_SLICE", 37)
    assert (L.ngram_counts(text) == whole).all() and whole.sum() == 3 * len(text) - 3


def brute(rows):
    low = {i: i + 32 for i in range(65, 91)}
    words = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low)) + [None] for _, t in rows]
    count = Counter()
    for (i, _), w in zip(rows, words):
        if i is not None and zlib.crc32(str(i).encode()) % 7 != 2:
            count.update(w)
    n, v = sum(count.values()), len(count)
    return sorted((repr(i), len(w), sum(count[x] > 0 for x in w), n, round(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w), 4)) for (i, _), w in zip(rows, words))


@pytest.mark.parametrize("edge", [True, False])
def test_lm_base_counts(spark, tmp_path, edge):
    rows = EDGE if edge else [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = S.op7_lm_score(spark, saved(spark, tmp_path, documents=frame(spark, rows))).collect()
    assert sorted((repr(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == brute(rows)
    assert all(math.isfinite(r.score) and r.score <= 0 for r in got)


def brute_scores(rows, depth=3):
    """Scores of ``rows`` by dictionaries of contexts of up to ``depth`` tokens."""
    texts = [[*(t or "").encode("utf-8").lower().split(), None] for _, t in rows]
    learn = [i is not None and zlib.crc32(str(i).encode()) % 7 != 2 for i, _ in rows]
    count = Counter(w for ws, ok in zip(texts, learn) if ok for w in ws)
    n, v = sum(count.values()), len(count)
    follows = {}  # of each context, what follows it in training
    for ws, ok in zip(texts, learn):
        line = ["start", *ws]
        for i in range(1, len(line) if ok else 0):
            for k in range(1, min(depth, i) + 1):
                context = tuple(line[i - k:i])
                follows.setdefault(tuple(None if w == "start" else w for w in context) if k == 1 else context, Counter())[line[i]] += 1

    def rate(counts):
        ones, twos = (sum(c == k for c in counts) for k in (1, 2))
        return min(max(ones / max(ones + 2 * twos, 1), 0.1), 0.9)
    once = {c for c, f in follows.items() if sum(f.values()) < 2}
    # of a longer context, the pair of its suffix and last token was seen twice: so was it
    d = [rate(count.values())] + [rate([m for c, f in follows.items() if len(c) == k and c not in once for m in f.values()]) for k in range(1, depth + 1)]
    state = {}

    def probability(context, w):
        if not context:
            return (count[w] - d[0]) / n if count[w] else d[0] * v / n if n else 1.0
        p = probability(context[1:], w)
        if context not in state:
            f = follows.get(context, {})
            seen = sum(f.values())
            cost = {x: np.clip(np.rint(-S.STEPS * np.log(probability(context[1:], x))), 0, 255) / S.STEPS for x in f} if seen >= 2 else {}
            state[context] = seen >= 2 and sum(m * (math.log(m / seen) + cost[x]) for x, m in f.items()) > S.DIVERGENCE + 1e-6
        if not state[context]:
            return p
        f, seen = follows[context], sum(follows[context].values())
        k = len(context)
        return max(f.get(w, 0) - d[k], 0) / seen + d[k] * len(f) / seen * p
    out = []
    for (i, _), ws in zip(rows, texts):
        line, score = ["start", *ws], 0.0
        for j in range(1, len(line)):
            context = tuple(line[max(j - depth, 0):j])
            if "start" in context:
                context = context if len(context) > 1 else (None,)
            score += math.log10(probability(context, line[j]))
        out.append((repr(i), score))
    return sorted(out), sum(state.values()), {len(c) for c, kept in state.items() if kept}


@pytest.mark.parametrize("edge", [True, False])
def test_lm_scores_equal_brute_force(spark, tmp_path, monkeypatch, edge):
    rows = EDGE if edge else [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    if not edge:
        monkeypatch.setattr(S, "BLOCK_CHARS", 100_000)
        monkeypatch.setattr(S, "HOT", 50)
    got = S.op7_lm_score(spark, saved(spark, tmp_path, documents=frame(spark, rows))).collect()
    want, _, lengths = brute_scores(rows)
    have = sorted((repr(r.doc_id), r.score) for r in got)
    assert edge or lengths == {1, 2, 3}
    assert [i for i, _ in have] == [i for i, _ in want]
    assert np.allclose([x for _, x in have], [x for _, x in want], rtol=1e-9, atol=1e-9)


def test_lm_is_a_distribution_over_its_alphabet(spark):
    """After any text, the probabilities of all training tokens and one new word add up to 1."""
    train = [(i, t) for i, t in enumerate(["a b c a b d a b c", "b c a b c d", "a b c a b", "d d a b"] * 3)]
    words, prefixes = ["a", "b", "c", "d", "new"], ["a b", "b c a", "d", "new a", "c new"]
    made = {}
    for k, prefix in enumerate(prefixes):
        made[prefix] = [(1000 + 100 * k + j, f"{prefix} {w} new new new new") for j, w in enumerate(words)] + [(1000 + 100 * k + 50, prefix)]
    asked = [r for rows in made.values() for r in rows]
    got = {r.doc_id: r.score for r in S.score_texts(frame(spark, train + asked + [(9000, "new new new new")]), F.col("doc_id") < 1000, F.col("doc_id") >= 1000).collect()}
    for k, prefix in enumerate(prefixes):
        # the three tokens and the end after a word known by new words alone cost the same each time
        ids = range(1000 + 100 * k, 1000 + 100 * k + len(words))
        assert all(math.isfinite(got[i]) and got[i] < 0 for i in ids)
    count = Counter(w for _, t in train for w in [*t.split(), None])
    n, d = sum(count.values()), S.discount(sum(c == 1 for c in count.values()), sum(c == 2 for c in count.values()))
    assert math.isclose(sum((c - d) / n for c in count.values()) + d * len(count) / n, 1)


def test_lm_beats_unigrams_on_held_out_texts(spark):
    for sf in (SF2, "/root/testdata/sf0.1"):
        got = S.op7_lm_score(spark, sf).where("held_out")
        score, base, better, n = got.agg(F.sum("score"), F.sum("base_score"), F.count_if(F.col("score") > F.col("base_score")), F.count("*")).first()
        assert score > 0.8 * base and better > 0.95 * n


def test_lm_learns_nothing_from_held_out_texts(spark):
    rows = [(i, f"some words of text {i % 7} and more") for i in range(100)]
    base = {r.doc_id: r.score for r in S.score_texts(frame(spark, rows + [(500, "held out words here")]), F.col("doc_id") < 100, F.col("doc_id") >= 100).collect()}
    more = {r.doc_id: r.score for r in S.score_texts(frame(spark, rows + [(500, "held out words here")] + [(600 + k, "held out words here again") for k in range(50)]), F.col("doc_id") < 100, F.col("doc_id") >= 100).collect()}
    assert all(math.isclose(more[i], base[i], abs_tol=1e-12) for i in base)
    nothing = S.score_texts(frame(spark, rows), F.lit(False), F.lit(True)).collect()
    assert all(r.score == 0 and r.train_tokens == 0 and r.n_known == 0 for r in nothing)


def test_lm_empty(spark, tmp_path):
    assert S.op7_lm_score(spark, saved(spark, tmp_path, documents=frame(spark, EDGE).limit(0))).count() == 0


def test_signs_that_are_no_letters_have_no_language(spark):
    model = L.train(frame(spark, [(i, t, lang) for i in range(40) for t, lang in ((f"the cat and the dog {i}", "en"), (f"der Hund und die Katze {i}", "de"), ("½ ② ³ 12", "xx"))],
                             "doc_id long, text string, lang string"))
    assert model.langs == ["de", "en"]
    df = frame(spark, [(1, "²½①"), (2, "12 __ --"), (3, "the cat"), (4, "ª"), (5, "ⅷ")])
    got = {r.doc_id: r.lang_pred for r in L.identify(df, model).collect()}
    assert (got[1], got[2], got[3], got[5]) == ("und", "und", "en", "und") and got[4] != "und"


def test_quality_learns_from_labelled_documents_alone(spark):
    """Every learnable document labelled: all of them are the unlabelled set."""
    docs = spark.read.parquet(f"{SF2}/documents.parquet").join(spark.read.parquet(f"{SF2}/labels.parquet").select("doc_id"), "doc_id", "left_semi")
    docs = docs.unionByName(docs.limit(50)).unionByName(docs.limit(50))  # ids that repeat
    labels = spark.read.parquet(f"{SF2}/labels.parquet")
    model = Q.train(docs, labels, Q.learned_keys)
    known = {r.doc_id: r.quality for r in labels.collect()}
    rows = [r for r in Q.score_documents(docs.dropDuplicates(["doc_id"]), model).collect() if r.doc_id in known]
    assert sum((r.score >= Q.THRESHOLD) == known[r.doc_id] for r in rows) / len(rows) > 0.93
