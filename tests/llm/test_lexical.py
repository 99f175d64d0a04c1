"""Ranked lexical search against scoring every document in plain Python."""

import math
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mesonlab.llm import lexical as X
from mesonlab.llm import queries as Q
from tests.llm.helpers import EDGE, SF, duck, frame, same

LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return re.findall(X.WORDS, (text or "").translate(LOWER))


def brute(docs, items, k):
    held = [(i, Counter(words(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in held:
            m, s = 25 + 75 * sum(c.values()) * n // total, 0
            for t in words(text):
                if t in c:
                    s += math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m))
            if s > 0:
                scores.append((-s, i is None, i, s))
        out += [(item, r + 1, x[2], x[3]) for r, x in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return out


ITEMS = [(1, "one Two three three"), (2, None), (3, "..."), (4, "same text HERE same"), (4, "word ß"), (None, "xxx no id"), (5, "absent")]


def test_edge_cases(spark):
    got = X.search(frame(spark, EDGE), frame(spark, ITEMS, "item_id long, text string"))
    key = lambda rows: sorted(map(repr, rows))
    assert key(tuple(r) for r in got.collect()) == key(brute(EDGE, ITEMS, 10))


def test_blocks_shards_clashing_names(spark, monkeypatch):
    monkeypatch.setattr(X, "SHARD_POSTINGS", 8)
    monkeypatch.setattr(X, "BEAM", 2)
    rng = np.random.default_rng(3)
    docs = [(i, " ".join(f"t{int(w)}" for w in rng.zipf(1.4, rng.integers(0, 30)) if w < 60)) for i in range(400)]
    items = [(i, " ".join(f"t{int(w)}" for w in rng.zipf(1.4, 12) if w < 60)) for i in range(40)]
    extra = frame(spark, docs).withColumn("score", F.lit(1)).withColumn("rank", F.lit("x")).withColumn("item_id", F.lit(0))
    asked = frame(spark, items, "item_id long, text string").withColumn("doc_id", F.lit(9))
    want = sorted(brute(docs, items, 5))
    for terms in (X.BLOCK_TERMS, 60):
        monkeypatch.setattr(X, "BLOCK_TERMS", terms)
        assert sorted(map(tuple, X.search(extra, asked, k=5).collect())) == want


def test_empty_tables_and_text_ids(spark):
    none = frame(spark, [])
    assert X.search(none, frame(spark, ITEMS, "item_id long, text string")).count() == 0
    assert X.search(frame(spark, EDGE), frame(spark, [], "item_id long, text string")).count() == 0
    got = X.search(frame(spark, [("b", "x y"), ("a", "x y"), ("c", "z")], "doc_id string, text string"), frame(spark, [("q", "x")], "item_id string, text string"), k=1)
    assert [tuple(r)[:3] for r in got.collect()] == [("q", 1, "a")]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aB1 ,é漢\x7f", max_size=40), max_size=6), st.integers(1, 6))
def test_counts(texts, size):
    terms = sorted({w for t in texts for w in words(t)})[::2]
    many = np.zeros(len(texts), int)
    found = Counter()
    for first, n, row, term, tf in X._counted(texts, X.Terms(terms)):
        many[first:first + len(n)] = n
        for r, t, c in zip(row, term, tf):
            found[first + r, terms[t]] += c
    assert many.tolist() == [len(words(t)) for t in texts]
    assert found == Counter({(i, w): c for i, t in enumerate(texts) for w, c in Counter(words(t)).items() if w in terms})


def test_long_text_in_blocks():
    text = "ab, Cd éf " * 200_000 + "x" * 3_000_000
    (_, n, row, term, tf), = X._counted([text], X.Terms(["cd", "x" * 3_000_000, "ab"]))
    assert n.tolist() == [600_001] and dict(zip(term, tf)) == {0: 200_000, 1: 1, 2: 200_000}


def test_registered_query(spark):
    same(Q.QUERIES["op13_lexical_search"](spark, SF).toPandas(), duck(X.ORACLE_OP13))
