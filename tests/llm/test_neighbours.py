"""Approximate nearest neighbours against comparing everything."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from mesonlab.llm import neighbours as N
from mesonlab.llm import queries as Q
from tests.llm.helpers import SF, duck, frame

VECTORS = "vec_id long, embedding array<float>"


def brute(rows, asked, k):
    """{(query, vector's place)}: the k best (score, id) of each query."""
    good = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    good = list({(i, v.tobytes()): (i, v) for i, v in good}.values())
    out = []
    for i, v in good:
        if asked(i):
            best = sorted((-float(v @ w), j) for j, w in good if j != i and len(w) == len(v))[:k]
            out.append((i, [(j, -s) for s, j in best]))
    return out


def recall(found, want):
    got = {}
    for r in found:
        got.setdefault(r.query_id, {})[r.vec_id] = r
    hits = total = 0
    for i, best in want:
        own = got.get(i, {})
        assert len(own) == len(best)
        ranked = sorted(own.values(), key=lambda r: r.rank)
        assert [r.rank for r in ranked] == list(range(1, len(own) + 1))
        assert all((a.score, -a.vec_id) > (b.score, -b.vec_id) for a, b in zip(ranked, ranked[1:]))
        least = best[-1][1] - 1e-9 if best else 0
        hits, total = hits + sum(r.score >= least for r in own.values()), total + len(best)
    return hits / max(total, 1)


def test_registered_query(spark):
    rows = [(r.vec_id, r.embedding.tolist()) for r in duck("SELECT vec_id, embedding FROM embeddings").itertuples()]
    found = Q.QUERIES["op11_neighbours"](spark, SF).collect()
    want = brute(rows, lambda i: i % 20 == 0, 20)
    assert recall(found, want) >= 0.99
    scores = {(i, j): s for i, best in want for j, s in best}
    assert all(abs(r.score - scores[r.query_id, r.vec_id]) < 1e-12 for r in found if (r.query_id, r.vec_id) in scores)


@pytest.mark.parametrize("lengths", [False, True])
def test_recall_on_groups_and_copies(spark, monkeypatch, lengths):
    """Thirty groups, one of them of a third of all rows, and hundreds of copies of one vector."""
    for name, value in (("START_BLOCK", 128), ("STARTS", 4), ("JOINED", 700), ("PART", 32), ("ENTRIES", 64)):
        monkeypatch.setattr(N, name, value)
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(30, 24))
    of = np.where(rng.random(2400) < 1 / 3, 0, rng.integers(0, 30, 2400))
    x = centre[of] + 0.5 * rng.normal(size=(2400, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if lengths:
        x *= rng.uniform(0.5, 2, (2400, 1))
    x[:400] = x[0]
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x)]
    df = frame(spark, rows, VECTORS).withColumn("node", F.lit(1)).withColumn("rank", F.lit("x"))
    found = N.nearest_vectors(df, df.where("vec_id % 50 = 0")).collect()
    assert recall(found, brute(rows, lambda i: i % 50 == 0, 20)) >= 0.95


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(None, [1.0, 2.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]),
            (20, [1.0, 0.0]), (20, [1.0, 0.0]), (21, [1.0, 0.0]), (22, [-1.0, 0.5]), (23, [3.0, 1.0]), (40, [1.0, 1.0, 1.0]), (41, [2.0, 1.0, 0.0]), (60, [5.0])]
    df = frame(spark, rows, VECTORS)
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in N.nearest_vectors(df, df.where("vec_id % 20 = 0"), k=2).collect()}
    assert got == {(20, 1): (23, 3.0), (20, 2): (21, 1.0), (40, 1): (41, 3.0)}
    none = df.limit(0)
    assert N.nearest_vectors(none, none).count() == 0 and N.nearest_vectors(df, none).count() == 0
    assert N.nearest_vectors(none, none).columns == ["query_id", "rank", "vec_id", "score"]


def test_other_queries_and_doubles(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (1e200 * v).tolist()) for i, v in enumerate(rng.normal(size=(300, 8)))]
    asked = [(1000 + i, (1e-200 * v).tolist()) for i, v in enumerate(rng.normal(size=(10, 8)))]
    kind = "vec_id long, embedding array<double>"
    found = N.nearest_vectors(frame(spark, rows, kind), frame(spark, asked, kind), k=5).collect()
    want = {i: sorted((-float(np.array(v) @ np.array(w)), j) for j, w in rows)[:5] for i, v in asked}
    assert {(r.query_id, r.rank): r.vec_id for r in found} == {(i, k + 1): j for i, best in want.items() for k, (_, j) in enumerate(best)}
