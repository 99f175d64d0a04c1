"""Near duplicates of texts and vectors, repeated lines: against brute force."""

import random
import re
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mesonlab.llm import common
from mesonlab.llm import embeddings as E
from mesonlab.llm import lines as L
from mesonlab.llm import minhash as M
from mesonlab.llm.components import components
from tests.llm.helpers import EDGE, SF, frame, saved


def groups(nodes, edges):
    up = {i: i for i in nodes}
    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in edges:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {i: root(i) for i in nodes}


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 340)] + [(400, i) for i in range(401, 450)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = groups({x for e in edges for x in e}, edges)
    assert got == {i: c for i, c in want.items() if any(a != b and i in (a, b) for a, b in edges)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingles(text, size=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    return {tuple(w[k:k + size]) for k in range(max(len(w) - size + 1, 1))} if w else set()


def copies():
    """A family of near copies around the threshold, short texts and exact copies."""
    rng = random.Random(1)
    base = [f"w{rng.randrange(400)}" for _ in range(120)]
    rows = []
    for i in range(60):
        w = list(base)
        for _ in range(rng.randrange(0, 9)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(900)}"
        rows.append((1000 + i, " ".join(w)))
    rows += [(2000 + i, "same words in all of these texts here") for i in range(20)]
    rows += [(3000 + i, " ".join(f"z{k}" for k in range(i, i + 12))) for i in range(8)]
    return rows


@pytest.mark.parametrize("rows", [[*EDGE, *copies()], None], ids=["made", "documents"])
def test_near_duplicates(spark, tmp_path, rows):
    rows = rows or [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = M.op4_near_duplicates(spark, saved(spark, tmp_path, documents=frame(spark, rows))).collect()
    sets = {i: shingles(t) for i, t in rows if i is not None}
    links = [(a, b) for a, b in combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = groups(sets, links)
    assert sorted(map(repr, (r.doc_id for r in got))) == sorted(repr(i) for i, _ in rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), want[r.doc_id], want[r.doc_id] == r.doc_id)


def test_near_duplicates_empty(spark):
    assert M.near_duplicates(frame(spark, EDGE).limit(0)).count() == 0


def test_estimate_follows_similarity():
    rng = np.random.default_rng(3)
    for n, shared in ((2000, 0.9), (60, 0.8), (9, 0.8)):
        errors = []
        for _ in range(40):
            h = np.unique(rng.integers(0, 1 << 63, 3 * n, dtype=np.uint64) * np.uint64(2))
            k = int(n * shared)
            a, b = h[rng.permutation(len(h))][:n], None
            b = np.concatenate([a[:k], h[~np.isin(h, a)][:n - k]])
            true = k / (2 * n - k)
            errors.append((M.registers(np.sort(a)) == M.registers(np.sort(b))).mean() - true)
        assert abs(np.mean(errors)) < 0.06


def vectors():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] + rng.normal(size=8) * 0.35).astype(np.float32).tolist()) for i in range(300)]
    rows += [(500 + i, rows[3][1]) for i in range(30)]
    return rows + [(600, None), (601, [0.0] * 8), (602, [1.0, None] + [0.0] * 6), (603, [float("nan")] + [1.0] * 7), (604, [float("inf")] + [1.0] * 7), (605, [1.0, 2.0]), (606, [2.0, 4.0]), (607, [])]


def test_vectors(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(E, "INTERVAL", 64)
    monkeypatch.setattr(E, "LEAF", 16)
    rows = vectors()
    df = frame(spark, rows, "vec_id long, embedding array<float>").withColumn("label", F.lit(1)).withColumn("ok", F.lit(2))
    got = {r.vec_id: r for r in E.op8_embeddings(spark, saved(spark, tmp_path, embeddings=df)).collect()}
    good = {i: np.array(v, float) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    links = [(a, b) for a, b in combinations(good, 2) if len(good[a]) == len(good[b]) and good[a] @ good[b] / np.sqrt((good[a] @ good[a]) * (good[b] @ good[b])) >= 0.9]
    want, n = groups([i for i, _ in rows], links), defaultdict(int)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    assert {i: (r.n_links, r.component_id, r.kept) for i, r in got.items()} == {i: (n[i], want[i], want[i] == i) for i, _ in rows}
    assert E.near_vectors(df.limit(0)).count() == 0


@pytest.mark.parametrize("parts", [1, 40])
def test_links_between_distant_intervals_in_64_dimensions(spark, monkeypatch, parts):
    """Links whose vectors lie far apart in the grid order, over several levels of boxes and
    whatever the partitions; intervals are numbered over the whole sequence."""
    for name, value in (("INTERVAL", 16), ("LEAF", 4), ("FAN", 3)):
        monkeypatch.setattr(E, name, value)
    made = []
    near = E._near_boxes
    monkeypatch.setattr(E, "_near_boxes", lambda box, count, eps: made.append((count, near(box, count, eps))) or made[-1][1])
    rng = np.random.default_rng(8)
    x = rng.normal(size=(600, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    turned = rng.normal(size=(60, 64))
    turned -= (turned * x[:60]).sum(1, keepdims=True) * x[:60]
    turned /= np.linalg.norm(turned, axis=1, keepdims=True)
    y = 0.92 * x[:60] + np.sqrt(1 - 0.92 ** 2) * turned  # cosines of 0.92: neighbouring cells on some coordinates
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(np.concatenate((x, y)))]
    got = {r.vec_id: (r.n_links, r.component_id) for r in E.near_vectors(frame(spark, rows, "vec_id long, embedding array<float>").repartition(parts)).collect()}
    good = np.array([v for _, v in rows], np.float64)
    good /= np.linalg.norm(good, axis=1, keepdims=True)
    links = [(a, b) for a, b in zip(*np.nonzero(good @ good.T >= 0.9)) if a < b]
    want, n = groups(range(660), links), defaultdict(int)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    assert len(links) >= 60 and got == {i: (n[i], want[i]) for i in range(660)}
    (count, pairs), = made
    assert count == 42 and pairs.count() <= 42 * 43 // 2 and pairs.distinct().count() == pairs.count()


def test_vectors_of_doubles(spark):
    tilt = lambda c: [c, float(np.sqrt(1 - c * c))]
    rows = [(1, [1.0, 0.0]), (2, tilt(0.9 - 2e-9)), (3, [-1e200, 0.0]), (4, [-2e200, 1e190]), (5, [0.0, -1e-200]), (6, [0.0, -3e-200])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in E.near_vectors(frame(spark, rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {1: (0, 1), 2: (0, 2), 3: (1, 3), 4: (1, 3), 5: (1, 5), 6: (1, 5)}


PASSAGE = "This passage has quite a few words in it. It is long enough to be found in every text that holds it, whatever stands around it here."


def brute_lines(rows, key, least=25):
    """All but the first occurrence of every run of lines with enough words."""
    cut = {i: L.lines(t) for i, t in rows}
    seen = defaultdict(list)
    for i, t in rows:
        norm = [x.lower().split() for x in cut[i]]
        for s in range(len(norm)):
            for e in range(s, len(norm)):
                if sum(map(len, norm[s:e + 1])) >= least:
                    seen[tuple(" ".join(x) for x in norm[s:e + 1])].append((key[i], s, e, i))
    gone = defaultdict(set)
    for places in seen.values():
        first = min(places)
        for p in places:
            if p[:2] > first[:2]:
                gone[p[3]].update(range(p[1], p[2] + 1))
    return {i: "".join(x for k, x in enumerate(cut[i]) if k not in gone[i]) if gone[i] else t for i, t in rows}


def test_lines(spark, tmp_path):
    rows = [(1, None), (2, ""), (3, " \n "), (4, f"Start here.\n{PASSAGE}\nEnd one."), (5, f"Other start. {PASSAGE} And more.\nShort line."), (6, f"{PASSAGE} {PASSAGE}"), (7, "Short line.\nOther text"),
            (8, "Twice the same. " * 30), (9, PASSAGE.upper() + "\n\ntail"), (10, "x" * 30_000), (11, "one two three. " * 3)]
    df = frame(spark, rows)
    key = {r.doc_id: (r.doc_id, r.h) for r in df.selectExpr("doc_id", "xxhash64(text) h").collect()}
    got = {r.doc_id: r.text for r in L.op6_lines(spark, saved(spark, tmp_path, documents=df)).collect()}
    assert got == brute_lines(rows, key)
    assert PASSAGE in got[4] and all("quite a few" not in (got[i] or "").lower() for i in (5, 6, 9))


def test_lines_on_documents(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect() if len(r.text) < 4000]
    key = {r.doc_id: (r.doc_id, r.h) for r in df.selectExpr("doc_id", "xxhash64(text) h").collect()}
    got = {r.doc_id: r.text for r in L.dedup_lines(frame(spark, rows)).collect()}
    assert got == brute_lines(rows, key)


def without_passages(rows, size):
    """Words and all of each text, without the windows of ``size`` words that occur earlier."""
    seen, out = {}, {}
    for i, t in rows:
        words = [m.start() for m in re.finditer(r"\S+", t)]
        low = t.lower().split()
        gone = np.zeros(len(low), bool)
        for s in range(len(low) - size + 1):
            if seen.setdefault(tuple(low[s:s + size]), (i, s)) != (i, s):
                gone[s:s + size] = True
        ends = [0, *words[1:], len(t)]
        out[i] = "".join(t[a:b] for a, b, g in zip(ends, ends[1:], gone) if not g) if gone.any() else t
    return out


def test_passages_across_line_ends(spark, tmp_path):
    rng = random.Random(9)
    made = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    long, cut = made(70), made(90)
    cut[20] += "."
    cut[31] += "."
    rows = [(1, " ".join([*made(30), *long, *made(30)])), (2, " ".join([*made(10), *long, *made(15)])), (3, " ".join(["Before", *cut, "after."])), (4, " ".join([*made(9), *cut, *made(9)])),
            (5, " ".join([*made(12), *long[:49], *made(12)])), (6, " ".join([*made(5), *cut[25:75], *made(3), *long[5:60], "end"])), (7, " ".join(long + long))]
    got = {r.doc_id: r for r in L.op6_lines(spark, saved(spark, tmp_path, documents=frame(spark, rows))).collect()}
    assert {i: r.text for i, r in got.items()} == without_passages(rows, 50)
    assert [got[i].words_removed for i in range(1, 8)] == [0, 70, 0, 90, 0, 105, 140]
    assert got[1].n_removed == 0 and got[2].n_removed == 1


def test_lowest():
    h = np.random.default_rng(1).integers(0, 9, 60, dtype=np.uint64)
    for window in (1, 2, 3, 35, 60, 61):
        assert L._lowest(h, window).tolist() == [s + int(h[s:s + window].argmin()) for s in range(60 - window + 1)]


def test_lines_odd_rows(spark):
    df = frame(spark, [*EDGE, (None, PASSAGE), (None, PASSAGE)]).withColumn("row", F.lit(1)).withColumn("runs", F.lit(2)).withColumn("k1", F.lit(3)).withColumn("n_removed", F.lit(4))
    out = L.dedup_lines(df)
    assert out.count() == len(EDGE) + 2 and out.columns == ["doc_id", "text", "row", "runs", "k1", "n_removed", "words_removed"]
    assert L.dedup_lines(df.limit(0)).count() == 0


@pytest.mark.parametrize("size", [4, 9, 17])
def test_line_hashes_agree_with_lines_over_blocks(monkeypatch, size):
    monkeypatch.setattr(common, "BLOCK_BYTES", size)
    rng = random.Random(size)
    texts = ["word \nnext line \n and \t\n more. Then  \n  ", " \n a", *["".join(rng.choice("ab .\n\té ") for _ in range(80)) for _ in range(60)]]
    for first, hashes, words, offsets in L.line_hashes(texts):
        for k in range(len(offsets) - 1):
            assert [len(p.split()) for p in L.lines(texts[first + k])] == words[offsets[k]:offsets[k + 1]].tolist()


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="ab .!?\n\té", max_size=40), min_size=1, max_size=6))
def test_line_hashes_agree_with_lines(texts):
    for first, hashes, words, offsets in L.line_hashes(texts):
        for k in range(len(offsets) - 1):
            parts = L.lines(texts[first + k])
            assert "".join(parts) == (texts[first + k] if parts else "")
            assert [len(p.split()) for p in parts] == words[offsets[k]:offsets[k + 1]].tolist()


def test_line_ends_and_windows_equal_plain_code():
    """Words that end a line, the shortest windows of each line, and each window's longest line."""
    rng = np.random.default_rng(3)
    for text in ("", "\n", "\n\na b\nc. d", "a\n", " a ", *("".join(rng.choice(list("ab \n.!\t"), 80)) for _ in range(40))):
        raw = np.frombuffer(text.encode(), np.uint8)
        start, end = common._edges(raw, common.WORD_BYTES["nonspace"])
        after = [*start[1:], len(text)]
        assert common._line_ends(raw, start, end).tolist() == [text[e - 1] in ".!?" or "\n" in text[e:a] for e, a in zip(end, after)]
    for _ in range(30):
        words, hashes = rng.integers(1, 6, 40), rng.integers(0, 3, 40, dtype=np.uint64)
        offsets = np.array([0, 0, 13, 30, 40])
        runs = L.windows(words, offsets, 9)
        want = set()
        for lo, hi in zip(offsets, offsets[1:]):
            for i in range(lo, hi):
                want |= {(i, next((j for j in range(i, hi) if words[i:j + 1].sum() >= 9), None)), (next((j for j in range(i, lo - 1, -1) if words[j:i + 1].sum() >= 9), None), i)}
        assert list(map(tuple, runs.tolist())) == sorted(w for w in want if None not in w)
        assert L._longest(runs, words, hashes).tolist() == [min(range(a, b + 1), key=lambda i: (-words[i], hashes[i], i)) for a, b in runs.tolist()]
    assert L.windows(np.zeros(0, np.int64), np.array([0]), 9).shape == (0, 2)
