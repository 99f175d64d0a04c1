"""Cross-tokenizer alignment against tokenising and linking in plain Python."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from mesonlab.llm import alignment as A
from mesonlab.llm import queries as Q
from tests.llm.helpers import EDGE, SF, duck, frame

ODD = [(20, " two  spaces\tand\n\nbreaks <|endoftext|> </s> <s> <unk> <0x41>"), (21, "▁ a lower one eighth block is no space"), (22, "\x00 zero, é́ ﬁ Å"), (23, "漢字かな交じり文 😀👍🏽 ½²"), (24, "    " * 50 + "12345 6789.0" * 9)]


def _tools():
    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    place = {chr(b): b for b in keep} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in keep)}
    return a, place, sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))


TOOLS = _tools()


def tokens(text):
    a, place, b = TOOLS
    whole = (" " + text).encode()
    x = a.encode(" " + text, add_special_tokens=False)
    xs = [(i, bytes(place[c] for c in a.id_to_token(i))) for i in x.ids]
    ys = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
    return (xs, ys) if text and b"".join(w for _, w in xs) == whole == b"".join(w for _, w in ys) else ([], [])


def grouped(xs, ys):
    ends = [list(np.cumsum([len(w) for _, w in t])) for t in (xs, ys)]
    cuts, out = sorted(set(ends[0]) & set(ends[1])), []
    for lo, hi in zip([0, *cuts], cuts):
        out.append(tuple([i for (i, _), e in zip(t, es) if lo < e <= hi] for t, es in zip((xs, ys), ends)))
    return out


def brute(docs):
    held = [(i, *tokens(t or "")) for i, t in docs]
    held = [(i, x, y, grouped(x, y)) for i, x, y in held]
    linked = [Counter((p, q) for ps, qs in g for p in ps for q in qs) for _, _, _, g in held]
    count = Counter(k for c in linked for k in c)
    most = {}
    for (p, _), n in count.items():
        most[p] = max(most.get(p, 0), n)
    out = []
    for (i, x, y, g), c in zip(held, linked):
        sha = hashlib.sha256(";".join(f"{','.join(map(str, p))}|{','.join(map(str, q))}" for p, q in g).encode()).hexdigest() if x else ""
        out.append((i, len(x), len(y), len(g), sum(c.values()), sum(n for k, n in c.items() if count[k] == most[k[0]]), sum(n * count[k] for k, n in c.items()), sha))
    return out, count, sum(linked, Counter())


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def rows(df):
    return sorted(map(repr, (tuple(r) for r in df.select(COLUMNS).collect())))


def test_edge_cases(spark):
    docs = [(i, t if t is None else t[:3000]) for i, t in EDGE] + ODD
    want, count, linked = brute(docs)
    extra = frame(spark, docs).withColumn("bucket", F.lit("x")).withColumn("n_a", F.lit(1)).withColumn("block", F.lit(None).cast("int"))
    assert rows(A.align(extra)) == sorted(map(repr, want))
    index = A.pair_index(frame(spark, docs))
    assert {(r.a_id, r.b_id): (r.n_docs, r.n_links) for r in A.pair_totals(index).collect()} == {k: (count[k], linked[k]) for k in count}
    assert A.align(frame(spark, [])).columns == COLUMNS and A.align(frame(spark, [])).count() == 0
    assert [r.doc_id for r in A.align(frame(spark, [("x", "text id")], "doc_id string, text string")).collect()] == ["x"]


def test_real_texts_in_small_blocks(spark):
    docs = [(r.doc_id, r.text) for r in duck("SELECT doc_id, text FROM documents").itertuples()]
    want = sorted(map(repr, brute(docs)[0]))
    assert rows(Q.QUERIES["op12_alignment"](spark, SF)) == want


def test_repeated_long_text(spark):
    text = "abc def " * 100_000
    got = A.align(frame(spark, [(1, text), (2, text), (2, text)])).collect()
    assert len({tuple(r)[1:] for r in got}) == 1 and got[0].n_best <= got[0].n_links and got[0].count_sum == 3 * got[0].n_links


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab  \n\t1é漢<|>▁.😀"), max_size=60), max_size=5), st.integers(1, 40))
def test_groups_and_links(texts, limit):
    al, before = A.aligner(), (A.GROUP_PAIRS, A.STEP_PAIRS)
    ok, a, b = al.tokens(texts)
    want = [tokens(t) for t in texts]
    assert [bool(x) for x, _ in want] == ok.tolist()
    g = A.groups(al, a, b)
    A.GROUP_PAIRS, A.STEP_PAIRS = limit, limit
    try:
        found = Counter()
        for key, n in A.links(al, a, b, g, np.flatnonzero(ok)):
            for k, m in zip(key.tolist(), n.tolist()):
                found[k & 0xFFFF, (k >> 16) // al.size_b, (k >> 16) % al.size_b] += m
    finally:
        A.GROUP_PAIRS, A.STEP_PAIRS = before
    assert found == Counter((i, p, q) for i, (x, y) in enumerate(want) for ps, qs in grouped(x, y) for p in ps for q in qs)
    assert A.digests(al, a, b, g) == [hashlib.sha256(";".join(f"{','.join(map(str, p))}|{','.join(map(str, q))}" for p, q in grouped(x, y)).encode()).hexdigest() for x, y in want if x]


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 70), st.lists(st.dictionaries(st.integers(0, 69), st.integers(1, 300), min_size=1, max_size=60), min_size=1, max_size=8))
def test_bitmaps(docs, pairs):
    pairs = [{k % docs: v for k, v in p.items()} for p in pairs]
    flat = [(k, p[k]) for p in pairs for k in sorted(p)]
    df, number, times = np.array([len(p) for p in pairs]), np.array([f[0] for f in flat]), np.array([f[1] for f in flat])
    got = A._postings(df, A._bitmaps(docs, df, number, times))
    assert got[0].tolist() == number.tolist() and got[1].tolist() == times.tolist()
