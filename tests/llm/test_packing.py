import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from mesonlab.llm import packing as P
from mesonlab.llm.common import written
from tests.llm.helpers import EDGE, SF, frame


def check(rows, docs, capacity=1024):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for i, t in docs:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        for k, (s, n) in enumerate(P.cut(len(ids), capacity)):
            want[i, k, s, n, zlib.crc32(np.array(ids[s:s + n], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= capacity
    return len(by)


def best_fit_decreasing(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= n]
        if fits:
            g = min(fits)
            gaps.remove(g)
            gaps.append(g - n)
        else:
            gaps.append(capacity - n)
    return len(gaps)


def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = P.op3_packing(spark, SF).collect()
    n = check(rows, [(r.doc_id, r.text) for r in docs.collect()])
    assert n == best_fit_decreasing([r.length for r in rows], 1024)
    assert n <= -(-sum(r.length for r in rows) // 1024) * 1.02 + 1


def test_edge_rows(spark):
    rows = [*EDGE, (30, "a<|endoftext|>b"), (31, "<|endoftext|>" * 3)]
    df = frame(spark, rows).withColumn("piece", F.lit("x")).withColumn("rank", F.lit(1))
    check(P.pack_documents(df).collect(), rows)
    assert P.pack_documents(df.limit(0)).count() == 0


def test_sequences_round_trip(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    placed = written(P.pack_documents(docs), "placed")
    lengths = {r.sequence_id: r.n for r in placed.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()}
    assert {r.sequence_id: len(r.ids) for r in P.sequences(placed, docs).collect()} == lengths


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 19), st.integers(1, 40), max_size=12))
def test_rounds_are_best_fit_decreasing(counts):
    plan = P.best_fit_rounds(counts, 20)
    bins, seen = {}, Counter()
    for length, lo, hi, each, first, base in plan:
        assert lo == seen[length]
        seen[length] = hi
        for r in range(lo, hi):
            bins.setdefault(first + (r - lo) // each, []).append((base + (r - lo) % each * length, length))
    assert seen == counts
    for parts in bins.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 20
    assert len(bins) == best_fit_decreasing([k for k, n in counts.items() for _ in range(n)], 20)
