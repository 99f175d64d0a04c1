"""The pipeline: its stages in order, each one's decisions, odd tables."""

import zlib

import corpus_pipeline as C
from pyspark.sql import functions as F

from mesonlab.llm import packing as P
from mesonlab.llm.common import written
from tests.llm.helpers import EDGE, SF2, frame, saved
from tests.llm.test_duplicates import shingles
from tests.llm.test_packing import check


def test_stages(spark):
    docs = spark.read.parquet(f"{SF2}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF2}/labels.parquet").collect()}
    assert [n for n, _ in C.STAGES] == ["quality", "lines", "near", "leaks", "packing"]
    kept = {}
    now = docs
    for name, stage in C.STAGES[:-1]:
        before, now = now, written(stage(spark, now, SF2), name)
        assert now.dtypes == docs.dtypes
        kept[name] = {r.doc_id: r.text for r in now.collect()}
        assert set(kept[name]) <= {r.doc_id for r in before.collect()}
    held = [i for i, q in labels.items() if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum((i in kept["quality"]) == labels[i] for i in held) / len(held) > 0.93
    sets = [s for s in (shingles(t, 5) for t in kept["near"].values()) if s]
    assert all(100 * len(a & b) < 80 * len(a | b) for k, a in enumerate(sets) for b in sets[:k] if min(len(a), len(b)) >= 0.8 * max(len(a), len(b)))
    placed = C.STAGES[-1][1](spark, now, SF2).collect()
    check(placed, list(kept["leaks"].items()))


def test_odd_tables(spark, tmp_path):
    docs = frame(spark, EDGE).withColumn("lang", F.lit(None).cast("string")).withColumn("source", F.lit("s")).withColumn("n_chars", F.length("text").cast("long"))
    bench, labels = frame(spark, [(1, None)], "item_id long, text string"), frame(spark, [], "doc_id long, quality int, toxic int")
    sf = saved(spark, tmp_path, documents=docs, benchmark=bench, labels=labels)
    for _, stage in C.STAGES:
        stage(spark, docs, sf).collect()
        stage(spark, docs.limit(0), sf).collect()
    assert C.run(spark, sf).columns == P.pack_documents(docs).columns


CLASHING = ["score", "n_removed", "words_removed", "row", "key", "kept", "runs", "n_hit", "spans", "items", "turn", "k", "tie", "a.b"]


def test_columns_of_the_operators_names_are_handed_on(spark, tmp_path):
    docs = spark.read.parquet(f"{SF2}/documents.parquet").where("doc_id < 300")
    named = docs.select("*", *[F.concat(F.lit(f"{c}-"), F.col("doc_id").cast("string")).alias(c) for c in CLASHING])
    for name, stage in C.STAGES[:-1]:
        plain, extra = stage(spark, docs, SF2), stage(spark, named, SF2)
        assert extra.columns == named.columns, name
        rows = extra.collect()
        assert sorted((r.doc_id, r.text) for r in rows) == sorted((r.doc_id, r.text) for r in plain.collect())
        assert all(r[c] == f"{c}-{r.doc_id}" for r in rows for c in CLASHING), name


TEXT = "Some words that make a document of their own, and enough of them to be told from others by shingles."


def test_near_with_repeated_and_null_ids(spark):
    rows = [(1, TEXT), (1, TEXT), (1, "Another text under the same id, with words that the first one doesn't have at all."), (2, TEXT + " x"), (None, "A text without an id, but with words in it."),
            (None, "Another text without an id, which has other words."), (None, None), (3, ""), (4, None), (5, TEXT.upper())]
    docs = frame(spark, [(*r, k) for k, r in enumerate(rows)], "doc_id long, text string, place int")
    got = [(r.doc_id, r.text) for r in C.near(spark, docs, None).collect()]
    assert len(got) == len(set(got)) == 7
    assert sum(t is not None and t.lower().startswith(TEXT.lower()) for _, t in got) == 1
    assert {(None, rows[4][1]), (None, rows[5][1]), (None, None), (3, ""), (4, None), (1, rows[2][1])} <= set(got)
    again = [(r.doc_id, r.text, r.place) for r in C.near(spark, docs.repartition(7), None).collect()]
    assert sorted(map(repr, again)) == sorted(map(repr, ((r.doc_id, r.text, r.place) for r in C.near(spark, docs.repartition(2), None).collect())))


def test_stages_keep_rows_that_say_nothing(spark, tmp_path):
    """Null and empty texts, ties and repeated rows through lines, leaks and packing."""
    rows = [(1, None), (2, ""), (2, ""), (None, TEXT), (None, TEXT), (3, TEXT), (4, "short")]
    docs = frame(spark, rows)
    sf = saved(spark, tmp_path, benchmark=frame(spark, [(1, None), (2, "")], "item_id long, text string"))
    left = sorted((repr(r.doc_id), r.text) for r in C.lines(spark, docs, sf).where("text IS NOT NULL").collect())
    assert left == sorted([("2", ""), ("2", ""), ("4", "short")] + [("None", TEXT)] * 2 + ([("3", TEXT)] if len(TEXT.split()) < 25 else []))
    assert C.leaks(spark, docs, sf).count() == len(rows)
    placed = C.packing(spark, docs, sf).collect()
    assert sorted(repr(r.doc_id) for r in placed) == sorted(repr(i) for i, _ in rows)
    assert C.quality(spark, docs, saved(spark, tmp_path, labels=frame(spark, [], "doc_id long, quality int, toxic int"))).count() == len(rows)
