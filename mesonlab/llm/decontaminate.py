"""Benchmark decontamination: a broadcast hash set of the benchmark's word
windows, scanned over the word windows of every document; hits are verified
word by word, and spans or documents removed."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mesonlab.llm.common import lower_ascii, table, window_hashes, word_hashes, written

WINDOW = 10
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Windows of one broadcast block (about 100 bytes each on a worker). A larger
#: benchmark is scanned block by block, each block over all documents.
BLOCK_WINDOWS = 500_000
_HITS = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("items", T.ArrayType(T.StringType())),
                      T.StructField("words_hit", T.ArrayType(T.ArrayType(T.LongType()))),
                      T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType())))])


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct (item, window): every ``window`` consecutive words joined by a
    space; an item of fewer words, but not none, is one window."""
    words = F.regexp_extract_all(lower_ascii(F.col(f"`{text_col}`")), F.lit(WORDS), F.lit(0))
    items = benchmark.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null")).alias("item"), words.alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    return items.select("item", F.explode(F.transform(starts, lambda i: F.array_join(F.slice("w", i, window), " "))).alias("window")).distinct()


def _lookup(rows: list[tuple[str, str]]) -> dict:
    """By window length: sorted hashes, a table of their upper 16 bits, and the
    items by exact window."""
    by_size: dict[int, dict[str, list[str]]] = {}
    for item, text in rows:
        by_size.setdefault(text.count(" ") + 1, {}).setdefault(text, []).append(item)
    out = {}
    for size, items in by_size.items():
        one = np.concatenate([h for _, h, _ in word_hashes(list(items), "alnum")]).reshape(len(items), size)
        keys = np.sort(np.concatenate([window_hashes(row, size) for row in one]))
        near = np.zeros(1 << 16, bool)
        near[(keys >> np.uint64(48)).astype(np.int64)] = True
        out[size] = (keys, near, items)
    return out


def _scan(texts: pd.Series, lookup: dict) -> pd.DataFrame:
    n_words, items = np.zeros(len(texts), np.int64), [[] for _ in range(len(texts))]
    ranges: list[list] = [[] for _ in range(len(texts))]
    spans: list[list] = [[] for _ in range(len(texts))]
    for first, hashes, offsets in word_hashes(texts, "alnum"):
        sizes = np.diff(offsets)
        n_words[first:first + len(sizes)] = sizes
        found: dict[int, list[tuple[int, int]]] = {}
        for size, (keys, near, _) in lookup.items():
            windows = window_hashes(hashes, size)
            at = np.flatnonzero(near[(windows >> np.uint64(48)).astype(np.int64)])
            at = at[keys[np.minimum(np.searchsorted(keys, windows[at]), len(keys) - 1)] == windows[at]]
            doc = np.searchsorted(offsets, at, side="right") - 1
            inside = at + size <= offsets[doc + 1]
            for d, p in zip(doc[inside].tolist(), at[inside].tolist()):
                found.setdefault(d, []).append((p - int(offsets[d]), size))
        for d, places in found.items():  # verify: the words themselves
            text = texts.iloc[first + d]
            words = list(re.finditer(WORDS, text.translate(_TO_LOWER)))
            hit = np.zeros(len(words), bool)
            names: set[str] = set()
            for p, size in places:
                if got := lookup[size][2].get(" ".join(m.group() for m in words[p:p + size])):
                    names.update(got)
                    hit[p:p + size] = True
            edge = np.diff(hit.astype(np.int8), prepend=0, append=0)
            runs = list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()))
            items[first + d] = sorted(names)
            ranges[first + d] = [list(r) for r in runs]
            spans[first + d] = [[words[s].start(), words[e - 1].end()] for s, e in runs]
    return pd.DataFrame({"n_words": n_words, "items": items, "words_hit": ranges, "spans": spans})


def _scanner(shared):
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield _scan(texts, shared.value)
    return F.pandas_udf(scan, _HITS)


_TO_LOWER = {i: i + 32 for i in range(65, 91)}


def _merged(lists):
    """Union of ranges [start, end) given as an array of arrays, sorted and merged."""
    def step(a, x):
        last = F.element_at(a, -1)
        touching = (F.size(a) > 0) & (F.get(x, F.lit(0)) <= F.get(last, F.lit(1)))
        return F.when(touching, F.concat(F.slice(a, 1, F.size(a) - 1), F.array(F.array(F.get(last, F.lit(0)), F.greatest(F.get(last, F.lit(1)), F.get(x, F.lit(1)))))))\
            .otherwise(F.concat(a, F.array(x)))
    return F.aggregate(F.array_sort(lists), F.expr("cast(array() as array<array<bigint>>)"), step)


def scan_documents(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit`` (words inside any benchmark window),
    ``items`` (sorted ids as strings) and ``spans`` (code point ranges of the hit
    words).

    Null and empty texts have no words and no hits; an empty benchmark hits
    nothing; rows are kept as they are; columns with the new names are replaced.
    The windows are collected in blocks of a bounded size, each broadcast and
    scanned in a narrow pass, so a benchmark of any size works."""
    spark = docs.sparkSession
    windows = written(benchmark_windows(benchmark, window), "benchmark-windows")
    blocks = max(-(-windows.count() // block_windows), 1)
    new = ("n_words", "n_hit", "items", "spans")
    out = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in new or c == text_col])
    parts = []
    for b in range(blocks):
        part = windows if blocks == 1 else windows.where(F.pmod(F.xxhash64("item", "window"), F.lit(blocks)) == b)
        shared = spark.sparkContext.broadcast(_lookup([tuple(r) for r in part.collect()]))
        parts.append(f"__hits{b}")
        out = out.withColumn(parts[-1], _scanner(shared)(F.col(f"`{text_col}`")))
        if blocks > 1:
            out = written(out, "decontaminate")
    rows = [F.col(p) for p in parts]
    words_hit = _merged(F.concat(*[r["words_hit"] for r in rows])) if blocks > 1 else rows[0]["words_hit"]
    spans = _merged(F.concat(*[r["spans"] for r in rows])) if blocks > 1 else rows[0]["spans"]
    return out.select(*[F.col(f"`{c}`") for c in out.columns if c not in parts],
                      rows[0]["n_words"].alias("n_words"),
                      F.aggregate(words_hit, F.lit(0).cast("long"), lambda a, x: a + F.get(x, F.lit(1)) - F.get(x, F.lit(0))).alias("n_hit"),
                      F.array_sort(F.array_distinct(F.concat(*[r["items"] for r in rows]))).alias("items"), spans.alias("spans"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, mode: str = "documents", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the contaminated documents (``mode="documents"``), or with
    the hit spans cut out of their texts (``mode="spans"``); same columns."""
    if mode not in ("documents", "spans"):
        raise ValueError(f"unknown mode {mode!r}")
    names = docs.columns
    one = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(f"`{text_col}`").alias("text"))
    hits = scan_documents(one, benchmark, "text", **options)
    if mode == "documents":
        return hits.where(F.col("n_hit") == 0).select("row.*")
    cut = F.aggregate("spans", F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("text")),
                      lambda a, x: F.struct(F.get(x, F.lit(1)).alias("at"), F.concat(a["text"], F.substr(F.col("text"), (a["at"] + 1).cast("int"), (F.get(x, F.lit(0)) - a["at"]).cast("int"))).alias("text")),
                      lambda a: F.concat(a["text"], F.substr(F.col("text"), (a["at"] + 1).cast("int"))))
    return hits.select(*[F.when(F.size("spans") > 0, cut).otherwise(F.col("text")).alias(c) if c == text_col else F.col("row")[c].alias(c) for c in names])


def op2_decontamination(spark, sf_dir: str) -> DataFrame:
    """Benchmark windows found in every whole text of ``documents``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hits = scan_documents(docs, table(spark, sf_dir, "benchmark"))
    return hits.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


ORACLE_OP2 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(len(w), 10) AS size, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
       FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS win
       FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)),
hit AS (SELECT dw.doc_id, dw.i, dw.size, bw.item FROM dw JOIN bw ON dw.win = bw.win AND dw.size = bw.size),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hit) GROUP BY doc_id),
it AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hit GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(pos.n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(it.n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(it.items, '')) AS items_sha256, coalesce(pos.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos ON d.doc_id = pos.doc_id LEFT JOIN it ON d.doc_id = it.doc_id
"""
