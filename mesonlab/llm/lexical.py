"""Ranked lexical search with range-maximum tables.

Documents are cut into shards. A shard's posting lists (document, term frequency) are
stored; when searched, each list gets a sparse table of range maxima over its impacts.
A query starts with the interval of all documents of a shard. The intervals of largest
bound, the sum over the query's terms of the largest impact inside, are taken first: the
document of the largest single impact is scored and the interval split at it. A search
ends when no interval's bound reaches the score of the k-th best document, so its answer
is exact. A task hands the k-th score on from shard to shard."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mesonlab.llm.common import lower_ascii, table, word_places, written

#: Fixed values of the ranking: results, and the weights of the impact.
TOP = 10
#: Documents and postings of a shard, at most; one document may hold more postings.
SHARD_DOCS, SHARD_POSTINGS = 8192, 1 << 20
#: Terms of the queries that are searched together (a few MB in each task); more queries
#: are searched block by block, each block over all documents.
BLOCK_TERMS = 500_000
#: Intervals taken at a time, at most.
BEAM = 512
WORDS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_NUMBERS = "array<int>"


def _pieces(text: str):
    """The text's bytes in blocks of about a MB, cut before a byte that is in no term."""
    data, at, size = text.encode("utf-8"), 0, 1 << 20
    while len(data) - at > size:
        cut = next((c for c in range(at + size, at, -1) if not _IN_TERM[data[c]]), None)
        if cut is None:
            cut = next((c for c in range(at + size, len(data)) if not _IN_TERM[data[c]]), len(data))
        yield data[at:cut]
        at = cut
    yield data[at:]


_IN_TERM = [48 <= c < 58 or 65 <= c < 91 or 97 <= c < 123 or c >= 128 for c in range(256)]


class Terms:
    """Numbers of terms among the words of texts: found by hash, confirmed by their length
    and their first and last eight bytes (up to sixteen bytes, that is the whole word)."""

    def __init__(self, terms: list[str]):
        data = b" ".join(t.encode("utf-8") for t in terms)
        keys, *marks = word_places(data, "alnum")
        order = np.argsort(keys, kind="stable")
        self.number, self.keys, self.marks = order, keys[order], [m[order] for m in marks]

    def of(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """For each word of ``data`` its term's number or -1, and the words' first bytes."""
        keys, start, *marks = word_places(data, "alnum", starts=True)
        if not len(keys) or not len(self.keys):
            return np.full(len(keys), -1), start
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        same = self.keys[at] == keys
        for own, found in zip(self.marks, marks):
            same &= own[at] == found
        return np.where(same, self.number[at], -1), start


def _counted(texts, terms: Terms) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first text, words of the texts as an array, text of each posting, term, frequency)."""
    def flush(first, group):
        sizes = np.fromiter((len(x) + 1 for x in group), np.int64, len(group))
        number, start = terms.of(b" ".join(group))
        row = np.searchsorted(np.cumsum(sizes), start, side="right")
        n = np.bincount(row, minlength=len(group))
        has = number >= 0
        key, tf = np.unique(row[has] << 32 | number[has], return_counts=True)
        return first, n, key >> 32, key & 0xFFFFFFFF, tf

    group, held, first = [], 0, 0
    for i, text in enumerate(texts):
        text = text or ""
        if len(text) > 1 << 19:
            if group:
                yield flush(first, group)
            many, parts = 0, []
            for piece in _pieces(text):
                number, _ = terms.of(piece)
                many += len(number)
                parts.append(np.unique(number[number >= 0], return_counts=True))
            key, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            tf = np.bincount(at, np.concatenate([p[1] for p in parts]), len(key)).astype(np.int64)
            yield i, np.array([many]), np.zeros(len(key), np.int64), key, tf
            group, held, first = [], 0, i + 1
            continue
        data = text.encode("utf-8")
        if group and held + len(data) > 1 << 20:
            yield flush(first, group)
            group, held, first = [], 0, i
        group.append(data)
        held += len(data) + 1
    if group:
        yield flush(first, group)


def build_index(docs: DataFrame, terms: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The posting lists of ``terms``, a row per shard: ``docs`` and ``words`` (documents with
    a term of any kind, and all their terms), and as arrays of equal length ``ids`` and
    ``n`` (terms of each document that holds one of ``terms``, in the order of ids, nulls
    last), ``term`` and ``df`` (its postings), and ``at`` and ``tf``, the lists one after the
    other: a document's place and the term's occurrences."""
    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def shard(ids: list[pa.Array], held: list[tuple], seen: tuple[int, int]) -> pa.RecordBatch:
        doc, term, tf, n = (np.concatenate([h[k] for h in held]) for k in range(4))
        own, place = np.unique(doc, return_inverse=True)
        ids = pa.concat_arrays(ids).take(pa.array(own))
        order = pa.compute.sort_indices(ids, null_placement="at_end").to_numpy().astype(np.int64)
        rank = np.empty(len(own), np.int64)
        rank[order] = np.arange(len(own))
        place = rank[place]
        by = np.lexsort((place, term))
        terms_, df = np.unique(term, return_counts=True)
        many = np.zeros(len(own), np.int64)
        many[place] = n
        ints = [pa.array([x.astype(np.int32)], pa.list_(pa.int32())) for x in (many, terms_, df, place[by], tf[by])]
        return pa.RecordBatch.from_arrays([pa.array([seen[0]]), pa.array([seen[1]]), pa.array([ids.take(pa.array(order))], pa.list_(ids.type)), *ints],
                                          ["docs", "words", "ids", "n", "term", "df", "at", "tf"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Terms(terms)
        ids, held, docs_, words, rows_, postings = [], [], 0, 0, 0, 0
        for batch in batches:
            for first, n, row, term, tf in _counted((x.as_py() for x in batch.column(1)), known):
                if rows_ and (rows_ + len(n) > SHARD_DOCS or postings + len(row) > SHARD_POSTINGS):
                    yield shard(ids, held, (docs_, words))
                    ids, held, docs_, words, rows_, postings = [], [], 0, 0, 0, 0
                ids.append(batch.column(0).slice(first, len(n)))
                held.append((rows_ + row, term, tf, n[row]))
                docs_, words = docs_ + int((n > 0).sum()), words + int(n.sum())
                rows_, postings = rows_ + len(n), postings + len(row)
        if rows_:
            yield shard(ids, held, (docs_, words))
    return source.mapInArrow(rows, f"docs long, words long, ids array<{kind}>, n {_NUMBERS}, term {_NUMBERS}, df {_NUMBERS}, at {_NUMBERS}, tf {_NUMBERS}")


class Shard:
    """A shard's posting lists with a sparse table of range maxima."""

    def __init__(self, row: dict[str, np.ndarray], docs: int, words: int):
        self.term, self.at = row["term"], row["at"]
        self.ends = np.concatenate(([0], np.cumsum(row["df"], dtype=np.int64)))
        m = 100 - 75 + (75 * row["n"].astype(np.int64) * docs) // max(words, 1)
        tf = row["tf"].astype(np.int64)
        self.impact = 1_000_000_000 * tf // (1000 * tf + 8 * m[self.at])
        # table[j][p]: the largest of 2^j impacts from p on, and its place in the low bits
        self.table = [self.impact << 32 | np.arange(len(tf))]
        for j in range(1, int(row["df"].max(initial=1)).bit_length()):
            last, half = self.table[-1], 1 << (j - 1)
            self.table.append(np.append(np.maximum(last[:-half], last[half:]), last[len(last) - half:]) if len(last) > half else last)
        self.flat = np.stack(self.table)
        self.docs = len(row["n"])

    def lists(self, terms: np.ndarray) -> np.ndarray:
        """Of each term, the number of its list; -1 if the shard doesn't hold it."""
        at = np.minimum(np.searchsorted(self.term, terms), max(len(self.term) - 1, 0))
        return np.where(self.term[at] == terms, at, -1) if len(self.term) else np.full(len(terms), -1)

    def largest(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Largest entries of the postings lo to hi (0 where there are none)."""
        size = hi - lo
        j = np.frexp(np.maximum(size, 1).astype(np.float64))[1] - 1
        both = np.maximum(self.flat[j, np.minimum(lo, len(self.impact) - 1)], self.flat[j, np.maximum(hi - (1 << j), 0)])
        return np.where(size > 0, both, 0)

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int, floor: int) -> list[tuple[int, int]]:
        """(score, document) of the best ``k`` documents, the smaller document first among
        equal scores, of those that score ``floor`` at least and 1 at least."""
        lists = self.lists(terms)
        weights, lists = weights[lists >= 0], lists[lists >= 0]
        if not len(lists):
            return []
        base = lists.astype(np.int64) * (self.docs + 1)  # sorts postings by list, then document
        best: list[tuple[int, int]] = []                 # a heap of (score, -document)
        floor = max(floor, 1)
        lo, hi = self.ends[lists][None, :], self.ends[lists + 1][None, :]
        first, last = np.array([0]), np.array([self.docs])
        top = self.largest(lo, hi)
        bound = (weights * (top >> 32)).sum(1)
        while len(bound):
            keep = bound >= floor
            first, last, lo, hi, top, bound = (x[keep] for x in (first, last, lo, hi, top, bound))
            if not len(bound):
                break
            order = np.argsort(-bound, kind="stable")
            now, rest = order[:BEAM], order[BEAM:]
            # split at the document of the largest weighted impact
            lead = (weights * (top[now] >> 32)).argmax(1)
            doc = self.at[(top[now, lead] & 0xFFFFFFFF)].astype(np.int64)
            place = np.searchsorted(self.key, base[None, :] + doc[:, None])
            found = (place < hi[now]) & (self.at[np.minimum(place, len(self.at) - 1)] == doc[:, None])
            score = (weights * np.where(found, self.impact[np.minimum(place, len(self.impact) - 1)], 0)).sum(1)
            for s, d in zip(score.tolist(), doc.tolist()):
                if s >= floor:
                    if len(best) < k:
                        heapq.heappush(best, (s, -d))
                    elif (s, -d) > best[0]:
                        heapq.heapreplace(best, (s, -d))
                    if len(best) == k:
                        floor = max(floor, best[0][0])
            parts = [(first[now], doc, lo[now], place), (doc + 1, last[now], place + found, hi[now])]
            parts = [tuple(np.concatenate([p[c] for p in parts]) for c in range(4))]
            pf, pl, plo, phi = parts[0]
            ptop = self.largest(plo, phi)
            pbound = (weights * (ptop >> 32)).sum(1)
            some = (pl > pf) & (pbound >= floor)
            first, last, lo, hi, top, bound = (np.concatenate((a[rest], b[some])) for a, b in ((first, pf), (last, pl), (lo, plo), (hi, phi), (top, ptop), (bound, pbound)))
        return sorted(((s, -d) for s, d in best), key=lambda x: (-x[0], x[1]))

    @property
    def key(self) -> np.ndarray:
        if not hasattr(self, "_key"):
            self._key = np.repeat(np.arange(len(self.ends) - 1), np.diff(self.ends)) * (self.docs + 1) + self.at
        return self._key


def _searcher(queries: list[tuple[np.ndarray, np.ndarray]], docs: int, words: int, k: int):
    """``queries``: per query the terms' numbers and their weights times repeats."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[int]] = [[] for _ in queries]  # the k best scores of the shards so far
        for batch in batches:
            for i in range(len(batch)):
                row = {c: batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in ("n", "term", "df", "at", "tf")}
                if not len(row["term"]):
                    continue
                shard, ids = Shard(row, docs, words), batch.column("ids")[i].values
                query, doc, score = [], [], []
                for q, (terms, weights) in enumerate(queries):
                    found = shard.search(terms, weights, k, best[q][0] if len(best[q]) == k else 1)
                    for s, d in found:
                        query.append(q)
                        doc.append(d)
                        score.append(s)
                        if len(best[q]) < k:
                            heapq.heappush(best[q], s)
                        else:
                            heapq.heappushpop(best[q], s)
                yield pa.RecordBatch.from_arrays([pa.array(query, pa.int32()), ids.take(pa.array(doc, pa.int64())), pa.array(score, pa.int64())], ["query", "doc_id", "score"])
    return search


def best_first(found: DataFrame, k: int, salts: int) -> DataFrame:
    """The ``k`` best rows of each query with their ``rank``, first in parts, then of all."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    part = found.withColumn("salt", F.spark_partition_id() % F.lit(max(salts, 1)))
    part = part.withColumn("rank", F.row_number().over(Window.partitionBy("query", "salt").orderBy(*order))).where(F.col("rank") <= k)
    return part.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("rank") <= k).drop("salt")


def search(docs: DataFrame, queries: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text", query_id: str = "item_id", query_text: str = "text") -> DataFrame:
    """Per row of ``queries``: item_id, rank (from 1), doc_id, score of its ``k`` best rows of
    ``docs``, every row a document of its own.

    Terms are ASCII letters and digits and everything beyond ASCII, A-Z lower-cased. Null
    and empty texts have none: such a document isn't found or counted, such a query finds
    nothing. Equal scores come by id, null ids last; rows that repeat an id and text are
    found each, in any order. An empty table gives no rows. The queries' texts come to the
    driver in blocks of at most BLOCK_TERMS terms (one query may hold more)."""
    spark = docs.sparkSession
    source = queries.select(F.col(f"`{query_id}`").alias("item_id"), F.regexp_extract_all(lower_ascii(F.col(f"`{query_text}`").cast("string")), F.lit(WORDS), F.lit(0)).alias("terms"))
    source = source.where(F.size("terms") > 0)
    kind, id_kind = source.schema["item_id"].dataType, docs.select(F.col(f"`{id_col}`")).schema[0].dataType.simpleString()
    total = source.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    blocks = max(-(-total // BLOCK_TERMS), 1)
    source = written(source.withColumn("block", F.pmod(F.hash("item_id", "terms"), F.lit(blocks))), "queries")
    out = None
    for b in range(blocks):
        items = source.where(F.col("block") == b).select("item_id", "terms").collect()  # about BLOCK_TERMS terms
        terms = sorted({t for r in items for t in r["terms"]})
        number = {t: i for i, t in enumerate(terms)}
        index = written(build_index(docs, terms, id_col, text_col), "postings")
        n, words, shards = index.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0)), F.count(F.lit(1))).first()
        df = dict(index.select(F.explode(F.arrays_zip("term", "df")).alias("x")).groupBy("x.term").agg(F.sum("x.df").alias("df")).collect())  # a row per term
        # in doubles, as the rule has it
        weight = np.floor(1000 * np.log((2.0 * n + 2) / (2.0 * np.array([df.get(i, 0) for i in range(len(terms))]) + 1))).astype(np.int64)
        asked = []
        for r in items:
            own, many = np.unique([number[t] for t in r["terms"]], return_counts=True)
            asked.append((own.astype(np.int64), weight[own] * many))
        names = spark.createDataFrame(list(enumerate(r["item_id"] for r in items)), f"query int, item_id {kind.simpleString()}")
        found = index.mapInArrow(_searcher(asked, n, words, k), f"query int, doc_id {id_kind}, score long")
        found = best_first(found, k, int(shards ** 0.5)).join(F.broadcast(names), "query").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        out = found if out is None else out.unionByName(found)
    return out


def op13_lexical_search(spark, sf_dir: str) -> DataFrame:
    """The ten best of all ``documents`` for each item of ``benchmark``."""
    return search(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text"))


ORACLE_OP13 = r"""
WITH words AS (
  SELECT row_number() OVER () AS d, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
asked AS (
  SELECT row_number() OVER () AS q, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
lengths AS (SELECT d, doc_id, count(*) AS n FROM words GROUP BY ALL),
corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM lengths),
postings AS (SELECT d, term, count(*) AS tf FROM words GROUP BY ALL),
weights AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * any_value(docs) + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w
            FROM postings, corpus GROUP BY term),
wanted AS (SELECT q, item_id, term, count(*) AS many FROM asked GROUP BY ALL),
scored AS (
  SELECT q, item_id, doc_id, d, CAST(sum(many * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // words)))) AS BIGINT) AS score
  FROM wanted JOIN weights USING (term) JOIN postings USING (term) JOIN lengths USING (d), corpus GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""
