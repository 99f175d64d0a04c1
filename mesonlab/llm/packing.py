"""Best-fit packing of tokenised documents into sequences.

Bulk-synchronous best fit, decreasing: documents are dealt by length and ranked
within it by a distributed sort; each round takes all documents of the next
smaller length, sweeps the gaps upward from that length (the successor of a
document is the smallest gap that holds it), gives documents to gaps by rank,
and puts the smaller gaps back. Documents of one length, and sequences of one
gap, are interchangeable, so a round works on ranges of ranks: the state has a
few ranges for each of at most ``capacity`` lengths, whatever the corpus holds,
and the placement of single documents is a join on (length, rank)."""

from __future__ import annotations

import base64
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mesonlab.llm.common import table, written

CAPACITY = 1024
END_ID = 2
VOCABULARY = "byte_bpe_50k"
_ENCODERS: dict = {}


class Encoder:
    """The ids that ``tokenizers`` gives with the vocabulary file, computed by
    ``tiktoken`` over the same vocabulary as ranks (several times faster, same
    ids); texts that hold the special token's string go to ``tokenizers``."""

    def __init__(self, vocabulary: str):
        import public_tokenizers as P
        import tiktoken
        with open(P.path(f"{vocabulary}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._fast = tiktoken.Encoding("corpus", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._path, self._exact = P.path(f"{vocabulary}.json"), None

    def ids(self, text: str) -> np.ndarray:
        if "<|endoftext|>" in text:
            if self._exact is None:
                from tokenizers import Tokenizer
                self._exact = Tokenizer.from_file(self._path)
            return np.array(self._exact.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.asarray(self._fast.encode_to_numpy(text, allowed_special=set(), disallowed_special=()), np.uint32)


def encoder(vocabulary: str = VOCABULARY) -> Encoder:
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = Encoder(vocabulary)
    return _ENCODERS[vocabulary]


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: one, or full pieces after a first
    one that takes what is left over."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity
    return ([(0, first)] if first else []) + [(s, capacity) for s in range(first, n, capacity)]


def tokenize(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, vocabulary: str = VOCABULARY,
             end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Per piece: id, piece, start, length, ids_crc32, and the ids if asked for.
    A null text is empty: a document of the end id alone."""
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for batch in batches:
            row, number, start, length, crc, tokens = [], [], [], [], [], []
            for i, text in enumerate(batch.column(1)):
                ids = np.append(enc.ids(text.as_py() or ""), np.uint32(end_id)).astype("<u4")
                for k, (s, n) in enumerate(cut(len(ids), capacity)):
                    row.append(i)
                    number.append(k)
                    start.append(s)
                    length.append(n)
                    crc.append(zlib.crc32(ids[s:s + n].tobytes()))
                    if with_ids:
                        tokens.append(ids[s:s + n].astype(np.int32))
            columns = [batch.column(0).take(pa.array(row, pa.int32())), pa.array(number, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns, names = [*columns, pa.array(tokens, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names)
    return source.mapInArrow(pieces, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids)


def best_fit_rounds(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, documents a sequence, first sequence,
    offset) for ranges of documents. One round for each length, longest first;
    within it the smallest gaps that hold the length are filled first, and new
    sequences opened when none is left: exactly best-fit decreasing."""
    gaps: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
    opened, out = 0, []
    for length in sorted(counts, reverse=True):
        left, rank, gap = counts[length], 0, length
        while left:
            while gap <= capacity and not gaps[gap]:
                gap += 1
            if gap > capacity:
                size, many = capacity, -(-left // (capacity // length))
                first, opened = opened, opened + many
            else:
                size = gap
                first, many = gaps[gap].pop()
            each = size // length
            full = min(many, left // each)
            for n, docs in ((full, each), (1, left - full * each)):
                if n and 0 < docs <= each and many and left:
                    out.append((length, rank, rank + n * docs, docs, first, capacity - size))
                    gaps[size - docs * length].append((first, n))
                    rank, left, first, many = rank + n * docs, left - n * docs, first + n, many - n
            if many:
                gaps[size].append((first, many))
    return out


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (doc_id, piece, length, ids_crc32, ...) with ``sequence_id`` and
    ``offset``. Full pieces get a sequence each (negative ids). ``pieces`` must
    be a stored table: it is read several times. An empty table gives none."""
    spark = pieces.sparkSession
    full = pieces.where(F.col("length") == capacity).select("*", (-F.monotonically_increasing_id() - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = pieces.where(F.col("length") < capacity)
    counts = {r["length"]: r["n"] for r in rest.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    plan = spark.createDataFrame(best_fit_rounds(counts, capacity), "p_length long, lo long, hi long, each long, first long, base long")
    # n documents of a length are ranked in about sqrt(n) parts of about sqrt(n) rows
    salts = spark.createDataFrame([(k, math.isqrt(n) + 1) for k, n in counts.items()], "s_length long, salts long")
    key = ["length", "salt"]
    dealt = rest.join(F.broadcast(salts), rest["length"] == salts["s_length"]).withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("salts"))).drop("s_length", "salts")
    before = dealt.groupBy(*key).agg(F.count("*").alias("n")).withColumn(
        "before", F.sum("n").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)))
    before = before.select(F.col("length").alias("b_length"), F.col("salt").alias("b_salt"), F.coalesce("before", F.lit(0)).alias("before"))
    local = dealt.withColumn("local", F.row_number().over(Window.partitionBy(*key).orderBy("doc_id", "piece", "start", "ids_crc32")) - 1)
    ranked = local.join(before, (F.col("length") == F.col("b_length")) & (F.col("salt") == F.col("b_salt"))).withColumn("rank", F.col("before") + F.col("local"))
    placed = ranked.join(F.broadcast(plan), (F.col("length") == F.col("p_length")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
    placed = placed.withColumn("sequence_id", F.expr("first + (rank - lo) div each")).withColumn("offset", F.expr("base + (rank - lo) % each * length"))
    return placed.select(*full.columns).unionByName(full)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """Placement of every piece of every document: tokenised once, written, packed."""
    return pack(written(tokenize(docs, id_col, text_col, capacity, vocabulary), "pieces"), capacity)


def sequences(placed: DataFrame, docs: DataFrame, **options) -> DataFrame:
    """The packed token ids: (sequence_id, ids), joined from the documents' pieces."""
    ids = tokenize(docs, with_ids=True, **options).select("doc_id", "piece", "ids")
    parts = placed.select("doc_id", "piece", "sequence_id", "offset").join(ids, ["doc_id", "piece"])
    return parts.groupBy("sequence_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids"))


def op3_packing(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` packed into sequences of at most 1024 tokens."""
    return pack_documents(table(spark, sf_dir, "documents"))
