"""Alignment of two tokenizers by inverted pair bitmaps.

Both tokenisations of a text are cut into groups at the byte offsets where tokens of both
end; tokens that share a group are linked. Documents are numbered inside blocks of at most
2^16. For each pair of ids a block holds a compressed bitmap of its documents (a list of
numbers where few, bits where many) and, over the bitmap's members, the bit planes of how
often each holds the pair beyond once. Bitmaps of the blocks have no document in common:
OR-ing them is putting them side by side, and the popcounts add up to a pair's document
count. The counts return to the blocks, where every posting hands them to its document."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mesonlab.llm.common import prepare, table, written

VOCABULARY_A, VOCABULARY_B = "byte_bpe_50k", "piece_bpe_32k"
#: Characters and documents of a block, at most (a longer text is a block of its own).
BLOCK_CHARS, BLOCK_DOCS = 12_000_000, 1 << 16
#: Characters whose pairs make a bucket of the counting, about.
BUCKET_CHARS, LEAST_BUCKETS = 24_000_000, 12
#: Characters that are tokenised together, and pairs of a step.
STEP_CHARS, STEP_PAIRS = 1 << 20, 1 << 22
#: Pairs of a group that are listed; of a larger one, only pairs of different ids.
GROUP_PAIRS = 1 << 16
#: A bitmap holds bits, not a list, from this share of the block's documents on.
DENSE = 16
_ZSTD = pa.Codec("zstd")
_ALIGNERS: dict = {}


@dataclass
class Tokens:
    """Of several texts, one after the other: ids, and offsets of the texts."""
    ids: np.ndarray
    at: np.ndarray


class Aligner:
    """The two vocabularies: ids of a text, bytes of an id."""

    def __init__(self, a: str, b: str):
        import public_tokenizers as P
        import sentencepiece
        import tiktoken
        with open(P.path(f"{a}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(x): int(y) for x, y in map(bytes.split, f)}
        self.a = tiktoken.Encoding("aligned", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=P.path(f"{b}.model"))
        self.size_a, self.size_b = max(ranks.values()) + 1, self.b.get_piece_size()
        self.a_length = np.zeros(self.size_a, np.int64)
        for word, rank in ranks.items():
            self.a_length[rank] = len(word)
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode("utf-8") for i, p in enumerate(map(self.b.id_to_piece, range(self.size_b)))]
        self.b_length = np.array(list(map(len, self.b_bytes)))

    @cached_property
    def labels(self) -> list[bytes]:
        """Ids in decimal with the sign after them: A inside a group, A at its end, B inside, B at its end."""
        return [b"%d%s" % (i, sign) for size, signs in ((self.size_a, (b",", b"|")), (self.size_b, (b",", b";"))) for sign in signs for i in range(size)]

    def tokens(self, texts: list[str]) -> tuple[np.ndarray, Tokens, Tokens]:
        """Which texts have tokens, and the tokens of these."""
        whole = [(" " + t).encode("utf-8") for t in texts]
        a = [self.a.encode_to_numpy(" " + t, allowed_special=set(), disallowed_special=()) if t else np.zeros(0, np.uint32) for t in texts]
        b = [np.array(x, np.int64) for x in self.b.encode(texts, num_threads=1)]
        ok = np.array([bool(t) and int(self.a_length[x].sum()) == len(w) and b"".join(map(self.b_bytes.__getitem__, y.tolist())) == w for t, w, x, y in zip(texts, whole, a, b)], bool)
        return ok, *(Tokens(np.concatenate([np.zeros(0, np.int64), *(x.astype(np.int64) for x, k in zip(all_, ok) if k)]), np.concatenate(([0], np.cumsum([len(x) for x, k in zip(all_, ok) if k], dtype=np.int64)))) for all_ in (a, b))


def aligner(a: str = VOCABULARY_A, b: str = VOCABULARY_B) -> Aligner:
    if (a, b) not in _ALIGNERS:
        _ALIGNERS[a, b] = Aligner(a, b)
    return _ALIGNERS[a, b]


@dataclass
class Groups:
    """Groups of several texts: each token's group, each group's first tokens (and the end
    of the last), offsets of the texts among the groups."""
    of_a: np.ndarray
    of_b: np.ndarray
    a: np.ndarray
    b: np.ndarray
    at: np.ndarray


def groups(al: Aligner, a: Tokens, b: Tokens) -> Groups:
    a_end, b_end = np.cumsum(al.a_length[a.ids]), np.cumsum(al.b_length[b.ids])
    total = int(a_end[-1]) if len(a_end) else 0
    ends = np.zeros((2, total + 1), bool)
    ends[0, a_end] = ends[1, b_end] = True
    both = ends[0] & ends[1]
    last_a, last_b = both[a_end], both[b_end]
    past = np.concatenate(([0], np.cumsum(last_a)))
    return Groups(past[:-1], np.cumsum(last_b) - last_b, np.concatenate(([0], np.flatnonzero(last_a) + 1)), np.concatenate(([0], np.flatnonzero(last_b) + 1)), past[a.at])


def digests(al: Aligner, a: Tokens, b: Tokens, g: Groups) -> list[str]:
    """Of each text, the hash of its groups: decimal ids, A before B."""
    code = np.empty(len(a.ids) + len(b.ids), np.int64)
    last_a, last_b = (np.diff(of, append=of[-1:] + 1) != 0 for of in (g.of_a, g.of_b))
    code[np.arange(len(a.ids)) + g.b[g.of_a]] = a.ids + al.size_a * last_a
    code[np.arange(len(b.ids)) + g.a[g.of_b + 1]] = 2 * al.size_a + b.ids + al.size_b * last_b
    labels = al.labels
    ends = a.at + b.at
    return [hashlib.sha256(b"".join(map(labels.__getitem__, code[s:e].tolist()))[:-1]).hexdigest() for s, e in zip(ends[:-1], ends[1:])]


def links(al: Aligner, a: Tokens, b: Tokens, g: Groups, numbers: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(pair and document in one number, how often), in steps; ``numbers`` are the texts'
    numbers in their block. A pair is a's id times the size of B plus b's id."""
    many_a, many_b = np.diff(g.a), np.diff(g.b)
    many = many_a * many_b
    document = np.repeat(numbers, np.diff(g.at))
    listed = many <= GROUP_PAIRS
    for one in np.flatnonzero(~listed):
        ids_a, n_a = np.unique(a.ids[g.a[one]:g.a[one + 1]], return_counts=True)
        ids_b, n_b = np.unique(b.ids[g.b[one]:g.b[one + 1]], return_counts=True)
        step = max(STEP_PAIRS // len(ids_b), 1)
        for s in range(0, len(ids_a), step):
            pair = ids_a[s:s + step, None] * al.size_b + ids_b
            yield (pair << 16 | document[one]).ravel(), (n_a[s:s + step, None] * n_b).ravel()
    weight = np.where(listed, many, 0)
    total = np.concatenate(([0], np.cumsum(weight)))
    start = 0
    while start < len(many):
        end = max(int(np.searchsorted(total, total[start] + STEP_PAIRS, side="right")) - 1, start + 1)
        tokens = np.arange(g.a[start], g.a[end])
        own = g.of_a[tokens]
        each = np.where(listed[own], many_b[own], 0)
        first = np.repeat(g.b[own] - (np.cumsum(each) - each), each)
        pair = np.repeat(a.ids[tokens] * al.size_b, each) + b.ids[first + np.arange(len(first))]
        key, n = np.unique(pair << 16 | np.repeat(document[own], each), return_counts=True)
        yield key, n
        start = end


def _pack(*arrays: np.ndarray) -> bytes:
    """Whole numbers, compressed: the first bytes of all of an array's values together, then
    the second ones, as many as its largest value has."""
    out = []
    for x in arrays:
        width = max((int(x.max(initial=0)).bit_length() + 7) // 8, 1)
        raw = np.ascontiguousarray(x.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()
        data = _ZSTD.compress(raw, asbytes=True) if raw else b""
        out.append(np.array([len(x), width, len(data)], "<i8").tobytes() + data)
    return b"".join(out)


def _unpack(data: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(data):
        n, width, size = np.frombuffer(data, "<i8", 3, at).tolist()
        wide = np.zeros((n, 8), np.uint8)
        if n:
            wide[:, :width] = np.frombuffer(_ZSTD.decompress(data[at + 24:at + 24 + size], n * width, asbytes=True), np.uint8).reshape(width, n).T
        out.append(wide.view("<i8").ravel())
        at += 24 + size
    return out


def _bitmaps(docs: int, df: np.ndarray, number: np.ndarray, times: np.ndarray) -> bytes:
    """The pairs' bitmaps and their multiplicity planes. ``number`` and ``times`` are the
    postings, pair after pair."""
    dense = np.repeat(df * DENSE > docs, df)
    pair = np.repeat(np.arange(len(df)), df)
    few, first = number[~dense], np.diff(pair[~dense], prepend=-1) != 0
    steps = np.where(first, few, np.diff(few, prepend=0))
    rows = np.flatnonzero(df * DENSE > docs)
    bits = np.zeros((len(rows), docs), bool)
    bits[np.searchsorted(rows, pair[dense]), number[dense]] = True
    more = times - 1
    planes = [np.packbits((more >> k) & 1) for k in range(int(more.max(initial=0)).bit_length())]
    return _pack(np.array([docs]), steps, np.packbits(bits, axis=1).ravel(), *planes)


def _postings(df: np.ndarray, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """``number`` and ``times`` of _bitmaps."""
    (docs,), steps, bits, *planes = _unpack(data)
    dense = np.repeat(df * DENSE > docs, df)
    number = np.zeros(len(dense), np.int64)
    if len(steps):
        size = df[df * DENSE <= docs]
        run = np.cumsum(steps)
        start = np.cumsum(size) - size
        number[~dense] = run - np.repeat(run[start] - steps[start], size)
    if len(bits):
        rows = int((df * DENSE > docs).sum())
        number[dense] = np.nonzero(np.unpackbits(bits.astype(np.uint8).reshape(rows, -1), axis=1, count=int(docs)))[1]
    times = np.ones(len(dense), np.int64)
    for k, plane in enumerate(planes):
        times += np.unpackbits(plane.astype(np.uint8), count=len(dense)).astype(np.int64) << k
    return number, times


def _bucket(pair: np.ndarray, buckets: int) -> np.ndarray:
    return ((pair.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) * buckets >> 31


_ROWS = ("doc_id", "at", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
_CELLS = ("bucket", "pairs", "bitmaps")


def _indexer(kind: pa.DataType, buckets: int, names: tuple[str, str]):
    schema = pa.schema([("block", pa.string()), ("doc_id", kind), *((c, pa.int64()) for c in _ROWS[1:-1]), ("groups_sha256", pa.string()),
                        ("bucket", pa.int64()), ("pairs", pa.binary()), ("bitmaps", pa.binary())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        al, part = aligner(*names), TaskContext.get().partitionId()
        block = docs = chars = 0
        keys, times = [], []

        def emit(**columns) -> pa.RecordBatch:
            n = len(next(iter(columns.values())))
            return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(n, f.type)) if f.name != "block" else pa.array([f"{part}-{block}"] * n) for f in schema], schema=schema)

        def cells() -> pa.RecordBatch:
            key, n = np.concatenate(keys), np.concatenate(times)
            keys.clear(), times.clear()
            order = np.argsort(key, kind="stable")
            key, n = key[order], n[order]
            first = np.flatnonzero(np.diff(key, prepend=-1) != 0)
            key, n = key[first], np.add.reduceat(n, first) if len(first) else n
            pair, number = key >> 16, key & 0xFFFF
            bucket = _bucket(pair, buckets)
            order = np.argsort(bucket, kind="stable")
            pair, number, n, bucket = pair[order], number[order], n[order], bucket[order]
            cuts = np.searchsorted(bucket, np.arange(buckets + 1))
            out = []
            for k in np.flatnonzero(np.diff(cuts)):
                own = slice(cuts[k], cuts[k + 1])
                start = np.flatnonzero(np.diff(pair[own], prepend=-1) != 0)
                df = np.diff(np.append(start, cuts[k + 1] - cuts[k]))
                out.append((int(k), _pack(np.diff(pair[own][start], prepend=0), df), _bitmaps(docs, df, number[own], n[own])))
            columns = list(zip(*out)) or [(), (), ()]
            return emit(bucket=pa.array(columns[0], pa.int64()), pairs=pa.array(columns[1], pa.binary()), bitmaps=pa.array(columns[2], pa.binary()))

        def step(ids: pa.Array, texts: list[str]) -> pa.RecordBatch:
            ok, a, b = al.tokens(texts)
            g = groups(al, a, b)
            numbers = docs + np.flatnonzero(ok)
            sizes = {c: np.zeros(len(texts), np.int64) for c in ("n_a", "n_b", "n_groups", "n_links")}
            linked = np.concatenate(([0], np.cumsum(np.diff(g.a) * np.diff(g.b))))
            for c, at in (("n_a", a.at), ("n_b", b.at), ("n_groups", g.at), ("n_links", linked[g.at])):
                sizes[c][ok] = np.diff(at)
            sha = np.full(len(texts), "", object)
            if ok.any():
                sha[ok] = digests(al, a, b, g)
                for key, n in links(al, a, b, g, numbers):
                    keys.append(key)
                    times.append(n)
            return emit(doc_id=ids, at=pa.array(docs + np.arange(len(texts))), groups_sha256=pa.array(sha, pa.string()), **{c: pa.array(x) for c, x in sizes.items()})

        for batch in batches:
            start = 0
            texts = ["" if x is None else x for x in batch.column(1).to_pylist()]
            while start < len(texts):
                end, held = start, 0
                while end < len(texts) and (end == start or held + len(texts[end]) <= STEP_CHARS) and end - start < BLOCK_DOCS:
                    held += len(texts[end])
                    end += 1
                if docs and (docs + end - start > BLOCK_DOCS or chars + held > BLOCK_CHARS):
                    if keys:
                        yield cells()
                    block, docs, chars = block + 1, 0, 0
                yield step(batch.column(0).slice(start, end - start), texts[start:end])
                docs, chars, start = docs + end - start, chars + held, end
        if keys:
            yield cells()
    return rows


def _count(size_b: int):
    def count(group: pa.Table) -> pa.Table:
        """Of one bucket, the document counts of each cell's pairs, and the highest count of
        each id of A (in a row without a block)."""
        cells = [_unpack(x.as_py()) for x in group["pairs"]]
        key = np.concatenate([np.cumsum(c[0]) for c in cells])
        pair, at = np.unique(key, return_inverse=True)
        df = np.zeros(len(pair), np.int64)
        np.add.at(df, at, np.concatenate([c[1] for c in cells]))
        cuts = np.cumsum([0, *(len(c[0]) for c in cells)])
        a = pair // size_b
        first = np.flatnonzero(np.diff(a, prepend=-1) != 0)
        return pa.table({"block": pa.array([*group["block"].to_pylist(), None], pa.string()), "bucket": pa.array([*group["bucket"].to_pylist(), None], pa.int64()),
                         "counts": pa.array([*(_pack(df[at[s:e]]) for s, e in zip(cuts[:-1], cuts[1:])), None], pa.binary()),
                         "a": pa.array([None] * len(cells) + [a[first].tolist()], pa.list_(pa.int64())),
                         "most": pa.array([None] * len(cells) + [np.maximum.reduceat(df, first).tolist()], pa.list_(pa.int64()))})
    return count


def _returned(size_b: int, most):
    def score(block: pa.Table, counted: pa.Table) -> pa.Table:
        """One block's documents with what the postings of its pairs hand them."""
        is_cell = block["bucket"].is_valid()
        rows, cells = block.filter(pa.compute.invert(is_cell)).select(_ROWS), block.filter(is_cell)
        counts = dict(zip(counted["bucket"].to_pylist(), counted["counts"].to_pylist()))
        best, total = (np.zeros(len(rows), np.int64) for _ in range(2))
        for bucket, pairs, bitmaps in zip(*(cells[c].to_pylist() for c in _CELLS)):
            steps, df = _unpack(pairs)
            (count,) = _unpack(counts[bucket])
            number, times = _postings(df, bitmaps)
            np.add.at(total, number, times * np.repeat(count, df))
            is_best = np.repeat(count == most.value[np.cumsum(steps) // size_b], df)
            np.add.at(best, number[is_best], times[is_best])
        at = rows["at"].to_numpy()
        return pa.table({**{c: rows[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}, "n_best": best[at], "count_sum": total[at], "groups_sha256": rows["groups_sha256"]})
    return score


def pair_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabularies: tuple[str, str] = (VOCABULARY_A, VOCABULARY_B)) -> DataFrame:
    """The stored index. Rows with a ``bucket`` are cells: the ``pairs`` of a block that fall
    into the bucket, with their document counts in it, and their ``bitmaps``; the others are
    documents: ``at`` is the number in the block."""
    spark = docs.sparkSession
    prepare(spark)
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    chars = source.agg(F.sum(F.length("text"))).first()[0] or 0
    kind = source.schema["doc_id"].dataType
    schema = f"block string, doc_id {kind.simpleString()}, at long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, bucket long, pairs binary, bitmaps binary"
    from pyspark.sql.pandas.types import to_arrow_type
    return written(source.mapInArrow(_indexer(to_arrow_type(kind), max(-(-chars // BUCKET_CHARS), LEAST_BUCKETS), vocabularies), schema), "pair-index")


def pair_totals(index: DataFrame, vocabularies: tuple[str, str] = (VOCABULARY_A, VOCABULARY_B)) -> DataFrame:
    """(a_id, b_id, n_docs, n_links) of every linked pair of ids, from a stored index."""
    def totals(group: pa.Table) -> pa.Table:
        size_b = aligner(*vocabularies).size_b
        key, docs, many = [], [], []
        for pairs, bitmaps in zip(group["pairs"].to_pylist(), group["bitmaps"].to_pylist()):
            steps, df = _unpack(pairs)
            key.append(np.cumsum(steps))
            docs.append(df)
            many.append(np.add.reduceat(_postings(df, bitmaps)[1], np.cumsum(df) - df))
        pair, at = np.unique(np.concatenate(key), return_inverse=True)
        sums = np.zeros((2, len(pair)), np.int64)
        np.add.at(sums[0], at, np.concatenate(docs))
        np.add.at(sums[1], at, np.concatenate(many))
        return pa.table({"a_id": pair // size_b, "b_id": pair % size_b, "n_docs": sums[0], "n_links": sums[1]})
    return index.where("bucket IS NOT NULL").select("bucket", "pairs", "bitmaps").groupBy("bucket").applyInArrow(totals, "a_id long, b_id long, n_docs long, n_links long")


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabularies: tuple[str, str] = (VOCABULARY_A, VOCABULARY_B)) -> DataFrame:
    """Per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair's
    document count is the highest of its A id), count_sum (the counts of all links' pairs)
    and groups_sha256.

    Null and empty texts, and those that either tokenizer doesn't give back byte by byte,
    have no tokens: zeros and ''. Every row is a document of its own, also where id and
    text repeat; ids of any type, null ones too, stay as they are. An empty table gives
    none. A block's pairs go to buckets by a hash and their counts come back, an entry per
    block and pair, so no pair or document is gathered; to the driver comes a number for
    each id of A."""
    index = pair_index(docs, id_col, text_col, vocabularies)
    size_b = aligner(*vocabularies).size_b
    counted = written(index.where("bucket IS NOT NULL").select("block", "bucket", "pairs").groupBy("bucket").applyInArrow(
        _count(size_b), "block string, bucket long, counts binary, a array<long>, most array<long>"), "pair-counts")
    most = np.zeros(aligner(*vocabularies).size_a, np.int64)
    for a, n in counted.where("block IS NULL").select(F.explode(F.arrays_zip("a", "most")).alias("x")).groupBy("x.a").agg(F.max("x.most")).collect():  # a row per id of A
        most[a] = n
    shared = docs.sparkSession.sparkContext.broadcast(most)
    kind = index.schema["doc_id"].dataType.simpleString()
    return (index.groupBy("block").cogroup(counted.where("block IS NOT NULL").select("block", "bucket", "counts").groupBy("block"))
            .applyInArrow(_returned(size_b, shared), f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"))


def op12_alignment(spark, sf_dir: str) -> DataFrame:
    """Both tokenisations of every whole text of ``documents``, aligned."""
    return align(table(spark, sf_dir, "documents").select("doc_id", "text"))
