"""Near-duplicate documents by HyperMinHash: one hash per shingle, the minimum of
each bucket stored as its count of leading zeros and a few mantissa bits; bands of
these compressed registers propose pairs, a collision-corrected estimate of the
Jaccard similarity sifts them, and full shingle sets confirm them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mesonlab.llm.common import table, window_hashes, word_hashes, written
from mesonlab.llm.components import components

#: Words of a shingle and the similarity of a link; the registered query takes four words.
SHINGLE, PERCENT, QUERY_SHINGLE = 5, 80, 4
#: A pair at the threshold shares no band with probability (1 - 0.8^5)^32 = 3e-6.
BANDS, ROWS = 32, 5
BUCKETS, MANTISSA = BANDS * ROWS, 10
#: Expected share of registers that agree by chance, for sets of equal size.
COLLISION = 0.169919 / (1 << MANTISSA)
#: Estimates are sifted four standard deviations below the threshold.
SLACK = 4.0
#: Keys of texts to be confirmed that may be broadcast (8 bytes each); more are joined.
BROADCAST_KEYS = 500_000
#: Members of a part of a bucket, two of which are compared in a task, and rows of a step.
PART, COMPARED = 2048, 128
#: Shingles of a part, about (8 bytes each); a longer text is a part's only bulk.
PART_SHINGLES = 1 << 20
#: Buckets of at most so many classes take their smallest member as pivot.
SMALL_BUCKET = 8
_ORDER = np.argsort(np.random.default_rng(11).random((BUCKETS, BUCKETS)), axis=1)


def shingle_sets(texts, size: int = SHINGLE) -> Iterator[tuple[int, np.ndarray]]:
    """(index, sorted distinct shingle hashes) of each text with words."""
    for first, hashes, offsets in word_hashes(texts, "nonspace"):
        for k in range(len(offsets) - 1):
            own = hashes[offsets[k]:offsets[k + 1]]
            if len(own):
                yield first + k, np.unique(window_hashes(own, min(size, len(own))))


def registers(shingles: np.ndarray) -> np.ndarray:
    """Compressed registers of sorted hashes. An empty bucket borrows the register of
    the first filled one in an order of its own, the same for all texts."""
    bucket = ((shingles >> np.uint64(32)) * np.uint64(BUCKETS)) >> np.uint64(32)
    place = shingles * np.uint64(BUCKETS)  # position inside the bucket, of 2**64
    filled, at = np.unique(bucket, return_index=True)
    low = place[at]
    bits = np.frexp(low.astype(np.float64))[1]
    zeros = np.clip(64 - bits, 0, 53).astype(np.uint64)
    mantissa = (low << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA)
    out = np.zeros(BUCKETS, np.int16)
    out[filled.astype(np.int64)] = ((zeros << np.uint64(MANTISSA)) | mantissa).astype(np.uint16).view(np.int16)
    if len(filled) < BUCKETS:
        have = np.zeros(BUCKETS, bool)
        have[filled.astype(np.int64)] = True
        empty = np.flatnonzero(~have)
        out[empty] = out[_ORDER[empty, have[_ORDER[empty]].argmax(1)]]
    return out


def _lists(arrays: list[np.ndarray], kind) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, kind))


def sketches(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Per row of (doc_id, text): n_shingles, a digest of the whole set, registers."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, digest = np.zeros(len(batch), np.int64), [None] * len(batch)
            regs: list = [None] * len(batch)
            texts = (x.as_py() for x in batch.column(1))
            for i, own in shingle_sets(texts, shingle):
                n[i], digest[i], regs[i] = len(own), xxhash.xxh3_128_digest(own.tobytes()), registers(own)
            none = np.zeros(0, np.int16)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(digest, pa.binary()), _lists([none if r is None else r for r in regs], pa.int16())],
                                             ["doc_id", "n_shingles", "digest", "regs"])
    return docs.select("doc_id", "text").mapInArrow(rows, "doc_id long, n_shingles long, digest binary, regs array<short>")


def _sets(docs: DataFrame, shingle: int) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, sets, held = [], [], 0
            for i, own in shingle_sets((x.as_py() for x in batch.column(1)), shingle):
                at.append(i)
                sets.append(own.view(np.int64))
                held += len(own)
                if held > 1 << 21:
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int32())), _lists(sets, pa.int64())], ["id", "shingles"])
                    at, sets, held = [], [], 0
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int32())), _lists(sets, pa.int64())], ["id", "shingles"])
    return docs.select("doc_id", "text").mapInArrow(rows, "id long, shingles array<long>")


def _likely(ra: str, rb: str, na: str, nb: str, percent: int):
    """Estimated similarity, corrected for registers that agree by chance, not far
    below the threshold."""
    t = percent / 100
    agree = F.aggregate(F.zip_with(ra, rb, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x) / BUCKETS
    chance = F.lit(COLLISION * 4) * F.col(na) * F.col(nb) / ((F.col(na) + F.col(nb)) * (F.col(na) + F.col(nb)))
    return (agree - chance) / (1 - chance) >= t - SLACK * (t * (1 - t) / BUCKETS) ** 0.5


def _own_sets(ids: DataFrame, docs: DataFrame, shingle: int) -> DataFrame:
    """(id, shingles) of the documents named by ``ids`` (doc_id)."""
    keys = written(ids.distinct(), "keys")
    keys = F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys
    return written(_sets(docs.join(keys, "doc_id", "left_semi"), shingle).dropDuplicates(["id"]), "sets")


def _untested(members: DataFrame, percent: int) -> DataFrame:
    """Links between classes of different components that share a bucket, each tested
    in the first band that it shares: by the estimate, then on full sets. A large bucket
    is dealt to parts of bounded size, and a task compares two parts. It names a link
    only between classes that its other links don't connect, so it returns fewer
    rows than it reads."""
    t = percent / 100
    least = t - SLACK * (t * (1 - t) / BUCKETS) ** 0.5

    def compare(group: pa.Table) -> pa.Table:
        x, y, band = group["x"][0].as_py(), group["y"][0].as_py(), group["band"][0].as_py()
        part, rep, comp = (group[c].to_numpy() for c in ("part", "rep", "comp"))
        regs = group["regs"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, BUCKETS)
        n = group["size"].to_numpy()
        ends = np.concatenate(([0], np.cumsum(n)))
        own_ids, flat = np.unique(group["shingles"].combine_chunks().flatten().to_numpy(zero_copy_only=False), return_inverse=True)
        mark = np.zeros(len(own_ids), bool)
        label = np.unique(comp, return_inverse=True)[1]
        left, right = np.flatnonzero(part == x), np.flatnonzero(part == y)
        out = []
        for lo in range(0, len(left), COMPARED):
            own = left[lo:lo + COMPARED]
            able = (label[own][:, None] != label[right]) & (100 * np.minimum(n[own][:, None], n[right]) >= percent * np.maximum(n[own][:, None], n[right]))
            if x == y:
                able &= rep[own][:, None] < rep[right]
            i, j = np.nonzero(able)
            likely = []
            for at in range(0, len(i), COMPARED * COMPARED):
                p, q = own[i[at:at + COMPARED * COMPARED]], right[j[at:at + COMPARED * COMPARED]]
                same = regs[p] == regs[q]
                chance = 4 * COLLISION * n[p] * n[q] / (n[p] + n[q]) ** 2
                good = (same.mean(1) - chance) / (1 - chance) >= least
                good &= ~same.reshape(-1, BANDS, ROWS).all(2)[:, :band].any(1)
                likely.append((p[good], q[good]))
            p, q = (np.concatenate([k[side] for k in likely] or [left[:0]]) for side in (0, 1))
            firsts = np.flatnonzero(np.diff(p, prepend=-1))
            for start, end in zip(firsts, np.append(firsts[1:], len(p))):
                a, others = p[start], q[start:end]
                others = others[label[others] != label[a]]
                if not len(others):
                    continue
                mark[flat[ends[a]:ends[a + 1]]] = True
                shared = np.array([np.count_nonzero(mark[flat[ends[k]:ends[k + 1]]]) for k in others])
                mark[flat[ends[a]:ends[a + 1]]] = False
                linked = others[100 * shared >= percent * (n[a] + n[others] - shared)]
                if len(linked):
                    labels, at = np.unique(label[linked], return_index=True)
                    out.append((np.full(len(at), rep[a]), rep[linked[at]]))
                    label[np.isin(label, labels)] = label[a]
        return pa.table({c: np.concatenate([o[k] for o in out] or [np.zeros(0, np.int64)]) for k, c in enumerate("ab")})
    parts = F.greatest(F.ceil(F.col("many") / PART), F.ceil(F.col("total") / PART_SHINGLES))
    dealt = members.withColumn("part", F.pmod(F.xxhash64("rep"), parts)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    dealt = dealt.select("key", "band", "rep", "comp", "regs", "shingles", F.size("shingles").cast("long").alias("size"), "part",
                         F.least("part", "other").alias("x"), F.greatest("part", "other").alias("y"))
    return dealt.groupBy("key", "x", "y").applyInArrow(compare, "a long, b long").distinct()


def _links(pairs: DataFrame, classes: DataFrame, docs: DataFrame, percent: int, shingle: int) -> DataFrame:
    """The pairs (a, b) whose sets have the similarity; sifted by the estimate first."""
    regs = classes.select("rep", "n", "regs")
    both = (pairs.join(regs.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("regs").alias("ra")), "a")
            .join(regs.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("regs").alias("rb")), "b"))
    sifted = written(both.where(_likely("ra", "rb", "na", "nb", percent)).select("a", "b"), "pairs")
    sets = _own_sets(sifted.select(F.col("a").alias("doc_id")).union(sifted.select("b")), docs, shingle)
    full = (sifted.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), "a")
            .join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb")), "b"))
    shared = F.size(F.array_intersect("sa", "sb"))
    return full.where(100 * shared >= percent * (F.size("sa") + F.size("sb") - shared)).select("a", "b")


def near_duplicates(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """Per row of ``docs`` (doc_id, text; other columns are ignored): doc_id,
    n_shingles, component_id, kept (doc_id = component_id). Sets hold the distinct runs of
    ``shingle`` words.

    Texts with the same set are one class, so copies cost a row each and no pair.
    In every bucket of a band, classes are tested against one pivot; pairs left
    between different components are then tested too, so no bucket emits all its
    pairs and no link between components is lost. A text without words links with nothing.
    Rows that repeat an id form one document if their sets agree; a null id takes no
    part: component_id is null, kept is true. No rows give no rows."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    sketched = written(sketches(docs, shingle), "sketches")
    known = sketched.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    classes = written(known.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("regs").alias("regs")), "classes")
    bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(F.slice("regs", b * ROWS + 1, ROWS), b))
    keyed = classes.select("rep", "n", F.posexplode(bands).alias("band", "key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("many")).where(F.col("many") > 1)
    members = written(keyed.join(shared, "key"), "members")
    # one pivot a bucket; in large buckets a random one, so that a class meets many pivots over its bands
    order = F.when(F.col("many") <= SMALL_BUCKET, F.col("rep")).otherwise(F.xxhash64("rep", "key"))
    pivots = members.groupBy("key").agg(F.min(F.struct(order.alias("o"), "rep", "n")).alias("p"))
    tested = members.join(pivots, "key").where(F.col("rep") != F.col("p.rep"))
    fit = 100 * F.least("n", "p.n") >= percent * F.greatest("n", "p.n")
    pairs = tested.where(fit).select(F.least("rep", "p.rep").alias("a"), F.greatest("rep", "p.rep").alias("b")).distinct()
    links = written(_links(pairs, classes, docs, percent, shingle), "links")
    found = written(components(links), "components")
    # what is left: pairs of different components in the same bucket, without its pivot
    rest = tested.select("key", "band", "rep", "n").join(found, tested["rep"] == found["node"], "left")
    rest = written(rest.select("key", "band", "rep", "n", F.coalesce("component", "rep").alias("comp")), "members")
    open_ = rest.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("many"), F.sum("n").alias("total"))
    rest = written(rest.join(open_.where("low < high").select("key", "many", "total"), "key"), "members")
    sets = _own_sets(rest.select(F.col("rep").alias("doc_id")), docs, shingle).withColumnRenamed("id", "rep")
    rest = rest.join(classes.select("rep", "regs").join(sets, "rep"), "rep")
    links = written(links.union(_untested(rest, percent)), "links")
    found = written(components(links), "components")
    ids = classes.select("digest", "rep")
    ids = ids.join(found, ids["rep"] == found["node"], "left").select("digest", F.coalesce("component", "rep").alias("comp"))
    component = F.when(F.col("n_shingles") > 0, F.col("comp")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    out = sketched.select("doc_id", "n_shingles", "digest").join(ids, "digest", "left")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def op4_near_duplicates(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all ``documents``."""
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), shingle=QUERY_SHINGLE)
