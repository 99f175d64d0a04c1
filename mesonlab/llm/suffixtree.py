"""Language model scoring with a probabilistic suffix tree over words.

The alphabet is that of the base score: the training tokens and one symbol for all other
words. The root gives a token seen c times (c - D) / N and the other symbol D V / N. A
context is the run of one to DEPTH tokens before a token, and starts no earlier than its
text. It is a state if training holds it twice or more and its next-token distribution
diverges from that of its suffix, the context without its first token: count * divergence
in nats above DIVERGENCE. A state gives max(n - D, 0) / seen + D distinct / seen * P(its
suffix), where n of its ``seen`` continuations are the token and ``distinct`` tokens
follow; other contexts give what their suffix gives, so a token is scored by the longest
state that ends before it. Each level's D is estimated from how many counts are 1 and 2.
All distributions sum to 1.

Documents are dealt to blocks where they are read. A block numbers its own tokens and sends
its distinct words, and level by level its distinct pairs of context and next token, to
buckets, where they are counted, contexts tested, and pairs seen twice numbered: they
are the contexts of the next level. A block gets back an entry for each of its own, so the
model grows with the corpus, and no part of it is gathered but a few numbers a bucket."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from mesonlab.llm.alignment import _pack, _unpack
from mesonlab.llm.common import crc_mod, prepare, table, word_hashes, written

#: Tokens of the longest contexts.
DEPTH = 3
#: A context is a state if count * divergence (in nats) from its suffix exceeds this.
DIVERGENCE = 3.0
#: Characters of a block of documents, and of a bucket's share of the corpus, about.
BLOCK_CHARS, BUCKET_CHARS, LEAST_BUCKETS = 8_000_000, 16_000_000, 12
#: A context with more occurrences than this, and than a 65,536th of all, is dealt to
#: several buckets: at most 65,536 contexts are.
HOT = 1 << 18
#: Steps of a nat in which a suffix's probability travels with a pair.
STEPS = 8
END = np.uint64(0x9E3779B97F4A7C15)  # the text's end among word hashes


def discount(ones: int, twos: int) -> float:
    """What absolute discounting takes from each count."""
    return min(max(ones / max(ones + 2 * twos, 1), 0.1), 0.9)


def _distinct(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys in order, a place of each, and of every key its number among them."""
    order = np.argsort(key)
    ordered = key[order]
    new = np.ones(len(key), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    at = np.empty(len(key), np.int64)
    at[order] = np.cumsum(new) - 1
    return ordered[new], order[new], at


def _sums(at: np.ndarray, n: np.ndarray, size: int) -> np.ndarray:
    """Sums of ``n`` by ``at``: whole numbers, exact below 2^53."""
    return np.bincount(at, n, size).astype(np.int64)


def _lists(block: str, docs: list[pa.RecordBatch], sizes: list[np.ndarray], tokens: list[np.ndarray], buckets: int, schema: pa.Schema) -> pa.RecordBatch:
    """A block as rows: its documents, with the tokens as places among its distinct words;
    and the words' hashes with their training counts, by bucket."""
    size, token = np.concatenate(sizes), np.concatenate(tokens)
    rows = pa.Table.from_batches(docs)
    learn = rows["learn"].to_numpy()
    own, _, local = _distinct(token)
    seen = _sums(local, np.repeat(learn, size), len(own))
    cuts = np.searchsorted((own >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32), np.arange(buckets + 1, dtype=np.uint64))
    some = np.flatnonzero(np.diff(cuts))
    cells = [_pack(np.diff(own[cuts[b]:cuts[b + 1]], prepend=np.uint64(0)), seen[cuts[b]:cuts[b + 1]]) for b in some]
    n = len(cells)
    columns = {"doc_id": pa.array([rows["doc_id"].combine_chunks()] + [None] * n, schema.field("doc_id").type),
               "learn": pa.array([learn] + [None] * n, pa.list_(pa.bool_())), "held_out": pa.array([rows["held_out"].to_numpy()] + [None] * n, pa.list_(pa.bool_())),
               "tokens": pa.array([_pack(size, local)] + [None] * n, pa.binary()),
               "block": pa.array([block] * (n + 1)), "bucket": pa.array([None, *some.tolist()], pa.int64()), "data": pa.array([None, *cells], pa.binary())}
    return pa.RecordBatch.from_arrays([columns[f.name] for f in schema], schema=schema)


def _blocks(docs: DataFrame, buckets: int) -> DataFrame:
    """Blocks of ``docs`` (doc_id, text, learn, held_out), made where the documents are read."""
    kind = docs.schema["doc_id"].dataType
    schema = pa.schema([("block", pa.string()), ("doc_id", pa.list_(to_arrow_type(kind))), ("learn", pa.list_(pa.bool_())), ("held_out", pa.list_(pa.bool_())),
                        ("tokens", pa.binary()), ("bucket", pa.int64()), ("data", pa.binary())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, number = TaskContext.get().partitionId(), 0
        held, sizes, tokens, chars = [], [], [], 0
        for batch in batches:
            ids = batch.select(["doc_id", "learn", "held_out"])
            for first, hashes, offsets in word_hashes((x.as_py() for x in batch.column("text")), "nonspace"):
                many = len(offsets) - 1
                if held and chars + 6 * len(hashes) > BLOCK_CHARS:
                    yield _lists(f"{part}-{number}", held, sizes, tokens, buckets, schema)
                    held, sizes, tokens, chars, number = [], [], [], 0, number + 1
                held.append(ids.slice(first, many))
                sizes.append(np.diff(offsets) + 1)
                tokens.append(np.insert(hashes, offsets[1:], END))
                chars += 6 * len(hashes) + many
        if held:
            yield _lists(f"{part}-{number}", held, sizes, tokens, buckets, schema)
    text = f"block string, doc_id array<{kind.simpleString()}>, learn array<boolean>, held_out array<boolean>, tokens binary, bucket long, data binary"
    return docs.mapInArrow(rows, text)


COUNTED = "block string, level int, bucket long, data binary, total long, many long, ones long, twos long, hot array<struct<context:long,seen:long,many:long,gain:double>>"


def _replies(group: pa.Table, level: int, data: list[bytes], total: int, many: int, counts: np.ndarray, hot: list[dict]) -> pa.Table:
    """A bucket's replies to the blocks, and a row without a block about the bucket."""
    n = len(data)
    nulls = [None] * n
    return pa.table({"block": pa.array([*group["block"].to_pylist(), None], pa.string()), "level": pa.array([level] * (n + 1), pa.int32()), "bucket": pa.array([*group["bucket"].to_pylist(), group["bucket"][0].as_py()], pa.int64()),
                     "data": pa.array([*data, None], pa.binary()), "total": pa.array([*nulls, total], pa.int64()), "many": pa.array([*nulls, many], pa.int64()),
                     "ones": pa.array([*nulls, int((counts == 1).sum())], pa.int64()), "twos": pa.array([*nulls, int((counts == 2).sum())], pa.int64()),
                     "hot": pa.array([*nulls, hot], pa.list_(pa.struct([("context", pa.int64()), ("seen", pa.int64()), ("many", pa.int64()), ("gain", pa.float64())])))})


def _count_words(group: pa.Table) -> pa.Table:
    """Numbers inside the bucket, and training counts, of each block's words. ``many`` is the
    number of words, ``total`` that of words that training holds."""
    cells = [_unpack(x) for x in group["data"].to_pylist()]
    keys = [np.cumsum(c[0].view(np.uint64), dtype=np.uint64) for c in cells]
    own, _, at = _distinct(np.concatenate(keys))
    count = _sums(at, np.concatenate([c[1] for c in cells]), len(own))
    cuts = np.cumsum([0, *map(len, keys)])
    data = [_pack(np.diff(at[s:e], prepend=0), count[at[s:e]]) for s, e in zip(cuts[:-1], cuts[1:])]
    hot = [{"context": 0, "seen": int(count.sum()), "many": 0, "gain": 0.0}]  # the tokens of the bucket
    return _replies(group, 0, data, int((count > 0).sum()), len(own), count, hot)


def _diverges(seen: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Whether count * divergence, from the sum over pairs of n (log n - log of the suffix's
    probability), is above the threshold by more than rounding."""
    return (seen >= 2) & (total - seen * np.log(np.maximum(seen, 1)) > DIVERGENCE + 1e-6)


def _count_pairs(level: int, plain: int):
    def count(group: pa.Table) -> pa.Table:
        """Of each block's pairs in the bucket, the training count and the number as a context of
        the next level; of each of its contexts how often seen and how many tokens follow, 0
        if it is no state. Buckets from ``plain`` on hold parts of hot contexts."""
        cells = [_unpack(x) for x in group["data"].to_pylist()]
        context = np.concatenate([np.repeat(np.cumsum(c[0]), c[1]) for c in cells])
        following = np.concatenate([_following(c[1], c[2]) for c in cells])
        contexts, _, c_at = _distinct(context)
        _, _, f_at = _distinct(following)
        pairs, first, at = _distinct(c_at << 32 | f_at)
        n = _sums(at, np.concatenate([c[3] for c in cells]), len(pairs))
        cost = np.concatenate([c[4] for c in cells])[first] / STEPS
        start = np.searchsorted(pairs, np.arange(len(contexts)) << 32)
        seen, many = np.add.reduceat(n, start), np.add.reduceat((n > 0).astype(np.int64), start)
        sums = np.add.reduceat(n * (np.log(np.maximum(n, 1)) + cost), start)
        hot = []
        if group["bucket"][0].as_py() >= plain:
            hot = [{"context": int(c), "seen": int(s), "many": int(m), "gain": float(g)} for c, s, m, g in zip(contexts, seen, many, sums)]
            seen = many = np.zeros(len(contexts), np.int64)
        else:
            state = _diverges(seen, sums)
            seen, many = np.where(state, seen, 0), np.where(state, many, 0)
        child = np.where(n >= 2, np.cumsum(n >= 2), 0)
        data, p, q = [], 0, 0
        for c in cells:
            own, ctx = at[p:p + len(c[2])], c_at[p:p + len(c[2])][np.cumsum(c[1]) - c[1]]
            p, q = p + len(c[2]), q + len(c[0])
            has = child[own][child[own] > 0]
            data.append(_pack(n[own], np.diff(has, prepend=0), seen[ctx], many[ctx]))
        return _replies(group, level, data, 0, int((n >= 2).sum()), n, hot)
    return count


def _following(sizes: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Next tokens from the steps between those of a context, the first one from 0."""
    run = np.cumsum(steps)
    start = np.cumsum(sizes) - sizes
    return run - np.repeat(run[start] - steps[start], sizes) if len(sizes) else run


class Model:
    """What all blocks share: a few numbers for each bucket."""

    def __init__(self):
        self.offsets: list[np.ndarray] = []       # of each level, the first number of each bucket
        self.discounts: list[float] = []
        self.hot: list[tuple[np.ndarray, ...]] = []   # of each level, hot contexts: number, seen, many
        self.tokens = self.known = 0

    def add(self, counted: DataFrame, level: int) -> None:
        rows = counted.where("block IS NULL").select("bucket", "total", "many", "ones", "twos").collect()  # a row per bucket
        offsets = np.zeros(max((r.bucket for r in rows), default=-1) + 2, np.int64)
        for r in rows:
            offsets[r.bucket + 1] = r.many
        self.offsets.append(np.cumsum(offsets))
        self.discounts.append(discount(sum(r.ones for r in rows), sum(r.twos for r in rows)))
        parts = counted.where("block IS NULL").select(F.explode("hot").alias("h"))
        if level == 0:
            self.tokens, self.known = parts.agg(F.coalesce(F.sum("h.seen"), F.lit(0))).first()[0], sum(r.total for r in rows)
            return
        whole = parts.groupBy("h.context").agg(F.sum("h.seen").alias("seen"), F.sum("h.many").alias("many"), F.sum("h.gain").alias("gain")).collect()  # at most 65,536 contexts
        kept = sorted((r.context, r.seen, r.many) for r in whole if _diverges(np.float64(r.seen), np.float64(r.gain)))
        self.hot.append(tuple(np.array([k[c] for k in kept], np.int64) for c in range(3)))


class Block:
    """One block's tokens, and the probabilities that the levels counted so far give them."""

    def __init__(self, tokens: bytes, learn: np.ndarray, replies: dict[int, dict[int, bytes]], model: Model, buckets: int):
        self.sizes, self.token = _unpack(tokens)
        self.model, self.buckets, self.weight = model, buckets, np.repeat(learn, self.sizes)
        self.start = np.cumsum(self.sizes) - self.sizes
        cells = [(b, *_unpack(x)) for b, x in sorted(replies[0].items())]
        self.word = np.concatenate([model.offsets[0][b] + np.cumsum(steps) for b, steps, _ in cells])
        self.count = np.concatenate([n for _, _, n in cells])
        d, total = model.discounts[0], max(model.tokens, 1)
        root = np.where(self.count > 0, (self.count - d) / total, d * model.known / total if model.tokens else 1.0)
        self.p = root[self.token]
        # contexts of the next level: their places among ``numbers`` and training counts
        self.context = np.concatenate(([0], self.token[:-1]))
        self.context[self.start] = self.token[self.sizes[0] - 1]  # an end stands before a text's first token
        self.numbers, self.seen = self.word, self.count[self.context]
        for level in range(1, max(replies) + 1):
            self._climb(level, replies.get(level, {}))

    def pairs(self) -> tuple[np.ndarray, ...]:
        """At the positions that have a context seen twice: their places; and the distinct
        pairs in the order of (bucket, context, next token): bucket, context, token, a position,
        and at each place its pair."""
        at = np.flatnonzero(self.seen >= 2)
        key, first, pair = _distinct(self.context[at] << 32 | self.token[at])
        context, token, place = self.numbers[key >> 32], key & 0xFFFFFFFF, at[first]
        spread = (context.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
        least = max(HOT, self.model.tokens >> 16)
        salts = -(-self.seen[place] // least)
        salt = (self.word[token].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(33)) % salts.astype(np.uint64)
        spread = (spread + salt * np.uint64(0x9E3779B1)) & np.uint64(0x7FFFFFFF)
        bucket = (spread * np.uint64(self.buckets) >> np.uint64(31)).astype(np.int64) + np.where(salts > 1, self.buckets, 0)
        order = np.argsort(bucket, kind="stable")
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return at, bucket[order], context[order], token[order], place[order], back[pair]

    def _climb(self, level: int, replies: dict[int, bytes]) -> None:
        at, bucket, context, token, _, pair = self.pairs()
        cells = [(b, *_unpack(x)) for b, x in sorted(replies.items())]
        none = np.zeros(0, np.int64)
        n = np.concatenate([none, *(c[1] for c in cells)])
        new = np.diff(context, prepend=-1) != 0
        new |= np.diff(bucket, prepend=-1) != 0
        which = np.cumsum(new) - 1
        seen, many = (np.concatenate([none, *(c[k] for c in cells)])[which] for k in (3, 4))
        hot, hot_seen, hot_many = self.model.hot[level - 1]
        if len(hot):
            k = np.minimum(np.searchsorted(hot, context), len(hot) - 1)
            is_hot = (bucket >= self.buckets) & (hot[k] == context)
            seen, many = np.where(is_hot, hot_seen[k], seen), np.where(is_hot, hot_many[k], many)
        d = self.model.discounts[level]
        state = seen > 0
        own, rest = np.where(state, np.maximum(n - d, 0) / np.maximum(seen, 1), 0.0), np.where(state, d * many / np.maximum(seen, 1), 1.0)
        self.p[at] = own[pair] + rest[pair] * self.p[at]
        child = np.full(len(n), -1)
        child[n >= 2] = np.concatenate([none, *(self.model.offsets[level][b] + np.cumsum(c) - 1 for b, _, c, _, _ in cells)])
        # the context of the next level is this one and its token; pairs are in the order of their numbers
        self.numbers = child
        here, count = np.zeros(len(self.token), np.int64), np.zeros(len(self.token), np.int64)
        here[at], count[at] = pair, n[pair]
        self.context, self.seen = np.concatenate(([0], here[:-1])), np.concatenate(([0], count[:-1]))
        self.seen[self.start] = 0


def _block(docs: pa.Table, replies: pa.Table, model: Model, buckets: int) -> Block:
    held: dict[int, dict[int, bytes]] = {}
    for level, bucket, data in zip(*(replies[c].to_pylist() for c in ("level", "bucket", "data"))):
        held.setdefault(level, {})[bucket] = data
    held.setdefault(len(model.offsets) - 1, {})
    return Block(docs["tokens"][0].as_py(), docs["learn"][0].values.to_numpy(zero_copy_only=False), held, model, buckets)


def _emitter(shared, buckets: int):
    def emit(docs: pa.Table, replies: pa.Table) -> pa.Table:
        """One block's pairs of the next level with their training counts and the cost of the
        token after the suffix, by bucket."""
        block = _block(docs, replies, shared.value, buckets)
        at, bucket, context, token, place, pair = block.pairs()
        n = np.bincount(pair, block.weight[at], len(bucket)).astype(np.int64)
        cost = np.clip(np.rint(-STEPS * np.log(block.p[place])), 0, 255).astype(np.int64)
        cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
        out = []
        for s, e in zip(cuts, np.append(cuts[1:], len(bucket))):
            first = np.flatnonzero(np.diff(context[s:e], prepend=-1) != 0)
            word = block.word[token[s:e]]
            steps = np.diff(word, prepend=0)
            steps[first] = word[first]
            out.append(_pack(np.diff(context[s:e][first], prepend=0), np.diff(np.append(first, e - s)), steps, n[s:e], cost[s:e]))
        return pa.table({"block": pa.array(docs["block"].to_pylist() * len(out), pa.string()), "bucket": pa.array(bucket[cuts]), "data": pa.array(out, pa.binary())})
    return emit


def _scorer(shared, buckets: int):
    def score(docs: pa.Table, replies: pa.Table) -> pa.Table:
        model = shared.value
        block = _block(docs, replies, model, buckets)
        known = block.count[block.token]
        base = np.log10(known + 1.0) - math.log10(model.tokens + model.known + 1)
        sums = lambda x: np.add.reduceat(x, block.start)
        return pa.table({"doc_id": docs["doc_id"].combine_chunks().flatten(), "held_out": docs["held_out"].combine_chunks().flatten(), "n_tokens": block.sizes, "n_known": sums((known > 0).astype(np.int64)),
                         "train_tokens": np.full(len(block.sizes), model.tokens), "base_score": sums(base), "score": sums(np.log10(np.minimum(block.p, 1.0)))})
    return score


def score_texts(docs: DataFrame, learn, held_out, depth: int = DEPTH) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score (unigrams with add-one smoothing) and score (the tree).

    ``learn`` and ``held_out`` are boolean columns of doc_id. A null text is empty: its
    end alone. With no training rows all counts are 0, and every token has probability 1 (the
    one symbol there is). Repeated rows and null ids are rows like others. An empty table
    gives none. A block sends and gets an entry for each of its distinct words and pairs, in a
    cell for each bucket; hot ones cost an entry a block, and a context beyond HOT
    occurrences is dealt to several buckets. Buckets and blocks grow in number with the
    input, not in size."""
    spark = docs.sparkSession
    prepare(spark)
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(-(-chars // BUCKET_CHARS), LEAST_BUCKETS)
    source = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.coalesce(learn, F.lit(False)).alias("learn"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    blocks = written(_blocks(source, buckets), "lm-blocks")
    texts = blocks.where("tokens IS NOT NULL").select("block", "doc_id", "learn", "held_out", "tokens")
    model, replies = Model(), None
    counted = written(blocks.where("bucket IS NOT NULL").select("block", "bucket", "data").groupBy("bucket").applyInArrow(_count_words, COUNTED), "lm-words")
    for level in range(depth + 1):
        model.add(counted, level)
        own = counted.where("block IS NOT NULL").select("block", "level", "bucket", "data")
        replies = own if replies is None else replies.unionByName(own)
        shared = spark.sparkContext.broadcast(model)
        both = texts.groupBy("block").cogroup(replies.groupBy("block"))
        if level < depth:
            pairs = both.applyInArrow(_emitter(shared, buckets), "block string, bucket long, data binary")
            counted = written(pairs.groupBy("bucket").applyInArrow(_count_pairs(level + 1, buckets), COUNTED), "lm-pairs")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return both.applyInArrow(_scorer(shared, buckets), f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op7_lm_score(spark, sf_dir: str) -> DataFrame:
    """Language model scores of every whole text of ``documents``."""
    fold = crc_mod(F.col("doc_id"), 7)
    return score_texts(table(spark, sf_dir, "documents").select("doc_id", "text"), fold != 2, fold == 2)
