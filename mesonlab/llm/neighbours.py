"""Approximate nearest neighbours by NN-descent.

Graph: every vector starts with its nearest among the blocks it falls into when vectors
are put in the order of random projections. Then rounds of joins: whoever points at a
vector, or is pointed at by it, meets those that it points at, and every vector keeps the
nearest it has met; a pair meets again only if one of its two links is new. Rounds end
when few links change. Queries walk the graph greedily, all at a time: each opens the
nearest vectors of its pool that it hasn't opened, their neighbours are scored and the
nearest stay, until a pool holds nothing unopened. The pools are scored exactly last.

Nearness is the inner product. For the graph each vector gets one more coordinate that
makes all lengths equal, so that the nearest are also the closest ones; a query's is 0."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from mesonlab.llm.common import prepare, table, written

#: Neighbours that a search returns, and links of a vector in the graph.
TOP, LINKS = 20, 40
#: Orders by random projections that the graph starts from, vectors of a block of them, and
#: links that each adds.
STARTS, START_BLOCK, START_LINKS = 8, 2048, 20
#: Vectors whose neighbourhoods are joined in a task; those of one that many vectors point
#: at are dealt to parts of so many.
JOINED, PART = 6144, 512
#: Rounds of the graph end when a smaller share of the links is new, or after so many.
SETTLED, ROUNDS = 0.02, 12
#: A query's pool, vectors that it opens in a round, and vectors that all queries start from.
POOL, OPENED, ENTRIES = 200, 40, 256
#: Bytes of the queries that are searched together.
QUERY_BYTES = 1 << 26
EDGE = "u long, w long, d float, fresh boolean"


def _floats(lists, dim: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _best(u: np.ndarray, w: np.ndarray, d: np.ndarray, old: np.ndarray, k: int) -> np.ndarray:
    """Rows of the ``k`` nearest distinct ``w`` of each ``u``; of rows that repeat, an old one."""
    order = np.lexsort((~old, w, u))
    first = np.ones(len(u), bool)
    first[1:] = (np.diff(u[order]) != 0) | (np.diff(w[order]) != 0)
    order = order[first]
    order = order[np.lexsort((-d[order], u[order]))]
    start = np.flatnonzero(np.diff(u[order], prepend=u[order[:1]] - 1 if len(order) else 0) != 0)
    rank = np.arange(len(order)) - np.repeat(start, np.diff(np.append(start, len(order))))
    return order[rank < k]


def _usable(vector):
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vector, lambda x: x != 0), F.lit(False))


def _rows(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v, h1, h2) of the rows that take part."""
    kind = "float" if isinstance(df.select(F.col(f"`{vector_col}`")).schema[0].dataType.elementType, FloatType) else "double"
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast(f"array<{kind}>").alias("v"))
    return rows.where(F.col("id").isNotNull() & _usable(F.col("v"))).withColumn("h1", F.xxhash64("v")).withColumn("h2", F.xxhash64(F.lit(1), F.reverse("v")))


def _distinct(rows: DataFrame, k: int) -> DataFrame:
    """(node, v, ids): each different vector with the smallest ``k`` + 1 of its ids."""
    few = rows.withColumn("r", F.row_number().over(Window.partitionBy("h1", "h2").orderBy("id"))).where(F.col("r") <= k + 1)
    few = few.groupBy("h1", "h2").agg(F.first("v").alias("v"), F.array_sort(F.collect_list("id")).alias("ids"))
    return written(few.select(F.monotonically_increasing_id().alias("node"), "v", "ids"), "nodes")


def _scaled(nodes: DataFrame, dim: int, seed: int = 7) -> DataFrame:
    """(node, x, p): coordinates in single precision with the additional one, scaled so that
    the longest vector's length is about 1; and the projections."""
    def largest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([float(np.abs(_floats(batch.column(0), dim)).max(initial=0))])], ["m"])
    scale = 0.5 ** np.frexp(nodes.select("v").mapInArrow(largest, "m double").agg(F.max("m")).first()[0])[1]

    def length(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _floats(batch.column(0), dim).astype(np.float64) * scale
            yield pa.RecordBatch.from_arrays([pa.array([float((x * x).sum(1).max(initial=0))])], ["m"])
    longest = nodes.select("v").mapInArrow(length, "m double").agg(F.max("m")).first()[0] * (1 + 1e-12)
    axes = np.random.default_rng(seed).normal(size=(dim + 1, STARTS))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _floats(batch.column(1), dim).astype(np.float64) * scale
            x = np.hstack([x, np.sqrt(np.maximum(longest - (x * x).sum(1, keepdims=True), 0))]) / np.sqrt(longest)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(x.astype(np.float32)), pa.list_(pa.float32())), pa.array(list(x @ axes), pa.list_(pa.float64()))], ["node", "x", "p"])
    return written(nodes.select("node", "v").mapInArrow(rows, "node long, x array<float>, p array<double>"), "scaled")


def _merged(edges: DataFrame, blocks: int, links: int) -> DataFrame:
    """Of all links met, the nearest of every vector."""
    def best(group: pa.Table) -> pa.Table:
        u, w, d, fresh = (group[c].to_numpy() for c in ("u", "w", "d", "fresh"))
        return group.select(["u", "w", "d", "fresh"]).take(pa.array(_best(u, w, d, ~fresh, links)))
    return written(edges.withColumn("home", F.pmod(F.hash("u"), F.lit(blocks))).groupBy("home").applyInArrow(best, EDGE), "links")


def _started(scaled: DataFrame, dim: int, blocks: int, count: int) -> DataFrame:
    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, many = [], 0

        def joined(node: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
            k = min(START_LINKS, len(node) - 1)
            dots = x @ x.T
            np.fill_diagonal(dots, -np.inf)
            at = np.argpartition(-dots, k - 1, axis=1)[:, :k] if k else np.zeros((len(node), 0), np.int64)
            return pa.RecordBatch.from_arrays([pa.array(np.repeat(node, k)), pa.array(node[at].ravel()), pa.array(np.take_along_axis(dots, at, 1).ravel()), pa.array(np.ones(at.size, bool))], ["u", "w", "d", "fresh"])

        for batch in batches:
            held.append((batch.column(0).to_numpy(), _floats(batch.column(1), dim + 1)))
            many += len(batch)
            while many >= 2 * START_BLOCK:
                node, x = (np.concatenate(c) for c in zip(*held))
                yield joined(node[:START_BLOCK], x[:START_BLOCK])
                held, many = [(node[START_BLOCK:], x[START_BLOCK:])], many - START_BLOCK
        if many > 1:
            node, x = (np.concatenate(c) for c in zip(*held))
            yield joined(node, x)
    out = None
    for s in range(STARTS):
        order = scaled.select("node", "x", F.get("p", F.lit(s)).alias("p")).repartitionByRange(max(count // (4 * START_BLOCK), 1), "p", "node").sortWithinPartitions("p", "node")
        one = order.select("node", "x").mapInArrow(near, EDGE)
        out = one if out is None else out.unionByName(one)
    return _merged(out, blocks, LINKS)


def _local_join(dim: int, links: int):
    def join(lists: pa.Table, members: pa.Table) -> pa.Table:
        node, low = members["node"].to_numpy(), members["low"].to_numpy()
        order = np.argsort(node)
        node, low, x = node[order], low[order], _floats(members["x"].combine_chunks(), dim + 1)[order]
        v, part, forward, fresh = (lists[c].to_numpy() for c in ("v", "part", "forward", "fresh"))
        m = np.searchsorted(node, lists["m"].to_numpy())
        order = np.lexsort((~forward, part, v))
        v, part, forward, fresh, m = (c[order] for c in (v, part, forward, fresh, m))
        start = np.flatnonzero(np.append(True, (np.diff(v) != 0) | (np.diff(part) != 0)))
        end = np.append(start[1:], len(v))
        ahead = np.add.reduceat(forward.astype(np.int64), start)
        some = np.logical_or.reduceat(fresh, start)
        found: list[tuple] = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32))]
        held = 0

        def settle():
            u, w, d = (np.concatenate(c) for c in zip(*found))
            keep = _best(u, w, d, np.zeros(len(u), bool), links)
            found[:] = [(u[keep], w[keep], d[keep])]

        for s, e, f in zip(start[some], end[some], ahead[some]):
            if not f:
                continue
            own, to = m[s:e], m[s:s + f]
            dots = x[own] @ x[to].T
            ok = (fresh[s:e, None] | fresh[None, s:s + f]) & (own[:, None] != to)
            i, j = np.nonzero(ok & (dots > low[own][:, None]))
            k, n = np.nonzero(ok & (dots > low[to]))
            found.append((np.concatenate((own[i], to[n])), np.concatenate((to[j], own[k])), np.concatenate((dots[i, j], dots[k, n]))))
            held += len(i) + len(k)
            if held > 1 << 22:
                settle()
                held = 0
        settle()
        u, w, d = found[0]
        return pa.table({"u": node[u], "w": node[w], "d": d, "fresh": np.ones(len(u), bool)})
    return join


def _round(edges: DataFrame, scaled: DataFrame, dim: int, blocks: int, links: int) -> DataFrame:
    """One round: the neighbours' neighbours join the links."""
    low = edges.groupBy("u").agg(F.min("d").alias("low"), F.count(F.lit(1)).alias("n")).select(F.col("u").alias("node"), F.when(F.col("n") >= links, F.col("low")).otherwise(F.lit(float("-inf"))).cast("float").alias("low"))
    known = scaled.select("node", "x").join(low, "node", "left").fillna(float("-inf"), ["low"])
    parts = edges.groupBy("w").agg(F.ceil(F.count(F.lit(1)) / F.lit(PART)).alias("parts")).withColumnRenamed("w", "v")
    ahead = edges.select(F.col("u").alias("v"), F.col("w").alias("m"), "fresh").join(parts, "v", "left")
    ahead = ahead.select("v", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)).cast("int") - 1)).alias("part"), "m", F.lit(True).alias("forward"), "fresh")
    back = edges.select(F.col("w").alias("v"), F.col("u").alias("m"), "fresh").join(parts, "v").select("v", F.pmod(F.hash("m"), F.col("parts").cast("int")).alias("part"), "m", F.lit(False).alias("forward"), "fresh")
    lists = written(ahead.unionByName(back).withColumn("block", F.pmod(F.hash("v", "part"), F.lit(blocks))), "neighbourhoods")
    members = lists.select(F.col("block").alias("home"), F.col("m").alias("node")).distinct().join(known, "node")
    met = lists.groupBy("block").cogroup(members.groupBy("home")).applyInArrow(_local_join(dim, links), EDGE)
    return _merged(edges.withColumn("fresh", F.lit(False)).unionByName(met), blocks, links)


class Graph:
    """A neighbour graph over the different vectors of a table, of one length."""

    def __init__(self, nodes: DataFrame, dim: int, links: int = LINKS):
        self.nodes, self.dim = nodes, dim
        self.scaled = _scaled(nodes, dim)
        self.count = self.scaled.count()
        blocks = max(-(-self.count // JOINED), 1)
        edges = _started(self.scaled, dim, blocks, self.count)
        self.rounds, wanted = 0, min(links, self.count - 1)
        while self.rounds < ROUNDS:
            many, fresh = edges.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("fresh").cast("long")), F.lit(0))).first()
            if many == self.count * wanted and fresh <= SETTLED * many or not many:
                break
            edges, self.rounds = _round(edges, self.scaled, dim, blocks, wanted), self.rounds + 1
        # links backwards too, of each vector the nearest
        back = edges.select(F.col("w").alias("u"), F.col("u").alias("w"), "d").withColumn("r", F.row_number().over(Window.partitionBy("u").orderBy(F.col("d").desc(), "w"))).where(F.col("r") <= links)
        self.edges = edges
        self.adjacency = written(edges.select("u", "w").union(back.select("u", "w")).groupBy(F.col("u").alias("node")).agg(F.collect_set("w").alias("near")), "adjacency")

    def search(self, asked: DataFrame, pool: int = POOL, opened: int = OPENED) -> DataFrame:
        """(q, node): the pools of the queries ``asked`` (q long, v), which come to the driver
        in blocks of at most QUERY_BYTES."""
        many = asked.count()
        blocks = max(-(-many * self.dim * 8 // QUERY_BYTES), 1)
        asked = written(asked.withColumn("block", F.pmod(F.hash("q"), F.lit(blocks))), "asked")
        out = None
        for b in range(blocks):
            part = self._walk(asked.where(F.col("block") == b).select("q", "v").toArrow(), pool, opened)
            out = part if out is None else out.unionByName(part)
        return out

    def _walk(self, asked: pa.Table, pool: int, opened: int) -> DataFrame:
        spark, dim = self.nodes.sparkSession, self.dim
        names = asked["q"].to_numpy()
        x = _floats(asked["v"].combine_chunks(), dim).astype(np.float64)
        x = np.hstack([x / np.maximum(np.abs(x).max(1, keepdims=True), 1e-300), np.zeros((len(x), 1))]).astype(np.float32)
        entry = self.scaled.select("node", "x").orderBy(F.hash("node"), "node").limit(ENTRIES).toArrow()  # ENTRIES rows
        entries, ex = entry["node"].to_numpy(), _floats(entry["x"].combine_chunks(), dim + 1)
        shared = spark.sparkContext.broadcast((x, entries, ex))

        def started(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            x, entries, ex = shared.value
            for batch in batches:
                q = batch.column(0).to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(q, len(entries)).astype(np.int32)), pa.array(np.tile(entries, len(q))), pa.array((x[q] @ ex.T).ravel()), pa.array(np.zeros(len(q) * len(entries), bool))], ["q", "node", "s", "done"])

        def nearest(rows: DataFrame) -> DataFrame:
            # of one vector met twice, what is known about it; then the nearest of each query
            rows = rows.repartition("q").groupBy("q", "node").agg(F.max("s").alias("s"), F.max("done").alias("done"))
            rank = F.row_number().over(Window.partitionBy("q").orderBy(F.col("s").desc(), "node"))
            rows = rows.withColumn("r", rank).where(F.col("r") <= pool)
            turn = F.row_number().over(Window.partitionBy("q").orderBy("done", "r"))
            return rows.withColumn("now", ~F.col("done") & (turn <= opened)).select("q", "node", "s", "done", "now")
        now = written(nearest(spark.range(len(x)).mapInArrow(started, "q int, node long, s float, done boolean")), "pool")
        while True:
            front = now.where("now").select("q", "node")
            state = now.groupBy("q").agg(F.min("s").alias("s"), F.count(F.lit(1)).alias("n"), F.max("now").alias("now")).toPandas()  # a row per query of the block
            if not state["now"].any():
                break
            least = np.full(len(x), -np.inf, np.float32)
            full = state["n"] >= pool
            least[state["q"][full]] = state["s"][full]
            floor = spark.sparkContext.broadcast(least)

            def scored(batches: Iterator[pa.RecordBatch], floor=floor) -> Iterator[pa.RecordBatch]:
                x, least = shared.value[0], floor.value
                for batch in batches:
                    q, y = batch.column(0).to_numpy(), _floats(batch.column(2), dim + 1)
                    s = np.einsum("ij,ij->i", x[q], y)
                    at = np.flatnonzero(s > least[q])
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at)), pa.array(s[at]), pa.array(np.zeros(len(at), bool))], ["q", "node", "s", "done"])
            met = front.join(self.adjacency, "node").select("q", F.explode("near").alias("node")).repartition("node").dropDuplicates(["node", "q"])
            met = met.join(self.scaled.select("node", "x"), "node").select("q", "node", "x").mapInArrow(scored, "q int, node long, s float, done boolean")
            now = written(nearest(now.select("q", "node", "s", (F.col("done") | F.col("now")).alias("done")).unionByName(met)), "pool")
        numbers = spark.createDataFrame(pa.table({"q": np.arange(len(names), dtype=np.int32), "name": names}))
        return now.join(F.broadcast(numbers), "q").select(F.col("name").alias("q"), "node")


def _dot(a, b):
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def nearest_vectors(vectors: DataFrame, queries: DataFrame, k: int = TOP, id_col: str = "vec_id", vector_col: str = "embedding", links: int = LINKS, pool: int = POOL) -> DataFrame:
    """(query_id, rank, vec_id, score): of every row of ``queries`` (the same columns) the
    ``k`` rows of ``vectors`` of largest inner product found, without those of its own id.

    Equal vectors are one vertex of the graph with its smallest ``k`` + 1 ids, so copies
    don't crowd out other neighbours; equal scores come by id. Vectors that are null, zero or
    hold null or non-finite components, and null ids, take no part; vectors of different
    lengths don't meet; rows that repeat an id and a vector count once, as query and as
    neighbour. Empty tables give no rows. Scores are added up in double precision from the
    vectors as they come; the graph is walked in single precision."""
    prepare(vectors.sparkSession)
    rows = _rows(vectors, id_col, vector_col).dropDuplicates(["id", "h1", "h2"])
    nodes = _distinct(rows, k)
    asked = _rows(queries, id_col, vector_col).dropDuplicates(["id", "h1", "h2"])
    asked = written(asked, "queries")
    faces = written(asked.groupBy("h1", "h2").agg(F.first("v").alias("v")).withColumn("q", F.monotonically_increasing_id()), "faces")
    out = None
    for (dim,) in nodes.select(F.size("v").alias("d")).distinct().sort("d").collect():  # the lengths that occur
        graph = Graph(nodes.where(F.size("v") == dim), dim, links)
        pools = graph.search(faces.where(F.size("v") == dim).select("q", "v"), max(pool, k + 1))
        out = pools if out is None else out.unionByName(pools)
    schema = "query_id long, rank int, vec_id long, score double"
    if out is None:
        return vectors.sparkSession.createDataFrame([], schema)
    scored = out.join(nodes, "node").join(faces.select("q", F.col("v").alias("qv"), "h1", "h2"), "q").select("h1", "h2", "ids", _dot(F.col("qv"), F.col("v")).alias("score"))
    best = scored.withColumn("r", F.row_number().over(Window.partitionBy("h1", "h2").orderBy(F.col("score").desc(), F.get("ids", F.lit(0))))).where(F.col("r") <= k + 1)
    found = best.select("h1", "h2", "score", F.explode("ids").alias("vec_id"))
    found = found.join(asked.select("h1", "h2", F.col("id").alias("query_id")), ["h1", "h2"]).where(F.col("query_id") != F.col("vec_id"))
    rank = F.row_number().over(Window.partitionBy("h1", "h2", "query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op11_neighbours(spark, sf_dir: str) -> DataFrame:
    """The 20 nearest found of all ``embeddings`` for those whose id is divisible by 20."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest_vectors(vectors, vectors.where(F.col("vec_id") % 20 == 0))
