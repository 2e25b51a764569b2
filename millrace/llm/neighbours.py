"""Approximate nearest neighbours by inner product: a forest of random-projection trees.

Vectors that are equal are one entry with its smallest ids; an answer never needs more of them than
``TOP + 1``. Entries get one more component that makes all lengths equal, queries a zero there, so the
largest inner product is the smallest angle.

Trees are grown on a bounded sample of entries: a node splits its entries at the median of their
projections on the difference of two of them. Every entry is then sent down every tree; a leaf is a
group of rows that share its number. A query walks all trees at once with one priority queue, ordered
by the margins on the way, until it has reached its number of leaves. Queries meet entries leaf by
leaf; leaves with many rows are split into blocks. Each block keeps a query's best entries; these are
merged per query, and their inner products with the original vectors are taken in double precision.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.registry import query
from millrace.llm.texts import tidy
from millrace.session import scratch
from millrace.tables import table

TOP = 20
TREES = 8
LEAF = 256  # sampled entries of a leaf, at most
LEAVES = 160  # leaves a query visits over all trees, at least
VISITED = 0.12  # and this share of all leaves
SAMPLE = 60_000  # entries the trees are grown on, at most
BLOCK = 4096  # entries of a leaf that meet its queries in one block
SPARE = 4  # entries a block keeps beyond the wanted ones, as it ranks by sums in another order
HELD = 1 << 20  # scored pairs a task holds before it reduces them
SEED = 11


class Tree:
    """Nodes as arrays: the split's normal and offset, and the two children; a leaf's number is negative."""

    def __init__(self, normals: np.ndarray, offsets: np.ndarray, children: np.ndarray) -> None:
        self.normals, self.offsets, self.children = normals, offsets, children

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector."""
        at = np.zeros(len(vectors), np.int64) if len(self.children) else np.full(len(vectors), -1)
        while (inner := np.flatnonzero(at >= 0)).size:
            for part in np.array_split(inner, -(-len(inner) // 65536)):
                node = at[part]
                side = np.einsum("ij,ij->i", vectors[part], self.normals[node]) > self.offsets[node]
                at[part] = self.children[node, side.astype(np.int64)]
        return -1 - at


def grow(vectors: np.ndarray, seed: int, leaf: int = LEAF) -> Tree:
    rng = np.random.default_rng(seed)
    normals, offsets, children, leaves = [], [], [], 0
    todo = [(np.arange(len(vectors)), -1, 0)]
    while todo:
        rows, parent, side = todo.pop()
        split = None
        if len(rows) > leaf:
            for _ in range(8):
                a, b = rng.choice(rows, 2, replace=False)
                normal = vectors[a] - vectors[b]
                along = vectors[rows] @ normal
                offset = np.median(along)
                right = along > offset
                if 0 < right.sum() < len(rows):
                    split = normal, offset, right
                    break
        if split is None:
            number, leaves = -1 - leaves, leaves + 1
        else:
            number = len(normals)
            normals.append(split[0])
            offsets.append(split[1])
            children.append([0, 0])
            todo += [(rows[split[2]], number, 1), (rows[~split[2]], number, 0)]
        if parent >= 0:
            children[parent][side] = number
    return Tree(
        np.array(normals, np.float32).reshape(-1, vectors.shape[1]), np.array(offsets, np.float32), np.array(children, np.int64).reshape(-1, 2)
    )


def visit(trees: list[Tree], vector: np.ndarray, most: int) -> list[tuple[int, int]]:
    """(tree, leaf) in the order of a priority queue that all trees share.

    A node's place is the smallest margin on the way to it: how far the vector is on the right side
    of every split, or, where negative, how far it is on the wrong one.
    """
    heap = [(-np.inf, t, 0 if len(tree.children) else -1) for t, tree in enumerate(trees)]
    margins = [tree.normals @ vector - tree.offsets if len(tree.children) else None for tree in trees]
    found: list[tuple[int, int]] = []
    while heap and len(found) < most:
        place, t, node = heapq.heappop(heap)
        while node >= 0:
            margin = float(margins[t][node])
            near = 1 if margin > 0 else 0
            heapq.heappush(heap, (max(place, abs(margin)), t, int(trees[t].children[node, 1 - near])))
            node = int(trees[t].children[node, near])
        found.append((t, -1 - node))
    return found


def usable(rows: DataFrame, vector: str) -> DataFrame:
    """Rows with a vector that is not null, not zero and finite throughout; -0.0 becomes 0.0."""
    kind = rows.schema[vector].dataType.elementType
    rows = rows.withColumn(vector, F.transform(F.col(vector), lambda x: x + F.lit(0).cast(kind)))
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(v.isNotNull() & finite & F.exists(v, lambda x: x != 0))


def entries(rows: DataFrame, most: int) -> DataFrame:
    """(key, vector, entry, ids): distinct vectors with their ``most`` smallest ids, ascending.

    The rank limit is applied in each task before the shuffle, so a vector that a third of all rows
    share sends ``most`` rows from each task. ``entry`` is the smallest id.
    """
    rank = F.dense_rank().over(Window.partitionBy("key", "vector").orderBy("id"))
    few = rows.withColumn("__rank", rank).filter(F.col("__rank") <= most)
    ids = F.sort_array(F.collect_set("id"))
    return few.groupBy("key", "vector").agg(ids.alias("ids")).withColumn("entry", F.get("ids", F.lit(0)))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, width)


def lifted(vectors: np.ndarray, longest: float) -> np.ndarray:
    """One more component, so that all have the length of the longest; in units of that length."""
    vectors = vectors / longest
    return np.concatenate([vectors, np.sqrt(np.maximum(0, 1 - (vectors**2).sum(1)))[:, None]], 1).astype(np.float32)


def best_of(query: np.ndarray, entry: np.ndarray, score: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``most`` best entries of each query, each entry once."""
    order = np.lexsort((-score, entry, query))
    first = np.concatenate(([True], (np.diff(query[order]) != 0) | (np.diff(entry[order]) != 0)))
    order = order[first]
    order = order[np.lexsort((entry[order], -score[order], query[order]))]
    starts = np.flatnonzero(np.concatenate(([True], np.diff(query[order]) != 0)))
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.concatenate((starts, [len(order)]))))
    order = order[rank < most]
    return query[order], entry[order], score[order]


def meet(stream: Iterator[pa.RecordBatch], width: int, most: int) -> Iterator[pa.RecordBatch]:
    """(query, entry, score) of a task's best, from rows sorted by leaf, block and kind (entries first)."""
    now, held, held_ids = None, [], []
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def reduced() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return best_of(*(np.concatenate(x) for x in zip(*found)), most)

    def sent(rows: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x) for x in rows], ["query", "entry", "score"])

    size = 0
    for batch in stream:
        leaf, block, kind, ids = (batch.column(i).to_numpy() for i in range(4))
        at = matrix(batch.column(4), width)
        edges = np.flatnonzero((leaf[1:] != leaf[:-1]) | (block[1:] != block[:-1]) | (kind[1:] != kind[:-1])) + 1
        for a, b in zip([0, *edges], [*edges, len(ids)]):
            if b == a:
                continue
            if now != (leaf[a], block[a]):
                now, held, held_ids = (leaf[a], block[a]), [], []
            if kind[a] == 0:
                held.append(at[a:b].astype(np.float64))
                held_ids.append(ids[a:b])
            elif held:
                have, have_ids = np.concatenate(held), np.concatenate(held_ids)
                held, held_ids = [have], [have_ids]
                for c in range(a, b, 512):
                    scores = at[c : min(b, c + 512)].astype(np.float64) @ have.T
                    n = min(most, len(have_ids))
                    best = np.argpartition(-scores, n - 1, axis=1)[:, :n]
                    found.append((np.repeat(ids[c : c + len(scores)], n), have_ids[best].ravel(), np.take_along_axis(scores, best, 1).ravel()))
                    size += found[-1][0].size
        if size > HELD:
            found = [reduced()]
            size = found[0][0].size
            if size > HELD // 2:  # many queries: send what there is rather than hold more
                yield sent(found[0])
                found, size = [], 0
    if found:
        yield sent(reduced())


def nearest(
    rows: DataFrame, wanted: str, id_col: str = "vec_id", vector: str = "embedding", top: int = TOP, trees: int = TREES, leaves: int = LEAVES, share: float = VISITED,
    sample: int = SAMPLE,
) -> DataFrame:
    """(query_id, rank, id, score): the ``top`` nearest found of every row for which ``wanted`` holds.

    Null ids, and vectors that are null, zero or not finite take no part. Rows of one id with one
    vector count once. Vectors must have one length. Ties go to the smaller id. A query with fewer
    other rows gets them all. Without usable rows, or without queries, the result is empty.
    """
    spark = rows.sparkSession
    key = F.xxhash64("vector")
    good = usable(rows.filter(F.col(id_col).isNotNull()), vector)
    plain = good.select(F.col(id_col).cast("long").alias("id"), F.col(vector).alias("vector")).withColumn("key", key)
    path = scratch(spark, "vectors")
    entries(plain, top + 1).write.parquet(path)
    known = spark.read.parquet(path)
    asking = good.filter(wanted).select(F.col(id_col).cast("long").alias("query_id"), F.col(vector).alias("vector")).distinct()
    path = scratch(spark, "queries")
    asking.withColumn("key", key).join(known.select("key", "vector", "entry"), ["key", "vector"]).select("query_id", "entry").write.parquet(path)
    asking = spark.read.parquet(path)

    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    count, width, narrowest, longest = known.agg(F.count(F.lit(1)), F.max(F.size("vector")), F.min(F.size("vector")), F.max(norm)).first()
    if not count:
        return spark.createDataFrame([], f"query_id long, rank int, {id_col} long, score double")
    if width != narrowest:
        raise ValueError(f"vectors of {narrowest} and of {width} components")
    place = F.pmod(F.xxhash64("entry"), F.lit(1 << 30))
    drawn = known.filter(place <= int((1 << 30) * min(1.0, sample / count))).select("entry", "vector").orderBy(F.xxhash64("entry"), "entry").limit(sample)
    base = spark.sparkContext.broadcast(lifted(matrix(drawn.select("vector").toArrow().column(0).combine_chunks(), width), longest))

    def grown(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for t in batch.column(0).to_pylist():
                tree = grow(base.value, SEED * 1000 + t)
                arrays = [pa.array([x.tobytes()], pa.binary()) for x in (tree.normals, tree.offsets, tree.children)]
                yield pa.RecordBatch.from_arrays([pa.array([t]), *arrays], ["tree", "normals", "offsets", "children"])

    # The forest's size depends on the sample and the number of trees, not on the table.
    forest = spark.range(trees, numPartitions=trees).mapInArrow(tidy(grown), "tree long, normals binary, offsets binary, children binary").collect()
    shared = spark.sparkContext.broadcast([(bytes(r.normals), bytes(r.offsets), bytes(r.children)) for r in sorted(forest)])

    def planted() -> list[Tree]:
        return [
            Tree(np.frombuffer(a, np.float32).reshape(-1, width + 1), np.frombuffer(b, np.float32), np.frombuffer(c, np.int64).reshape(-1, 2))
            for a, b, c in shared.value
        ]

    def placed(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = planted()
        for batch in stream:
            at = lifted(matrix(batch.column(1), width), longest)
            for t, tree in enumerate(forest):
                number = pa.array((t << 32) + tree.leaves(at))
                yield pa.RecordBatch.from_arrays([number, batch.column(0), batch.column(1)], ["leaf", "id", "vector"])

    def asked(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = planted()
        number = max(leaves, int(share * sum(len(tree.children) + 1 for tree in forest)))
        for batch in stream:
            at = lifted(matrix(batch.column(1), width), longest)
            at[:, -1] = 0
            seen = [[(t << 32) + leaf for t, leaf in visit(forest, v, number)] for v in at]
            row = pa.array(np.repeat(np.arange(len(seen)), [len(x) for x in seen]))
            reached = pa.array(np.concatenate(seen) if seen else [], pa.int64())
            yield pa.RecordBatch.from_arrays([reached, batch.column(0).take(row), batch.column(1).take(row)], ["leaf", "id", "vector"])

    kind = known.schema["vector"].dataType.simpleString()
    schema = f"leaf long, id long, vector {kind}"
    blocks = max(1, -(-count // max(1, (min(count, sample) // LEAF) * BLOCK // 2)))  # leaves hold equal shares of the entries
    index = known.select("entry", "vector").mapInArrow(tidy(placed), schema)
    index = index.select("leaf", F.pmod("id", F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("kind"), "id", "vector")
    queries = known.join(asking.select("entry").distinct(), "entry", "left_semi").select("entry", "vector").mapInArrow(tidy(asked), schema)
    queries = queries.select("leaf", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("kind"), "id", "vector")
    met = index.unionAll(queries).repartition("leaf", "block").sortWithinPartitions("leaf", "block", "kind", "id")
    most = top + SPARE
    pairs = met.mapInArrow(tidy(lambda stream: meet(stream, width, most)), "query long, entry long, score double")
    pairs = pairs.unionByName(asking.select(F.col("entry").alias("query"), "entry", F.lit(float("inf")).alias("score")))
    pairs = pairs.groupBy("query", "entry").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "entry")
    pairs = pairs.withColumn("__n", F.row_number().over(order)).filter(F.col("__n") <= most + 1)

    other = known.select(F.col("entry").alias("query"), F.col("vector").alias("__vector"))
    exact = pairs.select("query", "entry").join(known.select("entry", "vector", "ids"), "entry").join(other, "query")
    product = F.aggregate(F.zip_with("vector", "__vector", lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda a, x: a + x)
    exact = exact.withColumn("__score", product).select("query", F.transform("ids", lambda i: F.struct((-F.col("__score")).alias("down"), i.alias("id"))).alias("found"))
    lists = exact.groupBy("query").agg(F.slice(F.sort_array(F.flatten(F.collect_list("found"))), 1, top + 1).alias("found"))
    answers = asking.join(lists, asking.entry == lists.query)
    others = F.filter("found", lambda x: x["id"] != F.col("query_id"))
    answers = answers.select("query_id", F.posexplode(F.slice(others, 1, top)).alias("__at", "__hit"))
    return answers.select("query_id", (F.col("__at") + 1).alias("rank"), F.col("__hit.id").alias(id_col), (-F.col("__hit.down")).alias("score"))


@query("op3_neighbours")
def op3_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(table(spark, folder, "embeddings"), "vec_id % 20 = 0")
