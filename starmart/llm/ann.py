"""Approximate nearest neighbours (inner product) over a hierarchical k-means tree.

The tree is fitted on at most ``MAX_FIT_ROWS`` vectors (the smallest seeded digests of their
ids), so its size is fixed; every row is then put into the leaf whose centroid path is nearest. A
query walks the tree best bin first: a priority queue holds unexplored branches by
their upper bound ``q . centre + |q| * radius``, and leaves come out in order of promise.
How many leaves are visited is calibrated: for up to ``CALIBRATE`` query rows the exact neighbours
among all rows are found by brute force, block by block, and visits widen leaf by
leaf until the mean recall reaches the target. A query whose leaves hold fewer than k rows besides those
of its own id goes on until they do.

Leaves are searched as blocks of (queries x rows). A leaf with many rows or queries is
dealt over several blocks, so a vector that a third of all rows share stays bounded; every block
returns each query's best k and a last step keeps the best k of all.

Defined cases: vectors that are null, empty, zero, of another length than most of the sample (they have no inner product
with it) or hold null or non-finite components take no part, nor do rows without id; ties go to the smaller id; a
product that overflows is infinite, one that is no number comes last; rows equal in id are candidates of their
own, but never a neighbour of a query with that id; copies of a query row ask once, and where rows with one id hold
different vectors a candidate counts with its best score;
an empty table gives an empty result; fewer candidates than k give them all.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.session import materialise

MAX_FIT_ROWS = 16384
BRANCH = 8
LEAF = 96            # sample vectors below which a node is not split
CALIBRATE = 64
WIDEST = 1e100       # components beyond it count as this in the tree (scores are of the vectors themselves)
BLOCK = 4096         # rows, and queries, of one block
OUT = "query long, query_id long, row long, vec_id long, score double"


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.float64).reshape(len(column), -1)


class Tree:
    """Nodes in arrays: centre, radius, children (empty at a leaf, which has a number)."""

    def __init__(self, sample: np.ndarray, seed: int = 17):
        self.centre: list[np.ndarray] = []
        self.radius: list[float] = []
        self.children: list[list[int]] = []
        self.leaf: list[int] = []
        self.leaves = 0
        self._grow(sample, np.random.default_rng(seed))

    def _grow(self, x: np.ndarray, rng: np.random.Generator) -> int:
        x = np.clip(x, -WIDEST, WIDEST)
        node = len(self.centre)
        c = x.mean(axis=0)
        self.centre.append(c)
        self.radius.append(float(np.quantile(np.linalg.norm(x - c, axis=1), 0.9)))
        self.children.append([])
        self.leaf.append(-1)
        parts = self._split(x, rng) if len(x) > LEAF else []
        if len(parts) < 2:
            self.leaf[node] = self.leaves
            self.leaves += 1
        else:
            self.children[node] = [self._grow(p, rng) for p in parts]
        return node

    @staticmethod
    def _split(x: np.ndarray, rng: np.random.Generator) -> list[np.ndarray]:
        c = x[rng.choice(len(x), BRANCH, replace=False)]
        for _ in range(12):
            near = ((c * c).sum(axis=1) - 2 * x @ c.T).argmin(axis=1)
            c = np.array([x[near == k].mean(axis=0) if (near == k).any() else c[k] for k in range(len(c))])
        return [x[near == k] for k in range(len(c)) if (near == k).any()]

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every row."""
        x = np.clip(x, -WIDEST, WIDEST)
        out = np.empty(len(x), np.int32)
        work = [(0, np.arange(len(x)))]
        while work:
            node, rows = work.pop()
            below = self.children[node]
            if not below:
                out[rows] = self.leaf[node]
                continue
            c = np.array([self.centre[k] for k in below])
            near = ((c * c).sum(axis=1) - 2 * x[rows] @ c.T).argmin(axis=1)
            work += [(k, rows[near == n]) for n, k in enumerate(below) if (near == n).any()]
        return out

    def visit(self, q: np.ndarray, most: int, rows: np.ndarray | None = None, need: int = 0) -> list[int]:
        """The first ``most`` leaves of a best-bin-first walk, more until their ``rows`` reach ``need``."""
        q = np.clip(q, -WIDEST, WIDEST)
        length = float(np.linalg.norm(q))
        heap, out, held = [(0.0, 0)], [], 0
        while heap and (len(out) < most or held < need):
            _, node = heapq.heappop(heap)
            if self.leaf[node] >= 0:
                out.append(self.leaf[node])
                held += 0 if rows is None else int(rows[self.leaf[node]])
            for k in self.children[node]:
                heapq.heappush(heap, (-(float(q @ self.centre[k]) + 0.5 * length * self.radius[k]), k))
        return out


SLACK = 1e-9         # of |q||x|: what rounding may move a product of matrices by


def _score(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of rows, added in the order of the components, so equal vectors score alike in every block."""
    out = np.zeros(len(q))
    for k in range(q.shape[1]):
        out += q[:, k] * x[:, k]
    return out


def _best(query: np.ndarray, q_ids: np.ndarray, q: np.ndarray, row: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> pd.DataFrame:
    """Each query's best k of a block of rows; a row with the query's id is none of its neighbours. Scores that overflow count
    as infinite, those that are no number as the least."""
    own = q_ids[:, None] == ids[None, :]
    with np.errstate(over="ignore", invalid="ignore"):
        rough = q @ x.T
        slack = SLACK * np.linalg.norm(q, axis=1)[:, None] * np.linalg.norm(x, axis=1)[None, :]
        may = ~own
        if len(ids) > k:
            least = rough - slack
            least[own | np.isnan(least)] = -np.inf
            edge = -np.partition(-least, k - 1, axis=1)[:, k - 1:k]
            may &= ~(rough + slack < edge)         # what may reach the k-th best, and all whose bounds overflow
        rows, cols = np.nonzero(may)
        score = _score(q[rows], x[cols])
    score[np.isnan(score)] = -np.inf
    out = pd.DataFrame({"query": query[rows], "query_id": q_ids[rows], "row": row[cols], "vec_id": ids[cols], "score": score})
    out = out.sort_values(["query", "score", "vec_id", "row"], ascending=[True, False, True, True])
    return out[out.groupby("query").cumcount() < k]


def _keep(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each query id. Where rows with one id hold several vectors, a candidate counts with its best score;
    it is then among the k best of that vector, so all others go before they are compared."""
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id", "row")
    found = found.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= k)
    found = found.groupBy("query_id", "row", "vec_id").agg(F.max("score").alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def valid(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, v) of the rows that take part."""
    v = F.transform(F.col(column), lambda x: x.cast("double"))
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = (vectors.where(F.col("vec_id").isNotNull() & F.col(column).isNotNull())
            .select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"), good.alias("_good")))
    return rows.where(F.col("_good") & F.exists("v", lambda x: x != 0)).select("vec_id", "v")


def search(vectors: DataFrame, every: int = 20, k: int = 20, target: float = 0.97, column: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score of the queries ``vec_id % every = 0`` against all rows."""
    spark = vectors.sparkSession
    rows = valid(vectors, column)
    mark = F.md5(F.concat(F.lit("ann"), F.col("vec_id").cast("string")))
    sample = rows.orderBy(mark, "vec_id").limit(MAX_FIT_ROWS).toPandas()
    if not len(sample):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim = int(sample["v"].map(len).mode()[0])
    rows = rows.where(F.size("v") == dim)
    tree = Tree(_matrix(sample[sample["v"].map(len) == dim]["v"]))
    shared = spark.sparkContext.broadcast(tree)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(leaf=shared.value.assign(_matrix(b["v"])) if len(b) else [])

    placed = materialise(rows.mapInPandas(place, "vec_id long, v array<double>, leaf int")
                         .withColumn("row", F.monotonically_increasing_id()), "ann-placed")
    # copies of a query row ask once
    queries = placed.where(F.pmod("vec_id", F.lit(every)) == 0).groupBy(F.col("vec_id").alias("query_id"), "v").agg(F.min("row").alias("query"))
    queries = materialise(queries, "ann-queries")

    probe = queries.orderBy(F.md5(F.concat(F.lit("probe"), F.col("query_id").cast("string"))), "query_id", "v").limit(CALIBRATE).toPandas()
    most = calibrate(placed, probe, tree, k, target)

    held = {r["leaf"]: r["count"] for r in placed.groupBy("leaf").count().collect()}       # a row per leaf
    counts = spark.sparkContext.broadcast(np.array([held.get(leaf, 0) for leaf in range(tree.leaves)]))

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i, v, own in zip(b["query"], b["v"], b["own"], strict=True):
                leaves = shared.value.visit(np.asarray(v), most, counts.value, k + own)
                yield pd.DataFrame({"query": i, "leaf": np.array(leaves, np.int32)})

    own = placed.where(F.pmod("vec_id", F.lit(every)) == 0).groupBy(F.col("vec_id").alias("query_id")).agg(F.count("*").alias("own"))
    visits = queries.join(own.hint("merge"), "query_id").mapInPandas(walk, "query long, leaf int")
    n = {leaf: -(-count // BLOCK) for leaf, count in held.items()}
    visits = materialise(visits, "ann-visits")
    m = {r["leaf"]: -(-r["count"] // BLOCK) for r in visits.groupBy("leaf").count().collect()}
    parts = spark.createDataFrame([(leaf, n.get(leaf, 0), m.get(leaf, 0)) for leaf in range(tree.leaves)],
                                  "_leaf int, _n int, _m int").where((F.col("_n") > 0) & (F.col("_m") > 0))
    parts = F.broadcast(parts)       # one row per leaf, at most MAX_FIT_ROWS
    data = (placed.join(parts, placed["leaf"] == parts["_leaf"])
            .select("leaf", F.pmod(F.xxhash64("row"), F.col("_n")).alias("i"),
                    F.explode(F.sequence(F.lit(0).cast("long"), F.col("_m").cast("long") - 1)).alias("j"), "row", "vec_id", "v"))
    asked = visits.join(queries.withColumnRenamed("v", "qv"), "query")
    asked = (asked.join(parts, asked["leaf"] == parts["_leaf"])
             .select("leaf", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n").cast("long") - 1)).alias("i"),
                     F.pmod(F.xxhash64("query"), F.col("_m")).alias("j"), "query", "query_id", "qv"))

    def block(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query": [], "query_id": [], "row": [], "vec_id": [], "score": []})
        x, ids, row = _matrix(right["v"]), right["vec_id"].to_numpy(), right["row"].to_numpy()
        q, q_ids, query = _matrix(left["qv"]), left["query_id"].to_numpy(), left["query"].to_numpy()
        return pd.concat([_best(query[a:a + 256], q_ids[a:a + 256], q[a:a + 256], row, ids, x, k) for a in range(0, len(q), 256)])

    found = asked.groupBy("leaf", "i", "j").cogroup(data.groupBy("leaf", "i", "j")).applyInPandas(block, OUT)
    return _keep(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def calibrate(placed: DataFrame, probe: pd.DataFrame, tree: Tree, k: int, target: float) -> int:
    """Leaf visits at which the probe's mean recall against brute force reaches ``target``."""
    if not len(probe):
        return 1
    query, q_ids, q = probe["query"].to_numpy(), probe["query_id"].to_numpy(), _matrix(probe["v"])

    def exact(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                got = _best(query, q_ids, q, b["row"].to_numpy(), b["vec_id"].to_numpy(), _matrix(b["v"]), k)
                yield got.assign(leaf=b.set_index("row")["leaf"].loc[got["row"]].to_numpy())

    w = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id", "row")
    best = placed.mapInPandas(exact, OUT + ", leaf int").withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).toPandas()
    place = {int(i): {leaf: n for n, leaf in enumerate(tree.visit(v, tree.leaves))} for i, v in zip(query, q, strict=True)}
    needed = np.sort([place[int(i)][leaf] + 1 for i, leaf in zip(best["query"], best["leaf"], strict=True)])
    return int(needed[int(np.ceil(target * len(needed))) - 1]) if len(needed) else 1
