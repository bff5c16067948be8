"""Approximate nearest neighbours: a hierarchical k-means tree searched best bin first."""

from __future__ import annotations

import heapq
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from danji.llm.common import cut, ship

#: Vectors the tree is fitted on, and queries its search is calibrated on, at most.
FITTED = 20_000
CALIBRATED = 200
#: Children of a node; vectors a leaf shall hold; vectors of a leaf a task compares at once.
BRANCHES = 8
LEAF = 200
BLOCK = 4096
QUERY_BLOCK = 2048


@dataclass
class Tree:
    """centers[i] is the centre of node i; children[i] its nodes, none of a leaf."""

    centers: np.ndarray
    children: list[list[int]]

    def leaves_of(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf each unit vector falls into, going to the nearest child from the root on."""
        out = np.zeros(len(vectors), np.int64)
        work = [(0, np.arange(len(vectors)))]
        while work:
            node, rows = work.pop()
            below = self.children[node]
            if not below or not len(rows):
                out[rows] = node
                continue
            nearest = (vectors[rows] @ self.centers[below].T).argmax(1)
            work += [(child, rows[nearest == i]) for i, child in enumerate(below)]
        return out

    def leaf_order(self) -> list[int]:
        """All leaves from left to right, so that neighbours stand side by side."""
        out, work = [], [0]
        while work:
            node = work.pop()
            work += reversed(self.children[node])
            if not self.children[node]:
                out.append(node)
        return out

    def nearest_leaves(self, vector: np.ndarray, visits: int) -> list[int]:
        """The first `visits` leaves in best-bin-first order: the closest open node is opened next."""
        closeness = self.centers @ vector
        queue, found = [(-closeness[0], 0)], []
        while queue and len(found) < visits:
            _, node = heapq.heappop(queue)
            if self.children[node]:
                for child in self.children[node]:
                    heapq.heappush(queue, (-closeness[child], child))
            else:
                found.append(node)
        return found


def fit(sample: np.ndarray, leaves: int) -> Tree:
    """A tree over unit vectors with about `leaves` leaves, by spherical k-means in each node."""
    random = np.random.default_rng(7)
    least = max(8, len(sample) // max(1, leaves))
    centers, children = [sample.mean(0) if len(sample) else np.zeros(0)], [[]]
    work = [(0, sample)]
    while work:
        node, rows = work.pop()
        if len(rows) <= least * 1.5:
            continue
        k = int(min(BRANCHES, max(2, round(len(rows) / least))))
        means = rows[random.choice(len(rows), k, replace=False)]
        for _ in range(8):
            near = (rows @ means.T).argmax(1)
            sums = np.stack([rows[near == i].sum(0) for i in range(k)])
            size = np.linalg.norm(sums, axis=1, keepdims=True)
            means = np.where(size > 0, sums / np.where(size > 0, size, 1), means)
        near = (rows @ means.T).argmax(1)
        groups = [rows[near == i] for i in range(k)]
        if sum(len(g) > 0 for g in groups) < 2:
            continue
        for group, mean in zip(groups, means):
            if len(group):
                children[node].append(len(centers))
                centers.append(mean)
                children.append([])
                work.append((len(centers) - 1, group))
    return Tree(np.asarray(centers), children)


def _usable(vector: Column) -> Column:
    """Whether a vector takes part: no null or non-finite component, not all zeros."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    if not len(column):
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    largest = np.abs(x).max(1, keepdims=True, initial=0)
    x = x / np.where(largest > 0, largest, 1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows times powers of two, which changes no cosine: largest components from 1/2 to 1, so squares stay finite."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True, initial=0))[1])


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision: the same for equal rows wherever they stand."""
    a, b = _scaled(a), _scaled(b)
    return (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))


def _best(queries, vectors, ids, skip, k: int, visited=None):
    """(query row, vector row, score) of each query's k best, of those it visits."""
    close = _unit(queries) @ _unit(vectors).T
    if visited is not None:
        close[~visited] = -np.inf
    close[skip[:, None] == ids[None, :]] = -np.inf
    take = min(k, len(ids))
    last = np.partition(close, -take, axis=1)[:, -take]
    q, v = np.nonzero((close >= last[:, None] - 1e-9) & np.isfinite(close))
    score = cosine(queries[q], vectors[v])
    order = np.lexsort((ids[v], -score, q))
    q, v, score = q[order], v[order], score[order]
    first = np.searchsorted(q, np.arange(len(queries)))
    kept = np.arange(len(q)) - first[q] < k
    return q[kept], v[kept], score[kept]


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 5, recall: float = 0.97, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """The k nearest rows of each query by cosine: query_id, rank, vec_id, score.

    The tree is fitted on at most FITTED vectors (the first by the hash of their ids); its leaves grow
    with the rows, up to one for every 8 of the fitted. Every row is indexed. Of rows with equal vectors
    the k + 1 of the smallest ids are compared, the others could not be among the nearest k. How
    many leaves a query visits, best bin first, is calibrated: for at most CALIBRATED of the rows
    the true neighbours among all rows are found by comparing in blocks, and visits are widened
    until the leaves visited hold `recall` of them; if no number below all does, all are visited.

    Leaves that lie side by side share a bin of about BLOCK rows, in which a query is compared with
    those it visits; a larger leaf is a bin of several blocks, and queries come in blocks too. So no
    task holds a whole hot leaf, and a block gives at most k rows a query. Vectors that are null, zero, or
    hold null or non-finite components take no part, and null ids. Vectors of different lengths have no
    cosine: each length is a search of its own. Rows that repeat an id and vector count once. Ties go
    to the smaller id. Components of any finite magnitude are compared. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    ship(spark)
    usable = vectors.where(_usable(F.col(vector_col)) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"), is_query.alias("is_query")
    ).distinct()
    rows = cut(usable)
    lengths = rows.where("is_query").select(F.size("v").alias("length")).distinct().orderBy("length").collect()
    if not lengths:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    found = [_nearest(rows.where(F.size("v") == r["length"]), k, recall) for r in lengths]
    return reduce(DataFrame.unionAll, found)


def _nearest(rows: DataFrame, k: int, recall: float) -> DataFrame:
    """See nearest; rows: distinct (vec_id, v, is_query) of vectors of one length."""
    spark = rows.sparkSession
    context = spark.sparkContext
    compared = cut(
        rows.selectExpr("vec_id", "v", "row_number() over (partition by v order by vec_id) as copy").where(f"copy <= {k + 1}").drop("copy")
    )
    order = [F.xxhash64("vec_id"), F.col("vec_id")]
    sample = _unit(np.array([r["v"] for r in compared.orderBy(*order).limit(FITTED).select("v").collect()]))
    count = compared.count()
    tree = fit(sample, min(-(-count // LEAF), max(1, len(sample) // 8)))
    tests = compared.orderBy(*order).limit(CALIBRATED).collect()
    shared = context.broadcast((tree, np.array([r["v"] for r in tests]), np.array([r["vec_id"] for r in tests])))

    def index(batches):
        tree = shared.value[0]
        for batch in batches:
            found = tree.leaves_of(_unit(_matrix(batch.column(1)))) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int64())], ["vec_id", "v", "leaf"])

    indexed = cut(compared.mapInArrow(index, "vec_id bigint, v array<double>, leaf bigint"))

    def truth(batches):
        _, queries, ids = shared.value
        best = [np.zeros((0,)), np.zeros((0,), np.int64), np.zeros((0,), np.int64), np.zeros((0,), np.int64)]
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                mine, leaf = (part.column(i).to_numpy() for i in (0, 2))
                q, v, score = _best(queries, _matrix(part.column(1)), mine, ids, k)
                best = [np.concatenate(x) for x in zip(best, (score, q, mine[v], leaf[v]))]
                order = np.lexsort((best[2], -best[0], best[1]))
                best = [x[order] for x in best]
                kept = np.arange(len(best[1])) - np.searchsorted(best[1], best[1]) < k
                best = [x[kept] for x in best]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in best], ["score", "q", "vec_id", "leaf"])

    true = indexed.mapInArrow(truth, "score double, q bigint, vec_id bigint, leaf bigint").selectExpr(
        "*", "row_number() over (partition by q order by score desc, vec_id) as rank"
    ).where(f"rank <= {k}").select("q", "leaf").collect()
    place = [{leaf: i for i, leaf in enumerate(tree.nearest_leaves(u, len(tree.centers)))} for u in _unit(shared.value[1])]
    needed = np.sort([place[r["q"]][r["leaf"]] + 1 for r in true]) if true else np.array([1])
    visits = int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))])

    # At most one leaf for every 8 vectors the tree was fitted on, so they are few.
    sizes = {r["leaf"]: r["n"] for r in indexed.groupBy("leaf").agg(F.count("*").alias("n")).collect()}
    bin_of, blocks_of, held = {}, [], BLOCK
    for leaf in tree.leaf_order():
        n = sizes.get(leaf, 0)
        if held + n > BLOCK:
            blocks_of.append(max(1, -(-n // BLOCK)))
            held = 0
        bin_of[leaf] = len(blocks_of) - 1
        held += n
    bins = context.broadcast(bin_of)
    leaves = spark.createDataFrame(
        [(leaf, b, blocks_of[b]) for leaf, b in bin_of.items()], "leaf bigint, bin int, blocks int"
    )
    queries = rows.where("is_query").select("vec_id", "v")

    def visit(batches):
        tree, bin_of = shared.value[0], bins.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                row, bin_, visited = [], [], []
                for i, u in enumerate(_unit(_matrix(part.column(1)))):
                    by_bin: dict[int, list[int]] = {}
                    for leaf in tree.nearest_leaves(u, visits):
                        by_bin.setdefault(bin_of[leaf], []).append(leaf)
                    row += [i] * len(by_bin)
                    bin_ += by_bin.keys()
                    visited += by_bin.values()
                yield pa.RecordBatch.from_arrays(
                    [*part.take(pa.array(row, pa.int64())).columns, pa.array(bin_, pa.int32()), pa.array(visited, pa.list_(pa.int64()))],
                    ["query_id", "q", "bin", "visited"],
                )

    asked = cut(queries.mapInArrow(visit, "query_id bigint, q array<double>, bin int, visited array<bigint>"))
    blocks = F.broadcast(leaves.select("bin", "blocks").distinct())
    query_blocks = asked.groupBy("bin").agg(F.expr(f"int(ceil(count(*) / {QUERY_BLOCK}))").alias("query_blocks"))
    grid = cut(query_blocks.join(blocks, "bin"))
    there = indexed.join(F.broadcast(leaves.select("leaf", "bin")), "leaf").join(grid, "bin").select(
        "bin", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)).alias("part"), "vec_id", "v", "leaf",
    )
    asking = asked.join(grid, "bin").select(
        "bin", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks").cast("bigint") - 1)).alias("block"),
        F.pmod(F.xxhash64("query_id"), F.col("query_blocks")).cast("int").alias("part"), "query_id", "q", "visited",
    )

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names)
        ids, asked_ids = left["vec_id"].to_numpy(), right["query_id"].to_numpy()
        here, leaf = np.unique(left["leaf"].to_numpy(), return_inverse=True)
        visits = right["visited"].combine_chunks()
        query = np.repeat(np.arange(len(visits)), np.diff(visits.offsets.to_numpy()))
        wanted = visits.flatten().to_numpy()
        at = np.minimum(np.searchsorted(here, wanted), len(here) - 1)
        open_ = np.zeros((len(visits), len(here)), bool)
        open_[query[here[at] == wanted], at[here[at] == wanted]] = True
        q, v, score = _best(
            _matrix(right["q"].combine_chunks()), _matrix(left["v"].combine_chunks()), ids, asked_ids, k, open_[:, leaf]
        )
        return pa.table([pa.array(asked_ids[q]), pa.array(ids[v]), pa.array(score)], names)

    key = ["bin", "block", "part"]
    found = there.groupBy(*key).cogroup(asking.groupBy(*key)).applyInArrow(compare, "query_id bigint, vec_id bigint, score double")
    return found.selectExpr(
        "query_id", "cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank", "vec_id", "score"
    ).where(f"rank <= {k}")
