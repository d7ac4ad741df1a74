"""Approximate nearest neighbours by low-dimensional stable projections.

Vectors are brought to length one, so that the largest cosine is the smallest
Euclidean distance, and projected on ``DIMENSIONS`` Gaussian directions. For two
vectors at distance d the squared projected distance is d**2 times a chi-square
variable of that many degrees of freedom. The projections are indexed by a
kd-tree, whose splits come from a bounded sample (``SAMPLE_ROWS`` rows) while
every row is put into its leaf; large leaves are kept in chunks, so neither one
leaf nor a crowd of equal vectors meets in one task.

Search takes two rounds. First each query looks into the leaf it falls into and
so gets k candidates and a distance d_k. Then it visits the other leaves whose
boxes are near enough, and in each one takes the rows in the order of their
projected distance r, verifying the original vectors batch by batch, until the
stopping test holds: chi-square CDF of r**2 / d_k**2 >= ``CONFIDENCE``. d_k only
shrinks on the way. A neighbour nearer than the final d_k is then missed with a
probability of 1 - ``CONFIDENCE`` at most.

Queries are dealt into blocks and meet the index chunk by chunk, so memory is
bounded by a chunk and a block; nothing is collected but the sample and one count
per leaf (at most ``2**MAX_TREE_DEPTH``).

Defined results: rows with a null id, and vectors that are null, empty, zero, or
hold null or non-finite components take no part. Vectors of different lengths
are no candidates for each other. A row with the query's id is not a candidate.
Ties in the score go to the smaller id; repeated rows are rows of their own, as
queries and as candidates of others.
Other columns do not take part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from basketseq.llm.scratch import Scratch

DIMENSIONS = 8
CONFIDENCE = 0.96
SAMPLE_ROWS = 16_384
LEAF_ROWS = 2_048
MAX_TREE_DEPTH = 12
QUERY_BLOCK = 2_048
BATCH = 512
SEED = 7

POINT = "row long, id long, dim int, vector binary, projection binary"
FOUND = "row long, query_id long, id long, score double"


def chi_square_cdf(x: float, degrees: int = DIMENSIONS) -> float:
    """For an even number of degrees of freedom."""
    terms = (x / 2) ** np.arange(degrees // 2) / [math.factorial(i) for i in range(degrees // 2)]
    return 1 - math.exp(-x / 2) * float(terms.sum())


def chi_square_quantile(p: float, degrees: int = DIMENSIONS) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_cdf(middle, degrees) < p else (low, middle)
    return high


def directions(dim: int) -> np.ndarray:
    """The Gaussian (2-stable) directions for vectors of that length."""
    return np.random.default_rng([SEED, dim]).standard_normal((dim, DIMENSIONS))


def _rows(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype="<f8").reshape(len(column), -1)


def projected(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """The rows that take part: vector and projection of its unit vector, as bytes."""

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[int, np.ndarray] = {}
        for batch in batches:
            rows = []
            for row, key, values in zip(batch["row"], batch["id"], batch["vector"], strict=True):
                vector = np.asarray(values, dtype=np.float64)
                with np.errstate(over="ignore", invalid="ignore"):
                    length = np.sqrt((vector * vector).sum())
                if not len(vector) or not np.isfinite(length) or length == 0:
                    continue
                if len(vector) not in known:
                    known[len(vector)] = directions(len(vector))
                projection = (vector / length) @ known[len(vector)]
                rows.append((row, key, len(vector), vector.tobytes(), projection.tobytes()))
            yield pd.DataFrame(rows, columns=["row", "id", "dim", "vector", "projection"])

    taking_part = vectors.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector")
    ).where("id is not null and vector is not null")
    return taking_part.mapInPandas(project, POINT)


class Tree:
    """Splits of a kd-tree in heap order, and the box of each leaf."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.depth = depth
        self.axis = np.zeros((1 << depth) - 1, dtype=np.int64)
        self.value = np.zeros((1 << depth) - 1)
        parts = {0: sample}
        low = {0: np.full(DIMENSIONS, -np.inf)}
        high = {0: np.full(DIMENSIONS, np.inf)}
        for node in range((1 << depth) - 1):
            part = parts.pop(node)
            spread = np.ptp(part, axis=0) if len(part) else np.zeros(DIMENSIONS)
            axis = int(np.argmax(spread))
            value = float(np.median(part[:, axis])) if len(part) else 0.0
            self.axis[node], self.value[node] = axis, value
            below = part[:, axis] < value
            for child, rows, is_low in (
                (2 * node + 1, part[below], True),
                (2 * node + 2, part[~below], False),
            ):
                parts[child] = rows
                low[child], high[child] = low[node].copy(), high[node].copy()
                (high if is_low else low)[child][axis] = value
        first = (1 << depth) - 1
        self.low = np.array([low[first + i] for i in range(1 << depth)])
        self.high = np.array([high[first + i] for i in range(1 << depth)])

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), dtype=np.int64)
        for _ in range(self.depth):
            above = points[np.arange(len(points)), self.axis[node]] >= self.value[node]
            node = 2 * node + 1 + above
        return node - ((1 << self.depth) - 1)

    def box_distances(self, point: np.ndarray) -> np.ndarray:
        """Squared distance of each leaf's box."""
        gap = np.maximum(0, np.maximum(self.low - point, point - self.high))
        return (gap * gap).sum(axis=1)


def _indexed(points: DataFrame, tree: Tree) -> DataFrame:
    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch.assign(leaf=tree.leaf_of(_rows(batch["projection"])))

    return points.mapInPandas(place, f"{POINT}, leaf int")


def _visits(
    queries: DataFrame, tree: Tree, chunks: list[int], first_round: bool, limit: float
) -> DataFrame:
    """A row per query and leaf chunk it has to look into."""
    amount = np.array(chunks)

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            points = _rows(batch["projection"])
            own = tree.leaf_of(points)
            places, leaves = [], []
            for i, point in enumerate(points):
                if first_round:
                    near = own[i : i + 1]
                else:
                    near = np.flatnonzero(
                        tree.box_distances(point) <= batch["bound"].iat[i] * limit
                    )
                    near = near[near != own[i]]
                places.append(np.full(len(near), i))
                leaves.append(near)
            place, leaf = np.concatenate(places), np.concatenate(leaves)
            times = amount[leaf]
            out = batch.iloc[np.repeat(place, times)].reset_index(drop=True)
            starts = np.cumsum(times) - times
            chunk = np.arange(len(out)) - np.repeat(starts, times)
            yield out.assign(leaf=np.repeat(leaf, times), chunk=chunk)

    return queries.mapInPandas(
        visit, f"{POINT}, bound double, block int, leaf int, chunk int"
    )


def _search(k: int, limit: float):
    def search(points: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = []
        for dim in queries["dim"].unique() if len(points) else ():
            near, own = points[points["dim"] == dim], queries[queries["dim"] == dim]
            if len(near):
                _search_chunk(near, own, k, limit, found)
        if not found:
            return pd.DataFrame({"row": [], "query_id": [], "id": [], "score": []}).astype(
                {"row": "int64", "query_id": "int64", "id": "int64"}
            )
        return pd.concat(found)

    return search


def _search_chunk(near, own, k: int, limit: float, found: list) -> None:
    ids, vectors, places = near["id"].to_numpy(), _rows(near["vector"]), _rows(near["projection"])
    lengths = np.sqrt((vectors * vectors).sum(axis=1))
    units = vectors / lengths[:, None]
    for row, key, raw, projection, bound in zip(
        own["row"], own["id"], own["vector"], own["projection"], own["bound"], strict=True
    ):
        query = np.frombuffer(raw, dtype="<f8")
        length = np.sqrt((query * query).sum())
        gap = places - np.frombuffer(projection, dtype="<f8")
        away = (gap * gap).sum(axis=1)
        reach = np.flatnonzero((away <= bound * limit) & (ids != key))
        order = reach[np.argsort(away[reach], kind="stable")]
        best = np.zeros(0)
        seen = 0
        rough = np.zeros(0)
        while seen < len(order):
            # The stopping test: the next projected neighbour is already too far.
            if away[order[seen]] > bound * limit:
                break
            batch = order[seen : seen + BATCH]
            seen += len(batch)
            rough = np.concatenate((rough, units[batch] @ (query / length)))
            best = np.sort(np.concatenate((best, rough[-len(batch) :])))[-k:]
            if len(best) == k:
                bound = min(bound, max(0.0, 2 - 2 * best[0]) + 1e-9)
        if not seen:
            continue
        least = best[0] if len(best) == k else -2.0
        short = order[:seen][rough >= least - 1e-9]
        # In one fixed order of summation, so that equal vectors score equally.
        score = (vectors[short] * query).sum(axis=1) / (lengths[short] * length)
        top = np.lexsort((ids[short], -score))[:k]
        found.append(
            pd.DataFrame(
                {"row": row, "query_id": key, "id": ids[short][top], "score": score[top]}
            )
        )


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("row").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    confidence: float = CONFIDENCE,
) -> DataFrame:
    """(query_id, rank, <id_col>, score): the ``k`` rows of largest cosine found for
    each row that ``is_query`` (an expression over ``id``) selects."""
    scratch = Scratch(vectors.sparkSession, "neighbours")
    limit = chi_square_quantile(confidence)
    points, points_path = scratch.write(projected(vectors, id_col, vector_col), "points")
    total = points.count()
    sample = points.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).select("projection")
    drawn = [bytes(row[0]) for row in sample.collect()]
    flat = np.frombuffer(b"".join(drawn), dtype="<f8").reshape(-1, DIMENSIONS)
    wanted = math.ceil(math.log2(max(1, total / LEAF_ROWS)))
    useful = max(0, int(math.log2(max(1, len(drawn) / 4))))
    tree = Tree(flat, min(wanted, useful, MAX_TREE_DEPTH))
    placed, _ = scratch.write(_indexed(points, tree), "leaves")
    scratch.drop(points_path)
    counts = {r["leaf"]: r["count"] for r in placed.groupBy("leaf").count().collect()}
    chunks = [max(1, -(-counts.get(leaf, 0) // LEAF_ROWS)) for leaf in range(1 << tree.depth)]
    per_leaf = F.element_at(F.array(*(F.lit(c) for c in chunks)), F.col("leaf") + 1)
    index = placed.withColumn("chunk", F.pmod(F.xxhash64("id"), per_leaf).cast("int"))

    asked = placed.where(is_query)
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    queries = asked.select(
        "row",
        "id",
        "dim",
        "vector",
        "projection",
        F.lit(float("inf")).alias("bound"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int").alias("block"),
    )

    def round_of(visits: DataFrame, label: str) -> DataFrame:
        visits, path = scratch.write(visits, f"{label}-visits")
        # Read apart: the cogroup below would take the columns for one another.
        again = scratch.spark.read.schema(visits.schema).parquet(path)
        keys = again.select("leaf", "chunk", "block").distinct()
        met = index.join(keys, ["leaf", "chunk"])
        key = ["leaf", "chunk", "block"]
        out = met.groupBy(*key).cogroup(visits.groupBy(*key)).applyInPandas(
            _search(k, limit), FOUND
        )
        return scratch.write(out, label)[0]

    first = round_of(_visits(queries, tree, chunks, True, limit), "first")
    bounds = (
        _top(first, k)
        .groupBy("row")
        .agg(F.min("score").alias("least"), F.count("*").alias("n"))
        .where(F.col("n") == k)
        .select(
            "row",
            (F.greatest(F.lit(0.0), 2 - 2 * F.col("least")) + 1e-9).alias("known"),
        )
    )
    again = queries.join(bounds, "row", "left").select(
        "row", "id", "dim", "vector", "projection", F.coalesce("known", "bound").alias("bound"), "block"
    )
    second = round_of(_visits(again, tree, chunks, False, limit), "second")
    return _top(first.unionByName(second), k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score"
    )
