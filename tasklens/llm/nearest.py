"""Approximate nearest neighbours by adaptive dimension scans of inverted lists (dealt operator 10).

Vectors are turned by one random rotation, so that any first dimensions hold a fair share of every distance, and dealt
into the lists of their nearest centroids. A list is stored as blocks of columns: all vectors' first dimensions, then the
next. A query scans the blocks of its nearest lists; after each block it drops the vectors whose partial distance is, by a
hypothesis test, too large for the whole one to come under the tenth best so far. What is left is measured exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as Win
from pyspark.sql import functions as F

from tasklens.llm.storage import stored

# Vectors that centroids are fitted on, those with the smallest hash of their id.
SAMPLE = 20_000
LIST_ROWS = 400
MAX_LISTS = 4_096
# Lists that a query probes at least; more, until so large a share of the nearest vectors of some queries is found.
PROBES = 48
RECALL = 0.99
TRIED = 128
# Rows of a list that one task scans.
PART_ROWS = 4_000
COLUMNS = 16
# Width of the test: a larger one abandons later and errs less.
EPSILON = 2.4
ROUNDS = 8


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id, v`` of the rows that take part: an id, and a vector with numbers only, finite and not all zero."""
    v = F.col("v")
    clean = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    return rows.filter(F.col("id").isNotNull() & v.isNotNull() & clean & F.coalesce(some, F.lit(False)))


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    rows = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False) if rows else np.zeros(0)
    return flat.reshape(rows, -1) if rows else np.zeros((0, 0))


def rotation(dimensions: int) -> np.ndarray:
    """A random rotation, the same everywhere."""
    q, r = np.linalg.qr(np.random.default_rng(11).standard_normal((dimensions, dimensions)))
    return q * np.sign(np.diag(r))


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum(0, (a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)[None, :])


def fit_centroids(sample: np.ndarray, lists: int, rounds: int = ROUNDS) -> np.ndarray:
    """Lloyd's rounds from a spread start; an empty centroid restarts at the vector farthest from its own."""
    rng = np.random.default_rng(5)
    centroids = sample[rng.permutation(len(sample))[:lists]].copy()
    for _ in range(rounds):
        owner, distance = np.empty(len(sample), np.int64), np.empty(len(sample))
        for low in range(0, len(sample), 2048):
            d = _squares(sample[low : low + 2048], centroids)
            owner[low : low + 2048] = d.argmin(1)
            distance[low : low + 2048] = d.min(1)
        counts = np.bincount(owner, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, owner, sample)
        held = counts > 0
        centroids[held] = sums[held] / counts[held, None]
        empty = np.flatnonzero(~held)
        centroids[empty] = sample[np.argsort(-distance, kind="stable")[: len(empty)]]
    return np.unique(centroids, axis=0)


def _scan(table: pa.Table, queries: pa.Table, turn: np.ndarray, k: int, epsilon: float) -> pa.Table:
    """The ``k`` nearest rows of one part of a list for each of the queries that probe it."""
    if not table.num_rows or not queries.num_rows:
        return _found([], [], [])
    table = table.sort_by("id")
    ids, vectors = table["id"].to_numpy(), _matrix(table["v"])
    turned = (vectors @ turn).astype(np.float32)
    dimensions = turned.shape[1]
    edges = [*range(0, dimensions, COLUMNS), dimensions]
    blocks = [np.ascontiguousarray(turned[:, a:b].T) for a, b in zip(edges, edges[1:], strict=False)]
    out_query, out_id, out_score = [], [], []
    for query, raw in zip(queries["id"].to_numpy(), _matrix(queries["v"]), strict=True):
        q = (raw @ turn).astype(np.float32)
        # The first rows, whole, give a first bound.
        own = np.flatnonzero(ids != query)
        first = own[: max(k, 32)]
        exact = ((vectors[first] - raw) ** 2).sum(1)
        best = list(zip(exact.tolist(), ids[first].tolist(), strict=True))
        best = sorted(best)[:k]
        alive = own[len(first) :]
        partial = np.zeros(len(alive), np.float32)
        for block, low, high in zip(blocks, edges, edges[1:], strict=False):
            if not len(alive):
                break
            diff = block[:, alive] - q[low:high, None]
            partial = partial + (diff * diff).sum(0)
            bound = best[-1][0] if len(best) == k else np.inf
            if high < dimensions:
                # Under the null hypothesis that the whole distance is within the bound, the share seen so far
                # exceeds this only with the test's small probability.
                limit = bound * high / dimensions * (1 + epsilon / np.sqrt(high)) ** 2
            else:
                limit = bound * (1 + 1e-4) + 1e-9
            keep = partial <= limit
            alive, partial = alive[keep], partial[keep]
        if len(alive):
            exact = ((vectors[alive] - raw) ** 2).sum(1)
            best = sorted([*best, *zip(exact.tolist(), ids[alive].tolist(), strict=True)])[:k]
        out_query += [int(query)] * len(best)
        out_id += [i for _, i in best]
        out_score += [float(np.sqrt(d)) for d, _ in best]
    return _found(out_query, out_id, out_score)


def _found(queries: list, ids: list, scores: list) -> pa.Table:
    return pa.table(
        {"query_id": pa.array(queries, pa.int64()), "vec_id": pa.array(ids, pa.int64()), "score": pa.array(scores, pa.float64())}
    )


def probes_for(indexed: DataFrame, wanted: DataFrame, centroids: np.ndarray, k: int) -> int:
    """How many lists hold ``RECALL`` of the ``k`` nearest rows of some queries, those compared with all rows."""
    tried = wanted.orderBy(F.xxhash64("id"), "id").limit(TRIED).toPandas()
    if not len(tried):
        return PROBES
    ids, points = tried["id"].to_numpy(), np.stack(tried["v"].to_numpy())
    sent = indexed.sparkSession.sparkContext.broadcast((ids, points))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, places = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column(1).to_numpy()
            d = _squares(places, _matrix(batch.column(2)))
            d[asked[:, None] == own[None, :]] = np.inf
            size = min(k, batch.num_rows)
            at = np.argpartition(d, size - 1, axis=1)[:, :size]
            query, row = np.repeat(np.arange(len(asked)), size), at.ravel()
            near = d[query, row]
            some = np.isfinite(near)
            yield pa.RecordBatch.from_arrays(
                [pa.array(query[some].astype(np.int32)), pa.array(near[some]), batch.column(0).take(pa.array(row[some]))],
                names=["query", "d", "list"],
            )

    close = indexed.select("list", "id", "v").mapInArrow(run, "query int, d double, list int")
    best = Win.partitionBy("query").orderBy("d", "list")
    # At most TRIED times k rows.
    found = close.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k).select("query", "list").collect()
    if not found:
        return PROBES
    order = np.argsort(np.argsort(_squares(points, centroids), axis=1, kind="stable"), axis=1)
    ranks = np.sort([order[r["query"], r["list"]] for r in found])
    return max(PROBES, int(ranks[int(np.ceil(RECALL * len(ranks))) - 1]) + 1)


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
    sample: int = SAMPLE, list_rows: int = LIST_ROWS, probes: int | None = None, epsilon: float = EPSILON, part_rows: int = PART_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest vectors found for each query, by Euclidean distance.

    Candidates are all rows of ``vectors`` but the query's own id; fewer than ``k`` candidates give fewer rows. Nearest
    first, ties to the smaller id; scores are distances between the original vectors in double precision. Vectors that
    are null, all zero, or hold null or non-finite components take no part on either side, nor do rows without an id or
    vectors of another length than most. Rows that repeat an id are candidates each. Empty tables give none.

    Centroids are fitted on at most ``sample`` vectors, every row is indexed, and each query probes ``probes`` lists of
    about ``list_rows`` rows. Unless given, that number follows the data: some queries are compared with all rows, and as
    many lists are probed as hold ``RECALL`` of what they find, ``PROBES`` at least. Lists longer than ``part_rows`` are cut into parts by a hash of the id, so copies of
    one vector spread; each part returns its own ``k`` best.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col)
    wanted = usable(queries, id_col, vector_col)
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dimensions, total = lengths[0]["n"], lengths[0]["count"]
    rows, wanted = rows.filter(F.size("v") == dimensions), wanted.filter(F.size("v") == dimensions)
    fitted = rows.orderBy(F.xxhash64("id"), "id").limit(sample).select("v").toPandas()
    lists = int(min(MAX_LISTS, max(1, round(total / list_rows)), len(fitted)))
    centroids = fit_centroids(np.stack(fitted["v"].to_numpy()), lists)
    turn = rotation(dimensions)
    sent = spark.sparkContext.broadcast((centroids, turn))

    def assign(many: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            middle, _ = sent.value
            for batch in batches:
                if not batch.num_rows:
                    continue
                size = min(many, len(middle))
                near = []
                matrix = _matrix(batch.column(1))
                for low in range(0, len(matrix), 2048):
                    d = _squares(matrix[low : low + 2048], middle)
                    near.append(np.argsort(d, axis=1, kind="stable")[:, :size])
                index = np.concatenate(near)
                row = pa.array(np.repeat(np.arange(batch.num_rows), size))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(index.ravel().astype(np.int32)), batch.column(0).take(row), batch.column(1).take(row)],
                    names=["list", "id", "v"],
                )

        return run

    schema = "list int, id long, v array<double>"
    indexed = stored(rows.mapInArrow(assign(1), schema), "lists")
    if probes is None:
        probes = PROBES if len(centroids) <= PROBES else probes_for(indexed, wanted, centroids, k)
    sizes = indexed.groupBy("list").count()
    # At most MAX_LISTS rows.
    parts = {r["list"]: -(-r["count"] // part_rows) for r in sizes.collect()}
    cut = F.broadcast(spark.createDataFrame([(i, n) for i, n in parts.items()], "list int, parts int"))
    placed = indexed.join(cut, "list").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    asked = wanted.mapInArrow(assign(probes), schema).join(cut, "list")
    asked = asked.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("list", "part", "id", "v")

    def scan(left: pa.Table, right: pa.Table) -> pa.Table:
        return _scan(left, right, sent.value[1], k, epsilon)

    pairs = placed.select("list", "part", "id", "v").groupBy("list", "part").cogroup(asked.groupBy("list", "part"))
    found = pairs.applyInArrow(scan, "query_id long, vec_id long, score double")
    best = Win.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
