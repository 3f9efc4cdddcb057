"""Approximate nearest neighbours by inner product: lists, rotated column blocks, and an adaptive scan of dimensions."""

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from shelfmatch.llm.common import hash_sample, quoted
from shelfmatch.sources.staging import stage

SAMPLE_ROWS = 20_000  # vectors that one task or the driver fits lists on, those with the least hashes
ROWS_PER_LIST = 16  # of the sample, about
ROUNDS, SEED = 12, 11
TRIALS = 400  # queries that choose the number of probed lists, each compared with all vectors
COLUMNS = 16  # dimensions per block
ERROR = 2.1  # of the test: the larger, the fewer true neighbours are given up
SPARE = 12  # candidates kept beyond those asked for, until exact scores decide
BAND = 8  # powers of two: vectors whose lengths differ by no more are searched together
CELL = 4096  # vectors, and queries, that meet in one group


def usable(vector: Column) -> Column:
    """Not null, not empty, not zero, and no component null or not finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def normed(vectors: DataFrame) -> DataFrame:
    """(id, size, unit): log2 of the length, and the vector with length 1; no square overflows, whatever the values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                matrix = _matrix(batch.column(1))
                shift = np.frexp(np.abs(matrix).max(axis=1))[1]
                near = np.ldexp(matrix, -shift[:, None])
                length = np.sqrt((near**2).sum(axis=1))
                unit = near / length[:, None]
                rows = pa.ListArray.from_arrays(pa.array(np.arange(0, unit.size + 1, unit.shape[1]), pa.int32()), pa.array(unit.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shift + np.log2(length)), rows], ["id", "size", "unit"])

    return vectors.select("id", "vec").mapInArrow(run, "id long, size double, unit array<double>")


def nearest_of(points: np.ndarray, centroids: np.ndarray, count: int) -> np.ndarray:
    """The nearest ``count`` centroids of each point, nearest first."""
    far = (centroids**2).sum(axis=1) - 2 * points @ centroids.T
    if count >= far.shape[1]:
        return np.argsort(far, axis=1, kind="stable")
    near = np.argpartition(far, count - 1, axis=1)[:, :count]
    return np.take_along_axis(near, np.argsort(np.take_along_axis(far, near, axis=1), axis=1, kind="stable"), axis=1)


def k_means(points: np.ndarray, count: int) -> np.ndarray:
    centroids = points[np.random.default_rng(SEED).choice(len(points), count, replace=False)]
    for _ in range(ROUNDS):
        own = np.concatenate([nearest_of(points[at:at + 1000], centroids, 1)[:, 0] for at in range(0, len(points), 1000)])
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, points)
        sizes = np.bincount(own, minlength=count)
        centroids = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centroids)
    return centroids


@dataclass
class Lists:
    """Centroids of vectors that got one more component, which gives all the same length (queries get a 0 there): the
    nearest by distance are then the greatest by inner product. ``rotation`` mixes all dimensions evenly.

    There are two levels: each list has a parent, and ``begins`` says where the lists of each parent stand. A vector
    lies in the nearest list of its nearest parent; a query looks at the lists of its nearest ``wide`` parents.
    """

    length: float
    rotation: np.ndarray
    parents: np.ndarray  # rotated
    centroids: np.ndarray  # rotated, those of one parent together
    begins: np.ndarray  # one more than parents

    def rotated(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        last = np.zeros(len(vectors)) if query else np.sqrt(np.maximum(0, self.length**2 - (vectors**2).sum(axis=1)))
        return np.concatenate((vectors, last[:, None]), axis=1) @ self.rotation

    def order(self, rotated: np.ndarray, wide: int, count: int) -> np.ndarray:
        """The nearest ``count`` lists among those of the nearest ``wide`` parents, nearest first; -1 where there are
        no more."""
        near = nearest_of(rotated, self.parents, wide)
        sizes = np.diff(self.begins)
        if sizes.max() == 1:
            return near[:, :count]
        most = int(sizes.max())
        far = np.full((len(rotated), near.shape[1], most), np.inf)
        number = np.full(far.shape, -1)
        for parent in np.unique(near):
            row, nth = np.nonzero(near == parent)
            a, b = self.begins[parent:parent + 2]
            own = self.centroids[a:b]
            far[row, nth, :b - a] = (own**2).sum(axis=1) - 2 * rotated[row] @ own.T
            number[row, nth, :b - a] = np.arange(a, b)
        far, number = far.reshape(len(rotated), -1), number.reshape(len(rotated), -1)
        best = np.argsort(far, axis=1, kind="stable")[:, :count]
        return np.take_along_axis(number, best, axis=1)

    def rows_together(self, wide: int) -> int:
        """How many vectors to order at a time, so that their distances to lists fill 8 MB at most."""
        return max(1, min(1000, (1 << 20) // (min(wide, len(self.parents)) * int(np.diff(self.begins).max()))))


def fit_lists(vectors: DataFrame, rows: int, length: float, dimensions: int) -> Lists:
    """About the square root of the rows as the number of lists, ``ROWS_PER_LIST`` sampled vectors each.

    The parents are fitted by the driver on ``SAMPLE_ROWS`` vectors. If more lists are wanted than these can tell apart,
    a sample that grows with the lists is dealt to the parents, and each parent is divided by a task of its own, on
    at most ``SAMPLE_ROWS`` vectors. The driver gets the centroids: as many as the square root of the rows.
    """
    sample = hash_sample(vectors, "vec", "vec", rows, SAMPLE_ROWS).collect()
    random = np.random.default_rng(SEED)
    rotation, _ = np.linalg.qr(random.standard_normal((dimensions + 1, dimensions + 1)))
    none = np.zeros((1, dimensions + 1))
    points = Lists(length, rotation, none, none, np.array([0, 1])).rotated(np.array([r.vec for r in sample], float), False)
    wanted = max(1, round(rows**0.5))
    parents = k_means(points, max(1, min(wanted, len(points) // ROWS_PER_LIST)))
    lists = Lists(length, rotation, parents, parents, np.arange(len(parents) + 1))
    if wanted <= len(parents) or len(points) == rows:
        return lists

    def divide(members: pa.Table) -> pa.Table:
        own = _matrix(members.column("rotated").combine_chunks())
        centroids = k_means(own, max(1, len(own) // ROWS_PER_LIST))
        return pa.table([pa.array(np.full(len(centroids), members.column("list")[0].as_py(), np.int32)), _rows(centroids)], ["parent", "rotated"])

    low = F.xxhash64("vec") <= -(1 << 63) + ((1 << 64) - 1) * min(rows, wanted * ROWS_PER_LIST) // rows
    placed = place(vectors.where(low), lists, 1, 1, False)
    nth = F.row_number().over(Window.partitionBy("list").orderBy(F.xxhash64("id")))
    members = placed.select("list", "id", "rotated").withColumn("n", nth).where(F.col("n") <= SAMPLE_ROWS)
    found = members.select("list", "rotated").groupBy("list").applyInArrow(divide, "parent int, rotated array<float>").toArrow().sort_by("parent")
    of = np.concatenate((found.column("parent").to_numpy(), np.setdiff1d(np.arange(len(parents)), found.column("parent").to_numpy())))
    centroids = np.concatenate((_matrix(found.column("rotated").combine_chunks()), parents[of[found.num_rows:]]))  # no sampled vector: undivided
    at = np.argsort(of, kind="stable")
    return Lists(length, rotation, parents, centroids[at], np.searchsorted(of[at], np.arange(len(parents) + 1)))


def choose_probes(index: DataFrame, asked: DataFrame, lists: Lists, k: int, recall: float) -> tuple[int, int]:
    """How many parents and lists to look at: so many that they hold the part ``recall`` of the true ``k`` nearest
    of ``TRIALS`` queries (those with the least hashes), which are compared with every vector."""
    trials = asked.select("id", F.struct("id", "unit").alias("trial"))
    trials = hash_sample(trials, "id", "trial", trials.count(), TRIALS).select("trial.*").toArrow()
    if not trials.num_rows:
        return 1, 1
    ids, queries = trials.column("id").to_numpy(), lists.rotated(_matrix(trials.column("unit").combine_chunks()), True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near, where = np.full((len(ids), k), np.inf), np.full((len(ids), k), -1)
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                matrix = _matrix(batch.column(2))
                far = (matrix**2).sum(axis=1) - 2 * queries @ matrix.T
                far[ids[:, None] == batch.column(1).to_numpy()] = np.inf
                both = np.concatenate((near, far), axis=1)
                best = np.argpartition(both, k - 1, axis=1)[:, :k]
                own = np.broadcast_to(batch.column(0).to_numpy(), far.shape)
                near, where = np.take_along_axis(both, best, axis=1), np.take_along_axis(np.concatenate((where, own), axis=1), best, axis=1)
        query, nth = np.nonzero(np.isfinite(near))
        yield pa.RecordBatch.from_arrays([pa.array(query.astype(np.int32)), pa.array(where[query, nth].astype(np.int32)), pa.array(near[query, nth])], ["trial", "list", "far"])

    found = index.select("list", "id", "rotated").mapInArrow(run, "trial int, list int, far double")
    nth = F.row_number().over(Window.partitionBy("trial").orderBy("far", "list"))
    true = found.withColumn("n", nth).where(F.col("n") <= k).select("trial", "list").toArrow()
    if not true.num_rows:
        return 1, 1
    trial, own = (true.column(c).to_numpy() for c in ("trial", "list"))

    def enough(ranks: np.ndarray, part: float) -> int:
        return int(np.sort(ranks)[min(len(ranks) - 1, int(np.ceil(part * len(ranks))))]) + 1

    parent = np.searchsorted(lists.begins, own, "right") - 1
    order = nearest_of(queries, lists.parents, len(lists.parents))
    wide = enough(np.argsort(order, axis=1)[trial, parent], (1 + recall) / 2)
    ranks = np.full(len(trial), len(lists.centroids))
    step = lists.rows_together(wide)
    for at in range(0, len(queries), step):
        order = lists.order(queries[at:at + step], wide, len(lists.centroids))
        mine = np.flatnonzero((trial >= at) & (trial < at + step))
        for i in mine:
            place_of = np.flatnonzero(order[trial[i] - at] == own[i])
            ranks[i] = place_of[0] if len(place_of) else ranks[i]
    return wide, min(enough(ranks, recall), len(lists.centroids))


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def _rows(matrix: np.ndarray) -> pa.ListArray:
    flat = matrix.astype(np.float32)
    return pa.ListArray.from_arrays(pa.array(np.arange(0, flat.size + 1, flat.shape[1]), pa.int32()), pa.array(flat.ravel()))


def place(vectors: DataFrame, lists: Lists, wide: int, probes: int, query: bool) -> DataFrame:
    """(list, nth, id, rotated): each vector in its nearest list, or each query in its nearest ``probes`` lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = lists.rows_together(wide)
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                rotated = lists.rotated(_matrix(batch.column(1)), query)
                near = lists.order(rotated, wide, probes)
                row, nth = np.nonzero(near >= 0)
                ids = batch.column(0).to_numpy()[row]
                yield pa.RecordBatch.from_arrays([pa.array(near[row, nth].astype(np.int32)), pa.array(nth.astype(np.int32)), pa.array(ids), _rows(rotated[row])], ["list", "nth", "id", "rotated"])

    return vectors.select("id", "vec").mapInArrow(run, "list int, nth int, id long, rotated array<float>")


def scan_list(queries: np.ndarray, limits: np.ndarray, vectors: np.ndarray, keep: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query: its number, the vectors that may be among its ``keep`` nearest, and their squared distances.

    The vectors stand in blocks of columns. After each block, the partial distance scaled to all dimensions is tested
    against the limit (the best known distance of rank ``keep``): a candidate is given up if it would exceed the limit
    even when the partial distance overstates it by the factor that the random rotation makes very unlikely.
    """
    dimensions = vectors.shape[1]
    edges = [*range(0, dimensions, COLUMNS), dimensions]
    blocks = [np.ascontiguousarray(vectors[:, a:b]) for a, b in zip(edges, edges[1:])]
    for q, limit in zip(range(len(queries)), limits):
        query = queries[q]
        left, partial = np.arange(len(vectors)), np.zeros(len(vectors))
        if not np.isfinite(limit) and len(vectors) > 4 * keep:  # no limit yet: full distances of some vectors give one
            some = ((vectors[:4 * keep] - query) ** 2).sum(axis=1)
            limit = np.partition(some, keep - 1)[keep - 1]
        for block, a, b in zip(blocks, edges, edges[1:]):
            partial = partial + ((block[left] - query[a:b]) ** 2).sum(axis=1)
            bound = limit * (1 + ERROR / b**0.5) ** 2 * b / dimensions if b < dimensions else limit
            stay = partial <= bound * (1 + 1e-6)
            left, partial = left[stay], partial[stay]
        if len(left) > keep:
            best = np.argpartition(partial, keep - 1)[:keep]
            left, partial = left[best], partial[best]
        yield q, left, partial


def scan(index: DataFrame, probes: DataFrame, keep: int) -> DataFrame:
    """(query, id, distance) of the vectors of each probed list that pass the tests. ``probes`` has (list, id, rotated,
    limit). Lists with many vectors or queries are dealt into cells of bounded size."""
    sizes = index.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / CELL).alias("index_parts"))
    asked = probes.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / CELL).alias("query_parts"))
    parts = stage(sizes.join(asked, "list"), "parts")

    def dealt(rows, own, other):
        part = F.pmod(F.xxhash64("id"), F.col(own)).alias("own")
        wide = rows.join(F.broadcast(parts), "list").select("*", part, F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias("other"))
        return wide.withColumnsRenamed({"own": own[:-1], "other": other[:-1]}).drop(own, other)

    vectors = dealt(index, "index_parts", "query_parts").select("list", "index_part", "query_part", "id", "rotated")
    asks = dealt(probes, "query_parts", "index_parts").select("list", "index_part", "query_part", "id", "rotated", "limit")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows and right.num_rows:
            ids, queries = left.column("id").to_numpy(), right.column("id").to_numpy()
            matrix, asked = (_matrix(t.column("rotated").combine_chunks()) for t in (left, right))
            rows = [(np.full(len(at), queries[q]), ids[at], far) for q, at, far in scan_list(asked, right.column("limit").to_numpy(), matrix, keep)]
            found = [np.concatenate(x) for x in zip(*rows)]
            return pa.table({"query": pa.array(found[0]), "id": pa.array(found[1]), "distance": pa.array(found[2])})
        return pa.table({"query": pa.array([], pa.int64()), "id": pa.array([], pa.int64()), "distance": pa.array([], pa.float64())})

    key = ["list", "index_part", "query_part"]
    return vectors.groupBy(*key).cogroup(asks.groupBy(*key)).applyInArrow(run, "query long, id long, distance double")


def find_in_band(band: DataFrame, asked: DataFrame, rows: int, size: float, dimensions: int, k: int, recall: float, keep: int) -> DataFrame:
    """(query, id): for each query the ``keep`` nearest found among the vectors (id, size, unit) of one band, whose
    greatest length has the logarithm ``size``. Vectors are scaled by that length, and queries have length 1, so what
    single precision rounds away is small beside the inner products of the band."""
    vectors = stage(band.select("id", F.transform("unit", lambda x: x * F.pow(F.lit(2.0), F.col("size") - size)).alias("vec")), "band")
    lists = fit_lists(vectors, rows, 1.0, dimensions)
    index = stage(place(vectors, lists, 1, 1, False).select("list", "id", "rotated"), "index")
    wide, probes = choose_probes(index, asked, lists, k, recall)
    wanted = stage(place(asked.withColumnRenamed("unit", "vec"), lists, wide, probes, True), "probes")
    first = stage(scan(index, wanted.where("nth = 0").withColumn("limit", F.lit(float("inf"))), keep), "first")
    by_query = Window.partitionBy("query").orderBy("distance")
    limits = first.withColumn("n", F.row_number().over(by_query)).where(F.col("n") == keep).select(F.col("query").alias("id"), F.col("distance").alias("limit"))
    rest = wanted.where("nth > 0").join(limits, "id", "left").withColumn("limit", F.coalesce("limit", F.lit(float("inf"))))
    found = first.union(scan(index, rest, keep))
    return found.withColumn("n", F.row_number().over(by_query)).where(F.col("n") <= keep).select("query", "id")


def search(
    vectors: DataFrame, is_query: Column, k: int = 20, recall: float = 0.95,
    vec_id: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found, by inner product, of every row for which ``is_query``
    holds, among all other rows; nearest first, equal scores by smaller ``vec_id``. Scores are those of the original
    vectors in double precision; which rows are found is approximate (see ``scan_list``).

    Vectors that are null, empty, zero or hold a null or non-finite component take no part, nor do rows without id or
    vectors of another length than most. Repeated rows count once; different ids with equal vectors all count. With
    fewer than ``k`` others all of them are returned. An empty table gives an empty result.

    Equal vectors are one entry of the index, with their ``k + 1`` smallest ids, so a vector that a third of all rows
    share is one candidate and one query. Vectors of very different lengths (in bands of ``2 ** BAND``) have indexes of
    their own, each asked by every query. The number of probed lists is chosen for the stated ``recall`` (see
    ``choose_probes``). A query looks at ``probes`` lists of about the square root of the rows each.
    """
    spark = vectors.sparkSession
    rows = vectors.select(quoted(vec_id).cast("long").alias("id"), quoted(vector).cast("array<double>").alias("vec"), is_query.alias("asks"))
    rows = rows.where("id is not null").where(usable(F.col("vec")))
    widths = rows.groupBy(F.size("vec").alias("w")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "w").limit(1).collect()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not widths:
        return empty
    dimensions = widths[0].w
    rows = stage(rows.where(F.size("vec") == dimensions).distinct(), "vectors")

    classes = stage(rows.groupBy("vec").agg(F.min("id").alias("id")), "classes")
    copies = rows.select("vec", F.col("id").alias("copy")).withColumn("nth", F.row_number().over(Window.partitionBy("vec").orderBy("copy"))).where(F.col("nth") <= k + 1)
    copies = copies.withColumn("id", F.min("copy").over(Window.partitionBy("vec"))).select("id", "copy")
    asking = stage(rows.where("asks").select("vec", F.col("id").alias("query_id")).join(classes, "vec").select("query_id", "id"), "asking")
    asked = classes.join(asking.select("id").distinct(), "id", "left_semi")

    band = F.floor(F.col("size") / BAND + 0.5).cast("long")
    scaled = stage(normed(classes).withColumn("band", band), "scaled")
    asked = stage(normed(asked).select("id", "unit"), "asked")
    keep = k + 1 + SPARE
    bands = scaled.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("size")).orderBy("band").collect()
    parts = [find_in_band(scaled.where(F.col("band") == b.band), asked, b.n, b.size, dimensions, k, recall, keep) for b in bands]
    best = reduce(DataFrame.union, parts)

    ends = classes.withColumnsRenamed({"id": "query", "vec": "query_vec"})
    scored = best.join(ends, "query").join(classes, "id").select("query", "id", dot(F.col("query_vec"), F.col("vec")).alias("score"))
    listed = scored.join(copies, "id").withColumn("n", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "copy"))).where(F.col("n") <= k + 1)
    nearest = listed.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("n", "copy", "score"))).alias("near"))
    joined = asking.join(nearest, asking.id == nearest.query)
    others = F.slice(F.filter("near", lambda x: x["copy"] != F.col("query_id")), 1, k)
    out = joined.select("query_id", F.posexplode(others).alias("rank", "x"))
    return out.select("query_id", (F.col("rank") + 1).alias("rank"), F.col("x.copy").alias("vec_id"), F.col("x.score").alias("score"))
