"""Approximate nearest neighbours by balanced posting lists.

Lists: a bounded sample is halved again and again, each time by two centres with the border set so that both halves
are equal; the leaves' means are the centroids. Centroids stay in memory, at most ``MOST_LISTS``, and are searched by a
graph: each is tied to near ones, leaving out those that another of its neighbours is closer to, and a search walks
from fixed entry points to ever nearer centroids. Vectors lie in posting lists of their nearest centroids: the nearest one,
and others almost as near, so that a vector at a border is found from both sides; of those, one that lies behind another
chosen one adds little and is left out. A query reads all lists whose centroids are at most a ratio times as far as the nearest; the
ratio is fitted on the sample, to find ``RECALL`` of the true neighbours there. (Neighbours in a sample are farther
than those among all vectors, so the ratio errs to the safe side.)

Equal vectors are one entry with the smallest of their ids, as many as a result can use. Lists are dealt in blocks of
about ``BLOCK`` vectors, and the queries that read a list in blocks of about ``QUERIES``; each block of the one meets each
of the other in a group of its own, so neither a long list nor a list that many queries read is one task's load. A block
answers with its best vectors only, and of those only what is not farther than as many vectors of the sample in
the lists read. The best of many rows are always taken by a ranking window, of which each task hands on no more rows per key
than the result can use; no array gathers a group. Distances are computed in double precision on the
original vectors.

Defined cases: vectors null, zero, or with a null or non-finite component take no part, nor do vectors of
another length than the most common one; rows without an id take no part; equal distances go to the smaller id; repeated
rows with one id are one; a query without candidates returns no rows; an empty table gives no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vitalgauge.llm.common import free_name
from vitalgauge.sources.shared import share

SAMPLE = 65_536
MOST_LISTS = 2048
#: Vectors a list should hold, replicas aside; lists hold more beyond ``MOST_LISTS`` of them.
LIST_SIZE = 64
#: Lists a vector is in at most, and how much farther than the nearest their centroids may be.
REPLICAS = 4
REPLICA_RATIO = 1.15
#: A centroid is left out if another chosen one is this many times nearer to it than the vector is.
BEHIND = 2.0
#: The share of true neighbours that the ratio of the lists to read is fitted to find, on vectors of the sample.
RECALL = 0.97
CALIBRATION_ROWS = 8192
CALIBRATION_QUERIES = 128
NEIGHBOURS = 24
#: Centroids a walk opens at a time, and vectors that walk together.
_BEAM = 8
_ROWS = 256
BLOCK = 4096
QUERIES = 4096
_SEED = 7


# --- centroids ------------------------------------------------------------------------------------


def balanced_centroids(vectors: np.ndarray, lists: int) -> np.ndarray:
    """Means of equal parts of the vectors."""
    parts, rng = [np.arange(len(vectors))], np.random.default_rng(_SEED)
    while len(parts) < lists:
        halves = [half for part in parts for half in _halved(vectors, part, rng)]
        if len(halves) == len(parts):
            break
        parts = halves
    return np.array([vectors[p].mean(0) for p in parts])


def _halved(vectors: np.ndarray, part: np.ndarray, rng: np.random.Generator) -> list[np.ndarray]:
    if len(part) < 2:
        return [part]
    x = vectors[part]
    one, two = x[rng.choice(len(x), 2, replace=False)]
    for _ in range(8):
        order = np.argsort(x @ (two - one), kind="stable")
        first, second = order[: len(x) // 2], order[len(x) // 2 :]
        one, two = x[first].mean(0), x[second].mean(0)
    return [part[first], part[second]]


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` to all of ``b``."""
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T, 0)


@dataclass(frozen=True)
class Centroids:
    points: np.ndarray

    @functools.cached_property
    def links(self) -> np.ndarray:
        """Each centroid's neighbours, itself where it has fewer."""
        n = len(self.points)
        links = np.repeat(np.arange(n)[:, None], min(NEIGHBOURS, max(n - 1, 1)), 1)
        for low in range(0, n, 512):
            far = squared(self.points[low : low + 512], self.points)
            order = np.argsort(far, 1, kind="stable")[:, 1 : 4 * NEIGHBOURS]
            for i, near in enumerate(order, low):
                chosen: list[int] = []
                between = squared(self.points[near], self.points[near])
                for k, c in enumerate(near):
                    if all(between[k, j] >= far[i - low, c] for j in chosen):
                        chosen.append(k)
                    if len(chosen) == links.shape[1]:
                        break
                rest = [k for k in range(len(near)) if k not in set(chosen)]
                picked = near[(chosen + rest)[: links.shape[1]]]
                links[i, : len(picked)] = picked
        return links

    @functools.cached_property
    def entries(self) -> np.ndarray:
        n = len(self.points)
        return np.unique(np.linspace(0, n - 1, min(n, 16)).astype(int))

    def nearest(self, x: np.ndarray, view: int, ratio: float | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and squared distances of near centroids of each row, nearest first; -1 and inf where fewer.

        With a ratio, all that the walk finds within it; without, ``view`` of them.
        """
        n, rows = len(x), np.arange(len(x))[:, None]
        seen = np.zeros((n, len(self.points) + 1), bool)
        seen[:, self.entries] = True
        ids, far = np.repeat(self.entries[None, :], n, 0), squared(x, self.points[self.entries])
        done = np.zeros(ids.shape, bool)
        own, norms = (x * x).sum(1)[:, None], (self.points * self.points).sum(1)
        while True:
            limit = np.inf if ratio is None else ratio**2 * far.min(1, keepdims=True) + 1e-12
            open_far = np.where(done | (far > limit), np.inf, far)
            best = np.argpartition(open_far, min(_BEAM, open_far.shape[1]) - 1, 1)[:, :_BEAM]
            active = np.isfinite(open_far[rows, best])
            if not active.any():
                break
            done[rows, best] = True
            new = np.where(active[:, :, None], self.links[ids[rows, best]], -1).reshape(n, -1)
            new = np.sort(np.where(seen[rows, new], -1, new), 1)
            new[:, 1:][new[:, 1:] == new[:, :-1]] = -1
            seen[rows, new] = True
            seen[:, -1] = False
            dots = np.einsum("nkd,nd->nk", self.points[new], x)
            ids = np.c_[ids, new]
            far = np.c_[far, np.where(new < 0, np.inf, np.maximum(own + norms[new] - 2 * dots, 0))]
            done = np.c_[done, new < 0]
            kept = view if ratio is None else int(np.isfinite(far).sum(1).max())
            order = np.argsort(far, 1, kind="stable")[:, :kept]
            ids, far, done = (np.take_along_axis(a, order, 1) for a in (ids, far, done))
        order = np.argsort(far, 1, kind="stable")
        ids, far = np.take_along_axis(ids, order, 1), np.take_along_axis(far, order, 1)
        return np.where(np.isfinite(far), ids, -1), far

    def homes(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and list of every place a vector has in the index."""
        ids, far = self.nearest(x, 4 * REPLICAS)
        taken = np.zeros(ids.shape, bool)
        taken[:, 0] = True
        for k in range(1, ids.shape[1]):
            open_ = (ids[:, k] >= 0) & (far[:, k] <= REPLICA_RATIO**2 * far[:, 0]) & (taken.sum(1) < REPLICAS)
            for j in range(k):
                apart = ((self.points[ids[:, k]] - self.points[ids[:, j]]) ** 2).sum(1)
                open_ &= ~(taken[:, j] & (BEHIND**2 * apart < far[:, k]))
            taken[:, k] = open_
        row, column = np.nonzero(taken)
        return row, ids[row, column]

    def all_homes(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """:meth:`homes`, of a few rows at a time."""
        parts = [(low, *self.homes(x[low : low + _ROWS])) for low in range(0, len(x), _ROWS)]
        return np.concatenate([low + r for low, r, _ in parts]), np.concatenate([h for _, _, h in parts])

    def lists(self, x: np.ndarray, ratio: float) -> tuple[np.ndarray, np.ndarray]:
        """Row and list of every list a query reads."""
        ids, far = self.nearest(x, 0, ratio)
        row, column = np.nonzero((ids >= 0) & (far <= ratio**2 * far[:, :1] + 1e-12))
        return row, ids[row, column]

    def ratio_for(self, x: np.ndarray, k: int) -> float:
        """The least ratio that finds ``RECALL`` of the ``k`` nearest of some of the rows among all of them."""
        asked = x[:: max(1, len(x) // CALIBRATION_QUERIES)][:CALIBRATION_QUERIES]
        near = np.argsort(squared(asked, x), 1, kind="stable")[:, : k + 1]
        row, home = self.all_homes(x)
        to_centroids = np.sqrt(squared(asked, self.points))
        least = np.maximum(to_centroids.min(1), 1e-12)
        needed = np.full(near.shape, np.inf)
        by_row = np.searchsorted(row, np.arange(len(x) + 1))
        for i, found in enumerate(near):
            for j, member in enumerate(found):
                needed[i, j] = to_centroids[i, home[by_row[member] : by_row[member + 1]]].min() / least[i]
        return float(np.quantile(needed, RECALL)) + 1e-6 if needed.size else 1.0


# --- Spark ----------------------------------------------------------------------------------------


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1) if n else np.zeros((0, 1))


def _batches(batch: pa.RecordBatch, step: int) -> Iterator[pa.RecordBatch]:
    for low in range(0, batch.num_rows, step):
        yield batch.slice(low, step)


def squared_limits(x: np.ndarray, row: np.ndarray, read: np.ndarray, known: np.ndarray, homes: tuple[np.ndarray, np.ndarray], n: int) -> np.ndarray:
    """For each of the queries ``x``, which read the lists ``read`` (by ``row``), a squared distance within which ``n`` of
    the known vectors in those lists lie: its ``n`` nearest there are not farther."""
    if len(known) < n:
        return np.full(len(x), np.inf)
    far, (member, home) = squared(x, known), homes
    for i, own in enumerate(far):
        reached = np.zeros(len(known), bool)
        reached[member[np.isin(home, read[row == i])]] = True
        own[~reached] = np.inf
    return np.partition(far, n - 1, 1)[:, n - 1]


def first_of(rows: DataFrame, n: int, keys: list[str], order: list[str]) -> DataFrame:
    """Of each key the first ``n`` rows in an order. Spark ranks before the shuffle too, so a key's rows there are
    at most ``n`` per task."""
    place = free_name(rows, "place")
    ranked = rows.withColumn(place, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(place) <= n).drop(place)


def distinct_vectors(vectors: DataFrame, keep: int) -> DataFrame:
    """``rep`` (the smallest id), ``ids`` (the ``keep`` smallest) and ``vector`` of each distinct usable vector."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("vector"))
    rows = rows.filter(F.col("id").isNotNull() & usable(F.col("vector"))).withColumn("length", F.size("vector"))
    common = rows.groupBy("length").count().orderBy(F.desc("count"), "length").first()
    rows = rows.filter(F.col("length") == (common["length"] if common else 0))
    ids = first_of(rows.select("id", "vector").distinct(), keep, ["vector"], ["id"])
    found = ids.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    return found.select(F.element_at("ids", 1).alias("rep"), "ids", "vector")


def fit_centroids(distinct: DataFrame, k: int, list_size: int = LIST_SIZE, most_lists: int = MOST_LISTS) -> tuple[Centroids, float, np.ndarray] | None:
    """Centroids, the ratio for ``k`` neighbours and ``CALIBRATION_ROWS`` vectors, from a sample of at most ``SAMPLE``
    distinct vectors, taken by a hash of the id. None if there are no vectors."""
    n = distinct.count()
    if not n:
        return None
    part = min(1.0, 1.1 * SAMPLE / n + 64 / n)
    chosen = distinct.filter(F.pmod(F.xxhash64("rep", F.lit(_SEED)), F.lit(1 << 30)) < int(part * (1 << 30)))
    got = chosen.orderBy(F.xxhash64("rep", F.lit(_SEED)), "rep").limit(SAMPLE).select("vector").toArrow()
    points = _matrix(got.column("vector").combine_chunks())
    centroids = Centroids(balanced_centroids(points, max(1, min(most_lists, n // list_size))))
    some = points[:CALIBRATION_ROWS]
    return centroids, centroids.ratio_for(some, k), some


def dealt(rows: DataFrame, key: str, own: tuple[str, dict[int, int]], other: tuple[str, dict[int, int]]) -> DataFrame:
    """Rows of lists, each in one of its list's blocks on its ``own`` side, once for every block on the ``other`` side.

    A side is the name of the column with its block, and its number of blocks by list. Lists without any there are left out.
    """
    (mine, n_mine), (theirs, n_theirs) = own, other

    def number(blocks: dict[int, int]) -> Column:
        return F.try_element_at(F.create_map(*[F.lit(x) for pair in blocks.items() for x in pair]), F.col("list"))

    block = F.pmod(F.xxhash64(key), number(n_mine)).cast("int")
    return rows.withColumns({mine: block, theirs: F.explode(F.sequence(F.lit(0), number(n_theirs) - 1))})


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """For each row of ``queries``, up to ``k`` near rows of ``vectors`` other than itself: ``query_id``, ``rank``, ``vec_id``, ``score``.

    Both have ``vec_id`` and ``embedding``; queries are some of the vectors. The score is the Euclidean distance.
    """
    spark = vectors.sparkSession
    distinct = share(distinct_vectors(vectors, k + 1), "vectors")
    fitted = fit_centroids(distinct, k)
    nothing = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if fitted is None:
        return nothing
    centroids, ratio, known = fitted
    homes = centroids.all_homes(known)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in _batches(batch, _ROWS):
                row, home = centroids.homes(_matrix(some.column(1)))
                taken = some.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array(home, pa.int32()), *taken.columns], names=["list", "rep", "vector"])

    postings = share(distinct.select("rep", "vector").mapInArrow(placed, "list int, rep long, vector array<double>"), "postings")
    sizes = {r["list"]: r["count"] for r in postings.groupBy("list").count().collect()}  # one row per centroid
    blocks = {home: -(-n // BLOCK) for home, n in sizes.items()}

    asked = queries.select(F.col("vec_id").cast("long").alias("query_id"), F.col("embedding").cast("array<double>").alias("vector"))
    asked = asked.filter(F.col("query_id").isNotNull() & usable(F.col("vector")))
    by_vector = distinct.select("rep", "ids", "vector").join(asked.select("vector").distinct(), "vector", "left_semi")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in _batches(batch, _ROWS):
                row, read = centroids.lists(_matrix(some.column(1)), ratio)
                limits = squared_limits(_matrix(some.column(1)), row, read, known, homes, k + 3)
                held = np.isin(read, list(blocks))
                row, read = row[held], read[held]
                taken = some.take(pa.array(row))
                columns = [pa.array(read, pa.int32()), *taken.columns, pa.array(limits[row])]
                yield pa.RecordBatch.from_arrays(columns, names=["list", "query", "vector", "most"])

    reads = by_vector.select("rep", "vector").mapInArrow(spread, "list int, query long, vector array<double>, most double")
    reads = share(reads, "reads")
    readers = {r["list"]: r["count"] for r in reads.groupBy("list").count().collect()}  # one row per centroid
    parts = {home: -(-n // QUERIES) for home, n in readers.items()}
    if not parts:
        return nothing
    of_vectors, of_queries = ("block", blocks), ("asking", parts)
    kept, asking = dealt(postings, "rep", of_vectors, of_queries), dealt(reads, "query", of_queries, of_vectors)

    def searched(held: pa.Table, asking: pa.Table) -> pa.Table:
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if held.num_rows and asking.num_rows:
            points, reps = _matrix(held.column("vector").combine_chunks()), held.column("rep").to_numpy()
            wanted, names = _matrix(asking.column("vector").combine_chunks()), asking.column("query").to_numpy()
            most, size, last = asking.column("most").to_numpy(), (points * points).sum(1), min(k, len(points) - 1)
            for low in range(0, len(wanted), _ROWS):
                part = wanted[low : low + _ROWS]
                own = (part * part).sum(1)
                rough = size[None, :] + own[:, None] - 2 * part @ points.T
                # the best of this block that can be among the best of all; what rounding may hide is measured exactly
                edge = np.minimum(np.partition(rough, last, 1)[:, last], most[low : low + _ROWS])
                row, column = np.nonzero(rough <= (edge + 1e-9 * (size.max() + own))[:, None])
                exact = np.sqrt(((points[column] - part[row]) ** 2).sum(1))
                parts.append((names[low + row], reps[column], exact))
        columns = [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [[], [], []]
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["query", "rep", "score"])

    found = (
        kept.groupBy("list", "block", "asking")
        .cogroup(asking.groupBy("list", "block", "asking"))
        .applyInArrow(searched, "query long, rep long, score double")
    )
    found = found.groupBy("query", "rep").agg(F.min("score").alias("score"))
    near = first_of(found, k + 1, ["query"], ["score", "rep"])
    members = near.join(distinct.select("rep", "ids"), "rep").select("query", "score", F.explode("ids").alias("vec_id"))
    results = first_of(members, k + 1, ["query"], ["score", "vec_id"])
    by_query = asked.join(by_vector.select("rep", "vector"), "vector").select("query_id", "rep").distinct()
    rows = by_query.join(results, by_query["rep"] == results["query"]).select("query_id", "vec_id", "score").filter("vec_id <> query_id")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    ranked = rows.withColumn("rank", place).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

