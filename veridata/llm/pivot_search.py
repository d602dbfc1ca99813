"""Exact top-k search by inner product over a pivot-distance index.

Components become integers floor(256 x). An inner product is turned into a distance by one more component, which lifts
every candidate to the same norm: |q - c|^2 = |q|^2 + M - 2 q.c, with M the largest squared norm, so the nearest
candidates have the highest products. Each candidate is keyed by its nearest pivot and its distance to it. Bands of
neighbouring distances are annuli around the pivot; a band with more vectors than one task should hold is dealt over
several segments, and inside a segment the vectors are cut into finer annuli.

A query knows from the sample a score that its k-th best at least has, so by the triangle inequality,
|d(q, pivot) - d(c, pivot)| <= |q - c|, it is sent to those bands only that may hold one of its k. In a segment it visits
the annuli from its own distance to the pivot outwards and stops when no later one can hold a candidate that enters.

Pivots and bands are picked from a bounded sample of ``SAMPLE`` vectors (those with the smallest hashes), which only
affects how much is pruned; every vector is indexed and the result is exact. Float products find the candidates; where
they may not be exact (squared norms of 2^53 or more), all candidates within the rounding error of the k-th place are
scored again in whole numbers.

Rows are told apart, not ids: equal rows (same id, same vector) are kept once with their number, a query row leaves out
itself alone, and each of several query rows of one vec_id has its own ranks. Ties go to the smaller vec_id. Vectors that
are null, hold null or non-finite components, or components that are no longer finite times 256, take no part, nor do rows
with a null vec_id. Vectors of different lengths are compared on the components that both have; an empty vector scores 0.
Scores beyond a long are ranked exactly and shown as the nearest long. Columns of other names are not read. Empty tables
give no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import ensure_checkpoint_dir

SCALE, K, EVERY = 256, 5, 50
SAMPLE, PIVOTS, BANDS = 4096, 16, 16
SEGMENT_ROWS, ANNULUS_ROWS, QUERY_BLOCK = 20_000, 1024, 512
#: Above this squared norm float sums of integer products may round.
EXACT_NORM = 2.0**53
_SLACK = 1e-6
_LEAST, _MOST = -(2**63), 2**63 - 1
#: What a segment tells of a query and a candidate; ``key`` orders scores of any size as bytes.
_FOUND = {"query_id": pa.int64(), "copies": pa.int64(), "q": pa.binary(), "vec_id": pa.int64(), "m": pa.int64(), "key": pa.binary(), "score": pa.int64()}


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, filled up with zeros to one width."""
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(float)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def spread_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first pick of up to n rows."""
    if not len(sample):
        return sample
    picked = [0]
    far = ((sample - sample[0]) ** 2).sum(axis=1)
    while len(picked) < n and far.max() > 0:
        picked.append(int(far.argmax()))
        far = np.minimum(far, ((sample - sample[picked[-1]]) ** 2).sum(axis=1))
    return sample[picked]


def exact_product(a: np.ndarray, b: np.ndarray) -> int:
    """Inner product in whole numbers of any size."""
    return sum(int(x) * int(y) for x, y in zip(a, b, strict=True))


class PivotIndex:
    """Pivots, bands and the scale of the float arithmetic; small, sent with the tasks."""

    def __init__(self, sample: np.ndarray, ids: np.ndarray, largest: float, k: int):
        # a power of two keeps every component's digits and the squared norms finite
        self.unit = 2.0 ** -max(0, math.frexp(largest)[1] - 300)
        self.width, self.k = sample.shape[1], k
        self.sample, self.sample_ids = sample, ids
        self.norm = 0.0

    def fit(self, top_norm: float, pivots: int = PIVOTS, bands: int = BANDS) -> PivotIndex:
        """Pivots and the bands' inner edges from the sample; ``top_norm``: the largest squared norm of all vectors."""
        self.norm = top_norm
        lifted = self.lift(self.sample)
        self.pivots = spread_pivots(lifted, pivots)
        cell, far = self.place(self.sample)
        self.edges = [np.unique(np.quantile(far[cell == p], np.linspace(0, 1, bands + 1)[1:-1])) if (cell == p).any() else np.empty(0) for p in range(len(self.pivots))]
        return self

    @property
    def exact(self) -> bool:
        return self.unit == 1.0 and self.norm < EXACT_NORM

    def error(self, norms: np.ndarray) -> np.ndarray:
        """Bound on the rounding of products of queries of these squared norms with any vector."""
        return 0.0 * norms if self.exact else (self.width + 2) * 2.0**-51 * np.sqrt(norms * self.norm) + 2.0**-1000

    def lift(self, x: np.ndarray) -> np.ndarray:
        x = x * self.unit
        return np.column_stack([x, np.sqrt(np.maximum(0.0, self.norm - (x**2).sum(axis=1)))])

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest pivot of each candidate and the distance to it."""
        y = self.lift(x)
        far = np.sqrt(np.maximum(0.0, (y**2).sum(axis=1)[:, None] + (self.pivots**2).sum(axis=1) - 2 * y @ self.pivots.T))
        cell = far.argmin(axis=1)
        return cell, far[np.arange(len(x)), cell]

    def band(self, cell: np.ndarray, far: np.ndarray) -> np.ndarray:
        out = np.zeros(len(cell), np.int64)
        for p in range(len(self.pivots)):
            out[cell == p] = np.searchsorted(self.edges[p], far[cell == p], side="right")
        return out

    def query_far(self, q: np.ndarray) -> np.ndarray:
        """Distance of each query, which is not lifted, to each pivot."""
        y = q * self.unit
        return np.sqrt(np.maximum(0.0, (y**2).sum(axis=1)[:, None] + (self.pivots**2).sum(axis=1) - 2 * y @ self.pivots[:, :-1].T))

    def reach(self, q: np.ndarray, best: np.ndarray) -> np.ndarray:
        """How far from a query a candidate may be that scores ``best`` (in scaled units) or more."""
        norm = ((q * self.unit) ** 2).sum(axis=1)
        return np.sqrt(np.maximum(0.0, norm + self.norm - 2 * (best - self.error(norm)))) * (1 + _SLACK) + _SLACK * (1 + math.sqrt(self.norm))

    def sure_score(self, q: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """A score that the k-th best of each query at least has: its k-th best in the sample, rows of its own id left out."""
        s = (q * self.unit) @ (self.sample * self.unit).T
        s[ids[:, None] == self.sample_ids[None, :]] = -np.inf
        return -np.partition(-s, self.k - 1, axis=1)[:, self.k - 1] if s.shape[1] >= self.k else np.full(len(q), -np.inf)


def search_segment(index: PivotIndex, q: np.ndarray, q_ids: np.ndarray, q_best: np.ndarray, pivot: int, c: np.ndarray, c_ids: np.ndarray, c_n: np.ndarray, c_far: np.ndarray):
    """Top k of one segment for a block of queries; candidates sorted by distance to the segment's pivot.

    Returns (query row, candidate row, number of rows, exact score) of each query's k best distinct candidates. Annuli are
    visited by their bound; a query whose k-th score can't be beaten any more drops out of the next products, and the
    search ends when that holds for all.
    """
    k = index.k
    cuts = [*range(0, len(c), ANNULUS_ROWS), len(c)]
    lo, hi = c_far[cuts[:-1]], c_far[np.array(cuts[1:]) - 1]
    q_far = index.query_far(q)[:, pivot]
    bound = np.maximum(0.0, np.maximum(lo[None, :] - q_far[:, None], q_far[:, None] - hi[None, :]))
    x, y = q * index.unit, c * index.unit
    error = 2 * index.error((x**2).sum(axis=1))
    kth = q_best.copy()
    held = [([], []) for _ in q]  # scores and places that may still be among the k best
    for step in np.argsort(bound.min(axis=0), kind="stable"):
        a, b = cuts[step], cuts[step + 1]
        reach = index.reach(q, kth)
        if bound[:, step].min() > reach.max():
            break  # later annuli are farther from every query
        live = np.flatnonzero(bound[:, step] <= reach)
        if not len(live):
            continue
        s = x[live] @ y[a:b].T
        # a query's own row is no candidate; where the row occurs again, the others are
        for i, j in zip(*np.nonzero(q_ids[live][:, None] == c_ids[a:b][None, :]), strict=True):
            if c_n[a + j] == 1 and np.array_equal(q[live[i]], c[a + j]):
                s[i, j] = -np.inf
        for i, row in enumerate(live):
            near = np.flatnonzero((s[i] >= kth[row] - error[row]) & (s[i] > -np.inf))
            if not len(near):
                continue
            score, place = np.append(held[row][0], s[i, near]), np.append(held[row][1], a + near).astype(np.int64)
            if len(score) > k:
                kth[row] = max(kth[row], -np.partition(-score, k - 1)[k - 1])
                keep = score >= kth[row] - error[row]
                score, place = score[keep], place[keep]
            if len(score) > 4 * k and index.exact:  # many ties at the k-th place: the smaller ids are enough
                keep = np.lexsort((c_ids[place], -score))[:k]
                score, place = score[keep], place[keep]
            held[row] = (score, place)
    out: list[tuple[int, int, int, int]] = []
    for row, (score, place) in enumerate(held):
        exact = [int(v) for v in score] if index.exact else [exact_product(q[row], c[p]) for p in place]
        for s, p in sorted(zip(exact, place, strict=True), key=lambda t: (-t[0], c_ids[t[1]]))[:k]:
            own = q_ids[row] == c_ids[p] and np.array_equal(q[row], c[p])
            out.append((row, int(p), int(c_n[p]) - int(own), s))
    return out


def top_inner_products(vectors: DataFrame, k: int = K, every: int = EVERY, vec_id: str = "vec_id", embedding: str = "embedding", segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score of each query row (vec_id divisible by ``every``) against every other row."""
    spark = vectors.sparkSession
    ensure_checkpoint_dir(spark)
    part = F.transform(F.col(embedding), lambda x: x.cast("double") * SCALE)
    rows = vectors.where(F.col(vec_id).isNotNull() & F.col(embedding).isNotNull()).select(F.col(vec_id).cast("long").alias("id"), part.alias("v"))
    rows = rows.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))

    def floored(batches):
        for b in batches:
            at = b.column(1)
            flat = np.floor(at.flatten().to_numpy(zero_copy_only=False).astype(float)) + 0.0  # no negative zero: equal vectors are equal
            ends = np.concatenate([[0], np.cumsum(at.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=["id", "v"])

    # equal rows are combined before they move; the table is read again below, so it is written once
    rows = rows.mapInArrow(floored, "id long, v array<double>").groupBy("id", "v").agg(F.count("*").alias("n")).checkpoint()
    n, width, largest = rows.agg(F.count("*"), F.max(F.size("v")), F.max(F.coalesce(F.array_max(F.transform("v", F.abs)), F.lit(0.0)))).first()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    sample = rows.orderBy(F.xxhash64("id", "v"), "id").limit(SAMPLE).select("id", "v").toArrow()
    index = PivotIndex(_matrix(sample["v"].combine_chunks(), width), sample["id"].to_numpy(), largest, k)
    unit = F.lit(index.unit)
    bands_each = max(1, min(BANDS, math.ceil(max(2 * spark.sparkContext.defaultParallelism, n / segment_rows) / PIVOTS)))
    index.fit(rows.agg(F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + (x * unit) * (x * unit)))).first()[0], bands=bands_each)

    def keyed(batches):
        for b in batches:
            cell, far = index.place(x := _matrix(b.column(1), width))
            yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(index.band(cell, far), pa.int32()), pa.array(far), b.column(0), pa.array([r.tobytes() for r in x], pa.binary()), b.column(2)], names=["cell", "band", "far", "id", "v", "n"])

    placed = rows.select("id", "v", "n").mapInArrow(keyed, "cell int, band int, far double, id long, v binary, n long").checkpoint()
    # PIVOTS * BANDS rows at most
    bands = [tuple(r) for r in placed.groupBy("cell", "band").agg(F.min("far"), F.max("far"), F.count("*")).orderBy("cell", "band").collect()]
    salts = [max(1, math.ceil(c / segment_rows)) for *_, c in bands]
    first = np.cumsum([0, *salts])
    of = {cell * BANDS + band: (int(s), m) for (cell, band, *_), s, m in zip(bands, first, salts, strict=False)}
    start, many = (F.array(*[F.lit(of.get(i, (0, 1))[j]) for i in range(PIVOTS * BANDS)]) for j in (0, 1))
    at = F.col("cell") * BANDS + F.col("band") + 1
    segments = placed.select((F.element_at(start, at) + F.pmod(F.xxhash64("id", "v"), F.element_at(many, at))).cast("int").alias("segment"), "cell", "far", "id", "v", "n")

    def routed(batches):
        # the queries of a block that may have a candidate in a band are one row a segment of it
        for b in batches:
            for a in range(0, b.num_rows, QUERY_BLOCK):
                block = b.slice(a, QUERY_BLOCK)
                q = np.frombuffer(b"".join(block.column(1).to_pylist()), float).reshape(block.num_rows, width)
                ids, copies = block.column(0).to_numpy(), block.column(2).to_numpy()
                sure = index.sure_score(q, ids)
                far, reach = index.query_far(q), index.reach(q, sure)
                for (cell, _, lo, hi, _), s, many_ in zip(bands, first, salts, strict=False):
                    near = np.flatnonzero(np.maximum(lo - far[:, cell], far[:, cell] - hi) <= reach)
                    if len(near):
                        for j in range(many_):
                            yield pa.RecordBatch.from_arrays([pa.array([int(s) + j], pa.int32()), *[pa.array([x[near].tobytes()], pa.binary()) for x in (ids, copies, sure, q)]], names=["segment", "ids", "copies", "sure", "q"])

    asked = placed.where(F.pmod("id", F.lit(every)) == 0).select("id", "v", "n").mapInArrow(routed, "segment int, ids binary, copies binary, sure binary, q binary")

    size = 64 if index.exact else 2304  # bits that hold any sum of products of doubles

    def search(segment: pa.Table, asking: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if segment.num_rows and asking.num_rows:
            far, ids = segment["far"].to_numpy(), segment["id"].to_numpy()
            order = np.lexsort((ids, far))
            c = np.frombuffer(b"".join(segment["v"].to_pylist()), float).reshape(len(ids), width)[order]
            c_n, pivot = segment["n"].to_numpy()[order], segment["cell"][0].as_py()
            for row in range(asking.num_rows):
                read = lambda name, t: np.frombuffer(asking[name][row].as_py(), t)  # noqa: B023, E731
                q_ids, copies = read("ids", np.int64), read("copies", np.int64)
                q = read("q", float).reshape(len(q_ids), width)
                for i, j, m, s in search_segment(index, q, q_ids, read("sure", float), pivot, c, ids[order], c_n, far[order]):
                    out.append((int(q_ids[i]), int(copies[i]), q[i].tobytes(), int(ids[order][j]), m, (s + (1 << size - 1)).to_bytes(size // 8, "big"), min(max(s, _LEAST), _MOST)))
        cols = list(zip(*out, strict=True)) or [[]] * len(_FOUND)
        return pa.table([pa.array(list(v), t) for v, t in zip(cols, _FOUND.values(), strict=True)], names=list(_FOUND))

    total = int(first[-1])
    near = segments.repartition(total, "segment").groupBy("segment").cogroup(asked.repartition(total, "segment").groupBy("segment")).applyInArrow(search, "query_id long, copies long, q binary, vec_id long, m long, key binary, score long")
    # equal query rows are one row here, told apart from others of their id by the vector's digest
    order = Window.partitionBy("query_id", F.md5("q")).orderBy(F.desc("key"), "vec_id")
    upto = F.sum("m").over(order.rowsBetween(Window.unboundedPreceding, 0))
    ranked = near.where("m > 0").withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("m")).where(F.col("before") < k)
    each = ranked.withColumn("rank", F.explode(F.sequence(F.col("before") + 1, F.least("upto", F.lit(k).cast("long")))))
    each = each.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return each.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
