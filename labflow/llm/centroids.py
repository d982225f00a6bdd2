"""k-means on integers: exact centroids, distances from scalar lookup tables.

Vectors are turned into integers once and staged in packed batches: for every dimension the values that occur in the batch, and
for every vector the places of its values among them.  A round tabulates, for each dimension, the squared difference of every
occurring value to every centroid; a vector's distances are then one table row per dimension, gathered and added up by NumPy.
A task returns sums per centroid and dimension, so what a round shuffles and brings to the driver is k times the dimensions.

Defined cases: only vectors with exactly ``dims`` components, none null or not finite, take part; of these, a vector with an
integer component beyond 2 ** 27 has distances that a long can't hold and stays out too.  Repeated rows count each; with fewer
than k vectors there are as many centroids as vectors; a null id's hash is that of no digits; no vector gives an empty result.
An inertia that a long can't hold is null.  Other columns don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pack, stage, table, unpack

#: Vectors in a batch: places fit 16 bits, and a dimension's table has at most so many rows.
BATCH = 32_768
MOST = 1 << 27


def integers(column: pa.Array, dims: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows of a list column take part, and floor(scale * x) of their components."""
    column = column.cast(pa.large_list(pa.float64()))
    length = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(length == dims)
    flat = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), dims)
    with np.errstate(invalid="ignore", over="ignore"):
        whole = np.floor(flat * scale)
    good = (np.abs(whole) <= MOST).all(axis=1)  # false for what isn't a number
    return rows[good], whole[good].astype(np.int64)


def encode(vectors: DataFrame, dims: int, scale: int, id_: str, embedding: str) -> DataFrame:
    """ids, values: one packed row per batch of vectors that take part."""

    def packed(ids: pa.Array, whole: np.ndarray) -> pa.RecordBatch:
        out = []
        for d in range(dims):
            values, place = np.unique(whole[:, d], return_inverse=True)
            out += [values, place.astype(np.uint16)]
        return pa.RecordBatch.from_arrays([pa.array([ids.to_pylist()], pa.list_(pa.int64())), pa.array([pack(*_grouped(out))], pa.binary())], ["ids", "payload"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held, n = [], [], 0
        for b in batches:
            rows, whole = integers(b.column(embedding), dims, scale)
            for at in range(0, len(rows), BATCH):
                part = rows[at : at + BATCH]
                if n and n + len(part) > BATCH:
                    yield packed(pa.concat_arrays(ids), np.concatenate(held))
                    ids, held, n = [], [], 0
                ids.append(b.column(id_).cast(pa.int64()).take(pa.array(part)))
                held.append(whole[at : at + BATCH])
                n += len(part)
        if n:
            yield packed(pa.concat_arrays(ids), np.concatenate(held))

    return stage(vectors.select(id_, embedding).mapInArrow(task, "ids array<long>, payload binary"), "centroid-codes")


def _grouped(pairs: list[np.ndarray]) -> list[np.ndarray]:
    """Values of all dimensions end to end, how many each has, and all places: three arrays for ``pack``."""
    values, places = pairs[::2], pairs[1::2]
    return [np.concatenate(values), np.array([len(v) for v in values], np.uint32), np.concatenate(places)]


def _opened(payload: bytes) -> tuple[list[np.ndarray], np.ndarray]:
    """A batch's occurring values by dimension, and the places (dimension, vector)."""
    values, size, places = unpack(payload)
    return np.split(values, np.cumsum(size)[:-1]), places.reshape(len(size), -1)


def distances(values: list[np.ndarray], places: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances (vector, centroid): per dimension a table of its occurring values, gathered and added."""
    out = np.zeros((places.shape[1], len(centroids)), np.int64)
    for d, occurring in enumerate(values):
        lookup = (occurring[:, None] - centroids[None, :, d]) ** 2
        out += lookup[places[d]]
    return out


def first_centroids(vectors: DataFrame, k: int, dims: int, scale: int, seed: int, id_: str, embedding: str) -> np.ndarray:
    """The k vectors with the least hash of their id, as integers; ties by the vector itself."""
    n = F.col(embedding)
    fits = F.coalesce((F.size(n) == dims) & F.forall(n, lambda x: x.isNotNull() & (x.cast("double") * scale >= -MOST) & (x.cast("double") * scale < MOST + 1)), F.lit(False))
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_).cast("string"), F.lit(""))).cast("binary"), 256)
    rows = vectors.filter(fits).select(key.alias("key"), F.transform(n, lambda x: F.floor(x.cast("double") * scale)).alias("v")).orderBy("key", "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64).reshape(len(rows), dims)


def moved(codes: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: each the floor of its vectors' mean, exactly; empty ones stay."""
    k, dims = centroids.shape

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for b in batches:
            for payload in b.column("payload"):
                values, places = _opened(payload.as_py())
                own = distances(values, places, centroids).argmin(axis=1)
                count += np.bincount(own, minlength=k)
                for d, occurring in enumerate(values):
                    for c in range(k):
                        total[c, d] += occurring @ np.bincount(places[d][own == c], minlength=len(occurring))
        c, d = np.indices((k, dims))
        yield pa.RecordBatch.from_arrays([pa.array(c.ravel().astype(np.int32)), pa.array(d.ravel().astype(np.int32)), pa.array(total.ravel()), pa.array(np.repeat(count, dims))], ["cluster", "dim", "total", "n"])

    sums = codes.select("payload").mapInArrow(task, "cluster int, dim int, total long, n long").groupBy("cluster", "dim").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect()
    out = centroids.copy()
    for r in sums:  # k times dims rows
        if r["n"]:
            out[r["cluster"], r["dim"]] = r["total"] // r["n"]
    return out


def assigned(codes: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster, distance of every vector."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, payload in zip(b.column("ids"), b.column("payload"), strict=True):
                found = distances(*_opened(payload.as_py()), centroids)
                own = found.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([ids.values, pa.array(own.astype(np.int32)), pa.array(found[np.arange(len(own)), own])], ["vec_id", "cluster", "distance"])

    return codes.mapInArrow(task, "vec_id long, cluster int, distance long")


def cluster(vectors: DataFrame, *, k: int = 8, dims: int = 64, scale: int = 1024, rounds: int = 10, seed: int = 3, id_: str = "vec_id", embedding: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """vec_id, cluster, distance of every vector that takes part, and the final centroids."""
    codes = encode(vectors, dims, scale, id_, embedding)
    centroids = first_centroids(vectors, k, dims, scale, seed, id_, embedding)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(codes, centroids)
    if not len(centroids):
        return codes.sparkSession.createDataFrame([], "vec_id long, cluster int, distance long"), centroids
    return stage(assigned(codes, centroids), "centroid-clusters"), centroids


def report(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Each vector beside its cluster's inertia, the whole inertia and its centroid's digest."""
    own = found.groupBy("cluster").agg(F.try_sum("distance").alias("cluster_inertia")).collect()  # a row per centroid
    sums = {r["cluster"]: r["cluster_inertia"] for r in own}
    whole = sum(sums.values()) if all(v is not None for v in sums.values()) else None
    whole = whole if whole is not None and whole < 1 << 63 else None
    rows = [(c, sums.get(c), whole, hashlib.sha256(",".join(map(str, v)).encode()).hexdigest()) for c, v in enumerate(centroids.tolist())]
    told = found.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(told), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op13_centroids(spark, sf_dir: str) -> DataFrame:
    """Eight clusters of all vectors of 64 components, in ten rounds."""
    return report(*cluster(table(spark, sf_dir, "embeddings")))


def centroid_sql(k: int = 8, dims: int = 64, scale: int = 1024, rounds: int = 10, seed: int = 3) -> str:
    """The same in SQL, one step per round."""
    near = "SELECT i, v, arg_min(c, (d, c)) AS c, min(d) AS d FROM (SELECT i, v, c, list_sum(list_transform(range(1, {n}), lambda j: (v[j] - w[j]) * (v[j] - w[j])))::BIGINT AS d FROM x, {w}) GROUP BY i, v"
    steps = []
    for r in range(rounds):
        mean = "((s - ((s % n) + n) % n) // n)::BIGINT"
        steps.append(f"n{r} AS MATERIALIZED ({near.format(n=dims + 1, w=f'c{r}')}), m{r} AS (SELECT c, j, {mean} AS m FROM (SELECT c, j, sum(v[j]) AS s, count(*)::HUGEINT AS n FROM n{r}, (SELECT unnest(range(1, {dims + 1})) AS j) GROUP BY c, j)), c{r + 1} AS MATERIALIZED (SELECT c{r}.c, coalesce(any_value(u.w), c{r}.w) AS w FROM c{r} LEFT JOIN (SELECT c, list(m ORDER BY j) AS w FROM m{r} GROUP BY c) u ON u.c = c{r}.c GROUP BY c{r}.c, c{r}.w)")
    return f"""WITH e AS (SELECT row_number() OVER () AS i, vec_id, embedding FROM embeddings WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x::DOUBLE * {scale} >= -{MOST} AND x::DOUBLE * {scale} < {MOST + 1})) = {dims}),
 x AS MATERIALIZED (SELECT i, vec_id, list_transform(embedding, lambda y: floor({scale} * y::DOUBLE)::BIGINT) AS v FROM e), c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v AS w FROM (SELECT sha256('{seed}:' || coalesce(vec_id::VARCHAR, '')) AS h, v FROM x ORDER BY h, v LIMIT {k})),
 {", ".join(steps)}, z AS MATERIALIZED ({near.format(n=dims + 1, w=f"c{rounds}")})
 SELECT vec_id, z.c::INT AS cluster, d AS distance, (sum(d) OVER (PARTITION BY z.c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(w, ',')) AS centroid_sha256 FROM z JOIN x USING (i) JOIN c{rounds} ON c{rounds}.c = z.c"""
