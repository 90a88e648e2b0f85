"""Operator 13, embedding whitening by QDWH spectral divide and conquer.

The fit takes two passes: exact integer sums by dimension, then the covariance of
the centred vectors, summed over tasks by (i, j). Its eigenvectors come from
polar decompositions: U of ``V - shift * I = U H`` (QDWH iteration: dynamically
weighted Halley steps by QR) has eigenvalue 1 above the shift and -1 below, so
``(I + U) / 2`` and ``(I - U) / 2`` project on two invariant subspaces. The matrix
is restricted to each and split again until single components are left. Mean and
whitening matrix, d x k numbers, are broadcast; every vector is projected in one
pass. Only d x d numbers ever reach the driver.

Defined cases: rows whose vector is null, empty or holds null or non-finite
entries, or entries beyond ``LIMIT`` (no exact long), are not part of fit or
result; of vectors of several lengths those of the most frequent one are (of
equally frequent ones the longest). Null vec_ids stay, repeated rows count and
are returned one by one. Components without variance (eigenvalue at most
d * 2^-52 of the trace) can't be whitened and are left out, so equal vectors and
an empty table give an empty result. A deviation beyond a long is null. Other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbflow.llm.common import Shared, written

LIMIT = float(2 ** 40)
EPS = np.finfo(float).eps
LONG = 2 ** 63


# -- spectral divide and conquer -------------------------------------------------------------------------------

def polar_factor(a: np.ndarray, most: int = 30) -> np.ndarray:
    """Orthogonal factor of a symmetric matrix by the QDWH iteration (inverse-free, by QR)."""
    n = len(a)
    scale = np.linalg.norm(a)               # at least the largest singular value
    if scale == 0:
        return np.eye(n)
    x, low, eye = a / scale, EPS, np.eye(n)
    for _ in range(most):
        d = np.cbrt(4 * (1 - low ** 2) / low ** 4)
        wa = np.sqrt(1 + d) + 0.5 * np.sqrt(8 - 4 * d + 8 * (2 - low ** 2) / (low ** 2 * np.sqrt(1 + d)))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q, _r = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))
        new = (wb / wc) * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        new = (new + new.T) / 2
        moved = np.linalg.norm(new - x)
        x, low = new, min(1.0, low * (wa + wb * low ** 2) / (1 + wc * low ** 2))
        if moved <= np.cbrt(4 * EPS) and 1 - low <= 10 * EPS:
            break
    return x


def _range(p: np.ndarray, rank: int, rng) -> np.ndarray:
    """Orthonormal basis of a projector's range: its product with a random matrix, once more to clean it."""
    q, _ = np.linalg.qr(p @ rng.standard_normal((len(p), rank)))
    q, _ = np.linalg.qr(p @ q)
    return q


def _split(a: np.ndarray, size: float, rng):
    """(basis, rank): an orthogonal basis whose first ``rank`` columns span the subspace above some shift."""
    n, diag = len(a), np.sort(np.diag(a))
    mean = diag.mean()                      # between the least and the largest eigenvalue unless all are equal
    spread = max(diag[-1] - diag[0], np.linalg.norm(a - mean * np.eye(n)) / np.sqrt(n))
    shifts = [np.median(diag), mean, *(mean + spread * f for f in (0.11, -0.13, 0.29, -0.31, 0.53, -0.57, 0.89, -0.97))]
    best = None
    for shift in shifts:
        u = polar_factor(a - shift * np.eye(n))
        rank = int(round((np.trace(u) + n) / 2))
        if not 0 < rank < n:
            continue
        above, below = (np.eye(n) + u) / 2, (np.eye(n) - u) / 2
        q, _ = np.linalg.qr(np.hstack([_range(above, rank, rng), _range(below, n - rank, rng)]))
        left = np.linalg.norm((q.T @ a @ q)[:rank, rank:])
        if best is None or left < best[0]:
            best = left, q, rank
        if left <= 20 * n * EPS * size:
            break
    return best


def spectral_components(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors as columns) of a symmetric matrix by falling eigenvalue.

    The largest entry of every eigenvector is positive.
    """
    v = (v + v.T) / 2
    size, rng, done = np.linalg.norm(v), np.random.default_rng(13), []
    todo = [(v, np.eye(len(v)))]
    while todo:
        a, basis = todo.pop()
        n = len(a)
        rest = np.linalg.norm(a - np.diag(np.diag(a)))
        found = None if n == 1 or rest <= 4 * EPS * size else _split(a, size, rng)
        if found is None:                   # one component, or all eigenvalues are one to double precision
            done += [(a[i, i], basis[:, i]) for i in range(n)]
            continue
        _, q, rank = found
        for part in (q[:, :rank], q[:, rank:]):
            b = part.T @ a @ part
            todo.append(((b + b.T) / 2, basis @ part))
    q, _ = np.linalg.qr(np.column_stack([u for _, u in sorted(done, key=lambda x: -x[0])]))
    values = np.einsum("ij,ij->j", q, v @ q)
    order = np.argsort(-values, kind="stable")
    q = q[:, order]
    q = q * np.where(q[np.argmax(np.abs(q), axis=0), np.arange(q.shape[1])] < 0, -1.0, 1.0)
    return values[order], q


# -- passes over the vectors -----------------------------------------------------------------------------------

def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, c): rows whose vector is whole, as doubles."""
    c = F.col(vec_col)
    fine = F.forall(c, lambda e: F.coalesce(F.abs(e.cast("double")) < F.lit(LIMIT), F.lit(False)))
    return vectors.where(c.isNotNull() & fine & (F.size(c) > 0)).select(
        F.col(id_col).alias("vec_id"), c.cast("array<double>").alias("c"))


def matrix_of(batch: pa.RecordBatch, name: str, d: int) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def scaled(batch: pa.RecordBatch, d: int) -> np.ndarray:
    return np.floor(1024 * matrix_of(batch, "c", d)).astype(np.int64) + 100_000


def column_sums(rows: DataFrame, d: int) -> list:
    """[(n, sum, least, largest)] of x by dimension, exact."""
    def part(batches):
        n, s, low, high = 0, [0] * d, None, None
        for b in batches:
            if b.num_rows:
                x = scaled(b, d)
                n += len(x)
                s = [p + int(q) for p, q in zip(s, x.sum(axis=0))]
                low = x.min(axis=0) if low is None else np.minimum(low, x.min(axis=0))
                high = x.max(axis=0) if high is None else np.maximum(high, x.max(axis=0))
        if n:
            yield pa.RecordBatch.from_pydict({"i": pa.array(range(d), pa.int32()), "n": pa.array([n] * d, pa.int64()),
                                              "s": pa.array([str(v) for v in s]),
                                              "low": pa.array(low), "high": pa.array(high)})
    sums = rows.select("c").mapInArrow(part, "i int, n long, s string, low long, high long").groupBy("i").agg(
        F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.min("low").alias("low"), F.max("high").alias("high"))
    return [(r["n"], int(r["s"]), r["low"], r["high"]) for r in sorted(sums.collect(), key=lambda r: r["i"])]


def gram(rows: DataFrame, d: int, centred) -> np.ndarray:
    """Sum over the rows of the outer products of ``centred(batch)``; partial sums by task, added by (i, j)."""
    def part(batches):
        total = np.zeros((d, d))
        for b in batches:
            if b.num_rows:
                y = centred(b)
                total += y.T @ y
        i, j = np.triu_indices(d)
        yield pa.RecordBatch.from_pydict({"i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()), "v": pa.array(total[i, j])})
    sums = rows.mapInArrow(part, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    out = np.zeros((d, d))
    for r in sums:
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["v"]
    return out


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = 8) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for every usable row and component."""
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], f"vec_id {dict(vectors.dtypes)[id_col]}, component int, n long, deviation long, "
                                      "whitened double, explained double, identity_error double")
    rows = usable(vectors, id_col, vec_col)
    lengths = rows.groupBy(F.size("c").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not lengths:
        return empty
    d = lengths[0]["d"]
    rows = rows.where(F.size("c") == d)
    sums = column_sums(rows, d)
    n, s = sums[0][0], [x[1] for x in sums]
    mean = np.array([float(v) / n for v in s])
    v = gram(rows.select("c"), d, lambda b: scaled(b, d) - mean) / n
    values, vecs = spectral_components(v)
    trace = float(np.trace(v))
    k = min(components, int((values > d * EPS * trace).sum()))
    if k == 0:
        return empty
    # Deviations in 64-bit integers where no dimension can leave them, else in Python's.
    far = [max(n * high - t, t - n * low) for (_, t, low, high) in sums]
    small = sum(x * x for x in far) < LONG and max(max(n * abs(x[2]), n * abs(x[3]), abs(x[1])) for x in sums) < LONG
    shared = Shared(spark, {"mean": mean, "to": vecs[:, :k] / np.sqrt(values[:k]), "s": s})

    def project(batches):
        fit = shared.value
        s64 = np.array(fit["s"], dtype=np.int64 if small else object)
        for b in batches:
            x = scaled(b, d)
            if small:
                deviation = pa.array(((n * x - s64) ** 2).sum(axis=1), pa.int64())
            else:
                exact = [sum((n * int(p) - t) ** 2 for p, t in zip(row, fit["s"])) for row in x]
                deviation = pa.array([e if e < LONG else None for e in exact], pa.int64())
            w = (x - fit["mean"]) @ fit["to"]
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), deviation, pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * k, w.ravel())],
                ["vec_id", "deviation", "w"])
    schema = f"vec_id {dict(rows.dtypes)['vec_id']}, deviation long, w array<double>"
    out = written(spark, rows.mapInArrow(project, schema), "whitened")
    means = [r["m"] for r in out.select(F.posexplode("w").alias("i", "x")).groupBy("i").agg(F.avg("x").alias("m")).orderBy("i").collect()]
    means = np.array(means)
    error = float(np.abs(gram(out.select("w"), k, lambda b: matrix_of(b, "w", k) - means) / n - np.eye(k)).max())
    explained = F.array(*[F.lit(float(e) / trace) for e in values[:k]])
    return out.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(explained, F.col("at") + 1).alias("explained"), F.lit(error).alias("identity_error"))


def whitening_query(vectors: DataFrame) -> DataFrame:
    return whiten(vectors)
