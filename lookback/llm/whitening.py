"""Whitening of embeddings: leading eigenvectors by Jacobi-Davidson, matrix-free."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lookback.llm.common import staged

#: Entries are scaled, cut to whole numbers and moved by so much.
SCALE, SHIFT = 64, 1_000_000
#: Whole numbers beyond this (entries beyond 1.7e10) are held at it.
LIMIT = float(1 << 40)
#: Inner MINRES steps of a correction, and outer steps before giving up.
INNER, OUTER = 8, 200

Product = Callable[[np.ndarray], np.ndarray]


def scaled(vector: Column) -> Column:
    """Entries as whole numbers: ``floor(64 * c) + 1000000``, within ``LIMIT``."""
    return F.transform(
        vector,
        lambda c: F.floor(F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), c.cast("double") * F.lit(float(SCALE)))))
        + F.lit(SHIFT).cast("long"),
    )


def usable(vector: Column) -> Column:
    """Whether a vector is there with finite entries only."""
    bad = F.exists(
        vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == F.lit(float("inf")))
    )
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def correct(product: Product, theta: np.ndarray, ritz: np.ndarray, away: np.ndarray, residual: np.ndarray) -> np.ndarray:
    """Approximate solutions of the correction equations, one per column, by MINRES.

    ``(I - QQ')(V - theta)(I - QQ') t = -r`` with Q the locked vectors and the column's own
    Ritz vector. All columns take their steps together, so a step is one pass over the data.
    """

    def project(block: np.ndarray) -> np.ndarray:
        for _ in range(2):
            block = block - away @ (away.T @ block)
            block = block - ritz * (ritz * block).sum(axis=0)
        return block

    def norm(block: np.ndarray) -> np.ndarray:
        return np.sqrt((block * block).sum(axis=0))

    tiny = np.finfo(float).tiny
    v = project(-residual)
    beta = norm(v)
    start = np.maximum(beta, tiny)
    v_old, v = np.zeros_like(v), v / start
    x = np.zeros_like(v)
    w, w_old = np.zeros_like(v), np.zeros_like(v)
    c, c_old, s, s_old = (np.full_like(beta, k) for k in (1.0, 1.0, 0.0, 0.0))
    eta, beta_now = beta.copy(), np.zeros_like(beta)
    going = beta > tiny
    for _ in range(INNER):
        p = project(product(v)) - theta * v
        alpha = (v * p).sum(axis=0)
        p = project(p - alpha * v - beta_now * v_old)
        beta_next = norm(p)
        delta = c * alpha - c_old * s * beta_now
        rho1 = np.sqrt(delta**2 + beta_next**2)
        rho2 = s * alpha + c_old * c * beta_now
        rho3 = s_old * beta_now
        safe = np.where(rho1 > tiny, rho1, 1.0)
        c_old, c, s_old, s = c, np.where(rho1 > tiny, delta / safe, 1.0), s, np.where(rho1 > tiny, beta_next / safe, 0.0)
        w_old, w = w, (v - rho3 * w_old - rho2 * w) / safe
        going = going & (rho1 > tiny)
        x = x + np.where(going, c * eta, 0.0) * w
        eta = -s * eta
        going = going & (np.abs(eta) > 1e-3 * start)
        if not going.any():
            break
        v_old, v = v, p / np.maximum(beta_next, tiny)
        beta_now = beta_next
    return project(x)


def jacobi_davidson(product: Product, size: int, wanted: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric matrix and unit eigenvectors.

    ``product`` gives the matrix times a block of columns; nothing else is known of it.
    Each round takes the Ritz pairs of a subspace, locks the leading ones whose residuals
    are down to rounding (``size`` x 2^-50 of the largest eigenvalue), and widens the
    subspace by the corrections of the others. Ritz values stay in falling order, and a
    pair is locked only after all before it.
    """
    rng = np.random.default_rng(seed)
    widest = min(size, max(3 * wanted, wanted + 16))
    locked, values = np.zeros((size, 0)), []
    basis = np.linalg.qr(rng.standard_normal((size, min(size, wanted + 4))))[0]
    image = product(basis)
    least, since = np.inf, 0
    for _ in range(OUTER):
        small = basis.T @ image
        theta, inner = np.linalg.eigh((small + small.T) / 2)
        theta, inner = theta[::-1], inner[:, ::-1]
        ritz, applied = basis @ inner, image @ inner
        n = min(wanted - len(values), ritz.shape[1])
        residual = applied[:, :n] - ritz[:, :n] * theta[:n]
        # Locked directions are no part of what is left of the matrix.
        residual -= locked @ (locked.T @ residual)
        size_of = np.sqrt((residual**2).sum(axis=0))
        scale = max(abs(values[0]) if values else abs(theta[0]), np.finfo(float).tiny)
        within = size_of <= max(size, 16) * 2.0**-50 * scale
        least, since = (size_of.max(), 0) if size_of.max() < least / 2 else (least, since + 1)
        # The sums themselves round; what no longer falls and is at their level is done.
        if since > 4:
            within = within | (size_of <= 1e-12 * scale)
        done = int(np.argmin(np.append(within, False)))
        if done:
            locked = np.column_stack([locked, ritz[:, :done]])
            values += theta[:done].tolist()
            least = np.inf
        if len(values) == wanted:
            order = np.argsort(-np.array(values), kind="stable")
            return np.array(values)[order], locked[:, order]
        theta, ritz, applied, residual = theta[done:], ritz[:, done:], applied[:, done:], residual[:, done:n]
        if ritz.shape[1] + residual.shape[1] > widest:
            keep = min(ritz.shape[1], max(wanted - len(values), widest - residual.shape[1]))
            ritz, applied = ritz[:, :keep], applied[:, :keep]
        room = size - len(values) - ritz.shape[1]
        basis, image = ritz, applied
        if room > 0:
            m = min(residual.shape[1], room)
            step = correct(product, theta[:m], ritz[:, :m], locked, residual[:, :m])
            fresh = _new_directions(step, np.column_stack([locked, basis]), rng)
            if fresh.shape[1]:
                basis, image = np.column_stack([basis, fresh]), np.column_stack([image, product(fresh)])
        else:
            # The subspace is everything: taken anew, its images lose their rounding.
            basis = np.linalg.qr(ritz - locked @ (locked.T @ ritz))[0]
            image = product(basis)
    raise RuntimeError(f"{wanted - len(values)} eigenvectors did not converge")


def _new_directions(step: np.ndarray, against: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """An orthonormal block that spans ``step`` beyond ``against``; noise where it adds none."""
    out = np.zeros((len(step), 0))
    for column in step.T:
        for attempt in range(2):
            size = np.linalg.norm(column)
            vector = column / size if size > 0 else rng.standard_normal(len(column))
            for _ in range(3):
                vector = vector - against @ (against.T @ vector)
                vector = vector - out @ (out.T @ vector)
            left = np.linalg.norm(vector)
            if left > 1e-8:
                out = np.column_stack([out, vector / left])
                break
            column = rng.standard_normal(len(column))
    return out


def _blocks(batch: pa.Array, size: int) -> np.ndarray:
    return batch.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _summed(rows: DataFrame, part: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Sum over all rows of what ``part`` gives for a block of vectors, flat.

    Each task adds up its own; Spark adds the tasks' entries by place before the driver
    gets them, one number per place whatever the number of tasks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                one = part(_blocks(batch.column(0), size)).ravel()
                total = one if total is None else total + one
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["v"])

    tasks = rows.select("x").mapInArrow(run, "v array<double>")
    sums = tasks.select(F.posexplode("v").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v"))
    got = sorted((r["at"], r["v"]) for r in sums.collect())
    return np.array([v for _, v in got])


def whitened(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", wanted: int = 32) -> DataFrame:
    """Vectors on the leading principal axes, scaled to unit variance.

    Entries become whole numbers x (``scaled``). The covariance V of all x (divisor n,
    centred before multiplying) is never formed: its products with blocks of columns are
    passes over the rows. Returns per row and component (numbered from 1 by falling
    eigenvalue e): ``id_col``, ``component``, ``n``, ``deviation`` (sum over dimensions of
    (n x - S)^2, exact; null where a long cannot hold it), ``whitened`` (x - S/n on the
    component, over sqrt(e)), ``explained`` (e over the trace), ``identity_error`` (largest
    absolute entry of the covariance of ``whitened`` minus the identity).

    Vectors that are null or hold null or non-finite entries are dropped, and so are those
    of another length than most (of equally frequent lengths the longer counts). Rows with
    null or repeated ids stay rows of their own. Components end where eigenvalues are
    rounding errors of the first, so equal vectors, and no vectors, give no rows.
    """
    kind = vectors.schema[id_col].dataType.simpleString()
    rows = vectors.where(usable(F.col(vector_col))).select(F.col(id_col).alias("id"), scaled(F.col(vector_col)).alias("x"))
    rows = staged(rows, "whiten-rows")
    lengths = rows.groupBy(F.array_size("x").alias("size")).agg(F.count("*").alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("size")).first()
    schema = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    empty = vectors.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id_col)
    if most is None or not most["size"]:
        return empty
    size, n = most["size"], most["n"]
    rows = rows.where(F.array_size("x") == size)
    sums = _exact_sums(rows, size)
    centred = _centring(n, sums)
    trace = _summed(rows, lambda x: np.array([(centred(x) ** 2).sum()]), size)[0] / n

    def product(block: np.ndarray) -> np.ndarray:
        def part(x: np.ndarray) -> np.ndarray:
            y = centred(x)
            return y.T @ (y @ block)

        return _summed(rows, part, size).reshape(size, -1) / n

    if not trace > 0:
        return empty
    values, axes = jacobi_davidson(product, size, min(wanted, size))
    some = values > max(size, 16) * 2.0**-48 * values[0]
    values, axes = values[some], axes[:, some]
    onto = axes / np.sqrt(values)

    def second(x: np.ndarray) -> np.ndarray:
        z = centred(x) @ onto
        return np.concatenate([z.sum(axis=0), (z.T @ z).ravel()])

    moments = _summed(rows, second, size) / n
    mean, square = moments[: len(values)], moments[len(values) :].reshape(len(values), -1)
    error = float(np.abs(square - np.outer(mean, mean) - np.eye(len(values))).max())
    explained = values / trace
    exact = _deviations(n, sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(explained)
        for batch in batches:
            for start in range(0, batch.num_rows, 2_000):
                part = batch.slice(start, 2_000)
                x = _blocks(part.column(1), size)
                every = np.repeat(np.arange(len(x)), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(every)),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(len(every), n)),
                        pa.array(exact(x), pa.int64()).take(pa.array(every)),
                        pa.array((centred(x) @ onto).ravel()),
                        pa.array(np.tile(explained, len(x))),
                        pa.array(np.full(len(every), error)),
                    ],
                    names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.select("id", "x").mapInArrow(run, schema).withColumnRenamed("id", id_col)


def _exact_sums(rows: DataFrame, size: int) -> list[int]:
    """Per-dimension sums, exact: batches add up longs, Spark their sums as decimals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                total = _blocks(batch.column(0), size).sum(axis=0, dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.int64()))], names=["v"])

    tasks = rows.select("x").mapInArrow(run, "v array<long>")
    exact = F.sum(F.col("v").cast("decimal(38,0)")).alias("v")
    sums = tasks.select(F.posexplode("v").alias("at", "v")).groupBy("at").agg(exact)
    return [int(v) for _, v in sorted((r["at"], r["v"]) for r in sums.collect())]


def _centring(n: int, sums: list[int]) -> Callable[[np.ndarray], np.ndarray]:
    """x - S/n as doubles: the whole part of the mean leaves exactly, then its rest."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s % n) / n for s in sums])
    return lambda x: (x - whole).astype(float) - rest


def _deviations(n: int, sums: list[int]) -> Callable[[np.ndarray], list[int | None]]:
    """Sum over dimensions of (n x - S)^2 in whole numbers, as n (x - m) - r with m the mean's whole part.

    Longs hold it as long as n times the distance does; beyond, whole numbers of any size.
    """
    whole = np.array([s // n for s in sums], np.int64)
    rest = [s % n for s in sums]
    top = (1 << 63) - 1

    def run(x: np.ndarray) -> list[int | None]:
        away = x - whole
        if (int(np.abs(away).max(initial=0)) + 1) ** 2 * n * n * x.shape[1] <= top:
            return ((n * away - np.array(rest, np.int64)) ** 2).sum(axis=1).tolist()
        exact = (n * away.astype(object) - np.array(rest, object)) ** 2
        return [int(v) if v <= top else None for v in exact.sum(axis=1)]

    return run
