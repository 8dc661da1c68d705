"""Embedding whitening by Chebyshev-filtered subspace iteration (operator 11).

The leading eigenvectors of the covariance V of integer vectors x are found without forming V. A block of
k + `EXTRA` vectors Q is multiplied by V in a pass over the data, each task adding up (x - m)'((x - m) Q) of
its rows, m = S / n. A round runs a Chebyshev recurrence of such products, which damps the unwanted spectrum
[0, b] (b: the smallest Ritz value of the block) and magnifies the rest, then takes a QR factor and the
Rayleigh-Ritz vectors of the block. A leading vector is locked once |Vq - eq| <= `TOLERANCE` x the largest
eigenvalue; locked vectors are projected out, so the filter never has to bridge the whole spectrum. The degree
of the filter follows from the spread of what is left, so that no column drowns in another.

The vectors are written once as rows of eight-byte integers to the shared folder, in partitions of many rows;
passes read that table. Per pass a partition gives one row per dimension, added up by Spark; the driver gets
p x (k + `EXTRA`) numbers, p being the number of dimensions, whatever the number of rows. `MOST_PASSES` ends a
computation that does not converge with an error.

Defined results: rows whose vector is null, empty, or holds null or non-finite entries or entries beyond
+-2^42 are left out, and so are vectors that have not the commonest number of dimensions (of equally common
ones the largest). Repeated rows and null ids count like any other. Fewer than eight components come out where
there are fewer dimensions or where an eigenvalue is zero beside the largest (below p x 1e-13 of it): equal
vectors have none. `deviation` is null where it does not fit a long; `residual` is |Vq - eq| / e. An empty
table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from signalloom.llm.arrow import map_columns
from signalloom.session import cut_lineage

SCALE, SHIFT = 1024.0, 100_000
FARTHEST = float(1 << 52)
COMPONENTS = 8
EXTRA = 24
ROWS_PER_PARTITION = 1 << 18
TOLERANCE = 1e-13
SPREAD = 1e7
MOST_DEGREE = 16
MOST_PASSES = 2_000
OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, residual double"


def integers(df: DataFrame, id_: str, vector: str) -> DataFrame:
    """(vec_id, x): x as little-endian eight-byte integers, of the rows that are not left out."""
    def make(batch: pa.RecordBatch) -> Iterator[list]:
        ids, lists = batch.column(0), batch.column(1)
        values = pc.fill_null(lists.flatten(), float("nan")).to_numpy(zero_copy_only=False)
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        scaled = np.floor(values * SCALE)
        bad = np.concatenate(([0], np.cumsum(~(np.abs(scaled) < FARTHEST))))
        keep = (sizes > 0) & (bad[ends] == bad[ends - sizes])
        whole = np.where(np.abs(scaled) < FARTHEST, scaled, 0).astype("<i8") + SHIFT
        yield [ids.filter(pa.array(keep)), [whole[e - s : e].tobytes() for s, e in zip(sizes[keep].tolist(), ends[keep].tolist())]]

    return map_columns(df.select(F.col(id_).cast("long"), F.col(vector).cast("array<double>")), "vec_id long, x binary", make)


def rows_of(column: pa.Array, p: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<i8").reshape(-1, p)


def add_up(table: DataFrame, p: int, height: int, width: int, kind: str, make: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all rows of the height x width matrices that `make` gives for runs of rows."""
    names = [f"y{j}" for j in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = make(rows_of(batch.column(0), p))
                total = part if total is None else total + part
        if total is not None:
            columns = [pa.array(np.arange(height, dtype=np.int32)), *(pa.array(np.ascontiguousarray(total[:, j])) for j in range(width))]
            yield pa.RecordBatch.from_arrays(columns, names=["d", *names])

    parts = table.select("x").mapInArrow(run, ", ".join(["d int", *(f"{c} {kind}" for c in names)]))
    got = parts.groupBy("d").agg(*(F.sum(c).alias(c) for c in names)).collect()
    out = np.zeros((height, width), dtype=np.int64 if kind == "long" else np.float64)
    for r in got:
        out[r[0]] = r[1:]
    return out


def leading(multiply: Callable[[np.ndarray], np.ndarray], p: int, k: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Eigenvalues, unit eigenvectors and residual norms of the k largest eigenvalues of a symmetric
    semidefinite matrix of order p, given its product with a block."""
    m = min(p, k + EXTRA)
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(p, m)))[0]
    v = multiply(q)
    locked_q, locked_v, locked_e = np.zeros((p, 0)), np.zeros((p, 0)), np.zeros(0)
    passes, best, stuck = 1, np.inf, 0
    while True:
        h = q.T @ v
        e, u = np.linalg.eigh((h + h.T) / 2)
        e, u = e[::-1], u[:, ::-1]
        q, v = q @ u, v @ u
        if len(locked_e) and e[0] > locked_e[-1] * (1 + 1e-9):  # something larger came up: nothing is settled
            q, v = np.linalg.qr(np.hstack((locked_q, q)))[0], None
            v = multiply(q)
            passes += 1
            locked_q, locked_v, locked_e = np.zeros((p, 0)), np.zeros((p, 0)), np.zeros(0)
            best = np.inf
            continue
        top = max(locked_e[0] if len(locked_e) else e[0], 0.0)
        miss = np.linalg.norm(v - q * e, axis=0)
        wanted = k - len(locked_e)
        worst = miss[:wanted].max()
        stuck = stuck + 1 if worst > 0.5 * best else 0
        best = min(best, worst)
        floor = stuck >= 3 and worst <= 1e-10 * top  # rounding leaves no more
        settled = miss <= TOLERANCE * top
        count = wanted if floor or m == p or top == 0 else int(np.argmin(np.append(settled[:wanted], False)))
        locked_q, locked_v, locked_e = (np.concatenate(x, axis=-1) for x in ((locked_q, q[:, :count]), (locked_v, v[:, :count]), (locked_e, e[:count])))
        q, v, e = q[:, count:], v[:, count:], e[count:]
        if count:
            best, stuck = np.inf, 0
        if len(locked_e) == k:
            break
        if passes > MOST_PASSES:
            raise RuntimeError(f"no convergence after {passes} passes")
        half = max(e[-1], 1e-14 * top) / 2
        reach = max(e[0] / half - 1, 1.0 + 1e-12)
        growth = reach + np.sqrt(reach * reach - 1)
        degree = int(np.clip(np.log(SPREAD) / np.log(growth), 1, MOST_DEGREE))
        sigma = first = 1 / reach
        last, now = q, (v - half * q) * (sigma / half)
        for _ in range(degree - 1):
            now -= locked_q @ (locked_q.T @ now)
            following = 1 / (2 / first - sigma)
            last, now = now, (multiply(now) - half * now) * (2 * following / half) - sigma * following * last
            sigma = following
        for _ in range(2):
            now -= locked_q @ (locked_q.T @ now)
            now = np.linalg.qr(now)[0]
        q, v = now, multiply(now)
        passes += degree
    order = np.argsort(-locked_e, kind="stable")
    return locked_e[order], locked_q[:, order], np.linalg.norm(locked_v - locked_q * locked_e, axis=0)[order]


def deviations(x: np.ndarray, n: int, sums: list[int], most: int) -> list[int | None]:
    """Exact sums of (n x - S)^2 of each row; `most` bounds |n x - S|."""
    if most * most * x.shape[1] < 1 << 63:
        d = x * np.int64(n) - np.array(sums, dtype=np.int64)
        return (d * d).sum(axis=1).tolist()
    out = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x.tolist()]
    return [v if v < 1 << 63 else None for v in out]


def whiten(vectors: DataFrame, id_: str = "vec_id", vector: str = "embedding", k: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error, residual of each row and component."""
    spark = vectors.sparkSession
    narrow = integers(vectors, id_, vector)
    table = cut_lineage(narrow, "vectors")
    sizes = table.groupBy(F.octet_length("x").alias("bytes")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("bytes")).first()
    if sizes is None:
        return spark.createDataFrame([], OUT)
    p, n = sizes["bytes"] // 8, sizes["n"]
    # fewer, larger partitions without a shuffle: a pass costs a task's start per partition
    table = table.filter(F.octet_length("x") == 8 * p)
    parts = max(spark.sparkContext.defaultParallelism, -(-n // ROWS_PER_PARTITION))
    table = table.coalesce(parts)

    def whole(x: np.ndarray) -> np.ndarray:
        return x.sum(axis=0, dtype=np.int64)[:, None]

    sums = [int(s) for s in add_up(table, p, p, 1, "long", whole)[:, 0]]
    mean = np.array([s / n for s in sums])

    def squares(x: np.ndarray) -> np.ndarray:
        return ((x - mean) ** 2).sum(axis=0)[:, None]

    trace = float(add_up(table, p, p, 1, "double", squares).sum()) / n

    def multiply(q: np.ndarray) -> np.ndarray:
        def product(x: np.ndarray) -> np.ndarray:
            c = x - mean
            return c.T @ (c @ q)

        return add_up(table, p, p, q.shape[1], "double", product) / n

    e, q, miss = leading(multiply, p, min(k, p))
    real = e > max(e[0], 0.0) * p * 1e-13 if trace > 0 else np.zeros(len(e), dtype=bool)
    e, q, miss = e[real], q[:, real], miss[real]
    if not len(e):
        return spark.createDataFrame([], OUT)
    turn = q / np.sqrt(e)

    def gram(x: np.ndarray) -> np.ndarray:
        w = (x - mean) @ turn
        return np.hstack((w.T @ w, w.sum(axis=0)[:, None]))

    g = add_up(table, p, len(e), len(e) + 1, "double", gram) / n
    error = float(np.abs(g[:, :-1] - np.outer(g[:, -1], g[:, -1]) - np.eye(len(e))).max())
    explained, residual = (e / trace).tolist(), (miss / e).tolist()

    def make(batch: pa.RecordBatch) -> Iterator[list]:
        x = rows_of(batch.column("x"), p)
        if not len(x):
            return
        most = max(n * max(int(x.max()), -int(x.min())), max(map(abs, sums)))
        if most < 1 << 62:
            most = int(np.abs(x * np.int64(n) - np.array(sums, dtype=np.int64)).max())
        times = len(e)
        again = pa.array(np.repeat(np.arange(len(x)), times))
        yield [batch.column("vec_id").take(again), pa.array(np.tile(np.arange(1, times + 1, dtype=np.int32), len(x))), pa.array(np.full(len(x) * times, n)),
               pa.array(deviations(x, n, sums, most), type=pa.int64()).take(again), pa.array(((x - mean) @ turn).ravel()),
               pa.array(np.tile(explained, len(x))), pa.array(np.full(len(x) * times, error)), pa.array(np.tile(residual, len(x)))]

    return map_columns(table.select("vec_id", "x"), OUT, make)
