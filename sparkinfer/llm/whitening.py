"""Whitening of embeddings by a Jacobi-Davidson search that never forms the covariance."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkinfer.llm.common import fresh, stored

#: Scaled entries beyond this are no 64-bit numbers with room to spare; such rows are left out.
LARGEST = float(1 << 61)
#: Vectors searched besides the wanted ones, and MINRES steps of one correction.
GUARD, INNER = 4, 5
#: The basis starts anew from its best vectors beyond this multiple of the block.
BASIS = 5
#: Partial sums that may go to the driver from one product; more are summed in tasks first.
FEW = 64


def integral(vector: Column, scale: float, shift: int) -> Column:
    """``floor(scale * entry) + shift`` of every entry as long; null unless all entries are finite numbers."""
    fine = F.forall(vector, lambda c: c.isNotNull() & (F.lit(scale) * c.cast("double")).between(-LARGEST, LARGEST))
    entries = F.transform(vector, lambda c: F.floor(F.lit(scale) * c.cast("double")).cast("long") + F.lit(shift).cast("long"))
    return F.when(vector.isNotNull() & (F.size(vector) > 0) & fine, entries)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


class FitList:
    """Distinct integer vectors, stored once, with exact counts and sums; products pass over them in tasks."""

    def __init__(self, vectors: DataFrame, column: str, width: int, shift: int):
        self.width, self.shift = width, shift
        self.data = stored(vectors.select(F.col(column).alias("x")).distinct(), "whiten-fit")
        self.tasks = self.data.rdd.getNumPartitions()
        origin = shift

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, sums = 0, [0] * width
            for record in batches:
                x = _matrix(record.column(0), width) - origin
                n += len(x)
                high = float(np.abs(x.astype(np.float64)).max(initial=0.0)) * max(1, len(x))
                part = (x if high < LARGEST else x.astype(object)).sum(axis=0)
                sums = [s + int(p) for s, p in zip(sums, part, strict=True)]
            yield pa.RecordBatch.from_pydict({"n": [n], "sums": [[str(s) for s in sums]]})

        self.n, moved = 0, [0] * width
        # one row a task; many tasks are added up in groups of tasks first
        parts = self.data.mapInArrow(count, "n long, sums array<string>")
        if self.tasks > FEW:
            each = parts.select("n", F.posexplode("sums").alias("i", "s"))
            total = each.groupBy("i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
            self.n = total[0]["n"] if total else 0
            for r in total:
                moved[r["i"]] = int(r["s"])
        else:
            for r in parts.collect():
                self.n += r["n"]
                moved = [m + int(s) for m, s in zip(moved, r["sums"], strict=True)]
        self.moved = moved  # sums of x - shift
        # S / n is `shift` plus a whole part and a rest, so that centring loses nothing
        whole = [round(m / self.n) if self.n else 0 for m in moved]
        self.whole = np.array(whole, np.int64)
        self.rest = np.array([(m - w * self.n) / self.n if self.n else 0.0 for m, w in zip(moved, whole, strict=True)])

    @property
    def sums(self) -> list[int]:
        return [m + self.n * self.shift for m in self.moved]

    def centred(self) -> Callable[[pa.Array], np.ndarray]:
        width, whole, rest, shift = self.width, self.whole, self.rest, self.shift
        return lambda column: (_matrix(column, width) - shift - whole).astype(np.float64) - rest

    def total(self, share: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
        """Sum over all centred vectors of what ``share`` makes of a lot of them."""
        centred = self.centred()

        def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            acc = np.zeros(shape)
            for record in batches:
                acc += share(centred(record.column(0)))
            yield pa.RecordBatch.from_pydict({"task": [TaskContext.get().partitionId()], "acc": [acc.tobytes()]})

        def add(table: pa.Table) -> pa.Table:
            rows = sorted(zip(table.column("task").to_pylist(), table.column("acc").to_pylist(), strict=True))
            acc = np.sum([np.frombuffer(b) for _, b in rows], axis=0)
            return pa.table({"task": [rows[0][0]], "acc": [acc.tobytes()]})

        parts = self.data.mapInArrow(part, "task long, acc binary")
        if self.tasks > FEW:  # groups of tasks, as many as members
            ways = math.isqrt(self.tasks) + 1
            parts = parts.groupBy(F.pmod("task", F.lit(ways)).alias("way")).applyInArrow(add, "task long, acc binary")
        rows = sorted((r["task"], bytes(r["acc"])) for r in parts.collect())
        return np.sum([np.frombuffer(b) for _, b in rows], axis=0).reshape(shape) if rows else np.zeros(shape)

    def times(self, block: np.ndarray) -> np.ndarray:
        """Covariance (divisor n) times a block of vectors."""
        return self.total(lambda x: x.T @ (x @ block), block.shape) / self.n


def _orthogonal(block: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """Orthonormal columns of ``block`` outside the given ones; columns that vanish are left out."""
    kept: list[np.ndarray] = []
    for column in block.T:
        start = size = np.linalg.norm(column)
        if not np.isfinite(start) or start == 0:
            continue
        v = column / start
        for _ in range(3):
            for basis in against:
                v = v - basis @ (basis.T @ v)
            for w in kept:
                v = v - w * (w @ v)
            size = np.linalg.norm(v)
            if size < 1e-10:
                break
            v = v / size
        if size >= 1e-10:
            kept.append(v)
    return np.array(kept).T.reshape(block.shape[0], len(kept))


def minres(apply: Callable[[np.ndarray], np.ndarray], rhs: np.ndarray, steps: int) -> np.ndarray:
    """Minimal residuals for symmetric systems, one a column, that share each product."""
    beta = np.linalg.norm(rhs, axis=0)
    safe = np.where(beta > 0, beta, 1.0)
    v, before = rhs / safe, np.zeros_like(rhs)
    eta, x = beta.copy(), np.zeros_like(rhs)
    w1, w2 = np.zeros_like(rhs), np.zeros_like(rhs)
    cos, cos_old = np.ones_like(beta), np.ones_like(beta)
    sin, sin_old, link = np.zeros_like(beta), np.zeros_like(beta), np.zeros_like(beta)
    for _ in range(steps):
        av = apply(v)
        alpha = (v * av).sum(axis=0)
        following = av - alpha * v - link * before
        beta = np.linalg.norm(following, axis=0)
        delta = cos * alpha - cos_old * sin * link
        turn = np.hypot(delta, beta)
        second, third = sin * alpha + cos_old * cos * link, sin_old * link
        live = turn > 0
        turn = np.where(live, turn, 1.0)
        w = (v - third * w2 - second * w1) / turn
        cos_old, cos, sin_old, sin = cos, delta / turn, sin, beta / turn
        x = x + np.where(live, cos * eta, 0.0) * w
        eta = -sin * eta
        w2, w1, before = w1, w, v
        v, link = following / np.where(beta > 0, beta, 1.0), beta
        if not (np.abs(eta) > 0).any():
            break
    return x


def jacobi_davidson(times: Callable[[np.ndarray], np.ndarray], width: int, wanted: int,
                    rounds: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues and their unit vectors of a symmetric operator.

    ``times`` multiplies the operator with a block of columns: one distributed pass. Each round takes
    Ritz pairs of the basis, locks the leading ones whose residual has reached double precision,
    and adds the MINRES solutions of the projected correction equations of the other wanted
    pairs, which share their passes.
    """
    rng = np.random.default_rng(0)
    block = min(width, wanted + GUARD)
    basis = _orthogonal(rng.standard_normal((width, block)))
    image = times(basis)
    locked, values = np.zeros((width, 0)), []
    for _ in range(rounds):
        small = basis.T @ image
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        basis, image = basis @ turn, image @ turn
        residual = image - basis * theta
        residual -= locked @ (locked.T @ residual)
        size = np.linalg.norm(residual, axis=0)
        limit = 4 * width * np.finfo(float).eps * max([abs(theta[0]), *map(abs, values)])
        done = 0
        while done < len(theta) and len(values) < wanted and size[done] <= limit:
            locked = np.column_stack([locked, basis[:, done]])
            values.append(theta[done])
            done += 1
        if len(values) == wanted:
            order = np.argsort(values)[::-1]
            return np.array(values)[order], locked[:, order]
        theta, basis, image, residual = theta[done:], basis[:, done:], image[:, done:], residual[:, done:]
        open_ = min(wanted - len(values), len(theta))
        shift, held = theta[:open_], np.column_stack([locked, basis[:, :open_]])

        def off(y: np.ndarray, held: np.ndarray = held) -> np.ndarray:
            return y - held @ (held.T @ y)

        def corrected(y: np.ndarray, shift: np.ndarray = shift, off: Callable = off) -> np.ndarray:
            y = off(y)
            return off(times(y) - y * shift)

        if basis.shape[1] > BASIS * block:
            basis, image = basis[:, :2 * block], image[:, :2 * block]
        more = np.zeros((width, 0))
        if basis.shape[1] + locked.shape[1] < width:
            more = _orthogonal(off(minres(corrected, -off(residual[:, :open_]), INNER)), locked, basis)
        if more.shape[1]:
            basis, image = np.column_stack([basis, more]), np.column_stack([image, times(more)])
        else:  # nothing to add: cleanse the basis of rounding and multiply anew
            basis = _orthogonal(basis, locked)
            image = times(basis)
    raise RuntimeError(f"{wanted - len(values)} eigenvectors have not reached double precision")


@dataclass(frozen=True)
class Whitening:
    """A fit: ``vectors`` has one column for each component, by falling eigenvalue."""

    scale: float
    shift: int
    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float


def fit_whitening(df: DataFrame, vector_col: str, components: int = 16, scale: float = 64.0,
                  shift: int = 1_000_000) -> Whitening:
    """Fit on each distinct vector of integers ``floor(scale * entry) + shift`` once.

    Vectors that are null, empty, or hold null, non-finite or unrepresentable entries are left
    out, as are those of another length than most (of equally frequent lengths the longest
    counts). Fewer components come out where the vectors have fewer dimensions or do not vary in
    some: directions without variance cannot be whitened. An empty table has none.
    """
    name = fresh(df.columns, "x")
    rows = df.select(integral(F.col(f"`{vector_col}`"), scale, shift).alias(name)).where(F.col(name).isNotNull())
    usual = rows.groupBy(F.size(name).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not usual:
        return Whitening(scale, shift, 0, [], np.zeros(0), np.zeros((0, 0)), 0.0, 0.0)
    width = usual[0]["d"]
    fit = FitList(rows.where(F.size(name) == width), name, width, shift)
    trace = float(fit.total(lambda x: np.array([(x * x).sum()]), (1,))[0]) / fit.n
    values, vectors = (jacobi_davidson(fit.times, width, min(components, width)) if trace > 0
                       else (np.zeros(0), np.zeros((width, 0))))
    real = values > 4 * width * np.finfo(float).eps * trace
    values, vectors = values[real], vectors[:, real]
    k = len(values)
    if k:  # largest entry positive: one sign for all runs
        vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(k)])
    error = 0.0
    if k:
        to = vectors / np.sqrt(values)

        def share(x: np.ndarray) -> np.ndarray:
            z = x @ to
            return np.vstack([z.T @ z, z.sum(axis=0)])

        found = fit.total(share, (k + 1, k)) / fit.n
        error = float(np.abs(found[:k] - np.outer(found[k], found[k]) - np.eye(k)).max())
    return Whitening(scale, shift, fit.n, fit.sums, values, vectors, trace, error)


def whiten(df: DataFrame, id_col: str, vector_col: str, model: Whitening) -> DataFrame:
    """Rows of ``id_col`` and ``component`` (from 1) with ``whitened`` and the figures of the fit.

    ``deviation`` is the exact sum over dimensions of (n x - S)^2, null beyond 64 bits. Vectors
    that the fit leaves out have no rows; repeated rows and null ids are rows like others.
    Other columns are not read; an id named like a column of the result raises ValueError.
    """
    out = ["component", "n", "deviation", "whitened", "explained", "identity_error"]
    if id_col.lower() in out:
        raise ValueError(f"the id column cannot be named {id_col}: the result has a column of this name")
    width, k, n = len(model.sums), len(model.values), model.n
    named = df.schema[id_col]
    schema = T.StructType([T.StructField(id_col, named.dataType), T.StructField("component", T.IntegerType()),
                           *(T.StructField(c, T.LongType()) for c in ("n", "deviation")),
                           *(T.StructField(c, T.DoubleType()) for c in ("whitened", "explained", "identity_error"))])
    x = integral(F.col(f"`{vector_col}`"), model.scale, model.shift)
    rows = df.select(F.col(f"`{id_col}`").alias("id"), x.alias("x")).where(F.size("x") == width if k else F.lit(False))
    moved = [s - n * model.shift for s in model.sums]
    to, shift = (model.vectors / np.sqrt(model.values) if k else None), model.shift
    explained = model.values / model.trace if k else None
    error = model.identity_error

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for record in batches:
            for at in range(0, record.num_rows, 2048):
                part = record.slice(at, 2048)
                x = _matrix(part.column(1), width) - shift
                high = n * float(np.abs(x.astype(np.float64)).max()) + max(map(abs, moved))
                small = high < LARGEST and high * high * width < LARGEST
                apart = (x * n - np.array(moved, np.int64)) if small else x.astype(object) * n - np.array(moved, object)
                deviation = [int(v) for v in (apart * apart).sum(axis=1)]
                white = (apart.astype(np.float64) / n) @ to
                rows = np.repeat(np.arange(len(x)), k)
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(rows)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(rows), n)),
                    pa.array([v if v < 1 << 63 else None for v in deviation], pa.int64()).take(pa.array(rows)),
                    pa.array(white.reshape(-1)), pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(len(rows), error))], names=schema.names)

    return rows.mapInArrow(project, schema)
