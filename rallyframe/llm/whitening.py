"""Embedding whitening by a block Jacobi-Davidson method.

Vectors become whole numbers (64 times each component, rounded down, plus SHIFT). Each distinct vector counts
once for the fit. The covariance is never formed: a product with it reads the distinct vectors, centres
them before multiplying and sums per task, so the driver holds a basis of the dimension, never rows.

The search space starts random and is orthonormal. Rayleigh-Ritz in it gives the wanted pairs; those whose
residual has reached double precision are locked, largest eigenvalue first. For the others the
correction equation, projected off the locked and the current Ritz vectors, is solved roughly by a few
steps of MINRES, all pairs at once so that a step costs one pass over the vectors, and the corrections widen
the space. A space that grows beyond its bound restarts from its best Ritz vectors.

Centring is exact: sums are decimals, and a component less the whole part of its mean is a small whole
number, from which the fraction is then taken.

Cases: vectors that are null or hold null or non-finite entries take no part; vectors of different
lengths are whitened apart, each length by its own distinct vectors; components without variance (an
eigenvalue that double precision cannot tell from zero) and empty vectors have no rows; repeated rows and
ids each get their rows, null ids too; a deviation beyond a long is null; scaled entries of 2**61 and more are
an error, as sums of two would leave the range of a long; long vectors are one row; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rallyframe.workspace import materialise

SHIFT = 1_000_000
SCALE = 64
COMPONENTS = 16
INNER = 4                # MINRES steps, each one pass over the vectors
SPACE = 4                # the space holds so many times the wanted vectors at most
OUTER = 60               # rounds before giving up
LIMIT = 2.0 ** 61
EPS = np.finfo(np.float64).eps
_TYPES = ("<i1", "<i2", "<i4", "<i8")


def _rows(vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and whole-numbered vectors of the sound rows, one matrix per length."""
    sizes = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False)
    flat = pc.list_flatten(vectors).cast(pa.float64())
    values = flat.fill_null(np.nan).to_numpy(zero_copy_only=False)
    ends = np.cumsum(np.maximum(sizes, 0))
    for size in np.unique(sizes[sizes > 0]).tolist():
        rows = np.flatnonzero(sizes == size)
        own = values[(ends[rows] - size)[:, None] + np.arange(size)]
        good = np.isfinite(own).all(1)
        scaled = np.floor(own[good] * SCALE)
        if np.abs(scaled).max(initial=0) >= LIMIT:
            raise ValueError(f"an entry of a vector is beyond {LIMIT / SCALE:g}")
        yield rows[good], scaled.astype(np.int64)


def _keys(whole: np.ndarray) -> list[bytes]:
    """Each vector as bytes: the width of its numbers, then the numbers, as narrow as they fit."""
    low, high = whole.min(1), whole.max(1)
    width = sum(((low < -(1 << b)) | (high >= 1 << b)).astype(int) for b in (7, 15, 31))
    out: list[bytes] = [b""] * len(whole)
    for w in np.unique(width).tolist():
        for i, row in zip(np.flatnonzero(width == w).tolist(), whole[width == w].astype(_TYPES[w])):
            out[i] = bytes([w]) + row.tobytes()
    return out


def _matrix(keys: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The vectors behind the keys again, without SHIFT."""
    if not len(keys):
        return
    _, where, data = keys.cast(pa.large_binary()).buffers()
    ends = np.frombuffer(where, np.int64)[keys.offset:keys.offset + len(keys) + 1]
    data = np.frombuffer(data, np.uint8)
    width = data[ends[:-1]]
    for w in np.unique(width).tolist():
        kind = np.dtype(_TYPES[w])
        at = ends[:-1][width == w] + 1
        yield np.ascontiguousarray(data[at[:, None] + np.arange(size * kind.itemsize)]).view(kind).astype(np.int64)


def distinct_vectors(vectors: DataFrame, vector: str) -> DataFrame:
    """(size, key): each distinct whole-numbered vector once, packed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, whole in _rows(batch.column(0)):
                keys = list(dict.fromkeys(_keys(whole)))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), whole.shape[1], np.int32)), pa.array(keys, pa.binary())], names=["size", "key"])

    found = vectors.select(F.col(vector).cast("array<double>").alias("v")).mapInArrow(run, "size int, key binary")
    return materialise(found.distinct(), "vectors")


def _summed(rows: DataFrame, work, columns: int, height: int) -> np.ndarray:
    """Sum over all tasks of what ``work`` makes of the vectors of a batch (height x columns)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((height, columns))
        for batch in batches:
            total += work(batch.column(0))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(height, dtype=np.int32)), *(pa.array(c) for c in np.ascontiguousarray(total.T))], names=["i", *(f"c{j}" for j in range(columns))])

    made = rows.select("key").mapInArrow(run, "i int, " + ", ".join(f"c{j} double" for j in range(columns)))
    out = np.zeros((height, columns))
    for r in made.groupBy("i").agg(*(F.sum(f"c{j}").alias(f"c{j}") for j in range(columns))).collect():  # one row per dimension
        out[r[0]] = r[1:]
    return out


@dataclass
class Fit:
    """The distinct vectors of one length, their number and sums; products with their covariance."""

    rows: DataFrame
    size: int
    n: int
    sums: list[int]          # of the vectors without SHIFT

    def __post_init__(self):
        self.base = np.array([s // self.n for s in self.sums], np.int64)
        self.rest = np.array([(s % self.n) / self.n for s in self.sums])

    def centred(self):
        """A function from packed vectors to centred ones."""
        size, base, rest = self.size, self.base, self.rest

        def work(keys: pa.Array) -> np.ndarray:
            return np.concatenate([np.zeros((0, size)), *((m - base).astype(np.float64) - rest for m in _matrix(keys, size))])
        return work

    def product(self, block: np.ndarray) -> np.ndarray:
        """Covariance times a block of columns."""
        centred = self.centred()

        def work(keys: pa.Array) -> np.ndarray:
            c = centred(keys)
            return c.T @ (c @ block)
        return _summed(self.rows, work, block.shape[1], self.size) / self.n

    def trace(self) -> float:
        centred = self.centred()
        return float(_summed(self.rows, lambda keys: np.array([[np.square(centred(keys)).sum()]]), 1, 1)[0, 0]) / self.n

    def covariance_of(self, maps: np.ndarray) -> np.ndarray:
        """Covariance of the centred vectors after a linear map (dimension x components)."""
        centred = self.centred()

        def work(keys: pa.Array) -> np.ndarray:
            y = centred(keys) @ maps
            return y.T @ y
        return _summed(self.rows, work, maps.shape[1], maps.shape[1]) / self.n


def fits(rows: DataFrame) -> list[Fit]:
    """One fit per length of the distinct vectors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes).tolist():
                n, total = sums.get(size, (0, np.zeros(size, object)))
                for m in _matrix(batch.column("key").filter(pa.array(sizes == size)), size):
                    n += len(m)
                    wide = np.abs(m).max(initial=0) * float(len(m)) >= LIMIT
                    total = total + (m.astype(object).sum(0) if wide else m.sum(0).astype(object))
                sums[size] = (n, total)
        for size, (n, total) in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(size, size, np.int32)), pa.array(np.arange(size, dtype=np.int32)), pa.array(np.full(size, n)),
                                              pa.array([str(x) for x in total])], names=["size", "i", "n", "total"])

    per_task = rows.select("size", "key").mapInArrow(run, "size int, i int, n long, total string")
    sums = per_task.groupBy("size", "i").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()  # one row per length and dimension
    by_size: dict[int, list] = {}
    for r in sorted(sums, key=lambda r: (r["size"], r["i"])):
        by_size.setdefault(r["size"], []).append(r)
    return [Fit(rows.where(F.col("size") == size), size, own[0]["n"], [int(r["total"]) for r in own]) for size, own in by_size.items()]


def _orthonormal(block: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """Columns that span what ``block`` adds to orthonormal columns; directions that add nothing go."""
    fixed = np.concatenate([a for a in against if a.shape[1]] or [block[:, :0]], axis=1)
    for _ in range(3):
        block = block - fixed @ (fixed.T @ block)
        norms = np.linalg.norm(block, axis=0)
        block = block[:, norms > 0] / norms[norms > 0]
        if not block.shape[1]:
            return block
        u, s, _ = np.linalg.svd(block, full_matrices=False)
        block = u[:, s > 1e-10 * s[0]] if s[0] else u[:, :0]
    room = block.shape[0] - fixed.shape[1]
    return block[:, :max(0, room)]


def minres(product, right: np.ndarray, steps: int) -> np.ndarray:
    """A few MINRES steps for each column of ``right`` at once, from zero; one product per step."""
    x = np.zeros_like(right)
    beta = np.linalg.norm(right, axis=0)
    live = beta > 0
    v_old, v = np.zeros_like(right), right / np.where(live, beta, 1.0)
    w_old, w = np.zeros_like(right), np.zeros_like(right)
    phi, c_old, c, s_old, s = beta.copy(), np.ones_like(beta), np.ones_like(beta), np.zeros_like(beta), np.zeros_like(beta)
    beta_old = np.zeros_like(beta)
    for _ in range(steps):
        p = product(v)
        alpha = (v * p).sum(0)
        p = p - alpha * v - beta_old * v_old
        beta_new = np.linalg.norm(p, axis=0)
        # the new column of the tridiagonal matrix, turned by the last two rotations and then by its own
        third, second = s_old * beta_old, c * (c_old * beta_old) + s * alpha
        first = c * alpha - s * c_old * beta_old
        size = np.hypot(first, beta_new)
        live &= size > 0
        safe = np.where(live, size, 1.0)
        c_new, s_new = np.where(live, first / safe, 1.0), np.where(live, beta_new / safe, 0.0)
        w_new = np.where(live, (v - third * w_old - second * w) / safe, 0.0)
        x = x + np.where(live, c_new * phi, 0.0) * w_new
        phi = -s_new * phi
        live &= beta_new > EPS * np.abs(alpha)
        v_old, v = v, np.where(live, p / np.where(beta_new > 0, beta_new, 1.0), 0.0)
        w_old, w, c_old, c, s_old, s, beta_old = w, w_new, c, c_new, s, s_new, beta_new
    return x


def principal(product, size: int, wanted: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues and their unit eigenvectors of a symmetric matrix known by its products with blocks.

    A pair is locked when its residual is within rounding of the largest eigenvalue. Where residuals no longer
    fall, the products are made anew, free of what rotations have added; after that, a hundred times
    the rounding is enough.
    """
    wanted = min(wanted, size)
    bound = min(size, SPACE * wanted)
    locked, values = np.zeros((size, 0)), np.zeros(0)
    space = _orthonormal(np.random.default_rng(seed).standard_normal((size, wanted)))
    image = product(space)
    least, stuck = np.inf, 0
    for _ in range(OUTER):
        small = space.T @ image
        found, turn = np.linalg.eigh((small + small.T) / 2)
        found, turn = found[::-1], turn[:, ::-1]
        ritz, moved = space @ turn, image @ turn
        scale = max([*np.abs(values), *np.abs(found), 0.0])
        rest = moved[:, :wanted - len(values)] - ritz[:, :wanted - len(values)] * found[:wanted - len(values)]
        rest = rest - locked @ (locked.T @ rest)
        size_of = np.linalg.norm(rest, axis=0)
        tight = 8 * np.sqrt(size) * EPS * scale
        worst = float(size_of.max(initial=0))
        stuck = stuck + 1 if worst > least / 2 else 0
        done = size_of <= (100 * tight if stuck > 2 else tight)
        least = min(least, worst)
        count = int(np.argmin(done)) if not done.all() else len(done)
        if count:  # lock the leading ones
            locked, values = np.concatenate([locked, ritz[:, :count]], 1), np.concatenate([values, found[:count]])
            ritz, moved, found, rest = ritz[:, count:], moved[:, count:], found[count:], rest[:, count:]
        if len(values) >= wanted:
            break
        least, stuck = (np.inf, 0) if count else (least, stuck)
        if stuck == 2:
            moved = product(ritz)
        if ritz.shape[1] > bound - rest.shape[1]:  # restart from the best
            keep = max(rest.shape[1], bound - 2 * rest.shape[1]) if bound < size else ritz.shape[1]
            ritz, moved, found = ritz[:, :keep], moved[:, :keep], found[:keep]
        todo = rest.shape[1]
        fixed = np.concatenate([locked, ritz[:, :todo]], 1)
        off = lambda x: x - fixed @ (fixed.T @ x)  # noqa: B023, E731
        shift = found[:todo]
        fix = minres(lambda p: off(product(off(p)) - p * shift), -off(rest), INNER)  # noqa: B023
        more = _orthonormal(np.concatenate([fix, rest], 1)[:, :max(todo, 1)], locked, ritz)
        if not more.shape[1]:
            more = _orthonormal(np.random.default_rng(seed + 1).standard_normal((size, todo)), locked, ritz)
        if not more.shape[1]:  # the space is whole
            space, image = ritz, product(ritz)
            continue
        space, image = np.concatenate([ritz, more], 1), np.concatenate([moved, product(more)], 1)
    else:
        raise ArithmeticError(f"{len(values)} of {wanted} eigenvectors after {OUTER} rounds; residual {worst:g}")
    order = np.argsort(-values, kind="stable")
    return values[order], locked[:, order]


@dataclass
class Whitening:
    """What turns a vector of one length into its whitened components."""

    size: int
    n: int
    sums: list[int]
    base: np.ndarray
    rest: np.ndarray
    maps: np.ndarray         # dimension x components: unit eigenvectors over the roots of their eigenvalues
    explained: np.ndarray
    identity_error: float


def fit(rows: DataFrame, components: int = COMPONENTS) -> list[Whitening]:
    """One whitening per length, of ``distinct_vectors``."""
    made = []
    for own in fits(rows):
        trace = own.trace()
        values, vectors = principal(own.product, own.size, components)
        good = values > 16 * own.size * EPS * trace
        values, maps = values[good], vectors[:, good] / np.sqrt(values[good])
        error = np.abs(own.covariance_of(maps) - np.eye(len(values))).max() if len(values) else 0.0
        made.append(Whitening(own.size, own.n, own.sums, own.base, own.rest, maps, values / trace if trace else values, float(error)))
    return made


def _deviations(centre: Whitening, whole: np.ndarray) -> pa.Array:
    """Exact sum of squares of n x - S, null beyond a long."""
    away = whole - centre.base                                    # n x - S = n (x - base) - (S mod n)
    left = [s % centre.n for s in centre.sums]
    size = np.square(np.abs(away).astype(np.float64) + 1).sum(1) * float(centre.n) ** 2
    out = np.square(away * centre.n - np.array(left, np.int64)).sum(1) if size.max(initial=0) < LIMIT else None
    if out is not None:
        return pa.array(out)
    exact = [sum((centre.n * a - b) ** 2 for a, b in zip(row, left)) for row in away.tolist()]
    return pa.array([x if x < 1 << 63 else None for x in exact], pa.int64())


def whiten(vectors: DataFrame, model: list[Whitening], vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row per sound vector and component."""
    shared = vectors.sparkSession.sparkContext.broadcast({m.size: m for m in model})
    kind = vectors.schema[vec_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, whole in _rows(batch.column(1)):
                m = shared.value[whole.shape[1]]
                k = m.maps.shape[1]
                if not k or not len(rows):
                    continue
                white = ((whole - m.base).astype(np.float64) - m.rest) @ m.maps
                each = np.repeat(np.arange(len(rows)), k)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows[each])), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))), pa.array(np.full(len(each), m.n)),
                     _deviations(m, whole).take(pa.array(each)), pa.array(white.ravel()), pa.array(np.tile(m.explained, len(rows))), pa.array(np.full(len(each), m.identity_error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    source = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    return source.mapInArrow(run, f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
