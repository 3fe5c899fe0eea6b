"""Whitening of vectors by an incremental eigendecomposition.

Each task reads its vectors one after the other and keeps the eigenvalues and
eigenvectors of the scatter around their mean.  A vector is a rank-one update,
centred by the mean so far: in the eigenvectors' own coordinates the new
eigenvalues are the roots of a secular equation, one between each pair of old
ones.  Directions that the update does not touch, and all but one of those that
share an eigenvalue, are deflated first.  Two spectra become one by rank-one
updates too, one for each eigenpair of the second and one for the distance of the
means; they are combined eight at a time, level by level.

Thousands of updates leave errors beyond double precision, so a last pass over
the vectors sums up the exact scatter in the coordinates found; its own
eigenvectors, a small rotation, turn the basis into the final one (Rayleigh and
Ritz).  The components are those of eigenvalues that differ from 0.

Cases: vectors that are null, empty or hold a null or non-finite entry, or one
over 2**40, take no part, nor do those of a length other than the most frequent
one (of several, the longest); rows of equal id are rows of their own; a single
vector, or equal ones only, have no component and so no rows; nor has an empty
table.  ``deviation`` is null where it is over 64 bits.  Columns beside the two
named ones are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nodepulse.llm.common import kept

#: States that are combined at once; parts of the largest eigenvalue under which a difference counts as none.
FAN, EPS = 8, 8 * np.finfo(float).eps


def _roots(d: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum(z2 / (d - x)) = 0 for ascending, distinct d and positive z2.

    There is one above each d.  Returns (d of the nearest pole as its index, distance from it), which keeps the
    differences from all poles exact.  Steps follow the rational function that has the same value and slope;
    one that leaves the bracket is replaced by its middle.
    """
    k = len(d)
    upper = np.append(d[1:], d[-1] + z2.sum())
    half = (upper - d) / 2
    value = 1 + (z2 / (d - (d + half)[:, None])).sum(1)
    from_right = (value < 0) & (np.arange(k) < k - 1)  # the function rises from -inf to +inf between two poles
    near = np.arange(k) + from_right
    shift = d - d[near][:, None]
    left, right = d - d[near], upper - d[near]
    low, high = np.where(from_right, left / 2, left), np.where(from_right, right, right / 2)
    low[-1], high[-1] = (half[-1], right[-1]) if value[-1] < 0 else (0.0, half[-1])
    x = (low + high) / 2
    below = np.arange(k) <= np.arange(k)[:, None]
    for _ in range(60):
        gap = shift - x[:, None]
        with np.errstate(all="ignore"):
            part = z2 / gap
            w = 1 + part.sum(1)
            slope = part / gap
            s, p = (slope * below).sum(1), slope.sum(1)
            done = np.abs(w) <= 4 * np.finfo(float).eps * (1 + np.abs(part).sum(1))
            low, high = np.where(w < 0, x, low), np.where(w < 0, high, x)
            g, h = left - x, right - x
            c = w - g * s - h * (p - s)
            a, b = (g + h) * w - g * h * p, g * h * w
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            new = x + step
        bad = ~((new > low) & (new < high))
        new[bad] = (low[bad] + high[bad]) / 2
        done |= (new == x) | (new == low) | (new == high)
        x = np.where(done, x, new)
        if done.all():
            break
    return near, x


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenpairs of ``vectors diag(values) vectors.T + rho v v.T`` for rho >= 0, values ascending, vectors in columns."""
    z = np.sqrt(rho) * (vectors.T @ v)
    size = z @ z
    scale = max(abs(values[0]), abs(values[-1])) + size
    if not size > 0 or not np.isfinite(size):
        return values, vectors
    # Directions of one eigenvalue: a reflection puts all of z into the last of them.
    first = np.flatnonzero(np.r_[True, np.diff(values) > EPS * scale])
    if len(first) < len(values):
        vectors = vectors.copy()
        for a, b in zip(first, np.r_[first[1:], len(values)], strict=True):
            own = z[a:b].copy()
            length = np.linalg.norm(own)
            if b - a > 1 and length > 0:
                mirror = own.copy()
                mirror[-1] += np.copysign(length, own[-1])
                mirror /= np.linalg.norm(mirror)
                part = vectors[:, a:b]
                vectors[:, a:b] = part - 2 * np.outer(part @ mirror, mirror)
                z[a:b] = 0
                z[b - 1] = -np.copysign(length, own[-1])
    live = np.flatnonzero(z * z > (EPS * scale) * EPS * scale / size)
    if not len(live):
        return values, vectors
    d, own = values[live], z[live]
    near, x = _roots(d, own * own)
    gap = (d - d[near][:, None]) - x[:, None]  # old pole less new value, exact in its leading digits
    # The z for which these roots are exact makes the new vectors orthogonal.
    with np.errstate(all="ignore"):
        ratio = -gap.T  # row: pole j, column: root i
        under = d[None, :] - d[:, None]
        np.fill_diagonal(under, 1.0)
        share = ratio / under
        np.fill_diagonal(share, np.diagonal(ratio))
        fitted = np.sqrt(np.abs(np.prod(share, axis=1)))
    fitted = np.where(np.isfinite(fitted), np.copysign(fitted, own), own)
    turn = fitted[:, None] / gap.T
    turn /= np.linalg.norm(turn, axis=0)
    values, vectors = values.copy(), vectors.copy()
    values[live] = d[near] + x
    vectors[:, live] = vectors[:, live] @ turn
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


class Spectrum:
    """Number, exact sums, mean and eigenpairs of the scatter of some vectors."""

    def __init__(self, dim: int):
        self.n, self.sums, self.mean = 0, [0] * dim, np.zeros(dim)
        self.values, self.vectors = np.zeros(dim), np.eye(dim)

    def add(self, rows: np.ndarray) -> None:
        """Add whole-numbered vectors."""
        self.sums = [a + int(b) for a, b in zip(self.sums, rows.sum(0, dtype=object), strict=True)]
        for x in rows.astype(float):
            off = x - self.mean
            self.n += 1
            if self.n > 1:
                self.values, self.vectors = rank_one(self.values, self.vectors, off, (self.n - 1) / self.n)
            self.mean = self.mean + off / self.n

    def merge(self, other: Spectrum) -> None:
        """Add the vectors of ``other``."""
        if not other.n:
            return
        n = self.n + other.n
        off = other.mean - self.mean
        for value, vector in zip(other.values, other.vectors.T, strict=True):
            if value > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, vector, value)
        self.values, self.vectors = rank_one(self.values, self.vectors, off, self.n * other.n / n)
        self.sums = [a + b for a, b in zip(self.sums, other.sums, strict=True)]
        self.mean = self.mean + off * (other.n / n)
        self.n = n

    def pack(self) -> dict:
        """Plain values for a row."""
        floats = np.concatenate([self.mean, self.values, self.vectors.ravel()])
        return {"n": self.n, "sums": " ".join(map(str, self.sums)), "floats": floats.tobytes()}

    @classmethod
    def unpack(cls, n: int, sums: str, floats: bytes) -> Spectrum:
        own = cls(0)
        own.n, own.sums = int(n), [int(x) for x in sums.split()]
        dim, flat = len(own.sums), np.frombuffer(floats)
        own.mean, own.values, own.vectors = flat[:dim], flat[dim : 2 * dim], flat[2 * dim :].reshape(dim, dim)
        return own


def _folded(states: DataFrame, merge: Callable[[pd.DataFrame], dict]):
    """All ``states`` (part, and what ``merge`` makes of several) as one row, combined FAN at a time."""
    states = kept(states, "states")
    schema, parts = states.schema, 1 + states.agg(F.max("part")).first()[0]
    columns = states.columns
    names = [n for n in columns if n != "part"]

    def one(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("part")
        made = merge(rows) if len(rows) > 1 else rows.iloc[0][names].to_dict()
        return pd.DataFrame([{"part": key[0], **made}])[columns]

    while parts > 1:
        parts = -(-parts // FAN)
        states = states.groupBy(F.floor(F.col("part") / FAN).alias("__next")).applyInPandas(one, schema)
    return states.first()


def _per_task(rows: DataFrame, dim: int, start: Callable[[], object], add: Callable, pack: Callable, schema: str) -> DataFrame:
    """One row for each task with rows: ``add`` puts blocks of vectors into what ``start`` makes, ``pack`` makes the row."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, seen = start(), 0
        for batch in batches:
            add(state, _matrix(batch.column(0), dim))
            seen += batch.num_rows
        if seen:
            row = {"part": TaskContext.get().partitionId(), **pack(state)}
            yield pa.RecordBatch.from_pylist([row])

    return rows.select("x").mapInArrow(tasks, "part long, " + schema)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _vectors(rows: DataFrame, id_col: str, vector_col: str, scale: int, plus: int) -> DataFrame:
    """(vec_id, x) with whole-numbered x of the rows that take part, all of one length."""
    most = float(1 << 40)
    sound = f"size(`{vector_col}`) > 0 and forall(`{vector_col}`, c -> c is not null and abs(c) <= {most}D and not isnan(c))"
    x = F.transform(F.col(vector_col), lambda c: F.floor(c.cast("double") * scale).cast("long") + plus)
    fit = rows.where(sound).select(F.col(id_col).alias("vec_id"), x.alias("x"))
    size = fit.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    return fit.where(F.size("x") == (size["dim"] if size else 0))


class Basis:
    """Components of a table of vectors: columns of ``vectors``, by falling eigenvalue."""

    def __init__(self, n: int, sums: list[int], values: np.ndarray, vectors: np.ndarray, trace: float):
        self.n, self.sums, self.values, self.vectors, self.trace = n, sums, values, vectors, trace

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Coordinates of whole-numbered vectors, each of variance 1."""
        return centred(x, self.n, self.sums) @ (self.vectors / np.sqrt(self.values))


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``x - sums / n``, rounded once."""
    whole = np.array([s // n for s in sums], np.int64)
    return (x - whole) - np.array([(s % n) / n for s in sums])


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sum of (n * x - sums)**2 of each row; null where it is over 64 bits."""
    whole = np.array([s // n for s in sums], np.int64)
    off = x - whole
    if float(np.abs(off).max(initial=0) + 1) ** 2 * float(n) ** 2 * x.shape[1] < 2**62:
        diff = n * off - np.array([s % n for s in sums], np.int64)
        return (diff * diff).sum(1).tolist()
    diff = n * off.astype(object) - np.array([s % n for s in sums], object)
    return [t if t < 1 << 63 else None for t in (diff * diff).sum(1).tolist()]


def _scatter(rows: DataFrame, dim: int, width: int, turned: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the products, and of the rows, of ``turned`` vectors."""

    def add(state: list, x: np.ndarray) -> None:
        for a in range(0, len(x), 4096):
            y = turned(x[a : a + 4096])
            state[0] += y.T @ y
            state[1] += y.sum(0)

    def pack(state: list) -> dict:
        return {"floats": np.concatenate([state[0].ravel(), state[1]]).tobytes()}

    def merge(parts: pd.DataFrame) -> dict:
        return {"floats": np.sum([np.frombuffer(p) for p in parts["floats"]], axis=0).tobytes()}

    states = _per_task(rows, dim, lambda: [np.zeros((width, width)), np.zeros(width)], add, pack, "floats binary")
    got = np.frombuffer(_folded(states, merge)["floats"])
    return got[:-width].reshape(width, width), got[-width:]


def fit(rows: DataFrame) -> Basis | None:
    """Basis of the whole-numbered vectors ``x`` of ``rows``; None where they have no component."""
    first = rows.select(F.size("x").alias("dim")).first()
    if first is None:
        return None
    dim = first["dim"]

    def merge(parts: pd.DataFrame) -> dict:
        first, *rest = [Spectrum.unpack(*p) for p in parts[["n", "sums", "floats"]].itertuples(index=False)]
        for other in rest:
            first.merge(other)
        return first.pack()

    states = _per_task(rows, dim, lambda: Spectrum(dim), Spectrum.add, Spectrum.pack, "n long, sums string, floats binary")
    whole = _folded(states, merge)
    n, sums, found = whole["n"], whole["sums"], Spectrum.unpack(whole["n"], whole["sums"], whole["floats"])
    sums = [int(s) for s in sums.split()]
    basis = np.linalg.qr(found.vectors)[0]
    products, _ = _scatter(rows, dim, dim, lambda x: centred(x, n, sums) @ basis)
    values, turn = np.linalg.eigh(products / n)
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order], (basis @ turn)[:, order]
    real = values > dim * EPS * max(values[0], 0)
    return Basis(n, sums, values[real], vectors[:, real], float(np.trace(products) / n)) if real.any() else None


def whitened(
    rows: DataFrame, most: int = 32, scale: int = 64, plus: int = 1_000_000, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row for each vector and component."""
    fitted = _vectors(rows, id_col, vector_col, scale, plus)
    kind = fitted.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    basis = fit(fitted)
    if basis is None:
        return rows.sparkSession.createDataFrame([], schema)
    width, dim = min(most, len(basis.values)), len(basis.sums)
    own = Basis(basis.n, basis.sums, basis.values[:width], basis.vectors[:, :width], basis.trace)
    products, sums = _scatter(fitted, dim, width, own.whitened)
    mean = sums / own.n
    error = float(np.abs(products / own.n - np.outer(mean, mean) - np.eye(width)).max())
    shared = rows.sparkSession.sparkContext.broadcast(own)  # dim * most numbers

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for a in range(0, batch.num_rows, 2048):
                part = batch.slice(a, 2048)
                x = _matrix(part.column(1), dim)
                each = np.repeat(np.arange(len(x)), width)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(each)),
                        pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(len(each), own.n)),
                        pa.array(deviations(x, own.n, own.sums), pa.int64()).take(pa.array(each)),
                        pa.array(own.whitened(x).ravel()),
                        pa.array(np.tile(own.values / own.trace, len(x))),
                        pa.array(np.full(len(each), error)),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return fitted.mapInArrow(tasks, schema)
