"""Embedding whitening by Chebyshev-filtered subspace iteration over distributed centred products.

The covariance V = C'C/n is never formed: each product V·Y with a narrow matrix Y is one pass over the vectors,
C'(C·Y), where a task adds up its own rows and only dimensions x block numbers are shuffled. A block of
trial directions, wider than the components asked for, goes through a Chebyshev polynomial of V that damps the
unwanted part of the spectrum (a three-term recurrence, one pass for each degree), then QR and a
Rayleigh-Ritz step. The lower end of the spectrum comes from a few Lanczos steps, the upper end of the
unwanted part is the block's smallest Ritz value. Rounds go on until the residuals |Vq - eq| certify the
components.

Components are centred in whole numbers (n*x - S) before anything is multiplied, so an offset of the vectors, however
large, costs no digits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.shared import stored
from marquee.llm.vectors import matrix, same_length, summed, whole_vectors


@dataclass(frozen=True)
class Settings:
    components: int = 8
    scale: int = 1024
    offset: int = 100_000
    block: int = 4  # trial directions for each component
    degree: int = 8  # of the polynomial of one round
    lanczos: int = 8  # steps that find the lower end of the spectrum
    residual: float = 2e-14  # certified when |Vq - eq| is at most this share of the largest eigenvalue
    good_enough: float = 1e-11  # accepted when rounding keeps the residual from shrinking any further
    rounds: int = 60
    null: float = 1e-13  # eigenvalues below this share of the largest count as zero
    seed: int = 11


@dataclass(frozen=True)
class Centring:
    """Number and sums by dimension of the fit list: all that tasks need to centre their rows."""

    n: int
    sums: np.ndarray

    def whole(self, batch: pa.RecordBatch) -> np.ndarray:
        """n*x - S, exact: as 64-bit numbers where they fit."""
        x = matrix(batch.column("x"), np.int64)
        if self.n * int(np.abs(x).max(initial=0)) + int(np.abs(self.sums).max(initial=0)) >= 1 << 62:
            return x.astype(object) * self.n - self.sums.astype(object)
        return x * np.int64(self.n) - self.sums

    def rows(self, batch: pa.RecordBatch) -> np.ndarray:
        """x - S/n, rounded once."""
        return self.whole(batch).astype(np.float64) / self.n


@dataclass(frozen=True)
class Centred:
    """The fit list: whole vectors ``x`` and how they are centred."""

    vectors: DataFrame
    centring: Centring

    @property
    def dims(self) -> int:
        return len(self.centring.sums)

    def times(self, y: np.ndarray) -> np.ndarray:
        """V·y: one pass."""
        rows = self.centring.rows

        def part(batch: pa.RecordBatch) -> np.ndarray:
            c = rows(batch)
            return (c.T @ (c @ y)).ravel()

        return summed(self.vectors, part, y.size).reshape(y.shape) / self.centring.n

    def trace(self) -> float:
        rows = self.centring.rows
        return float(summed(self.vectors, lambda b: np.array([(rows(b) ** 2).sum()]), 1)[0] / self.centring.n)


def fit_list(vectors: DataFrame, dims: int) -> Centred:
    """Count and exact sums, in one pass. Sums that leave 64 bits raise an error in Spark."""
    def part(batch: pa.RecordBatch) -> np.ndarray:
        x = matrix(batch.column("x"), np.int64)
        if int(np.abs(x).max(initial=0)) * len(x) >= 1 << 62:
            raise ArithmeticError("sums by dimension leave 64 bits")
        return np.append(x.sum(0), len(x))

    totals = summed(vectors, part, dims + 1, "bigint")
    return Centred(vectors, Centring(int(totals[-1]), totals[:-1]))


def lower_end(fit: Centred, steps: int, seed: int) -> float:
    """A value at or a little below most of the spectrum: the least Ritz value less its residual."""
    q = np.random.default_rng(seed).normal(size=(fit.dims, 1))
    basis, alphas, betas = [q / np.linalg.norm(q)], [], []
    for _ in range(min(steps, fit.dims)):
        w = fit.times(basis[-1])
        alphas.append(float((w * basis[-1]).sum()))
        for _ in range(2):  # full orthogonalisation, twice
            for b in basis:
                w = w - b * float((b * w).sum())
        betas.append(float(np.linalg.norm(w)))
        if betas[-1] <= 1e-12 * max(map(abs, alphas)):
            betas[-1] = 0.0
            break
        basis.append(w / betas[-1])
    values, vectors = np.linalg.eigh(np.diag(alphas) + np.diag(betas[:-1], 1) + np.diag(betas[:-1], -1))
    return max(0.0, float(values[0] - betas[-1] * abs(vectors[-1, 0])))


def chebyshev_filter(fit: Centred, y: np.ndarray, degree: int, low: float, high: float, top: float) -> np.ndarray:
    """y through the polynomial that is small on [low, high] and 1 at ``top``; one pass for each degree."""
    half, centre = (high - low) / 2, (high + low) / 2
    first = half / (top - centre)
    scale = first
    before, now = y, (fit.times(y) - centre * y) * (first / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - scale)
        before, now = now, (fit.times(now) - centre * now) * (2 * following / half) - before * (scale * following)
        scale = following
    return now


def leading_components(fit: Centred, s: Settings) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvalues (falling), unit eigenvectors and the certified residual. Fewer than asked for where the
    others are zero."""
    width = min(fit.dims, s.block * s.components)
    wanted = min(s.components, fit.dims)
    q = np.linalg.qr(np.random.default_rng(s.seed).normal(size=(fit.dims, width)))[0]
    low, best = None, math.inf
    for _ in range(s.rounds):
        z = fit.times(q)
        small = q.T @ z
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, z = q @ turn, z @ turn
        if values[0] <= 0:
            return np.zeros(0), np.zeros((fit.dims, 0)), 0.0
        some = int((values[:wanted] > s.null * values[0]).sum())
        left = float(np.linalg.norm(z[:, :some] - q[:, :some] * values[:some], axis=0).max() / values[0])
        if left <= s.residual or (left <= s.good_enough and left > best / 2):
            return values[:some].copy(), np.linalg.qr(q[:, :some])[0], left
        best = min(best, left)
        if width == fit.dims:  # the block spans everything: only rounding is left
            q = np.linalg.qr(z)[0]
            continue
        if low is None:
            low = lower_end(fit, s.lanczos, s.seed)
        high = max(float(values[-1]), 1e-12 * float(values[0]))
        filtered = chebyshev_filter(fit, q, s.degree, min(low, 0.9 * high), high, float(values[0]))
        q = np.linalg.qr(filtered)[0]
    raise ArithmeticError(f"not certified after {s.rounds} rounds: residual {left:.1e}")


def whiten(
    embeddings: DataFrame, settings: Settings = Settings(), id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """For each usable row and component: vec_id, component, n, deviation, deviation_exact, whitened, explained,
    identity_error.

    Each entry c, as double, becomes the whole number x = floor(scale * c) + offset. Components are unit
    eigenvectors of the covariance of all usable rows (divisor n), numbered from 1 by falling eigenvalue e;
    whitened is the centred row projected on the component, over sqrt(e); explained is e over the trace.
    deviation is the exact sum of (n*x - S)^2, null where that does not fit 64 bits, in which case
    deviation_exact (38 digits) still holds it. identity_error is the largest entry of the whitened rows'
    covariance minus the identity, measured over all rows.

    Rows whose vector is null, empty, or holds null or non-finite entries are dropped; a null id is kept. Repeated rows
    count each time. Components of eigenvalue zero cannot be whitened and are left out: one row, or equal rows
    only, give an empty result, as does an empty table. Vectors of different lengths raise ValueError. Extra
    columns are not looked at.
    """
    s = settings
    spark = embeddings.sparkSession
    result = (
        "vec_id bigint, component int, n bigint, deviation bigint, deviation_exact decimal(38,0), whitened double, "
        "explained double, identity_error double"
    )
    vectors = stored(whole_vectors(embeddings, s.scale, s.offset, id_col, vector_col), "whole")
    lengths = vectors.agg(F.min(F.size("x")).alias("least"), F.max(F.size("x")).alias("most")).first()
    if lengths["least"] is None:
        return spark.createDataFrame([], result)
    fit = fit_list(vectors, same_length((lengths["least"], lengths["most"])))
    values, q, _ = leading_components(fit, s)
    if not len(values):
        return spark.createDataFrame([], result)
    count, spread = len(values), np.sqrt(values)
    explained, centring = values / fit.trace(), fit.centring

    def moments(batch: pa.RecordBatch) -> np.ndarray:
        w = (centring.rows(batch) @ q) / spread
        return np.append(w.T @ w, w.sum(0)[None], axis=0).ravel()

    total = summed(vectors, moments, (count + 1) * count).reshape(count + 1, count) / centring.n
    mean = total[-1]  # of centred rows: rounding only
    error = float(np.abs(total[:-1] - np.outer(mean, mean) - np.eye(count)).max())
    n, dims = centring.n, fit.dims

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = centring.whole(batch)
            if whole.dtype == object or dims * int(np.abs(whole).max()) ** 2 >= 1 << 63:
                exact = [sum(int(v) ** 2 for v in row) for row in whole.tolist()]
                deviation = pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())
                digits = pa.array([Decimal(v) for v in exact], pa.decimal128(38, 0))
            else:
                deviation = pa.array((whole**2).sum(1), pa.int64())
                digits = deviation.cast(pa.decimal128(38, 0))
            w = (whole.astype(np.float64) / n) @ q / spread
            each = pa.array(np.repeat(np.arange(batch.num_rows), count))
            size = batch.num_rows * count
            yield pa.RecordBatch.from_pydict({
                "vec_id": batch.column("vec_id").take(each),
                "component": pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), batch.num_rows)),
                "n": pa.array(np.full(size, n, np.int64)),
                "deviation": deviation.take(each),
                "deviation_exact": digits.take(each),
                "whitened": pa.array(w.ravel()),
                "explained": pa.array(np.tile(explained, batch.num_rows)),
                "identity_error": pa.array(np.full(size, error)),
            })

    return vectors.mapInArrow(rows, result)
