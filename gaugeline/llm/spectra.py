"""Eigenvalues and eigenvectors of growing scatter matrices, updated vector by vector.

Adding ``u u'`` to a matrix with known eigenpairs moves every eigenvalue to the root of
the secular equation ``1 + sum(z_j^2 / (d_j - t)) = 0`` in its own interval, where ``z``
is ``u`` in the old eigenbasis. Eigenvalues that ``u`` does not touch are deflated: they
stay, with their vectors. Equal eigenvalues are first turned (by a reflection among their
vectors) so that ``u`` touches one of them only. The vectors come from the roots by
Loewner's formula, which keeps them orthogonal when roots lie close together.

Several matrices, the lanes, are updated at once, so that one numpy call serves all.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

EPS = float(np.finfo(float).eps)
#: At most so many steps to a root; a relative step after which it is reached; steps made for all roots together.
STEPS, SETTLED, ALL_ROOTS = 40, 3e-6, 2


class Spectra:
    """Lanes of ``count``, ``mean``, eigenvalues ``values`` (rising) of the scatter about the
    mean, and eigenvectors ``vectors`` (rows)."""

    def __init__(self, count: np.ndarray, mean: np.ndarray, values: np.ndarray, vectors: np.ndarray):
        self.count, self.mean, self.values, self.vectors = count, mean, values, vectors

    @classmethod
    def empty(cls, lanes: int, d: int) -> Spectra:
        return cls(np.zeros(lanes), np.zeros((lanes, d)), np.zeros((lanes, d)), np.tile(np.eye(d), (lanes, 1, 1)))

    @classmethod
    def stacked(cls, parts: list[Spectra]) -> Spectra:
        return cls(*[np.concatenate([getattr(p, name) for p in parts])
                     for name in ("count", "mean", "values", "vectors")])

    def add(self, x: np.ndarray) -> None:
        """One row for each of the first ``len(x)`` lanes: a centred rank-one update."""
        lanes = len(x)
        gap = x - self.mean[:lanes]
        n = self.count[:lanes, None]
        self.update(gap * np.sqrt(n / (n + 1)))
        self.mean[:lanes] += gap / (n + 1)
        self.count[:lanes] += 1

    def merged(self) -> Spectra:
        """All lanes as one: of every pair of lanes one takes the other's weighted eigenvectors
        and the shift between their means as further rank-one updates."""
        whole = self
        while len(whole.count) > 1:
            odd = whole._lanes(slice(len(whole.count) // 2 * 2, None))
            a, b = whole._lanes(slice(0, len(whole.count) // 2 * 2, 2)), whole._lanes(slice(1, None, 2))
            total = np.maximum(a.count + b.count, 1)
            gap = b.mean - a.mean
            a.update(gap * np.sqrt(a.count * b.count / total)[:, None])
            # Eigenvalues that are rounding noise of zero are zero.
            real = b.values > EPS * b.values.shape[1] * b.values.max(1, initial=0)[:, None]
            weighted = np.sqrt(np.where(real, b.values, 0))[:, :, None] * b.vectors
            for i in np.flatnonzero(real.any(0)):
                a.update(weighted[:, i])
            # An empty lane has no mean of its own.
            a.mean = np.where((a.count > 0)[:, None], a.mean + gap * (b.count / total)[:, None], b.mean)
            a.count = a.count + b.count
            whole = Spectra.stacked([a, odd])
        return whole

    def _lanes(self, which: slice) -> Spectra:
        return Spectra(*[x[which].copy() for x in (self.count, self.mean, self.values, self.vectors)])

    def update(self, u: np.ndarray) -> None:
        """Adds ``u u'`` to the first ``len(u)`` lanes."""
        lanes = len(u)
        if not lanes:
            return
        d, vectors = self.values[:lanes], self.vectors[:lanes]
        z = (vectors @ u[:, :, None])[:, :, 0]
        size = np.sqrt((z * z).sum(1))
        limit = 8 * EPS * np.maximum(np.abs(d).max(1), size * size)
        close = d[:, 1:] - d[:, :-1] <= limit[:, None]
        if close.any():
            for lane in np.flatnonzero(close.any(1)):
                _turn_equal(close[lane], z[lane], vectors[lane], limit[lane] / max(size[lane], EPS))
        touched = np.abs(z) * size[:, None] > limit[:, None]
        z[~touched] = 0
        roots, turned = _rank_one(d, z, touched)
        self.values[:lanes] = roots
        np.matmul(turned, vectors.copy(), out=vectors)


def _turn_equal(close: np.ndarray, z: np.ndarray, vectors: np.ndarray, limit: float) -> None:
    """Within each run of equal eigenvalues, moves all of ``z`` to the run's last vector."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], close.view(np.int8), [0]])))
    for first, last in zip(edges[::2], edges[1::2]):
        run = slice(first, last + 1)
        size = np.linalg.norm(z[run])
        if np.count_nonzero(np.abs(z[run]) > limit) < 2:
            continue
        axis = z[run].copy()
        axis[-1] += np.copysign(size, axis[-1])
        axis /= np.linalg.norm(axis)
        vectors[run] -= 2 * np.outer(axis, axis @ vectors[run])
        end = -np.copysign(size, z[last])
        z[run] = 0
        z[last] = end


def _rank_one(d: np.ndarray, z: np.ndarray, touched: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) of ``diag(d) + z z'`` per lane, eigenvectors as rows."""
    k = d.shape[1]
    weight = z * z
    # The next touched eigenvalue above each; the last interval ends at d + |z|^2.
    above = np.where(touched, d, np.inf)
    above = np.minimum.accumulate(above[:, ::-1], 1)[:, ::-1]
    above = np.concatenate([above[:, 1:], np.full((len(d), 1), np.inf)], 1)
    top = np.isinf(above)
    span = np.where(touched, np.where(top, weight.sum(1)[:, None], above - d), 1.0)
    below = np.maximum.accumulate(np.where(touched, d, -np.inf), 1)
    below = np.concatenate([np.full((len(d), 1), -np.inf), below[:, :-1]], 1)
    # The other pole of the model: the next one, for the last interval the one before.
    lone = np.isinf(below)
    other = np.where(top, np.where(lone, -span, np.where(lone, 0, below) - d), span)

    gaps, away, inverse, poles = _scratch(len(d), k)
    np.subtract(d[:, None, :], d[:, :, None], out=gaps)
    column = weight[:, :, None]
    whole = touched.all()
    both = None if whole else touched[:, :, None] & touched[:, None, :]
    with np.errstate(all="ignore"):
        step = span / 2
        np.subtract(gaps, step[:, :, None], out=away)
        np.reciprocal(away, out=inverse)
        value = 1 + _dot(inverse, column)
        np.multiply(inverse, inverse, out=inverse)
        slope = _dot(inverse, column)
        # Distances are taken from the nearer end of the interval, so small ones keep their digits.
        left = top | ~(value < 0)
        sign = np.where(left, 1.0, -1.0)
        value *= sign
        far = np.where(left, other, span)
        near = np.where(left, weight, _weight_above(weight, touched))
        origin = np.where(left, d, np.where(top, d, above))
        np.subtract(d[:, None, :], origin[:, :, None], out=poles)
        poles *= sign[:, :, None]
        low, high, settled = np.zeros_like(step), np.where(top, span, span / 2), ~touched
        sole, at = lone & top, None
        every = [sign, near, far, sole, low, high, settled, step, value, slope]
        for round_ in range(STEPS):
            sign_, near_, far_, sole_, low_, high_, settled_, step_, value_, slope_ = every
            low_, high_ = np.where(value_ < 0, step_, low_), np.where(value_ < 0, high_, step_)
            new = _model_root(step_, value_, slope_, near_, far_)
            new = np.where(sole_, near_, new)
            # Steps shrink quadratically: after a small one the root is there, and is left alone.
            small = np.abs(new - step_) <= SETTLED * step_
            new = np.where(small | ((new > low_) & (new < high_)), new, (low_ + high_) / 2)
            step_ = np.where(settled_, step_, new)
            settled_ = settled_ | small
            if at is not None:
                step[at] = step_
            else:
                step = step_
            if settled_.all():
                break
            if at is None and round_ < ALL_ROOTS:
                np.subtract(poles, step[:, :, None], out=inverse)
                np.reciprocal(inverse, out=inverse)
                value_ = sign + _dot(inverse, column)
                np.multiply(inverse, inverse, out=inverse)
                slope_ = _dot(inverse, column)
                every = [sign, near, far, sole, low_, high_, settled_, step_, value_, slope_]
                continue
            # Only the roots that still move.
            rest = np.nonzero(~settled_)
            at = rest if at is None else tuple(i[rest[0]] for i in at)
            every = [x[rest] for x in (sign_, near_, far_, sole_, low_, high_, settled_, step_)]
            rows = 1 / (poles[at] - every[7][:, None])
            if not whole:
                rows[weight[at[0]] == 0] = 0
            terms = rows * weight[at[0]]
            every += [every[0] + terms.sum(1), np.einsum("ij,ij->i", rows, terms)]
        np.subtract(poles, step[:, :, None], out=away)
        # away[i, j] becomes d_j - root_i; an untouched eigenvalue is its own root.
        away *= sign[:, :, None]
        here = np.arange(k)
        ratio = np.divide(away, gaps, out=inverse)
        ratio[:, here, here] = -away[:, here, here]
        if not whole:
            ratio[~both] = 1.0
        loewner = np.copysign(np.sqrt(np.abs(ratio.prod(1))), z)
        turned = np.divide(loewner[:, None, :], away, out=gaps)
        if not whole:
            turned[~both] = 0.0
            turned[:, here, here] += ~touched
        turned /= np.sqrt(np.einsum("bij,bij->bi", turned, turned))[:, :, None]
        roots = np.where(touched, origin + sign * step, d)
    if (roots[:, 1:] < roots[:, :-1]).any():
        order = np.argsort(roots, 1, kind="stable")
        roots = np.take_along_axis(roots, order, 1)
        turned = np.take_along_axis(turned, order[:, :, None], 1)
    return roots, turned


@lru_cache(maxsize=4)
def _scratch(lanes: int, k: int) -> list[np.ndarray]:
    return [np.empty((lanes, k, k)) for _ in range(4)]


def _dot(matrix: np.ndarray, column: np.ndarray) -> np.ndarray:
    """Weighted row sums; an untouched eigenvalue at a pole has weight 0 and adds nothing."""
    out = (matrix @ column)[:, :, 0]
    if np.isnan(out).any():
        return np.where(column[:, None, :, 0] == 0, 0, matrix * column[:, None, :, 0]).sum(2)
    return out


def _weight_above(weight: np.ndarray, touched: np.ndarray) -> np.ndarray:
    """The weight of the next touched eigenvalue above each."""
    lanes, k = weight.shape
    at = np.where(touched, np.arange(k), k)
    at = np.minimum.accumulate(at[:, ::-1], 1)[:, ::-1]
    at = np.concatenate([at[:, 1:], np.full((lanes, 1), k)], 1)
    return np.take_along_axis(np.concatenate([weight, np.ones((lanes, 1))], 1), at, 1)


def _model_root(step, value, slope, near, far):
    """The root of the model that has the near pole's true weight and, for all the rest, a
    constant and a pole at ``far`` with the right value and slope."""
    rest = value + near / step
    tilt = slope - near / (step * step)
    weight = tilt * (far - step) ** 2
    level = rest - tilt * (far - step)
    b = level * far + near + weight
    q = b + np.copysign(np.sqrt(np.maximum(b * b - 4 * level * near * far, 0)), b)
    return np.where((far > 0) == (b > 0), 2 * near * far / q, q / (2 * level))
