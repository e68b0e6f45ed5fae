"""Sketches of vectors: a lossless test of which vectors can be near each other at all."""

from __future__ import annotations

import functools

import numpy as np

from .common import forest

#: Directions that a sketch keeps; vectors that a task looks at in one product, of either side.
DIMS, ROWS, GUESTS = 24, 256, 4_096
#: A side of a comparison is cut into cells of about CELL sketches, CELLS at most, fitted on FIT_ROWS of them.
CELL, CELLS, FIT_ROWS, ROUNDS = 256, 2_048, 16_384, 3


def kind(dim: int) -> np.dtype:
    """A sketch of a vector of dim components: key, error, scale and scaled components."""
    return np.dtype([("key", "<i8"), ("error", "<f4"), ("scale", "<f4"), ("q", "i1", (min(dim, DIMS),))])


@functools.lru_cache(maxsize=8)
def basis(dim: int) -> np.ndarray:
    """Orthonormal directions, the same in every process."""
    return np.linalg.qr(np.random.default_rng(5).normal(size=(dim, min(dim, DIMS))))[0]


def sketch(x: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Sketches of the rows of x: the unit vector's part along the basis, in bytes, and how far off that is."""
    out = np.zeros(len(x), kind(x.shape[1]))
    with np.errstate(all="ignore"):
        norm = np.sqrt((x * x).sum(1))
        tame = np.isfinite(norm) & (norm > 1e-150)
        z = np.where(tame[:, None], x / norm[:, None], 0.0) @ basis(x.shape[1])
    scale = np.maximum(np.abs(z).max(1), 1e-6).astype(np.float32) / np.float32(127)
    q = np.clip(np.rint(z / scale[:, None].astype(np.float64)), -127, 127)
    error = np.linalg.norm(z - q * scale[:, None].astype(np.float64), axis=1)
    out["key"], out["scale"], out["q"] = key, scale, q
    # a vector whose norm isn't a proper double may be near any other
    out["error"] = np.where(tame, error * 1.0001 + 1e-6, 4.0)
    return out


def _points(s: np.ndarray) -> np.ndarray:
    return s["q"].astype(np.float32) * s["scale"][:, None]


def _slack(s: np.ndarray, p: np.ndarray, reach: float) -> np.ndarray:
    """|p - q| <= reach + both errors implies p.q + slack(p) + slack(q) >= -reach^2 / 2."""
    e = s["error"].astype(np.float64)
    return (reach * e + e * e - (p.astype(np.float64) ** 2).sum(1) / 2).astype(np.float32)


def _cells(p: np.ndarray, k: int) -> np.ndarray:
    """Euclidean k-means: at most k centroids of p."""
    rng = np.random.default_rng(3)
    x = p[rng.choice(len(p), min(len(p), FIT_ROWS), replace=False)]
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(ROUNDS):
        own = _home(x, c)
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        n = np.bincount(own, minlength=len(c))[:, None]
        c = np.where(n > 0, sums / np.maximum(n, 1), c)
    return c


def _home(p: np.ndarray, c: np.ndarray) -> np.ndarray:
    half = (c * c).sum(1) / 2
    return np.concatenate([(p[at : at + GUESTS] @ c.T - half).argmax(1) for at in range(0, len(p), GUESTS)])


def _spanning(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs (row, column) marked in near, so many that what those connect stays connected."""
    rows, cols = np.nonzero(near.any(1))[0], np.nonzero(near.any(0))[0]
    p, q = np.concatenate([rows, near[:, cols].argmax(0)]), np.concatenate([near[rows].argmax(1), cols])
    at, root = forest(p, q + len(near))
    low = np.arange(sum(near.shape))
    low[at] = root
    more = np.nonzero(near & (low[: len(near), None] != low[None, len(near) :]))
    return np.concatenate([p, more[0]]), np.concatenate([q, more[1]])


def meet(a: np.ndarray, b: np.ndarray | None, reach: float, cell: int = CELL) -> tuple[np.ndarray, np.ndarray]:
    """Sketches of a near ones of b (b None: near others of a), as stars: places in a, then b, and
    each one's root, the least place that is connected with it.

    Two vectors at most reach apart are always near; others seldom. a lies in k-means cells, and each
    sketch of the other side is compared with the cells whose border is within reach of it; of two cells
    of one side, one visits the other."""
    same = b is None
    b = a if same else b
    edges = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    if not len(a) or not len(b):
        return edges[0]
    pa = _points(a)
    c = _cells(pa, min(CELLS, max(1, len(a) // cell)))
    home = _home(pa, c)
    order = np.argsort(home, kind="stable")
    starts = np.searchsorted(home[order], np.arange(len(c) + 1))
    pa = pa[order]
    left = np.column_stack([pa, _slack(a[order], pa, reach), np.ones(len(a), np.float32)])
    # the other side comes by cells too, so that those of a turn visit the same ones
    pb = pa if same else _points(b)
    own, turn = home, order
    if not same:
        own = _home(pb, c)
        turn = np.argsort(own, kind="stable")
        pb = pb[turn]
    own, b = own[turn], b[turn]
    right = np.column_stack([pb, np.ones(len(b), np.float32), _slack(b, pb, reach)])
    least = np.float32(-reach * reach / 2 - 1e-5)
    half, apart, number = (c * c).sum(1) / 2, _apart(c), np.arange(len(c))
    far = reach + float(a["error"].max()) + b["error"]
    for lo in range(0, len(b), GUESTS):
        to = min(lo + GUESTS, len(b))
        s, mine = pb[lo:to] @ c.T - half, own[lo:to]
        gap = s[np.arange(len(s)), mine][:, None] - s
        visits = gap <= far[lo:to, None] * apart[mine] * np.float32(1.0001) + np.float32(1e-4)
        if same:
            visits &= ((mine[:, None] + number) % 2 == 1) == (mine[:, None] < number)
        visits[np.arange(len(s)), mine] = True
        visits = np.ascontiguousarray(visits.T)
        for k in np.nonzero(visits.any(1))[0]:
            guests = np.nonzero(visits[k])[0] + lo
            g = right[guests].T
            for at in range(starts[k], starts[k + 1], ROWS):
                end = min(at + ROWS, starts[k + 1])
                value = left[at:end] @ g
                if value.max() < least:
                    continue
                near = value >= least
                if same:
                    near &= np.arange(at, end)[:, None] != guests
                if near.any():
                    p, q = _spanning(near)
                    edges.append((order[at:end][p], turn[guests][q] + (0 if same else len(a))))
    p, q = (np.concatenate(z) for z in zip(*edges, strict=True))
    return forest(p, q) if len(p) else (p, q)


def _apart(c: np.ndarray) -> np.ndarray:
    c = c.astype(np.float64)
    n = (c * c).sum(1)
    return np.sqrt(np.maximum(0, n[:, None] + n[None, :] - 2 * (c @ c.T))).astype(np.float32)
