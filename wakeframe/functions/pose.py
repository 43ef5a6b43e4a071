"""Head pose by least squares: the rotation and place whose projected model fits the image points best.

Levenberg-Marquardt on the reprojection error, started from POSIT (DeMenthon and Davis
1995), for all rows of an Arrow batch at once.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from wakeframe.constants import FRAME_HEIGHT, FRAME_WIDTH, HEAD_MODEL, POSE_POINTS

STEPS = 40  # at most, per start
POOR = 0.01  # mean error, as a share of the image width, beyond which a second start is tried
FLAT = 1e-9
FAR = np.inf
DEGENERATE = 1e-6


def projected(r: np.ndarray, t: np.ndarray, model: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Turned model points and their places in the camera: n x k x 3 each."""
    turned = np.einsum("nij,kj->nki", r, model)
    return turned, turned + t[:, None, :]


def _residuals(seen: np.ndarray, placed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Differences in image units (n x k x 2) and half their square sums; infinite behind the camera."""
    z = placed[:, :, 2]
    front = (z > DEGENERATE).all(axis=1)
    gap = placed[:, :, :2] / np.where(z > DEGENERATE, z, 1.0)[:, :, None] - seen
    return gap, np.where(front, 0.5 * (gap**2).sum(axis=(1, 2)), FAR)


def _turn(w: np.ndarray) -> np.ndarray:
    """Rotation matrices of rotation vectors (Rodrigues)."""
    angle = np.linalg.norm(w, axis=1)
    k = w / np.where(angle > 0, angle, 1.0)[:, None]
    cross = np.zeros((len(w), 3, 3))
    cross[:, 0, 1], cross[:, 0, 2], cross[:, 1, 2] = -k[:, 2], k[:, 1], -k[:, 0]
    cross -= cross.transpose(0, 2, 1)
    s, c = np.sin(angle)[:, None, None], 1 - np.cos(angle)[:, None, None]
    return np.eye(3) + s * cross + c * (cross @ cross)


def posit(seen: np.ndarray, model: np.ndarray, rounds: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Scaled orthographic poses, corrected by the perspective of each point; nan where there is none."""
    arms = model[1:] - model[0]
    inverse = np.linalg.pinv(arms)
    depth = np.zeros((len(seen), len(arms)))
    with np.errstate(invalid="ignore", divide="ignore", over="ignore"):
        for _ in range(rounds):
            arm = seen[:, 1:] * (1 + depth)[:, :, None] - seen[:, :1]
            axes = np.einsum("ck,nka->nac", inverse, arm)
            length = np.linalg.norm(axes, axis=2)
            length = np.where(length > FLAT, length, np.nan)
            i, j = np.moveaxis(axes / length[:, :, None], 1, 0)
            k = np.cross(i, j)
            scale = np.sqrt(length[:, 0] * length[:, 1])
            depth = (k @ arms.T) * scale[:, None]
        k /= np.linalg.norm(k, axis=1)[:, None]
        r = np.stack([i, np.cross(k, i), k], axis=1)
        origin = np.concatenate([seen[:, 0], np.ones((len(seen), 1))], axis=1) / scale[:, None]
    return r, origin - r @ model[0]


def refined(seen: np.ndarray, model: np.ndarray, r: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rotation, place, half the square error) after descending from the given poses."""
    n = len(seen)
    r, t = r.copy(), t.copy()
    turned, placed = projected(r, t, model)
    gap, cost = _residuals(seen, placed)
    cost = np.where(np.isfinite(r).all(axis=(1, 2)) & np.isfinite(t).all(axis=1), cost, FAR)
    damping = np.full(n, 1e-3)
    active = np.flatnonzero(np.isfinite(cost))
    for _ in range(STEPS):
        if not len(active):
            break
        p, g = turned[active], gap[active]
        z = placed[active][:, :, 2]
        u, v = placed[active][:, :, 0] / z, placed[active][:, :, 1] / z
        x, y, d = p[:, :, 0] / z, p[:, :, 1] / z, p[:, :, 2] / z
        one, none = 1 / z, np.zeros_like(z)
        # derivatives of both image coordinates by a small turn and a small shift
        rows = np.stack(
            [np.stack([-u * y, d + u * x, -y, one, none, -u / z], axis=2), np.stack([-d - v * y, v * x, x, none, one, -v / z], axis=2)],
            axis=2,
        ).reshape(len(active), -1, 6)
        normal = rows.transpose(0, 2, 1) @ rows
        slope = (rows.transpose(0, 2, 1) @ g.reshape(len(active), -1, 1))[:, :, 0]
        diagonal = np.einsum("nii->ni", normal)
        damped = normal.copy()
        np.einsum("nii->ni", damped)[:] += damping[active][:, None] * diagonal + 1e-15 * (1 + diagonal.max(axis=1, keepdims=True))
        step = -np.linalg.solve(damped, slope[:, :, None])[:, :, 0]
        new_r, new_t = _turn(step[:, :3]) @ r[active], t[active] + step[:, 3:]
        new_turned, new_placed = projected(new_r, new_t, model)
        new_gap, new_cost = _residuals(seen[active], new_placed)
        better = new_cost < cost[active]
        old_cost = cost[active]
        at = active[better]
        r[at], t[at], cost[at] = new_r[better], new_t[better], new_cost[better]
        turned[at], placed[at], gap[at] = new_turned[better], new_placed[better], new_gap[better]
        damping[active] = np.clip(np.where(better, damping[active] / 10, damping[active] * 10), 1e-12, 1e12)
        size = np.linalg.norm(step[:, :3], axis=1)
        still = better & (size > 1e-9) & (old_cost - new_cost > 1e-12 * old_cost + 1e-24)
        stuck = ~better & (damping[active] >= 1e11)
        active = active[still | (~better & ~stuck & (old_cost > 1e-24))]
    return r, t, cost


def fitted(seen: np.ndarray, model: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rotation, place, root mean square error in image units); nan where no pose fits.

    Where the first start ends in a poor fit, a head upright before the camera is tried
    as well, and the better of the two stays.
    """
    n, k = seen.shape[:2]
    r, t, cost = refined(seen, model, *posit(seen, model))
    spread = np.ptp(np.nan_to_num(seen), axis=1).max(axis=1)
    poor = np.flatnonzero(~(np.sqrt(2 * cost / k) <= POOR) & np.isfinite(seen).all(axis=(1, 2)) & (spread > FLAT))
    if len(poor):
        upright = np.tile(np.diag([1.0, -1.0, -1.0]), (len(poor), 1, 1))
        depth = np.ptp(model, axis=0).max() / spread[poor]
        middle = np.concatenate([seen[poor].mean(axis=1), np.ones((len(poor), 1))], axis=1) * depth[:, None]
        r2, t2, cost2 = refined(seen[poor], model, upright, middle)
        wins = cost2 < np.where(np.isnan(cost[poor]), FAR, cost[poor])
        r[poor[wins]], t[poor[wins]], cost[poor[wins]] = r2[wins], t2[wins], cost2[wins]
    bad = ~np.isfinite(cost) | (spread <= FLAT)
    r[bad], t[bad], cost[bad] = np.nan, np.nan, np.nan
    return r, t, np.sqrt(2 * cost / k)


def angles_of(r: np.ndarray) -> np.ndarray:
    """Pitch, yaw and roll in degrees of rotation matrices."""
    sy = np.hypot(r[:, 0, 0], r[:, 1, 0])
    singular = sy < DEGENERATE
    pitch = np.where(singular, np.arctan2(-r[:, 1, 2], r[:, 1, 1]), np.arctan2(r[:, 2, 1], r[:, 2, 2]))
    yaw = np.arctan2(-r[:, 2, 0], sy)
    roll = np.where(singular, 0.0, np.arctan2(r[:, 1, 0], r[:, 0, 0]))
    return np.degrees(np.stack([pitch, yaw, roll], axis=1))


def head_pose(
    points: Column,
    at: Sequence[int] = POSE_POINTS,
    model: Sequence[tuple[float, float, float]] = HEAD_MODEL,
    width: int = FRAME_WIDTH,
    height: int = FRAME_HEIGHT,
    places: int = 4,
) -> Column:
    """``pitch, yaw, roll`` in degrees and ``error``, the root mean square distance in pixels.

    The focal length is the image width, the principal point its centre. The first of the
    points is the reference of the start. Missing, non-finite or collapsed points give
    0, 0, 0 and a null error.
    """
    body = np.asarray(model, dtype=float)
    k = len(body)

    def solve(*columns: pa.Array) -> pa.Array:
        seen = np.stack([c.cast(pa.float64()).to_numpy(zero_copy_only=False) for c in columns], axis=1).reshape(-1, k, 2)
        whole = np.isfinite(seen).all(axis=(1, 2))
        r, _, error = fitted(np.where(whole[:, None, None], seen, 0.0), body)
        found = np.isfinite(error) & whole
        angles = np.where(found[:, None], np.round(angles_of(r), places) + 0.0, 0.0)
        parts = [*map(pa.array, angles.T), pa.array(np.where(found, error * width, 0.0), mask=~found)]
        return pa.StructArray.from_arrays(parts, names=["pitch", "yaw", "roll", "error"])

    # the schema travels with the function; Arrow hands over whole batches
    fit = F.arrow_udf(solve, "pitch double, yaw double, roll double, error double")
    inputs = []
    for i in at:
        p = F.get(points, F.lit(i))
        inputs += [(p["x"] * width - width / 2) / width, (p["y"] * height - height / 2) / width]
    return fit(*inputs)
