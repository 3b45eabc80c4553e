"""Registration of many small meshes in one task, without an exchange between its iterations.

A task holds the points and faces of whole meshes. Meshes of like size form
batches, padded to their largest, and every step of ``register`` works on a
batch at once. Each step here is the one of its name in ``register`` or
``topology``, with the same arithmetic; the tests compare both. A mesh that does
not fit in, with repeated vertices or values that are not finite, is named as
odd and left to the steps by tables.

Missing coordinates are NaN. ``alive`` tells which vertices a moving template
still has, ``met`` those with a correspondence.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from meshwright.functions.rigid import rotations
from meshwright.operators.align import MIN_WEIGHT
from meshwright.plans import bounded

# Pairs of vertices of the meshes that are worked on at once.
BATCH_PAIRS = 1 << 18
# Neighbours of a vertex that are found one by one.
FEW = 8
# Larger values are left to the steps by tables: their squares might overflow.
LARGEST_VALUE = 1.0e100

VERTEX, SCALE, TRACK, ODD = "vertex", "scale", "track", "odd"
POSITION, GOALS = ("x", "y", "z"), ("cx", "cy", "cz", "cnx", "cny", "cnz")


@dataclass(frozen=True)
class Fixed:
    """Fixed values of the registration model; ``register`` names them."""

    min_affinity: float
    min_squared_distance: float
    min_smoothing_weight: float
    sigma_range: tuple[float, float]
    inlier_passes: int
    outlier_level: float


@dataclass(frozen=True)
class Iteration:
    phase: str
    number: int
    noted: bool
    viscous: int = 0
    elastic: int = 0


class _Points:
    """Points of one side, sorted by mesh and id."""

    def __init__(self, rows: pa.Table, mesh: np.ndarray, rank: np.ndarray, ids: int, meshes: int):
        key = mesh * ids + rank
        order = np.argsort(key, kind="stable")
        self.rows, self.key, self.mesh = rows.take(pa.array(order)), key[order], mesh[order]
        self.start = np.searchsorted(self.mesh, np.arange(meshes + 1))
        self.size = np.diff(self.start)
        self.at = bounded.floats(self.rows, list(POSITION))
        self.nv = pc.fill_null(self.rows.column("nv"), -1).to_numpy()

    def odd(self) -> np.ndarray:
        """Meshes with a repeated vertex, a missing or changing size, or a value that is not a usable number."""
        wrong = np.zeros(len(self.key), bool)
        wrong[1:] = self.key[1:] == self.key[:-1]
        wrong |= pc.is_null(self.rows.column("vid")).to_numpy() | (self.nv < 0) | (self.nv != self.nv[self.start[self.mesh]])
        for axis in POSITION:
            value = pc.fill_null(self.rows.column(axis).cast(pa.float64()), 0.0).to_numpy()
            wrong |= ~(np.abs(value) <= LARGEST_VALUE)
        return self.mesh[wrong]

    def padded(self, meshes: np.ndarray, values: np.ndarray, empty: float | bool) -> np.ndarray:
        """Values of the meshes' vertices as (mesh, place, ...)."""
        table = np.full((len(meshes), int(self.size[meshes].max()), *values.shape[1:]), empty)
        for number, mesh in enumerate(meshes):
            table[number, :self.size[mesh]] = values[self.start[mesh]:self.start[mesh + 1]]
        return table


class _Faces:
    """Faces of one side, sorted by mesh, with their corners' places among the points of that side."""

    def __init__(self, rows: pa.Table, mesh: np.ndarray, ranks: list[np.ndarray], known: np.ndarray, ids: int, points: _Points):
        order = np.argsort(mesh, kind="stable")
        self.mesh, self.points = mesh[order], points
        self.key = np.stack([(mesh * ids + r)[order] for r in ranks], 1)
        self.nv = pc.fill_null(rows.column("nv"), -1).to_numpy()[order]
        self.start = np.searchsorted(self.mesh, np.arange(len(points.size) + 1))
        found = [bounded.gather(points.key, self.key[:, c]) for c in range(3)]
        self.row = np.stack([f[0] for f in found], 1)
        self.whole = found[0][1] & found[1][1] & found[2][1]
        self.known = known[order]

    def odd(self) -> np.ndarray:
        """Meshes with a face without a corner's id, or of another size than its points."""
        named = self.points.size[self.mesh] > 0
        held = np.zeros(len(self.mesh), self.nv.dtype)
        held[named] = self.points.nv[self.points.start[self.mesh[named]]]
        return self.mesh[~self.known | (named & (self.nv != held))]

    def boundary(self) -> np.ndarray:
        """Points on an edge that only one face side uses (``topology.boundary_vertices``)."""
        ids, corner = np.unique(self.key, return_inverse=True)
        corner = corner.reshape(-1, 3)
        sides = np.concatenate([corner[:, [0, 1]], corner[:, [1, 2]], corner[:, [0, 2]]])
        edges, count = np.unique(sides.min(1) * max(1, len(ids)) + sides.max(1), return_counts=True)
        once = edges[count == 1]
        ends = ids[np.unique(np.concatenate([once // max(1, len(ids)), once % max(1, len(ids))]))] if len(once) else ids[:0]
        at, there = bounded.gather(self.points.key, ends)
        return at[there]

    def badly_sized(self, zscore: float) -> np.ndarray:
        """Corners of faces of unusual area (``topology.badly_sized_vertices``)."""
        row, mesh, meshes = self.row[self.whole], self.mesh[self.whole], len(self.points.size)
        area = _doubled_areas(_crossed(self.points.at, row)) * 0.5
        row, mesh, area = row[known := np.isfinite(area)], mesh[known], area[known]
        with np.errstate(divide="ignore", invalid="ignore"):
            count = np.bincount(mesh, minlength=meshes)
            off = area - (np.bincount(mesh, area, meshes) / count)[mesh]
            deviation = np.sqrt(np.bincount(mesh, off * off, meshes) / count)[mesh]
            away = (deviation > 0.0) & (np.abs(off) / deviation > float(zscore))
        return np.unique(row[away])

    def of(self, meshes: np.ndarray, width: int) -> np.ndarray:
        """Corners of the meshes' whole faces, as rows of padded tables of ``width`` vertices a mesh."""
        parts = []
        for number, mesh in enumerate(meshes):
            own = slice(self.start[mesh], self.start[mesh + 1])
            parts.append(self.row[own][self.whole[own]] - self.points.start[mesh] + number * width)
        return np.concatenate(parts)


def _crossed(points: np.ndarray, corners: np.ndarray) -> np.ndarray:
    origin = points[corners[:, 0]]
    return _cross(points[corners[:, 1]] - origin, points[corners[:, 2]] - origin)


def _cross(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    return np.stack([u[:, 1] * v[:, 2] - u[:, 2] * v[:, 1], u[:, 2] * v[:, 0] - u[:, 0] * v[:, 2],
                     u[:, 0] * v[:, 1] - u[:, 1] * v[:, 0]], 1)


def _doubled_areas(normals: np.ndarray) -> np.ndarray:
    return np.sqrt(bounded.dot(normals, normals))


def _unit(vectors: np.ndarray, otherwise: np.ndarray | float = 0.0) -> np.ndarray:
    """Vectors divided by their length where that is positive."""
    length = _doubled_areas(vectors)[..., None]
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(length > 0.0, vectors / length, otherwise)


def vertex_normals(at: np.ndarray, corners: np.ndarray, alive: np.ndarray) -> np.ndarray:
    """Unit mean of the unit normals around each vertex; faces with a missing corner do not count."""
    flat = at.reshape(-1, 3)
    corners = corners[alive.reshape(-1)[corners].all(1)]
    normals, ends = _unit(_crossed(flat, corners)), corners.T.reshape(-1)
    summed = [np.bincount(ends, np.tile(normals[:, axis], 3), len(flat)) for axis in range(3)]
    return _unit(np.stack(summed, 1)).reshape(at.shape)


class _Space:
    """Tables of pairs that the batches of a task write into one after another."""

    def __init__(self):
        self.held: dict[str, np.ndarray] = {}

    def table(self, name: str, *shape: int) -> np.ndarray:
        size = math.prod(shape)
        if name not in self.held or len(self.held[name]) < size:
            self.held[name] = np.empty(max(size, BATCH_PAIRS))
        return self.held[name][:size].reshape(shape)


def _gaps(p: np.ndarray, q: np.ndarray, asking: np.ndarray, held: np.ndarray, space: _Space) -> np.ndarray:
    """Squared distances (mesh, place in p, place in q), infinite beside the asking and held ones."""
    shape = len(p), p.shape[1], q.shape[1]
    d2, gap = space.table("d2", *shape), space.table("other", *shape)
    d2[:] = 0.0
    for axis in range(p.shape[2]):
        np.subtract(np.ascontiguousarray(p[..., axis])[:, :, None], np.ascontiguousarray(q[..., axis])[:, None, :], out=gap)
        gap *= gap
        d2 += gap
    d2[~asking] = np.inf
    d2.swapaxes(1, 2)[~held] = np.inf
    return d2


def _nearest(d2: np.ndarray, k: int) -> np.ndarray:
    """Which columns are among the k nearest of their row, ties to the lower place; infinite ones never are."""
    there = np.isfinite(d2)
    if d2.shape[2] <= k:
        return there
    reach = np.partition(d2, k - 1, axis=2)[:, :, k - 1:k]
    near = d2 < reach
    tied = d2 == reach
    return (near | (tied & (np.cumsum(tied, 2) <= k - near.sum(2, keepdims=True)))) & there


def _near_pairs(d2: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, squared distance) of the k nearest of every row, numbered through all meshes; uses ``d2`` up."""
    meshes, rows, columns = d2.shape
    if k > FEW:
        mesh, row, column = np.nonzero(_nearest(d2, k))
        return mesh * rows + row, mesh * columns + column, d2[mesh, row, column]
    flat, first, parts = d2.reshape(-1), np.arange(meshes * rows) * columns, []
    for _ in range(min(k, columns)):
        column = d2.argmin(2).reshape(-1)
        gap = flat[first + column]
        flat[first + column] = np.inf
        row = np.flatnonzero(np.isfinite(gap))
        parts.append((row, row // rows * columns + column[row], gap[row]))
    return tuple(np.concatenate(p) for p in zip(*parts, strict=True))


def _scaled(rows: np.ndarray, w: np.ndarray, size: int) -> np.ndarray:
    total = np.bincount(rows, w, size)[rows]
    return np.divide(w, total, out=np.zeros_like(w), where=total > 0.0)


def _scale_rows(w: np.ndarray) -> None:
    """Divides weights by their row's sum; rows without weights stay so."""
    total = w.sum(2, keepdims=True)
    w /= np.where(total > 0.0, total, 1.0)


def powered(matrix: np.ndarray, values: np.ndarray, passes: int, spare: np.ndarray) -> np.ndarray:
    """``values`` after ``passes`` products with ``matrix``; squares of it take many passes at once. Uses both tables up."""
    while passes > 0:
        if passes > max(1, matrix.shape[1] // 4):
            if passes % 2:
                values = matrix @ values
            matrix, spare, passes = np.matmul(matrix, matrix, out=spare), matrix, passes // 2
        else:
            values, passes = matrix @ values, passes - 1
    return values


class _Batch:
    """Templates that move onto their targets, padded: (mesh, place, axis)."""

    def __init__(self, meshes: np.ndarray, start: _Points, start_faces: _Faces, target: _Points, target_faces: _Faces,
                 flags: np.ndarray, target_flags: np.ndarray, options, fixed: Fixed, space: _Space):
        self.o, self.fixed, self.space = options, fixed, space
        self.exists = start.padded(meshes, np.ones(len(start.key), bool), False)
        self.at = start.padded(meshes, start.at, np.nan)
        self.corners = start_faces.of(meshes, self.at.shape[1])
        self.normals = vertex_normals(self.at, self.corners, self.exists)
        self.flags = start.padded(meshes, flags, 0.0)
        goal = target.padded(meshes, target.at, np.nan)
        held = target.padded(meshes, np.ones(len(target.key), bool), False)
        normals = vertex_normals(goal, target_faces.of(meshes, goal.shape[1]), held)
        self.held = held & np.isfinite(goal).all(2)
        self.goal = np.where(self.held[..., None], np.concatenate([goal, normals], 2), 0.0)
        self.goal_flags = target.padded(meshes, target_flags, 0.0)
        self.alive = self.exists.copy()
        self.odd = np.zeros(len(meshes), bool)
        self.scale = np.ones(len(meshes))

    def match(self) -> None:
        """``register.correspondences``."""
        o, limit = self.o, float(self.o.correspondences_flag_threshold)
        asking = self.alive & np.isfinite(self.at).all(2)
        own = np.where(asking[..., None], np.concatenate([self.at, self.normals], 2), 0.0)
        d2 = _gaps(own, self.goal, asking, self.held, self.space)
        back = self.space.table("back", len(d2), d2.shape[2], d2.shape[1])
        back[:] = d2.swapaxes(1, 2)
        mine, other, k = own.reshape(-1, 6), self.goal.reshape(-1, 6), o.correspondences_num_neighbours
        flag, goal_flag = self.flags.reshape(-1), self.goal_flags.reshape(-1)

        def affinity(i: np.ndarray, j: np.ndarray, gap: np.ndarray) -> np.ndarray:
            facing = bounded.dot(mine[i, 3:], other[j, 3:]) / 2.0 + 0.5
            return np.maximum(facing / np.maximum(gap, self.fixed.min_squared_distance), self.fixed.min_affinity)

        i, j, gap = _near_pairs(d2, k)
        w, pulled = affinity(i, j, gap), np.ones(len(other))
        with np.errstate(divide="ignore", invalid="ignore"):
            if o.correspondences_symmetric:
                pj, pi, gap = _near_pairs(back, k)
                pw = affinity(pi, pj, gap)
                share = np.bincount(pj, pw * flag[pi], len(other)) / np.bincount(pj, pw, len(other))
                pulled = goal_flag * (np.nan_to_num(share) > limit)
                if o.correspondences_equalize_push_pull:
                    w, pw = _scaled(i, w, len(mine)), _scaled(pj, pw, len(other))
                i, j, w = np.concatenate([i, pi]), np.concatenate([j, pj]), np.concatenate([w, pw])
            total = np.bincount(i, w, len(mine))
            means = [np.bincount(i, w * column[j], len(mine)) / total for column in (*other.T, goal_flag, pulled)]
        self.met, self.own = (np.bincount(i, minlength=len(mine)) > 0).reshape(asking.shape), own
        self.found = np.where(self.met[..., None], np.stack(means[:6], 1).reshape(own.shape), 0.0)
        high = (means[6] > limit) & (means[7] > limit)
        self.found_flags = self.flags * high.reshape(asking.shape) * self.met

    def weigh(self, kappa: float) -> None:
        """``register.inlier_weights``."""
        damp, (low, high) = math.exp(-0.5 * float(kappa) * float(kappa)), self.fixed.sigma_range
        gap = self.found - self.own
        d2 = sum(gap[..., axis] * gap[..., axis] for axis in range(6))
        weight = np.where(self.met, self.found_flags, 0.0)
        with np.errstate(all="ignore"):
            for _ in range(self.fixed.inlier_passes):
                total = weight.sum(1)
                sigma = np.sqrt((weight * d2).sum(1) / total)
                sigma = np.where(np.isnan(sigma), high, np.minimum(high, np.maximum(low, sigma)))
                bell = np.exp(d2 * -0.5 / (sigma * sigma)[:, None])
                weight = np.where((total > 0.0)[:, None], weight * (bell / (bell + damp)), 0.0)
        facing = bounded.dot(self.own[..., 3:], self.found[..., 3:]) / 2.0 + 0.5
        self.weights = weight * np.maximum(0.0, np.minimum(1.0, facing))

    def turn(self) -> None:
        """``register.rigid_step``; a mesh without a fit ends here."""
        heavy = ((self.weights > MIN_WEIGHT) & self.met).sum(1) >= 3
        w = np.where(heavy[:, None], np.where(self.weights > MIN_WEIGHT, self.weights, 0.0), 1.0) * self.met
        with np.errstate(divide="ignore", invalid="ignore"):
            share = np.nan_to_num(w / w.sum(1)[:, None])[:, None]
            centre, goal = share @ self.own[..., :3], share @ self.found[..., :3]
            p, q = self.own[..., :3] - centre, self.found[..., :3] - goal
            pp, qq = (w * bounded.dot(p, p)).sum(1), (w * bounded.dot(q, q)).sum(1)
            rotation, strength, _ = rotations((p * w[..., None]).swapaxes(1, 2) @ q)
            scale = strength / pp if self.o.rigid_use_scaling else np.ones(len(pp))
        solved = (pp > 0.0) & (qq > 0.0)
        self.alive &= solved[:, None]
        scale = np.where(solved, scale, 1.0)
        back = rotation.reshape(-1, 3, 3).swapaxes(1, 2)
        shift = goal - scale[:, None, None] * (centre @ back)
        self.at = scale[:, None, None] * (self.at @ back) + shift
        turned = self.normals @ back
        self.normals = _unit(turned, turned)
        self.scale = np.where(solved, self.scale * scale, self.scale)

    def pull(self, viscous: int, elastic: int) -> None:
        """``register.viscoelastic_step``."""
        o, floor = self.o, self.fixed.min_smoothing_weight
        there = self.alive & np.isfinite(self.at).all(2)
        moves = self.alive & self.met
        # A template that moves in part needs passes that spread from place to place.
        self.odd |= moves.any(1) & (moves != there).any(1)
        places, weight = np.where(there[..., None], self.at, 0.0), self.weights
        values = np.where(moves[..., None], (self.found[..., :3] - places) * weight[..., None], 0.0)
        passes, diffuse = max(0, viscous) + max(0, elastic), int(o.outlier_diffusion_iterations)
        if passes > 0 or diffuse > 0:
            base = _gaps(places, places, there, there, self.space)
            near = _nearest(base, o.transform_num_neighbours)
            base *= -0.5 / (float(o.transform_sigma) * float(o.transform_sigma))
            np.exp(base, out=base)
            base *= (self.flags * (1.0 - floor))[:, None, :]
            base += floor
            base *= near
            _scale_rows(base)
        if passes > 0:
            mixed = np.multiply(base, (weight * (1.0 - floor))[:, None, :], out=self.space.table("other", *base.shape))
            mixed += floor
            mixed *= near
            _scale_rows(mixed)
            values = powered(mixed, values, passes, self.space.table("back", *base.shape))
        if diffuse > 0:
            weak, own = (weight <= self.fixed.outlier_level)[..., None], weight[..., None]
            for _ in range(diffuse):
                values = np.where(weak, values * own + (base @ values) * (1.0 - own), values)
        self.at = np.where(moves[..., None], places + values, np.nan)
        self.alive, before = moves, self.normals
        normals = vertex_normals(self.at, self.corners, moves)
        agreement = np.where(moves, bounded.dot(normals, before), 0.0).sum(1)
        self.normals = normals * np.where(agreement < 0.0, -1.0, 1.0)[:, None, None]

    def residuals(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``register.residuals``: which meshes have any, mean distance, mean weight."""
        rows = self.alive & self.met
        gap = np.where(rows[..., None], self.found[..., :3] - self.at, 0.0)
        with np.errstate(divide="ignore", invalid="ignore"):
            count = rows.sum(1)
            return count > 0, _doubled_areas(gap).sum(1) / count, np.where(rows, self.weights, 0.0).sum(1) / count

    def run(self, iterations: list[Iteration]) -> list[tuple[Iteration, np.ndarray, np.ndarray, np.ndarray]]:
        track = []
        for step in iterations:
            self.match()
            if step.phase == "rigid":
                self.weigh(self.o.rigid_inlier_kappa)
                self.turn()
                self.rigid_alive, self.rigid_at = self.alive.copy(), self.at
            else:
                self.weigh(self.o.nonrigid_inlier_kappa)
                self.pull(step.viscous, step.elastic)
            if step.noted:
                track.append((step, *self.residuals()))
        return track


def _batches(meshes: np.ndarray, start: np.ndarray, target: np.ndarray) -> Iterator[np.ndarray]:
    """Meshes of like size, at most ``BATCH_PAIRS`` pairs of vertices together."""
    size = np.maximum(start, target)[meshes]
    meshes, size = meshes[order := np.argsort(size, kind="stable")], np.sort(size)
    first = 0
    while first < len(meshes):
        end = first + 1
        while end < len(meshes) and (end + 1 - first) * int(size[end]) ** 2 <= BATCH_PAIRS:
            end += 1
        yield meshes[first:end]
        first = end


def worker(options, fixed: Fixed, iterations: list[Iteration], largest: int, shared: bool, empty: pa.Table) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Registers all meshes of a task.

    Points are (mesh_id, nv, vid, x, y, z, goal), faces (mesh_id, nv, a, b, c,
    goal): ``goal`` marks the targets', and with ``shared`` the faces belong to
    both sides. Meshes of more than ``largest`` vertices are odd.
    """
    o = options

    def rows(kind: str, count: int, **columns) -> pa.Table:
        columns["row"] = pa.array([kind] * count, pa.string())
        return pa.table([columns[f.name] if f.name in columns else pa.nulls(count, f.type) for f in empty.schema], names=empty.column_names)

    def work(points: pa.Table, faces: pa.Table) -> pa.Table:
        mesh, face_mesh = bounded.mesh_numbers(points, faces)
        names = pa.concat_arrays([t.column("mesh_id").combine_chunks() for t in (points, faces)]).dictionary_encode().dictionary
        ids, ranks, known = bounded.ranked(points.column("vid"), *[faces.column(c) for c in "abc"])
        goal, face_goal = (t.column("goal").to_numpy() for t in (points, faces))
        named = known[1] & known[2] & known[3]
        sides = []
        for second in (False, True):
            own, sided = goal == second, np.ones(len(face_goal), bool) if shared else face_goal == second
            held = _Points(points.filter(pa.array(own)), mesh[own], ranks[0][own], len(ids), len(names))
            sides.append((held, _Faces(faces.filter(pa.array(sided)), face_mesh[sided], [r[sided] for r in ranks[1:]], named[sided], len(ids), held)))
        (start, start_faces), (target, target_faces) = sides
        odd = np.zeros(len(names), bool)
        for side in (start, start_faces, target, target_faces):
            odd[side.odd()] = True
        odd |= np.maximum(start.size, target.size) > largest
        flags, target_flags = np.ones(len(start.key)), np.ones(len(target.key))
        if o.flag_floating_boundary:
            flags[start_faces.boundary()] = 0.0
        if o.flag_target_boundary:
            target_flags[target_faces.boundary()] = 0.0
        if o.flag_target_badly_sized_triangles:
            target_flags[target_faces.badly_sized(o.triangle_size_zscore)] = 0.0
        parts, space = [], _Space()
        # A template without a target has no correspondences, so it has no results.
        for meshes in _batches(np.flatnonzero(~odd & (start.size > 0) & (target.size > 0)), start.size, target.size):
            batch = _Batch(meshes, start, start_faces, target, target_faces, flags, target_flags, o, fixed, space)
            track = batch.run(iterations)
            odd[meshes[batch.odd]] = True
            fine = ~batch.odd
            for step, known, gap, weight in track:
                use = known & fine
                count = int(use.sum())
                parts.append(rows(
                    TRACK, count, mesh_id=names.take(pa.array(meshes[use])), phase=pa.array([step.phase] * count, pa.string()),
                    iteration=pa.array(np.full(count, step.number, np.int32)), residual_mean=pa.array(gap[use]),
                    inlier_weight_mean=pa.array(weight[use])))
            use = batch.rigid_alive.any(1) & fine
            parts.append(rows(SCALE, int(use.sum()), mesh_id=names.take(pa.array(meshes[use])), rigid_scale=pa.array(batch.scale[use])))
            left = (batch.rigid_alive | batch.alive | batch.met) & fine[:, None]
            number, place = np.nonzero(left)
            point = pa.array(start.start[meshes[number]] + place)
            parts.append(rows(
                VERTEX, len(number), mesh_id=names.take(pa.array(meshes[number])), nv=start.rows.column("nv").take(point),
                vid=start.rows.column("vid").take(point), rigid=pa.array(batch.rigid_alive[left]), moved=pa.array(batch.alive[left]),
                met=pa.array(batch.met[left]), flag=pa.array(batch.found_flags[left]), weight=pa.array(batch.weights[left]),
                **{f"r{a}": pa.array(batch.rigid_at[left][:, c], from_pandas=True) for c, a in enumerate(POSITION)},
                **{a: pa.array(batch.at[left][:, c], from_pandas=True) for c, a in enumerate(POSITION)},
                **{a: pa.array(batch.found[left][:, c]) for c, a in enumerate(GOALS)}))
        parts.append(rows(ODD, int(odd.sum()), mesh_id=names.take(pa.array(np.flatnonzero(odd)))))
        return pa.concat_tables(p.cast(empty.schema) for p in parts)

    return work
