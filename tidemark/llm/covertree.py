"""Cover trees over vectors lifted to one sphere, searched for inner products in windows."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LEAF = 16
_POINTS_AT_ONCE = 1_024
_CENTRES_AT_ONCE = 64
# What rounding of cosines may hide, as a share of the product of two lengths.
_SLACK = 1e-6
NONE = np.int64(-(2**62))


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of whole-number rows whose lengths keep them within a long."""
    if np.sqrt(_squares(a).max(initial=0.0) * _squares(b).max(initial=0.0)) < 2.0**53:
        return np.rint(a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _squares(x: np.ndarray) -> np.ndarray:
    return (x.astype(np.float64) ** 2).sum(axis=1)


@dataclass(frozen=True)
class Level:
    """Nodes of a level: where their parent stands in the level above, the point at their
    centre, the angle that covers all their points, and which points those are."""

    parent: np.ndarray
    centre: np.ndarray
    angle: np.ndarray
    start: np.ndarray
    end: np.ndarray
    leaf: np.ndarray

    FIELDS = ("parent", "centre", "angle", "start", "end", "leaf")


class CoverTree:
    """A cover tree of one block of vectors.

    A vector ``x`` becomes ``(x, sqrt(M**2 - |x|**2))``, so that all lie on the sphere of radius
    ``M``, the longest length, and the inner product with ``(q, 0)`` stays as it was: it is
    ``|q| M`` times the cosine of their angle. Centres of a level are more than its angle apart
    and every point is within it of one; the angle halves from level to level. A node ends up as
    a leaf when it has few points or copies of one point only.
    """

    def __init__(self, points: np.ndarray, ids: np.ndarray, labels: np.ndarray, levels: list[Level] | None = None):
        self.points, self.ids, self.labels = points, ids, labels
        self.radius = float(np.sqrt(_squares(points).max(initial=0.0)))
        self.levels = self._build() if levels is None else levels
        order = np.argsort(self.ids, kind="stable")
        # Among equal scores the smaller id goes first, that is, has the greater key.
        self.late = np.empty(len(ids), np.int64)
        self.late[order] = len(ids) - 1 - np.arange(len(ids))
        self.by_late = self.ids[order][::-1]

    def _lifted(self) -> np.ndarray:
        lift = np.sqrt(np.maximum(self.radius**2 - _squares(self.points), 0.0))
        lifted = np.hstack([self.points.astype(np.float64), lift[:, None]])
        return lifted / (np.linalg.norm(lifted, axis=1, keepdims=True) if self.radius else 1.0)

    def _build(self) -> list[Level]:
        unit, n = self._lifted(), len(self.points)
        order = np.arange(n)
        reach = _angle(unit @ unit[0]).max() if self.radius else 0.0
        nodes, levels, rho = [(0, 0, reach, 0, n)], [], np.pi
        while nodes:
            leaf = [end - start <= LEAF or angle <= 0.0 for _, _, angle, start, end in nodes]
            levels.append(Level(*(np.array(v) for v in zip(*nodes)), np.array(leaf)))
            rho, below = rho / 2, []
            for at, (_, _, angle, start, end) in enumerate(nodes):
                if leaf[at]:
                    continue
                if angle <= rho:
                    below.append((at, *nodes[at][1:]))
                    continue
                members = order[start:end].copy()
                owner, centres, far = _covered(unit[members], rho)
                sort = np.argsort(owner, kind="stable")
                order[start:end] = members[sort]
                cuts = start + np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(centres)))])
                below += [
                    (at, members[c], a, i, j) for c, a, i, j in zip(centres, far, cuts[:-1].tolist(), cuts[1:].tolist())
                ]
            nodes = below
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        self.points, self.ids, self.labels = self.points[order], self.ids[order], self.labels[order]
        return [
            Level(v.parent, place[v.centre], v.angle.astype(float), v.start, v.end, v.leaf) for v in levels
        ]

    def best(self, q: np.ndarray, q_ids: np.ndarray, q_labels: np.ndarray, low: np.ndarray, high: np.ndarray, same: bool, k: int):
        """The ``k`` best scores of each query in each of its windows, and whose they are.

        ``low`` and ``high`` are closed windows, one row a query; ``same`` looks at other rows of
        the query's label, else at rows of other labels. Gives scores and ids of shape (queries,
        windows, k), falling, with `NONE` where there are no more.

        Levels are gone through from the top; of a node whose bounds miss all windows of a query
        nothing below is looked at for it. Leaves are then verified best bound first, until no
        bound reaches what is already found.
        """
        low, high = low.astype(np.int64), high.astype(np.int64)
        top = np.full((*low.shape, k), NONE, dtype=object if self._wide(q) else np.int64)
        upper = self._leaves(q, low, high)
        order = np.argsort(-upper.max(axis=0), kind="stable")
        start = np.concatenate([v.start[v.leaf] for v in self.levels])[order]
        size = np.concatenate([v.end[v.leaf] - v.start[v.leaf] for v in self.levels])[order]
        upper = upper[:, order]
        group = np.cumsum(size) // _POINTS_AT_ONCE
        cuts = np.flatnonzero(np.diff(group, prepend=-1))
        for i, j in zip(cuts, [*cuts[1:], len(group)]):
            # What a window still asks for: more than its k-th best, or anything in it.
            kth = top[:, :, -1]
            found = kth != NONE
            asks = np.where(found, kth // len(self.ids), low).astype(np.float64).min(axis=1)
            need = upper[:, i:j] >= asks[:, None]
            who, where = np.flatnonzero(need.any(axis=1)), np.flatnonzero(need.any(axis=0)) + i
            if not len(who):
                continue
            rows = np.concatenate([np.arange(start[x], start[x] + size[x]) for x in where])
            scores = inner(q[who], self.points[rows])
            equal = q_labels[who][:, None] == self.labels[rows][None, :]
            fits = (equal & (q_ids[who][:, None] != self.ids[rows][None, :])) if same else ~equal
            keys = scores.astype(top.dtype) * len(self.ids) + self.late[rows]
            for w in range(low.shape[1]):
                inside = fits & (scores >= low[who, w][:, None]) & (scores <= high[who, w][:, None])
                both = np.hstack([top[who, w], np.where(inside, keys, NONE)])
                if top.dtype != object:
                    both = np.partition(both, -k, axis=1)[:, -k:]
                top[who, w] = np.sort(both, axis=1)[:, ::-1][:, :k]
        return self._told(top)

    def _wide(self, q: np.ndarray) -> bool:
        longest = np.sqrt(_squares(q).max(initial=0.0))
        return longest * self.radius * (len(self.ids) + 1) >= 2.0**61

    def _told(self, top: np.ndarray):
        none = top == NONE
        n = max(len(self.ids), 1)
        scores = np.where(none, NONE, top // n).astype(np.int64)
        late = np.where(none, 0, top % n).astype(np.int64)
        ids = self.by_late[late] if len(self.ids) else late
        return scores, ids

    def _leaves(self, q: np.ndarray, low: np.ndarray, high: np.ndarray):
        """Upper bounds of every leaf for every query, level by level; -inf where it is out of reach."""
        length = np.linalg.norm(q.astype(np.float64), axis=1)
        unit = q / np.where(length > 0, length, 1.0)[:, None]
        size = (length * self.radius)[:, None]
        least, most = low.min(axis=1)[:, None], high.max(axis=1)[:, None]
        alive, found = np.ones((len(q), 1), bool), []
        for depth, level in enumerate(self.levels):
            if depth:
                alive = alive[:, level.parent]
            need = np.flatnonzero(alive.any(axis=0))
            centre = self.points[level.centre[need]].astype(np.float64) / (self.radius or 1.0)
            angle = _angle(unit @ centre.T)
            reach = level.angle[need]
            upper = size * (np.cos(np.maximum(angle - reach, 0.0)) + _SLACK) + 1.0
            lower = size * (np.cos(np.minimum(angle + reach, np.pi)) - _SLACK) - 1.0
            hit = alive[:, need] & (upper >= least) & (lower <= most)
            alive = np.zeros_like(alive)
            alive[:, need] = hit
            bound = np.full(alive.shape, -np.inf)
            bound[:, need] = np.where(hit, upper, -np.inf)
            found.append(bound[:, level.leaf])
        return np.hstack(found)

    def packed(self) -> list[bytes]:
        """The levels as bytes, field by field."""
        counts = np.array([len(v.parent) for v in self.levels], np.int64)
        fields = [np.concatenate([getattr(v, f) for v in self.levels]).astype(float) for f in Level.FIELDS]
        return [counts.tobytes(), np.concatenate(fields).tobytes()]

    @classmethod
    def unpacked(cls, points, ids, labels, counts: bytes, fields: bytes) -> CoverTree:
        cuts = np.cumsum(np.frombuffer(counts, np.int64))
        table = np.frombuffer(fields).reshape(len(Level.FIELDS), -1)
        kinds = (np.int64, np.int64, float, np.int64, np.int64, bool)
        columns = [row.astype(kind) for row, kind in zip(table, kinds)]
        levels = [Level(*(c[i:j] for c in columns)) for i, j in zip([0, *cuts[:-1]], cuts)]
        return cls(points, ids, labels, levels)


def _angle(cosine: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosine, -1.0, 1.0))


def _covered(unit: np.ndarray, rho: float):
    """Centres more than ``rho`` apart that cover all rows: whose each row is, and how far it goes.

    Rows are offered as centres in their order, many at once; one that an earlier centre covers
    is none. A row goes to the nearest of the centres that were there when it was first covered.
    """
    least = np.cos(rho)
    owner, angle = np.full(len(unit), -1), np.zeros(len(unit))
    left, centres = np.arange(len(unit)), []
    while len(left):
        offered = left[:_CENTRES_AT_ONCE]
        near = unit[offered] @ unit[offered].T >= least
        chosen: list[int] = []
        for i in range(len(offered)):
            if not near[i, chosen].any():
                chosen.append(i)
        cosine = unit[left] @ unit[offered[chosen]].T
        nearest = cosine.argmax(axis=1)
        closest = cosine[np.arange(len(left)), nearest]
        for number, i in enumerate(chosen):
            # Its own centre, whatever rounding says.
            nearest[i], closest[i] = number, 2.0
        taken = closest >= least
        owner[left[taken]] = nearest[taken] + len(centres)
        angle[left[taken]] = np.where(closest[taken] >= 2.0, 0.0, _angle(closest[taken]))
        centres += offered[chosen].tolist()
        left = left[~taken]
    far = np.zeros(len(centres))
    np.maximum.at(far, owner, angle)
    # Angles near zero come out of cosines with an error of about 1e-8.
    same = _all_equal(unit, owner, centres)
    return owner, centres, np.where(same, 0.0, far + 1e-7)


def _all_equal(unit: np.ndarray, owner: np.ndarray, centres: list[int]) -> np.ndarray:
    differs = (unit != unit[np.array(centres)[owner]]).any(axis=1)
    return np.bincount(owner, weights=differs, minlength=len(centres)) == 0
