"""An M-tree in pages: routing objects with covering radii, and distances to parents.

It holds whole-number vectors for inner-product search. A vector is given one more
coordinate that brings it to the common length ``M``, and a query a zero there; then
the squared distance is ``|q|^2 + M^2 - 2 q.x``, and the nearest vectors are those of
the highest inner product. Distances are computed from products in double precision;
pruning leaves room for what they may be off by. Scores are exact: where products may
pass 2**53 they are computed from the whole numbers again for the entries that count.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np

#: Entries of a page, about.
PAGE = 512


#: Beyond this, a double does not hold every whole number.
EXACT = 2.0**53


def room(longest: float) -> float:
    """How far a distance may be off, by the rounding of products of this length."""
    return 4 * np.sqrt(longest * 1e-13) + 1e-6


def doubt(longest: float) -> float:
    """How far a product may be off."""
    return 0.0 if longest < EXACT else longest * 1e-13


def exact(one: np.ndarray, other: np.ndarray) -> int:
    """The product of vectors whose doubles are whole numbers."""
    return sum(int(a) * int(b) for a, b in zip(one.tolist(), other.tolist()))


@dataclass
class Page:
    """Entries of a node. ``below`` is the child's page, or in a leaf the entry's number."""

    number: int
    leaf: bool
    vectors: np.ndarray  # entry, coordinate
    radius: np.ndarray  # of the subtree below an entry; 0 in a leaf
    to_parent: np.ndarray  # distance of an entry to the routing object above the page
    below: np.ndarray


def _lift(norms: np.ndarray, longest: float) -> np.ndarray:
    return np.sqrt(np.maximum(longest - norms, 0.0))


def distances(one: np.ndarray, many: np.ndarray, longest: float) -> np.ndarray:
    """Distances of a stored vector to others, all of them brought to one length."""
    norm, norms = float(one @ one), np.einsum("ij,ij->i", many, many)
    product = many @ one + _lift(norms, longest) * _lift(np.array(norm), longest)
    return np.sqrt(np.maximum(2 * longest - 2 * product, 0.0))


def build(vectors: np.ndarray, longest: float, page: int = PAGE) -> tuple[list[Page], int, float]:
    """Pages of a tree over all vectors (page 0 is the root), the vector at its centre, and
    the radius about it."""
    values = vectors.astype(np.float64)
    pages: list[Page] = []

    def fill(members: np.ndarray, centre: int) -> int:
        number = len(pages)
        to_centre = distances(values[centre], values[members], longest)
        own = Page(number, True, values[members], np.zeros(len(members)), to_centre, members)
        pages.append(own)
        if len(members) <= page:
            return number
        fan = min(page, -(-len(members) // page) + 1)
        # Routing objects spread evenly over the members in order of distance.
        ranked = members[np.argsort(to_centre, kind="stable")]
        routing = ranked[np.linspace(0, len(members) - 1, fan).astype(int)]
        to_routing = np.stack([distances(values[r], values[members], longest) for r in routing])
        nearest = to_routing.argmin(axis=0)
        groups = [(r, members[nearest == i], to_routing[i][nearest == i]) for i, r in enumerate(routing)]
        groups = [g for g in groups if len(g[1])]
        if len(groups) == 1:  # nothing tells them apart: cut in two
            half = len(members) // 2
            groups = [
                (part[0], part, distances(values[part[0]], values[part], longest))
                for part in (members[:half], members[half:])
            ]
        objects = np.array([g[0] for g in groups])
        children = np.array([fill(g[1], int(g[0])) for g in groups])
        own.leaf, own.vectors, own.below = False, values[objects], children
        own.radius = np.array([g[2].max() for g in groups])
        own.to_parent = distances(values[centre], values[objects], longest)
        return number

    middle = values.mean(axis=0)
    centre = int(np.argmin(((values - middle) ** 2).sum(axis=1)))
    fill(np.arange(len(values)), centre)
    return pages, centre, float(distances(values[centre], values, longest).max())


class Best:
    """The ``size`` highest scores so far; ties go to smaller ids."""

    def __init__(self, size: int, floor: float | int = -np.inf) -> None:
        self._size = size
        self._floor = floor
        self.found: list[tuple[int, int]] = []  # negative score, id

    def add(self, score: int, ids: list[int]) -> None:
        self.found += [(-score, i) for i in ids]
        if len(self.found) > self._size:
            self.found = sorted(self.found)[: self._size]

    @property
    def worst(self) -> float | int:
        """A score below this one cannot come in."""
        full = -max(self.found)[0] if len(self.found) >= self._size else -np.inf
        return max(full, self._floor)


def search(
    pages: dict[int, Page],
    query: np.ndarray,
    best: Best,
    ids: list[list[int]],
    longest: float,
) -> int:
    """Best-first search of one tree; gives the number of distances computed."""
    norm, slack, unsure = float(query @ query), room(longest), doubt(longest)

    def reach() -> float:
        """Distance beyond which nothing can come in, with room for rounding."""
        if best.worst == -np.inf:
            return np.inf
        return np.sqrt(max(norm + longest - 2 * best.worst, 0.0)) * (1 + 1e-9) + slack

    queue: list[tuple[float, int, float | None]] = [(0.0, 0, None)]
    computed = 0
    while queue:
        least, number, to_parent = heapq.heappop(queue)
        if least > reach():
            break
        page = pages[number]
        near = np.arange(len(page.below))
        if to_parent is not None:
            # The triangle inequality, by stored distances only.
            near = np.flatnonzero(np.abs(to_parent - page.to_parent) - page.radius <= reach())
        products = page.vectors[near] @ query
        computed += len(near)
        if page.leaf:
            for i in np.flatnonzero(products >= best.worst - unsure):
                score = exact(page.vectors[near[i]], query) if unsure else int(products[i])
                if score >= best.worst:
                    best.add(score, ids[page.below[near[i]]])
            continue
        to_query = np.sqrt(np.maximum(norm + longest - 2 * products, 0.0))
        lower = np.maximum(to_query - page.radius[near], 0.0)
        limit = reach()
        for i in np.flatnonzero(lower <= limit):
            heapq.heappush(queue, (float(lower[i]), int(page.below[near[i]]), float(to_query[i])))
    return computed
