"""Exact search for the largest inner products within windows, by a cover tree over norm-augmented points.

Every point x gets one more coordinate sqrt(M * M - |x| * |x|), with M the largest norm, so that all have norm M. For a
query q, with 0 there, the inner product falls as the distance rises: 2 q.x = |q|^2 + M^2 - d(q, x)^2.
"""

import numpy as np

#: Radii of a level are those of the level above divided by BASE.
BASE = 1.3
#: Nodes of so few points are not divided, nor those that would need more children.
LEAF, CHILDREN = 32, 128
#: Points and queries that meet in one step, and hits that are held before they are cut to the best.
STEP, QUERIES, HELD = 2048, 1024, 1 << 20
#: Whole numbers up to here are exact as floating point numbers.
EXACT = 1 << 53

LONG = np.iinfo(np.int64)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-number rows as 64-bit numbers; those beyond are the nearest such number."""
    largest = lambda x: int(max(abs(int(x.min(initial=0))), int(x.max(initial=0))))
    if a.shape[1] * largest(a) * largest(b) < EXACT:
        return np.rint(a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, LONG.min, LONG.max).astype(np.int64) if exact.size else np.zeros(exact.shape, np.int64)


class CoverTree:
    """points: whole numbers, one row each; ids: their numbers, which order points of the same inner product."""

    def __init__(self, points: np.ndarray, ids: np.ndarray):
        n = len(points)
        flat = points.astype(np.float64)
        norms = np.einsum("ij,ij->i", flat, flat)
        self.norm = float(np.sqrt(norms.max(initial=0)))
        full = np.c_[flat, np.sqrt(np.maximum(self.norm**2 - norms, 0))]
        #: By level: centres, covering radii, parents in the level above, and numbers of leaves (-1: divided).
        self.centers: list[np.ndarray] = []
        self.radii: list[np.ndarray] = []
        self.parents: list[np.ndarray] = []
        self.leaf_of: list[np.ndarray] = []
        leaves: list[np.ndarray] = []
        nodes = [(0, self._reached(full, np.arange(n), 0), np.arange(n), -1)] if n else []
        scale = float(nodes[0][1].max(initial=0)) if n else 0.0
        while nodes:
            below, numbers = [], []
            scale /= BASE
            for place, (center, reach, members, _) in enumerate(nodes):
                divided = self._net(full, center, reach, members, scale)
                if divided is None:
                    numbers.append(len(leaves))
                    leaves.append(members)
                else:
                    numbers.append(-1)
                    below += [(*child, place) for child in divided]
            self.centers.append(full[[node[0] for node in nodes]])
            self.radii.append(np.array([node[1].max(initial=0) for node in nodes]))
            self.parents.append(np.array([node[3] for node in nodes]))
            self.leaf_of.append(np.array(numbers))
            nodes = below
        # Points leaf by leaf, in a leaf by id.
        leaf = np.repeat(np.arange(len(leaves)), [len(x) for x in leaves])
        order = np.concatenate(leaves) if leaves else np.arange(0)
        order = order[np.lexsort((ids[order], leaf))]
        self.points, self.ids, self.place = points[order], ids[order], np.argsort(order)
        self.ends = np.r_[0, np.cumsum([len(x) for x in leaves])].astype(np.int64)
        self.order = order

    @staticmethod
    def _reached(full: np.ndarray, members: np.ndarray, center: int) -> np.ndarray:
        off = full[members] - full[center]
        return np.sqrt(np.einsum("ij,ij->i", off, off))

    def _net(self, full, center: int, reach: np.ndarray, members: np.ndarray, radius: float):
        """Children (center, distances, members): the farthest point becomes the next centre until all are within the
        radius, so centres are over the radius apart. None where the node stays a leaf."""
        if len(members) <= LEAF or reach.max(initial=0) == 0:
            return None
        centers, nearest, reach = [center], np.zeros(len(members), np.int64), reach.copy()
        while reach.max() > radius:
            if len(centers) == min(CHILDREN, len(members) // 4):
                return None
            far = int(reach.argmax())
            new = self._reached(full, members, int(members[far]))
            closer = new < reach
            nearest[closer], reach[closer] = len(centers), new[closer]
            centers.append(int(members[far]))
        order = np.argsort(nearest, kind="stable")
        cuts = np.searchsorted(nearest[order], np.arange(1, len(centers)))
        return [(c, reach[own], members[own]) for c, own in zip(centers, np.split(order, cuts))]

    def _bounds(self, queries: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """The least and the largest inner product of each query with the points of each node of a level."""
        norms = np.sqrt(np.einsum("ij,ij->i", queries, queries))[:, None]
        centers, radii = self.centers[level], self.radii[level][None, :]
        middle = queries @ centers[:, :-1].T
        total = norms**2 + self.norm**2
        away = np.sqrt(np.maximum(total - 2 * middle, 0))
        upper = np.minimum(middle + norms * radii, (total - np.maximum(away - radii, 0) ** 2) / 2)
        lower = np.maximum(middle - norms * radii, (total - (away + radii) ** 2) / 2)
        slack = 1 + 1e-9 * (total + radii**2)
        return lower - slack, upper + slack

    def _leaf_bounds(self, queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """For each query and leaf the largest inner product that can be there; -inf for leaves below a node outside of the
        window."""
        upper = np.full((len(queries), len(self.ends) - 1), -np.inf)
        open_ = None
        for level, numbers in enumerate(self.leaf_of):
            least, most = self._bounds(queries, level)
            inside = (most >= low[:, None]) & (least <= high[:, None])
            open_ = inside if open_ is None else inside & open_[:, self.parents[level]]
            ends = np.flatnonzero(numbers >= 0)
            upper[:, numbers[ends]] = np.where(open_[:, ends], most[:, ends], -np.inf)
        return upper

    def search(self, queries, low, high, k: int, own, groups=None, query_groups=None):
        """The k points of the largest inner products, then of the smallest ids, within low to high for each query.

        own: the place of a point that a query never finds, or -1. Where there are groups (of points) and query_groups, points
        of the query's group are left out. Gives the number of the query, the place of the point, and the product.
        """
        own = np.where(own >= 0, self.place[own], -1) if len(self.place) else own
        groups = None if groups is None else groups[self.order]
        parts = []
        for at in range(0, len(queries), QUERIES):
            cut = slice(at, at + QUERIES)
            found = self._searched(queries[cut], low[cut], high[cut], k, own[cut], groups, None if groups is None else query_groups[cut])
            parts.append((found[0] + at, *found[1:]))
        number, place, product = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 3
        return number, self.order[place], product

    def _searched(self, queries, low, high, k, own, groups, query_groups):
        upper = self._leaf_bounds(queries.astype(np.float64), low.astype(np.float64), high.astype(np.float64))
        best = np.argsort(-upper, axis=1, kind="stable")
        bound = np.take_along_axis(upper, best, axis=1)
        # The k-th best so far: what comes after it, by product and id, is no hit.
        least, least_id = low.copy(), np.full(len(queries), LONG.max)
        held, size = [(np.zeros(0, np.int64),) * 3], 0

        def settle():
            nonlocal held, size
            number, place, product = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((self.ids[place], -product, number))
            number, place, product = number[order], place[order], product[order]
            rank = np.arange(len(number)) - np.searchsorted(number, number)
            keep = rank < k
            last = rank == k - 1
            least[number[last]], least_id[number[last]] = product[last], self.ids[place[last]]
            held, size = [(number[keep], place[keep], product[keep])], 0

        done, step = 0, 1
        while done < bound.shape[1]:
            # Leaves best first, in rounds of twice as many; a query is done when its next leaf can't reach its k-th best.
            asked = (bound[:, done : done + step] >= least[:, None].astype(np.float64)) & np.isfinite(bound[:, done : done + step])
            rows, columns = np.nonzero(asked)
            leaves = best[rows, done + columns]
            order = np.argsort(leaves, kind="stable")
            rows, leaves = rows[order], leaves[order]
            for leaf in np.unique(leaves):
                who = rows[np.searchsorted(leaves, leaf) : np.searchsorted(leaves, leaf, "right")]
                for start in range(self.ends[leaf], self.ends[leaf + 1], STEP):
                    end = min(start + STEP, self.ends[leaf + 1])
                    product = products(queries[who], self.points[start:end])
                    floor = least[who][:, None]
                    hit = (product > floor) | ((product == floor) & (self.ids[start:end][None, :] < least_id[who][:, None]))
                    hit &= product <= high[who][:, None]
                    if groups is not None:
                        hit &= groups[start:end][None, :] != query_groups[who][:, None]
                    row, place = np.nonzero(hit)
                    other = place + start != own[who][row]
                    row, place = row[other], place[other]
                    held.append((who[row], place + start, product[row, place]))
                    size += len(row)
                    if size > HELD:
                        settle()
            settle()
            done, step = done + step, 2 * step
        return held[0]
