"""Edit distance of labelled ordered trees in which whole subtrees may be put in or taken out at a discount."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

#: Fixed values of the score: every node costs 1; subtrees of more than BAR nodes cost SLOPE for each node beyond.
BAR, SLOPE = 5, 0.6


@dataclass(frozen=True)
class Tree:
    label: str
    children: Sequence[Tree] = field(default=())

    def size(self) -> int:
        return 1 + sum(c.size() for c in self.children)


def subtree_cost(size: int) -> float:
    return min(float(size), SLOPE * (size - BAR) + BAR) if size > 1 else 1.0


class _Ordered:
    """Nodes in postorder: labels, the place of each node's leftmost leaf, and the cost of its subtree."""

    def __init__(self, root: Tree):
        self.labels: list[str] = []
        self.first: list[int] = []
        self.cost: list[float] = []
        self._add(root)

    def roots(self) -> list[int]:
        """Of the nodes with one leftmost leaf the topmost, in postorder."""
        return sorted({first: i for i, first in enumerate(self.first)}.values())

    def _add(self, node: Tree) -> int:
        first = len(self.labels)
        for child in node.children:
            self._add(child)
        self.labels.append(node.label)
        self.first.append(first)
        self.cost.append(subtree_cost(len(self.labels) - first))
        return first


def distance(a: Tree, b: Tree) -> float:
    """Least cost that turns a into b, by Zhang and Shasha's tables: trees of nodes that aren't their parent's first child are
    told apart forest by forest, so time and memory grow with the product of the sizes and not with that of all ranges."""
    x, y = _Ordered(a), _Ordered(b)
    whole = [[0.0] * len(y.labels) for _ in x.labels]  # distances of the trees that end at two places
    for last in x.roots():
        i0 = x.first[last]
        for end in y.roots():
            j0 = y.first[end]
            above = [0.0]
            for j in range(j0, end + 1):
                above.append(min(above[-1] + 1, above[y.first[j] - j0] + y.cost[j]))
            forests = [above]
            for i in range(i0, last + 1):
                fi, cost, label, trees, without = x.first[i], x.cost[i], x.labels[i], whole[i], forests[x.first[i] - i0]
                row = [min(above[0] + 1, without[0] + cost)]
                for j in range(j0, end + 1):
                    fj = y.first[j]
                    at = min(above[j - j0 + 1] + 1, without[j - j0 + 1] + cost, row[-1] + 1, row[fj - j0] + y.cost[j])
                    if fi == i0 and fj == j0:
                        at = trees[j] = min(at, above[j - j0] + (label != y.labels[j]))
                    else:
                        at = min(at, without[fj - j0] + trees[j])
                    row.append(at)
                forests.append(row)
                above = row
    return whole[-1][-1]


def score(dist: float, size: int) -> float:
    """100 for equal trees, else 60 less the distance in percent of the answer's size, 0 at least."""
    return 100.0 if dist == 0 else max(0.0, 100 * SLOPE - 100 * dist / size)
