"""Flow of capacity from groups to quotas, cheapest level first.

Only the arcs that leave the supply cost something, and every group has the
same ascending costs, so a flow of least cost is found by filling level after
level: a later level never makes an earlier unit worth giving back.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence


class Network:
    """Arcs with residual capacities; arc ``i ^ 1`` is the reverse of arc ``i``."""

    def __init__(self, n_nodes: int):
        self.arcs: list[list[int]] = [[] for _ in range(n_nodes)]
        self.heads: list[int] = []
        self.left: list[int] = []

    def add(self, tail: int, head: int, capacity: int) -> int:
        self.arcs[tail].append(len(self.heads))
        self.arcs[head].append(len(self.heads) + 1)
        self.heads += [head, tail]
        self.left += [capacity, 0]
        return len(self.heads) - 2

    def levels(self, start: int, end: int) -> list[int] | None:
        found = [-1] * len(self.arcs)
        found[start] = 0
        waiting = deque([start])
        while waiting:
            node = waiting.popleft()
            for arc in self.arcs[node]:
                head = self.heads[arc]
                if self.left[arc] and found[head] < 0:
                    found[head] = found[node] + 1
                    waiting.append(head)
        return found if found[end] >= 0 else None

    def fill(self, start: int, end: int) -> None:
        """Augment until no path is left."""
        while (found := self.levels(start, end)) is not None:
            nexts = [0] * len(self.arcs)
            path: list[int] = []
            node = start
            while True:
                if node == end:
                    amount = min(self.left[arc] for arc in path)
                    for arc in path:
                        self.left[arc] -= amount
                        self.left[arc ^ 1] += amount
                    node, path = start, []
                    continue
                while nexts[node] < len(self.arcs[node]):
                    arc = self.arcs[node][nexts[node]]
                    if self.left[arc] and found[self.heads[arc]] == found[node] + 1:
                        break
                    nexts[node] += 1
                if nexts[node] < len(self.arcs[node]):
                    path.append(arc)
                    node = self.heads[arc]
                elif path:
                    node = self.heads[path.pop() ^ 1]
                    nexts[node] += 1
                else:
                    break


def route(
    sizes: Sequence[int], members: Sequence[Sequence[int]], quotas: Sequence[int], repeats: int
) -> list[dict[int, int]]:
    """Units that each group sends to each quota.

    Group ``i`` offers ``sizes[i]`` units once per level for ``repeats`` levels of
    rising cost, to the quotas ``members[i]``. As much as possible is sent, at
    the least total cost.
    """
    n = len(sizes)
    start, end = n + len(quotas), n + len(quotas) + 1
    network = Network(end + 1)
    routes = [
        {quota: network.add(i, n + quota, 1 << 62) for quota in listed}
        for i, listed in enumerate(members)
    ]
    for quota, amount in enumerate(quotas):
        network.add(n + quota, end, amount)
    for _ in range(repeats):
        for i, size in enumerate(sizes):
            network.add(start, i, size)
        network.fill(start, end)
    return [{quota: network.left[arc ^ 1] for quota, arc in held.items()} for held in routes]
