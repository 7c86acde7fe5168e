"""Minimum cut between two terminals, by augmenting along shortest paths level by level."""

from __future__ import annotations

from collections import deque


class Network:
    """Nodes with capacities from the source and to the sink, and edges with the same capacity both ways. Whole numbers."""

    def __init__(self, n: int) -> None:
        self.source, self.sink = n, n + 1
        self.edges: list[list[int]] = [[] for _ in range(n + 2)]
        self.to: list[int] = []
        self.room: list[int] = []

    def _add(self, a: int, b: int, forth: int, back: int) -> None:
        self.edges[a].append(len(self.to))
        self.to.append(b)
        self.room.append(forth)
        self.edges[b].append(len(self.to))
        self.to.append(a)
        self.room.append(back)

    def terminal(self, node: int, gain: int) -> None:
        """What it costs to put the node on the sink's side (gain > 0) or on the source's side (gain < 0)."""
        if gain > 0:
            self._add(self.source, node, gain, 0)
        elif gain < 0:
            self._add(node, self.sink, -gain, 0)

    def join(self, a: int, b: int, cost: int) -> None:
        """What it costs to part two nodes."""
        if cost > 0:
            self._add(a, b, cost, cost)

    def _levels(self) -> list[int]:
        level = [-1] * len(self.edges)
        level[self.source] = 0
        queue = deque([self.source])
        while queue:
            a = queue.popleft()
            for e in self.edges[a]:
                b = self.to[e]
                if self.room[e] and level[b] < 0:
                    level[b] = level[a] + 1
                    queue.append(b)
        return level

    def source_side(self) -> list[bool]:
        """For each node, whether it is on the source's side of the minimum cut that keeps that side smallest."""
        to, room, edges, sink = self.to, self.room, self.edges, self.sink
        level = self._levels()
        while level[sink] >= 0:
            tried = [0] * len(edges)
            path: list[int] = []
            a = self.source
            while True:
                if a == sink:
                    least = min(room[e] for e in path)
                    for k, e in enumerate(path):
                        room[e] -= least
                        room[e ^ 1] += least
                    cut = next(k for k, e in enumerate(path) if not room[e])
                    a = to[path[cut] ^ 1]
                    del path[cut:]
                    continue
                mine, at = edges[a], tried[a]
                while at < len(mine) and not (room[mine[at]] and level[to[mine[at]]] == level[a] + 1):
                    at += 1
                tried[a] = at
                if at < len(mine):
                    path.append(mine[at])
                    a = to[mine[at]]
                elif path:
                    level[a] = -1
                    a = to[path.pop() ^ 1]
                else:
                    break
            level = self._levels()
        return [at >= 0 for at in level[: self.source]]
