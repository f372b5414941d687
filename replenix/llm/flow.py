"""Minimum-cost flow by successive shortest paths (Dijkstra with potentials) on a small graph."""

from __future__ import annotations

import heapq


class Graph:
    def __init__(self, nodes: int):
        self.arcs: list[list[int]] = []          # [to, capacity left, cost]; arc i ^ 1 is the reverse of arc i
        self.out: list[list[int]] = [[] for _ in range(nodes)]

    def add(self, a: int, b: int, capacity: int, cost: int) -> int:
        for x, y, c, k in ((a, b, capacity, cost), (b, a, 0, -cost)):
            self.out[x].append(len(self.arcs))
            self.arcs.append([y, c, k])
        return len(self.arcs) - 2

    def flow(self, arc: int) -> int:
        return self.arcs[arc ^ 1][1]

    def solve(self, start: int, end: int) -> tuple[int, int]:
        """Largest flow from start to end at least cost; (flow, cost).  Costs must not be negative."""
        potential, total, paid = [0] * len(self.out), 0, 0
        while True:
            distance, via = {start: 0}, {}
            heap, done = [(0, start)], set()
            while heap:
                d, a = heapq.heappop(heap)
                if a in done:
                    continue
                done.add(a)
                for i in self.out[a]:
                    b, capacity, cost = self.arcs[i]
                    new = d + cost + potential[a] - potential[b]
                    if capacity > 0 and new < distance.get(b, new + 1):
                        distance[b], via[b] = new, i
                        heapq.heappush(heap, (new, b))
            if end not in distance:
                return total, paid
            far = max(distance.values())
            potential = [p + distance.get(n, far) for n, p in enumerate(potential)]
            path, n = [], end
            while n != start:
                path.append(via[n])
                n = self.arcs[via[n] ^ 1][0]
            amount = min(self.arcs[i][1] for i in path)
            for i in path:
                self.arcs[i][1] -= amount
                self.arcs[i ^ 1][1] += amount
                paid += amount * self.arcs[i][2]
            total += amount


def route(patterns: list[tuple[tuple[int, ...], int]], quotas: list[int], max_epochs: int) -> list[dict[int, int]]:
    """Capacity of every pattern that goes to each of its sources.

    ``patterns``: (sources of the pattern, its size).  The k-th use of a pattern's capacity costs k * k, so that
    repetition is spread evenly before anything is used a further time.
    """
    n, m = len(patterns), len(quotas)
    graph = Graph(n + m + 2)
    start, end = n + m, n + m + 1
    arcs: list[dict[int, int]] = []
    for p, (sources, size) in enumerate(patterns):
        for epoch in range(max_epochs):
            graph.add(start, p, size, epoch * epoch)
        arcs.append({s: graph.add(p, n + s, size * max_epochs, 0) for s in sources})
    for s, quota in enumerate(quotas):
        graph.add(n + s, end, quota, 0)
    graph.solve(start, end)
    return [{s: graph.flow(a) for s, a in to.items() if graph.flow(a)} for to in arcs]
