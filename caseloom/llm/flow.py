"""Minimum-cost flow on small networks, on the driver.

The callers pass networks whose size is bounded by numbers of categories, never by numbers of records.
"""

from __future__ import annotations

import heapq
import random


class Network:
    """Arcs with integer capacities and costs; ``solve`` sends as much as possible at the least cost."""

    def __init__(self) -> None:
        self.index: dict = {}
        self.out: list[list[int]] = []
        self.to: list[int] = []
        self.room: list[int] = []
        self.cost: list[int] = []

    def node(self, name) -> int:
        if name not in self.index:
            self.index[name] = len(self.out)
            self.out.append([])
        return self.index[name]

    def arc(self, start, end, capacity: int, cost: int = 0) -> int:
        """Add an arc; returns its handle for :meth:`flow`."""
        s, e = self.node(start), self.node(end)
        handle = len(self.to)
        self.to += [e, s]
        self.room += [int(capacity), 0]
        self.cost += [cost, -cost]
        self.out[s].append(handle)
        self.out[e].append(handle + 1)
        return handle

    def flow(self, handle: int) -> int:
        return self.room[handle ^ 1]

    def solve(self, source, sink) -> int:
        """Primal-dual: shortest distances set the potentials, then a blocking flow fills all arcs that lie on shortest paths.

        There are as many phases as path costs occur, a number of the cost scale and not of the arcs, so
        the work grows about as the arcs do. The start potentials admit negative costs.
        """
        s, t, n = self.node(source), self.node(sink), len(self.out)
        far = float("inf")
        high = [far] * n
        high[s] = 0
        queue, waiting = [s], {s}
        while queue:
            following = []
            for x in queue:
                waiting.discard(x)
                for a in self.out[x]:
                    y = self.to[a]
                    if self.room[a] > 0 and high[x] + self.cost[a] < high[y]:
                        high[y] = high[x] + self.cost[a]
                        if y not in waiting:
                            waiting.add(y)
                            following.append(y)
            queue = following
        total = 0
        while True:
            near = [far] * n
            near[s] = 0
            heap = [(0, s)]
            while heap:
                d, x = heapq.heappop(heap)
                if d > near[x] or high[x] == far:
                    continue
                for a in self.out[x]:
                    y = self.to[a]
                    if self.room[a] > 0 and high[y] < far:
                        e = d + self.cost[a] + high[x] - high[y]
                        if e < near[y]:
                            near[y] = e
                            heapq.heappush(heap, (e, y))
            if near[t] == far:
                return total
            for x in range(n):
                if high[x] < far:
                    high[x] += min(near[x], near[t])
            while pushed := self._block(s, t, high):
                total += pushed

    def _block(self, s: int, t: int, high: list) -> int:
        """Send flow from ``s`` to ``t`` over arcs without reduced cost until each shortest such path is full; returns how much."""
        level, queue = {s: 0}, [s]
        for x in queue:
            for a in self.out[x]:
                y = self.to[a]
                if self.room[a] > 0 and y not in level and high[x] + self.cost[a] == high[y]:
                    level[y] = level[x] + 1
                    queue.append(y)
        if t not in level:
            return 0
        total, tried, path, x = 0, dict.fromkeys(level, 0), [], s
        while True:
            if x == t:
                push = min(self.room[a] for a in path)
                total += push
                full = None
                for i, a in enumerate(path):
                    self.room[a] -= push
                    self.room[a ^ 1] += push
                    if full is None and not self.room[a]:
                        full = i
                x = self.to[path[full] ^ 1]
                del path[full:]
            arcs, i = self.out[x], tried[x]
            while i < len(arcs) and not (self.room[arcs[i]] > 0 and level.get(self.to[arcs[i]]) == level[x] + 1 and high[x] + self.cost[arcs[i]] == high[self.to[arcs[i]]]):
                i += 1
            tried[x] = i
            if i < len(arcs):
                path.append(arcs[i])
                x = self.to[arcs[i]]
            elif path:
                x = self.to[path.pop() ^ 1]
                tried[x] += 1
            else:
                return total


def round_margins(cells: dict, seed: int) -> dict:
    """Random integers for the fractional ``cells`` {(row, column): value}.

    Each result is the value rounded down or up, with the value as its expectation, and each row and
    column sum is rounded down or up as well: while two fractional cells touch, mass moves along a
    cycle or path of such cells by a random one of the two steps that end a fraction. The work is the
    number of cells times the length of such a path.
    """
    dice = random.Random(seed)
    value = {k: float(v) for k, v in sorted(cells.items())}
    loose = lambda v: abs(v - round(v)) > 1e-9
    by: dict = {}
    for (r, c), v in value.items():
        if loose(v):
            by.setdefault(("r", r), {})[r, c] = None
            by.setdefault(("c", c), {})[r, c] = None
    lines = sorted(by, key=str)
    ends = [x for x in lines if len(by[x]) == 1]  # those with one loose cell; kept up to date below
    while True:
        while ends and len(by[ends[-1]]) != 1:
            ends.pop()
        while lines and not by[lines[-1]]:
            lines.pop()
        if not lines:
            return {k: round(v) for k, v in value.items()}
        at = ends[-1] if ends else lines[-1]
        walk, seen, last = [], {at: 0}, None
        while True:
            step = next((k for k in by[at] if k != last), None)
            if step is None:
                break
            walk.append(step)
            at, last = (("c", step[1]) if at[0] == "r" else ("r", step[0])), step
            if at in seen:
                walk = walk[seen[at] :]
                break
            seen[at] = len(walk)
        up, down = walk[0::2], walk[1::2]
        above = lambda k: 1 - value[k] % 1
        more = min([above(k) for k in up] + [value[k] % 1 for k in down])
        less = min([value[k] % 1 for k in up] + [above(k) for k in down])
        move = more if dice.random() < less / (more + less) else -less
        for k in up:
            value[k] += move
        for k in down:
            value[k] -= move
        for k in walk:
            if not loose(value[k]):
                value[k] = float(round(value[k]))
                for x in (("r", k[0]), ("c", k[1])):
                    by[x].pop(k, None)
                    if len(by[x]) == 1:
                        ends.append(x)
