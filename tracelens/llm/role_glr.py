"""A generalised LR parser with weighted edits, for sequences of conversation roles.

The tables are SLR(1), built from the grammar; where they hold several actions
all are followed. Stacks share their tails: a node is a state on top of
another node, equal nodes are one node, and what reaches an equal top is
merged by the minimum of (cost, audit). For a grammar whose stacks don't grow
with the input (a left-recursive one) the nodes between two symbols are a
fixed few, so a stretch of the input is a table from the node before it to the
node after it, and the tables of stretches compose.
"""

from __future__ import annotations

from functools import lru_cache

#: The start symbol is C; symbols without a rule are terminals, the initials of roles.
ROLE_GRAMMAR = (("C", ""), ("C", "P"), ("C", "sP"), ("P", "X"), ("P", "PX"), ("X", "ua"))
#: What the edits cost; a truncated row that stays costs TRUNCATED more.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Initials that rerole and insert can make.
MADE = "ua"
#: How a row is: as it should be, cut off, or one that has to go.
FINE, CUT, BAD = 0, 1, 2
#: More nodes between two symbols than this mean a grammar whose stacks grow.
MOST_NODES = 1000

#: (node before, node after) -> (cost, audit)
Table = dict[tuple[int, int], tuple[int, str]]


class RoleParser:
    """Nodes are numbers; node 0 is the empty stack."""

    def __init__(self, grammar: tuple[tuple[str, str], ...] = ROLE_GRAMMAR):
        self.rules = (("^", grammar[0][0]), *grammar)
        self.left = {a for a, _ in self.rules}
        self._tables()
        self.nodes: list[tuple[int, int]] = [(0, -1)]
        self.number = {(0, -1): 0}
        terminals = sorted({x for _, b in self.rules for x in b if x not in self.left})
        #: Nodes after a node and a terminal; nodes at which the input may end.
        self.shift: list[dict[str, list[int]]] = []
        self.accepts: list[bool] = []
        between = [0]
        for node in between:
            steps = {t: sorted({self._node(to, top) for top in self._reduced(node, t) for kind, to in self.actions.get((self.nodes[top][0], t), ()) if kind == "shift"}) for t in terminals}
            while len(self.shift) <= node:
                self.shift.append({})
            self.shift[node] = {t: x for t, x in steps.items() if x}
            between.extend(x for t in terminals for x in steps[t] if x not in between)
            if len(between) > MOST_NODES:
                raise ValueError("the stacks of this grammar grow with the input")
        self.between = between
        self.shift.extend({} for _ in range(len(self.nodes) - len(self.shift)))
        self.accepts = [any(kind == "accept" for top in self._reduced(n, "$") for kind, _ in self.actions.get((self.nodes[top][0], "$"), ())) for n in range(len(self.shift))]
        self.solve = lru_cache(1 << 16)(self._solve)

    def _node(self, state: int, below: int) -> int:
        if (state, below) not in self.number:
            self.number[state, below] = len(self.nodes)
            self.nodes.append((state, below))
        return self.number[state, below]

    def _reduced(self, node: int, ahead: str) -> list[int]:
        """The node and all that its reductions before ``ahead`` lead to."""
        found = [node]
        for top in found:
            for kind, rule in self.actions.get((self.nodes[top][0], ahead), ()):
                if kind == "reduce":
                    name, body = self.rules[rule]
                    base = top
                    for _ in body:
                        base = self.nodes[base][1]
                    new = self._node(self.goto[self.nodes[base][0], name], base)
                    if new not in found:
                        found.append(new)
        return found

    def _tables(self) -> None:
        empty = {a for a, b in self.rules if not b}
        first: dict[str, set[str]] = {a: set() for a in self.left}
        follow: dict[str, set[str]] = {a: set() for a in self.left}
        follow["^"].add("$")
        changed = True
        while changed:
            before = sum(map(len, [*first.values(), *follow.values()])) + len(empty)
            for a, body in self.rules:
                if all(x in empty for x in body):
                    empty.add(a)
                for x in body:
                    first[a] |= first.get(x, {x})
                    if x not in empty:
                        break
                after = set(follow[a])
                for x in reversed(body):
                    if x in self.left:
                        follow[x] |= after
                        after = first[x] | (after if x in empty else set())
                    else:
                        after = {x}
            changed = sum(map(len, [*first.values(), *follow.values()])) + len(empty) > before

        def closed(items: set[tuple[int, int]]) -> frozenset:
            waiting = list(items)
            for rule, dot in waiting:
                body = self.rules[rule][1]
                for k, (a, _) in enumerate(self.rules):
                    if dot < len(body) and a == body[dot] and (k, 0) not in items:
                        items.add((k, 0))
                        waiting.append((k, 0))
            return frozenset(items)

        states = [closed({(0, 0)})]
        self.actions: dict[tuple[int, str], list[tuple[str, int]]] = {}
        self.goto: dict[tuple[int, str], int] = {}
        for s, items in enumerate(states):
            moved: dict[str, set[tuple[int, int]]] = {}
            for rule, dot in sorted(items):
                a, body = self.rules[rule]
                if dot < len(body):
                    moved.setdefault(body[dot], set()).add((rule, dot + 1))
                elif rule == 0:
                    self.actions.setdefault((s, "$"), []).append(("accept", 0))
                else:
                    for x in follow[a]:
                        self.actions.setdefault((s, x), []).append(("reduce", rule))
            for x, kernel in sorted(moved.items()):
                new = closed(kernel)
                if new not in states:
                    states.append(new)
                if x in self.left:
                    self.goto[s, x] = states.index(new)
                else:
                    self.actions.setdefault((s, x), []).append(("shift", states.index(new)))

    def _inserted(self, tops: dict[int, tuple[int, str]]) -> dict[int, tuple[int, str]]:
        """The tops with what inserted roles add to them."""
        waiting = list(tops)
        while waiting:
            node = waiting.pop()
            cost, audit = tops[node]
            for t in MADE:
                for new in self.shift[node].get(t, ()):
                    value = cost + INSERT, audit + "I"
                    if new not in tops or value < tops[new]:
                        tops[new] = value
                        waiting.append(new)
        return tops

    def _row(self, tops: dict[int, tuple[int, str]], initial: str, state: int) -> dict[int, tuple[int, str]]:
        """The tops after one more row, for every edit of it."""
        out: dict[int, tuple[int, str]] = {}
        for node, (cost, audit) in tops.items():
            choices = [(node, (cost + DELETE, audit + "D"))]
            if state != BAD:
                stays = cost + (TRUNCATED if state == CUT else 0)
                for t, nodes in self.shift[node].items():
                    if t == initial:
                        choices += [(new, (stays, audit + "K")) for new in nodes]
                    elif t in MADE:
                        choices += [(new, (stays + REROLE, audit + "R")) for new in nodes]
            for new, value in choices:
                if new not in out or value < out[new]:
                    out[new] = value
        return self._inserted(out)

    def stretch(self, rows: list[tuple[str, int]], starts: list[int] | None = None) -> Table:
        """The table of a stretch of rows (initial, state), from the nodes ``starts`` (all if not given)."""
        out: Table = {}
        for start in self.between if starts is None else starts:
            tops = self._inserted({start: (0, "")})
            for initial, state in rows:
                tops = self._row(tops, initial, state)
            out.update({(start, end): value for end, value in tops.items()})
        return out

    @staticmethod
    def compose(one: Table, two: Table) -> Table:
        """The table of one stretch with another behind it."""
        by_start: dict[int, list[tuple[int, int, str]]] = {}
        for (a, b), (cost, audit) in two.items():
            by_start.setdefault(a, []).append((b, cost, audit))
        out: Table = {}
        for (a, b), (cost, audit) in one.items():
            for c, more, rest in by_start.get(b, ()):
                total = cost + more
                old = out.get((a, c))
                if old is None or total < old[0] or (total == old[0] and audit + rest < old[1]):
                    out[a, c] = total, audit + rest
        return out

    def best(self, table: Table) -> tuple[int, str]:
        """The cheapest way from the empty stack to one at which the input may end."""
        return min(value for (start, end), value in table.items() if start == 0 and self.accepts[end])

    def _solve(self, rows: tuple[tuple[str, int], ...]) -> tuple[int, str]:
        return self.best(self.stretch(list(rows), [0]))
