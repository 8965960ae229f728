"""Cheapest edit scripts by a persistent dynamic program.

A script is a string of edit initials.  ``Audits`` keeps all scripts of a
program in one append-only tree: a node holds the piece that it adds to its
parent, so scripts share their prefixes.  Every node knows its length, a
rolling hash of its whole script and, by binary lifting, its ancestors at
distances 1, 2, 4, ...  Scripts of equal cost are compared by the length of
their longest common prefix, found by lifting one script to its deepest
ancestor whose hash is that of a prefix of the other.  Equal hashes are then
verified against the pieces; the walk ends at the first node that both share
or that was verified before.

``Cells`` is the program over the four states of the role pattern
``(s?(ua)+)?``: 0 nothing yet, 1 after system, 2 after user, 3 after assistant.
Two different scripts of the same cost that reach the same cell are never
prefixes of each other (the rest would be insertions, which cost), so the
ASCII-least script of a cell only needs the ASCII-least ones of its cells.
"""

from __future__ import annotations

#: The costs of the edits, and of a truncated row that stays.
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 3, 4, 3, 3
STATES, ACCEPT = 4, (0, 3)
#: State after keeping a row of a role initial.
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
#: Role that a state asks for, and the state after it.
WANTED = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
FORCED = ("blank", "duplicate")
_PRIME = (1 << 61) - 31


class Audits:
    """Append-only tree of scripts; node 0 is the empty one."""

    def __init__(self, prime: int = _PRIME):
        self.prime = prime
        self.parent, self.piece, self.length, self.hash, self.up = [0], [b""], [0], [0], [()]
        self.equal: set[tuple[int, int]] = set()

    def add(self, node: int, piece: bytes) -> int:
        if not piece:
            return node
        new = len(self.parent)
        self.parent.append(node)
        self.piece.append(piece)
        self.length.append(self.length[node] + len(piece))
        self.hash.append(self._extend(self.hash[node], piece))
        up, at, j = [node], node, 0
        while j < len(self.up[at]):
            at = self.up[at][j]
            up.append(at)
            j += 1
        self.up.append(up)
        return new

    def _extend(self, start: int, piece: bytes) -> int:
        return (start * pow(256, len(piece), self.prime) + int.from_bytes(piece)) % self.prime

    def script(self, node: int) -> bytes:
        pieces = []
        while node:
            pieces.append(self.piece[node])
            node = self.parent[node]
        return b"".join(reversed(pieces))

    def _over(self, node: int, length: int) -> int:
        """The highest ancestor (or ``node``) of at least ``length``."""
        for j in range(len(self.up[node]) - 1, -1, -1):
            if j < len(self.up[node]) and self.length[self.up[node][j]] >= length:
                node = self.up[node][j]
        return node

    def _prefix_hash(self, node: int, length: int) -> int:
        top = self._over(node, length)
        if self.length[top] == length:
            return self.hash[top]
        above = self.parent[top]
        return self._extend(self.hash[above], self.piece[top][: length - self.length[above]])

    def _slice(self, node: int, start: int, stop: int) -> bytes:
        node = self._over(node, stop)
        base, pieces = self.length[node], []
        while base > start:
            pieces.append(self.piece[node])
            node = self.parent[node]
            base = self.length[node]
        return b"".join(reversed(pieces))[start - base : stop - base]

    def _same(self, a: int, b: int, length: int) -> bool:
        """Whether the first ``length`` bytes of both are the same bytes."""
        a, b, at = self._over(a, length), self._over(b, length), length
        met = (a, b)
        while at > 0:
            if a == b or self.length[a] == self.length[b] == at and (a, b) in self.equal:
                break
            over_a, over_b = self.length[self.parent[a]], self.length[self.parent[b]]
            base = max(over_a, over_b)
            if self.piece[a][base - over_a : at - over_a] != self.piece[b][base - over_b : at - over_b]:
                return False
            a = self.parent[a] if over_a == base else a
            b = self.parent[b] if over_b == base else b
            at = base
        if self.length[met[0]] == self.length[met[1]] == length:
            self.equal.add(met)
        return True

    def common(self, a: int, b: int) -> int:
        """Length of the longest common prefix of two scripts."""
        length = lambda x: self.length[x]
        fits = lambda x: length(x) <= length(b) and self.hash[x] == self._prefix_hash(b, length(x))
        low, child = a, None
        if not fits(low):
            for j in range(len(self.up[low]) - 1, -1, -1):
                if j < len(self.up[low]) and not fits(self.up[low][j]):
                    low = self.up[low][j]
            child, low = low, self.parent[low]
        if not self._same(low, b, length(low)):  # a collision: compare the scripts themselves
            return _common(self.script(a), self.script(b))
        if child is None:
            return length(low)
        return length(low) + _common(self.piece[child], self._slice(b, length(low), min(length(child), length(b))))

    def less(self, a: int, b: int) -> bool:
        if a == b:
            return False
        n = self.common(a, b)
        if n in (self.length[a], self.length[b]):
            return self.length[a] < self.length[b]
        return self._slice(a, n, n + 1) < self._slice(b, n, n + 1)


def _common(x: bytes, y: bytes) -> int:
    n = min(len(x), len(y))
    return next((i for i in range(n) if x[i] != y[i]), n)


class Cells:
    """Cheapest, then ASCII-least script per state, as (cost, node)."""

    def __init__(self, tree: Audits, start: int, fresh: bool):
        self.tree = tree
        self.best: list[tuple[int, int] | None] = [None] * STATES
        self.best[start] = (0, 0)
        if fresh:  # insertions before the first row
            self._insert()

    def _offer(self, best, state: int, cost: int, node: int, piece: bytes) -> None:
        now = best[state]
        if now is None or cost < now[0]:
            best[state] = (cost, self.tree.add(node, piece))
        elif cost == now[0]:
            new = self.tree.add(node, piece)
            if self.tree.less(new, now[1]):
                best[state] = (cost, new)

    def _insert(self) -> None:
        for state in (0, 1, 3, 2):  # no dearer script can come back to its own state
            if self.best[state]:
                cost, node = self.best[state]
                self._offer(self.best, WANTED[state][1], cost + INSERT, node, b"I")

    def row(self, initial: str, fault: str | None, copies: int = 1) -> None:
        """Take a row and its adjacent copies, which have to go."""
        extra = CUT_OFF if fault == "truncated" else 0
        new: list[tuple[int, int] | None] = [None] * STATES
        for state, cell in enumerate(self.best):
            if cell is None:
                continue
            cost, node = cell
            self._offer(new, state, cost + DELETE, node, b"D")
            if fault in FORCED:
                continue
            kept = NEXT.get((state, initial))
            if kept is not None:
                self._offer(new, kept, cost + KEEP + extra, node, b"K")
            if kept != WANTED[state][1]:
                self._offer(new, WANTED[state][1], cost + REROLE + extra, node, b"R")
        if copies > 1:
            gone = b"D" * (copies - 1)
            new = [c and (c[0] + DELETE * (copies - 1), self.tree.add(c[1], gone)) for c in new]
        self.best = new
        self._insert()


def block_scripts(rows, first: bool) -> list[tuple[int, int, int, bytes]]:
    """(start state, end state, cost, script) of all cheapest ways through a
    block of ``rows`` (initial, fault, copies); the ``first`` block of a
    conversation starts in state 0 only."""
    out = []
    for start in (0,) if first else range(STATES):
        tree = Audits()
        cells = Cells(tree, start, fresh=first)
        for r in rows:
            cells.row(*r)
        out += [(start, end, c[0], tree.script(c[1])) for end, c in enumerate(cells.best) if c]
    return out


class Chain:
    """Joins the scripts of consecutive blocks; the tree's pieces are whole
    block scripts, so memory follows the length of the audit."""

    def __init__(self):
        self.tree = Audits()
        self.best: dict[int, tuple[int, int]] = {0: (0, 0)}
        self.start: dict[int, int] = {}

    def block(self, scripts) -> None:
        new: dict[int, tuple[int, int]] = {}
        for start, end, cost, script in scripts:
            if start not in self.best:
                continue
            total = self.best[start][0] + cost
            if end not in new or total <= new[end][0]:
                node = self.tree.add(self.best[start][1], script)
                self.start[node] = start
                if end not in new or total < new[end][0] or self.tree.less(node, new[end][1]):
                    new[end] = (total, node)
        self.best = new

    def result(self) -> tuple[int, bytes, list[tuple[int, bytes]]]:
        """Cost, audit, and per block its start state and script."""
        cost, node = min((c for s, c in self.best.items() if s in ACCEPT), key=lambda c: c[0])
        for state in ACCEPT:
            if state in self.best and self.best[state][0] == cost and self.tree.less(self.best[state][1], node):
                node = self.best[state][1]
        path = []
        while node:
            path.append((self.start[node], self.tree.piece[node]))
            node = self.tree.parent[node]
        path.reverse()
        return cost, b"".join(p for _, p in path), path


def edits(script: bytes, start: int, rows):
    """(row or None for what stands before the first, place after it, initial
    of the edit, role or None for the row's own) of a block's script; ``rows``
    are (row, initial, copies).  The deleted copies of a row are left out."""
    state, row, place, skip, rows = start, None, 0, 0, iter(rows)
    for letter in script.decode():
        if letter == "I":
            place += 1
            role, state = WANTED[state]
            yield row, place, letter, role
        elif skip:
            skip -= 1
        else:
            row, initial, copies = next(rows)
            place, skip, role = 0, copies - 1, None
            if letter == "K":
                state = NEXT[state, initial]
            elif letter == "R":
                role, state = WANTED[state]
            yield row, 0, letter, role
