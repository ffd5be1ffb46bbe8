"""Cheapest repair of a conversation's structure by Four-Russians block tables: costs of whole blocks of rows by one lookup.

A conversation's rows, as symbols, pass an automaton for role initials ``(s?(ua)+)?`` with four states: nothing yet, after the
system row, after a user row, after an assistant row. What the rest of a conversation costs from each state is a vector of four
numbers. Less its least number it is one of a small set of vectors, closed under every symbol. So for every block of ``BLOCK`` symbols and every
vector to its right, a table holds the vector to its left and the number to add.

Conversations are read from their last block to the first, a lookup each. For the trace a block is expanded backward from the
vector at its right edge and then walked forward. In each state the smallest letter that still costs the least is taken, so among
cheapest edits the ASCII-least string is found whatever the ties.

Maps of neighbouring blocks compose, so a conversation need not be in one task. Rows are sorted by range over all tasks, and cut into parts of
bounded rows and bytes. A part that is not its whole conversation is reduced to its map of vectors and states; the maps of a conversation's parts
(a few hundred bytes for thousands of rows) are composed together, and each part is traced on its own.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1  # costs
STATES, BLOCK = 4, 4
INITIALS = "sua"
#: symbols: the initial's class (s, u, a, other) times two, plus one if truncated; a row that must go; no row
MUST_GO, NO_ROW = 8, 9
SYMBOLS = 10
BIG = 1 << 20

#: next state on s, u, a, other; -1 where the automaton has none
ON_INITIAL = np.array([[1, 2, -1, -1], [-1, 2, -1, -1], [-1, -1, 3, -1], [-1, 2, -1, -1]])
#: the state after the row that may be inserted or given a new role here: a user row, or an assistant row after a user row
ON_NEW = np.array([2, 2, 3, 2])
NEW_ROLE = ("user", "user", "assistant", "user")


def with_inserts(costs: list[int]) -> list[int]:
    """Costs where rows may be inserted first; the longest useful run is two."""
    for _ in range(2):
        costs = [min(c, INSERT + costs[ON_NEW[s]]) for s, c in enumerate(costs)]
    return costs


def before(symbol: int, costs: list[int]) -> list[int]:
    """Costs from each state before a symbol, given those after it."""
    if symbol == NO_ROW:
        return list(costs)
    out = []
    for state in range(STATES):
        ways = [DELETE + costs[state]]
        if symbol != MUST_GO:
            late = TRUNCATED * (symbol % 2)
            ways.append(REROLE + late + costs[ON_NEW[state]])
            kept = ON_INITIAL[state, symbol // 2]
            if kept >= 0:
                ways.append(KEEP + late + costs[kept])
        out.append(min(ways))
    return with_inserts(out)


def walk(symbol: int, state: int, costs: list[int]) -> tuple[str, int]:
    """Least letters for a symbol entered in ``state``, given the costs after it, and the state after it."""
    if symbol == NO_ROW:
        return "", state
    here, letters = before(symbol, costs), ""
    while True:
        late = TRUNCATED * (symbol % 2) if symbol != MUST_GO else 0
        kept = ON_INITIAL[state, symbol // 2] if symbol != MUST_GO else -1
        if DELETE + costs[state] == here[state]:
            return letters + "D", state
        if INSERT + here[ON_NEW[state]] == here[state]:
            letters, state = letters + "I", int(ON_NEW[state])
        elif kept >= 0 and KEEP + late + costs[kept] == here[state]:
            return letters + "K", int(kept)
        else:
            return letters + "R", int(ON_NEW[state])


class Tables:
    """Vectors, their transitions by symbol and by block, and the letters and states of a walk by symbol."""

    def __init__(self):
        end = tuple(with_inserts([0, BIG, BIG, 0]))
        self.vectors, self.step, self.added = [end], [], []
        known = {end: 0}
        for vector in self.vectors:
            row, add = [], []
            for symbol in range(SYMBOLS):
                costs = before(symbol, list(vector))
                least = min(costs)
                left = tuple(c - least for c in costs)
                if left not in known:
                    known[left] = len(self.vectors)
                    self.vectors.append(left)
                row.append(known[left])
                add.append(least)
            self.step.append(row)
            self.added.append(add)
        self.step, self.added = np.array(self.step), np.array(self.added)
        count = len(self.vectors)
        self.letters: list[str] = []
        places: dict[str, int] = {}
        self.walk_letters = np.zeros((count, SYMBOLS, STATES), np.int64)
        self.walk_state = np.zeros((count, SYMBOLS, STATES), np.int64)
        for v, vector in enumerate(self.vectors):
            for symbol in range(SYMBOLS):
                for state in range(STATES):
                    letters, after = walk(symbol, state, list(vector))
                    if letters not in places:
                        places[letters] = len(self.letters)
                        self.letters.append(letters)
                    self.walk_letters[v, symbol, state], self.walk_state[v, symbol, state] = places[letters], after
        # every block of BLOCK symbols; the first symbol is the block number's highest digit
        digits = np.arange(SYMBOLS ** BLOCK)[:, None] // SYMBOLS ** np.arange(BLOCK)[::-1] % SYMBOLS
        self.block_step = np.zeros((count, SYMBOLS ** BLOCK), np.int64)
        self.block_added = np.zeros((count, SYMBOLS ** BLOCK), np.int64)
        for v in range(count):
            at, total = np.full(len(digits), v), np.zeros(len(digits), np.int64)
            for k in reversed(range(BLOCK)):
                total += self.added[at, digits[:, k]]
                at = self.step[at, digits[:, k]]
            self.block_step[v], self.block_added[v] = at, total
        self.digits = digits


@lru_cache(maxsize=1)
def tables() -> Tables:
    return Tables()


END = 0  # the vector after a conversation's last row


def blocks_of(symbols: list[np.ndarray]) -> np.ndarray:
    """Block numbers of several symbol strings, a row each; strings are filled up to the longest at their end."""
    longest = max((len(s) for s in symbols), default=0)
    grid = np.full((len(symbols), max(1, -(-longest // BLOCK)) * BLOCK), NO_ROW, np.int64)
    for k, s in enumerate(symbols):
        grid[k, :len(s)] = s
    return grid.reshape(len(symbols), -1, BLOCK) @ (SYMBOLS ** np.arange(BLOCK)[::-1])


def right_vectors(blocks: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The vector to the right of each block, the one to the left of all, and the cost added by all blocks."""
    t = tables()
    rights, at, total = np.zeros(blocks.shape, np.int64), np.array(last, np.int64), np.zeros(len(blocks), np.int64)
    for k in reversed(range(blocks.shape[1])):
        rights[:, k] = at
        total += t.block_added[at, blocks[:, k]]
        at = t.block_step[at, blocks[:, k]]
    return rights, at, total


def trace(blocks: np.ndarray, rights: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letter numbers and entry states by row and place, and the last state: each block is expanded backward, then walked."""
    t = tables()
    rows, count = blocks.shape
    letters = np.zeros((rows, count * BLOCK), np.int64)
    states = np.zeros((rows, count * BLOCK), np.int64)
    state = np.array(start, np.int64)
    for k in range(count):
        symbols = t.digits[blocks[:, k]]
        after = np.zeros((rows, BLOCK), np.int64)
        at = rights[:, k]
        for j in reversed(range(BLOCK)):
            after[:, j] = at
            at = t.step[at, symbols[:, j]]
        for j in range(BLOCK):
            states[:, k * BLOCK + j] = state
            letters[:, k * BLOCK + j] = t.walk_letters[after[:, j], symbols[:, j], state]
            state = t.walk_state[after[:, j], symbols[:, j], state]
    return letters, states, state


def part_map(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every vector to the right of a part: the vector to its left, and the last state by entry state."""
    count = len(tables().vectors)
    blocks = np.repeat(blocks_of([symbols]), count, axis=0)
    rights, left, _ = right_vectors(blocks, np.arange(count))
    after = np.stack([trace(blocks, rights, np.full(count, s))[2] for s in range(STATES)], axis=1)
    return left, after


def closing(state: int) -> str:
    """Rows to insert after the last one."""
    return {0: "", 1: "II", 2: "I", 3: ""}[state]
