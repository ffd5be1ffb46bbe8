"""A byte-level BPE tokenizer compiled into finite-state machines that say where tokens start and how many there are.

The first machine reads character classes and marks where pre-tokens start, by the published rule
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``. It has nine states, so a chunk of text is a map from nine
states to nine states. All chunks of a batch are read at once, their maps are composed by a parallel prefix scan, and a
second pass marks the starts from each chunk's true entry state.

The second machine reads the bytes of one pre-token from its start state. After any prefix exactly one token can end the
prefix's own encoding, and two neighbouring tokens may stand in an encoding iff merging their joined bytes gives the two
again. A state holds, for each suffix that begins some token, its place in the token trie, the token before it and how many tokens
precede it relative to the prefix's count; a transition is annotated with the change of the count (it may be negative where a
longer token absorbs earlier ones). Deterministic states are built as texts first need them and kept per worker.
Counts of distinct pre-tokens are kept under their bytes, so each one runs through the machine once per worker.
"""

from __future__ import annotations

import json
import unicodedata
from itertools import repeat

import numpy as np
from tokenizers import Tokenizer

from tradewind.llm import text as tx

# --- character classes and the pre-token machine ---------------------------------------------------------------------

CLASSES = {c: k for k, c in enumerate(
    ("letter", "short", "r_or_v", "e", "l", "number", "space", "white", "other", "quote", "end"))}
START, LETTERS, NUMBERS, OTHERS, SPACES, WHITES, QUOTE, QUOTE_RV, QUOTE_L = range(9)
STATES = 9
UNKNOWN = 255  # not assigned in this Python's Unicode tables: the library is asked
HERE, BEFORE = 1, 2  # a pre-token starts at this character, at the one before it


def _machine() -> tuple[np.ndarray, np.ndarray]:
    """Next state and marks, by class and state."""
    step, marks = np.zeros((len(CLASSES), STATES), np.uint8), np.zeros((len(CLASSES), STATES), np.uint8)
    letters = ("letter", "short", "r_or_v", "e", "l")
    kind = {**dict.fromkeys(letters, LETTERS), "number": NUMBERS, "other": OTHERS, "quote": OTHERS, "space": SPACES,
            "white": WHITES}
    for name, c in CLASSES.items():
        for state in range(STATES):
            if name == "end":
                to, mark = START, BEFORE if state in (QUOTE_RV, QUOTE_L) else 0
            elif state == QUOTE_RV and name == "e" or state == QUOTE_L and name == "l":
                to, mark = START, 0
            elif state == QUOTE and name in ("short", "r_or_v", "l"):
                to, mark = {"short": START, "r_or_v": QUOTE_RV, "l": QUOTE_L}[name], 0
            else:
                late = BEFORE if state in (QUOTE_RV, QUOTE_L) else 0  # the letter after the quote starts a pre-token after all
                before = {QUOTE: OTHERS, QUOTE_RV: LETTERS, QUOTE_L: LETTERS}.get(state, state)
                to = kind[name]
                if to in (SPACES, WHITES):
                    mark = 0 if before in (SPACES, WHITES) else HERE
                elif before == SPACES:
                    mark = BEFORE
                elif before == WHITES:
                    mark = BEFORE | HERE
                else:
                    mark = 0 if before == to else HERE
                if name == "quote" and mark & HERE:
                    to = QUOTE
                mark |= late
            step[c, state], marks[c, state] = to, mark
    return step, marks


STEP, MARKS = _machine()


def _class_table() -> np.ndarray:
    """Class of every code point; white space is Unicode's White_Space property."""
    letter, number, other = CLASSES["letter"], CLASSES["number"], CLASSES["other"]
    by_category = {"L": letter, "N": number}
    table = np.full(0x110000, other, np.uint8)
    for cp in range(0x110000):
        category = unicodedata.category(chr(cp))
        if category == "Cn":
            table[cp] = UNKNOWN
        elif category[0] in by_category:
            table[cp] = by_category[category[0]]
        elif category[0] == "Z":
            table[cp] = CLASSES["white"]
    table[[*range(0x09, 0x0E), 0x85]] = CLASSES["white"]
    table[0x20], table[0x27] = CLASSES["space"], CLASSES["quote"]
    for chars, name in (("stmd", "short"), ("rv", "r_or_v"), ("e", "e"), ("l", "l")):
        table[[ord(c) for c in chars]] = CLASSES[name]
    return table


def code_points(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Code points of the UTF-8 characters that start at ``starts``."""
    lead = data[starts].astype(np.int32)
    out = lead.copy()
    for size, low, keep in ((2, 0xC0, 0x1F), (3, 0xE0, 0x0F), (4, 0xF0, 0x07)):
        at = np.flatnonzero((lead >= low) & (lead < (0xE0, 0xF0, 0x100)[size - 2]))
        value = lead[at] & keep
        for k in range(1, size):
            value = (value << 6) | (data[starts[at] + k] & 0x3F)
        out[at] = value
    return out


def entry_states(classes: np.ndarray) -> np.ndarray:
    """The state in which each chunk (row of ``classes``) is entered: chunk maps composed by a prefix scan."""
    chunks, width = classes.shape
    maps = np.broadcast_to(np.arange(STATES, dtype=np.uint8), (chunks, STATES)).copy()
    flat = STEP.ravel()
    for k in range(width):
        maps = flat[classes[:, k, None].astype(np.intp) * STATES + maps]
    reach = 1
    while reach < chunks:  # after this round a map spans 2 * reach chunks
        maps[reach:] = np.take_along_axis(maps[reach:], maps[:-reach].astype(np.intp), axis=1)
        reach *= 2
    return np.concatenate([[START], maps[:-1, START]]).astype(np.uint8)


CHUNK = 64


def mark_starts(classes: np.ndarray) -> np.ndarray:
    """True where a pre-token starts, for a stream of character classes."""
    n = len(classes)
    padded = np.full(-(-n // CHUNK) * CHUNK, CLASSES["end"], np.uint8)
    padded[:n] = classes
    grid = padded.reshape(-1, CHUNK)
    state, out = entry_states(grid), np.zeros(grid.shape, np.uint8)
    step, marks = STEP.ravel(), MARKS.ravel()
    for k in range(CHUNK):
        at = grid[:, k].astype(np.intp) * STATES + state
        out[:, k], state = marks[at], step[at]
    out = out.ravel()[:n]
    starts = (out & HERE) > 0
    starts[:-1] |= (out[1:] & BEFORE) > 0
    return starts


# --- the token machine -----------------------------------------------------------------------------------------------


def byte_names() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself if printable, else one from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class TokenMachine:
    """Counts BPE tokens of byte strings by lazily built deterministic transitions."""

    def __init__(self, vocab: dict[str, int], merges: list):
        names = byte_names()
        spell = {t: bytes(names[c] for c in t) for t in vocab if all(c in names for c in t)}
        self.spelling = {vocab[t]: s for t, s in spell.items()}
        pairs = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in merges]
        self.merges = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.single = {s[0]: i for i, s in self.spelling.items() if len(s) == 1}
        if len(self.single) != 256:
            raise ValueError("the vocabulary must hold a token for every byte")
        made = {i for _, i in self.merges.values()} | set(self.single.values())
        self.child: dict[tuple[int, int], int] = {}
        self.token, self.leaf, nodes = {}, set(), 1
        for i in sorted(made):
            node = 0
            for b in self.spelling[i]:
                nxt = self.child.get((node, b))
                if nxt is None:
                    nxt = self.child[node, b] = nodes
                    nodes += 1
                node = nxt
            self.token[node] = i
        inner = {node for node, _ in self.child}
        self.leaf = {node for node in range(nodes) if node not in inner}
        self.valid: dict[tuple[int, int], bool] = {}
        self.states: dict[frozenset, int] = {}
        self.members: list[frozenset] = []
        self.next = np.zeros((0, 256), np.int32)
        self.emit = np.zeros((0, 256), np.int8)
        self.start = self.state_of(frozenset([(0, -1, 0)]))

    def encode(self, data: bytes) -> list[int]:
        """Plain merging, lowest rank first, leftmost first."""
        ids = [self.single[b] for b in data]
        while len(ids) > 1:
            best = min((self.merges.get(p, (1 << 30, 0))[0], k) for k, p in enumerate(zip(ids, ids[1:], strict=False)))
            if best[0] == 1 << 30:
                break
            k = best[1]
            ids[k:k + 2] = [self.merges[ids[k], ids[k + 1]][1]]
        return ids

    def may_follow(self, a: int, b: int) -> bool:
        if a < 0:
            known = self.valid.get((a, b))
            if known is None:
                known = self.valid[a, b] = self.encode(self.spelling[b]) == [b]
            return known
        known = self.valid.get((a, b))
        if known is None:
            known = self.valid[a, b] = self.encode(self.spelling[a] + self.spelling[b]) == [a, b]
        return known

    def state_of(self, members: frozenset) -> int:
        found = self.states.get(members)
        if found is None:
            found = self.states[members] = len(self.members)
            self.members.append(members)
            if found >= len(self.next):
                room = max(1024, 2 * len(self.next))
                grown, emit = np.full((room, 256), -1, np.int32), np.zeros((room, 256), np.int8)
                grown[:len(self.next)], emit[:len(self.emit)] = self.next, self.emit
                self.next, self.emit = grown, emit
        return found

    def build(self, state: int, byte: int) -> None:
        """Add one transition."""
        reached, last = [], None
        for node, before, count in self.members[state]:
            to = self.child.get((node, byte))
            if to is None:
                continue
            token = self.token.get(to)
            if last is None and token is not None and self.may_follow(before, token):
                last = (0, token, count + 1)
            if to not in self.leaf:
                reached.append((to, before, count))
        if last is None:
            raise ValueError("no token ends here: the merges do not form a byte-level encoding")
        change = last[2]
        members = frozenset([(0, last[1], 0)] + [(n, b, c - change) for n, b, c in reached])
        target = self.state_of(members)
        self.next[state, byte], self.emit[state, byte] = target, change

    def count(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Tokens of each byte span; all spans advance together, a byte a step."""
        sizes = ends - starts
        order = np.argsort(-sizes, kind="stable")
        starts, sizes = starts[order], sizes[order]
        state, total = np.full(len(starts), self.start, np.int64), np.zeros(len(starts), np.int64)
        alive = len(starts)
        for k in range(int(sizes[0]) if len(sizes) else 0):
            alive = int(np.searchsorted(-sizes[:alive], -k))  # spans longer than k
            byte = data[starts[:alive] + k].astype(np.int64)
            now = state[:alive]
            missing = np.flatnonzero(self.next[now, byte] < 0)
            if len(missing):
                for key in np.unique(now[missing] * 256 + byte[missing]).tolist():
                    self.build(key >> 8, key & 255)
            total[:alive] += self.emit[now, byte]
            state[:alive] = self.next[now, byte]
        out = np.zeros(len(starts), np.int64)
        out[order] = total
        return out

    def forget(self) -> None:
        """Drop the built states (they are rebuilt as needed)."""
        self.states, self.members = {}, []
        self.next, self.emit = np.zeros((0, 256), np.int32), np.zeros((0, 256), np.int8)
        self.start = self.state_of(frozenset([(0, -1, 0)]))


# --- a compiled tokenizer --------------------------------------------------------------------------------------------


class CompiledTokenizer:
    """Pre-token spans and token counts of many texts, from a tokenizer file's JSON."""

    KEPT_WORDS, KEPT_STATES = 1 << 19, 1 << 16  # memory of a worker: then the kept results start anew
    LONGEST = 64  # bytes of the longest pre-token whose count is kept

    def __init__(self, source: str):
        spec = json.loads(source)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        if (model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True)
                or spec["normalizer"] or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix",
                                                                    "end_of_word_suffix", "byte_fallback", "ignore_merges"))):
            raise ValueError("only plain byte-level BPE tokenizers can be compiled")
        self.special = {}
        for t in spec["added_tokens"]:
            if t["single_word"] or t["lstrip"] or t["rstrip"]:
                raise ValueError("added tokens that strip or need whole words can't be compiled")
            self.special[t["content"].encode()] = t["id"]
        self.library = Tokenizer.from_str(source)
        self.library.no_truncation()
        self.library.no_padding()
        self.machine = TokenMachine(model["vocab"], model["merges"])
        self.classes = _class_table()
        self.known: dict[bytes, int] = {}

    def class_of(self, cps: np.ndarray) -> np.ndarray:
        out = self.classes[cps]
        for cp in np.unique(cps[out == UNKNOWN]).tolist():
            c = chr(cp)
            split = self.library.pre_tokenizer.pre_tokenize_str
            name = "letter" if len(split(f"a{c}a")) == 1 else "number" if len(split(f"1{c}1")) == 1 else (
                "other" if len(split(f"!{c}!")) == 1 else "white")
            self.classes[cp] = CLASSES[name]
        return self.classes[cps]

    def segments(self, data: np.ndarray, offsets: np.ndarray):
        """Texts cut at special tokens: (starts, ends, row, special id or -1), in order."""
        cuts = []
        if self.special:
            raw = data.tobytes()
            found = {s: i for s, i in self.special.items() if s in raw}
            if found:
                row_ends = offsets[1:]
                at = 0
                while True:
                    hits = [(k, -len(s), s) for s in found if (k := raw.find(s, at)) >= 0]
                    if not hits:
                        break
                    k, size, s = min(hits)
                    row = int(tx.row_of(np.array([k]), offsets)[0])
                    if k - size <= row_ends[row]:
                        cuts.append((k, k - size, found[s]))
                        at = k - size
                    else:
                        at = k + 1
        if not cuts:
            rows = np.arange(len(offsets) - 1)
            return offsets[:-1], offsets[1:], rows, np.full(len(rows), -1)
        a = np.array([c[0] for c in cuts])
        b = np.array([c[1] for c in cuts])
        ids = np.array([c[2] for c in cuts])
        # plain pieces run from a row's start or a special's end to a row's end or a special's start
        starts = np.concatenate([offsets[:-1], b, a])
        kind = np.concatenate([np.full(len(offsets) - 1 + len(b), -1), ids])
        row = np.concatenate([np.arange(len(offsets) - 1), tx.row_of(a, offsets), tx.row_of(a, offsets)])
        # the k-th plain piece of a row ends where the k-th special of the row starts, the last at the row's end
        plain = len(offsets) - 1 + len(b)
        end_at = np.concatenate([offsets[1:], a])
        ends = np.empty(len(starts), np.int64)
        ends[:plain][np.lexsort((starts[:plain], row[:plain]))] = end_at[np.lexsort((end_at, row[:plain]))]
        ends[plain:] = b
        order = np.lexsort((ends, starts, row))
        return starts[order], ends[order], row[order], kind[order]

    def pretokens(self, data: np.ndarray, offsets: np.ndarray):
        """(starts, ends, row, special id or -1) of all pre-tokens and special tokens of the texts, in order."""
        seg_start, seg_end, seg_row, kind = self.segments(data, offsets)
        is_start = tx.character_starts(data)
        chars = np.flatnonzero(is_start)
        classes = self.class_of(code_points(data, chars))
        plain = np.flatnonzero((kind < 0) & (seg_end > seg_start))
        # characters of the plain segments in order, an end mark after each segment
        before = np.concatenate([[0], np.cumsum(is_start)])
        lo, n = before[seg_start[plain]], before[seg_end[plain]] - before[seg_start[plain]]
        place = np.concatenate([[0], np.cumsum(n + 1)])
        stream = np.full(place[-1], CLASSES["end"], np.uint8)
        seg = np.repeat(np.arange(len(plain)), n)
        within = np.arange(int(n.sum())) - np.repeat(np.concatenate([[0], np.cumsum(n)[:-1]]), n)
        char = lo[seg] + within
        at = place[seg] + within
        stream[at] = classes[char]
        on = mark_starts(stream)[at]
        starts, owner = chars[char[on]], plain[seg[on]]
        ends = np.append(starts[1:], 0)
        last = np.append(owner[1:] != owner[:-1], True) if len(owner) else np.zeros(0, bool)
        ends = ends[:len(starts)]
        ends[last] = seg_end[owner[last]]
        special = np.flatnonzero(kind >= 0)
        if not len(special):
            return starts, ends, seg_row[owner], np.full(len(starts), -1)
        all_starts = np.concatenate([starts, seg_start[special]])
        order = np.argsort(all_starts, kind="stable")
        return (all_starts[order], np.concatenate([ends, seg_end[special]])[order],
                np.concatenate([seg_row[owner], seg_row[special]])[order],
                np.concatenate([np.full(len(starts), -1), kind[special]])[order])

    def count_tokens(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each row."""
        starts, ends, row, special = self.pretokens(data, offsets)
        first, number = tx.same_spans(data, starts, ends)
        raw = data.tobytes()
        words = [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
        counts = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(counts < 0)
        if len(new):
            if len(self.machine.members) > self.KEPT_STATES:
                self.machine.forget()
            counts[new] = self.machine.count(data, starts[first[new]], ends[first[new]])
            if len(self.known) > self.KEPT_WORDS:
                self.known.clear()
            self.known.update((words[k], c) for k, c in zip(new.tolist(), counts[new].tolist(), strict=True)
                              if len(words[k]) <= self.LONGEST)
        each = np.where(special >= 0, 1, counts[number])
        return np.bincount(row, each, len(offsets) - 1).astype(np.int64)
