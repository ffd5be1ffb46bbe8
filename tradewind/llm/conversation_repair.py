"""Structure repair of conversations: faults counted, then the cheapest edits that make the roles alternate (see ``turn_repair``).

Rows are taken by turn (null turns first), then by role and text. Each row's first fault counts: blank, a repeat of a role and text
seen earlier in the conversation, truncated (its last character beyond white space is not ``.!?``). Blank and repeated rows have to go.

Equal rows of one turn are counted, not carried. The first turn of a role and text comes from a grouped minimum, joined back on
conversation, text and turn, so neither a conversation nor a line that holds a third of all rows is a hot key. Rows are then sorted by
range over all tasks and packed into parts of at most ``PART_ROWS`` rows or ``PART_BYTES`` bytes of text. Conversations that lie within
one part (nearly all) are repaired in their row. The others' parts are reduced to small maps; these meet per conversation, and each part
then learns its right edge and entry state. So a conversation of any length is repaired by many tasks in bounded memory. Only a digest of a
whole conversation's text reads its parts in one task, one after another, as such a digest has to.

Null ids, turns, roles and texts: an id or turn of null is a group or place of its own; null roles and texts are one space. An empty table gives
no rows. Conversations without rows (all dropped) keep one empty part. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm import turn_repair as tr
from tradewind.llm.frames import map_batches, quoted, stored

PART_ROWS, PART_BYTES = 16384, 4 << 20
PIECE_ROWS, COPIES = 1024, 4096
BLANK, REPEAT = -1, -2
NOT_SPACE = "[^\\x20\\x09-\\x0D]"
WHOLE_SENTENCE = "[.!?][\\x20\\x09-\\x0D]*\\z"

#: a part of a conversation: its rows as symbols, the messages that may stay, and what its faults add up to
PART = ("conv_id long, place long, alone boolean, symbols binary, roles array<string>, texts array<string>, min_turn long, max_turn long, "
        "turns long, blank long, duplicate long, truncated long, illegal long, first_initial int, last_initial int")
EDGES = "place long, right int, state int, last boolean, less_turns long, more_illegal long"
REPAIRED = ("conv_id long, place long, alone boolean, min_turn long, max_turn long, turns long, blank long, duplicate long, "
            "truncated long, illegal long, cost long, audit string, roles array<string>, texts array<string>")


def narrowed(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    space = F.lit(" ")
    return df.select(quoted(conv_col).cast("long").alias("conv_id"), quoted(turn_col).cast("long").alias("turn"),
                     F.coalesce(quoted(role_col).cast("string"), space).alias("role"),
                     F.coalesce(quoted(text_col).cast("string"), space).alias("text"))


def damage(df: DataFrame, **columns: str) -> DataFrame:
    """Rows with planted faults, by CRC-32 of ``conv_id:turn``: dropped, emptied, without stops, repeated, or said by the user.

    Dropped rows stay as marked rows without role and text, so that their conversation is not lost.
    """
    rows = narrowed(df, **columns)
    names = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat_ws(":", *names).cast("binary")) % 20
    rows = rows.withColumn("kind", kind)
    empty = F.lit("")
    text = F.when(F.col("kind") < 2, empty).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 0, empty).when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("kind") == 0).alias("dropped"),
                       F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(1))).otherwise(F.array(F.lit(1)))).alias("one")).drop("one")


def marked(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, dropped, number, n, initial, symbol): equal rows once with their number, in runs of at most ``COPIES``.

    ``symbol`` is that of the run's first row, whose repeats the others are; REPEAT if all of the run repeat an earlier row, BLANK if
    all are blank.
    """
    digest = F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256)
    held = rows.select("*", F.when(F.col("dropped"), F.lit("")).otherwise(digest).alias("digest"),
                       # (given, at) and (named, conv) stand for turn and conv_id without nulls, in the same order
                       F.col("turn").isNotNull().alias("given"), F.coalesce("turn", F.lit(0)).alias("at"),
                       F.col("conv_id").isNotNull().alias("named"), F.coalesce("conv_id", F.lit(0)).alias("conv"))
    same = ["named", "conv", "digest", "dropped"]
    first = held.groupBy(*same).agg(F.min(F.struct("given", "at")).alias("f")).select(
        *same, F.col("f.given").alias("given"), F.col("f.at").alias("at"), F.lit(True).alias("is_first"))
    spot = [*same, "given", "at"]
    counted = held.groupBy(*spot).agg(*[F.first(c).alias(c) for c in ("conv_id", "turn", "role", "text")], F.count("*").alias("n"))
    placed = counted.join(first, spot, "left")
    head = F.substring("role", 1, 1)
    initial = F.when(head == "s", 0).when(head == "u", 1).when(head == "a", 2).otherwise(3)
    late = (~F.col("text").rlike(WHOLE_SENTENCE)).cast("int")
    runs = placed.select("conv_id", "turn", "role", "text", "dropped", "n", "is_first", initial.alias("initial"), late.alias("late"),
                         F.explode(F.sequence(F.lit(0).cast("long"), ((F.col("n") - 1) / COPIES).cast("long"))).alias("number"))
    symbol = F.when(~F.col("text").rlike(NOT_SPACE), BLANK).when(
        F.col("is_first").isNotNull() & (F.col("number") == 0), 2 * F.col("initial") + F.col("late")).otherwise(REPEAT)
    return runs.select("conv_id", "turn", "role", "text", "dropped", "number",
                       F.least(F.lit(COPIES), F.col("n") - F.col("number") * COPIES).alias("n"), "initial", symbol.alias("symbol"))


LEGAL = np.zeros((4, 4), bool)  # su, ua, au
LEGAL[0, 1] = LEGAL[1, 2] = LEGAL[2, 1] = True


def as_parts(parts: list[tuple[list[pa.RecordBatch], int, bool]]) -> pa.RecordBatch:
    """Rows of parts, each with its place and whether it is all of its conversation, as one row a part."""
    table = pa.Table.from_batches([b for batches, _, _ in parts for b in batches])
    edges = np.cumsum([0, *[sum(b.num_rows for b in batches) for batches, _, _ in parts]])
    owner = np.repeat(np.arange(len(parts)), np.diff(edges))
    ids = table["conv_id"].take(pa.array(edges[:-1]))
    stay = ~table["dropped"].to_numpy()
    table, owner = table.filter(pa.array(stay)), owner[stay]
    symbol, n, initial = (table[c].to_numpy().astype(np.int64) for c in ("symbol", "n", "initial"))
    count, new = len(parts), symbol >= 0

    def total(values):
        return pa.array(np.bincount(owner, values, count).astype(np.int64))

    # a run's copies stand side by side with equal roles; between runs the initials decide
    between = np.zeros(len(owner), np.int64)
    between[1:] = (owner[1:] == owner[:-1]) & ~LEGAL[initial[:-1], initial[1:]]
    rows = np.repeat(np.where(new, tr.MUST_GO, symbol), n)
    rows[rows < 0] = tr.MUST_GO
    rows[(np.cumsum(n) - n)[new]] = symbol[new]
    length = np.bincount(owner, n, count).astype(np.int64)
    strings = np.split(rows.astype(np.uint8), np.cumsum(length)[:-1])
    lists = pa.array(np.concatenate([[0], np.cumsum(np.bincount(owner, new, count))]).astype(np.int32))
    messages = table.filter(pa.array(new))
    roles, texts = (pa.ListArray.from_arrays(lists, messages[c].combine_chunks()) for c in ("role", "text"))
    turn = table["turn"].fill_null(0).to_numpy()
    given = table["turn"].is_valid().to_numpy()
    fresh = given.copy()
    fresh[1:] &= (owner[1:] != owner[:-1]) | ~given[:-1] | (turn[1:] != turn[:-1])
    low, high = np.full(count, np.iinfo(np.int64).max), np.full(count, np.iinfo(np.int64).min)
    np.minimum.at(low, owner[given], turn[given])
    np.maximum.at(high, owner[given], turn[given])
    none = low > high
    head, tail = np.full(count, -1), np.full(count, -1)
    head[owner[::-1]] = initial[::-1]
    tail[owner] = initial
    columns = {
        "conv_id": ids.combine_chunks(), "place": pa.array([p for _, p, _ in parts], pa.int64()), "alone": pa.array([a for _, _, a in parts]),
        "symbols": pa.array([s.tobytes() for s in strings], pa.binary()), "roles": roles, "texts": texts,
        "min_turn": pa.array(low, mask=none), "max_turn": pa.array(high, mask=none), "turns": total(fresh),
        "blank": total(n * (symbol == BLANK)), "duplicate": total(np.where(new, n - 1, n * (symbol == REPEAT))),
        "truncated": total(new & (symbol % 2 == 1)), "illegal": total(n - 1 + between),
        "first_initial": pa.array(head.astype(np.int32)), "last_initial": pa.array(tail.astype(np.int32))}
    return pa.RecordBatch.from_pydict(columns)


def conversations(batches):
    """(conversation, rows of it in one batch) in order; no piece exceeds a part's rows."""
    for batch in batches:
        named = batch.column("conv_id").is_valid().to_numpy(zero_copy_only=False)
        ids = batch.column("conv_id").fill_null(0).to_numpy()
        cuts = np.flatnonzero((ids[1:] != ids[:-1]) | (named[1:] != named[:-1])) + 1
        edges = [0, *cuts.tolist(), batch.num_rows]
        for lo, hi in zip(edges, edges[1:], strict=False):
            for at in range(lo, hi, PIECE_ROWS):
                yield (bool(named[at]), int(ids[at])), batch.slice(at, min(PIECE_ROWS, hi - at))


def parts_of(rows: DataFrame) -> DataFrame:
    """Parts of conversations, from all rows sorted by range."""
    # range bounds are sampled: a text's start is enough to tell the rows of one turn apart there; the sort itself reads it whole
    ranged = rows.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 64))
    ranged = ranged.sortWithinPartitions("conv_id", "turn", "role", "text", "number")

    def run(batches):
        place, ready, load = TaskContext.get().partitionId() << 33, [], 0
        current, held, size, whole = None, [], 0, False  # the last conversation, its rows so far; may they be all of it
        for conversation, piece in conversations(b for b in batches if b.num_rows):
            bulk = int(np.sum(piece.column("n").to_numpy())) + piece.nbytes * PART_ROWS // PART_BYTES
            ended = conversation != current
            if held and (ended or size + bulk > PART_ROWS):
                ready.append((held, place, whole and ended))
                load, place, held, size, whole = load + size, place + 1, [], 0, whole and ended
                if load > PART_ROWS:
                    yield as_parts(ready)
                    ready, load = [], 0
            if ended:
                # the task's first conversation may have begun in the task before
                whole = current is not None
                current = conversation
            held.append(piece)
            size += bulk
        if held:  # and the last may go on in the next
            ready.append((held, place, False))
        if ready:
            yield as_parts(ready)

    return ranged.mapInArrow(run, PART)


def edges_of(parts: DataFrame) -> DataFrame:
    """For parts that are not alone: the vector at the right edge, the entry state, and what overlaps with the part before.

    Only maps travel: a conversation's group holds a few hundred bytes for each of its parts.
    """
    def maps(batch):
        found = [tr.part_map(np.frombuffer(s.as_buffer(), np.uint8)) for s in batch.column("symbols")]
        left, after = (pa.array([m[k].astype(np.uint8).tobytes() for m in found], pa.binary()) for k in (0, 1))
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in few], left, after], [*few, "left", "after"])

    few = ["conv_id", "place", "min_turn", "max_turn", "first_initial", "last_initial"]
    small = map_batches(parts.select(*few, "symbols"), maps, "conv_id long, place long, min_turn long, max_turn long, first_initial int, "
                        "last_initial int, left binary, after binary")

    def compose(key, table):
        rows = table.sort_by("place").to_pylist()
        vectors = len(tr.tables().vectors)
        at = tr.END
        for row in reversed(rows):
            row["right"], at = at, row["left"][at]
        state, turn, initial = 0, None, -1
        out = []
        for k, row in enumerate(rows):
            after = np.frombuffer(row["after"], np.uint8).reshape(vectors, tr.STATES)
            more = int(min(initial, row["first_initial"]) >= 0 and not LEGAL[initial, row["first_initial"]])
            out.append((row["place"], row["right"], state, k == len(rows) - 1, int(turn is not None and turn == row["min_turn"]), more))
            state = int(after[row["right"], state])
            turn = row["max_turn"] if row["max_turn"] is not None else turn
            initial = row["last_initial"] if row["last_initial"] >= 0 else initial
        place, right, state, last, less, more = zip(*out, strict=True)
        return pa.table({"place": pa.array(place, pa.int64()), "right": pa.array(right, pa.int32()), "state": pa.array(state, pa.int32()),
                         "last": pa.array(last), "less_turns": pa.array(less, pa.int64()), "more_illegal": pa.array(more, pa.int64())})

    return small.groupBy("conv_id").applyInArrow(compose, EDGES)


def repaired_rows(letters: list[str], symbols: np.ndarray, states: np.ndarray, tail: str, state: int, roles: list, texts: list):
    """(edits, roles, texts) of a part after its edits."""
    out_roles, out_texts, message = [], [], 0
    for edits, symbol, at in zip(letters, symbols.tolist(), states.tolist(), strict=True):
        for edit in edits:
            if edit == "I":
                out_roles.append(tr.NEW_ROLE[at])
                out_texts.append("")
                at = int(tr.ON_NEW[at])
            elif edit != "D":
                out_roles.append(roles[message] if edit == "K" else tr.NEW_ROLE[at])
                out_texts.append(texts[message])
        message += symbol < tr.MUST_GO
    for _ in tail:
        out_roles.append(tr.NEW_ROLE[state])
        out_texts.append("")
        state = int(tr.ON_NEW[state])
    return "".join(letters) + tail, out_roles, out_texts


def traced(parts: DataFrame) -> DataFrame:
    """Repaired parts, from parts that know their edges."""

    def run(batch):
        rows = batch.to_pylist()
        rows.sort(key=lambda r: len(r["symbols"]))
        lo = 0
        while lo < len(rows):  # strings of like length side by side
            hi, longest = lo, 0
            while hi < len(rows) and (hi == lo or (hi - lo + 1) * max(longest, len(rows[hi]["symbols"])) <= 1 << 18):
                longest = max(longest, len(rows[hi]["symbols"]))
                hi += 1
            yield repaired(rows[lo:hi])
            lo = hi

    def repaired(some):
        t = tr.tables()
        strings = [np.frombuffer(r["symbols"], np.uint8) for r in some]
        blocks = tr.blocks_of(strings)
        rights, _, _ = tr.right_vectors(blocks, np.array([r["right"] for r in some]))
        letters, states, ends = tr.trace(blocks, rights, np.array([r["state"] for r in some]))
        out = []
        for k, (row, symbols) in enumerate(zip(some, strings, strict=True)):
            tail = tr.closing(int(ends[k])) if row["last"] else ""
            edits = [t.letters[x] for x in letters[k, :len(symbols)].tolist()]
            audit, roles, texts = repaired_rows(edits, symbols, states[k, :len(symbols)], tail, int(ends[k]), row["roles"], row["texts"])
            late = sum(1 for e, s in zip(edits, symbols.tolist(), strict=True) if s < tr.MUST_GO and s % 2 and e[-1] != "D")
            cost = tr.DELETE * audit.count("D") + tr.REROLE * audit.count("R") + tr.INSERT * audit.count("I") + tr.TRUNCATED * late
            out.append((row["conv_id"], row["place"], row["alone"], row["min_turn"], row["max_turn"], row["turns"] - row["less_turns"],
                        row["blank"], row["duplicate"], row["truncated"], row["illegal"] + row["more_illegal"], cost, audit, roles, texts))
        long, text, names = pa.int64(), pa.string(), [c.split(" ")[0] for c in REPAIRED.split(", ")]
        kinds = [long, long, pa.bool_(), *[long] * 8, text, pa.list_(text), pa.list_(text)]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return map_batches(parts, run, REPAIRED)


def repair(rows: DataFrame) -> DataFrame:
    """Repaired parts of conversations in order of ``place``: faults, cost, edits, and the roles and texts after them.

    ``rows`` has conv_id, turn, role, text and dropped, as ``damage`` gives them; ``alone`` marks a part that is its whole conversation.
    """
    parts = stored(parts_of(stored(marked(rows), "marked")), "parts")
    apart = parts.where(~F.col("alone"))
    edges = edges_of(apart)
    plain = {"right": F.lit(tr.END), "state": F.lit(0), "last": F.lit(True), "less_turns": F.lit(0).cast("long"),
             "more_illegal": F.lit(0).cast("long")}
    return traced(parts.where("alone").select("*", *[c.alias(k) for k, c in plain.items()])
                  .unionByName(apart.join(edges, "place")))


SUMMARY = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
           "repaired_sha256 string")
SUMS = ("blank", "duplicate", "truncated", "illegal", "cost")


def summary(parts: DataFrame) -> DataFrame:
    """One row per conversation: its faults, cost, edits and the SHA-256 of its repaired ``role:text`` lines."""
    lines = F.array_join(F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit(":"), t)), "\n")
    # no turn at all: no gap
    gaps = F.coalesce(F.col("max_turn") - F.col("min_turn") + 1 - F.col("turns"), F.lit(0)).alias("gaps")
    alone = parts.where("alone").select("conv_id", gaps, *SUMS, "audit", F.sha2(lines.cast("binary"), 256).alias("repaired_sha256"))

    def run(batches):
        current, state = None, None

        def done():
            low, high, turns, sums, audit, digest, _ = state
            gap = high - low + 1 - turns if low is not None else 0
            values = [current[1], gap, *sums, "".join(audit), digest.hexdigest()]
            kinds = [*[pa.int64()] * 7, pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)],
                                              [c.split(" ")[0] for c in SUMMARY.split(", ")])

        for batch in batches:
            for k in range(batch.num_rows):  # a part at a time: memory holds one
                row = batch.slice(k, 1).to_pylist()[0]
                conversation = (row["conv_id"] is not None, row["conv_id"])
                if conversation != current:
                    if current is not None:
                        yield done()
                    current, state = conversation, [None, None, 0, [0] * len(SUMS), [], hashlib.sha256(), False]
                if row["min_turn"] is not None:
                    state[0] = row["min_turn"] if state[0] is None else min(state[0], row["min_turn"])
                    state[1] = row["max_turn"] if state[1] is None else max(state[1], row["max_turn"])
                state[2] += row["turns"]
                state[3] = [a + row[c] for a, c in zip(state[3], SUMS, strict=True)]
                state[4].append(row["audit"])
                for role, text in zip(row["roles"], row["texts"], strict=True):
                    state[5].update(f"{chr(10) if state[6] else ''}{role}:{text}".encode())
                    state[6] = True
        if current is not None:
            yield done()

    apart = parts.where(~F.col("alone")).repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return alone.unionByName(apart.mapInArrow(run, SUMMARY))
