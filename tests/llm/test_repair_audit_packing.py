"""Conversation repair, filter audit and swap packing against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict
from itertools import combinations, permutations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm import tables
from tradewind.llm import conversation_repair as cr
from tradewind.llm import filter_audit, queries, swap_packing, token_ids
from tradewind.llm import turn_repair as tr

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
ON_INITIAL = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

# --- conversations ---------------------------------------------------------------------------------------------------


def damaged(rows):
    held = defaultdict(list)
    for conv, turn, role, text in rows:
        held[conv]  # noqa: B018 - conversations without rows count too
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        held[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return held


def cheapest(rows, faults):
    """Cost and ASCII-least edits by costs to go, row by row, and the repaired lines."""
    far, n = 10 ** 9, len(rows)

    def closed(v):
        for _ in range(3):
            v = [min(v[q], 2 + v[3 if q == 2 else 2]) for q in range(4)]
        return v

    def kept(q, i):
        return ON_INITIAL.get((q, rows[i][1][:1]))

    togo = [closed([0, far, far, 0])]
    for i in reversed(range(n)):
        v = []
        for q in range(4):
            ways = [3 + togo[0][q]]
            if faults[i] not in ("blank", "duplicate"):
                late = faults[i] == "truncated"
                ways.append(2 + late + togo[0][3 if q == 2 else 2])
                if kept(q, i) is not None:
                    ways.append(late + togo[0][kept(q, i)])
            v.append(min(ways))
        togo.insert(0, closed(v))
    i = q = 0
    audit, lines = "", []
    while i < n or q not in (0, 3):
        new, role, here = (3, "assistant", togo[i][q]) if q == 2 else (2, "user", togo[i][q])
        if i < n and 3 + togo[i + 1][q] == here:
            audit, i = audit + "D", i + 1
        elif 2 + togo[i][new] == here:
            audit, q = audit + "I", new
            lines.append(f"{role}:")
        else:
            late = faults[i] == "truncated"
            keeps = kept(q, i) is not None and late + togo[i + 1][kept(q, i)] == here
            audit += "K" if keeps else "R"
            lines.append(f"{rows[i][1] if keeps else role}:{rows[i][2]}")
            q, i = kept(q, i) if keeps else new, i + 1
    return togo[0][0], audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def repaired(rows):
    out = {}
    for conv, held in damaged(rows).items():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults = set(), []
        for _, role, text in held:
            core = text.strip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [t for t, _, _ in held if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [r[:1] for _, r, _ in held]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        out[conv] = (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, *cheapest(held, faults))
    return out


def conversations(seed=4):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", None, "", "assistant", "user"]
    texts = ["Hi.", "ok", "", None, " ", "why?  ", "no\n", "x" * 50, "été!", "a:b."]
    rows = [(1, k, ("user", "assistant")[k % 2], f"line {k}.") for k in range(8)]
    for conv, n in ((None, 30), (7, 1), (8, 60), (9, 400), (10, 2)):
        rows += [(conv, rng.choice([None, *range(40)]), rng.choice(roles), rng.choice(texts)) for _ in range(n)]
    rows += [(11, k // 2, rng.choice(roles), rng.choice(texts) if k % 3 else f"text {k}.") for k in range(1500)]
    rows += [(12, None, "user", "same.")] * 300  # a third of a kind
    rows += [(13, k, "user", "word " * 20000) for k in range(3)]  # long texts
    dropped = [t for t in range(200) if zlib.crc32(f"14:{t}".encode()) % 20 == 0][:2]
    return rows + [(14, t, "user", "gone.") for t in dropped]


def frame(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name in ("digest", "n", "place", "symbol", "at", "kind", "dropped", "named"):
        df = df.withColumn(name, F.lit(name))
    return df


@pytest.mark.parametrize("part_rows", [16384, 50])
def test_conversations_match_brute_force(spark, monkeypatch, part_rows):
    monkeypatch.setattr(cr, "PART_ROWS", part_rows)
    monkeypatch.setattr(cr, "COPIES", 64)
    rows = conversations()
    out = cr.summary(cr.repair(cr.damage(frame(spark, rows).repartition(3)))).collect()
    assert {r[0]: tuple(r)[1:] for r in out} == repaired(rows)
    assert len(out) == len({r[0] for r in rows})


def test_given_conversations_match_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()]
    out = queries.op12_conversation_structure_repair(spark, sf_dir).collect()
    assert {r[0]: tuple(r)[1:] for r in out} == repaired(rows)


def test_no_conversations(spark):
    assert cr.summary(cr.repair(cr.damage(frame(spark, [])))).collect() == []


def test_blocks_equal_single_steps_and_parts_compose():
    t, rng = tr.tables(), random.Random(1)
    for _ in range(200):
        symbols = np.array([rng.randrange(9) for _ in range(rng.randrange(0, 23))], np.int64)
        costs = list(t.vectors[tr.END])
        for s in reversed(symbols.tolist()):
            costs = tr.before(s, costs)
        blocks = tr.blocks_of([symbols])
        _, left, added = tr.right_vectors(blocks, np.array([tr.END]))
        assert [added[0] + c for c in t.vectors[left[0]]] == costs
        cut = rng.randrange(len(symbols) + 1)
        (l1, s1), (l2, s2) = tr.part_map(symbols[:cut]), tr.part_map(symbols[cut:])
        whole = tr.part_map(symbols)
        assert (l1[l2] == whole[0]).all()
        for v in range(len(t.vectors)):
            assert [s2[v, s1[l2[v], s]] for s in range(4)] == whole[1][v].tolist()


# --- filters ---------------------------------------------------------------------------------------------------------


def audited(rows, labels):
    known = defaultdict(lambda: [False, False])
    for doc, quality, toxic in labels:
        if doc is not None:
            known[doc][0] |= quality == 1
            known[doc][1] |= toxic == 1
    first = {}
    for doc, text, *_ in rows:
        if doc is not None:
            first[text or ""] = min(first.get(text or "", doc), doc)
    parts = defaultdict(list)
    for doc, text, _, source, _ in rows:
        text = text or ""
        words = [w for w in re.split("[\x20\x09-\x0D]+", text) if w]
        fails = {letter for letter, failed in zip("ABCDE", (
            len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            re.search("[#$%&*|]", text) is not None, doc is not None and doc > first[text]), strict=True) if failed}
        parts[source or ""].append((fails, *(known[doc] if doc is not None else (False, False))))
    out = {}
    for part, docs in parts.items():
        shapley = defaultdict(int)
        for order in permutations("ABCDE"):
            left = docs
            for step, letter in enumerate(order, 1):
                gone = [d for d in left if letter in d[0]]
                left = [d for d in left if letter not in d[0]]
                fails = sum(letter in d[0] for d in docs)
                shapley[letter] += len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), fails - len(gone), sum(d[0] == {letter} for d in docs),
                                                   sum(d[1] for d in gone), sum(d[2] for d in gone)]
        for (p, order, step), values in out.items():
            if p == part:
                values.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def test_audit_matches_brute_force(spark):
    rows = tables.awkward() + [(900 + k, "SHOUT & 100% " * 3, "en", "src1", 1) for k in range(40)] + [(700, None, None, "", 0)]
    labels = [(k, k % 2, k % 3 == 0) for k in range(0, 45, 2)] + [(4, 1, 1), (None, 1, 1), (5, None, 1), (901, 1, None)]
    labels = [(d, q, int(t) if t is not None else None) for d, q, t in labels]
    found = filter_audit.audit(tables.frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert found.columns == ["part", "filter_order", "step", *filter_audit.COLUMNS]
    assert {tuple(r)[:3]: tuple(r)[3:] for r in found.collect()} == audited(rows, labels)


def test_audit_equals_its_sql(spark, sf_dir):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    done = con.execute(queries.ORACLE["op11_filter_interaction_audit"])
    columns = [c[0] for c in done.description]
    found = queries.op11_filter_interaction_audit(spark, sf_dir).select(*columns).collect()
    assert sorted(map(tuple, found)) == sorted(done.fetchall())


def test_audit_of_nothing(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(tables.empty(spark), labels).collect() == []


def test_carry_save_counts_are_plain_counts():
    rng = np.random.default_rng(3)
    for n, groups in ((0, 3), (1, 1), (5, 2), (1000, 7), (1000, 900)):
        g, w = rng.integers(0, groups, n), rng.integers(0, 1 << 32, n, np.uint32)
        weight = rng.integers(1, 40, n)
        plain = np.zeros((groups, 32), np.int64)
        np.add.at(plain, g, (w[:, None] >> np.arange(32) & 1) * weight[:, None])
        assert (filter_audit.carry_save(g, weight, w, groups) == plain).all()


# --- packing ---------------------------------------------------------------------------------------------------------


def test_ids_equal_the_library():
    library, encoder = Tokenizer.from_file(TOKENIZER), token_ids.TextEncoder(open(TOKENIZER, encoding="utf-8").read())
    assert encoder.machine is not None
    rng = random.Random(2)
    bits = ["a", "B", " ", "  ", "\n", "\t", "'s", "'re", "12", "é", "中", " ", "　", "\x1c", "\x85", "<|endoftext|>", "!", "\U0001f600", "'"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(0, 30))) for _ in range(500)]
    texts += [" " * 9000 + "a", "\n" * 5000, "a" * 20000, *("".join(pair) for pair in thue_morse("tz", "on", "ab"))]
    for text in texts:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def thue_morse(*alphabets):
    """Words of 2,048 letters that any polynomial hash modulo a power of two confuses with their complements."""
    for a, b in alphabets:
        word = [a if bin(k).count("1") % 2 == 0 else b for k in range(2048)]
        yield word
        yield [b if c == a else a for c in word]


def test_packing_is_whole_and_no_worse_than_best_fit(spark):
    library, rows = Tokenizer.from_file(TOKENIZER), tables.awkward()
    out = swap_packing.pack(tables.frame(spark, rows), TOKENIZER, size=256, pool=16).collect()
    ids = sorted((r[0] if r[0] is not None else -1, tuple(library.encode(r[1] or "", add_special_tokens=False).ids + [2])) for r in rows)
    docs = defaultdict(list)
    for r in out:
        docs[r.doc_id if r.doc_id is not None else -1].append((r.piece, r.start, np.frombuffer(r.ids, "<u4").tolist()))
    assert sorted((d, len(i)) for d, w in docs.items() for _, _, i in w) == sorted(
        (d, n) for d, i in ids for n in swap_packing.cut_lengths(len(i), 256))
    for doc, whole in ids:
        if sum(d == doc for d, _ in ids) == 1:
            pieces = sorted(docs[doc])
            assert tuple(x for _, _, part in pieces for x in part) == whole
            assert [p for p, _, _ in pieces] == list(range(len(pieces)))
            assert [s for _, s, _ in pieces] == np.cumsum([0, *[len(p) for _, _, p in pieces]])[:-1].tolist()
    held = defaultdict(list)
    for r in out:
        held[r.sequence_id].append((r.offset, r.length))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 256


def test_swaps_empty_sequences_that_best_fit_leaves():
    assert len(swap_packing.best_fit([5, 5, 4, 3, 3], 10)) == 2
    lengths = [6, 5, 5, 4, 3, 3, 2, 2]  # best fit by descending length is optimal here; the search may not spoil it
    assert len(swap_packing.pack_pool(lengths, 10)) == 3
    poor = [[0, 3], [1, 4], [2, 5]]  # 6+2, 5+3, 4+... two sequences of ten are enough
    lengths = [6, 5, 4, 1, 2, 2]
    assert len(swap_packing.local_search(poor, lengths, 10)) == 2


def optimal(lengths, size):
    """The least number of sequences, by trying all."""
    if not lengths:
        return 0
    rest = lengths[1:]
    return 1 + min(optimal([x for k, x in enumerate(rest) if k not in chosen], size)
                   for n in range(len(rest) + 1) for chosen in combinations(range(len(rest)), n)
                   if lengths[0] + sum(rest[k] for k in chosen) <= size)


def test_search_and_bound_against_all_packings():
    rng = random.Random(5)
    for _ in range(60):
        lengths = [rng.randrange(1, 21) for _ in range(rng.randrange(1, 8))]
        best = optimal(lengths, 20)
        found = swap_packing.pack_pool(lengths, 20)
        assert sorted(i for s in found for i in s) == list(range(len(lengths)))
        assert all(sum(lengths[i] for i in s) <= 20 for s in found)
        assert swap_packing.least_sequences(lengths, 20) <= best <= len(found) <= len(swap_packing.best_fit(lengths, 20))
        assert len(found) <= best + 1


def test_swap_packing_of_nothing(spark):
    assert swap_packing.pack(tables.empty(spark), TOKENIZER).collect() == []
