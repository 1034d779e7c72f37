"""The conversation trie against plain dictionaries, its slot tables, and its rounds."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from cardwatch.llm import prefixtrie
from cardwatch.llm.slots import SlotTable

TURNS = "conv_id long, turn long, role string, text string, node string, depth int, parent string, shard int, bytes int"


def brute(rows):
    turns = {}
    for c, turn, role, text in (r[:4] for r in rows):
        role, text = role or "", text or ""
        order = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
        if c is not None:
            turns.setdefault(c, []).append((turn is not None, turn or 0, order, (role, text)))
    own = {c: [t[-1] for t in sorted(x)] for c, x in turns.items()}
    members = {}
    ended = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        whole = tuple(own.get(c - c % 5, [])[:h] + mine[h:])
        for d in range(len(whole) + 1):
            members.setdefault(whole[:d], []).append(c)
        ended.setdefault(whole, []).append(c)
    out = []
    for path, convs in members.items():
        below = [p for p in members if p[: len(path)] == path]
        children = [p for p in below if len(p) == len(path) + 1]
        parents = {p[:-1] for p in members if p}
        out.append((
            min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs), len(children),
            sum(p not in parents for p in below),
            sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p),
            hashlib.sha256(",".join(map(str, sorted(ended.get(path, [])))).encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(seed, n, longest=7):
    """Conversations of which many start alike, some are equal, some have ties, nulls and empty texts."""
    rng, rows = random.Random(seed), []
    starts = [[(rng.choice(["user", "assistant", None]), f"start {i} {j} é") for j in range(rng.randrange(1, 5))] for i in range(4)]
    for c in rng.sample(range(5 * n), n):
        start = rng.choice(starts) if rng.random() < 0.7 else []
        turns = start + [(rng.choice(["user", "assistant"]), rng.choice([None, "", "yes", f"text {rng.randrange(9)} ü"]))
                         for _ in range(rng.randrange(longest))]
        rows += [(c, rng.choice([i, i, i, 3]) if turns[i][0] else None, *turns[i], "x", 1, "y", 2, 3) for i in range(len(turns))]
    return rows


def got(spark, rows, most=prefixtrie.SHARD_TURNS):
    found = prefixtrie.trie(spark.createDataFrame(rows, TURNS).repartition(4), most).drop("prefix")
    return sorted((tuple(r) for r in found.collect()), key=str)


@pytest.mark.parametrize("seed,n,most", [(1, 120, 1 << 15), (2, 150, 40), (3, 150, 4), (4, 60, 1)])
def test_equals_plain_dictionaries(spark, seed, n, most):
    """Small shards need several rounds of subtrees; the result is the same."""
    rows = conversations(seed, n)
    assert got(spark, rows, most) == brute(rows)


def test_one_conversation_of_a_third_of_all_rows_and_many_equal_ones(spark, monkeypatch):
    rows = [(7, i, "user", f"t{i % 50}", "x", 1, "y", 2, 3) for i in range(500)]
    rows += [(c, i, "user", f"common {i}", "x", 1, "y", 2, 3) for c in range(20, 200) for i in range(3)]
    rows += conversations(5, 40) + [(None, 0, "user", "nobody", "x", 1, "y", 2, 3)]
    rows += rows[-30:]
    assert got(spark, rows, 64) == brute(rows)


def test_nothing_to_build(spark):
    assert got(spark, []) == []
    assert got(spark, [(None, 1, "user", "x", None, None, None, None, None)]) == []


def test_turnless_conversation_is_a_member_of_the_root(spark):
    taking = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 2)
    rows = [(taking, None, None, None, "x", 1, "y", 2, 3)]
    assert got(spark, rows) == brute(rows) == [(taking, 0, None, 1, 0, 1, 0, hashlib.sha256(str(taking).encode()).hexdigest())]


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 30000])
def test_slots_are_minimal_and_verified(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(0, 1 << 63, (n, 4)).astype(np.uint64)
    table = SlotTable(keys)
    assert sorted(table.slots) == list(range(n)) and (table.find(keys) == table.slots).all()
    near = keys.copy()
    near[:, 3] ^= np.uint64(1)
    assert (table.find(near) == -1).all() and len(table.rows) < 40


def test_slot_table_refuses_repeated_keys():
    with pytest.raises(ValueError):
        SlotTable(np.ones((2, 4), np.uint64))


def test_long_lists_of_ends_are_hashed_piece_by_piece(spark, monkeypatch):
    """More ids than a piece holds, over several ranges."""
    rows = [(c, 0, "user", "same", "x", 1, "y", 2, 3) for c in range(0, 50000, 5)]
    assert got(spark, rows) == brute(rows)
