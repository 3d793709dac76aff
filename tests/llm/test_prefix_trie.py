"""The conversation prefix trie against a plain dictionary of prefixes."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ratewright.llm import prefixtrie
from ratewright.llm.queries import importable

TURNS = "conv_id bigint, turn int, role string, text string, depth string, block string, home int"


@pytest.fixture(scope="module", autouse=True)
def ready(spark):
    importable(spark)


def turns_of(spark, rows):
    """Turns with further columns whose names clash with the operator's own."""
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], TURNS)


def digest(role, text):
    role, text = role or "", text or ""
    return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def brute(rows):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            key = (turn is not None, turn or 0, digest(role, text))
            turns.setdefault(conv, []).append((key, (role or "", text or "")))
    turns = {c: [t for _, t in sorted(ts, key=lambda x: x[0])] for c, ts in turns.items()}
    rebuilt = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = tuple(turns.get(c - int(np.fmod(c, 5)), [])[:h] + turns[c][h:])
    members = {}
    for c, path in rebuilt.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    kids = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        leaves[node] = sum(leaves[k] for k in kids.get(node, [])) or 1
        saved[node] = own + sum(saved[k] for k in kids.get(node, []))
    out = []
    for node, ids in members.items():
        ends = ",".join(str(c) for c in sorted(ids) if len(rebuilt[c]) == len(node))
        out.append((
            min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids), len(kids.get(node, [])),
            leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out)


def found(spark, rows, block):
    return sorted(tuple(r) for r in prefixtrie.conversation_trie(turns_of(spark, rows), block).collect())


def conversations(seed, n, longest=7, first=("hi",), choices=3):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        rows.append((c, None if rng.random() < 0.1 else 0, "user", rng.choice(first)))
        for k in range(1, rng.randint(1, longest)):
            rows.append((c, k, rng.choice(["user", "assistant", None]), rng.choice(["é" * i for i in range(choices)])))
    return rows


@pytest.mark.parametrize("block", [16_384, 40, 9])
def test_nodes_equal_a_dictionary_of_prefixes(spark, block):
    rows = conversations(1, 60, first=("hi", "hi", "hi", "ho", ""))
    assert found(spark, rows, block) == brute(rows)


@pytest.mark.parametrize("block", [16_384, 6])
def test_nulls_repeats_gaps_and_negative_ids(spark, block):
    rows = [(7, 0, "user", "a"), (7, 0, "user", "a"), (7, None, None, None), (None, 0, "user", "a"), (-7, 0, "user", "a"),
            (-5, 0, "user", ""), (-5, 1, "x", "y"), (12, 3, "user", "a"), (13, 3, "user", "a")]
    assert found(spark, rows, block) == brute(rows)


@pytest.mark.parametrize("block", [16_384, 20])
def test_a_group_of_copies_over_many_blocks(spark, block):
    same = [(c, k, "user", f"turn {k}") for c in range(0, 200, 5) for k in range(4)]
    rows = same + [(c + 1, k, "user", f"turn {k}") for c in range(0, 200, 10) for k in range(2)]
    assert found(spark, rows, block) == brute(rows)


@pytest.mark.parametrize("block", [16_384, 50])
def test_long_conversations_with_one_long_common_start(spark, block):
    rows = [(5 * c, k, "user", "w" * (k % 7)) for c in range(8) for k in range(300 + c // 2)]
    assert found(spark, rows, block) == brute(rows)


def test_an_empty_table_has_no_nodes(spark):
    assert found(spark, [], 10) == []
    assert found(spark, [(None, 0, "user", "a")], 10) == []


@given(st.lists(st.integers(0, 6), min_size=1, max_size=70), st.data())
@settings(max_examples=150, deadline=None)
def test_extents_by_halving_steps(values, data):
    values = np.array(values)
    table = prefixtrie.sparse_table(values)
    at, depth = data.draw(st.integers(0, len(values) - 1)), data.draw(st.integers(0, 7))
    left, right = at, at
    while left >= 0 and values[left] >= depth:
        left -= 1
    while right < len(values) and values[right] >= depth:
        right += 1
    one = lambda x: np.array([x])
    assert prefixtrie.search_left(table, one(at), one(depth))[0] == left
    assert prefixtrie.search_right(table, one(at), one(depth))[0] == right
    high = data.draw(st.integers(at, len(values) - 1))
    assert prefixtrie.range_min(table, one(at), one(high))[0] == values[at : high + 1].min()
