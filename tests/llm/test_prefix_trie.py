"""The trie against a plain dictionary of prefixes."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest

from patchloom.llm.prefix_trie import BLOCK, ordered_turns, prefix_trie, with_openings

SCHEMA = "conv_id bigint, turn bigint, role string, text string, block int, pos int, a bigint, depth string"


def frame_of(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, "x") for r in rows], SCHEMA)


def ordered(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append(((turn is not None, turn or 0), (role or "", text or "")))
    return {c: [said for _, said in sorted(turns, key=lambda t: t[0])] for c, turns in convs.items()}


def rebuilt(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(np.fmod(c, 100))
        out[c] = convs.get(base, [])[:h] + turns[h:]
    return out


def brute(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    below = defaultdict(set)
    for node in members:
        if node:
            below[node[:-1]].add(node)

    totals = {}
    for node in sorted(members, key=len, reverse=True):
        kids = below[node]
        own = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        totals[node] = (sum(totals[k][0] for k in kids) if kids else 1, own + sum(totals[k][1] for k in kids))
    rows = []
    for node, who in members.items():
        ends = sorted(c for c in who if len(convs[c]) == len(node))
        digest = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        parent = min(members[node[:-1]]) if node else None
        rows.append((min(who), len(node), parent, len(who), len(below[node]), *totals[node], digest))
    return sorted(rows, key=repr)


def found_by(trie):
    return sorted(map(tuple, trie.collect()), key=repr)


def tree(spark, rows, openings=False):
    turns = ordered_turns(frame_of(spark, rows))
    if openings:
        return found_by(prefix_trie(*with_openings(turns)))
    return found_by(prefix_trie(turns, turns.select("conv_id").distinct()))


def random_rows(seed, convs, most, words=2, ids=lambda i: i):
    rng = np.random.default_rng(seed)
    return [(ids(c), t, ["user", "assistant"][t % 2], f"é{rng.integers(words)}" * (t % 3)) for c in range(convs) for t in range(rng.integers(1, most))]


@pytest.mark.parametrize("most", [4, 9, 40])
def test_random_conversations(spark, most):
    rows = random_rows(most, 60, most)
    assert tree(spark, rows) == brute(ordered(rows))


@pytest.mark.parametrize("ids", [lambda i: i, lambda i: i * 37 - 900, lambda i: i + (1 << 40)])
def test_rebuilt_conversations(spark, ids):
    rows = random_rows(5, 150, 9, ids=ids)
    assert tree(spark, rows, openings=True) == brute(rebuilt(ordered(rows)))


def test_conversations_that_differ_far_down(spark):
    long = [("user", f"turn {t}") for t in range(5 * BLOCK)]
    convs = {1: long, 2: long[:-1] + [("user", "another end")], 3: long[: 2 * BLOCK], 4: long[:BLOCK] + [("x", "y")] * 300, 5: long, 6: long[: BLOCK + 1]}
    rows = [(c, t, *said) for c, turns in convs.items() for t, said in enumerate(turns)]
    assert tree(spark, rows) == brute(convs)


def test_hard_rows(spark):
    rows = [
        (1, None, "user", "first"), (1, 0, None, None), (1, 5, "", ""), (1, -3, "user", "early"),
        (2, None, "user", "first"), (2, 1, "", None), (None, 1, "user", "nobody's"), (None, None, None, None),
        (3, 1, "user", "x" * 200_000), (4, 1, "user", "x" * 200_000), (-7, 1, "user", "first"), (8, 1, "userf", "irst"),
    ]
    assert tree(spark, rows) == brute(ordered(rows))
    assert tree(spark, rows, openings=True) == brute(rebuilt(ordered(rows)))


def test_equal_turn_numbers_and_repeated_rows_have_one_order(spark):
    rows = [(1, 1, "user", "a"), (1, 1, "user", "b"), (1, 1, "user", "b"), (2, 1, "user", "b"), (2, 1, "user", "a"), (2, 1, "user", "b")]
    found = tree(spark, rows)
    assert found == tree(spark, rows[::-1]) and len(found) == 4 and {r[3] for r in found} == {2}


def test_a_conversation_that_a_third_of_all_are(spark):
    rows = [(c, t, "user", f"common {t}") for c in range(9000) for t in range(2)] + [(20_000 + c, 0, "user", f"own {c % 900}") for c in range(2000)]
    assert tree(spark, rows) == brute(ordered(rows))


def test_no_conversations(spark):
    assert tree(spark, []) == [] and tree(spark, [], openings=True) == []


def test_turnless_conversations_are_at_the_root(spark):
    turns = ordered_turns(frame_of(spark, [(1, 0, "user", "a")]))
    convs = spark.createDataFrame([(1,), (2,), (-4,)], "conv_id bigint")
    assert found_by(prefix_trie(turns, convs)) == brute({1: [("user", "a")], 2: [], -4: []})
