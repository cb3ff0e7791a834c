"""Shingles, components, min-max hashing and repeated passages against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from patchloom.llm import shingles as S
from patchloom.llm.components import connected_components
from patchloom.llm.minhash import MinMax, drop_near_copies, near_duplicates
from patchloom.llm.substring_dedup import Passages, _forest, _grown, _may_grow, _Windows, compact_windows, repeated_passages
from tests.llm.conftest import prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def shingle_set(text, k):
    words = words_of(text)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def components_of(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from("aB \n\té　")), st.text()), max_size=8), st.sampled_from([8, 1 << 17]))
def test_word_hashes(texts, chunk):
    seen = {}
    before, S.CHUNK_BYTES = S.CHUNK_BYTES, chunk
    try:
        for at, to, hashes, offsets, _ in S.WordHasher().texts(pa.array(texts, pa.string())):
            for i in range(at, to):
                words = words_of(texts[i])
                own = hashes[offsets[i - at] : offsets[i - at + 1]].tolist()
                assert len(own) == len(words)
                assert all(seen.setdefault(w, h) == h for w, h in zip(words, own, strict=True))
    finally:
        S.CHUNK_BYTES = before
    assert len(set(seen.values())) == len(seen)


def test_components_against_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000, i) for i in range(1001, 1400)] + [(i, i + 1) for i in range(2000, 2040)]
    edges += [(5, 5), (None, 3)]
    found = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    real = [(a, b) for a, b in edges if a is not None and a != b]
    assert found == components_of({x for e in real for x in e}, real)
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def edited(text, rng, share):
    words = text.split(" ")
    for i in range(len(words)):
        if rng.random() < share:
            words[i] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def near_expected(rows, k):
    sets = {}
    for doc_id, text in rows:
        sets.setdefault(doc_id, set()).add(shingle_set(text, k))
    items = [(i, s) for i, own in sets.items() if i is not None for s in own if s]
    links = [
        (a, b)
        for x, (a, s) in enumerate(items)
        for b, t in items[:x]
        if a != b and 100 * len(s & t) >= 80 * len(s | t)
    ]
    component = components_of({i for i in sets if i is not None}, links)
    return sorted(
        ((i, len(shingle_set(t, k)), component.get(i), i == component.get(i)) for i, t in rows), key=repr
    )


@pytest.mark.parametrize("task_shingles", [2_000_000, 700])
def test_near_duplicates_against_all_pairs(documents, task_shingles):
    rng = random.Random(11)
    rows = []
    for group in range(12):
        base = prose(group, 120)
        rows += [(1000 * group + i, edited(base, rng, rng.choice([0, 0.01, 0.02, 0.03]))) for i in range(rng.randrange(1, 25))]
    rows += [(99_000 + i, prose(500 + i, 60)) for i in range(40)]
    rng.shuffle(rows)
    found = near_duplicates(documents(rows), MinMax(words=4, task_shingles=task_shingles))
    assert sorted(map(tuple, found.collect()), key=repr) == near_expected(rows, 4)


def test_near_duplicates_of_hard_rows(documents, hard_rows):
    rows = hard_rows + [(8, prose(77, 50)), (30, prose(77, 50)), (31, "one"), (32, "ONE")]
    found = near_duplicates(documents(rows))
    assert sorted(map(tuple, found.collect()), key=repr) == near_expected([(r[0], r[1]) for r in rows], 5)
    kept = drop_near_copies(documents(rows))
    assert kept.columns == documents([]).columns
    assert near_duplicates(documents([])).collect() == []


def test_rows_that_are_no_copies_pass_without_a_join(documents):
    rows = [(i, prose(i, 40)) for i in range(60)] + [(100 + i, prose(i, 40) + " x") for i in range(5)] + [(None, prose(0, 40)), (7, prose(7, 40))]
    kept = drop_near_copies(documents(rows))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == sorted([*((False, i) for i in range(60)), (False, 7), (True, 0)])
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    passed, matched = plan.split("Union", 1)[1].split("Join LeftAnti", 1)
    assert "bitmap" in passed and "bitmap" in matched


def brute_windows(values, least):
    out = set()
    for c, v in enumerate(values):
        left, right = c, c
        while left and values[left - 1] > v:
            left -= 1
        while right + 1 < len(values) and values[right + 1] >= v:
            right += 1
        if left and values[left - 1] == v:
            continue  # an equal value to the left stands for it
        if any(values[x] == v for x in range(c)) and min(values[max(x for x in range(c) if values[x] == v) : c + 1]) == v:
            continue
        if right - left + 1 >= least:
            out.add((left, c, right))
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(1, 30), max_size=25), max_size=4), st.integers(2, 6))
def test_compact_windows_are_the_wide_nodes_of_the_trees(texts, least):
    flat = np.array([v for t in texts for v in t], np.uint32)
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    found = set(zip(*(x.tolist() for x in compact_windows(flat, bounds, least)), strict=True))
    want = {(a + l, a + c, a + r) for t, a in zip(texts, bounds.tolist(), strict=False) for l, c, r in brute_windows(t, least)}
    assert found == want


def test_repeated_passages(documents):
    rng = random.Random(5)
    passage, near = prose(900, 70), prose(901, 90)
    rows = [(i, prose(i, 150)) for i in range(60)]
    rows += [(100 + i, f"{prose(1000 + i, 40 + i)} {passage} {prose(2000 + i, 30)}") for i in range(30)]
    rows += [(200 + i, f"{prose(3000 + i, 20)}\n{edited(near, rng, 0.01)} {prose(4000 + i, 50)}") for i in range(4)]
    rows += [(300 + i, f"{prose(5000 + i, 60)} {prose(902, 30)} {prose(6000 + i, 60)}") for i in range(20)]  # too short
    rows += [(None, passage), (400, None), (401, ""), (100, rows[60][1])]
    found = repeated_passages(documents(rows)).collect()
    flagged = {r["doc_id"] for r in found} | {r["partner_id"] for r in found}
    assert set(range(100, 130)) <= flagged
    assert flagged <= {*range(100, 130), *range(200, 204)}
    assert len(flagged & set(range(200, 204))) >= 2
    texts = {i: words_of(t) for i, t in rows if i is not None}
    for r in found:
        a = texts[r["doc_id"]][r["start_word"] : r["end_word"]]
        b = texts[r["partner_id"]][r["partner_start"] : r["partner_end"]]
        s, t = ({tuple(x[i : i + 5]) for i in range(len(x) - 4)} for x in (a, b))
        assert len(a) >= 50 and len(s & t) / len(s | t) == pytest.approx(r["similarity"]) and 100 * len(s & t) >= 80 * len(s | t)
    covered = next(r for r in found if r["doc_id"] == 101)
    assert covered["start_word"] <= 41 and covered["end_word"] >= 111 - Passages().gap
    # Every document is linked to two others at most, not to all.
    assert len(found) <= 2 * 40
    assert repeated_passages(documents([])).collect() == []


def test_passages_of_hard_rows(documents, hard_rows):
    found = repeated_passages(documents(hard_rows)).collect()
    pairs = {(r["doc_id"], r["partner_id"]) for r in found}
    assert {(5, 4), (9, 8)} <= pairs and all(a != b for a, b in pairs)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(1, 6), max_size=25), max_size=4), st.integers(2, 6))
def test_every_stretch_is_in_one_window(texts, least):
    flat = np.array([v for t in texts for v in t], np.uint32)
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    found = list(zip(*(x.tolist() for x in compact_windows(flat, bounds, least, every=True)), strict=True))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        for s in range(a, b - least + 1):
            holders = [c for l, c, r in found if max(l, c - least + 1) <= s <= min(c, r - least + 1)]
            assert holders == [s + int(flat[s : s + least].argmin())]


def test_passage_behind_a_repeated_line(documents):
    rows = []
    for n in range(40):
        line, fillers = prose(10_000 + n, 30), [prose(20_000 + 10 * n + k, 20) for k in range(4)]
        rows.append((2 * n, " ".join(f"{line} {filler}" for filler in fillers)))
        rows.append((2 * n + 1, f"{prose(30_000 + n, 40)} {line} {fillers[2]} {prose(40_000 + n, 40)}"))
    found = {(r["doc_id"], r["partner_id"]) for r in repeated_passages(documents(rows)).collect()}
    assert found == {(2 * n + 1, 2 * n) for n in range(40)}


def test_passage_of_two_frequent_lines(documents):
    rng = random.Random(9)
    a, b = prose(1, 25), prose(2, 25)
    rows = [(i, f"{prose(100 + i, 30)} {rng.choice([a, b])} {prose(5000 + i, 30)}") for i in range(400)]
    for i in (57, 311):
        rows[i] = (i, f"{prose(100 + i, 30)} {a} {b} {prose(5000 + i, 30)}")
    assert {(r["doc_id"], r["partner_id"]) for r in repeated_passages(documents(rows)).collect()} == {(311, 57)}


def near_pairs(n):
    """Pairs (2k, 2k + 1) that share 50 words but one: 41 of 51 shingles, a similarity just above 0.8."""
    rows = []
    for k in range(n):
        words = " ".join(f"w{k}x{i}" for i in range(50)).split(" ")
        near = words[:25] + [f"new{k}"] + words[26:]
        rows += [(2 * k + j, f"{prose(7000 + 4 * k + j, 30)} {' '.join(own)} {prose(9000 + 4 * k + j, 30)}") for j, own in enumerate((words, near))]
    return rows


def test_recall_of_least_length_at_the_limit(documents):
    found = {(r["doc_id"], r["partner_id"]) for r in repeated_passages(documents(near_pairs(400))).collect()}
    assert {(2 * k + 1, 2 * k) for k in range(400)} <= found


def test_near_passages_around_a_frequent_line(documents):
    line, rows, pairs = prose(50_000, 35), [], set()
    rows += [(i, f"{prose(60_000 + i, 30)} {line} {prose(70_000 + i, 30)}") for i in range(120)]
    for k in range(40):
        before, after = prose(80_000 + k, 7), prose(90_000 + k, 8)
        other = after.split(" ")
        other[0] = f"new{k}"
        rows.append((1000 + 2 * k, f"{prose(100_000 + k, 30)} {before} {line} {after} {prose(110_000 + k, 30)}"))
        rows.append((1001 + 2 * k, f"{prose(120_000 + k, 30)} {before} {line} {' '.join(other)} {prose(130_000 + k, 30)}"))
        pairs.add((1001 + 2 * k, 1000 + 2 * k))
    found = {(r["doc_id"], r["partner_id"]) for r in repeated_passages(documents(rows)).collect()}
    assert pairs <= found and {x for p in found for x in p} == {x for p in pairs for x in p}


def test_every_repeated_passage_connects_its_holders(documents, monkeypatch):
    """Against all pairs: near copies of a few passages in several documents, with keys in one part and in many."""
    rng = random.Random(21)
    rows = []
    for n in range(6):
        base = prose(140_000 + n, 60)
        rows += [(100 * n + i, f"{prose(150_000 + 100 * n + i, 20)} {edited(base, rng, 0.01)} {prose(160_000 + 100 * n + i, 20)}") for i in range(9)]
    sets = {i: [(at, shingle_set(" ".join(words[at : at + 50]), 5)) for at in range(len(words) - 49)] for i, words in ((i, words_of(t)) for i, t in rows)}
    links = [(b, a) for a in sets for b in sets if a < b and a // 100 == b // 100 and any(100 * len(s & t) >= 80 * len(s | t) for x, s in sets[a] for y, t in sets[b] if x == y)]
    for part, small in ((4096, 48), (3, 2)):
        monkeypatch.setattr("patchloom.llm.substring_dedup.PART_WINDOWS", part)
        monkeypatch.setattr("patchloom.llm.substring_dedup._SMALL", small)
        found = repeated_passages(documents(rows)).collect()
        pairs = {(r["doc_id"], r["partner_id"]) for r in found}
        real = components_of(sets, links)
        joined = components_of(sets, pairs)
        assert all(joined[a] == joined[b] for a, b in links) and all(joined[i] // 100 == i // 100 for i in sets)
        assert len(set(joined.values())) <= len(set(real.values()))


def test_other_holders_link_two_passages_of_one_document(documents):
    """The smallest id holds both variants: whoever holds one is linked to it or to the other's holders."""
    words = [f"v{i}" for i in range(70)]
    near = words[:35] + ["new"] + words[36:]
    rows = [(1, f"{' '.join(words)} {prose(1, 80)} {' '.join(near)}"), (2, f"{prose(2, 60)} {' '.join(words)} {prose(3, 60)}"), (3, f"{prose(4, 60)} {' '.join(near)} {prose(5, 60)}")]
    rows += [(4, " ".join(["the"] * 90)), (5, f"{prose(6, 60)} {' '.join(['the'] * 80)}")]
    found = {(r["doc_id"], r["partner_id"]) for r in repeated_passages(documents(rows)).collect()}
    assert {(2, 1), (3, 1), (5, 4)} <= found


def windows_of(around):
    """Windows of one key, each in a document of its own, with these shingles around their centres."""
    n = len(around)
    body = np.ascontiguousarray(around.astype("<u4")[:, :, None].view(np.uint8)[:, :, :3])
    place = np.full(n, 100 << 32)
    return _Windows(
        pa.table({"id": np.arange(n), "other": np.arange(n), "place": place, "there": place, "around": [row.tobytes() for row in body]}), Passages()
    )


def windows_around_a_line(n, width, rng):
    """``n`` windows that hold one line of ``width`` shingles; some go on alike behind it, with a changed word or two, and some are short."""
    reach = Passages().reach
    around = rng.integers(1, 1 << 24, (n, 2 * reach + 1))
    line = rng.integers(1, 1 << 24, width)
    for i in range(n):
        if i % 3 == 0:
            around[i] = around[i - i % 12]  # four alike
            for _ in range(rng.integers(0, 4)):
                at = rng.integers(0, 2 * reach - 4)
                around[i, at : at + 5] = rng.integers(1, 1 << 24, 5)
        if i % 7 == 0:
            around[i] = np.roll(around[i], rng.integers(-3, 4))
        if i % 5 == 0:
            around[i, : rng.integers(0, 50)] = 0
            around[i, 2 * reach + 1 - rng.integers(0, 50) :] = 0
    around[:, reach - 12 : reach - 12 + width] = line
    return around


@pytest.mark.parametrize(("n", "width"), [(700, 26), (300, 41), (120, 60)])
def test_windows_of_a_frequent_line_are_looked_up_not_all_compared(monkeypatch, n, width):
    windows = windows_of(windows_around_a_line(n, width, np.random.default_rng(n)))
    low, high = np.triu_indices(n, 1)
    a, b, start, surely = windows.linked(low, high)
    sure = surely | np.array([bool(np.all(windows.grows(a[k : k + 1], b[k : k + 1], start[k : k + 1]))) for k in range(len(a))])
    links = list(zip(a[sure].tolist(), b[sure].tolist(), strict=True))
    assert len(links) > n / 12

    compared, before = [], _Windows._linked
    monkeypatch.setattr(_Windows, "_linked", lambda self, x, y: compared.append(len(x)) or before(self, x, y))
    found = [np.concatenate(x) for x in zip(*_forest(windows, np.array([0, n])), strict=True)]
    chosen = list(zip(found[0].tolist(), found[1].tolist(), strict=True))
    assert components_of(range(n), chosen) == components_of(range(n), links)
    assert len(chosen) == n - len(set(components_of(range(n), chosen).values()))
    if width == 26:
        assert sum(compared) < 5 * n  # of n * (n - 1) / 2 pairs


def test_rows_that_cannot_grow_are_told_at_once():
    rng, settings_ = np.random.default_rng(4), Passages()
    size, told, real = 2 * settings_.reach + 1, 0, 0
    for share in (0.02, 0.05, 0.1, 0.2):
        matched = rng.random((400, size)) > share
        matched &= np.abs(np.arange(size) - size // 2) < rng.integers(10, size, 400)[:, None]
        partner = np.where(matched, np.arange(size) + rng.integers(-8, 9, 400)[:, None], -1)
        partner = np.where((partner >= 0) & (partner < size), partner, -1).astype(np.int32)
        middle = rng.integers(47, 93, 400)
        may = _may_grow(partner, middle, settings_)
        grown = np.array([bool(_grown(np.flatnonzero(p >= 0), p, int(m), settings_)) for p, m in zip(partner, middle, strict=True)])
        assert not (grown & ~may).any()
        told, real = told + int((~may).sum()), real + int((~grown).sum())
    assert told > 0.9 * real
