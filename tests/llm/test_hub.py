"""The look-up of what a hub misses: components against brute force, and templates in linear time."""

import random
import time

import pyarrow as pa
import pytest

from ledgerspark.llm import near_dedup


def looked_up(parts, sizes, asked, batch, percent=80):
    rows = [(0, i) for i in asked] + [(1, i) for i in range(len(parts))]

    def table(some):
        longs = lambda x: pa.array(x, pa.int64())
        return pa.RecordBatch.from_arrays(
            [longs([7] * len(some)), longs([8] * len(some)), pa.array([0] * len(some), pa.int32()), pa.array([r for r, _ in some], pa.int32()),
             longs([i for _, i in some]), longs([sizes[i] for _, i in some]), pa.array([parts[i] for _, i in some], pa.list_(pa.int64()))],
            names=["v", "v_key", "block", "role", "u", "n", "part"])

    out = []
    for b in near_dedup._look_up(percent)(table(rows[k:k + batch]) for k in range(0, len(rows), batch)):
        out += zip(b.column(0).to_pylist(), b.column(1).to_pylist())
    return out


def groups(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[find(a)] = find(b)
    out = {}
    for i in range(n):
        out.setdefault(find(i), set()).add(i)
    return sorted(map(sorted, out.values()))


def similar(a, b):
    return 100 * len(a & b) >= 80 * len(a | b)


@pytest.mark.parametrize("meetings", [7, 1 << 21])
def test_no_component_is_lost(monkeypatch, meetings):
    monkeypatch.setattr(near_dedup, "MEETINGS", meetings)
    rng = random.Random(meetings)
    for _ in range(60):
        hub = set(range(rng.randrange(3, 15)))
        spare = rng.choice([4, 30])
        sets = {frozenset({h for h in hub if rng.random() < rng.choice([0.6, 0.9])} | {100 + rng.randrange(spare) for _ in range(rng.randrange(4))})
                for _ in range(rng.randrange(2, 40))}
        sets = [s for s in sets if s and s != hub]
        linked = [similar(s, hub) for s in sets]
        parts = [[x * 2654435761 % 2**60 for x in s ^ hub] for s in sets]
        got = looked_up(parts, [len(s) for s in sets], [i for i, x in enumerate(linked) if not x], rng.choice([1, 5, 50]))
        assert all(similar(sets[a], sets[b]) for a, b in got) and len(got) <= len(sets)
        n, star = len(sets), [(i, len(sets)) for i, x in enumerate(linked) if x]
        links = [(i, j) for i in range(n) for j in range(i) if similar(sets[i], sets[j])]
        assert groups(n + 1, links + star) == groups(n + 1, got + star)


def test_texts_of_one_template_do_not_meet():
    """All members lack the same element of their hub and have one of their own: too little in common for any link."""
    n = 100_000
    began = time.time()
    assert looked_up([[10**15 + i * 7919, 5] for i in range(n)], [7] * n, range(n), 2000) == []
    assert time.time() - began < 30


def test_a_cluster_beside_its_hub_stays_a_forest():
    """Many members that are all linked with each other, but not with the hub, leave one link each."""
    n = 1500
    common = list(range(10**6, 10**6 + 9))
    got = looked_up([[*common, 10**9 + i] for i in range(n)], [40] * n, range(n), 500)
    assert len(got) == n - 1 and groups(n, got) == [list(range(n))]
