"""Operator 13 against a search over all edits, and on awkward rows."""

import hashlib
import os
import random
import re
import zlib
from functools import lru_cache

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.llm import conversations

SF = "/root/testdata/sf0.01"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
VISIBLE = re.compile(r"[^\x20\x09-\x0d]")
SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
                       T.StructField("text", T.StringType()), *[T.StructField(c, T.StringType()) for c in ("row", "pos", "block", "fault", "step", "h", "c", "d")]])


def damaged(rows):
    out = []
    for conv, turn, role, text, *_ in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        h = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        out += [(conv, turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    return out


def in_order(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).digest()))


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        visible = VISIBLE.findall(text)
        out.append("blank" if not visible else "duplicate" if (role, text) in seen else "truncated" if visible[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, fault):
    """Least (cost, audit, lines) by trying every edit at every place; the shape is tested by the pattern itself."""
    whole, part = re.compile(r"(s?(ua)+)?"), re.compile(r"s?(ua)*u?")

    @lru_cache(None)
    def best(i, shape):
        found = []
        if i == len(rows) and whole.fullmatch(shape):
            found.append((0, "", ()))
        options = []
        if shape.count("I") < 3:
            options += [(5, "I", r[0], f"{r}:", i) for r in ("user", "assistant")]
        if i < len(rows):
            _, _, role, text = rows[i]
            options.append((2, "D", None, None, i + 1))
            if fault[i] not in ("blank", "duplicate"):
                more = 5 * (fault[i] == "truncated")
                options.append((more, "K", role[:1] or "?", f"{role}:{text}", i + 1))
                options += [(1 + more, "R", r[0], f"{r}:{text}", i + 1) for r in ("user", "assistant")]
        for cost, edit, letter, line, j in options:
            now = shape + (letter or "")
            if not part.fullmatch(now) or (edit == "I" and len(now) > 2 * len(rows) + 4):
                continue
            now = now[:1] * now.startswith("s") + "ua" + now[-1:] * (now[-1] == "u") if len(now) > 3 else now  # same state
            inserted = edit == "I"
            if inserted and (i, now) in going:
                continue
            if inserted:
                going.add((i, now))
            rest = best(j, now)
            if inserted:
                going.discard((i, now))
            if rest:
                found.append((cost + rest[0], edit + rest[1], ((line,) if line is not None else ()) + rest[2]))
        return min(found) if found else None

    going = set()
    return best(0, "")


def forward(rows, fault):
    """The same by a forward DP over (position, state) that carries cost, audit and lines: quick enough for long conversations."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def inserted(states):
        for _ in range(2):
            for (at, letter), to in step.items():
                if letter != "s" and at in states:
                    c, a, lines = states[at]
                    new = (c + 5, a + "I", lines + [("user" if letter == "u" else "assistant") + ":"])
                    if to not in states or new[:2] < states[to][:2]:
                        states[to] = new
        return states

    states = inserted({"": (0, "", [])})
    for (_, _, role, text), f in zip(rows, fault):
        new = {}

        def offer(to, value):
            if to not in new or value[:2] < new[to][:2]:
                new[to] = value

        for at, (c, a, lines) in states.items():
            offer(at, (c + 2, a + "D", lines))
            if f in ("blank", "duplicate"):
                continue
            more = 5 * (f == "truncated")
            for (start, letter), to in step.items():
                if start != at:
                    continue
                if role[:1] == letter:
                    offer(to, (c + more, a + "K", lines + [f"{role}:{text}"]))
                if letter != "s":
                    offer(to, (c + more + 1, a + "R", lines + [("user" if letter == "u" else "assistant") + f":{text}"]))
        states = inserted(new)
    return min((states[s] for s in ("", "a") if s in states), key=lambda x: x[:2])


def expected(rows, hurt=True, solve=forward):
    by = {}
    for r in damaged(rows) if hurt else rows:
        by.setdefault(r[0], []).append(r[:4])
    out = {}
    for conv in {r[0] for r in rows}:
        own = in_order(by.get(conv, []))
        fault = faults(own)
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, lines = solve(own, fault)
        out[conv] = (gaps, fault.count("blank"), fault.count("duplicate"), fault.count("truncated"), illegal, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def awkward(seed=5, conversations_=150, longest=9):
    rng = random.Random(seed)
    rows = []
    for conv in range(conversations_):
        for turn in range(rng.randrange(longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Yes.", "No!", "Well", "Ends? \n", "", " \t", None, "çé 日本。", f"t{rng.random()}."])
            rows += [(conv, rng.choice([turn, turn, 2 * turn, None]), role, text)] * rng.choice([1, 1, 1, 2])
    return rows + [(None, 0, "user", "Hi."), (None, 1, "assistant", "Hello."), (None, None, None, None)]


def frame(spark, rows):
    return spark.createDataFrame([(*r[:4], *["x"] * 8) for r in rows], SCHEMA).repartition(3)


def results(whole, counts):
    found = {r[0]: tuple(r[1:]) for r in conversations.digests(whole).collect()}
    figures = {r[0]: tuple(r[1:]) for r in counts.collect()}
    return {c: (*figures[c], *found.get(c, (0, "", hashlib.sha256().hexdigest()))) for c in figures}


def test_forward_is_the_search_over_all_edits():
    rng = random.Random(2)
    for _ in range(300):
        rows = [(0, i, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["A.", "B.", "c", " "])) for i in range(rng.randrange(6))]
        fault = faults(rows)
        assert cheapest(rows, fault) == (*forward(rows, fault)[:2], tuple(forward(rows, fault)[2]))


@pytest.mark.parametrize("block_rows", [50_000, 7])
def test_repair(spark, block_rows):
    rows = awkward()
    got = results(*conversations.repair(conversations.damaged(frame(spark, rows)), block_rows))
    want = expected(rows)
    assert got == {c: want[c] for c in got}
    assert all(v == (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()) for c, v in want.items() if c not in got)


def test_one_conversation_over_many_blocks(spark):
    rng = random.Random(8)
    rows = [(1, rng.randrange(400), rng.choice(["user", "assistant", "system", "x"]), rng.choice(["A.", "b", f"{rng.random()}!", " "])) for _ in range(600)]
    rows += [(1, 7, "user", "Copy.")] * 300 + [(2, t, "user", "A.") for t in range(40)]
    placed = conversations.blocks(conversations.stored(frame(spark, rows)), 40)
    assert placed.groupBy("block").count().agg(F.max("count")).first()[0] < 200
    got = results(*conversations.repair(frame(spark, rows), 40))
    assert got == expected(rows, hurt=False)


def test_empty(spark):
    whole, counts = conversations.repair(frame(spark, []))
    assert whole.count() == counts.count() == conversations.digests(whole).count() == 0


@needs_data
def test_query(spark):
    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{SF}/conversations.parquet'").fetchall()
    got = {r[0]: tuple(r[1:]) for r in conversations.query(spark, SF).collect()}
    assert got == expected(rows)
