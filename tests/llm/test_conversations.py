"""Repair of conversations against trying all edits."""

import hashlib
import random
import re
import zlib

import pytest

from tillflow.llm import conversations
from tillflow.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
SPOKEN = re.compile("[^\x20\x09-\x0d]")
COSTS = {"K": 0, "R": 3, "D": 4, "I": 3}


def all_edits(facts, most):
    """Every (cost, audit, roles) that costs at most `most` and gives the pattern."""
    def go(place, cost, audit, roles):
        if cost > most or not re.fullmatch("s?(ua)*u?", roles):
            return
        if place == len(facts) and re.fullmatch("(s?(ua)+)?", roles):
            yield cost, audit, roles
        if place < len(facts):
            initial, gone, cut = facts[place]
            yield from go(place + 1, cost + 4, audit + "D", roles)
            if not gone:
                yield from go(place + 1, cost + 3 * cut, audit + "K", roles + (initial or "?"))
                for x in "ua":
                    yield from go(place + 1, cost + 3 + 3 * cut, audit + "R", roles + x)
        for x in "ua":
            yield from go(place, cost + 3, audit + "I", roles + x)

    return list(go(0, 0, "", ""))


def by_blocks(facts, size):
    blocks = []
    for k in range(0, len(facts), size):
        part = facts[k : k + size]
        blocks.append({s: conversations.block_values(part, s) for s in range(4)})
    return conversations.chain(blocks)


def test_lightest_repair_is_the_least_of_all_edits():
    draw = random.Random(7)
    for _ in range(250):
        n = draw.randint(0, 4)
        facts = [(draw.choice("suuaax"), draw.random() < 0.2, draw.random() < 0.3) for _ in range(n)]
        cost, audit, _ = min(all_edits(facts, 4 * n))
        assert by_blocks(facts, 9) == (cost, audit)


def test_blocks_join_to_the_same_repair():
    draw = random.Random(8)
    for n in (1, 5, 12, 40):
        facts = [(draw.choice("suuaa"), draw.random() < 0.2, draw.random() < 0.2) for _ in range(n)]
        assert len({by_blocks(facts, size) for size in (1, 2, 3, 7, 100)}) == 1


def plain(rows):
    """rows: (conv_id, turn, role, text) to the result of each conversation."""
    kept = {}
    for conv, turn, role, text in rows:
        own = kept.setdefault(conv, [])
        key = " " if conv is None else conv, " " if turn is None else turn
        kind = zlib.crc32(f"{key[0]}:{key[1]}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        own += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    results = {}
    for conv, own in kept.items():
        own.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
        seen, facts, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in own:
            found = SPOKEN.findall(text)
            fault = "blank" if not found else "duplicate" if (role, text) in seen else None
            if fault is None and found[-1] not in ".!?":
                fault = "truncated"
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            facts.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = [a[0] + b[0] for a, b in zip(facts, facts[1:])]
        illegal = sum(p not in ("su", "ua", "au") for p in pairs)
        ceiling = by_blocks(facts, 100)[0]
        cost, audit, roles = min(all_edits(facts, ceiling))
        said, rest, at = [], iter(own), 0
        for edit in audit:
            turn = None if edit == "I" else next(rest)
            if edit != "D":
                role = turn[1] if edit == "K" else {"u": "user", "a": "assistant"}[roles[at]]
                said.append(f"{role}:{turn[2] if turn else ''}")
                at += 1
        digest = hashlib.sha256("\n".join(said).encode()).hexdigest()
        results[conv] = (gaps, *counts.values(), illegal, cost, audit, digest)
    return results


def result(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize("block", [3, conversations.BLOCK])
def test_against_all_edits(spark, block):
    rows = spark.read.parquet(f"{FOLDER}/conversations.parquet")
    expected = plain([tuple(r) for r in rows.select("conv_id", "turn", "role", "text").collect()])
    found = result(conversations.repair_conversations(rows, block))
    assert found == expected
    assert len({audit for *_, audit, _ in expected.values()}) > 10


def test_odd_conversations(spark):
    draw, rows = random.Random(9), [(0, 0, "user", "Dropped with its whole conversation.")]
    texts = ["Yes.", "No!", "cut", " ", "", None, "Yes.", "Why? \t", "é漢?"]
    for conv in [None, *range(1, 30)]:
        for turn in range(draw.randint(1, 5)):
            role = draw.choice(["user", "assistant", "system", "", None, "User", "tool"])
            rows.append((conv, draw.choice([turn, turn, None, 3]), role, draw.choice(texts)))
    gone = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows += [(gone, 0, "user", "Hm."), (50, -(1 << 63), "user", "A."), (50, (1 << 63) - 1, "assistant", "B.")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    table = table.selectExpr("*", "1 AS number", "2 AS block", "3 AS place", "'x' AS audit", "4 AS start")
    expected = plain(rows)
    found = result(conversations.repair_conversations(table, 2))
    expected[50] = (min(expected[50][0], (1 << 63) - 1), *expected[50][1:])
    assert found == expected
    assert found[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    assert conversations.repair_conversations(table.limit(0)).count() == 0


def test_one_long_conversation(spark):
    """A conversation of many blocks, with a phrase that half of its turns have."""
    rows = [(1, k, ["user", "assistant"][k % 2], "Again." if k % 4 < 2 else f"Turn {k}.") for k in range(4000)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    few, many = (result(conversations.repair_conversations(table, b)) for b in (64, 5000))
    assert few == many and few[1][2] > 1500


def test_query(spark):
    rows = QUERIES["op12_conversation_repair"](spark, FOLDER)
    assert rows.columns[:3] == ["conv_id", "gaps", "blank"]
