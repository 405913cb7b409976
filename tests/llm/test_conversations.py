"""Conversation repair against plain dynamic programming."""

import random

import pyarrow as pa
import pytest

from tillhouse.llm import conversations as c

NEXT = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
TURN = {"": "u", "s": "u", "u": "a", "a": "u"}


def closed(ways):
    """`ways` (state to cost and audit) with up to two turns put in; more never pay."""
    for _ in range(2):
        for state, (cost, audit) in list(ways.items()):
            way, to = (cost + 3, audit + "I"), TURN[state]
            ways[to] = min(ways.get(to, way), way)
    return ways


def by_hand(rows):
    ways = {"": (0, "")}
    for initial, extra, gone in rows:
        after = {}
        for state, (cost, audit) in closed(ways).items():
            found = [(state, cost + 4, "D")]
            if not gone:
                found.append((TURN[state], cost + 3 + extra, "R"))
                if initial in NEXT[state]:
                    found.append((NEXT[state][initial], cost + extra, "K"))
            for to, price, edit in found:
                after[to] = min(after.get(to, (price, audit + edit)), (price, audit + edit))
        ways = after
    return min(way for state, way in closed(ways).items() if state in ("", "a"))


def some_rows(rng, n):
    return [(rng.choice("suax "), rng.choice((0, 0, 3)), rng.random() < 0.15) for _ in range(n)]


def test_bidirectional_search():
    rng = random.Random(4)
    for _ in range(600):
        rows = some_rows(rng, rng.randrange(0, 12))
        assert c.cheapest(rows) == by_hand(rows), rows
    rows = some_rows(rng, 300)
    assert c.cheapest(rows) == by_hand(rows)


def test_blocks_fold_to_the_whole():
    rng = random.Random(5)
    for _ in range(150):
        rows, fold = some_rows(rng, rng.randrange(1, 40)), c.Fold()
        at = 0
        while at < len(rows):
            size = rng.randrange(1, 9)
            fold.add(c._ways(rows[at:at + size]))
            at += size
        assert fold.done() == by_hand(rows)


@pytest.mark.parametrize("size", [1, 3, 512])
def test_partitions_of_any_size_give_the_same(monkeypatch, size):
    """Rows cut into partitions at any place, and blocks of any size."""
    monkeypatch.setattr(c, "BLOCK", size)
    rng = random.Random(size)
    rows = [
        {"ckey": f"c{k:02}", "dated": True, "turn": t, "role": rng.choice(("user", "assistant", "system")), "digest": bytes([t]),
         "last_char": rng.choice(".?x"), "copies": rng.choice((1, 1, 2)), "is_first": rng.random() < 0.9}
        for k in range(12) for t in range(rng.randrange(1, 9))
    ]
    cuts = sorted(rng.sample(range(len(rows)), 3))
    blocks = []
    for low, high in zip([0, *cuts], [*cuts, len(rows)]):
        for batch in c._blocks(iter([pa.RecordBatch.from_pylist(rows[low:high])])):
            blocks += batch.to_pylist()
    found = {r["ckey"]: (r["cost"], r["audit"]) for b in c._fold(iter([pa.RecordBatch.from_pylist(blocks, c.BLOCKS)])) for r in b.to_pylist()}
    for ckey in {r["ckey"] for r in rows}:
        own = [x for r in rows if r["ckey"] == ckey for x in c._faults(r)]
        lattice = [(i, 3 if f == "truncated" else 0, f in ("blank", "duplicate")) for i, f in own]
        assert found[ckey] == by_hand(lattice)


def test_repaired_text_follows_the_audit():
    lines = []
    replay = c.Replay("IKDRI", lambda role, text: lines.append(f"{role}:{text}"))
    for role, text in (("assistant", "hi."), ("user", ""), ("tool", "x.")):
        replay.row(role, text)
    replay.end()
    assert lines == ["user:", "assistant:hi.", "user:x.", "assistant:"]
