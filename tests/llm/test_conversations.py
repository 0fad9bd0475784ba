import hashlib
import heapq
import random
import zlib

import numpy as np
import pytest

from brokerhouse.llm import conversations
from brokerhouse.llm.conversations import repair, repair_long

WHITE = " \t\n\x0b\x0c\r"
NAMES = "conv_id long, turn int, role string, text string, _key string, cost int"
NEXT = {("n", "s"): "s", ("n", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
PUT = {"n": "u", "s": "u", "u": "a", "a": "u"}


def cheapest(rows):
    """Least cost, audit and turns of rows (initial, fault, role, text): every path, in order of cost and audit."""
    done, heap = set(), [(0, "", 0, "n", ())]
    while True:
        cost, audit, at, said, turns = heapq.heappop(heap)
        if (at, said) in done:
            continue
        if at == len(rows) and said in "na":
            return cost, audit, turns
        done.add((at, said))
        put = PUT[said]
        role = "user" if put == "u" else "assistant"
        heapq.heappush(heap, (cost + 2, audit + "I", at, put, (*turns, f"{role}:")))
        if at == len(rows):
            continue
        initial, fault, own, text = rows[at]
        late = fault == 3
        heapq.heappush(heap, (cost + 3, audit + "D", at + 1, said, turns))
        if fault in (0, 3):
            heapq.heappush(heap, (cost + 2 + late, audit + "R", at + 1, put, (*turns, f"{role}:{text}")))
            if (said, initial) in NEXT:
                heapq.heappush(heap, (cost + late, audit + "K", at + 1, NEXT[said, initial], (*turns, f"{own}:{text}")))


def brute(table):
    """The whole query, conversation by conversation."""
    by_id = {}
    for conv, turn, role, text, *_ in table:
        own = by_id.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        own += [] if kind == 0 else [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv, rows in by_id.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        seen, marked = set(), []
        for _, role, text in rows:
            bare = text.rstrip(WHITE)
            fault = 1 if not bare else 2 if (role, text) in seen else 0 if bare[-1] in ".!?" else 3
            seen.add((role, text))
            marked.append((role[:1], fault, role, text))
        turns = [r[0] for r in rows if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
        cost, audit, said = cheapest(marked)
        faults = [sum(m[1] == k for m in marked) for k in (1, 2, 3)]
        out.append((conv, gaps, *faults, illegal, cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest()))
    return sorted(out, key=str)


def table(rng, conversations_, longest):
    texts = ["Hello.", "Why?", "No", "yes!", "", " \t", "so it goes. \n", "...", "é", None, "!"]
    roles = ["user", "assistant", "system", "user", "assistant", None, "tool", "", "sage"]
    rows = []
    for conv in conversations_:
        for turn in range(rng.randrange(longest)):
            turn = rng.choice([turn, turn, turn, None, turn - 1])
            rows.append((conv, turn, rng.choice(roles), rng.choice(texts) if rng.random() < 0.7 else f"text {rng.random()}.", "x", 1))
            if rng.random() < 0.05:
                rows.append(rows[-1])
    return rows


def test_query_equals_brute_force(spark):
    rng = random.Random(8)
    rows = table(rng, [None, *range(-3, 260)], 14) + table(rng, [1000], 1500)
    rows += [(2000 + k, 3, "user", "a" * 2_000_000 + ".", "x", 1) for k in range(2)] + [(2001, 4, "assistant", " " * 2_000_000, "x", 1)]
    rows += [(3000, k, "user", "the same.", "x", 1) for k in range(700)]
    turns = spark.createDataFrame(rows, NAMES).repartition(6)
    found = conversations.repaired(conversations.damaged(turns), turns)
    assert sorted(map(tuple, found.collect()), key=str) == brute(rows)


def test_no_rows(spark):
    empty = spark.createDataFrame([], NAMES)
    assert conversations.repaired(conversations.damaged(empty), empty).count() == 0
    lost = [(k, 0, "user", "x.", "x", 1) for k in range(200) if zlib.crc32(f"{k}:0".encode()) % 20 == 0]
    turns = spark.createDataFrame(lost, NAMES)
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert {tuple(r)[1:] for r in conversations.repaired(conversations.damaged(turns), turns).collect()} == {nothing}


@pytest.mark.parametrize("most", [9, 40])
def test_ranks_give_the_least_of_the_cheapest_audits(most):
    rng = np.random.default_rng(most)
    lengths = rng.integers(0, most, 300)
    codes = rng.integers(0, 16, lengths.sum())
    costs, audits = repair(codes, lengths)
    for own, cost, audit in zip(np.split(codes, np.cumsum(lengths)[:-1]), costs.tolist(), audits, strict=True):
        expected = cheapest([("sua?"[c % 4], c // 4, "", "") for c in own.tolist()])
        assert (cost, audit.decode()) == expected[:2]
        if len(own):
            for stretch in (1, 3, 8):
                assert repair_long(own, stretch) == (cost, audit)


def test_a_long_conversation_is_ranked_in_stretches(monkeypatch):
    codes = np.random.default_rng(2).integers(0, 16, 20_000)
    costs, audits = repair(codes, np.array([len(codes)]))
    monkeypatch.setattr(conversations, "STRETCH", 1 << 20)
    assert repair(codes, np.array([len(codes)]))[1] == audits and costs[0] > 0
