"""Conversation repair against a comparison of whole edit lists."""

import functools
import hashlib
import itertools
import random
import re
import zlib

import pytest

from barsmith.llm import conversation_repair as repair
from barsmith.llm import queries
from conftest import SF_SMALL

SPACE = " \t\n\x0b\x0c\r"
LEGAL = re.compile("(s?(ua)+)?")


def damage(rows):
    """Rows (conv, turn, role, text) of one conversation after damage, in order."""
    out = []
    for conv, turn, role, text in rows:
        some = [" " if v is None else str(v) for v in (conv, turn, role, text)]
        kind = zlib.crc32(f"{some[0]}:{some[1]}".encode()) % 20
        role, text = some[2:]
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest())
    return sorted(out, key=key)


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        body = text.rstrip(SPACE)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, fault):
    """(cost, letters, lines): least by cost, then letters, of all edit lists; tried row by row with up to three inserts before each."""
    legal = lambda r: any(LEGAL.fullmatch(r + end) for end in ("", "a", "ua"))

    @functools.cache
    def rest(i, roles, free):
        """Best end of a list after rows ``:i`` and roles that read like ``roles``, with ``free`` inserts left before the next row."""
        found = [(0, "", ())] if i == len(rows) and LEGAL.fullmatch(roles) else []

        def add(price, letter, role, text, i, free):
            if legal(roles + role[0]):
                cost, letters, lines = rest(i, (roles + role[0])[-1:] if roles + role[0] == "s" else "u" if role[0] == "u" else "ua", free)
                found.append((price + cost, letter + letters, (f"{role}:{text}", *lines)))

        for role in ("user", "assistant") if free else ():
            add(2, "I", role, "", i, free - 1)
        if i < len(rows):
            _, role, text = rows[i]
            cost, letters, lines = rest(i + 1, roles, 3)
            found.append((3 + cost, "D" + letters, lines))
            if fault[i] not in ("blank", "duplicate"):
                for to, price, letter in ((role, 0, "K"), ("user", 2, "R"), ("assistant", 2, "R")):
                    if to:
                        add(price + (fault[i] == "truncated"), letter, to, text, i + 1, 3)
        return min(found, default=(10 ** 9, "", ()))

    return rest(0, "", 3)


def expected(rows):
    rows = damage(rows)
    fault = faults(rows)
    cost, letters, lines = cheapest(rows, fault)
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in itertools.pairwise(rows)]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(fault.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, letters, hashlib.sha256("\n".join(lines).encode()).hexdigest())


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def compare(got, rows):
    by = {}
    for conv, *rest in rows:
        by.setdefault(conv, []).append((conv, *rest))
    assert {r.conv_id: tuple(r[c] for c in COLUMNS) for r in got} == {conv: expected(some) for conv, some in by.items()}
    assert len(got) == len(by)


def test_query_equals_comparison(spark):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").collect()]
    compare(queries.op12_conversation_repair(spark, SF_SMALL).collect(), rows)


@pytest.fixture
def chats():
    """Null ids, turns, roles and texts, unknown roles, repeated rows and turns, conversations of one row, and one of several blocks."""
    rng = random.Random(4)
    rows = []
    for conv in [*range(60), None]:
        for _ in range(rng.randint(1, 7)):
            rows.append((conv, rng.choice([None, *range(9)]), rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None, "ux"]),
                         rng.choice(["Yes.", "No!\n", "", " \t", None, "cut", "a?", "x.y"])))
    return rows + [(1000, k, "user" if k % 2 == 0 else "assistant", f"text {k}." if k % 7 else f"text {k}") for k in range(45)]


def write(spark, rows, path):
    clash = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "conv_id long, turn long, role string, text string, id int, conv string, cost int")
    clash.write.parquet(f"{path}/conversations.parquet")
    return str(path)


def test_defined_cases_and_blocks_equal_comparison(spark, chats, tmp_path, monkeypatch):
    at = write(spark, chats, tmp_path)
    got = queries.op12_conversation_repair(spark, at).collect()
    compare(got, chats)
    monkeypatch.setattr(repair, "BLOCK_LOG2", 2)  # blocks of four rows and less
    assert sorted(map(repr, queries.op12_conversation_repair(spark, at).collect())) == sorted(map(repr, got))


def test_no_rows(spark, tmp_path):
    assert queries.op12_conversation_repair(spark, write(spark, [], tmp_path)).count() == 0


def test_dropped_conversation_has_zeros(spark, tmp_path):
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:5".encode()) % 20 == 0)
    got = queries.op12_conversation_repair(spark, write(spark, [(gone, 5, "user", "a.")], tmp_path)).collect()
    assert [tuple(r)[1:] for r in got] == [(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


@pytest.mark.parametrize("seed", range(4))
def test_blocks_of_any_size_give_the_same_list(seed):
    rng = random.Random(seed)
    codes = [rng.choice([0, 4, 4, 8, 8, 8, 12]) + rng.choice([0, 0, 0, 1, 2, 3]) for _ in range(90)]
    whole = repair.solve(codes, None)
    cuts = sorted(rng.sample(range(1, 90), 12))
    parts = [codes[a:b] for a, b in zip([0, *cuts], [*cuts, 90])]
    import numpy as np
    cost = np.array(repair._inserts([0 if q in repair.FINAL else repair.FAR for q in range(4)], lambda c, _, v: c + v))
    behind = []
    for part in reversed(parts):
        behind.insert(0, cost.tolist())
        cost = (repair.block_costs(np.array(part)) + cost).min(axis=1)
    text, state = "", 0
    for k, part in enumerate(parts):
        _, letters, exits = repair.solve(part, None if k == len(parts) - 1 else behind[k])
        text, state = text + letters[state], exits[state]
    assert text == whole[1][0] and cost[0] == whole[0][0]
