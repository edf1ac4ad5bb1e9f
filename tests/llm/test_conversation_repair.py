"""Op 11 against a brute-force repair: the damage, the faults and the cheapest edits written again, plainly."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import conversation_repair as cr
from ledgerline.llm.common import prepare, table

DOES = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "ua", ("ua", "u"): "u"}


def cheapest(rows):
    """(cost, audit, kept rows) by trying every edit from the end; rows: (role, text, must go, truncated)."""

    @lru_cache(None)
    def best(at, state, inserted):
        found = []
        if at == len(rows) and state in ("", "ua"):
            found.append((0, "", ()))

        def edit(role, text, cost, mark, to_at, more):
            state_after = DOES.get((state, role[:1]))
            if state_after is not None:
                rest = best(to_at, state_after, more)
                if rest:
                    found.append((cost + rest[0], mark + rest[1], (f"{role}:{text}",) + rest[2]))

        if inserted < 3:
            for role in ("user", "assistant"):
                edit(role, "", 5, "I", at, inserted + 1)
        if at < len(rows):
            role, text, must_go, cut = rows[at]
            rest = best(at + 1, state, 0)
            if rest:
                found.append((2 + rest[0], "D" + rest[1], rest[2]))
            if not must_go:
                edit(role, text, 5 * cut, "K", at + 1, 0)
                edit("user", text, 1 + 5 * cut, "R", at + 1, 0)
                edit("assistant", text, 1 + 5 * cut, "R", at + 1, 0)
        return min(found, default=None)

    return best(0, "", 0)


def expected(rows):
    """rows: (conv_id, turn, role, text)."""
    shown = lambda v: " " if v is None else str(v)
    after = {}
    for conv, turn, role, text in rows:
        role, text = shown(role), shown(text)
        kind = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
        own = after.setdefault(conv, [])
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        own.extend([(turn, role, text)] * (2 if kind == 3 else 1))
    out = []
    for conv, own in after.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, judged, count = set(), [], [0, 0, 0]
        for _, role, text in own:
            bare = text.strip(" \t\n\v\f\r")
            fault = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                count[fault] += 1
            judged.append((role, text, fault in (0, 1), fault == 2))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, kept = cheapest(tuple(judged))
        out.append((conv, gaps, *count, illegal, cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


SCHEMA = "conv_id long, turn long, role string, text string"


def answer(df):
    return sorted((tuple(r) for r in cr.op11(df).collect()), key=str)


def test_whole_table(spark):
    prepare(spark)
    df = table(spark, "/root/testdata/sf0.01", "conversations")
    assert answer(df) == expected([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def test_random_conversations(spark):
    """Odd roles, nulls, ties, repeats and blanks in short conversations."""
    prepare(spark)
    rng = random.Random(5)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "Tool", "Pal", "Cat", "", None]
    texts = ["Yes.", "No", "", " \t", None, "Why?", "So be it! \n", "é", "a.b"]
    rows = [(c if c % 50 else None, rng.choice([None, *range(8)]), rng.choice(roles), rng.choice(texts))
            for c in range(400) for _ in range(rng.randrange(1, 9 if c % 50 else 2))]
    assert answer(spark.createDataFrame(rows, SCHEMA).repartition(5)) == expected(rows)


def test_empty_and_clashing(spark):
    prepare(spark)
    df = table(spark, "/root/testdata/sf0.001", "conversations")
    assert answer(df.limit(0)) == []
    extra = df.withColumns({c: F.lit("x") for c in ("fault", "gone", "kind", "copy", "audit")})
    assert answer(extra) == answer(df)


def test_long_conversation_streams():
    """A long conversation keeps few stack tops, short audits and shallow stacks; the pieces equal the whole."""
    rng, machine = random.Random(9), cr.Automaton()
    own = cr.Repair(machine)
    rows = [(rng.choice(["user", "assistant", "system"]), f"{n}.", rng.random() < .1, rng.random() < .1) for n in range(20000)]
    for r in rows:
        own.row(*r)
        assert len(own.tops) <= len(machine.states) and max(len(w.audit) for w in own.tops.values()) < 9000
    cost, audit, _ = own.result()
    assert len(audit) - audit.count("I") == len(rows) and len(own.done) > 1
    price = {"K": 0, "R": 1, "D": 2, "I": 5}
    left, late = [m for m in audit if m != "I"], 0
    for mark, r in zip(left, rows):
        late += 5 * (mark != "D" and r[3])
    assert cost == late + sum(price[m] for m in audit)
    deep, node = 0, next(iter(own.tops.values())).node
    while node is not None:
        deep, node = deep + 1, node.below
    assert deep <= 4


@pytest.mark.parametrize("initials, legal", [("", True), ("s", False), ("sua", True), ("ua", True), ("uaua", True), ("au", False), ("uu", False)])
def test_grammar(initials, legal):
    own = cr.Repair(cr.Automaton())
    names = {"s": "system", "u": "user", "a": "assistant"}
    for n, initial in enumerate(initials):
        own.row(names[initial], f"{n}.", False, False)
    assert (own.result()[0] == 0) == legal
