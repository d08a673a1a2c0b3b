"""Conversation repair against all edit scripts of short conversations, and in blocks against whole ones."""

from __future__ import annotations

import hashlib
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from shelfspark.llm import repair

WHOLE = re.compile(r"(s?(ua)+)?")
BEGUN = re.compile(r"(s?(ua)*u?)?")
ROWS = "conv_id long, turn long, role string, text string"


def all_scripts(kinds):
    """The least (cost, audit) by trying every edit of every row and up to three inserted turns in each gap."""
    most = None
    gaps = [g for n in range(4) for g in itertools.product("ua", repeat=n)]

    def go(at, roles, cost, audit):
        nonlocal most
        for gap in gaps:
            now = roles + "".join(gap)
            if not BEGUN.fullmatch(now):
                continue
            c, a = cost + 3 * len(gap), audit + "I" * len(gap)
            if at == len(kinds):
                if WHOLE.fullmatch(now) and (most is None or (c, a) < most):
                    most = (c, a)
                continue
            initial, fault = kinds[at]
            go(at + 1, now, c + 4, a + "D")
            if fault not in "bd":
                more = 3 * (fault == "t")
                go(at + 1, now + initial, c + more, a + "K")
                for given in "ua":
                    go(at + 1, now + given, c + 3 + more, a + "R")

    go(0, "", 0, "")
    return most


def test_least_of_all_scripts():
    rng = random.Random(5)
    for _ in range(40):
        kinds = ["".join((rng.choice("suau?"), rng.choice("---btd"))) for _ in range(rng.randrange(4))]
        cost, audit, roles = repair.best(list(repair.from_tops("".join(kinds), False)))
        assert (cost, audit) == all_scripts(kinds)
        assert WHOLE.fullmatch(roles)


def test_blocks_joined_are_the_whole():
    rng = random.Random(6)
    for _ in range(30):
        kinds = ["".join((rng.choice("suau?"), rng.choice("----btd"))) for _ in range(40)]
        whole = repair.best(list(repair.from_tops("".join(kinds), False)))
        table = list(repair.from_tops("".join(kinds[:11]), False))
        for a, b in ((11, 12), (12, 30), (30, 40)):
            table = repair.joined(table, list(repair.from_tops("".join(kinds[a:b]), True)))
        assert repair.best(table) == whole


def test_a_grammar_without_a_bound_is_refused():
    with pytest.raises(ValueError):
        repair.Stacks((("S", ("X",)), ("X", ("u", "X", "a")), ("X", ("u", "a"))))


def test_another_grammar():
    graph = repair.Stacks((("S", ("u",)), ("S", ("S2",)), ("S2", ("u", "u"))))
    assert [sorted(x) for x in graph.shift][0] == ["u"]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [
        (1, 1, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Yo"), (1, None, None, None), (1, 9, "assistant", "Yo."), (2, 1, "tool", ""),
        (None, 3, "user", "Who?"), (None, 4, "assistant", "Me."), (None, None, "system", "S."), (3, None, "user", "Only."), (4, 1, "user", "word " * 20_000 + "."), (4, 2, "assistant", "End."),
    ]
    return spark.createDataFrame(rows, ROWS).withColumns({c: F.lit("user's") for c in ("n", "k", "kind", "none", "id", "block", "deal", "copies", "hit", "place")})


def test_repaired_rows(odd):
    out = {}
    for r in repair.repaired(odd).orderBy("conv_id", "place").collect():
        out.setdefault(r.conv_id, []).append((r.role, r.text[:5], r.edit))
    assert out[1] == [("user", "Hi.", "K"), ("assistant", "Yo.", "K")]  # cheaper than keeping the one without an end
    assert 2 not in out  # its one row is blank
    assert out[None] == [("system", "S.", "K"), ("user", "Who?", "K"), ("assistant", "Me.", "K")]
    assert out[3] == [("user", "Only.", "K"), ("assistant", "", "I")]
    assert out[4] == [("user", "word ", "K"), ("assistant", "End.", "K")]
    for turns in out.values():
        assert WHOLE.fullmatch("".join(t[0][0] for t in turns))


def plainly(rows):
    """``repair_damaged`` of a list of rows, without blocks, by hand."""
    import zlib

    space = lambda x: " " if x is None else str(x)
    of = {}
    for conv, turn, role, text in rows:
        role, text = space(role), space(text)
        hit = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        of.setdefault(conv, [])
        of[conv] += [(turn is not None, turn or 0, "user" if hit == 4 else role, text)] * {0: 0, 3: 2}.get(hit, 1)
    out = []
    for conv, own in of.items():
        own.sort()
        seen, kinds = set(), []
        for _, _, role, text in own:
            end = re.sub("[\x20\x09-\x0d]+$", "", text)
            kinds.append((role[:1] if role[:1] in "sua" and role else "?") + ("b" if not end else "d" if (role, text) in seen else "t" if end[-1] not in ".!?" else "-"))
            seen.add((role, text))
        cost, audit, roles = repair.best(list(repair.from_tops("".join(kinds), False)))
        at, stay, names = 0, [], iter(roles)
        for edit in audit:
            if edit == "I":
                stay.append(repair.ROLES[next(names)] + ":")
                continue
            if edit != "D":
                name = next(names)
                stay.append((own[at][2] if edit == "K" else repair.ROLES[name]) + ":" + own[at][3])
            at += 1
        turns = [t for there, t, _, _ in own if there]
        pairs = [a[0] + b[0] for a, b in itertools.pairwise(kinds)]
        counts = [sum(k[1] == f for k in kinds) for f in "bdt"]
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(stay).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("block,fan", [(1024, 64), (4, 2)])
def test_damage_and_repair_in_blocks(spark, odd, block, fan):
    """A conversation over many blocks, and blocks over several levels, give what one block gives."""
    rng = random.Random(7)
    rows = [tuple(r)[:4] for r in odd.collect()]
    rows += [(5, i, rng.choice(("user", "assistant", "system")), rng.choice(("Yes.", "No", "Well?", f"Say {i}."))) for i in range(90)]
    rows += [(100 + i // 3, i % 3, ("user", "assistant", "user")[i % 3], f"T {i}.") for i in range(60)]
    found = repair.repair_damaged(spark.createDataFrame(rows, ROWS), block, fan).collect()
    assert sorted((tuple(r) for r in found), key=str) == plainly(rows)


def test_no_rows(odd):
    assert repair.repaired(odd.limit(0)).collect() == []
    assert repair.repair_damaged(odd.limit(0)).collect() == []
