"""Conversation structure repair: generalised LR parsing of role sequences with weighted edits.

A grammar over role initials says which conversations are whole. Its LR(0)
automaton drives stacks that share their lower parts; where a row can be kept,
given another role, deleted, or where a turn can be inserted, the stacks fork,
and stacks with equal tops merge to the least (cost, audit). The audit holds
the initial of each edit in order. Stacks whose tops accept the same rest
count as equal, so a handful are alive at any row.

Conversations of any length: blocks of rows are parsed on their own, from every
top that a block may begin with, and the blocks' tables of (top before, top
after, cost, audit) are combined in a tree, as matrices over (min, +) are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.rows import id_key
from shelfspark.session import cut
from shelfspark.sources.products import numbered

#: Whole conversations: nothing, or a system turn at most and then pairs of user and assistant.
GRAMMAR = (("S", ()), ("S", ("T",)), ("S", ("s", "T")), ("T", ("T", "P")), ("T", ("P",)), ("P", ("u", "a")))
ROLES = {"s": "system", "u": "user", "a": "assistant"}
#: Roles that a row may be given and that an inserted turn may have.
GIVEN = ("u", "a")
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
#: Rows in a block, blocks that one fold of the tree takes, and stacks that a grammar may have at most.
BLOCK, FAN, STACKS = 1024, 64, 256
SPACE = " \t\n\x0b\x0c\r"

Value = tuple[int, str, str]  # cost, audit, roles of the turns that stay


class Stacks:
    """The graph of all stacks that a grammar's LR(0) automaton can hold between turns, and how turns lead from one to another."""

    def __init__(self, grammar: tuple = GRAMMAR):
        self.grammar, self.start = grammar, grammar[0][0]
        self.heads = {lhs for lhs, _ in grammar}
        self.tokens = sorted({x for _, rhs in grammar for x in rhs} - self.heads)
        self.root = (self._closure(frozenset((i, 0) for i, (lhs, _) in enumerate(grammar) if lhs == self.start)), None)
        self.next: dict[tuple, dict[str, tuple]] = {}
        self.accepts: dict[tuple, bool] = {}
        todo = [self.root]
        while todo:
            stack = todo.pop()
            if stack in self.next:
                continue
            if len(self.next) >= STACKS:
                raise ValueError(f"the grammar nests its stacks without a bound: more than {STACKS}")
            self.next[stack] = {t: tuple(sorted(self._reduced(to), key=self._plain)) for t in self.tokens if (to := self._push(stack, t))}
            self.accepts[stack] = self._accepts(stack)
            todo += [to for found in self.next[stack].values() for to in found]
        self._number()

    def _plain(self, stack: tuple | None) -> list:
        """The same in every process."""
        return [sorted(stack[0]), *self._plain(stack[1])] if stack else []

    def _closure(self, items: frozenset) -> frozenset:
        while True:
            more = {(i, 0) for r, dot in items for i, (lhs, _) in enumerate(self.grammar) if self.grammar[r][1][dot : dot + 1] == (lhs,)}
            if more <= items:
                return items
            items |= more

    def _push(self, stack: tuple, symbol: str) -> tuple | None:
        moved = frozenset((r, dot + 1) for r, dot in stack[0] if self.grammar[r][1][dot : dot + 1] == (symbol,))
        return (self._closure(moved), stack) if moved else None

    def _reductions(self, stack: tuple, start: bool) -> Iterator[tuple]:
        """The stacks after one reduction; those to the start symbol are for the end of a conversation."""
        for r, dot in stack[0]:
            lhs, rhs = self.grammar[r]
            if dot == len(rhs) and (lhs == self.start) == start:
                below = stack
                for _ in rhs:
                    below = below[1]
                if start:
                    yield below
                elif (to := self._push(below, lhs)) is not None:
                    yield to

    def _reduced(self, stack: tuple) -> set[tuple]:
        """The stacks that wait for a turn or the end, after all reductions."""
        found = {s for to in self._reductions(stack, False) for s in self._reduced(to)}
        waits = any(dot < len(self.grammar[r][1]) or self.grammar[r][0] == self.start for r, dot in stack[0])
        return found | ({stack} if waits else set())

    def _accepts(self, stack: tuple) -> bool:
        return any(below == self.root for below in self._reductions(stack, True))

    def _number(self) -> None:
        """Tops that accept the same rest get the same number: classes are split until none can be told apart."""
        order = list(self.next)
        of = {s: int(self.accepts[s]) for s in order}
        while True:
            marks = {s: (of[s], *(tuple(sorted({of[to] for to in self.next[s].get(t, ())})) for t in self.tokens)) for s in order}
            names: dict[tuple, int] = {}
            new = {s: names.setdefault(marks[s], len(names)) for s in order}
            if len(names) == len(set(of.values())):
                break
            of = new
        first = {}
        for s in order:
            first.setdefault(of[s], s)
        number = {k: i for i, k in enumerate(sorted(first, key=lambda k: (first[k] is not self.root, k)))}
        self.shift = [{} for _ in number]
        self.final = [False] * len(number)
        for k, s in first.items():
            self.shift[number[k]] = {t: tuple(sorted({number[of[to]] for to in tos})) for t, tos in self.next[s].items()}
            self.final[number[k]] = self.accepts[s]


@lru_cache(1)
def stacks() -> Stacks:
    return Stacks()


def _put(tops: dict[int, Value], top: int, value: Value) -> bool:
    if (old := tops.get(top)) is None or value < old:
        tops[top] = value
        return True
    return False


def inserted(tops: dict[int, Value]) -> dict[int, Value]:
    """The tops after any number of inserted turns, none among them."""
    graph, work = stacks(), sorted(tops)
    while work:
        top = work.pop()
        cost, audit, roles = tops[top]
        for token in GIVEN:
            for to in graph.shift[top].get(token, ()):
                if _put(tops, to, (cost + INSERT, audit + "I", roles + token)):
                    work.append(to)
    return tops


def parse(kinds: str, tops: dict[int, Value]) -> dict[int, Value]:
    """The tops after rows of ``kinds``, two characters a row: the role's initial, and its fault (``-``, ``b``lank,
    ``d``uplicate or ``t``runcated). Of equal tops that with the least (cost, audit) is kept.

    Equal costs after the same rows mean that no audit is the beginning of another, so the least one stays least
    whatever follows."""
    graph = stacks()
    for at in range(0, len(kinds), 2):
        initial, fault = kinds[at], kinds[at + 1]
        before, tops = inserted(dict(tops)), {}
        for top, (cost, audit, roles) in before.items():
            _put(tops, top, (cost + DELETE, audit + "D", roles))
            if fault in "bd":
                continue
            more = cost + TRUNCATED * (fault == "t")
            for to in graph.shift[top].get(initial, ()):
                _put(tops, to, (more, audit + "K", roles + initial))
            for token in GIVEN:
                for to in graph.shift[top].get(token, ()):
                    _put(tops, to, (more + REROLE, audit + "R", roles + token))
    return tops


def _from_tops(kinds: str, every: bool) -> tuple[tuple, ...]:
    starts = range(len(stacks().shift)) if every else (0,)
    return tuple((start, end, *value) for start in starts for end, value in parse(kinds, {start: (0, "", "")}).items())


_remembered = lru_cache(1 << 16)(_from_tops)


def from_tops(kinds: str, every: bool) -> tuple[tuple, ...]:
    """Rows ``(top before, top after, cost, audit, roles)``, from the empty stack or from every top; short blocks are remembered."""
    return (_remembered if len(kinds) <= 32 else _from_tops)(kinds, every)


def joined(first: list[tuple], then: list[tuple]) -> list[tuple]:
    """Two blocks as one."""
    found: dict[int, dict[int, Value]] = {}
    by: dict[int, list[tuple]] = {}
    for x in then:
        by.setdefault(x[0], []).append(x)
    for start, middle, cost, audit, roles in first:
        for _, end, more, edits, stay in by.get(middle, ()):
            _put(found.setdefault(start, {}), end, (cost + more, audit + edits, roles + stay))
    return [(start, end, *value) for start, ends in found.items() for end, value in ends.items()]


def best(table: list[tuple]) -> Value:
    """The cheapest way to a whole conversation."""
    tops = inserted({end: tuple(value) for start, end, *value in table if start == 0} if table else {0: (0, "", "")})
    return min(value for top, value in tops.items() if stacks().final[top])


_TABLE = pa.list_(pa.struct([("before", pa.int32()), ("after", pa.int32()), ("cost", pa.int64()), ("audit", pa.string()), ("roles", pa.string())]))
_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_EDGES = ("first_kind", "last_kind", "first_turn", "last_turn", "turns")
_BLOCK = pa.schema([("none", pa.bool_()), ("id", pa.int64()), ("block", pa.int64()), *[(c, pa.int64()) for c in _COUNTS], *[(c, pa.string()) for c in _EDGES[:2]], *[(c, pa.int64()) for c in _EDGES[2:]], ("table", _TABLE)])
_DONE = pa.schema([("none", pa.bool_()), ("id", pa.int64()), ("gaps", pa.int64()), *[(c, pa.int64()) for c in _COUNTS], ("cost", pa.int64()), ("audit", pa.string()), ("roles", pa.string())])
_DDL = {pa.bool_(): "boolean", pa.int64(): "long", pa.string(): "string", _TABLE: "array<struct<before: int, after: int, cost: long, audit: string, roles: string>>"}
_LEGAL = frozenset(("su", "ua", "au"))


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {_DDL[f.type]}" for f in schema)


def _parsed(block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A block's rows, sorted, become its counts, its edges and its table."""
        for batch in batches:
            out = []
            for x in batch.to_pylist():
                rows = x["rows"]
                kinds = "".join(r["kind"] for r in rows)
                turns = [r["turn"] for r in rows if r["turn"] is not None]
                # A block that begins with the first number of a stretch may go on with a conversation of the block before.
                table = from_tops(kinds, rows[0]["n"] % block == 0)
                out.append({
                    "none": x["none"], "id": x["id"], "block": x["block"], "blank": kinds[1::2].count("b"), "duplicate": kinds[1::2].count("d"), "truncated": kinds[1::2].count("t"),
                    "illegal": sum(kinds[i] + kinds[i + 2] not in _LEGAL for i in range(0, len(kinds) - 2, 2)), "first_kind": kinds[0], "last_kind": kinds[-2],
                    "first_turn": turns[0] if turns else None, "last_turn": turns[-1] if turns else None, "turns": len(set(turns)),
                    "table": [dict(zip(("before", "after", "cost", "audit", "roles"), t, strict=True)) for t in table],
                })
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=_BLOCK)

    return run


def _fold(parts: list[dict]) -> dict:
    """Blocks of one conversation in order, as one."""
    whole = dict(parts[0])
    table = [tuple(t.values()) for t in whole["table"]]
    for x in parts[1:]:
        for c in _COUNTS:
            whole[c] += x[c]
        whole["illegal"] += whole["last_kind"] + x["first_kind"] not in _LEGAL
        shared = x["first_turn"] is not None and x["first_turn"] == whole["last_turn"]
        whole["turns"] += x["turns"] - shared
        whole["first_turn"] = x["first_turn"] if whole["first_turn"] is None else whole["first_turn"]
        whole["last_turn"] = whole["last_turn"] if x["last_turn"] is None else x["last_turn"]
        whole["last_kind"] = x["last_kind"]
        table = joined(table, [tuple(t.values()) for t in x["table"]])
    whole["table"] = [dict(zip(("before", "after", "cost", "audit", "roles"), t, strict=True)) for t in table]
    return whole


def _folded(done: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x in batch.to_pylist():
                parts = [p for p in x["parts"] if p["first_kind"] is not None]
                whole = _fold(parts) if parts else {c: 0 for c in _COUNTS} | {"table": [], "first_turn": None, "last_turn": None, "turns": 0, "first_kind": None, "last_kind": None}
                whole |= {"none": x["none"], "id": x["id"], "block": x["block"]}
                if done:
                    whole["cost"], whole["audit"], whole["roles"] = best([tuple(t.values()) for t in whole["table"]])
                    whole["gaps"] = 0 if whole["first_turn"] is None else whole["last_turn"] - whole["first_turn"] + 1 - whole["turns"]
                out.append(whole)
            if out:
                yield pa.RecordBatch.from_pylist([{f: x[f] for f in (_DONE if done else _BLOCK).names} for x in out], schema=_DONE if done else _BLOCK)

    return run


def ordered(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with ``n``: places by conversation and turn (nulls first), equal turns by role and
    text. Nulls of role and text are one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    picked = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), space("role"), space("text"))
    # The last key deals repeats of one row over partitions; they are the same in whichever order they come.
    picked = picked.withColumn("deal", F.monotonically_increasing_id() % 4096)
    return numbered(picked, F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text", "deal").select("conv_id", "turn", "role", "text", (F.col("n") - 1).alias("n"))


def faults(turns: DataFrame) -> DataFrame:
    """``n, none, id, turn, kind`` of numbered rows: a row's role initial and its first fault.

    A repeat is found by the least place of its conversation, role and text; only
    contents that are there twice or more travel to the join, which is written
    first so that a hot one can be split."""
    turns = turns.withColumn("k", F.sha2(F.to_json(F.struct("conv_id", "role", "text")), 256))
    repeated = cut(turns.groupBy("k").agg(F.min("n").alias("first"), F.count("*").alias("times")).filter("times > 1").select("k", "first"), "repeated")
    left = F.rtrim(F.col("text"), F.lit(SPACE))
    end = F.substring(left, -1, 1)
    own = F.when(left == "", "b").when(~end.isin(".", "!", "?"), "t").otherwise("-")
    initial = F.substring("role", 1, 1)
    rows = turns.select("k", "n", *[c.alias(x) for x, c in id_key("conv_id").items()], "turn", F.when(initial.isin(*ROLES), initial).otherwise("?").alias("initial"), own.alias("own"))
    rows = rows.join(repeated, "k", "left")
    return rows.select("n", "none", "id", "turn", F.concat("initial", F.when((F.col("own") != "b") & (F.col("n") > F.col("first")), "d").otherwise(F.col("own"))).alias("kind"))


def repairs(turns: DataFrame, also: DataFrame | None = None, block: int = BLOCK, fan: int = FAN) -> DataFrame:
    """One row a conversation: ``none, id, gaps, blank, duplicate, truncated, illegal, cost, audit, roles``.

    ``also`` names conversations (``none, id``) that may have no row left. No
    task sees more than a block of rows or a fold of blocks' tables.
    """
    rows = faults(turns)
    blocks = rows.groupBy("none", "id", F.expr(f"n div {block}").alias("block")).agg(F.sort_array(F.collect_list(F.struct("n", "kind", "turn"))).alias("rows"))
    blocks = blocks.mapInArrow(_parsed(block), _ddl(_BLOCK))
    if also is not None:
        blocks = blocks.unionByName(also.select("none", "id", F.lit(-1).cast("long").alias("block")), allowMissingColumns=True)
    blocks = cut(blocks, "blocks")
    parts = F.sort_array(F.collect_list(F.struct("block", *_COUNTS, *_EDGES, "table"))).alias("parts")
    while (blocks.groupBy("none", "id").agg(F.count("*").alias("c")).agg(F.max("c")).first()[0] or 0) > fan:
        blocks = blocks.groupBy("none", "id", F.expr(f"floor(block / {fan})").cast("long").alias("block")).agg(parts)
        blocks = cut(blocks.mapInArrow(_folded(False), _ddl(_BLOCK)), "blocks")
    return blocks.groupBy("none", "id").agg(F.lit(0).cast("long").alias("block"), parts).mapInArrow(_folded(True), _ddl(_DONE))


_TURN = "conv_id long, place long, role string, text string, edit string"


def _replayed(emit: bool):
    """Each conversation's audit comes first and then its rows in order; a batch at most is held."""
    kept = [f for f in _DONE if f.name not in ("none", "id", "roles")]
    schema = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())]) if emit else pa.schema([("conv_id", pa.int64()), *kept, ("repaired_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, sha, place, at, out = None, None, 0, 0, []

        def turn(role: str, text: str, edit: str) -> None:
            nonlocal place
            if emit:
                out.append({"conv_id": head["conv_id"], "place": place, "role": role, "text": text, "edit": edit})
            else:
                sha.update((("\n" if place else "") + f"{role}:{text}").encode())
            place += 1

        def insert() -> None:
            nonlocal at
            while at < len(head["audit"]) and head["audit"][at] == "I":
                turn(ROLES[head["roles"][place]], "", "I")
                at += 1

        def close() -> None:
            insert()
            if not emit:
                out.append({c.name: head[c.name] for c in schema if c.name in head} | {"repaired_sha256": sha.hexdigest()})

        for batch in batches:
            for x in batch.to_pylist():
                if x["n"] < 0:
                    if head is not None:
                        close()
                    head, sha, place, at = x, hashlib.sha256(), 0, 0
                    continue
                insert()
                edit = head["audit"][at]
                if edit != "D":
                    turn(x["role"] if edit == "K" else ROLES[head["roles"][place]], x["text"], edit)
                at += 1
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out = []
        if head is not None:
            close()
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def _with_audits(turns: DataFrame, found: DataFrame) -> DataFrame:
    rows = turns.select(*[c.alias(x) for x, c in id_key("conv_id").items()], "n", "role", "text")
    heads = found.withColumn("n", F.lit(-1).cast("long"))
    both = heads.unionByName(rows, allowMissingColumns=True).withColumn("conv_id", F.when(~F.col("none"), F.col("id")))
    return both.repartition("none", "id").sortWithinPartitions("none", "id", "n")


def repaired(rows: DataFrame) -> DataFrame:
    """``conv_id, place, role, text, edit``: the turns of the cheapest whole conversations, in place of ``rows``.

    ``edit`` is K (as it was), R (another role) or I (inserted, with empty text); deleted rows are gone. Blank rows and
    repeats of an earlier row of the conversation are always deleted. Null roles and texts are one space; a null
    conv_id is a conversation of its own; null turns come first; equal turns go by role, then text. Conversations
    whose rows are all deleted have no row. An empty table gives an empty result; other columns are not read.
    """
    turns = ordered(rows)
    return _with_audits(turns, repairs(turns)).mapInArrow(_replayed(True), _TURN)


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies``: rows damaged by the checksum of ``conv_id:turn`` modulo 20. 0 leaves no
    copy, 1 no text, 2 no ``[.!?]``, 3 two copies, 4 the role user; nulls are one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hit = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text: Column = F.when(hit == 1, "").when(hit == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    role = F.when(hit == 4, "user").otherwise(space("role"))
    copies = F.when(hit == 0, 0).when(hit == 3, 2).otherwise(1)
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), copies.alias("copies"))


def repair_damaged(rows: DataFrame, block: int = BLOCK, fan: int = FAN) -> DataFrame:
    """Damage, repair and digests: one row for every conv_id of ``rows``, those without a row left too.

    The digest of a conversation needs its rows in order, so they meet in one task, which streams them; what it holds
    is the audit, a character a row. All else is done in blocks. Nulls, ties and empty tables as in ``repaired``; equal
    turns stand by the role and text that the damage leaves.
    """
    hit = damaged(rows)
    gone = hit.filter("copies = 0").select(*[c.alias(x) for x, c in id_key("conv_id").items()]).distinct()
    turns = ordered(hit.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("copies")))))
    shown = ", ".join(f"{f.name} {_DDL[f.type]}" for f in _DONE if f.name not in ("none", "id", "roles"))
    return _with_audits(turns, repairs(turns, gone, block, fan)).mapInArrow(_replayed(False), f"conv_id long, {shown}, repaired_sha256 string")
