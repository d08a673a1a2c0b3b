"""Chat formatting: layouts told apart by a schema fingerprint, canonical turns, reversible template.

A record's layout is the set of its nested field paths. The hash of those paths
that any declared mapping knows selects the mapping, which says where the turns
are; where no mapping has just these, the one with the most paths that are all
there is taken, of equals the one declared first. Formatted turns read ``<turn:ROLE>TEXT</turn>`` and a line feed; inside
role and text the control characters are escaped, so that no text can close a
turn or open another, and reading back gives every text exactly.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOSS_ROLE = "assistant"
#: In this order to escape, reversed to read back: each escape is a backslash and one letter.
ESCAPES = (("\\", "\\b"), ("<", "\\l"), (">", "\\g"))
TURN = re.compile(r"<turn:([^<>]*)>([^<>]*)</turn>\n", re.S)


@dataclass(frozen=True)
class Mapping:
    """``paths`` name the layout; ``turns`` are (role, paths of its text joined by a blank line), or
    ``each`` is (path of an array, role field, text field), or ``row`` is (conversation, order, role, text)."""

    name: str
    paths: tuple[str, ...]
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()
    each: tuple[str, str, str] | None = None
    row: tuple[str, str, str, str] | None = None


MAPPINGS = (
    Mapping("rows by turn", ("conv_id", "turn", "role", "text"), row=("conv_id", "turn", "role", "text")),
    Mapping("messages", ("messages[].role", "messages[].content"), each=("messages", "role", "content")),
    Mapping("conversations", ("conversations[].from", "conversations[].value"), each=("conversations", "from", "value")),
    Mapping("prompt and response", ("prompt", "response"), turns=(("user", ("prompt",)), ("assistant", ("response",)))),
    Mapping("prompt and completion", ("prompt", "completion"), turns=(("user", ("prompt",)), ("assistant", ("completion",)))),
    Mapping("instruction", ("instruction", "output"), turns=(("user", ("instruction",)), ("assistant", ("output",)))),
    Mapping("instruction with input", ("instruction", "input", "output"), turns=(("user", ("instruction", "input")), ("assistant", ("output",)))),
    Mapping("nested dialogue", ("data.system", "data.turns[].speaker", "data.turns[].text"), each=("data.turns", "speaker", "text"), turns=(("system", ("data.system",)),)),
)
#: Other names that layouts give to roles.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
#: Lists of turns with their text fields; these may be lists of content parts.
TEXTS = frozenset((m.each[0], m.each[2]) for m in MAPPINGS if m.each)
KNOWN = frozenset(p for m in MAPPINGS for p in m.paths)


def fingerprint(paths) -> str:
    """Of the paths that a mapping knows, sorted; other fields do not matter."""
    return hashlib.sha256("\n".join(sorted(KNOWN.intersection(paths))).encode()).hexdigest()[:16]


BY_FINGERPRINT = {fingerprint(m.paths): m for m in MAPPINGS}
#: For records with more known names than one mapping has.
MOST_SPECIFIC = sorted(MAPPINGS, key=lambda m: -len(m.paths))


def schema_paths(kind: T.DataType, at: str = "") -> list[str]:
    """All nested leaf paths of a type; ``[]`` marks array elements."""
    if isinstance(kind, T.StructType):
        return [p for f in kind for p in schema_paths(f.dataType, f"{at}.{f.name}" if at else f.name)]
    if isinstance(kind, T.ArrayType):
        return schema_paths(kind.elementType, f"{at}[]")
    return [at]


def mapping_of(df: DataFrame) -> Mapping:
    paths = schema_paths(df.schema)
    found = BY_FINGERPRINT.get(fingerprint(paths)) or next((m for m in MOST_SPECIFIC if set(m.paths) <= set(paths)), None)
    if found is None:
        raise ValueError(f"no mapping for the layout {sorted(schema_paths(df.schema))}")
    return found


def _text(x: Column) -> Column:
    return F.coalesce(x.cast("string"), F.lit(""))


def _role(x: Column) -> Column:
    return F.coalesce(F.element_at(F.create_map(*[F.lit(v) for kv in ROLES.items() for v in kv]), x), x, F.lit(""))


def _kind(x: Column) -> Column:
    return F.schema_of_variant(x)


def _part_texts(x: Column) -> Column:
    """The texts of a variant list of content parts, each a string or an object with one; null for other parts."""
    own = lambda p: F.when(_kind(p) == "STRING", p.cast("string")).when(_kind(p).startswith("OBJECT"), F.try_variant_get(p, "$.text", "string"))
    return F.transform(F.try_variant_get(x, "$", "array<variant>"), own)


def _content(x: Column, kind: T.DataType) -> Column:
    """A turn's text: a string, or the texts of its content parts one after the other."""
    if isinstance(kind, T.VariantType):
        return F.when(_kind(x).startswith("ARRAY"), F.array_join(_part_texts(x), "")).otherwise(_text(x))
    return _text(x)


def _turn_type(kind: T.DataType, path: str) -> T.StructType:
    for p in path.split("."):
        kind = kind[p].dataType
    return kind.elementType


def canonical_turns(df: DataFrame, record_id: str = "id") -> DataFrame:
    """``conv_id, turn, role, text`` from a table in any declared layout; one row a turn.

    Null texts and roles become empty. Layouts other than rows by turn take the
    conversation from ``record_id``; their turns count from 0 and a null or
    empty list of messages gives no turn. An unknown layout is refused.
    """
    m = mapping_of(df)
    if m.row:
        conv, turn, role, text = (F.col(c) for c in m.row)
        return df.select(conv.alias("conv_id"), turn.alias("turn"), _text(role).alias("role"), _text(text).alias("text"))
    made = [F.struct(F.lit(r).alias("role"), F.concat_ws("\n\n", *[F.when(F.col(p) != "", F.col(p)) for p in ps]).alias("text")) for r, ps in m.turns]
    turns = F.array(*made) if made else None
    if m.each:
        path, role, text = m.each
        content = _turn_type(df.schema, path)[text].dataType
        listed = F.transform(F.col(path), lambda x: F.struct(_role(x[role].cast("string")).alias("role"), F.coalesce(_content(x[text], content), F.lit("")).alias("text")))
        turns = listed if turns is None else F.concat(turns, F.coalesce(listed, F.array().cast("array<struct<role:string,text:string>>")))
    out = df.select(F.col(record_id).alias("conv_id"), F.posexplode(turns).alias("turn", "t"))
    return out.select("conv_id", F.col("turn").cast("long").alias("turn"), "t.role", "t.text")


def canonical_json(df: DataFrame, payload: str = "record", record_id: str = "id") -> DataFrame:
    """The same from JSON records whose layouts differ row by row, with ``layout``, the mapping's name.

    A text given as a list of content parts is their texts, one after the other.
    Records that are null, not JSON objects or of no known layout, as with content
    parts that hold no text, give one row
    with a null layout, and records of a known one without turns one row with a
    null turn, so that none is lost unseen.
    """
    parsed = df.select(F.col(record_id).alias("id"), F.col(payload).alias("raw"), F.try_parse_json(payload).alias("v"))
    parsed = parsed.select("id", "raw", _layout(F.col("v")).alias("layout"))
    out = parsed.filter("layout is null").select(F.col("id").cast("string").alias("conv_id"), F.lit(None).cast("long").alias("turn"), *[F.lit(None).cast("string").alias(c) for c in ("role", "text", "layout")])
    for m in MAPPINGS:
        rows = parsed.filter(F.col("layout") == m.name).select("id", F.from_json("raw", _typed(m.paths)).alias("r")).select("id", "r.*")
        turns = canonical_turns(rows.drop("id") if m.row else rows)
        if m.each:
            path = m.each[0]
            silent = rows.filter(F.coalesce(F.size(path), F.lit(0)) <= 0) if not m.turns else rows.limit(0)
            turns = turns.select(F.col("conv_id").cast("string").alias("conv_id"), "turn", "role", "text").unionByName(silent.select(F.col("id").cast("string").alias("conv_id"), F.lit(None).cast("long").alias("turn"), *[F.lit(None).cast("string").alias(c) for c in ("role", "text")]))
        turns = turns.withColumn("layout", F.lit(m.name))
        out = out.unionByName(turns.withColumns({"conv_id": F.col("conv_id").cast("string"), "turn": F.col("turn").cast("long")}))
    return out


def _layout(v: Column) -> Column:
    """The name of the mapping for a variant, by the known leaf paths that it has."""
    kind = lambda x: F.schema_of_variant(x)
    get = lambda x, p, t="variant": F.try_variant_get(x, f"$.{p}", t)
    leaf = lambda x: F.coalesce(~F.startswith(kind(x), F.lit("OBJECT")) & ~F.startswith(kind(x), F.lit("ARRAY<OBJECT")), F.lit(False))

    def has(path: str) -> Column:
        if "[]." not in path:
            return leaf(get(v, path))
        root, field = path.split("[].")
        items = get(v, root, "array<variant>")
        objects = F.forall(items, lambda x: F.coalesce(F.startswith(kind(x), F.lit("OBJECT")) | (kind(x) == "VOID"), F.lit(True)))
        plain = lambda x: leaf(get(x, field)) & ~F.coalesce(kind(get(x, field)).startswith("ARRAY"), F.lit(False))
        if (root, field) not in TEXTS:
            return F.coalesce(objects & F.exists(items, lambda x: leaf(get(x, field))), F.lit(False))
        listed = lambda x: F.coalesce(kind(get(x, field)).startswith("ARRAY"), F.lit(False))
        texts = lambda x: F.forall(_part_texts(get(x, field)), lambda t: t.isNotNull())
        known = F.forall(items, lambda x: F.when(listed(x), F.coalesce(texts(x), F.lit(False))).otherwise(F.coalesce(~kind(get(x, field)).startswith("OBJECT"), F.lit(True))))
        return F.coalesce(objects & known & F.exists(items, lambda x: plain(x) | listed(x)), F.lit(False))

    def empty(m: Mapping) -> Column:
        """Whether the mapping's list is there, but null or without elements."""
        return F.coalesce(kind(get(v, m.each[0])).isin("VOID", "ARRAY<VOID>") & (F.coalesce(F.size(get(v, m.each[0], "array<variant>")), F.lit(0)) <= 0), F.lit(False))

    known = F.array_compact(F.array(*[F.when(has(p), F.lit(p)) for p in sorted(KNOWN)]))
    mark = F.substring(F.sha2(F.array_join(known, "\n"), 256), 1, 16)
    exact = F.element_at(F.create_map(*[F.lit(x) for k, m in BY_FINGERPRINT.items() for x in (k, m.name)]), mark)
    fits = [F.when(F.size(F.array_except(F.array(*map(F.lit, m.paths)), known)) == 0, F.lit(m.name)) for m in MOST_SPECIFIC]
    others = lambda m: [p for p in m.paths if not p.startswith(f"{m.each[0]}[].")]
    silent = [F.when(empty(m) & F.forall(F.array(*map(F.lit, others(m))).cast("array<string>"), lambda p: F.array_contains(known, p)), F.lit(m.name)) for m in MOST_SPECIFIC if m.each]
    return F.coalesce(exact, *fits, *silent)


def _typed(paths: tuple[str, ...]) -> T.StructType:
    """The type of records with these paths."""
    tree: dict = {}
    for p in paths:
        at = tree
        *up, leaf = p.split(".")
        for x in up:
            at = at.setdefault(x, {})
        at[leaf] = None

    def kind(t: dict, at: str = "") -> T.StructType:
        return T.StructType([T.StructField(k.removesuffix("[]"), T.StringType() if v is None else T.ArrayType(kind(v, at + k.removesuffix("[]"))) if k.endswith("[]") else kind(v, f"{at}{k}.")) if (at, k) not in TEXTS else T.StructField(k, T.VariantType()) for k, v in t.items()])

    return kind(tree)


def escape(x: Column) -> Column:
    for a, b in ESCAPES:
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def unescape(text: str) -> str:
    for a, b in reversed(ESCAPES):
        text = text.replace(b, a)
    return text


def format_turns(turns: DataFrame) -> DataFrame:
    """Each turn with ``segment``, its formatted text, and the loss mask's part ``[loss_start, loss_end)`` in it.

    A conversation's formatted text is its segments in order of turn; offsets
    are code points in the segment, and equal where the turn has no loss.
    """
    head = F.concat(F.lit("<turn:"), escape(F.col("role")), F.lit(">"))
    body = escape(F.col("text"))
    end = F.length(head) + F.when(F.col("role") == LOSS_ROLE, F.length(body)).otherwise(0)
    return turns.select("*", F.concat(head, body, F.lit("</turn>\n")).alias("segment"), F.length(head).alias("loss_start"), end.alias("loss_end"))


_READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by conversation; only digests and counts of the current one are held."""
    names = [x.split()[0] for x in _READ.split(", ")]
    kinds = [pa.string() if "string" in x else pa.int64() for x in _READ.split(", ")]
    now, all_, loss, n, lost, chars = None, None, None, 0, 0, 0

    def close() -> list:
        return [*now, n, all_.hexdigest(), lost, loss.hexdigest(), chars]

    for batch in batches:
        out = []
        for conv, segment, start, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now != (conv,):
                if now is not None:
                    out.append(close())
                now, all_, loss, n, lost, chars = (conv,), hashlib.sha256(), hashlib.sha256(), 0, 0, 0
            role, text = map(unescape, TURN.fullmatch(segment).groups())
            all_.update(f"{role}\n{text}\n".encode())
            masked = unescape(segment[start:end])
            loss.update(masked.encode())
            n, lost, chars = n + 1, lost + len(masked), chars + len(segment)
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names) if out else pa.RecordBatch.from_arrays([pa.array([], k) for k in kinds], names=names)
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(close(), kinds, strict=True)], names=names)


def digests(formatted: DataFrame) -> DataFrame:
    """One row per conversation, read back from its segments.

    Turns go in order of turn, nulls last, ties by role and text; a null
    conv_id is a conversation of its own. A conversation's digest needs its
    turns in order, so its rows meet in one task, which streams them in sorted
    order and holds no more than a batch, however long the conversation.
    """
    rows = formatted.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_last(), "role", "text")
    return rows.select(F.col("conv_id").cast("long"), "segment", "loss_start", "loss_end").mapInArrow(_read_back, _READ)
