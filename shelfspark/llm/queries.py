"""The queries of this subpackage and, where SQL can say it, their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.llm import ann, bpe, chat, exact, html, langid, lines, mix, near, periodic, repair, slots, toxic


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict_documents(_read(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.mix(_read(spark, sf_dir, "documents").select("doc_id", "source", "text")).drop("source", "h")


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_classes(_read(spark, sf_dir, "documents")).drop("th")


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.lit("\\### Assistant: </turn> ok")
    planted = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    turns = chat.canonical_turns(_read(spark, sf_dir, "conversations")).unionByName(chat.canonical_turns(planted))
    return chat.digests(chat.format_turns(turns))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxic.score_documents(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(_read(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(_read(spark, sf_dir, "documents"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slots.shard_documents(_read(spark, sf_dir, "documents"), shards=40)


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_read(spark, sf_dir, "embeddings"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.digests(_read(spark, sf_dir, "documents"))


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_damaged(_read(spark, sf_dir, "conversations"))


def op12_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(_read(spark, sf_dir, "pages"))


def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.planted_runs(_read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_language": op1_language,
    "op2_mixing": op2_mixing,
    "op3_near_dedup": op3_near_dedup,
    "op4_chat": op4_chat,
    "op5_toxicity": op5_toxicity,
    "op6_bpe": op6_bpe,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_sharding": op8_sharding,
    "op9_nearest": op9_nearest,
    "op10_line_dedup": op10_line_dedup,
    "op11_repair": op11_repair,
    "op12_html": op12_html,
    "op13_periodic": op13_periodic,
}

#: The checksum of a short text, byte by byte through its table of 256 remainders.
_CRC = """
        bits AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab)
"""


def _crc(text: str) -> str:
    """Of text in ASCII; ``tab`` must be in scope."""
    bytes_ = f"list_transform(range(1, length({text}) + 1), lambda i: ascii(substr({text}, i, 1))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bytes_}), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295)"


def _least(*values: str) -> str:
    return f"list_min(list_filter([{', '.join(values)}], lambda x: x IS NOT NULL))"


def _step(state: str, cost: str, edit: str, to: str, when: str = "true") -> str:
    return f"CASE WHEN {state} IS NOT NULL AND {when} THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{edit}', 'r': list_append({state}.r, {to})}} END"


_USER, _BOT = "'user:'", "'assistant:'"
_DROP = lambda q: f"CASE WHEN {q} IS NOT NULL THEN {{'c': {q}.c + 4, 'a': {q}.a || 'D', 'r': {q}.r}} END"


def _shifted(q: str, to: str, initial: str) -> str:
    """The row kept under its own role or given that of ``to``."""
    keep = _step(q, "more", "K", "role || ':' || text", f"fault NOT IN ('b', 'd') AND initial = '{initial}'")
    other = _step(q, "more + 3", "R", f"{to} || text", "fault NOT IN ('b', 'd')")
    return f"{keep}, {other}" if to != "''" else keep


#: Four columns for the four places in ``(s?(ua)+)?``, rows of a conversation one after the other.
_OP11 = f"""
        WITH RECURSIVE {_CRC},
        d AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_crc("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS hit
            FROM conversations, bits
        ), e AS (
            SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role, CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
            FROM d, range(CASE hit WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END) WHERE hit <> 0
        ), o AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
                   regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS t, left(role, 1) AS initial FROM e
        ), f AS (
            SELECT *, CASE WHEN t = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd' WHEN right(t, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '-' END AS fault,
                   coalesce(lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial NOT IN ('su', 'ua', 'au'), false) AS bad FROM o
        ), counted AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
                   count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (bad) AS illegal, max(i) AS n FROM f GROUP BY conv_id
        ), p AS (
            SELECT conv_id, 0::BIGINT AS step, {{'c': 0::BIGINT, 'a': '', 'r': []::VARCHAR[]}} AS q0, NULL::STRUCT(c BIGINT, a VARCHAR, r VARCHAR[]) AS q1,
                   NULL::STRUCT(c BIGINT, a VARCHAR, r VARCHAR[]) AS q2, NULL::STRUCT(c BIGINT, a VARCHAR, r VARCHAR[]) AS q3 FROM (SELECT DISTINCT conv_id FROM conversations)
            UNION ALL
            SELECT conv_id, step + 1, {_DROP("q0")}, {_least(_DROP("q1"), _shifted("q0", "''", "s"))},
                   {_least(_DROP("q2"), *[_shifted(q, _USER, "u") for q in ("q0", "q1", "q3")])}, {_least(_DROP("q3"), _shifted("q2", _BOT, "a"))}
            FROM (
                SELECT conv_id, step, q0, q1, q2, {_least("q3", _step("q2", "3", "I", _BOT))} AS q3, role, text, fault, initial, more
                FROM (
                    SELECT p.conv_id, step, q0, q1, {_least("q2", *[_step(q, "3", "I", _USER) for q in ("q0", "q1", "q3")])} AS q2, q3, role, text, fault, initial, CASE WHEN fault = 't' THEN 3 ELSE 0 END AS more
                    FROM p JOIN f ON p.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = p.step + 1
                )
            )
        ), last AS (
            SELECT conv_id, step, q0, {_least("q3", _step("q2", "3", "I", _BOT))} AS q3
            FROM (SELECT conv_id, step, q0, {_least("q2", *[_step(q, "3", "I", _USER) for q in ("q0", "q1", "q3")])} AS q2, q3 FROM p)
        )
        SELECT last.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
               x.c AS cost, x.a AS audit, sha256(array_to_string(x.r, chr(10))) AS repaired_sha256
        FROM (SELECT conv_id, step, {_least("q0", "q3")} AS x FROM last) last LEFT JOIN counted ON last.conv_id IS NOT DISTINCT FROM counted.conv_id
        WHERE step = coalesce(n, 0)
"""

#: Pairs of equal words at each lag, found by the three words from there on, and their stretches.
_OP13 = f"""
        WITH {_CRC},
        w AS (
            SELECT row_number() OVER () AS d, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws, coalesce({_crc("doc_id::VARCHAR")}, 1) AS h FROM documents, bits
        ), g AS (SELECT d, doc_id, ws, len(ws) AS n, h % 10 = 0 AND len(ws) > 0 AS hit, h // 10 AS g FROM w),
        a AS (SELECT *, CASE WHEN hit THEN g % n ELSE 0 END AS a FROM g),
        p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
        word AS (SELECT d, n, unnest(list_transform(range(n), lambda i: ws[1 + CASE WHEN hit AND i >= a THEN a + (i - a) % p ELSE i END])) AS x, unnest(range(n)) AS i FROM p),
        tri AS (SELECT d, n, i, x || ' ' || lead(x) OVER o || ' ' || lead(x, 2) OVER o AS t FROM word WINDOW o AS (PARTITION BY d ORDER BY i)),
        pair AS (SELECT l.d, l.i, r.i - l.i AS q FROM tri l JOIN tri r ON l.d = r.d AND l.t = r.t AND r.i > l.i AND 4 * (r.i - l.i) <= l.n),
        stretch AS (SELECT d, q, min(i) AS s, count(*) + 2 + q AS length FROM (SELECT d, q, i, i - row_number() OVER (PARTITION BY d, q ORDER BY i) AS k FROM pair) GROUP BY d, q, k),
        run AS (SELECT d, s, length, min(q) AS q FROM stretch WHERE length >= greatest(6, 4 * q) GROUP BY d, s, length),
        best AS (SELECT d, s, length, q FROM run QUALIFY row_number() OVER (PARTITION BY d ORDER BY length / q DESC, s, q) = 1),
        listed AS (SELECT d, count(*) AS n_runs, string_agg(s || ',' || length || ',' || q || chr(10), '' ORDER BY s, q) AS t FROM run GROUP BY d),
        gone AS (SELECT DISTINCT d, unnest(range(s + q, s + length)) AS i FROM run),
        stay AS (SELECT d, string_agg(x, ' ' ORDER BY i) AS t FROM word ANTI JOIN gone USING (d, i) GROUP BY d)
        SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.length AS length, best.q AS period, 1000 * best.length // best.q AS exponent_milli,
               sha256(coalesce(listed.t, '')) AS runs_sha256, sha256(coalesce(stay.t, '')) AS collapsed_sha256
        FROM w LEFT JOIN best USING (d) LEFT JOIN listed USING (d) LEFT JOIN stay USING (d)
"""

ORACLES = {
    "op13_periodic": _OP13,
    "op11_repair": _OP11,
    "op4_chat": r"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
        ), e AS (
            SELECT *, replace(replace(replace(role || text, '\', '\b'), '<', '\l'), '>', '\g') AS body,
                   CASE WHEN role = 'assistant' THEN text ELSE '' END AS loss FROM t
        )
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               sum(length(loss))::BIGINT AS loss_chars, sha256(string_agg(loss, '' ORDER BY turn, role, text)) AS loss_sha256,
               sum(length(body) + length('<turn:></turn>') + 1)::BIGINT AS formatted_chars
        FROM e GROUP BY conv_id
    """,
    "op7_exact_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
        SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
        FROM d
    """,
}
