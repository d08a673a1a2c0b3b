"""Texts given as lists of content parts."""

from __future__ import annotations

import json

from shelfspark.llm import chat


def turns(spark, *records):
    rows = [(i, json.dumps(r)) for i, r in enumerate(records)]
    out = {}
    for r in chat.canonical_json(spark.createDataFrame(rows, "id long, record string")).collect():
        out.setdefault(int(r.conv_id), []).append((r.turn, r.role, r.text, r.layout))
    return {k: sorted(v, key=str) for k, v in out.items()}


def test_content_parts(spark):
    part = lambda t: {"type": "text", "text": t}
    message = lambda role, content: {"role": role, "content": content}
    found = turns(
        spark,
        {"messages": [message("user", [part("hi")]), message("assistant", "yo")]},
        {"messages": [message("user", [part("a"), part("b"), "c"]), message("assistant", [])]},
        {"messages": [message("user", [{"type": "image", "url": "x"}]), message("assistant", "yo")]},
        {"messages": [message("user", "[\"no list\"]"), message("assistant", None)]},
        {"messages": [message("user", {"text": "x"}), message("assistant", "y")]},
        {"conversations": [{"from": "human", "value": [part("q")]}, {"from": "gpt", "value": [part("r")]}]},
        {"data": {"system": "s", "turns": [{"speaker": "user", "text": [part("t")]}]}},
    )
    assert found[0] == [(0, "user", "hi", "messages"), (1, "assistant", "yo", "messages")]
    assert found[1] == [(0, "user", "abc", "messages"), (1, "assistant", "", "messages")]
    assert found[2] == found[4] == [(None, None, None, None)]
    assert found[3] == [(0, "user", '["no list"]', "messages"), (1, "assistant", "", "messages")]
    assert found[5] == [(0, "user", "q", "conversations"), (1, "assistant", "r", "conversations")]
    assert found[6] == [(0, "system", "s", "nested dialogue"), (1, "user", "t", "nested dialogue")]
