"""Layouts by fingerprint, the template's round trip, and the loss mask."""

import json
import random

from pyspark.sql import functions as F

from tests.llm.brute import ordered, sha
from visitlens.llm import chat


def turns(rows, column="turns"):
    return [None if r[column] is None else [(t.role, t.text) for t in r[column]] for r in rows]


def test_layouts_of_json_texts(spark):
    records = [
        ({"prompt": "p", "response": "r"}, [("user", "p"), ("assistant", "r")]),
        ({"response": None, "prompt": "p"}, [("user", "p"), ("assistant", "")]),
        ({"Prompt": "p", "completion": "c"}, None),
        ({"system": "s", "prompt": "p", "response": "r"}, [("system", "s"), ("user", "p"), ("assistant", "r")]),
        ({"instruction": "do", "input": "x", "output": "y"}, [("user", "do\n\nx"), ("assistant", "y")]),
        ({"instruction": "do", "input": "", "output": "y"}, [("user", "do"), ("assistant", "y")]),
        ({"messages": [{"role": "human", "content": "h"}, {"content": "g", "role": "GPT"}]}, [("user", "h"), ("assistant", "g")]),
        ({"conversations": [{"from": "human", "value": "h"}, {"from": None, "value": None}]}, [("user", "h"), ("", "")]),
        ({"turns": [{"turn": 2, "role": "b", "text": "2"}, {"turn": 1, "role": "a", "text": "1"}]}, [("a", "1"), ("b", "2")]),
        ({"other": 1}, None),
        ({}, None),
    ]
    given = [(i, json.dumps(record)) for i, (record, _) in enumerate(records)] + [(90, None), (91, "{broken")]
    found = chat.from_json_texts(spark.createDataFrame(given, "i int, record string")).orderBy("i").collect()
    wanted = [x for _, x in records] + [None, None]
    wanted[2] = [("user", ""), ("assistant", "c")]
    assert turns(found) == wanted


def test_records_with_more_than_a_layout_asks_for(spark):
    """Empty lists, other keys at the top and in any item, unlike items, and texts that look like lists."""
    said = [("user", "h"), ("assistant", "g")]
    pair = [{"role": "user", "content": "h"}, {"role": "assistant", "content": "g"}]
    records = [
        ({"messages": []}, []),
        ({"conversations": [], "id": 3}, []),
        ({"turns": []}, []),
        ({"messages": pair, "id": "x", "meta": {"a": [1]}}, said),
        ({"messages": [{**pair[0], "name": "n"}, pair[1]]}, said),
        ({"messages": [pair[0], {**pair[1], "tool": {"deep": [{"role": "x"}]}}]}, said),
        ({"messages": [{"role": "user"}, {"content": "g", "role": "assistant"}]}, [("user", ""), ("assistant", "g")]),
        ({"messages": [pair[0], None, pair[1]]}, [("user", "h"), ("", ""), ("assistant", "g")]),
        ({"messages": ["h", "g"]}, None),
        ({"messages": [{"role": "user"}]}, None),
        ({"messages": None}, None),
        ({"messages": {"role": "user", "content": "h"}}, None),
        ({"system": "s", "prompt": "p", "response": "r", "x": 1}, [("system", "s"), ("user", "p"), ("assistant", "r")]),
        ({"instruction": "do", "output": "y", "source": "z"}, [("user", "do"), ("assistant", "y")]),
        ({"prompt": "[1] p", "response": "[{\"role\": \"x\"}]"}, [("user", "[1] p"), ("assistant", "[{\"role\": \"x\"}]")]),
        ({"it's": 1, "question": "q", "answer": "a", "$['x']": []}, [("user", "q"), ("assistant", "a")]),
        ([1, 2], None),
        ("text", None),
    ]
    given = [(i, json.dumps(record)) for i, (record, _) in enumerate(records)]
    found = chat.from_json_texts(spark.createDataFrame(given, "i int, record string"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    for row, (record, wanted) in zip(turns(found.orderBy("i").collect()), records):
        assert row == wanted, record
    written = chat.read_back(chat.formatted(found.filter("i = 0"))).first()
    assert written.formatted == "" and written.read_turns == []


def test_structs_with_more_than_a_layout_asks_for(spark):
    kind = "record struct<id: int, turns: array<struct<mark: string, turn: int, role: string, text: string>>, more: string>"
    given = spark.createDataFrame([((1, [("a", 2, "r2", "t2"), ("b", 1, "r1", "t1")], "x"),), ((2, [], "x"),)], kind)
    found = chat.from_structs(given).collect()
    assert turns(found) == [[("r1", "t1"), ("r2", "t2")], []]
    assert {r.layout for r in found} == {"rows_by_turn"}


def test_layouts_of_structs(spark):
    given = spark.createDataFrame([(("q", "a"),), (None,)], "record struct<question: string, answer: string>")
    assert turns(chat.from_structs(given).collect()) == [[("user", "q"), ("assistant", "a")], [("user", ""), ("assistant", "")]]
    unknown = spark.createDataFrame([((1,),)], "record struct<x: int>")
    assert turns(chat.from_structs(unknown).collect()) == [None]


def test_round_trip_and_mask(spark):
    rng = random.Random(3)
    signs = ["<|im_start|>", "<|im_end|>", "<\\|", "<", "|", "\\", "\n", "assistant", "é", "", "\\n", "\\b", "$1"]
    rows = []
    for conv in range(60):
        for turn in range(rng.randrange(1, 6)):
            role = rng.choice(["user", "assistant", None, "a\nb", "x<|im_end|>\\n"])
            text = rng.choice([None, "".join(rng.choice(signs) for _ in range(rng.randrange(8)))])
            rows.append((conv, rng.choice([turn, turn, None]), role, text))
    rows += [(None, 0, "assistant", "same")] * 2
    schema = "conv_id int, turn int, role string, text string"
    found = chat.read_back(chat.formatted_conversations(spark.createDataFrame(rows, schema))).collect()
    def key(row):
        return [(x is not None, x) for x in row[1:]]
    assert len(found) == 61
    for r in found:
        own = [(role or "", text or "") for _, _, role, text in sorted((x for x in rows if x[0] == r.conv_id), key=key)]
        assert [(t.role, t.text) for t in r.read_turns] == own
        assert list(r.loss_texts) == [text for role, text in own if role == "assistant"]
        assert r.formatted.count(chat.START) == r.formatted.count(chat.END) == len(own)


def test_main_path_is_native(spark):
    rows = spark.createDataFrame([], "conv_id int, turn int, role string, text string")
    found = chat.read_back(chat.formatted_conversations(rows))
    assert found.collect() == []
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_null_and_empty_turns(spark):
    given = spark.createDataFrame([(1, None), (2, [])], f"i int, turns {chat.TURNS}")
    found = {r.i: r for r in chat.read_back(chat.formatted(given)).collect()}
    assert found[1].formatted is None and found[1].read_turns is None
    assert found[2].formatted == "" and found[2].read_turns == [] and found[2].loss_texts == []
