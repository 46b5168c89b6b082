"""Operator 11: layouts by fingerprint, exact read-back, loss mask, edge cases."""

import hashlib
import json
import random

import pytest
from oracle_check import difference, oracle_connection
from pyspark.sql import functions as F

from ledgerspark.llm import chat_layouts as cl
from ledgerspark.llm.oracle import ORACLES
from ledgerspark.llm.queries import QUERIES

QUERY = "op11_schema_chats"
PIECES = ["\\", "\\\\", "<", "|", "<|", "<|im_end|>", "<|im_start|>user<|im_sep|>", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
          "[", "/", "s>", "\n", " ", "é", "🙂", "", "text", "$1", "\x00", "<\\|", "[\\INST]"]


def canonical(spark, *values, layouts=None):
    rows = [(i, v if isinstance(v, str) or v is None else json.dumps(v)) for i, v in enumerate(values)]
    records = cl.json_records(spark.createDataFrame(rows, "id int, body string"), "id", "body")
    got = sorted(cl.canonical_turns(records, "id", layouts).collect())
    return [(r["layout"], None if r["turns"] is None else [tuple(t) for t in r["turns"]]) for r in got]


def test_layouts(spark):
    u, a, s = ("user", "Hi"), ("assistant", "Yes"), ("system", "Be kind")
    pair = [{"role": "user", "content": "Hi"}, {"role": "assistant", "content": "Yes"}]
    got = canonical(
        spark,
        {"messages": pair},
        {"messages": pair, "id": 7, "meta": {"lang": ["de"]}},
        {"conversations": [{"from": "human", "value": "Hi"}, {"from": "gpt", "value": "Yes"}, {"from": "tool", "value": "1"}]},
        {"instruction": "Hi", "output": "Yes"},
        {"instruction": "Add", "input": "1 2", "output": "3"},
        {"instruction": "Hi", "input": "", "output": "Yes", "system": "Be kind"},
        {"instruction": "Hi", "input": None, "output": None},
        {"prompt": "Hi", "completion": "Yes"},
        {"prompt": "Hi", "response": "Yes"},
        {"context": "C", "question": "Hi", "answer": "Yes"},
        {"messages": [{"role": "user", "content": [{"type": "text", "text": "H"}, {"type": "text", "text": "i"}]}]},
        {"turn": 3, "role": "user", "text": "Hi"},
        {"messages": []},
        {"messages": [{"content": "Hi"}, {"role": None, "content": None}]},
        {"unknown": "x"},
        {"messages": pair, "prompt": "Hi"},
        {"prompt": pair},
        [1, 2],
        "no json",
        None,
        {},
    )
    plain = [
        ("messages", [u, a]),
        ("messages", [u, a]),
        ("speakers", [u, a, ("tool", "1")]),
        ("instruction", [u, a]),
        ("instruction", [("user", "Add\n\n1 2"), ("assistant", "3")]),
        ("instruction", [s, u, a]),
        ("instruction", [u, ("assistant", "")]),
        ("prompt", [u, a]),
        ("response", [u, a]),
        ("question", [("user", "C\n\nHi"), a]),
        ("message parts", [u]),
        ("rows", [u]),
        ("messages", []),
        ("messages", [("", "Hi"), ("", "")]),
    ]
    assert got == plain + [(None, None)] * 7


def test_fingerprint_is_the_hash_of_known_paths(spark):
    values = [{"messages": [{"role": "a", "content": "b"}, {"extra": 1}], "z": {"y": [[1]]}}, {"prompt": "x"}, {}]
    rows = spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(values)], "id int, body string")
    read = rows.select("id", cl.field_paths(F.try_parse_json("body")).alias("paths"), cl.fingerprint(F.try_parse_json("body"), cl.LAYOUTS).alias("mark"))
    got = {r["id"]: r for r in read.collect()}
    assert sorted(got[0]["paths"]) == ["messages[].content", "messages[].extra", "messages[].role", "z.y[][]"]
    assert got[0]["mark"] == cl.fingerprint_of({"messages[].role", "messages[].content"})
    assert got[1]["mark"] == cl.fingerprint_of({"prompt"}) and got[2]["mark"] == cl.fingerprint_of(set())


def test_own_layouts(spark):
    own = {"chat": cl.Messages("chat", "who", "says", (("A", "user"), ("B", "assistant"))), "pair": cl.Fields((("user", ("q",), False), ("assistant", ("a",), False)))}
    got = canonical(spark, {"chat": [{"who": "A", "says": "x"}, {"who": "B", "says": "y"}]}, {"q": "x", "a": "y"}, {"messages": []}, layouts=own)
    assert got == [("chat", [("user", "x"), ("assistant", "y")]), ("pair", [("user", "x"), ("assistant", "y")]), (None, None)]
    with pytest.raises(ValueError, match="same fields"):
        cl.fingerprints({"one": own["pair"], "two": own["pair"]})
    with pytest.raises(ValueError, match="mark"):
        cl.Template(end="###")


def test_round_trip(spark):
    rng = random.Random(11)
    chats = [
        [{"role": "".join(rng.choices(PIECES, k=2)) if rng.random() < 0.3 else rng.choice(["user", "assistant"]), "content": "".join(rng.choices(PIECES, k=rng.randint(0, 12)))} for _ in range(rng.randint(0, 6))]
        for _ in range(300)
    ]
    rows = spark.createDataFrame([(i, json.dumps({"messages": c})) for i, c in enumerate(chats)], "id int, body string")
    done = cl.format_chats(cl.canonical_turns(cl.json_records(rows, "id", "body"), "id"), "id")
    text = cl.formatted(F.col("segments"))
    read = done.select("id", text.alias("text"), cl.read_turns(text).alias("turns"), cl.read_learnt(F.col("segments")).alias("learnt"))
    for r in read.collect():
        chat = chats[r["id"]]
        assert [tuple(t) for t in r["turns"]] == [(m["role"], m["content"]) for m in chat]
        assert r["learnt"] == "".join(m["content"] for m in chat if m["role"] == "assistant")
        assert r["text"].count("<|") == 3 * len(chat)
        assert not any(c in r["text"] for c in ("</s>", "[INST]", "<<SYS>>"))


def test_edges(spark):
    schema = "conv_id bigint, turn bigint, role string, text string, segments string, layout int, record string, place int"
    rows = [
        (1, 2, "assistant", "B"), (1, 1, "user", "A"), (1, None, "system", None), (1, 2, "assistant", "B"),
        (None, 1, "user", "x"), (None, 0, None, "y"), (3, 1, "assistant", "long " * 200_000),
    ]
    frame = spark.createDataFrame([(*r, "s", 1, "r", 5) for r in rows], schema)
    records = cl.records_of(frame, "conv_id", ["turn", "role", "text"])
    done = cl.format_chats(cl.canonical_turns(records, "conv_id"), "conv_id")
    read = done.select("conv_id", "n_unmapped", cl.read_turns(cl.formatted(F.col("segments"))).alias("t"))
    got = {r["conv_id"]: ([tuple(t) for t in r["t"]], r["n_unmapped"]) for r in read.collect()}
    # Order by turn, nulls first; repeated rows are turns of their own.
    assert got[1] == ([("system", ""), ("user", "A"), ("assistant", "B"), ("assistant", "B")], 0)
    assert got[None] == ([("", "y"), ("user", "x")], 0)
    assert got[3][0][0][1] == "long " * 200_000
    assert cl.format_chats(cl.canonical_turns(cl.records_of(frame.limit(0), "conv_id", ["turn", "role", "text"]), "conv_id"), "conv_id").count() == 0
    # A record without a layout is counted, the others of its key are formatted.
    mixed = spark.createDataFrame([(1, '{"x": 1}'), (1, '{"prompt": "a", "completion": "b"}'), (2, "broken")], "conv_id int, body string")
    done = cl.format_chats(cl.canonical_turns(cl.json_records(mixed, "conv_id", "body"), "conv_id"), "conv_id")
    assert {r["conv_id"]: (len(r["segments"]), r["n_unmapped"]) for r in done.collect()} == {1: (6, 1), 2: (0, 1)}


def test_nested_columns(spark):
    frame = spark.sql("SELECT 5 AS id, array(named_struct('role', 'user', 'content', 'Hi')) AS messages, 'x' AS extra")
    rows = cl.canonical_turns(cl.records_of(frame, "id"), "id").collect()
    assert [(r["id"], r["layout"], [tuple(t) for t in r["turns"]]) for r in rows] == [(5, "messages", [("user", "Hi")])]


def test_query_and_oracle(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    assert difference(QUERIES[QUERY](spark, sf), oracle_connection(sf), ORACLES[QUERY]) is None
    rows = [(1, 1, "assistant", "\\ <|x|> </s> [INST] 🙂"), (1, 0, None, None), (1, None, "assistant", ""), (None, 0, "<<SYS>>", "<</SYS>>\\"), (4, 0, "user", "no answer")]
    folder = f"{tmp_path}/t"
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").coalesce(1).write.parquet(f"{folder}/conversations.parquet")
    con = oracle_connection(sf)
    con.execute(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet/*.parquet'")
    assert difference(QUERIES[QUERY](spark, folder), con, ORACLES[QUERY]) is None
    got = {r["conv_id"]: r for r in QUERIES[QUERY](spark, folder).collect()}
    text = "</s>[INST] ok [/INST]"
    assert got[-7]["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest() and got[-7]["loss_chars"] == len(text)
    assert got[-7]["turns_sha256"] == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    plan = QUERIES[QUERY](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
