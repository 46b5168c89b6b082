import json
import random
from datetime import date

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from ledgerspark.operators import merge, records
from ledgerspark.schemas import TABLES
from ledgerspark.sources import tables

RECEIVED = TABLES["b3_proventos_recebidos"]
DAY = date(2024, 12, 31)


def received(table, *rows):
    return table(
        RECEIVED.name,
        *[
            {"id": i, "produto": p, "tipo_evento": "x", "valor_liquido": v, "data_pregao": d}
            for i, p, v, d in rows
        ],
    )


def test_smallest_id_stays_and_null_keys_are_equal(table):
    rows = received(table, ("b", "P", 1, DAY), ("a", "P", 2, DAY), ("c", None, 3, None), ("d", None, 4, None))
    assert rows_of(merge.keep_smallest_id(rows, RECEIVED), "id") == [("a",), ("c",)]


def test_insert_ignore_keeps_what_is_there(table):
    existing = received(table, ("z", "P", 1, DAY), ("n", None, 1, DAY))
    batch = received(table, ("a", "P", 9, DAY), ("c", "Q", 2, DAY), ("b", "Q", 3, DAY), ("m", None, 4, DAY))
    after = merge.insert_ignore(existing, batch, RECEIVED.key, [F.col("id")])
    assert rows_of(after, "id") == [("b",), ("n",), ("z",)]


def test_insert_ignore_of_a_table_into_itself(table):
    rows = received(table, ("a", "P", 1, DAY), ("b", "Q", 2, DAY))
    assert merge.new_rows(rows, rows, RECEIVED.key, [F.col("id")]).count() == 0


def test_taxpayers_do_not_share_keys(table):
    ana = received(table, ("a", "P", 1, DAY))
    bia = ana.withColumn("taxpayer_id", F.lit("bia"))
    assert merge.new_rows(bia, ana, RECEIVED.key, [F.col("id")]).count() == 1


def test_append_is_idempotent(spark, table, tmp_path):
    path = str(tmp_path / "t")
    first = received(table, ("a", "P", 1, DAY), ("b", "P", 2, DAY), ("n", None, 1, None))
    later = received(table, ("l", "P", 1, date(2025, 12, 31)))
    more = received(table, ("a", "P", 1, DAY), ("c", "R", 2, DAY), ("m", None, 3, None))
    none = first.filter("false")
    undated = first.filter("id = 'n'")
    for run, batch in enumerate((first, first, later, more, more, none, undated)):
        merge.append_new_rows(batch, path, RECEIVED, ["id"], str(run))
    stored = tables.stored_rows(spark, path, RECEIVED)
    assert rows_of(stored, "id", "ingest_run") == [("a", "0"), ("c", "3"), ("l", "2"), ("n", "0")]


def test_append_reads_only_what_the_batch_can_meet(spark, table, tmp_path):
    path = str(tmp_path / "t")
    rows = received(table, ("a", "P", 1, DAY))
    merge.append_new_rows(rows, path, RECEIVED, ["id"], "1")
    near = merge._within_reach(tables.stored_rows(spark, path, RECEIVED), rows, "data_pregao")
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(data_pregao,2024-12-31)" in plan
    assert "PartitionFilters: [isnotnull(taxpayer_bucket" in plan


def test_summary_counts_read_and_added_rows(spark, frame, tmp_path):
    read = frame([("t",), ("t",), ("u",)], "table_name string")
    added = frame([("t",)], "table_name string")
    summary = merge.import_summary(read, added)
    assert rows_of(summary) == [("t", 2, 1, "ok"), ("u", 1, 0, "ok")]
    merge.write_summary(summary, str(tmp_path / "s"))
    lines = [json.loads(line) for f in (tmp_path / "s").glob("*.json") for line in f.read_text().splitlines()]
    assert {"table_name": "t", "rows_processed": 2, "rows_inserted": 1, "status": "ok"} in lines


def test_record_changes(frame):
    old = frame([("1", '{"k":1}'), ("2", None)], "id string, data string")
    changes = frame(
        [
            ("update", "1", '{"k":2}', 1),
            ("update", "1", '{"k":3}', 2),
            ("update", "9", '{"k":9}', 3),
            ("add", "5", '{"k":5}', 4),
            ("update", "5", '{"k":6}', 5),
            ("add", None, '{"k":7}', 6),
            ("update", None, '{"k":8}', 7),
            ("add", None, '{"k":7}', 8),
            ("add", None, None, 9),
            ("update", "7", '{"k":1}', 10),
            ("add", "7", '{"k":70}', 11),
        ],
        "op string, id string, data string, seq long",
    )
    after = {r.id: r.data for r in records.upsert(old, changes, "b").collect()}
    made = sorted(str(after.pop(i)) for i in list(after) if len(i) == 64)
    assert made == ["None", '{"k":7}', '{"k":7}']
    assert after == {"1": '{"k":3}', "2": None, "5": '{"k":6}', "7": '{"k":70}'}
    hits = {r.seq: r.hit for r in records.upsert_results(old, changes, "b").collect()}
    assert hits == {1: True, 2: True, 3: False, 4: True, 5: True, 6: True, 8: True, 9: True, 10: False, 11: True}


def test_record_times(frame):
    from datetime import datetime

    then, now = datetime(2020, 1, 1), datetime(2024, 1, 1)
    schema = "id string, data string, created_at timestamp_ntz, updated_at timestamp_ntz"
    old = frame([("1", "a", then, then), ("2", "b", then, then)], schema)
    changes = frame([("update", "1", "c", 1), ("add", "3", "d", 2)], "op string, id string, data string, seq long")
    after = records.upsert(old, changes, "b", F.lit(now).cast("timestamp_ntz"))
    assert rows_of(after) == [("1", "c", then, now), ("2", "b", then, then), ("3", "d", now, now)]


def test_record_lookup_delete_and_decode(frame):
    old = frame([("1", '{"k":1}'), ("2", None)], "id string, data string")
    ids = frame([("2",), ("2",), ("3",)], "id string")
    assert rows_of(records.lookup(old, ids)) == [("2", '{"id":"2"}', True), ("3", None, False)]
    assert rows_of(records.delete(old, ids), "id") == [("1",)]
    assert rows_of(records.deletion_results(old, ids)) == [("2", True), ("3", False)]
    shown = records.decode(old, "k int").withColumn("others", F.to_json("others"))
    assert rows_of(shown) == [("1", 1, "{}"), ("2", None, '{"id":"2"}')]


def test_records_of_any_shape_lose_nothing(frame):
    payloads = ['{"k": 1, "z": {"b": [1, null], "a": "x"}, "K": 2}', '{"k": "text"}', '{"k": null}', "[1, {}]", "7", "{}", None, '{"a.b": 1, "k": 3}', '{"k": 1.5, "z": {"a": "y"}}']
    old = frame([(str(i), p) for i, p in enumerate(payloads)], "id string, data string")
    decoded = records.decode(old, "k int, z struct<a string>").withColumn("others", F.to_json("others"))
    assert rows_of(decoded) == [
        ("0", 1, ("x",), '{"K":2,"z":{"a":"x","b":[1,null]}}'),
        ("1", None, None, '{"k":"text"}'),
        ("2", None, None, "{}"),
        ("3", None, None, "[1,{}]"),
        ("4", None, None, "7"),
        ("5", None, None, "{}"),
        ("6", None, None, '{"id":"6"}'),
        ("7", 3, None, '{"a.b":1}'),
        ("8", 1, ("y",), '{"k":1.5}'),
    ]
    whole = records.decode(old).withColumn("others", F.to_json("others"))
    assert rows_of(whole)[0] == ("0", '{"K":2,"k":1,"z":{"a":"x","b":[1,null]}}')
    fields = rows_of(records.field_values(old).filter("id in ('0', '3', '6')"))
    assert sorted(fields, key=str) == sorted(
        [("0", "K", "BIGINT", "2"), ("0", "k", "BIGINT", "1"), ("0", "z", "OBJECT", '{"a":"x","b":[1,null]}'), ("3", None, "ARRAY", "[1,{}]"), ("6", "id", "STRING", '"6"')],
        key=str,
    )
    with pytest.raises(ValueError, match="others"):
        records.decode(old, "others int")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        records.decode(frame([("1", "{broken")], "id string, data string")).collect()


def test_random_merges_against_brute_force(spark, frame):
    """Insert-or-ignore and record changes on random rows with many repeats and null key parts."""
    import random

    rng = random.Random(7)

    def some(n, first_id):
        return [
            (rng.choice(["t", "u", None]), rng.choice(["a", "b", "c", None]), rng.randrange(5), first_id + i)
            for i in range(n)
        ]

    schema = "taxpayer_id string, k string, n int, id int"
    old = list({r[:3]: r for r in reversed(some(30, 0))}.values())
    batch = some(200, 100)
    expected = {r[:3]: r for r in reversed(batch)} | {r[:3]: r for r in old}
    merged = merge.insert_ignore(frame(old, schema), frame(batch, schema), ["taxpayer_id", "k", "n"], ["id"])
    assert rows_of(merged) == sorted(expected.values(), key=repr)

    stored = {str(i): f"old{i}" for i in range(0, 40, 2)}
    changes = [
        (rng.choice(["add", "update"]), str(rng.randrange(60)), f"new{i}", i) for i in range(150)
    ]
    state = dict(stored)
    for op, key, data, _ in changes:
        if op == "add" or key in state:
            state[key] = data
    rng.shuffle(changes)
    after = records.upsert(
        frame(list(stored.items()), "id string, data string"),
        frame(changes, "op string, id string, data string, seq long"),
        "b",
    )
    assert rows_of(after) == sorted(state.items(), key=repr)


def test_stored_side_of_a_merge_is_not_shuffled_for_a_small_batch(spark, table, tmp_path):
    tables.write_table(received(table, ("a", "P", 1, DAY)), str(tmp_path / "t"), RECEIVED)
    received(table, ("a", "P", 1, DAY), ("b", "Q", 1, DAY)).write.parquet(str(tmp_path / "batch"))
    stored, batch = tables.stored_rows(spark, str(tmp_path / "t"), RECEIVED), spark.read.parquet(str(tmp_path / "batch"))
    rows = merge.new_rows(batch, stored, RECEIVED.key, ["id"])
    assert rows_of(rows, "id") == [("b",)]
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("Initial Plan")]
    assert final.count("BroadcastHashJoin") == 2 and "hashpartitioning(_seen_" not in final


def test_large_batch_is_decided_without_joins(spark, table, tmp_path, monkeypatch):
    rng = random.Random(6)
    keys = [(i, rng.choice(["P", "Q", None]), n, rng.choice([DAY, None])) for n, i in enumerate("abcdefghijklmnop" * 3)]
    old, new = received(table, *keys[:16]), received(table, *keys[8:])
    order = ["id", "valor_liquido"]
    few, many = (f(new, old, RECEIVED.key, order) for f in (merge.new_rows, merge.new_rows_of_many))
    assert rows_of(many) == rows_of(few)
    assert many.columns == new.columns
    assert "Join" not in many._jdf.queryExecution().executedPlan().toString()
    path, calls = str(tmp_path / "t"), []
    monkeypatch.setattr(merge, "SMALL_BATCH", 0)
    known = merge.new_rows_of_many
    monkeypatch.setattr(merge, "new_rows_of_many", lambda *a: calls.append(1) or known(*a))
    expected = merge.append_new_rows(old, path, RECEIVED, order, "one")
    assert expected == old.select(*RECEIVED.key).distinct().count()
    assert merge.append_new_rows(old, path, RECEIVED, order, "two") == 0
    assert merge.append_new_rows(new, path, RECEIVED, order, "three") == few.count()
    assert calls == [1, 1]
