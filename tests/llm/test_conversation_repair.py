"""Operator 13: the streamed repair against a recursion over whole conversations, spills, edge cases."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache
from itertools import product

import pyarrow as pa
import pytest

from ledgerspark.llm import conversation_repair as cr
from ledgerspark.llm.queries import QUERIES

BLANK = "\x20\x09\x0a\x0b\x0c\x0d"
FIELDS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
SCHEMA = "conv_id bigint, turn bigint, role string, text string, kind string, conv string, seen int"


def faults(rows):
    seen = set()
    for role, text in rows:
        kept = text.rstrip(BLANK)
        yield "blank" if not kept else "duplicate" if (role, text) in seen else "truncated" if kept[-1] not in ".!?" else None
        seen.add((role, text))


def cheapest(rows, marks):
    """(cost, audit, repaired turns) by recursion from the end; states are what the roles so far end in."""
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    names = {"u": "user", "a": "assistant"}

    @lru_cache(maxsize=None)
    def best(i, state, inserted=0):
        ways = [(10**9, "", ())]
        if inserted < 3:
            for letter in "ua":
                if (state, letter) in after:
                    cost, audit, rest = best(i, letter, inserted + 1)
                    ways.append((cost + 3, "I" + audit, (names[letter] + ":", *rest)))
        if i == len(rows):
            if state in ("", "a"):
                ways.append((0, "", ()))
            return min(ways)
        role, text = rows[i]
        cost, audit, rest = best(i + 1, state)
        ways.append((cost + 4, "D" + audit, rest))
        if marks[i] not in ("blank", "duplicate"):
            extra = 3 * (marks[i] == "truncated")
            if (state, role[:1]) in after:
                cost, audit, rest = best(i + 1, role[:1])
                ways.append((cost + extra, "K" + audit, (f"{role}:{text}", *rest)))
            for letter in "ua":
                if (state, letter) in after:
                    cost, audit, rest = best(i + 1, letter)
                    ways.append((cost + extra + 3, "R" + audit, (f"{names[letter]}:{text}", *rest)))
        return min(ways)

    return best(0, "")


def wanted(turns):
    """The report of turns in order: (turn, role, text)."""
    rows = [(" " if r is None else r, " " if t is None else t) for _, r, t in turns]
    marks = list(faults(rows))
    cost, audit, repaired = cheapest(rows, marks)
    numbers = [n for n, _, _ in turns if n is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    pairs = [(a[0][:1] + b[0][:1]) for a, b in zip(rows, rows[1:])]
    illegal = sum(p not in ("su", "ua", "au") for p in pairs)
    digest = hashlib.sha256("\n".join(repaired).encode()).hexdigest()
    return gaps, *[marks.count(m) for m in cr.FAULTS[1:]], illegal, cost, audit, digest


def order(turns):
    return sorted(turns, key=lambda t: (t[0] is not None, t[0], t[1] is not None, t[1] or "", t[2] is not None, t[2] or ""))


@pytest.fixture(scope="module")
def frame(spark):
    def make(conversations):
        rows = [(c, *t, None, None, None) for c, turns in conversations.items() for t in turns]
        random.Random(1).shuffle(rows)
        return spark.createDataFrame(rows, SCHEMA)

    return make


def reported(df):
    return {r["conv_id"]: tuple(r[c] for c in FIELDS) for r in cr.repair_report(df).collect()}


def test_like_recursion(frame):
    rng = random.Random(3)
    conversations = {}
    for c in range(400):
        turns = []
        for n in range(rng.randint(1, 9)):
            text = rng.choice(["", " \n\t", "Yes.", "No", f"Text {n}.", f"Cut {n}", "Hm? \n"])
            turns.append((rng.choice([n, n, n + 1, None]), rng.choice(["user", "assistant", "system", "user", "tool", " "]), text))
        conversations[c] = turns
    got = reported(frame(conversations))
    assert got == {c: wanted(order(turns)) for c, turns in conversations.items()}


def test_all_short_role_sequences(frame):
    roles = ("system", "user", "assistant", "other")
    conversations = {}
    for length in range(1, 5):
        for names in product(roles, repeat=length):
            conversations[len(conversations)] = [(i, r, f"text {i}" + "." * (i % 3 != 1)) for i, r in enumerate(names)]
    got = reported(frame(conversations))
    for c, turns in conversations.items():
        assert got[c] == wanted(turns), turns
        assert re.fullmatch("[KRDI]*", got[c][6])


def test_turns_agree_with_report(frame):
    conversations = {
        0: [(0, "assistant", "Hello."), (1, "user", "Hi."), (1, "user", "Hi."), (2, "user", ""), (5, "assistant", "cut")],
        1: [(0, "system", "Be kind."), (1, "user", "Why?"), (2, "assistant", "So.")],
        2: [(0, "user", "  ")],
    }
    rows = defaultdict(list)
    for r in cr.repaired_turns(frame(conversations)).collect():
        rows[r["conv_id"]].append(r)
    report = reported(frame(conversations))
    for c, edits in rows.items():
        assert "".join(r["edit"] for r in edits) == report[c][6]
        kept = [r for r in edits if r["position"] is not None]
        assert [r["position"] for r in kept] == list(range(len(kept)))
        assert hashlib.sha256("\n".join(f"{r['role']}:{r['text']}" for r in kept).encode()).hexdigest() == report[c][7]
        assert re.fullmatch("(s?(ua)+)?", "".join(r["role"][0] for r in kept))
    assert [r["fault"] for r in rows[0]] and [r["edit"] for r in rows[1]] == ["K"] * 3
    assert [(r["edit"], r["fault"], r["position"]) for r in rows[2]] == [("D", "blank", None)]


def test_spills_and_batches_change_nothing(monkeypatch):
    rng = random.Random(5)
    schema = pa.schema([("conv", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("kind", pa.int32())])
    rows = []
    for conv, size in ((1, 3), (2, 300_000), (3, 1), (4, 70_000)):
        for n in range(size):
            initial, fault = rng.randint(0, 3), rng.choice([0, 0, 0, 1, 3])
            rows.append((conv, n, ("x", "system", "user", "assistant")[initial], f"t{n}", 4 * initial + fault))
    whole = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
    out = pa.schema([("conv_id", pa.int64())] + [(n, pa.int64()) for n in FIELDS[:6]] + [(n, pa.string()) for n in FIELDS[6:]])
    report = lambda batches: pa.Table.from_batches(cr._report_rows(batches, out)).to_pylist()
    plain = report(iter([whole]))
    # 300 000 steps are several of the blocks in which spilled steps are read backwards.
    monkeypatch.setattr(cr, "SPILL_BYTES", 1 << 16)
    assert report(whole.slice(at, 1009) for at in range(0, whole.num_rows, 1009)) == plain
    assert [len(r["audit"].replace("I", "")) for r in plain] == [3, 300_000, 1, 70_000]


def test_edges(frame, spark):
    conversations = {
        None: [(0, "user", "A."), (1, "assistant", "B.")],
        1: [(None, None, None), (None, "user", "Q."), (3, "assistant", None)],
        2: [(7, "user", "x. " * 100_000), (9, "assistant", "Long")],
    }
    got = reported(frame(conversations))
    assert got == {c: wanted(order(t)) for c, t in conversations.items()}
    assert got[2][0] == 1
    empty = spark.createDataFrame([], SCHEMA)
    assert cr.repair_report(empty).count() == 0 and cr.repaired_turns(empty).count() == 0
    text_key = spark.createDataFrame([("a", 1, "user", "Q."), ("a", 2, "assistant", "A.")], "conv_id string, turn int, role string, text string")
    assert [(r["conv_id"], r["audit"]) for r in cr.repair_report(text_key).collect()] == [("a", "KK")]


def test_steps_fit_two_bytes():
    known = cr.steps()
    assert len(known.next) < 1 << 16
    assert all(0 <= cost for cost in known.cost)


def brute_damage(rows):
    spaced = lambda v: " " if v is None else str(v)
    for conv, turn, role, text in rows:
        lot = zlib.crc32(f"{spaced(conv)}:{spaced(turn)}".encode()) % 20
        role, text = spaced(role), spaced(text)
        if lot == 0:
            continue
        text = "" if lot == 1 else re.sub("[.!?]", "", text) if lot == 2 else text
        one = (turn, "user" if lot == 4 else role, text)
        yield from [(conv, one)] * (2 if lot == 3 else 1)


def test_query(spark, tmp_path):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    # Nulls, and conversations of which nothing is left.
    lost = [c for c in range(10_000, 11_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:3]
    rows += [(c, 0, "user", "Gone.") for c in lost] + [(None, None, None, None), (None, 4, "user", "Q."), (20_000, None, "user", "A.")]
    schema = "conv_id bigint, turn bigint, role string, text string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r["conv_id"]: tuple(r[c] for c in FIELDS) for r in QUERIES["op13_conversation_repair"](spark, str(tmp_path)).collect()}
    turns = defaultdict(list)
    for conv, one in brute_damage(rows):
        turns[conv].append(one)
    assert got == {c: wanted(order(turns.get(c, []))) for c in {r[0] for r in rows}}
    assert all(got[c] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()) for c in lost)
