"""Conversation repair against a plain search over all edits."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from attestal.llm import turns

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def plain(rows):
    """The verdict on one conversation's (turn, role, text) rows, by trying every sequence of edits."""
    rows = sorted(
        ((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    )
    numbers = [r[0] for r in rows if r[0] is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    seen, faults = set(), []
    for _, role, text in rows:
        told = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("blank" if not told else "duplicate" if (role, text) in seen else "truncated" if told[-1] not in ".!?" else "")
        seen.add((role, text))
    illegal = sum(a[1][:1] + b[1][:1] not in {"su", "ua", "au"} for a, b in zip(rows, rows[1:], strict=False))
    # (cost, audit, lines) by row and by the initials so far, which matter only by their last one
    known = {"": (0, "", [])}

    def insert_all(places):
        for _ in range(3):
            for initials, (cost, audit, lines) in list(places.items()):
                for role in ("user", "assistant"):
                    offer(places, initials, role[0], (cost + 2, audit + "I", [*lines, f"{role}:"]))

    def offer(places, before, initial, found):
        if (before, initial) in {("", "s"), ("", "u"), ("s", "u"), ("a", "u"), ("u", "a")}:
            if initial not in places or found[:2] < places[initial][:2]:
                places[initial] = found

    for (_, role, text), fault in zip(rows, faults, strict=True):
        insert_all(known)
        late = 1 if fault == "truncated" else 0
        after = {i: (c + 3, a + "D", lines) for i, (c, a, lines) in known.items()}
        if fault not in ("blank", "duplicate"):
            for initials, (cost, audit, lines) in known.items():
                offer(after, initials, role[:1], (cost + late, audit + "K", [*lines, f"{role}:{text}"]))
                for other in ("user", "assistant"):
                    offer(after, initials, other[0], (cost + 2 + late, audit + "R", [*lines, f"{other}:{text}"]))
        known = after
    insert_all(known)
    cost, audit, lines = min(found for place, found in known.items() if place in ("", "a"))
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()), lines


def some_rows(seed, conversations=150):
    rnd = random.Random(seed)
    rows = []
    for conv in range(conversations):
        for _ in range(rnd.randrange(0, 9) if conv else 40):
            turn = rnd.choice([None, *range(12)])
            role = rnd.choice(["user", "user", "assistant", "assistant", "system", "tool", "", None, "User", "ural", "sys"])
            rows.append((conv or None, turn, role, rnd.choice(["a.", "b", " ", "", None, "Ende!\n", "é?", " ", "x" * 50, "a."])))
    return rows


def by_conversation(rows):
    groups = {}
    for conv, *row in rows:
        groups.setdefault(conv, []).append(row)
    return groups


@pytest.mark.parametrize("piece", [3, turns.PIECE])
def test_repair(spark, piece):
    rows = some_rows(5)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("Audit", F.lit("x")).withColumn("kind", F.lit(9)).repartition(3)
    found = turns.repair(df, piece=piece)
    got = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in found.collect()}
    want = {conv: plain(mine) for conv, mine in by_conversation(rows).items()}
    assert got == {conv: verdict for conv, (verdict, _) in want.items()}
    repaired = turns.repaired_turns(df, found).orderBy("conv_id", "position").collect()
    lines = {conv: [] for conv in want}
    for r in repaired:
        assert r["position"] == len(lines[r["conv_id"]])
        lines[r["conv_id"]].append(f"{r['role']}:{r['text']}")
    assert lines == {conv: told for conv, (_, told) in want.items()}


def test_small_batches(spark):
    """State is carried from batch to batch."""
    rows = some_rows(6)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        found = turns.repair(spark.createDataFrame(rows, SCHEMA)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {r["conv_id"]: r["audit"] for r in found} == {conv: plain(mine)[0][-2] for conv, mine in by_conversation(rows).items()}


def test_no_conversation_is_lost_and_none_made(spark):
    nothing = ("", hashlib.sha256(b"").hexdigest())
    df = spark.createDataFrame([(1, 0, "user", "a."), (2, 0, "user", "a.")], SCHEMA)
    found = turns.repair(df, copies=F.when(F.col("conv_id") == 1, 0).otherwise(1)).collect()
    lost = next(r for r in found if r["conv_id"] == 1)
    assert (lost["audit"], lost["repaired_sha256"]) == nothing and lost["turns"] == lost["cost"] == lost["gaps"] == 0
    assert len(found) == 2
    empty = turns.repair(df.limit(0))
    assert empty.count() == 0 and turns.repaired_turns(df.limit(0), empty).count() == 0
    text_ids = turns.repair(df.withColumn("conv_id", F.concat(F.lit("c"), "conv_id")))
    assert {r["conv_id"] for r in text_ids.collect()} == {"c1", "c2"}


def test_a_long_conversation(spark):
    """Twenty thousand turns, one of a million characters, in pieces of a thousand."""
    rows = [(7, i, ("user", "assistant")[i % 2 ^ (i % 97 == 0)], f"turn {i}" + "." * (i % 5 > 0)) for i in range(20_000)]
    rows[500] = (7, 500, "user", "long " * 200_000 + ".")
    got = turns.repair(spark.createDataFrame(rows, SCHEMA), piece=1000).first()
    assert tuple(got[c] for c in COLUMNS) == plain([r[1:] for r in rows])[0]


def test_damage(spark):
    rows = [(c if c else None, t if t else None, "assistant", "Is it? Yes!") for c in range(30) for t in range(10)] + [(5, 6, None, None)]
    got = turns.damage(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    for conv, turn, role, text, copies in got:
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        said, by = {1: "", 2: "Is it Yes"}.get(fate, "Is it? Yes!"), "user" if fate == 4 else "assistant"
        assert copies == {0: 0, 3: 2}.get(fate, 1)
        assert (role, text) == (by, said) or (conv, turn) == (5, 6)
