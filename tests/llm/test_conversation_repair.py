"""Conversation repair against a search over all edits."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from functools import cache

import pytest

from catalogflow.llm import conversation_repair as repair

ROLE = {"u": "user", "a": "assistant"}


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        space = lambda v: " " if v is None else v
        how = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        role, text = space(role), space(text)
        if how == 0:
            continue
        text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
        out += [(conv, turn, "user" if how == 4 else role, text)] * (2 if how == 3 else 1)
    return out


def cheapest(rows):
    """All of a conversation's figures, by a search over every edit sequence."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    faults, seen = [], set()
    for _, _, role, text in rows:
        last = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[-1] not in ".!?" else None)
        seen.add((role, text))
    following = {"": "su", "s": "u", "u": "a", "a": "u"}

    @cache
    def best(i, state, inserts):
        options = [(0, "")] if i == len(rows) and state in ("", "a") else []
        if inserts < 4:
            fits = "a" if state == "u" else "u"
            c, e = best(i, fits, inserts + 1)
            options.append((c + 3, "I" + e))
        if i < len(rows):
            c, e = best(i + 1, state, 0)
            options.append((c + 4, "D" + e))
            if faults[i] not in ("blank", "duplicate"):
                more, initial = 3 if faults[i] else 0, rows[i][2][:1]
                if initial and initial in following[state]:
                    c, e = best(i + 1, initial, 0)
                    options.append((c + more, "K" + e))
                fits = "a" if state == "u" else "u"
                c, e = best(i + 1, fits, 0)
                options.append((c + 3 + more, "R" + e))
        return min(options, default=(10**9, ""))

    cost, audit = best(0, "", 0)
    lines, state, rest = [], "", iter(rows)
    for edit in audit:
        fits = "a" if state == "u" else "u"
        row = None if edit == "I" else next(rest)
        if edit == "I":
            lines.append(ROLE[fits] + ":")
        elif edit == "K":
            fits = row[2][0]
            lines.append(f"{row[2]}:{row[3]}")
        elif edit == "R":
            lines.append(f"{ROLE[fits]}:{row[3]}")
        state = state if edit == "D" else fits
    turns = {r[1] for r in rows if r[1] is not None}
    initials = [r[2][:1] for r in rows]
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def conversations(seed: int, most: int):
    rng, rows = random.Random(seed), []
    for conv in [*range(60), None]:
        turns = [rng.choice((None, k, k, k, k + 5)) for k in range(rng.randrange(1, most))]
        for turn in turns:
            role = rng.choice(("user", "assistant", "user", "assistant", "system", "tool", "", None, "User"))
            text = rng.choice(("Yes.", "No", "é!", " ", None, "Well? \n", "x\n", "a" * 300 + ".", f"{rng.random()}.", f"{rng.random()}"))
            rows.append((conv, turn, role, text))
    return rows


@pytest.mark.parametrize("segment,fan,most", [(64, 64, 9), (1, 2, 9), (3, 2, 30), (4, 3, 14)])
def test_against_search(spark, tmp_path, monkeypatch, segment, fan, most):
    rows = conversations(segment, most)
    kept = damage(rows)
    want = {conv: cheapest([r for r in kept if r[0] == conv]) for conv in {r[0] for r in rows}}
    spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, audit string").repartition(4).write.parquet(f"{tmp_path}/conversations.parquet")
    whole = repair.repaired
    monkeypatch.setattr(repair, "repaired", lambda frame: whole(frame, segment, fan))
    got = repair.op13_conversation_repair(spark, str(tmp_path)).collect()
    assert {r.conv_id: tuple(r[c] for c in COLUMNS) for r in got} == want and len(got) == len(want)


def test_nothing_left_and_empty_table(spark, tmp_path):
    gone = [k for k in range(2000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0][:3]
    spark.createDataFrame([(k, 0, "user", "Hi.") for k in gone], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/a/conversations.parquet")
    got = repair.op13_conversation_repair(spark, f"{tmp_path}/a").collect()
    assert [tuple(r[c] for c in COLUMNS) for r in got] == [(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())] * 3
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/b/conversations.parquet")
    assert repair.op13_conversation_repair(spark, f"{tmp_path}/b").count() == 0


def test_long_conversation_with_a_run_of_copies(spark):
    """One conversation over several ranges and segments; a text repeated 5,000 times is one symbol with a count."""
    rows = [(1, k, "user" if k % 2 else "assistant", f"Line {k}.", 1) for k in range(1000)] + [(1, 500, "assistant", "Again.", 5000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, copies long")
    pieces, found = repair.repaired(frame.repartition(8), 16, 4)
    r = found.first()
    assert pieces.count() > 60 and r.duplicate == 4999
    assert r.cost == 4 * r.audit.count("D") + 3 * (r.audit.count("I") + r.audit.count("R")) and r.audit.count("D") >= 4999
    assert len(r.audit.replace("I", "")) == 6000
    lines = [t for (t,) in pieces.orderBy("part", "seg").select("repaired").collect() if t is not None]
    assert hashlib.sha256("\n".join(lines).encode()).hexdigest() == r.repaired_sha256


def test_suffixes_are_computed_once():
    """A signature that ends as the one before shares its nodes."""
    import pyarrow as pa

    made = []
    real = repair.before
    repair.before = lambda symbol, rest: made.append(symbol) or real(symbol, rest)
    try:
        signatures = sorted((x + "uaua" for x in ("a", "s", "u", "ua", "xu", "au")), key=lambda s: s[::-1])
        batch = pa.RecordBatch.from_arrays([pa.array([0] * 6, pa.int32()), pa.array(signatures)], ["kind", "signature"])
        rows = [r for b in repair.walk([batch]) for r in b.to_pylist()]
    finally:
        repair.before = real
    assert len(rows) == 6 and len(made) == 4 + 3 + 3
    assert all(r["costs"][0] >= 0 for r in rows)
