"""Conversation repair: against every edit sequence, and long conversations run by run against whole ones."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from ctrprep.llm import conversations
from ctrprep.llm.conversations import damage, repair, repair_rows

LAWFUL = re.compile(r"(s?(ua)+)?\Z")


def plainly(rows):
    """The least (cost, letters, text) over all edits with few insertions, tried one by one."""
    seen, forced, cut = set(), [], []
    for role, text in rows:
        body = text.strip(" \t\n\v\f\r")
        forced.append(not body or (role, text) in seen)
        seen.add((role, text))
        cut.append(body[-1:] not in (".", "!", "?"))
    best = None
    places = range(len(rows) + 1)
    for extra in range(4):
        if best and best[0] <= 5 * extra:
            break
        for where in itertools.combinations_with_replacement(places, extra):
            for ops in itertools.product(*["D" if f else "DKua" for f in forced]):
                for added in itertools.product("ua", repeat=extra):
                    cost, word, left, k = 5 * extra, "", [], 0
                    for i in places:
                        while k < extra and where[k] == i:
                            left.append(({"u": "user", "a": "assistant"}[added[k]], ""))
                            word, k = word + "I", k + 1
                        if i == len(rows):
                            break
                        role, text = rows[i]
                        word += ops[i] if ops[i] in "DK" else "R"
                        cost += {"D": 2, "K": 0}.get(ops[i], 1) + (5 if cut[i] and ops[i] != "D" else 0)
                        if ops[i] != "D":
                            left.append((role if ops[i] == "K" else {"u": "user", "a": "assistant"}[ops[i]], text))
                    if LAWFUL.match("".join(r[:1] or "-" for r, _ in left)):
                        found = cost, word, "\n".join(f"{r}:{t}" for r, t in left)
                        best = min(best or found, found)
    return best


def test_least_edits_equal_all_edits():
    rng = random.Random(3)
    roles, texts = ["user", "assistant", "system", "tool", "", "User"], ["a.", "b!", "c", " ", "d? ", ""]
    for _ in range(250):
        rows = [(rng.choice(roles[: rng.choice([2, 3, 6])]), rng.choice(texts)) for _ in range(rng.randint(0, 4))]
        _, _, _, _, _, cost, audit, digest = repair_rows([(k, *r) for k, r in enumerate(rows)])
        want = plainly(rows)
        assert (cost, audit, digest) == (want[0], want[1], hashlib.sha256(want[2].encode()).hexdigest()), rows


def random_rows(rng, n):
    roles = ["user", "assistant", "system", "tool", None, ""]
    weights = [8, 8, 1, 1, 1, 1]
    texts = ["One.", "Two!", "Three", "", None, "\t", "Four? "]
    rows = []
    for k in range(n):
        conv = rng.choice([1, 1, 1, 2, 3, None, None])
        text = f"Line {k}." if rng.random() < 0.6 else rng.choice(texts)
        rows.append((conv, rng.choice([k, k, k // 2, None]), rng.choices(roles, weights)[0], text, rng.choice([1, 1, 1, 0, 2, 4])))
    return [*rows, (9, 5, "user", "gone", 0)]


@pytest.mark.parametrize("segment", [3, 40])
def test_long_conversations_equal_whole_ones(spark, monkeypatch, segment):
    monkeypatch.setattr(conversations, "SEGMENT", segment)
    rows = random_rows(random.Random(segment), 400)
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, n int").repartition(5)
    whole = {r["conv_id"]: r for r in repair(table, copies="n").collect()}
    for long in (0, 60):
        by_runs = {r["conv_id"]: r for r in repair(table, copies="n", long=long).collect()}
        assert by_runs == whole
    spread = {}
    for conv, turn, role, text, n in rows:
        spread.setdefault(conv, []).extend([(turn, " " if role is None else role, " " if text is None else text)] * n)
    for conv, own in spread.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        assert tuple(whole[conv])[1:] == repair_rows(own)


def test_edge_rows(spark):
    fields = "conv_id long, turn long, role string, text string, cost string, audit long"
    rows = [(1, 0, "user", "x" * 3_000_000 + "."), (1, 1, "assistant", " " * 1_000_000 + "Yes."), (2, None, None, None), (3, None, "user", "Hi.")]
    got = {r["conv_id"]: r for r in repair(spark.createDataFrame([(*r, "a", 1) for r in rows], fields)).collect()}
    assert (got[1]["audit"], got[1]["cost"], got[1]["gaps"]) == ("KK", 0, 0)
    assert (got[2]["audit"], got[2]["cost"], got[2]["blank"], got[2]["gaps"]) == ("D", 2, 1, 0)
    assert (got[3]["audit"], got[3]["cost"]) == ("D", 2)
    empty = repair(damage(spark.createDataFrame([], fields)), copies="__copies")
    assert empty.collect() == []


def test_damage_follows_the_checksum(spark):
    rows = [(c, t, "assistant", "So. It is!") for c in (1, 2, None) for t in (*range(30), None)]
    got = damage(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert len(got) == len(rows)
    for r in got:
        key = ":".join(" " if x is None else str(x) for x in (r["conv_id"], r["turn"]))
        fault = zlib.crc32(key.encode()) % 20
        want = {0: ("assistant", "So. It is!", 0), 1: ("assistant", "", 1), 2: ("assistant", "So It is", 1), 3: ("assistant", "So. It is!", 2), 4: ("user", "So. It is!", 1)}
        assert (r["role"], r["text"], r["__copies"]) == want.get(fault, ("assistant", "So. It is!", 1))


def test_all_rows_dropped(spark):
    got = repair(spark.createDataFrame([(7, 1, "user", "Hi.", 0)], "conv_id long, turn long, role string, text string, n int"), copies="n").collect()
    assert [tuple(r) for r in got] == [(7, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
