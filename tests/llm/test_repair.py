"""Conversation repair against a plain dynamic programme and a row-by-row version."""
import hashlib
import random
import re
import zlib

import pytest

from lodestone.llm.queries import op13_auction_structure_repair
from lodestone.llm.repair import damage, repair_conversations, repair_of

SPACE = " \t\n\x0b\x0c\r"
STEP = {("0", "s"): "1", ("0", "u"): "2", ("1", "u"): "2", ("2", "a"): "3", ("3", "u"): "2"}
MADE = {"0": "u", "1": "u", "2": "a", "3": "u"}
NAME = {"u": "user", "a": "assistant"}


def brute_repair(rows):
    """rows: (role, text, fault) -> (cost, audit, repaired rows): least (cost, audit) by layers."""
    def with_inserts(layer):
        for _ in range(2):
            for s, (c, a, out) in list(layer.items()):
                r = MADE[s]
                new = (c + 2, a + "I", out + [(NAME[r], "")])
                t = STEP[s, r]
                if t not in layer or new[:2] < layer[t][:2]:
                    layer[t] = new
        return layer

    layer = with_inserts({"0": (0, "", [])})
    for role, text, fault in rows:
        nxt = {}
        for s, (c, a, out) in layer.items():
            ways = [(s, c + 3, "D", out)]
            if fault not in ("blank", "duplicate"):
                e = 1 if fault == "truncated" else 0
                if (s, role[:1]) in STEP:
                    ways.append((STEP[s, role[:1]], c + e, "K", out + [(role, text)]))
                r = MADE[s]
                ways.append((STEP[s, r], c + 2 + e, "R", out + [(NAME[r], text)]))
            for t, cost, letter, o in ways:
                if t not in nxt or (cost, a + letter) < nxt[t][:2]:
                    nxt[t] = (cost, a + letter, o)
        layer = with_inserts(nxt)
    return min((layer[s] for s in "03" if s in layer), key=lambda x: x[:2])


def brute(rows):
    """All of a conversation's row, from its damaged rows (turn, role, text)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.strip(SPACE)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else
                      "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for _, r, _ in rows]
    cost, audit, out = brute_repair([(r, x, f) for (_, r, x), f in zip(rows, faults)])
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{x}" for r, x in out).encode()).hexdigest())


def brute_damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        if conv is None:
            continue
        kept = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        what = zlib.crc32(f"{conv}:{' ' if turn is None else turn}".encode()) % 20
        if what == 0:
            continue
        text = "" if what == 1 else re.sub("[.!?]", "", text) if what == 2 else text
        kept += [(turn, "user" if what == 4 else role, text)] * (2 if what == 3 else 1)
    return {c: brute(r) for c, r in out.items()}


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_auction_equals_dynamic_programme():
    rng = random.Random(1)
    names = {0: "tool", 1: "system", 2: "user", 3: "assistant"}
    faults = ["", "blank", "duplicate", "truncated"]
    for n in [*range(9)] * 150 + [63, 64, 65, 200, 700]:
        codes = bytes(rng.choice((0, 1, 2, 2, 3, 3)) + 4 * rng.choice((0, 0, 0, 1, 2, 3)) for _ in range(n))
        cost, audit, turns = repair_of(codes)
        rows = [(names[c & 3], f"t{i}", faults[c >> 2]) for i, c in enumerate(codes)]
        want = brute_repair(rows)
        made = [(role or rows[pos][0], "" if pos is None else rows[pos][1]) for pos, role in turns]
        assert (cost, audit, made) == want, codes


def test_long_conversations_stay_linear():
    rng = random.Random(2)
    codes = bytes(rng.choice((1, 2, 3)) + 4 * rng.choice((0, 1, 2, 3)) for _ in range(50_000))
    cost, audit, _ = repair_of(codes)
    assert sum(a != "I" for a in audit) == 50_000 and cost > 0


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_brute_force(spark, sf):
    got = op13_auction_structure_repair(spark, f"/root/testdata/{sf}").collect()
    rows = spark.read.parquet(f"/root/testdata/{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    want = brute_damage(map(tuple, rows))
    assert len(got) == len(want) and {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in got} == want


def test_odd_rows(spark):
    texts = [None, "", "  \n", "Fine.", "Cut off", "Fine. \t", "é!", "Ok?", "x" * 100_000 + "."]
    roles = [None, "", "user", "assistant", "system", "tool", "User", "s"]
    rng = random.Random(4)
    rows = [(c, rng.choice([None, *range(12)]), rng.choice(roles), rng.choice(texts)) for c in range(120) for _ in range(rng.randint(1, 14))]
    rows += [(None, 1, "user", "nowhere."), (500, None, "user", "a."), (500, None, "user", "a."), (-7, 3, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr(
        "*", "1 as pos", "'x' as fault", "2 as seq", "3 as codes", "'y' as line", "4 as _what", "5 as cost")
    report, turns = repair_conversations(damage(df))
    want = {c: r for c, r in brute_damage(rows).items()}
    got = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in report.collect()}
    dropped = set(want) - set(got)
    assert got == {c: want[c] for c in got}
    assert all(want[c] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c in dropped)
    assert turns.where("role is null or text is null").count() == 0
    report, turns = repair_conversations(df.limit(0))
    assert report.count() == 0 and turns.count() == 0


def test_conversation_without_rows_after_damage(spark, tmp_path):
    gone = next(t for t in range(1000) if zlib.crc32(f"9:{t}".encode()) % 20 == 0)
    spark.createDataFrame([(9, gone, "user", "a."), (8, 1, "user", "b.")], "conv_id long, turn long, role string, text string") \
        .write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in op13_auction_structure_repair(spark, str(tmp_path)).collect()}
    assert got[9] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) and len(got) == 2
