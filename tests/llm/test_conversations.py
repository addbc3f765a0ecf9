import hashlib
import random
import re

import duckdb
import pytest
from hypothesis import given, settings, strategies as st

from duoscope.llm import conversations as C
from duoscope.llm.queries import OP13_SQL, op13_conversation_repair


def search(letters):
    """Dynamic programme over whole audits: (cost, audit), least cost and then least by ASCII."""
    def insert(best):
        for _ in range(4):
            for state, (cost, audit) in list(best.items()):
                new = {"": "u", "s": "u", "u": "a", "a": "u"}[state]
                best[new] = min(best.get(new, (10**9, "")), (cost + 3, audit + "I"))
        return best

    best = {"": (0, "")}
    for letter in letters:
        after = {}

        def put(state, found):
            after[state] = min(after.get(state, (10**9, "")), found)

        for state, (cost, audit) in insert(best).items():
            put(state, (cost + 4, audit + "D"))
            if letter != "D":
                stay = cost + 3 * letter.isupper()
                if letter.lower() in {"": "su", "s": "u", "u": "a", "a": "u"}[state]:
                    put(letter.lower(), (stay, audit + "K"))
                put("a" if state == "u" else "u", (stay + 3, audit + "R"))
        best = after
    ends = [insert(best)[s] for s in ("", "a") if s in best]
    return min(ends)


def hirschberg(letters):
    cost, end = C.finish(C.summary(letters))
    return cost, C.audit_between(letters, C.START, end) + "I" * C._TAIL[end]


@settings(max_examples=400, deadline=None)
@given(st.text("suaxSUAXD", max_size=24))
def test_division_finds_the_least_of_the_cheapest(letters):
    assert hirschberg(letters) == search(letters) if letters else True


@settings(max_examples=200, deadline=None)
@given(st.text("suaxSUAXD", min_size=1, max_size=40), st.lists(st.integers(0, 40), max_size=6))
def test_summaries_of_stretches_compose(letters, cuts):
    edges = sorted({0, len(letters), *[c for c in cuts if c < len(letters)]})
    stretches = [letters[a:b] for a, b in zip(edges, edges[1:])]
    whole = [C.summary(s) for s in stretches]
    cost, end = C.finish(C.compose(whole))
    assert C.compose(whole) == C.summary(letters)
    assert [C._summary(C._flat(s)) for s in whole] == whole
    states = [C.START, *C.crossings(whole, C.START, end)]
    audit = "".join(C.audit_between(s, a, b) for s, a, b in zip(stretches, states, states[1:]))
    assert (cost, audit + "I" * C._TAIL[end]) == search(letters)


def test_very_long_sequence():
    rng = random.Random(3)
    letters = "".join(rng.choice("suaxSUAXD" + "ua" * 8) for _ in range(30_000))
    cost, audit = hirschberg(letters)
    assert (cost, audit) == search(letters)


def brute(rows):
    """rows after damage, in order: the report of one conversation."""
    seen, letters, counts = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        visible = re.sub(r"[\x20\x09-\x0D]", "", text)
        kind = "blank" if not visible else "duplicate" if (role, text) in seen else \
            "truncated" if visible[-1] not in ".!?" else None
        seen.add((role, text))
        if kind:
            counts[kind] += 1
        letter = role[:1] if role[:1] in ("s", "u", "a") else "x"
        letters += "D" if kind in ("blank", "duplicate") else letter.upper() if kind else letter
    cost, audit = search(letters) if letters else (0, "")
    out, i = [], 0
    for edit in audit:
        after = out[-1][0] if out else ""
        if edit == "K":
            out.append((rows[i][1][0], f"{rows[i][1]}:{rows[i][2]}"))
        elif edit in "RI":
            new = "a" if after == "u" else "u"
            out.append((new, {"a": "assistant", "u": "user"}[new] + ":" + (rows[i][2] if edit == "R" else "")))
        i += edit != "I"
    roles = "".join(r for r, _ in out)
    assert re.fullmatch("(s?(ua)+)?", roles)
    turns = [t for t, _, _ in rows if t is not None]
    bad = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return {"gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, **counts, "illegal": bad,
            "cost": cost, "audit": audit,
            "repaired_sha256": hashlib.sha256("\n".join(x for _, x in out).encode()).hexdigest()}


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))


SCHEMA = "conv_id long, turn long, role string, text string, conv int, block string, letters string"


def test_blocks_and_partitions_change_nothing(spark):
    rng = random.Random(11)
    rows = []
    for conv in [*range(25), None]:
        for turn in range(rng.choice([0, 1, 2, 5, 9, 30])):
            rows.append((conv, rng.choice([turn, turn, turn, None, 3]),
                         rng.choice(["user", "assistant", "assistant", "system", "tool", "", "User"]),
                         rng.choice(["Yes.", "No?", "", " \t", f"text {turn}.", f"cut {turn}", "é!", "x" * 5])))
    for turn in range(1500):   # one conversation with most of the rows, one text with a third of it
        rows.append((99, turn, rng.choice(["user", "assistant"]), "Same." if turn % 3 else f"row {turn}."))
    rows.append((98, 0, "user", "long " * 300_000))
    rows += [(97, 1, "user", "Equal.")] * 6
    groups = {}
    for conv, *row in rows:
        groups.setdefault(conv, []).append(tuple(row))
    expected = {conv: brute(ordered(g)) for conv, g in groups.items()}
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA).repartition(7)
    for block in (1, 7, C.BLOCK):
        got = {r.conv: {k: r[k] for k in r.asDict() if k != "conv"} for r in C.digests(
            df.select(df.conv_id.alias("conv"), "turn", "role", "text"), block).collect()}
        assert got == expected
    fixed = {}
    for r in sorted(C.repair(df.select(df.conv_id.alias("conv"), "turn", "role", "text"), 7).collect(),
                    key=lambda r: (r.block, r.i)):
        fixed.setdefault(r.conv, []).append(f"{r.role}:{r.text}")
    for conv, x in expected.items():
        assert hashlib.sha256("\n".join(fixed.get(conv, [])).encode()).hexdigest() == x["repaired_sha256"]


def test_damage_and_report_equal_sql(spark, tmp_path):
    rng = random.Random(2)
    rows = [(conv, turn, rng.choice(["user", "assistant", "system", None, "tool"]),
             rng.choice(["Hello there. And more!", "no end", None, "", "A? B", "A? B", "é."]), 1, "x", "y")
            for conv in [*range(150), None] for turn in [None, *range(rng.randrange(6))]]
    rows.append((1000, 7, "user", "gone or kept.", 1, "x", "y"))
    df = spark.createDataFrame(rows, SCHEMA)
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    names = ["conv_id", *C._REPORT, "audit", "repaired_sha256"]
    sql = con.sql(f"SELECT {', '.join(names)} FROM ({OP13_SQL})").fetchall()
    got = op13_conversation_repair(spark, str(tmp_path))
    assert got.columns == names
    key = lambda r: (r[0] is not None, r[0] or 0)
    assert sorted([tuple(r) for r in got.collect()], key=key) == sorted(sql, key=key)


def test_empty_table_and_dropped_conversations(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert C.report(df, C.damaged(df)).count() == 0
    df = spark.createDataFrame([(5, 1, "user", "Hi.", 1, "x", "y")], SCHEMA)
    (row,) = C.report(df, C.damaged(df).where("false")).collect()
    assert tuple(row) == (5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


@pytest.mark.parametrize("letters, audit", [("ua", "KK"), ("a", "IK"), ("u", "KI"), ("s", "D"), ("sD", "DD"), ("xU", "DD"),
                                            ("D", "D")])
def test_small_cases(letters, audit):
    assert hirschberg(letters) == search(letters) and hirschberg(letters)[1] == audit
