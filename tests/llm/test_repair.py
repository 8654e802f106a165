"""Conversation repair against an exhaustive search, in one piece and in many."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from quarry.llm import queries, repair

BLANKS = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def damaged(rows):
    """The contract's damage, row by row; every conversation stays as a key."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        space = lambda v: " " if v is None else str(v)
        hit = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        text, role = space(text), space(role)
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        out[conv] += [(turn, "user" if hit == 4 else role, text)] * {0: 0, 3: 2}.get(hit, 1)
    return out


def faults(rows):
    seen, found = set(), []
    for _, role, text in rows:
        body = text.strip(BLANKS)
        found.append("blank" if not body else "duplicate" if (role, text) in seen
                     else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return found


def search(rows):
    """Least (cost, audit) and its turns, over all edits that can still fit the pattern."""
    kinds = faults(rows)
    best = [(10**9, "", None)]

    def go(i, inserted, cost, audit, initials, turns):
        if cost > best[0][0] or not re.fullmatch("s?(ua)*u?", initials):
            return
        if inserted < 2:
            for role in ("user", "assistant"):
                go(i, inserted + 1, cost + 3, audit + "I", initials + role[0], [*turns, (role, "")])
        if i == len(rows):
            if re.fullmatch("(s?(ua)+)?", initials):
                best[0] = min(best[0], (cost, audit, turns))
            return
        _, role, text = rows[i]
        go(i + 1, 0, cost + 4, audit + "D", initials, turns)
        if kinds[i] in ("", "truncated"):
            extra = 3 * (kinds[i] == "truncated")
            if role:
                go(i + 1, 0, cost + extra, audit + "K", initials + role[0], [*turns, (role, text)])
            for new in ("user", "assistant"):
                go(i + 1, 0, cost + extra + 3, audit + "R", initials + new[0], [*turns, (new, text)])

    go(0, 0, 0, "", "", [])
    return best[0]


def expected(conv, rows, solver=search):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    kinds = Counter(faults(rows))
    known = [t for t, _, _ in rows if t is not None]
    initials = [r[1][:1] for r in rows]
    cost, audit, turns = solver(rows)
    text = "\n".join(f"{a}:{b}" for a, b in turns)
    return (conv, max(known) - min(known) + 1 - len(set(known)) if known else 0, kinds["blank"], kinds["duplicate"],
            kinds["truncated"], sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)),
            cost, audit, hashlib.sha256(text.encode()).hexdigest())


def quick(rows):
    """The same by a forward pass over strings (used where the search takes too long; held to it below)."""
    kinds = faults(rows)
    step = {"": "su", "s": "u", "u": "a", "a": "u"}
    now = {"": (0, "", [])}  # by the last initial

    def better(table, key, value):
        if key not in table or value[:2] < table[key][:2]:
            table[key] = value

    names = {"u": "user", "a": "assistant"}
    insert = lambda last: names["a" if last == "u" else "u"]
    for (_, role, text), kind in zip(rows, kinds, strict=True):
        after = {}
        for last, (cost, audit, turns) in now.items():
            for k in range(3):
                better(after, last, (cost + 4, audit + "D", turns))
                if kind in ("", "truncated"):
                    extra = 3 * (kind != "")
                    if role[:1] and role[0] in step[last]:
                        better(after, role[0], (cost + extra, audit + "K", [*turns, (role, text)]))
                    new = insert(last)
                    better(after, new[0], (cost + extra + 3, audit + "R", [*turns, (new, text)]))
                if k < 2:
                    new = insert(last)
                    cost, audit, turns, last = cost + 3, audit + "I", [*turns, (new, "")], new[0]
        now = after
    ends = []
    for last, (cost, audit, turns) in now.items():
        while last not in ("", "a"):
            new = insert(last)
            cost, audit, turns, last = cost + 3, audit + "I", [*turns, (new, "")], new[0]
        ends.append((cost, audit, turns))
    return min(ends, key=lambda x: x[:2])


def result(df):
    return Counter(tuple(r) for r in df.collect())


def random_rows(seed, convs, most):
    rng = random.Random(seed)
    rows = []
    for conv in range(convs):
        for turn in range(rng.randint(0, most)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "sys", "umpire"])
            text = rng.choice(["Yes.", "No!", "what?", "cut off", "", " \n", "so ", "Fine. \n", None, "x" * 80 + str(turn)])
            rows.append((conv, rng.choice([turn, turn, turn, turn + 1, None]) if seed % 2 else turn,
                         rng.choice([role, role, role, None]), text))
    return rows


def test_search_and_pass_agree():
    rng = random.Random(3)
    for _ in range(400):
        rows = [(k, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["a.", "b.", "c", "", "d?"]))
                for k in range(rng.randint(0, 6))]
        a, b = search(rows), quick(rows)
        assert a == b
        kinds = "".join(repair.kind_of(r, t, f != "duplicate")[0] for (_, r, t), f in zip(rows, faults(rows), strict=True))
        assert repair.solve(kinds) == a[:2]


@pytest.mark.parametrize("seed, chunk", [(2, 1024), (4, 2), (5, 1024), (7, 1)])
def test_repair_equals_exhaustive_search(spark, seed, chunk):
    rows = random_rows(seed, 60, 6)
    want = Counter()
    by = defaultdict(list)
    for r in rows:
        by[r[0]].append((r[1], " " if r[2] is None else r[2], " " if r[3] is None else r[3]))
    for conv, own in by.items():
        own.sort(key=lambda r: (r[1], r[2]))
        want[expected(conv, own)] += 1
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4).withColumns({"id": F.lit("x"), "part": F.lit(1)})
    pieces = repair.repair(docs, chunk=chunk)
    assert result(repair.report(pieces)) == want
    ordered = pieces.select("id", "part", "seq", F.posexplode("repaired").alias("at", "x")).collect()
    made = defaultdict(list)
    for r in sorted(ordered, key=lambda r: (r.id, r.part, r.seq, r.at)):
        made[r.id].append(f"{r.x.role}:{r.x.text}")
    digests = {w[0]: w[8] for w in want}
    assert all(hashlib.sha256("\n".join(made[c]).encode()).hexdigest() == d for c, d in digests.items())


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    want = Counter(expected(conv, own, quick) for conv, own in damaged(rows).items())
    out = queries.op12_conversation_repair(spark, folder)
    assert result(out) == want
    assert out.columns[0] == "conv_id" and any(r[7] for r in want)


def test_conversations_without_rows_and_null_ids(spark):
    rows = [(1, 2, "user", "gone", 0), (None, 1, "system", "Be kind.", 1), (None, 2, "user", "Hi.", 1),
            (None, None, "user", "first.", 1), (3, None, "assistant", "So.", 1), (3, None, "assistant", "So.", 2)]
    docs = spark.createDataFrame(rows, SCHEMA + ", n int")
    got = {r.id: r for r in repair.report(repair.repair(docs, count=F.col("n"))).collect()}
    assert set(got) == {1, 3, None}
    assert tuple(got[1])[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert (got[3].gaps, got[3].duplicate, got[3].illegal, got[3].cost, got[3].audit) == (0, 2, 2, 11, "IKDD")
    assert (got[None].gaps, got[None].illegal) == (0, 1) and got[None].audit == expected(
        None, [(None, "user", "first."), (1, "system", "Be kind."), (2, "user", "Hi.")])[7]


@pytest.mark.parametrize("copies", [1, 3000])
def test_a_conversation_that_holds_a_third_of_the_rows(spark, copies):
    rng = random.Random(1)
    rows = [(7, k, rng.choice(["user", "assistant", "user", "assistant", "system"]),
             rng.choice(["same words.", f"text {k}.", f"text {k}", ""])) for k in range(2500)]
    rows += [(100 + k // 2, k % 2, ("user", "assistant")[k % 2], f"t{k}.") for k in range(2000)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(8).withColumn(
        "n", F.when((F.col("conv_id") == 7) & (F.col("turn") == 5), copies).otherwise(1))
    pieces = repair.repair(docs, chunk=100, count=F.col("n"))
    got = {r.id: tuple(r) for r in repair.report(pieces).collect()}
    hot = [(t, r, x) for c, t, r, x in rows if c == 7 for _ in range(copies if t == 5 else 1)]
    assert len(got) == 1001 and got[7] == expected(7, hot, quick)
    assert all(r[6] == 0 and r[7] == "KK" for c, r in got.items() if c != 7)
    parts = pieces.filter("id = 7").select("part").distinct().count()
    assert parts > 1


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert repair.report(repair.repair(docs)).count() == 0
