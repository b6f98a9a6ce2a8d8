"""Repairs against a search over all edits, and the query against SQL."""

import hashlib
import heapq
import random
import re
import zlib

import duckdb
from pyspark.sql import functions as F

from stationlake.llm import dialogue
from stationlake.llm.oracle import oracle_sql
from stationlake.llm.registry import op13_dialogue

COLUMNS = "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
RIGHT = re.compile(r"(s?(ua)+)?")
SPACE = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def cheapest(rows):
    """The least (cost, audit) over all edits, best first, by the pattern itself."""
    queue, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, at, initials, turns = heapq.heappop(queue)
        if at == len(rows) and RIGHT.fullmatch(initials):
            return cost, audit, turns
        if (at, initials[-1:], len(initials) > 1) in done:
            continue
        done.add((at, initials[-1:], len(initials) > 1))
        steps = [(2, "I", 0, role, "") for role in ("user", "assistant")]
        if at < len(rows):
            role, text, fault = rows[at]
            steps.append((3, "D", 1, None, None))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                steps.append((more, "K", 1, role, text))
                steps += [(2 + more, "R", 1, r, text) for r in ("user", "assistant")]
        for price, letter, move, role, text in steps:
            now = initials + (role[:1] if role is not None else "")
            if role is not None and not (role and re.fullmatch(r"(s?(ua)*u?)?", now)):
                continue
            kept = turns if role is None else (*turns, (role, text))
            # texts play no part in the order
            heapq.heappush(queue, (cost + price, audit + letter, at + move, now, kept))


def brute(rows, every):
    """The contract, conversation by conversation."""
    out = []
    for conv in set(every):
        own = [r for r in rows if r[0] == conv]
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0))
        seen, marked = set(), []
        for _, _, role, text in own:
            body = text.rstrip(SPACE)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else None
            fault = fault or ("" if body[-1] in ".!?" else "truncated")
            seen.add((role, text))
            marked.append((role, text, fault))
        turns = {t for _, t, _, _ in own if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        counts = [sum(f == x for *_, f in marked) for x in ("blank", "duplicate", "truncated")]
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(marked, marked[1:])]
        illegal = sum(p not in ("su", "ua", "au") for p in pairs)
        cost, audit, kept = cheapest(marked)
        text = "\n".join(f"{role}:{text}" for role, text in kept)
        digest = hashlib.sha256(text.encode()).hexdigest()
        out.append((conv, gaps, *counts, illegal, cost, audit, digest))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


SCHEMA = "conv_id long, turn long, role string, text string"


def some(n, rows, seed):
    pick = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", ""]
    texts = ["Yes.", "no", "", " \n", "Why?\t", "a b!", "end. x", "\x0b.", "é", "日本。"]
    out = []
    for conv in range(n):
        for turn in range(pick.randint(0, rows)):
            turn = pick.choice([turn, turn, turn * 2 + 50])
            out.append((conv, turn, pick.choice(roles), pick.choice(texts) * pick.choice([1, 1, 3])))
    at = {}
    return [r for r in out if at.setdefault(r[:2], r) is r]


def test_against_all_edits(spark):
    rows = some(150, 7, 1) + [(None, 0, "user", "null."), (None, 1, None, "a."), (-3, None, "assistant", "b.")]
    every = [r[0] for r in rows] + [999]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS n", "2 AS fault", "3 AS `a.b`")
    ids = spark.createDataFrame([(e,) for e in every], "conv_id long")
    given = [(c, t, *(" " if x is None else x for x in (r, s))) for c, t, r, s in rows]
    assert found(dialogue.report(df, ids)) == brute(given, every)


def test_damage(spark):
    rows = some(100, 9, 2) + [(None, None, None, None), (None, 1, "user", None), (5, None, None, "x.")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(repr, map(tuple, dialogue.damage(df).collect()))) == sorted(map(repr, damaged(rows)))


def test_long_conversations_cross_ranges(spark, monkeypatch):
    monkeypatch.setattr(dialogue, "NEIGHBOURS", 2)
    pick = random.Random(8)
    texts = [f"Number {i}{pick.choice(['.', '', '!'])}" for i in range(900)]
    rows = [(1, i, pick.choice(["user", "assistant", "system"]), t) for i, t in enumerate(texts)]
    rows += [(2, i, "user", "same.") for i in range(500)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert dialogue._parts(dialogue.faults(df)).where("conv_id = 1").count() > 2
    assert found(dialogue.report(df, df)) == brute(rows, [1, 2])


def test_repeated_and_null_rows(spark):
    rows = [(1, 0, "user", "a."), (1, 0, "user", "a."), (1, None, "assistant", "b."), (1, None, "user", "c.")]
    rows += [(2, 0, "user", " "), (3, 5, "system", "s."), (None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    report = {r.conv_id: r for r in dialogue.report(df, df).collect()}
    assert (report[1].duplicate, report[1].gaps, report[2].audit, report[3].audit) == (1, 0, "D", "D")
    assert (report[None].blank, report[None].cost, report[None].audit) == (1, 3, "D")
    summary = dialogue.repair(df)
    turns = dialogue.repaired(df, summary.select("conv_id", "audit")).orderBy("conv_id", "position").collect()
    by_conv = {}
    for t in turns:
        by_conv.setdefault(t.conv_id, []).append(t)
    initials = "".join(t.role[0] for t in by_conv[1])
    assert set(by_conv) == {1} and RIGHT.fullmatch(initials)
    assert [t.position for t in by_conv[1]] == list(range(len(initials)))
    none = df.where("false")
    assert dialogue.report(none, none).collect() == [] == dialogue.repaired(none, summary.where("false")).collect()


def test_any_cut_of_a_span_gives_its_cell():
    pick = random.Random(6)
    rows = [dialogue.of_row(pick.choice("suax"), pick.choice(range(4))) for _ in range(9)]
    chart = {(i, i + 1): cell for i, cell in enumerate(rows)}
    for length in range(2, 10):
        for i in range(10 - length):
            cells = [dialogue.joined(chart[i, k], chart[k, i + length]) for k in range(i + 1, i + length)]
            assert all(c == cells[0] for c in cells)
            chart[i, i + length] = cells[0]


def test_the_query_against_sql_and_all_edits(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf_dir}/conversations.parquet'")
    result = con.execute(oracle_sql()["op13_dialogue"])
    assert [c[0] for c in result.description] == COLUMNS
    should = sorted(result.fetchall(), key=repr)
    assert found(op13_dialogue(spark, sf_dir)) == should
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()]
    assert brute(damaged(rows), [r[0] for r in rows]) == should
