import hashlib
import re
import zlib
from functools import lru_cache

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from demandkit.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string"
SHOWN = re.compile(r"[^\x20\x09-\x0D]")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def cheapest(items, state, accept=re.compile(r"(s?(ua)+)?")):
    """Cost and letters by trying every edit; ``items`` are (initial, must go, broken)."""
    @lru_cache(None)
    def best(at, roles, inserted):
        if not re.fullmatch("s?(ua)*u?", roles):
            return (1 << 30, "", "")  # no more edits make it legal
        roles = re.sub("(ua)+", "ua", roles)  # how often doesn't matter
        found = []
        if at == len(items):
            if accept.fullmatch(roles):
                found.append((0, "", ""))
        else:
            initial, gone, broken = items[at]
            c, t, r = best(at + 1, roles, 0)
            found.append((c + 4, "D" + t, r))
            for role, cost, letter in ([] if gone else [(initial, 0, "K"), ("u", 3, "R"), ("a", 3, "R")]):
                c, t, r = best(at + 1, roles + role, 0)
                found.append((c + cost + 3 * broken, letter + t, role + r))
        if inserted < 3:
            for role in "ua":
                c, t, r = best(at, roles + role, inserted + 1)
                found.append((c + 3, "I" + t, role + r))
        return min(found, default=(1 << 30, "", ""))
    return best(0, state, 0)


def brute(rows, convs):
    out = []
    for conv in convs:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (
            r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest()))
        seen, items, faults = set(), [], [0, 0, 0]
        for _, _, role, text in mine:
            shown = SHOWN.findall(text)
            fault = 0 if not shown else 1 if (role, text) in seen else 2 if shown[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                faults[fault] += 1
            items.append((role[:1] if role[:1] in ("s", "u", "a") else "o", fault in (0, 1), fault == 2))
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        first = [i[0] for i in items]
        illegal = sum(x + y not in ("su", "ua", "au") for x, y in zip(first, first[1:]))
        cost, audit, roles = cheapest(tuple(items), "")
        kept, repaired, roles = iter(mine), [], iter(roles)
        for letter in audit:
            row = None if letter == "I" else next(kept)
            if letter == "D":
                continue
            role = {"u": "user", "a": "assistant"}.get(next(roles))
            repaired.append(f"{row[2] if letter == 'K' else role}:{'' if letter == 'I' else row[3]}")
        out.append((conv, gaps, *faults, illegal, cost, audit, hashlib.sha256("\n".join(repaired).encode()).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


EDGES = [(900, 3, "user", "a."), (900, 3, "user", "a."), (900, None, "user", "a."), (900, None, None, None), (900, 9, "", "b"),
         (901, 1, "assistant", "x"), (902, 0, "tool", "y."), (902, 5, "s", "z!"), (902, 6, "system", "z?"), (903, None, "user", " \t\n"),
         (None, 1, "user", "hello."), (None, 2, "assistant", "hi"), (904, 1, "user", "x" * 100_000 + "."), (904, 2, "assistant", "é ."),
         (905, 2, "user", "b."), (905, 2, "user", "a."), (905, 2, "assistant", "a."), *[(906, 4, "user", "same.")] * 3]


@pytest.fixture(scope="module")
def table(spark, small_dir):
    return spark.read.parquet(f"{small_dir}/conversations.parquet")


def test_damaged_table_against_brute_force(spark, table):
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()] + EDGES
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("audit", F.lit("x")).withColumn("signs", F.lit(1)).withColumn("copy", F.lit(2))
    got = result(C.damaged_summary(docs.repartition(5)))
    assert got == brute(damaged(rows), {r[0] for r in rows})
    assert any(r[7] == "" for r in got) or len(got) > 20


def test_repeats_at_several_turns_and_stretches(spark, monkeypatch):
    rows = [(1, t, ("user", "assistant")[t % 2], ("a.", "b", "c!", "", "a.")[t % 5]) for t in range(60)] + \
           [(2, t, ("system", "user", "assistant", "tool")[t % 4], f"{t % 7}{'.' * (t % 2)}") for t in range(41)] + EDGES
    df = spark.createDataFrame([(c, t, r, x) for c, t, r, x in rows], SCHEMA).repartition(7)
    clean = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert result(C.summary(df)) == brute(clean, {r[0] for r in rows})


def test_stretches_meet():
    """A conversation cut anywhere gives the same numbers as in one piece."""
    import pyarrow as pa
    turns, marks = [None, 1, 1, 2, 5, 5, 5, 9], "susuauua"
    rows = [{"conv": "1", "conv_id": 1, "turn": t, "initials": m, "signs": m, "blank": 0, "duplicate": i, "truncated": 1}
            for i, (t, m) in enumerate(zip(turns, marks, strict=True))]
    kinds = pa.schema([("conv", pa.string()), ("conv_id", pa.int64()), ("turn", pa.int64()), ("initials", pa.string()),
                       ("signs", pa.string()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64())])

    class At:
        def __init__(self, n):
            self.n = n

        def partitionId(self):
            return self.n

    def run(cuts, context):
        out = []
        for n, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(rows)])):
            context(n)
            out += list(C._stretches(iter([pa.RecordBatch.from_pylist(rows[a:b], schema=kinds)])))
        return [b.to_pylist() for b in C._whole(iter(out))]

    real = C.TaskContext
    try:
        def context(n):
            C.TaskContext = type("T", (), {"get": staticmethod(lambda: At(n))})
        whole = run([], context)
        assert all(run([cut], context) == whole for cut in range(1, len(rows)))
        assert run([2, 3, 6], context) == whole
    finally:
        C.TaskContext = real


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="suaoSUAOx", max_size=7), min_size=1, max_size=6))
def test_automaton_finds_the_cheapest_least_audit(signatures):
    automaton = C.Automaton()
    for signs in sorted(signatures, key=lambda s: s[::-1]):
        items = tuple((s.lower(), s == "x", s.isupper()) for s in signs)
        assert automaton.read(signs[::-1]) == cheapest(items, "")[:2]


def test_long_signatures_share_their_suffix():
    automaton = C.Automaton()
    long = "ua" * 50_000
    assert automaton.read(long[::-1]) == (0, "K" * 100_000)
    cost, audit = automaton.read(("x" + long)[::-1])
    assert (cost, audit[:3], len(automaton.nodes)) == (4, "DKK", 100_002)


def test_repair_gives_legal_rows_in_order(spark, table):
    rows = C.repair(C.damage(table)).collect()
    by = {}
    for r in rows:
        by.setdefault(r.conv_id, []).append(r)
    legal = re.compile("(s?(ua)+)?")
    assert by and all(legal.fullmatch("".join(r.role[0] for r in c)) for c in by.values())
    assert all((r.turn is None and r.text == "") == (r.edit == "I") or r.turn is None for r in rows)


def test_empty_table(spark):
    assert C.damaged_summary(spark.createDataFrame([], SCHEMA)).collect() == []
    assert C.repair(spark.createDataFrame([], SCHEMA)).collect() == []
