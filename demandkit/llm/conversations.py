"""Conversation structure repair over a suffix-shared automaton.

A conversation is the string of its rows' signs: the role's initial, written large
if the text breaks off, or ``x`` for a row that has to go (blank, or said before).
It must become one of the grammar ``(s?(ua)+)?`` by keeping a row (K, free),
giving it the role user or assistant (R, 3), deleting it (D, 4) or inserting an empty
turn of user or assistant (I, 3); a kept or re-roled row that breaks off adds 3. The
cheapest edits count, and of equally cheap ones those whose letters are least.

Method. What the rest of a conversation costs depends on its remaining signs and the
state of the grammar alone. So the signatures of all conversations are read from the
end into one automaton (DAWG) whose nodes are suffixes: sorted by their reversed
signs, neighbours share their longest common suffix, and a task keeps the nodes
of the current one on a stack. A node has, for each of the four states, the cost
to go, the letters that are written before its sign is consumed, and the state that
follows, which is where the shared best audit of the rest goes on; they are computed
once, when the node is entered. Nodes that differ by a constant cost share one
computation. Equal signatures are neighbours and share their audit.

Spark's part. Texts are reduced to digests where they are read. Equal rows of a
conversation are summed in partial aggregates; what was said before is found by
the least turn of each digest. Rows are sorted by range, so a conversation of any
length is spread over tasks that each turn a stretch of it into its signs; only these
signs, a byte a row, come together by conversation, as its audit is one value. In the
end texts are sorted by conversation behind its audit and repaired in a stream that
holds one row; a hash over a conversation's text is a matter of one task.

Defined cases: a null role or text counts as one space. Rows are taken by turn, nulls
first; rows of one turn by role, then by the SHA-256 of role and text. A role that
begins with no s, u or a (an empty one too) can't be kept, only given another role or
deleted. A null conv_id is a conversation too. Other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, map_arrow, write_table

#: White space of a text (fixed values), and what may end a sentence.
SPACES, ENDINGS = "\x20\t\n\x0b\x0c\r", ".!?"
#: Costs of edits, and of keeping a row that breaks off (fixed values).
COST = {"D": 4, "I": 3, "R": 3, "K": 0}
BROKEN = 3
#: The grammar: state -> initial -> state. 0 start, 1 after system, 2 after user, 3 after
#: assistant; a conversation may end in 0 and 3.
GRAMMAR = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
FINAL = (0, 3)
ROLES = {"u": "user", "a": "assistant"}
#: The role that an edit can give in each state, and the state after it.
GIVEN = tuple(next((r, to) for r, to in moves.items() if r in ROLES) for moves in GRAMMAR)
#: Signs of a conversation that a task gathers before it writes them out.
STRETCH = 1 << 20

_NEVER = 1 << 40


@lru_cache(maxsize=1 << 16)
def _node(sign: str, after: tuple[int, ...]) -> tuple[tuple[int, ...], tuple[tuple[str, int], ...]]:
    """Cost to go before ``sign`` in each state, where ``after`` is the cost behind it, and
    the best letters up to its consumption with the state that follows. The end
    of a conversation is the empty sign, with ``after`` of no use."""
    options: list[list[tuple[int, str, int]]] = []
    for state in range(4):
        if not sign:
            options.append([(0 if state in FINAL else _NEVER, "", state)])
            continue
        found = [(COST["D"] + after[state], "D", state)]
        if sign != "x":
            more = BROKEN if sign.isupper() else 0
            if (to := GRAMMAR[state].get(sign.lower())) is not None:
                found.append((COST["K"] + more + after[to], "K", to))
            to = GIVEN[state][1]
            found.append((COST["R"] + more + after[to], "R", to))
        options.append(found)
    cost = [min(o)[0] for o in options]
    for _ in range(3):  # an insertion leads from a state to another before the same sign
        cost = [min(cost[s], COST["I"] + cost[GIVEN[s][1]]) for s in range(4)]
    letters = []
    for state in range(4):
        text, at = "", state
        while True:
            best = min((letter, to) for c, letter, to in
                       [*options[at], (COST["I"] + cost[GIVEN[at][1]], "I", GIVEN[at][1])] if c == cost[at])
            text, at = text + best[0], best[1]
            if best[0] != "I":
                break
        letters.append((text, at))
    return tuple(cost), tuple(letters)


class Automaton:
    """Nodes of the current signature, from its end to its start."""

    def __init__(self):
        cost, letters = _node("", (0,) * 4)
        self.path = ""
        self.nodes = [(0, cost, letters)]

    def read(self, backwards: str) -> tuple[int, str]:
        """Cost and audit of a signature, given from its end."""
        if backwards != self.path:
            shared = _shared(self.path, backwards)
            del self.nodes[shared + 1:]
            base, cost, _ = self.nodes[-1]
            for sign in backwards[shared:]:
                cost, letters = _node(sign, cost)
                least = min(cost)
                base, cost = base + least, tuple(c - least for c in cost)
                self.nodes.append((base, cost, letters))
            self.path = backwards
        state, out = 0, []
        for _, _, letters in reversed(self.nodes):
            text, state = letters[state]
            out.append(text)
        base, cost, _ = self.nodes[-1]
        return base + cost[0], "".join(out)


def _shared(a: str, b: str) -> int:
    """Length of the longest common start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def rows_of(conversations: DataFrame) -> DataFrame:
    """conv (the id as text), conv_id, turn, role, text without nulls in role and text."""
    conv_id, space = F.col("conv_id").cast("long"), F.lit(" ")
    return conversations.select(
        F.coalesce(conv_id.cast("string"), space).alias("conv"), conv_id.alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"), F.coalesce(F.col("text").cast("string"), space).alias("text"))


def damage(conversations: DataFrame) -> DataFrame:
    """Rows damaged by crc32 of ``conv_id:turn`` modulo 20: 0 drops a row, 1 empties
    its text, 2 takes out its sentence marks, 3 repeats it, 4 makes it a user's."""
    rows = rows_of(conversations)
    key = F.concat(F.col("conv"), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(key.cast("binary")) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate("text", ENDINGS, "")).otherwise(F.col("text"))
    return rows.where(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")).drop("copy")


def _said() -> Column:
    """Digest of role and text together."""
    return F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256))


def entries(rows: DataFrame) -> DataFrame:
    """Distinct rows of a conversation and turn with their number and their signs; a
    written table without texts."""
    shown = F.rtrim(F.col("text"), F.lit(SPACES))
    slim = rows_of(rows).select(
        "conv", "conv_id", "turn", "role", _said().alias("said"), (F.length(shown) == 0).alias("blank"),
        (~F.substring(shown, -1, 1).isin(*ENDINGS)).alias("broken"))
    whole = write_table(slim.groupBy(*slim.columns).agg(F.count(F.lit(1)).alias("times")), "turns")
    # What one conversation says at several turns: nulls come first, as in the order of rows.
    again = (whole.where("NOT blank").groupBy(F.col("conv").alias("of_conv"), F.col("said").alias("of_said"))
             .agg(F.count(F.lit(1)).alias("turns"), F.min(F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn"))).alias("first"))
             .where("turns > 1").drop("turns"))
    at = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn"))
    new = F.col("first").isNull() | (F.col("first.known") == at.known) & F.coalesce(F.col("first.turn") == F.col("turn"), F.lit(True))
    joined = whole.join(again, (whole.conv == again.of_conv) & (whole.said == again.of_said), "left").withColumn("new", ~F.col("blank") & new)
    initial = F.substring("role", 1, 1)
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("o"))
    kept = F.when(F.col("broken"), F.upper(initial)).otherwise(initial)
    count = F.col("times").cast("int")
    return joined.select(
        "conv", "conv_id", "turn", "role", "said", F.repeat(initial, count).alias("initials"),
        F.when(F.col("new"), F.concat(kept, F.repeat(F.lit("x"), count - 1))).otherwise(F.repeat(F.lit("x"), count)).alias("signs"),
        F.when(F.col("blank"), F.col("times")).otherwise(F.lit(0)).alias("blank"),
        F.when(F.col("blank"), F.lit(0)).otherwise(F.col("times") - F.col("new").cast("long")).alias("duplicate"),
        (F.col("new") & F.col("broken")).cast("long").alias("truncated"))


_STRETCH = ("conv string, conv_id long, part long, signs string, first string, last string, legal long, n long, blank long, "
            "duplicate long, truncated long, first_turn long, last_turn long, turns long")
_NUMBERS = "gaps long, blank long, duplicate long, truncated long, illegal long"
_SIGNED = f"conv string, conv_id long, signs string, {_NUMBERS}"
_DECIDED = f"conv string, conv_id long, {_NUMBERS}, cost long, audit string"


def _batch(rows: list, ddl: str) -> pa.RecordBatch:
    schema = arrow_schema(ddl)
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _legal(initials: str) -> int:
    return sum(initials.count(pair) for pair in ("su", "ua", "au"))


def _stretches(batches):
    """Signs of each stretch of a conversation in sorted rows, with the numbers
    that can be put together."""
    part = TaskContext.get().partitionId() << 40
    key, held, size = None, [], 0

    def stretch():
        nonlocal part
        part += 1
        _, conv_ids, turns, initials, signs, blank, duplicate, truncated = zip(*held, strict=True)
        known = [t for t in turns if t is not None]
        initials, signs = "".join(initials), "".join(signs)
        return (key, conv_ids[0], part, signs, initials[0], initials[-1], _legal(initials), len(initials), sum(blank), sum(duplicate),
                sum(truncated), known[0] if known else None, known[-1] if known else None, len(set(known)))

    names = ("conv", "conv_id", "turn", "initials", "signs", "blank", "duplicate", "truncated")
    for b in batches:
        out = []
        for row in zip(*(b.column(c).to_pylist() for c in names), strict=True):
            if held and (row[0] != key or size >= STRETCH):
                out.append(stretch())
                held, size = [], 0
            key = row[0]
            held.append(row)
            size += len(row[4])
        if out:
            yield _batch(out, _STRETCH)
    if held:
        yield _batch([stretch()], _STRETCH)


def _whole(batches):
    """One row for the stretches of each conversation."""
    held: list[dict] = []

    def conversation():
        total = lambda c: sum(r[c] for r in held)
        between = [(a["last"] + b["first"], a["last_turn"], b["first_turn"]) for a, b in zip(held, held[1:])]
        lows = [r["first_turn"] for r in held if r["first_turn"] is not None]
        highs = [r["last_turn"] for r in held if r["last_turn"] is not None]
        turns = total("turns") - sum(x is not None and x == y for _, x, y in between)
        illegal = total("n") - 1 - total("legal") - sum(_legal(pair) for pair, _, _ in between)
        return (held[0]["conv"], held[0]["conv_id"], "".join(r["signs"] for r in held),
                highs[-1] - lows[0] + 1 - turns if lows else 0, total("blank"), total("duplicate"), total("truncated"), illegal)

    for b in batches:
        out = []
        for row in b.to_pylist():
            if held and row["conv"] != held[0]["conv"]:
                out.append(conversation())
                held = []
            held.append(row)
        if out:
            yield _batch(out, _SIGNED)
    if held:
        yield _batch([conversation()], _SIGNED)


def _audits(batches):
    """Cost and audit of signatures sorted by their reversed signs."""
    automaton = Automaton()
    rest = ("gaps", "blank", "duplicate", "truncated", "illegal")
    for b in batches:
        read = [automaton.read(x) for x in b.column("backwards").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b.column("conv"), b.column("conv_id"), *(b.column(c) for c in rest),
             pa.array([c for c, _ in read], pa.int64()), pa.array([a for _, a in read], pa.string())], schema=arrow_schema(_DECIDED))


def decisions(rows: DataFrame) -> DataFrame:
    """conv, conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit: a
    row for each conversation of ``rows`` (conv_id, turn, role, text); a written table."""
    order = ["conv", "turn", "role", "said"]
    stretches = map_arrow(entries(rows).repartitionByRange(*order).sortWithinPartitions(*order).drop("role", "said"), _stretches, _STRETCH)
    signed = map_arrow(stretches.repartition("conv").sortWithinPartitions("conv", "part"), _whole, _SIGNED)
    backwards = signed.select("*", F.reverse("signs").alias("backwards")).drop("signs")
    sorted_back = backwards.repartitionByRange("backwards", "conv").sortWithinPartitions("backwards")
    return write_table(map_arrow(sorted_back, _audits, _DECIDED), "audits")


_EDITED = "conv_id long, turn long, edit string, role string, text string, cost long, audit string"


def _edits(batches):
    """Rows sorted by conversation, its audit first: the repaired rows, behind a row
    with the audit for each conversation."""
    audit, at, state, conv_id = "", 0, 0, None

    def insertions():
        nonlocal at, state
        while audit[at:at + 1] == "I":
            role, state = GIVEN[state]
            at += 1
            yield (conv_id, None, "I", ROLES[role], "", None, None)

    for b in batches:
        out = []
        for row in b.to_pylist():
            if row["audit"] is not None:
                out += insertions()
                audit, at, state, conv_id = row["audit"], 0, 0, row["conv_id"]
                out.append((conv_id, None, None, None, None, row["cost"], audit))
                continue
            out += insertions()
            edit, role = audit[at], row["role"]
            at += 1
            if edit == "D":
                continue
            if edit == "R":
                role, state = ROLES[GIVEN[state][0]], GIVEN[state][1]
            else:
                state = GRAMMAR[state][role[0]]
            out.append((conv_id, row["turn"], edit, role, row["text"], None, None))
        if out:
            yield _batch(out, _EDITED)
    last = list(insertions())
    if last:
        yield _batch(last, _EDITED)


def _edited(rows: DataFrame, decided: DataFrame) -> DataFrame:
    texts = rows_of(rows).select("conv", "conv_id", "turn", "role", "text", _said().alias("said"),
                                 F.lit(None).cast("long").alias("cost"), F.lit(None).cast("string").alias("audit"))
    heads = decided.select("conv", "conv_id", *(F.lit(None).cast(t).alias(c) for c, t in (
        ("turn", "long"), ("role", "string"), ("text", "string"), ("said", "binary"))), "cost", "audit")
    both = texts.unionByName(heads).repartition("conv").sortWithinPartitions(
        "conv", F.col("audit").isNull(), "turn", "role", "said")
    return map_arrow(both.drop("conv", "said"), _edits, _EDITED)


def repair(rows: DataFrame) -> DataFrame:
    """conv_id, turn (null if inserted), edit (K, R or I), role, text: the repaired
    conversations, in order within each of them."""
    return _edited(rows, decisions(rows)).where("edit IS NOT NULL").drop("cost", "audit")


def _digests(batches):
    """conv_id and SHA-256 of the repaired rows behind each audit."""
    ddl = "conv_id long, audit string, repaired_sha256 string"
    head, digest, first = None, None, True
    for b in batches:
        out = []
        for conv_id, edit, role, text, audit in zip(*(b.column(c).to_pylist() for c in ("conv_id", "edit", "role", "text", "audit")), strict=True):
            if edit is None:
                if head:
                    out.append((*head, digest.hexdigest()))
                head, digest, first = (conv_id, audit), hashlib.sha256(), True
                continue
            digest.update(f"{'' if first else chr(10)}{role}:{text}".encode())
            first = False
        if out:
            yield _batch(out, ddl)
    if head:
        yield _batch([(*head, digest.hexdigest())], ddl)


def summary(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256 of each conversation of ``rows``."""
    decided = decisions(rows)
    hashes = map_arrow(_edited(rows, decided), _digests, "conv_id long, audit string, repaired_sha256 string")
    return decided.drop("conv").join(
        hashes.select(F.col("conv_id").alias("of_conv"), "repaired_sha256"), F.col("conv_id").eqNullSafe(F.col("of_conv"))).drop("of_conv")


def damaged_summary(conversations: DataFrame) -> DataFrame:
    """:func:`summary` of the damaged rows, for every conversation of the
    undamaged ones."""
    every = conversations.select(F.col("conv_id").cast("long").alias("of_conv")).distinct()
    found = summary(damage(conversations))
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return every.join(found, F.col("of_conv").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("of_conv").alias("conv_id"), *(F.coalesce(c, F.lit(0)).alias(c) for c in numbers), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
