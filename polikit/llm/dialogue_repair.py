"""Repair of the structure of conversations by a least-cost edit plan.

The turns of a conversation are to read, by the initials of their roles, ``(s?(ua)+)?``: at
most one system turn, then user and assistant in turn, or nothing. An edit plan keeps (K),
re-roles (R) or deletes (D) every turn in order and inserts (I) empty user or assistant turns
anywhere; blank turns and repeats must go. The plan of least cost is taken and, among equals,
the one whose letters are least as text.

*Weights.* A plan's weight is one integer. Its high digits are the cost; below stand, at fixed
width, the plan's letters as digits in order (D < I < K < R), padded with zeros at the end, so
the least integer is the cheapest plan with the least letters. The plans form a directed
acyclic graph over (turn, state), four states; taking an edit before the best plan of what
follows shifts that plan's letters one digit down, and an ordinary minimum decides everything.

*Scale.* Rows are spread by (conversation, turn), so a conversation with a third of all rows is
cut over many tasks, and within a task into segments of at most ``SEGMENT`` rows (and about
``SEGMENT_CHARS`` characters). A segment
that holds a whole conversation is decided at once. For the others

1. each segment gives the least cost from each state to each state (16 numbers);
2. these are chained from the conversation's end, one narrow row a segment, which gives each
   segment the cost of what follows it by exit state;
3. with that, each segment finds its best plan from each of the four states by itself: plans
   of a segment end with an edit of one of its rows, so of two plans that differ none begins
   with the other, and what follows a segment never decides between its letters;
4. the exit states are chained from the start, again one narrow row a segment.

Identical rows are counted first. Repeats (role and text seen at an earlier turn) are found by
a grouped minimum with map-side combine, and only those seen at several turns are joined
back. No window, collect or join holds a conversation.

Rows are ordered by turn (nulls first), then role and text; null roles and texts are one space, a
null conversation id is an id like any other, and identical rows stand side by side. A
conversation without turns has an empty plan; an empty table gives none. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, broadcast_if_small, stage

SEGMENT = 1024  # rows
SEGMENT_CHARS = 1 << 20  # a segment ends with the row that reaches these
DELETE, INSERT, KEEP, REROLE = "D", "I", "K", "R"
COST = {DELETE: 3, INSERT: 2, KEEP: 0, REROLE: 2}
TRUNCATED_COST = 1  # of a truncated turn that stays
_DIGIT = {DELETE: 1, INSERT: 2, KEEP: 3, REROLE: 4}
_LETTER = "\0DIKR"
_BITS = 3  # of a letter's digit

# States: 0 nothing yet, 1 after the system turn, 2 after a user turn, 3 after an assistant turn.
_NEXT = {(0, "s"): 1, **{(s, "u"): 2 for s in (0, 1, 3)}, (2, "a"): 3}
_GIVES = ("u", "u", "a", "u")  # the initial that an inserted or re-roled turn has in each state
_ROLE = {"u": "user", "a": "assistant"}
#: Turns to insert at a conversation's end, by state.
_TO_END = ((0, ""), (4, "II"), (2, "I"), (0, ""))
_PAIRS = {"su", "ua", "au"}
_SPACE = " \t\n\v\f\r"
OK, BLANK, DUPLICATE, TRUNCATED = range(4)


# --- one segment ---------------------------------------------------------------------------

def _edits(initial: str, fault: int) -> list[list[tuple[int, str, int]]]:
    """(cost, letters, next state) of what may be done with a row, by state: with no or one turn
    inserted before it (two are never cheapest: they lead back to where they began)."""
    plain: list[list[tuple[int, str, int]]] = []
    stays = TRUNCATED_COST if fault == TRUNCATED else 0
    for state in range(4):
        found = [(COST[DELETE], DELETE, state)]
        if fault not in (BLANK, DUPLICATE):
            if (state, initial) in _NEXT:
                found.append((COST[KEEP] + stays, KEEP, _NEXT[state, initial]))
            found.append((COST[REROLE] + stays, REROLE, _NEXT[state, _GIVES[state]]))
        plain.append(found)
    return [found + [(COST[INSERT] + c, INSERT + letters, to) for c, letters, to in plain[_NEXT[state, _GIVES[state]]]]
            for state, found in enumerate(plain)]


_CHOICES = {(initial, fault): _edits(initial, fault) for initial in ("s", "u", "a", "") for fault in range(4)}


def _choices(role: str, fault: int) -> list[list[tuple[int, str, int]]]:
    initial = role[:1]
    return _CHOICES[initial if initial in ("s", "u", "a") else "", fault]


def costs_between(rows: list[tuple[str, int]]) -> list[int | None]:
    """The least costs from each state to each state over (role, fault) rows, 16 numbers by
    (from, to); None where there is no way."""
    out: list[int | None] = []
    for start in range(4):
        now: list[int | None] = [None] * 4
        now[start] = 0
        for role, fault in rows:
            then: list[int | None] = [None] * 4
            for state, found in enumerate(_choices(role, fault)):
                if now[state] is not None:
                    for cost, _, to in found:
                        cost += now[state]
                        if then[to] is None or cost < then[to]:
                            then[to] = cost
            now = then
        out += now
    return out


def best_plans(rows: list[tuple[str, int]], after: list[int] | None) -> list[tuple[int, str]]:
    """(cost of this and all that follows, letters) of the best plan over (role, fault) rows from each
    state. ``after``: the least cost of what follows by exit state; None at the end."""
    width = 2 * len(rows) + 2  # a row has two letters at most, the end two
    low = _BITS * width
    top, mask = _BITS * (width - 1), (1 << low) - 1

    def prefixed(cost: int, letters: str, weight: int) -> int:
        """The weight of a plan put after ``letters`` of that cost."""
        cost += weight >> low
        digits = weight & mask
        for letter in reversed(letters):
            digits = digits >> _BITS | _DIGIT[letter] << top
        return cost << low | digits

    if after is None:
        best = [prefixed(cost, letters, 0) for cost, letters in _TO_END]
    else:
        best = [cost << low for cost in after]
    for role, fault in reversed(rows):
        best = [min(prefixed(cost, letters, best[to]) for cost, letters, to in found)
                for found in _choices(role, fault)]
    out = []
    for weight in best:
        digits = weight & mask
        letters = "".join(_LETTER[digits >> at & 7] for at in range(top, -1, -_BITS)).rstrip("\0")
        out.append((weight >> low, letters))
    return out


def apply_plan(rows: list[tuple[str, str]], letters: str, state: int) -> tuple[list[tuple[str, str]], int]:
    """The (role, text) rows that a plan makes of (role, text) rows, and the state after them."""
    out, at = [], 0
    for letter in letters:
        if letter == INSERT:
            role, text = _ROLE[_GIVES[state]], ""
        else:
            role, text = rows[at]
            at += 1
        if letter == DELETE:
            continue
        if letter == REROLE:
            role = _ROLE[_GIVES[state]]
        state = _NEXT[state, role[:1]]
        out.append((role, text))
    return out, state


def fault_of(text: str, repeated: bool) -> int:
    """A row's first fault."""
    seen = text.rstrip(_SPACE)
    if not seen:
        return BLANK
    if repeated:
        return DUPLICATE
    return OK if seen[-1] in ".!?" else TRUNCATED


# --- damage, for trials --------------------------------------------------------------------

def damaged(df: DataFrame) -> DataFrame:
    """``df`` (conv_id, turn, role, text) with faults by crc32 of ``conv_id:turn`` modulo 20: 0 drops
    the row, 1 empties its text, 2 removes its ``[.!?]``, 3 repeats it, 4 sets role user. Nulls
    are one space. ``copies`` tells how often each row counts (0: not at all)."""
    def said(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    rows = df.select("conv_id", "turn", said("role").alias("role"), said("text").alias("text"), kind.alias("kind"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") <= 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("copies"))


# --- the operator --------------------------------------------------------------------------

_NUMBERS = ["turns", "distinct_turns", "blank", "duplicate", "truncated", "illegal"]


def _segment_schema(id_type: str, turn_type: str) -> str:
    return (f"conv_id {id_type}, part int, segment int, whole boolean, first_turn {turn_type}, last_turn {turn_type}, "
            f"first_initial string, last_initial string, {', '.join(f'{n} long' for n in _NUMBERS)}, roles array<string>, "
            "texts array<string>, faults array<int>, costs array<long>, state int, cost long, audit string")


def _marked(rows: DataFrame) -> DataFrame:
    """Different rows with their ``copies``, and ``again``: whether role and text were seen at an
    earlier turn."""
    same = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    at = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    seen = (rows.filter("copies > 0").groupBy("conv_id", same.alias("same"))
            .agg(F.min(at).alias("first"), F.max(at).alias("last")).filter(F.col("first") < F.col("last"))
            .select(F.col("conv_id").alias("conv_id_"), F.col("same").alias("same_"), "first"))
    seen = broadcast_if_small(stage(seen, "dialogue-repeats"))
    different = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies")).withColumn("same", same)
    both = different.join(seen, F.col("conv_id").eqNullSafe(F.col("conv_id_")) & (F.col("same") == F.col("same_")), "left")
    return both.select("conv_id", "turn", "role", "text", "copies", F.coalesce(at > F.col("first"), F.lit(False)).alias("again"))


def segments(rows: DataFrame, size: int = SEGMENT, size_chars: int = SEGMENT_CHARS) -> DataFrame:
    """Rows (conv_id, turn, role, text, copies) in order, cut into segments of whole or part
    conversations; the whole ones with their best plan, the others with their costs between
    states. Staged, so that what follows sees one cut."""
    kinds = dict(rows.dtypes)
    bounded_batches(rows.sparkSession)
    plain = rows.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")], "copies")
    spread = _marked(plain).repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 128))
    ordered = spread.sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        conv: object = run  # none yet
        held: list[tuple] = []  # (turn, role, text, fault)
        chars, cut = 0, True  # the first conversation of a part may have begun before it
        ready: list[dict] = []
        arrow = None

        def segment(whole: bool) -> dict:
            nonlocal number
            number += 1
            initials, known = [r[1][:1] for r in held], [r[0] for r in held if r[0] is not None]
            plan = [(r[1], r[3]) for r in held]
            cost, audit = best_plans(plan, None)[0] if whole else (None, None)
            return {"conv_id": conv, "part": part, "segment": number, "whole": whole,
                    "first_turn": known[0] if known else None, "last_turn": known[-1] if known else None,
                    "first_initial": initials[0] if held else None, "last_initial": initials[-1] if held else None,
                    "turns": len(held), "distinct_turns": len(set(known)),
                    **{name: sum(r[3] == fault for r in held)
                       for name, fault in (("blank", BLANK), ("duplicate", DUPLICATE), ("truncated", TRUNCATED))},
                    "illegal": sum(a + b not in _PAIRS for a, b in zip(initials, initials[1:], strict=False)),
                    "roles": [r[1] for r in held], "texts": [r[2] for r in held], "faults": [r[3] for r in held],
                    "costs": None if whole else costs_between(plan), "state": 0 if whole else None, "cost": cost, "audit": audit}

        for batch in batches:
            arrow = arrow or _arrow_schema(batch.schema)
            ids, turns, roles = (batch.column(i).to_pylist() for i in range(3))
            copies, again = batch.column(4).to_pylist(), batch.column(5).to_pylist()
            for i, text in enumerate(batch.column(3)):
                if ids[i] != conv or conv is run:
                    if conv is not run:
                        ready.append(segment(not cut))
                        cut = False
                    conv, held, chars = ids[i], [], 0
                text = text.as_py()
                for k in range(copies[i]):
                    if len(held) >= size or chars >= size_chars:
                        ready.append(segment(False))
                        cut, held, chars = True, [], 0
                    fault = fault_of(text, again[i] or k > 0)
                    held.append((turns[i], roles[i], "" if fault in (BLANK, DUPLICATE) else text, fault))
                    chars += len(held[-1][2])
                    if len(ready) > 500:
                        yield pa.RecordBatch.from_pylist(ready, arrow)
                        ready = []
                if len(ready) > 500:
                    yield pa.RecordBatch.from_pylist(ready, arrow)
                    ready = []
        if conv is not run:  # and the last may go on after it
            yield pa.RecordBatch.from_pylist([*ready, segment(False)], arrow)

    return stage(ordered.mapInArrow(run, _segment_schema(kinds["conv_id"], kinds["turn"])), "dialogue-segments")


def _arrow_schema(given: pa.Schema) -> pa.Schema:
    id_type, turn_type, text, texts = given.field(0).type, given.field(1).type, pa.string(), pa.list_(pa.string())
    return pa.schema([
        ("conv_id", id_type), ("part", pa.int32()), ("segment", pa.int32()), ("whole", pa.bool_()), ("first_turn", turn_type),
        ("last_turn", turn_type), ("first_initial", text), ("last_initial", text), *[(n, pa.int64()) for n in _NUMBERS],
        ("roles", texts), ("texts", texts), ("faults", pa.list_(pa.int32())), ("costs", pa.list_(pa.int64())),
        ("state", pa.int32()), ("cost", pa.int64()), ("audit", text)])


def _chain(rows: DataFrame, value: str, out: str, out_type: str, step, forward: bool) -> DataFrame:
    """``step(value, carried) -> (result, carried)`` along each conversation's segments, from the start or
    from the end (carried: None at first); (part, segment, ``out``). One narrow row a segment."""
    order = [F.col(c) if forward else F.col(c).desc() for c in ("part", "segment")]
    lined = rows.select("conv_id", "part", "segment", value).repartition("conv_id").sortWithinPartitions("conv_id", *order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, carried = run, None
        for batch in batches:
            results = []
            for i, v in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if conv is run or i != conv:
                    conv, carried = i, None
                result, carried = step(v, carried)
                results.append(result)
            kind = pa.list_(pa.int64()) if out_type.startswith("array") else pa.int32()
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(results, kind)], ["part", "segment", out])

    return stage(lined.mapInArrow(run, f"part int, segment int, {out} {out_type}"), "dialogue-chain")


def _cost_step(costs: list, after: list | None):
    """What follows a segment is its result; what follows the one before it is carried on."""
    end = after or [c for c, _ in _TO_END]
    before = [min(c + e for c, e in zip(costs[4 * s:4 * s + 4], end, strict=True) if c is not None) for s in range(4)]
    return after, before


def _state_step(exits: list, state: int | None):
    return state or 0, exits[state or 0]


def plans(cut: DataFrame) -> DataFrame:
    """``segments`` with state (at its start), cost (of it and all that follows) and audit of the best plan, for
    the conversations cut in several segments, too."""
    parts = cut.filter("not whole")
    after = _chain(parts, "costs", "after", "array<long>", _cost_step, forward=False)
    beside = parts.drop("state", "cost", "audit").join(broadcast_if_small(after), ["part", "segment"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                found = best_plans(list(zip(r["roles"], r["faults"], strict=True)), r["after"])
                rows = [(role, "") for role in r["roles"]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["conv_id"]], batch.schema.field(0).type), pa.array([r["part"]], pa.int32()),
                     pa.array([r["segment"]], pa.int32()), pa.array([[cost for cost, _ in found]], pa.list_(pa.int64())),
                     pa.array([[letters for _, letters in found]], pa.list_(pa.string())),
                     pa.array([[apply_plan(rows, letters, s)[1] for s, (_, letters) in enumerate(found)]], pa.list_(pa.int64()))],
                    ["conv_id", "part", "segment", "by_cost", "by_audit", "exits"])

    schema = (f"conv_id {dict(cut.dtypes)['conv_id']}, part int, segment int, by_cost array<long>, by_audit array<string>, "
              "exits array<long>")
    options = stage(beside.select("conv_id", "part", "segment", "roles", "faults", "after").mapInArrow(run, schema),
                    "dialogue-options")
    entered = _chain(options, "exits", "state", "int", _state_step, forward=True)
    chosen = options.join(entered, ["part", "segment"]).select(
        "part", "segment", "state", F.col("by_cost")[F.col("state")].alias("cost"), F.col("by_audit")[F.col("state")].alias("audit"))
    done = parts.drop("state", "cost", "audit").join(broadcast_if_small(stage(chosen, "dialogue-chosen")), ["part", "segment"])
    return cut.filter("whole").unionByName(done)


def repair(rows: DataFrame, size: int = SEGMENT, size_chars: int = SEGMENT_CHARS) -> DataFrame:
    """The best plans of the conversations of ``rows`` (conv_id, turn, role, text, and copies if
    given), by segment. ``repaired`` and ``summaries`` read them."""
    if "copies" not in rows.columns:
        rows = rows.withColumn("copies", F.lit(1).cast("long"))
    return plans(segments(rows, size, size_chars))


def repaired(planned: DataFrame) -> DataFrame:
    """The repaired turns: conv_id, part, segment, line (their order), role, text."""
    fields = planned.select("conv_id", "part", "segment", "state", "audit", "roles", "texts")
    schema = "conv_id {}, part int, segment int, line int, role string, text string".format(dict(planned.dtypes)["conv_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                rows, _ = apply_plan(list(zip(r["roles"], r["texts"], strict=True)), r["audit"], r["state"])
                n = len(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["conv_id"]] * n, batch.schema.field(0).type), pa.array([r["part"]] * n, pa.int32()),
                     pa.array([r["segment"]] * n, pa.int32()), pa.array(range(n), pa.int32()),
                     pa.array([x for x, _ in rows], pa.string()), pa.array([x for _, x in rows], pa.string())],
                    ["conv_id", "part", "segment", "line", "role", "text"])

    return fields.mapInArrow(run, schema)


def summaries(planned: DataFrame) -> DataFrame:
    """One row a conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256 (of the repaired ``role:text`` lines). A whole segment is its conversation. Those
    cut are brought together in order, one segment at a time: a digest of a whole text
    cannot be taken in parts, so a cut conversation's text passes through one task, which
    holds a batch of segments and the letters so far."""
    names = ["conv_id", "state", "audit", "roles", "texts", "first_turn", "last_turn", "first_initial", "last_initial", "cost",
             *_NUMBERS]
    out = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    schema = "conv_id {}, {}, audit string, repaired_sha256 string".format(
        dict(planned.dtypes)["conv_id"], ", ".join(f"{n} long" for n in out))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict | None = None
        letters: list[str] = []
        digest = hashlib.sha256()
        any_line = False
        ready: list[dict] = []
        kind = None

        def summary() -> dict:
            low, high = own["first_turn"], own["last_turn"]
            gaps = 0 if low is None else high - low + 1 - own["distinct_turns"]
            return {**{n: own[n] for n in ("conv_id", *out[1:])}, "gaps": gaps, "audit": "".join(letters),
                    "repaired_sha256": digest.hexdigest()}

        for batch in batches:
            kind = kind or pa.schema([("conv_id", batch.schema.field(0).type), *[(n, pa.int64()) for n in out],
                                      ("audit", pa.string()), ("repaired_sha256", pa.string())])
            for i in range(batch.num_rows):
                r = {name: batch.column(name)[i].as_py() for name in names}
                if own is None or r["conv_id"] != own["conv_id"]:
                    if own is not None:
                        ready.append(summary())
                    own, letters, digest, any_line = r, [], hashlib.sha256(), False
                else:
                    if r["turns"] and own["turns"]:
                        own["illegal"] += own["last_initial"] + r["first_initial"] not in _PAIRS
                    if r["turns"]:
                        own["last_initial"] = r["last_initial"]
                    if r["first_turn"] is not None:
                        own["distinct_turns"] -= own["last_turn"] == r["first_turn"]
                        own["last_turn"] = r["last_turn"]
                        if own["first_turn"] is None:
                            own["first_turn"] = r["first_turn"]
                    for n in _NUMBERS:
                        own[n] += r[n]
                lines, _ = apply_plan(list(zip(r["roles"], r["texts"], strict=True)), r["audit"], r["state"])
                letters.append(r["audit"])
                for role, text in lines:
                    digest.update(f"{chr(10) if any_line else ''}{role}:{text}".encode("utf-8", "replace"))
                    any_line = True
            if ready:
                yield pa.RecordBatch.from_pylist(ready, kind)
                ready = []
        if own is not None:
            yield pa.RecordBatch.from_pylist([summary()], kind)

    one = planned.filter("whole").select(*names).mapInArrow(run, schema)
    cut = planned.filter("not whole").select("part", "segment", *names)
    lined = cut.repartition("conv_id").sortWithinPartitions("conv_id", "part", "segment").select(*names)
    return one.unionByName(lined.mapInArrow(run, schema))
