"""Conversation repair against every edit plan, cut conversations, awkward rows."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from polikit.llm import dialogue_repair as R

SF = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string"
LEGAL = re.compile(r"(s?(ua)+)?")
NAMES = {"u": "user", "a": "assistant"}


def plain_damage(rows):
    """The rows after damage, by conversation, in order."""
    out = {}
    for conv, turn, role, text in rows:
        own = out.setdefault(conv, [])
        say = lambda x: " " if x is None else str(x)
        role, text = say(role), say(text)
        kind = zlib.crc32(f"{say(conv)}:{say(turn)}".encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        own += [(turn, role, text)] * (2 if kind == 3 else 1)
    for own in out.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    return out


def plain_faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        body = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def every_plan(rows, faults, inserts):
    """(cost, letters, result) of all legal plans with at most ``inserts`` insertions."""
    choices = []
    for (_, role, text), fault in zip(rows, faults, strict=True):
        own = [("D", 3, None)]
        if fault not in ("blank", "duplicate"):
            extra = fault == "truncated"
            own.append(("K", extra, (role, text)))
            own += [("R", 2 + extra, (NAMES[x], text)) for x in "ua"]
        choices.append(own)
    for n in range(inserts + 1):
        for places in itertools.combinations_with_replacement(range(len(rows) + 1), n):
            for new in itertools.product("ua", repeat=n):
                for plan in itertools.product(*choices):
                    letters, cost, result = "", 0, []
                    for i in range(len(rows) + 1):
                        for p, x in zip(places, new):
                            if p == i:
                                letters, cost = letters + "I", cost + 2
                                result.append((NAMES[x], ""))
                        if i < len(rows):
                            letter, c, row = plan[i]
                            letters, cost = letters + letter, cost + c
                            if row:
                                result.append(row)
                    if LEGAL.fullmatch("".join(role[:1] or "-" for role, _ in result)):
                        yield cost, letters, result


def plain_best(rows, faults):
    """By dynamic programming over whole letters, plans compared as (cost, letters); insertions singly."""
    best = {0: (0, "", ())}
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}

    def grow(found):
        for _ in range(4):
            for state, (cost, letters, result) in list(found.items()):
                for x in "ua":
                    to = step.get((state, x))
                    new = (cost + 2, letters + "I", (*result, (NAMES[x], "")))
                    if to is not None and (to not in found or new < found[to]):
                        found[to] = new
        return found
    # all plans so far are kept by (state), which suffices as later letters do not depend on earlier ones
    for (_, role, text), fault in zip(rows, faults, strict=True):
        then = {}

        def offer(state, new):
            if state is not None and (state not in then or new[:2] < then[state][:2]):
                then[state] = new
        for state, (cost, letters, result) in grow(best).items():
            offer(state, (cost + 3, letters + "D", result))
            if fault not in ("blank", "duplicate"):
                extra = int(fault == "truncated")
                offer(step.get((state, role[:1])), (cost + extra, letters + "K", (*result, (role, text))))
                for x in "ua":
                    offer(step.get((state, x)), (cost + 2 + extra, letters + "R", (*result, (NAMES[x], text))))
        best = then
    return min(x for state, x in grow(best).items() if state in (0, 3))


def plain_summary(rows, plan):
    faults = plain_faults(rows)
    turns = [t for t, _, _ in rows if t is not None]
    initials = [role[:1] for _, role, _ in rows]
    cost, letters, result = plan
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, letters,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in result).encode()).hexdigest())


FIELDS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def summarised(spark, rows, **sizes):
    got = R.summaries(R.repair(R.damaged(spark.createDataFrame(rows, SCHEMA)), **sizes)).collect()
    assert len({r["conv_id"] for r in got}) == len(got)
    return {r["conv_id"]: tuple(r[f] for f in FIELDS) for r in got}


def wanted(rows):
    return {conv: plain_summary(own, plain_best(own, plain_faults(own))) for conv, own in plain_damage(rows).items()}


def test_segment_plans_against_all_plans():
    rng = random.Random(3)
    for _ in range(150):
        n = rng.randint(0, 4)
        rows = [(i, rng.choice(["user", "assistant", "system", "tool", "", "ubuntu"]), rng.choice(["a.", "b", " "])) for i in range(n)]
        faults = plain_faults(rows)
        want = min(every_plan(rows, faults, 3), key=lambda p: (p[0], p[1]))
        codes = [("", "blank", "duplicate", "truncated").index(f) for f in faults]
        got = R.best_plans([(r[1], f) for r, f in zip(rows, codes)], None)[0]
        assert got == want[:2]
        assert R.apply_plan([r[1:] for r in rows], got[1], 0)[0] == want[2]
        assert plain_best(rows, faults)[:2] == want[:2]


def talks(seed, convs=60, longest=14):
    rng = random.Random(seed)
    out = []
    for c in range(convs):
        for t in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant"] * 4 + ["system", "tool", None, ""])
            text = rng.choice(["Yes.", "No", "ok?", None, "", " \t", "Ä é.", f"t{rng.random()}.", f"line\nbreak {t}"])
            out.append((c, rng.choice([t, t, t, t + 3, None]), role, text))
    return out


def test_against_plain_plans(spark):
    rows = talks(5)
    assert summarised(spark, rows) == wanted(rows)


@pytest.mark.parametrize("size", [1, 3])
def test_conversations_cut_in_segments(spark, size):
    """Segments far shorter than conversations, and one that holds a third of all rows."""
    rows = talks(6, 30) + [(7, 100 + i, ("user", "assistant")[i % 2 if i % 7 else 0], f"{i}." if i % 5 else "same.") for i in range(120)]
    assert summarised(spark, rows, size=size, size_chars=40) == wanted(rows)


def test_repaired_rows_are_legal_and_digest_alike(spark):
    planned = R.repair(R.damaged(spark.createDataFrame(talks(8), SCHEMA)), size=4)
    lines = {}
    for r in sorted(R.repaired(planned).collect(), key=lambda r: (r["conv_id"], r["part"], r["segment"], r["line"])):
        lines.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    for r in R.summaries(planned).collect():
        own = lines.get(r["conv_id"], [])
        assert LEGAL.fullmatch("".join(role[:1] for role, _ in own))
        assert hashlib.sha256("\n".join(f"{a}:{b}" for a, b in own).encode()).hexdigest() == r["repaired_sha256"]


def test_awkward_rows(spark):
    long = "word " * 60_000 + "end."
    rows = [(None, None, None, None), (None, 3, "user", "Hi."), (None, 3, "user", "Hi."), (1, None, "user", "a."), (1, None, "user", "b."),
            (2, 5, "user", long), (2, 6, "assistant", long), (3, 0, None, None), (4, 1, "user", ""), (5, 2, "assistant", "x")]
    rows += [(6, 1, "user", "Again.")] * 700 + [(6, 2, "assistant", "Again.")] * 300
    got = summarised(spark, rows, size=50)
    assert got == wanted(rows) and got[None][0] in (0, -0)
    extra = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS part", "'x' AS state", "2 AS segment", "'y' AS audit", "9 AS copies")
    again = R.summaries(R.repair(R.damaged(extra), size=50)).collect()
    assert {r["conv_id"]: tuple(r[f] for f in FIELDS) for r in again} == got


def test_conversations_that_lose_all_rows(spark):
    gone = [(c, 0, "user", "Hi.") for c in range(4000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:5]
    empty = hashlib.sha256(b"").hexdigest()
    got = summarised(spark, gone)
    assert len(got) == 5 and set(got.values()) == {(0, 0, 0, 0, 0, 0, "", empty)}
    assert summarised(spark, []) == {}


def test_whole_table(spark):
    from polikit.llm import queries
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    want = wanted([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])
    got = {r["conv_id"]: tuple(r[f] for f in FIELDS) for r in queries.QUERIES["op11_dialogue_repair"](spark, SF).collect()}
    assert got == want
