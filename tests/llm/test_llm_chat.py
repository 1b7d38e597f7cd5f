import random

import pytest

from polikit.llm import chat_format as C

TURNS = "conv_id long, turn long, role string, text string"


def slow(rows, part_turns=256):
    """Every view, rendered by hand (no crowded turns)."""
    rows = [(c, t, r or "unknown", (x or "").replace("<|", "< |")) for c, t, r, x in rows]
    out = {}
    for c in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        for who in {r[2] for r in own} - {"system"}:
            for _, t, role, text in own:
                head = "<|assistant|>\n" if role == who else "<|system|>\n" if role == "system" else f"<|user:{role.replace('<|', '< |')}|>\n"
                k = (c, who, -1 if t is None else t // part_turns)
                done, spans = out.get(k, ("", []))
                done += head
                end = done + text + "<|end|>\n"
                out[k] = (end, spans + [(len(done), len(end))] * (role == who))
    return out


def conversations(seed=1):
    rng = random.Random(seed)
    rows = []
    for c in range(40):
        roles = rng.sample(["user", "assistant", "ann", "bob", "<|x"], rng.randint(1, 4))
        if c % 4 == 0:
            rows.append((c, 0, "system", "be kind"))
        rows += [(c, t + 1, rng.choice(roles), "".join(rng.choice("ab é\U0001F600<|\n") for _ in range(rng.randint(0, 30)))) for t in range(rng.randint(0, 12))]
    rows += [(100, None, None, None), (100, 1, "user", None), (100, 1, "user", "tie"), (100, 1, "ann", "tie"), (None, 3, "user", "q"),
             (None, 2, "ann", "x" * 50_000), (101, 1, "system", "only"), (102, 5, "user", "same"), (102, 5, "user", "same")]
    rows += [(200, t, "user" if t % 2 else "assistant", f"turn {t}") for t in range(1500)]  # a third of all rows
    return rows


@pytest.mark.parametrize("part", [256, 7])
def test_views_against_brute_force(spark, part):
    rows = conversations()
    df = spark.createDataFrame(rows, TURNS).selectExpr("*", "1 AS conv", "2 AS part", "3 AS piece", "4 AS assistant")
    got = C.rotate(df, part_turns=part).collect()
    assert {(r["conv_id"], r["assistant"], r["part"]): (r["text"], [tuple(s) for s in r["spans"]]) for r in got} == slow(rows, part)
    assert all(r["piece"] == 0 for r in got)
    for r in got:
        for s in r["spans"]:
            assert r["text"][:s["start"]].endswith("<|assistant|>\n") and r["text"][s["start"]:s["end"]].endswith("<|end|>\n")


def test_crowded_turns_are_split_and_whole(spark):
    rows = [(1, 0, "user", "first")] + [(1, 5, "ann" if i % 2 else "user", f"t{i}") for i in range(1000)] + [(1, 6, "user", "last")]
    got = C.rotate(spark.createDataFrame(rows, TURNS), part_turns=100).collect()
    mine = [r for r in got if r["assistant"] == "ann"]
    assert len(mine) > 5 and sum(r["n_turns"] for r in mine) == 1002 and max(r["n_turns"] for r in mine) < 250
    whole = "".join(r["text"] for r in sorted(mine, key=lambda r: (r["part"], r["piece"])))
    assert all(f"\nt{i}<|end|>" in whole for i in range(1000))


def test_joined_pieces_are_the_view(spark):
    """Several crowded turns in one part, identical rows, a null turn and a null conversation."""
    rng = random.Random(4)
    rows = [(c, t, rng.choice(["ann", "user", None, "system"]), f"t{rng.randrange(60)}")
            for c in (1, None) for t in (0, 2, 3, 3, 5, None, 12) for _ in range(rng.choice([3, 45]))]
    rows += [(1, 3, "ann", "same")] * 70 + [(1, 5, "user", "same")] * 70 + [(1, 6, "user", "last"), (2, 1, "ann", "calm")]
    rng.shuffle(rows)
    got = C.rotate(spark.createDataFrame(rows, TURNS).repartition(5), part_turns=10).collect()
    assert len({(r["conv_id"], r["assistant"], r["part"], r["piece"]) for r in got}) == len(got)
    whole = {}
    for r in sorted(got, key=lambda r: (r["part"], r["piece"])):
        text, spans = whole.get((r["conv_id"], r["assistant"], r["part"]), ("", []))
        spans = spans + [(len(text) + s["start"], len(text) + s["end"]) for s in r["spans"]]
        whole[r["conv_id"], r["assistant"], r["part"]] = (text + r["text"], spans)
    assert whole == slow(rows, 10) and max(r["piece"] for r in got) > 10


def test_empty_table(spark):
    assert C.rotate(spark.createDataFrame([], TURNS)).collect() == []
