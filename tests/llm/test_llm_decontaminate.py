import random
import re
from itertools import combinations

import pytest

from llm_helpers import CLASHES, awkward, docs, empty, words
from polikit.llm import decontaminate as D

BENCH = "item_id long, text string"


def w(text):
    return [x for x in re.split(r"[^\w]+|_", (text or "").lower()) if x]


def brute(doc_rows, items, window=D.WINDOW, agree=D.AGREE):
    """Every document and item with a seed hit on a diagonal that verifies, by comparing all places."""
    out = set()
    for i, text, *_ in doc_rows:
        d = w(text)
        for item, t in items:
            b = w(t)
            masks = [m for m in D.MASKS]
            spots = {p - q for m in masks for p in range(0, len(d) - len(m) + 1, D.STRIDE) for q in range(len(b) - len(m) + 1)
                     if all(d[p + k] == b[q + k] for k, c in enumerate(m) if c == "1")}
            if 0 < len(b) < max(map(len, D.MASKS)):
                spots |= {p for p in range(len(d) - len(b) + 1) if d[p:p + len(b)] == b}
            size = min(len(b), window)
            for s in spots:
                same = [int(0 <= q + s < len(d) and d[q + s] == b[q]) for q in range(len(b))]
                inside = [q for q in range(len(b)) if 0 <= q + s < len(d)]
                if inside and len(inside) >= size:
                    lo, hi = inside[0], inside[-1] + 1
                    if any(sum(same[k:k + size]) >= -(-size * 8 // 10) for k in range(lo, hi - size + 1)):
                        out.add((i, item))
    return out


def planted(seed=3):
    rng = random.Random(seed)
    items = [(k, " ".join(words(rng, rng.choice([4, 9, 14, 20, 45])))) for k in range(30)]
    rows = awkward()
    for n in range(60):
        item = rng.choice(items)
        part = item[1].split()
        kind = n % 4
        if kind == 1 and len(part) > 14:  # substitutions
            for _ in range(len(part) // 10):
                part[rng.randrange(len(part))] = "zzz"
        if kind == 2:
            part = [p.upper() + "," for p in part]
        if kind == 3 and len(part) > 30:  # a word left out
            del part[15]
        rows.append((1000 + n, " ".join(words(rng, rng.randint(0, 80)) + part + words(rng, rng.randint(0, 80))), "en", "a", 1))
    return rows, items


def test_against_brute_force(spark):
    rows, items = planted()
    got = D.contaminated(docs(spark, rows, clashes=True), spark.createDataFrame(items, BENCH)).collect()
    pairs = {(r["doc_id"], r["item_id"]) for r in got}
    assert pairs == brute(rows, items) and len(got) == len(pairs)
    assert len(pairs) >= 55  # all but a few of the changed ones are caught
    for r in got:
        d, b = w({x[0]: x[1] for x in rows}[r["doc_id"]]), w(dict(items)[r["item_id"]])
        size = min(len(b), D.WINDOW)
        here = d[r["start"]:r["start"] + size]
        assert r["window"] == size and r["matched"] == max(
            sum(x == y for x, y in zip(here, b[q:q + size])) for q in range(len(b) - size + 1))


def test_other_plans_give_the_same(spark, monkeypatch):
    from polikit.llm import common
    rows, items = planted()
    bench = spark.createDataFrame(items, BENCH)
    small = sorted(map(tuple, D.contaminated(docs(spark, rows), bench).collect()))
    monkeypatch.setattr(D, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(D, "broadcast_if_small", lambda df, rows=None, limit=0: common.broadcast_if_small(df, rows, 0))
    assert sorted(map(tuple, D.contaminated(docs(spark, rows), bench).collect())) == small


def test_drop(spark):
    rows, items = planted()
    rows = rows + [rows[-1], (None, rows[-1][1], None, None, None), (5000, None, None, None, None)]
    dirty = {k for k, _ in brute([(k, r[1]) for k, r in enumerate(rows)], items)}
    df = docs(spark, rows, clashes=True)
    out = D.drop_contaminated(df, spark.createDataFrame(items, BENCH))
    assert out.columns == df.columns and set(CLASHES) <= set(out.columns)
    left = sorted((r["doc_id"] for r in out.collect()), key=str)
    assert left == sorted((r[0] for k, r in enumerate(rows) if k not in dirty), key=str)


def test_empty_tables_and_items(spark):
    none = spark.createDataFrame([], BENCH)
    odd = spark.createDataFrame([(None, None), (1, ""), (2, " ,. "), (None, "a b c d e f g h i j k l m n")], BENCH)
    assert D.contaminated(docs(spark), none).collect() == []
    assert D.contaminated(empty(spark), odd).collect() == []
    assert D.contaminated(docs(spark), odd).collect() == []
    assert D.drop_contaminated(docs(spark), none).count() == len(awkward())


def test_every_overlap_that_verifies_is_found(spark):
    """Against the word check alone on every diagonal, without masks: each way to substitute as many
    words as verification accepts, copies starting at even and odd words."""
    rng = random.Random(7)
    items, rows, wanted = [], [], {}
    for n in (1, 3, 5, 6, 8, 9, 10, 11, 12, 13, 15):
        item = [f"w{n}x{k}" for k in range(n)]
        items.append((n, " ".join(item)))
        size = min(n, D.WINDOW)
        wrong = size - -(-size * 8 // 10)
        for at, places in enumerate([*combinations(range(size), wrong)] * 2):
            part = ["zzz" if k in places else x for k, x in enumerate(item[:size])]
            before = words(rng, at % 2 + (at // 2) % 4)
            rows.append((len(rows), " ".join(before + part + words(rng, 3)), "en", "a", 1))
            wanted[len(rows) - 1] = (n, size - wrong, size, len(before))
    got = {}
    for r in D.contaminated(docs(spark, rows), spark.createDataFrame(items, BENCH)).collect():
        got[r["doc_id"]] = (r["item_id"], r["matched"], r["window"], r["start"])
    assert got == wanted


def test_masks_are_complete_for_other_windows():
    for n, wrong in ((13, 2), (13, 4), (20, 4), (60, 12), (9, 0)):
        found = [*D.MASKS, *D.more_masks(n, wrong, D.MASKS)]
        rng = random.Random(n)
        for _ in range(300):
            bad = set(rng.sample(range(n), wrong))
            assert any(all(c == "0" or i + k not in bad for k, c in enumerate(m)) for m in found for i in range(n - len(m) + 1))
    assert D.more_masks(D.WINDOW, 2, D.MASKS) == []


def test_ids_with_names_of_the_operators_own_columns(spark):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    for name in ("id", "tie", "h", "pos", "seed", "spots"):
        df = spark.createDataFrame([(5, f"said {item} today"), (6, "nothing of it")], f"{name} long, text string")
        assert [r[0] for r in D.contaminated(df, items, id_col=name).select(name).collect()] == [5]
        assert [r[0] for r in D.drop_contaminated(df, items, id_col=name).collect()] == [6]
    with pytest.raises(ValueError, match="item_id"):
        D.contaminated(spark.createDataFrame([(5, item)], "item_id long, text string"), items, id_col="item_id")
