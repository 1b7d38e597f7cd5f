import random
import re

import pytest

from llm_helpers import awkward, docs, empty, words
from polikit.llm import license_scan as L


def w(text):
    return [x for x in re.split(r"[^\w]+|_", (text or "").lower()) if x]


def shingles(tokens):
    return {tuple(tokens[i:i + 5]) for i in range(len(tokens) - 4)}


def brute(rows):
    """Licenses of which a window holds four fifths of each chunk that counts, by exact containment."""
    out = set()
    for i, text, *_ in rows:
        d = w(text)
        for name, t in L.TEMPLATES:
            b = w(t)
            held, total = 0, 0
            for at in range(0, max(1, len(b) - 4), L.CLASSES[-1] - 4):
                part = b[at:at + L.CLASSES[-1]]
                if len(part) < 5:
                    continue
                size = min(c for c in L.CLASSES if len(part) <= c)
                want = shingles(part)
                total += len(want)
                best = max((len(want & shingles(d[s:s + size + size // 4])) for s in range(0, max(1, len(d) - 4), size // 4)), default=0)
                held += best if best >= 0.8 * len(want) - 1e-9 else 0
            if held >= 0.8 * total - 1e-9:
                out.add((i, name))
    return out


def planted(seed=2):
    rng = random.Random(seed)
    rows = awkward()
    for n in range(120):
        part = rng.choice(L.TEMPLATES)[1].split()
        if n % 3 == 1 and len(part) > 12:
            part[rng.randrange(len(part))] = "zzz"
        if n % 3 == 2:
            part = [p.upper() for p in part]
        rows.append((1000 + n, " ".join(words(rng, rng.randint(0, 90)) + part + words(rng, rng.randint(0, 90))), "en", "a", 1))
    return rows


def test_against_brute_force(spark):
    rows = planted() + [(9000, "Released under the MIT License. " * 3, None, None, None), (None, "Licensed under CC BY-NC 4.0.", "", "", 1)]
    got = L.scan(docs(spark, rows, clashes=True)).collect()
    pairs = {(r["doc_id"], r["license"]) for r in got}
    assert pairs == brute(rows) and len(pairs) == len(got) and len(pairs) > 80
    assert all(0.8 <= r["containment"] <= 1 for r in got)


def test_long_templates_in_chunks(spark):
    rng = random.Random(8)
    long = words(rng, 300)
    near = [x if k % 60 else "zzz" for k, x in enumerate(long)]
    rows = [(1, " ".join(words(rng, 50) + long), "", "", 1), (2, " ".join(near + words(rng, 50)), "", "", 1),
            (3, " ".join(long[:150]), "", "", 1), (4, " ".join(words(rng, 300)), "", "", 1)]
    got = {r["doc_id"]: r["containment"] for r in L.scan(docs(spark, rows), [("X", " ".join(long))]).collect()}
    assert set(got) == {1, 2} and got[1] == 1.0 > got[2] >= 0.8


def test_many_templates_are_scanned_in_groups(spark, monkeypatch):
    """More shingles than one scan holds, bodies of several chunks among them, and one template beyond the bound."""
    rng = random.Random(12)
    templates = [(f"L{i % 40}", " ".join(words(rng, rng.choice([6, 12, 30, 150])))) for i in range(60)]
    rows = [(i, " ".join(words(rng, 20)) + " " + rng.choice(templates)[1] + " " + " ".join(words(rng, 20)), "", "", 1) for i in range(40)]
    rows += [rows[0], (None, templates[3][1], None, None, None)]
    df = docs(spark, rows)
    want = sorted(map(tuple, L.scan(df, templates).collect()), key=str)
    monkeypatch.setattr(L, "MAX_SHINGLES", 1000)
    assert sorted(map(tuple, L.scan(df, templates).collect()), key=str) == want and len(want) >= 41
    assert L.scan(df, []).collect() == []


def test_bodies(spark):
    bodies = [(i, f"Copyright (c) {i}\n{t}", "", "", 1) for i, (_, t) in enumerate(L.TEMPLATES) if len(w(t)) > 80]
    got = {(r["doc_id"], r["license"]) for r in L.scan(docs(spark, bodies)).collect()}
    assert {(i, L.TEMPLATES[i][0]) for i, *_ in bodies} <= got and len(bodies) == 3


def test_bands_keep_the_promise():
    for size in L.CLASSES:
        assert 0 < L.bands(size) < 200 and L.bands(size, miss=1e-3) < L.bands(size)


def test_refused_and_empty(spark):
    assert L.scan(empty(spark)).collect() == []
    with pytest.raises(ValueError):
        L.scan(docs(spark), [("X", "too short")])
