import random

import pytest
from pyspark.sql import functions as F

from llm_helpers import CLASHES, awkward, docs, empty
from polikit.llm import language_id as L

SF = "/root/testdata/sf0.01"
LETTERS = {"en": "thehandingonerity", "de": "ßüchderdieungkeit", "fr": "éêçeauquelleoui"}


def text(rng, lang, n):
    pool = LETTERS[lang]
    return " ".join("".join(rng.choice(pool) for _ in range(rng.randint(3, 8))) for _ in range(n))


def labelled(n=300, seed=2):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(sorted(LETTERS))
        out.append((i, text(rng, lang, rng.randint(5, 50)), lang, rng.choice(["s1", "s2"]), 1))
    return out


def test_trigrams_of_letterless_texts():
    assert not len(L.trigrams(None)) and not len(L.trigrams(" 12 ,. $$")) and len(L.trigrams("é")) == 2
    assert L.trigrams("Ab, cd").tolist() == L.trigrams("ab *** CD").tolist()


def test_held_out_accuracy(spark):
    """Text alone, on documents outside the sample, with their declarations hidden."""
    df = spark.read.parquet(f"{SF}/documents.parquet")
    train, test = df.filter("doc_id % 2 = 0"), df.filter("doc_id % 2 = 1 and n_chars > 100")
    model = L.fit_text_model(train)
    got = L.identify(test, model, F.col("text"), F.lit(None).cast("string"), F.lit(None).cast("string"))
    hits = got.agg(F.avg((F.col("row.lang") == F.col("language")).cast("int"))).first()[0]
    assert hits > 0.98


def test_sample_is_bounded_and_the_fit_repeats(spark):
    df = docs(spark, labelled(900))
    a, b = (L.fit_text_model(df.repartition(n), sample_rows=100) for n in (2, 5))
    assert (a.logs == b.logs).all() and a.languages == ["de", "en", "fr", "und"]
    full = L.fit_text_model(df)
    assert (full.logs != a.logs).any()


def test_rare_languages_are_classes_beyond_the_bound(spark):
    rng = random.Random(11)
    scripts = {"el": "αβγδεζηθ", "ru": "абвгдежз", "he": "אבגדהוזח", "th": "กขคงจฉชซ", "ka": "აბგდევზთ", "hy": "աբգդեզէը"}
    rare = [(5000 + i, " ".join("".join(rng.choice(pool) for _ in range(5)) for _ in range(30)), lang, "s1", 1)
            for i, (lang, pool) in enumerate(list(scripts.items()) * 3)]
    rows = labelled(900) + rare
    df = docs(spark, rows)
    model = L.fit_text_model(df, sample_rows=100)
    assert model.languages == sorted([*LETTERS, *scripts]) + ["und"]
    copies = df.unionByName(df.filter("doc_id = 3").crossJoin(spark.range(400)).drop("id"))
    assert (L.fit_text_model(copies, sample_rows=100).logs == model.logs).all()  # copies weigh once
    got = L.identify(df, model, F.col("text"), F.col("lang"), F.col("source")).filter("row.doc_id >= 5000").collect()
    assert len(got) == len(rare) and all(r["language"] == r["row"]["lang"] for r in got)


def test_evidence_decides_short_texts(spark):
    """One ambiguous word: the declaration and the host's other pages tip it."""
    rng = random.Random(5)
    rows = [(f"http://{h}.{t}/{i}", text(rng, lang, 40), lang) for i in range(60)
            for h, t, lang in (("a.one", "de", "de"), ("b.two", "com", "en"))]
    rows += [("http://a.one.de/x", "de", None), ("http://b.two.com/x", "de", None), ("http://c.two.com/x", "de", "en")]
    df = spark.createDataFrame(rows, "url string, text string, declared string")
    model = L.fit_text_model(docs(spark, labelled()))
    got = {r["row"]["url"]: r["language"] for r in
           L.identify(df, model, F.col("text"), F.col("declared"), L.host_of(F.col("url"))).collect()}
    assert got["http://a.one.de/x"] == "de" and got["http://b.two.com/x"] == "en" and got["http://c.two.com/x"] == "en"


@pytest.mark.parametrize("clashes", [False, True])
def test_awkward_rows(spark, clashes):
    rows = awkward() + labelled()
    df = docs(spark, rows, clashes)
    model = L.fit_text_model(df)
    got = L.identify(df, model, F.col("text"), F.col("lang"), F.col("source")).collect()
    assert len(got) == len(rows)
    for r in got:
        if not len(L.trigrams(r["row"]["text"])):
            assert (r["language"], r["confidence"]) == (L.UND, 0.0)
    kept = L.keep_identified(df)
    assert kept.columns == df.columns and (not clashes or set(CLASHES) <= set(kept.columns))
    lost = [r for r in rows if not len(L.trigrams(r[1]))]
    assert len(lost) == 4 and kept.count() <= len(rows) - len(lost)
    own = {r["doc_id"] for r in kept.collect()}
    assert {r[0] for r in labelled()} <= own | {r[0] for r in lost}


def test_other_plan_gives_the_same(spark, monkeypatch):
    from polikit.llm import common
    df = docs(spark, awkward() + labelled())
    one = sorted(map(str, L.keep_identified(df).collect()))
    monkeypatch.setattr(L, "broadcast_if_small", lambda x, rows=None, limit=0: common.broadcast_if_small(x, rows, 0))
    assert sorted(map(str, L.keep_identified(df).collect())) == one


def test_empty_tables(spark):
    model = L.fit_text_model(empty(spark))
    assert model.languages == [L.UND] and L.keep_identified(empty(spark)).collect() == []
    pages = spark.createDataFrame([(1, None, None), (2, "x", ""), (None, "http://h.de/", '<HTML LANG=de><p>der die')],
                                  "page_id long, url string, html string")
    got = sorted(L.identify_pages(pages, model).collect(), key=str)
    assert [r["language"] for r in got] == ["und"] * 3 and {r["declared"] for r in got} == {None, "de"}
    assert L.identify_pages(pages.limit(0), model).collect() == []




def fused_plainly(model, rows):
    """The fusion over (text, declared, host) rows, one number at a time."""
    import math
    k = len(model.languages)
    scores = [model.likelihood(t) for t, _, _ in rows]
    by: dict[tuple, list[float]] = {}
    for (_, declared, host), (x, n) in zip(rows, scores):
        odds = [math.exp(v - max(x)) for v in x] if n else [0.0] * k
        own = by.setdefault((declared, host), [0.0] * k)
        for i in range(k):
            own[i] += odds[i] / (sum(odds) or 1)

    def summed(f):
        out: dict = {}
        for key, p in by.items():
            out[f(key)] = [a + b for a, b in zip(out.get(f(key), [0.0] * k), p)]
        return out
    label = lambda h, n: None if h is None else ".".join(h.split(".")[-n:])
    size = [sum(p[i] for p in by.values()) for i in range(k)]
    world = [(m + 1) / (sum(size) + k) for m in size]
    said, suffix = summed(lambda d: d[0]), summed(lambda d: label(d[1], 1))
    domain, hosts = summed(lambda d: label(d[1], 2)), summed(lambda d: d[1])
    out = []
    for (_, declared, host), (x, n) in zip(rows, scores):
        if not n:
            out.append((L.UND, 0.0))
            continue
        d, h, fused = domain[label(host, 2)], hosts[host], []
        for i in range(k):
            of_domain = (d[i] + L.SMOOTHING * world[i]) / (sum(d) + L.SMOOTHING)
            of_host = (h[i] + L.SMOOTHING * of_domain) / (sum(h) + L.SMOOTHING)
            fused.append(x[i] + math.log((said[declared][i] + 1) / (size[i] + L.SMOOTHING))
                         + math.log((suffix[label(host, 1)][i] + 1) / (size[i] + L.SMOOTHING)) + math.log(of_host))
        out.append((model.languages[fused.index(max(fused))], 1 / sum(math.exp(v - max(fused)) for v in fused)))
    return out


def test_posterior_against_brute_force(spark):
    rng = random.Random(21)
    rows = [(text(rng, rng.choice(sorted(LETTERS)), rng.randint(1, 6)), rng.choice(["de", "en", None]),
             rng.choice(["a.one.de", "b.one.de", "two.com", None])) for _ in range(120)] + [(None, None, None), ("12", "en", "two.com")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i long, text string, declared string, host string")
    model = L.fit_text_model(docs(spark, labelled()))
    want = fused_plainly(model, rows)
    for carried in (None, ["i"]):
        got = {r["row"]["i"]: r for r in L.identify(df, model, F.col("text"), F.col("declared"), F.col("host"), carried).collect()}
        assert [got[i]["language"] for i in range(len(rows))] == [w[0] for w in want]
        assert all(abs(got[i]["confidence"] - w[1]) < 2e-6 for i, w in enumerate(want))


def test_more_labels_than_classes(spark):
    rows = labelled(300) + [(1000 + i, "the handing", f"x{i}", "s1", 1) for i in range(300)]
    df = docs(spark, rows)
    model = L.fit_text_model(df)
    assert len(model.languages) <= L.MAX_LANGUAGES + 1 and set(LETTERS) < set(model.languages)
    assert L.identify(df, model, F.col("text"), F.col("lang"), F.col("source")).count() == 600


def test_long_texts_take_constant_memory():
    import tracemalloc

    import numpy as np
    model = L.TextModel(["a", "b", "c"], np.ones((L.BUCKETS, 3)))
    once = "Ab, cd efg ÀÉ  \n zz " * 1000
    assert np.allclose(model.likelihood(once * 40)[0], model.likelihood(once)[0], atol=1e-2)
    whole = np.concatenate(list(L.trigram_blocks(once * 40)))
    cut = np.concatenate(list(L.trigram_blocks(once * 40, 7)))
    assert (whole == cut).all()
    long = "the handing " * 1_400_000
    tracemalloc.start()
    _, n = model.likelihood(long)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n > 16_000_000 and peak < 40 << 20
