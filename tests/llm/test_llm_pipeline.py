"""The pipeline against its stages done plainly, on a small corpus with every kind of document."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as P
from llm_helpers import DOC, awkward
from polikit.llm import decontaminate, mixing, queries, token_codes
from test_llm_decontaminate import brute
from test_llm_language_id import text
from test_llm_mixing import n_words, slow_targets
from test_llm_simhash import components, slow_fingerprint

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus(spark, folder, seed=6):
    rng = random.Random(seed)
    items = [(k, text(rng, "en", 40)) for k in range(10)]
    rows = []
    for i in range(400):
        lang = rng.choice(["en", "de", "fr"])
        own = text(rng, lang, rng.randint(20, 60))
        rows.append((i, own, lang, "hot" if i % 3 == 0 else rng.choice(["a", "b", None]), len(own)))
    base = rows[5]
    rows += [(1000 + k, base[1], *base[2:]) for k in range(150)]  # exact copies: a third of all rows
    rows += [(2000 + k, rows[k][1] + " " + rng.choice(items)[1], *rows[k][2:]) for k in range(20)]
    rows += [(3000, None, None, None, None), (3001, "", "en", "a", 0), (3002, "123 ?!", "en", "a", 6)]
    spark.createDataFrame(rows, DOC).repartition(4).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return rows, items


def test_stages_and_run(spark, scratch):
    rows, items = corpus(spark, scratch)
    docs, kept = spark.read.parquet(f"{scratch}/documents.parquet"), {}
    for name, fn in P.STAGES:
        docs = fn(spark, docs, scratch)
        docs.write.parquet(f"{scratch}/out-{name}")
        docs = spark.read.parquet(f"{scratch}/out-{name}")
        kept[name] = docs.collect()
        if name != P.STAGES[-1][0]:
            assert docs.columns == COLUMNS

    known = kept["language_id"]
    assert {r["doc_id"] for r in known} == {r[0] for r in rows} - {3000, 3001, 3002}

    group = components([slow_fingerprint(r["text"]) for r in known], 2)
    first = {}
    for r in known:
        g = group[slow_fingerprint(r["text"])]
        first[g] = min(first.get(g, r["doc_id"]), r["doc_id"])
    single = kept["simhash_near_dedup"]
    assert sorted(r["doc_id"] for r in single) == sorted(first.values())

    dirty = {i for i, _ in brute([tuple(r) for r in single], items)}
    clean = kept["decontamination"]
    assert len(dirty) >= 15 and {r["doc_id"] for r in clean} == {r["doc_id"] for r in single} - dirty

    sizes, taken = {}, {}
    for r in clean:
        sizes[r["source"]] = sizes.get(r["source"], 0) + n_words(r["text"])
    for r in kept["mixing"]:
        taken[r["source"]] = taken.get(r["source"], 0) + n_words(r["text"])
    for s, target in slow_targets(sizes).items():
        assert abs(taken.get(s, 0) - target) <= 60

    enc = token_codes.WordEncoder(queries.tokenizer_path())
    want = []
    for r in kept["mixing"]:
        ids = np.append(enc.whole(r["text"].encode()), 1).astype("<u4")
        want.append((r["doc_id"], len(ids), zlib.crc32(ids.tobytes())))
    last = sorted(kept["token_codes"], key=lambda r: r["start"])
    assert sorted((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in last) == sorted(want)
    assert [r["doc_id"] for r in last] == sorted(r["doc_id"] for r in last)

    whole = P.run(spark, scratch).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, whole)) == sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in last)


def test_every_stage_takes_awkward_and_empty_documents(spark, scratch):
    spark.createDataFrame([(1, "a b c d e f g h i j k l m n o p")], "item_id long, text string").write.parquet(
        f"{scratch}/benchmark.parquet")
    odd = spark.createDataFrame(awkward(), DOC)
    for docs in (odd, odd.limit(0)):
        for name, fn in P.STAGES:
            out = fn(spark, docs, scratch)
            assert out.count() <= 2 * docs.count(), name
            if name != P.STAGES[-1][0]:
                assert out.columns == COLUMNS
    out = decontaminate.drop_contaminated(odd, spark.read.parquet(f"{scratch}/benchmark.parquet"))
    assert out.count() == odd.count() and mixing.mixed(odd).agg(F.count("*")).first()[0] > 0
