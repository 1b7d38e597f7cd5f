import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_helpers import awkward, docs, empty
from polikit.llm import queries
from polikit.llm import token_codes as K

PATH = queries.tokenizer_path()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2 ** 32 - 1) | st.integers(0, 300), max_size=2000), st.data())
def test_round_trip_and_access(ids, data):
    a = np.array(ids, dtype=np.uint32)
    codes = K.encode(a)
    assert (K.decode(codes) == a).all()
    if ids:
        at = np.array(data.draw(st.lists(st.integers(0, len(ids) - 1), min_size=1, max_size=50)))
        assert (K.access(codes, at) == a[at]).all()


def test_rank_directory_at_its_borders():
    for n in (511, 512, 513, 1024, 5000):
        a = np.arange(n, dtype=np.uint32) * 97 % 70_000
        assert (K.access(K.encode(a), np.arange(n)) == a).all()


def test_word_encoder_gives_the_ids_of_whole_texts():
    enc = K.WordEncoder(PATH, remembered=200)
    rng = random.Random(4)
    pool = [*"abcXYZéÉßñÑüçİıΣς'’“”.,!?-_()<>|*#%&$0129\t\n ̸́中д٣\U0001F600\x1c\x85\x00",
            "'s", "'re", "don't", "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", " ", " ", " "]
    for _ in range(6000):
        text = "".join(rng.choice(pool) for _ in range(rng.randint(0, 16))).encode()
        assert enc(text).tolist() == enc.whole(text).tolist(), text
    assert len(enc.words) <= 200 + 20 and len(enc.cores) <= 200 + 20


def expected(rows):
    """(doc_id, n_tokens, crc) in order of id, null first, with the start."""
    enc = K.WordEncoder(PATH)
    out = []
    for r in rows:
        ids = np.concatenate((enc.whole((r[1] or "").encode()), [1])).astype("<u4")
        out.append((r[0], len(ids), zlib.crc32(ids.tobytes())))
    return out


@pytest.mark.parametrize("clashes", [False, True])
def test_digests(spark, clashes):
    files = K.write_codes(docs(spark, clashes=clashes), PATH, segment_ids=500)
    got = sorted(K.read_digests(files).collect(), key=lambda r: r["start"])
    assert sorted(((r[0], r[2], r[3]) for r in got), key=str) == sorted(expected(awkward()), key=str)
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    ids = [r["doc_id"] for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))


def test_whole_texts_give_the_same_files(spark):
    a = K.read_digests(K.write_codes(docs(spark), PATH)).collect()
    b = K.read_digests(K.write_codes(docs(spark), PATH, whole_texts=True)).collect()
    assert sorted(map(str, a)) == sorted(map(str, b))


def test_tokens_at(spark):
    rows = [r for r in awkward() if r[0] is not None]
    files = K.write_codes(docs(spark, rows), PATH, segment_ids=700)
    enc = K.WordEncoder(PATH)
    digest = sorted(K.read_digests(files).collect(), key=lambda r: r["start"])
    texts = {}
    for r in rows:
        texts.setdefault(r[0], r[1])
    whole = np.concatenate([np.append(enc.whole((texts[r["doc_id"]] or "").encode()), 1) for r in digest])
    asked = [0, 1, 5, 699, 700, 701, len(whole) - 1, len(whole), 10 ** 9]
    got = K.tokens_at(files, spark.createDataFrame([(p,) for p in asked], "position long"), block=256).collect()
    assert {r["position"]: r["token_id"] for r in got} == {p: int(whole[p]) for p in asked if p < len(whole)}


def test_empty_table(spark):
    assert K.read_digests(K.write_codes(empty(spark), PATH)).collect() == []
