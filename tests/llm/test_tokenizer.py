import os
import random

import numpy as np
import pytest

from corpusmill.llm import tokenizer as T

PATH = f"{T.DEFAULT_DIR}/{T.DEFAULT_FILE}"
pytestmark = pytest.mark.skipif(not os.path.exists(PATH), reason="the vocabulary files aren't here")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{T.DEFAULT_DIR}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return lambda texts: [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_random_texts_as_the_library(library):
    rng = random.Random(1)
    signs = "ab'sretvlmdX 1  \n\t\xa0　.,!-é²½中​\x85\x1c🧬"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    assert T.encode_batch(texts, PATH) == library(texts)


def test_long_and_special_texts(library):
    texts = ["a" * 20_000, " " * 5_000, "é" * 3_000 + "<|endoftext|>", "!?" * 4_000, "x y " * 60_000, "it's they'll we've 'tis  's\n's", ""]
    assert T.encode_batch(texts, PATH) == library(texts)


def test_starts_do_not_depend_on_blocks():
    text = "don't  stop 's 12a\n\n " * 200
    at = T.pieces([text])[0][1]
    for pad in (1, 7, 255):
        assert T.pieces(["z" * pad, None, text])[2][1] == at
    assert T.pieces([]) == [] and T.piece_starts(np.zeros(0, np.uint32), np.zeros(0, bool)).size == 0


def test_offsets_and_round_trip(spark):
    texts = ["don't panic, ¡é!", None, "", "a  b", "a  b"]
    df = spark.createDataFrame([(i, t, [9], "clash") for i, t in enumerate(texts)], "doc_id bigint, text string, ids array<int>, _text string")
    rows = T.encode(df, offsets=True).orderBy("doc_id").collect()
    assert [T.decode(r.ids) for r in rows] == [t or "" for t in texts] and rows[1].ids == rows[2].ids == []
    for r, t in zip(rows, texts):
        assert sum(r.piece_tokens) == len(r.ids)
        at, n = [*r.piece_starts, len(t or "")], 0
        for a, b, k in zip(at, at[1:], r.piece_tokens):
            assert T.decode(r.ids[n : n + k]) == t[a:b]
            n += k
    assert [r.ids for r in T.encode(df).orderBy("doc_id").collect()] == [r.ids for r in rows]
    assert [r.n_tokens for r in T.token_counts(df).orderBy("doc_id").collect()] == [len(r.ids) for r in rows]
    assert T.encode(df.limit(0)).count() == 0


def test_cache_is_bounded():
    m = T.Merger(T.load_ranks(PATH), cache_size=10)
    want = {w: T.merger(PATH)(w) for w in (f"word{i}" for i in range(50))}
    assert all(m(w) == ids for w, ids in want.items()) and len(m.cache) <= 10
