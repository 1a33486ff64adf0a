import os
import random

import pytest

from nightledger.llm import tokenizer as tk
from pyspark.sql import functions as F

pytestmark = pytest.mark.skipif(not os.path.exists(tk.DEFAULT_VOCABULARY), reason="no vocabulary files here")


@pytest.fixture(scope="module")
def ranks():
    return tk.load_ranks(tk.DEFAULT_VOCABULARY)


@pytest.fixture(scope="module")
def library(ranks):
    tiktoken = pytest.importorskip("tiktoken")
    return tiktoken.Encoding("own", pat_str=tk.PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = [
    None, "", " ", "\n\n  \t", "Hello world", "don't we'll  I'VE", "<|endoftext|> is text", "a" * 30_000, "ab" * 9_000 + " x", "naïve Ünïcödé ß 日本語 テキスト", "emoji 👩‍👩‍👧 🏳️‍🌈",
    "x y​z﻿", "\x00\x01�", "1234567890 3.14 €61,29 / 4 | 44 m²", "tabs\t\tand   spaces   \n end ",
]


def test_merge_is_the_public_one(ranks, library):
    rng = random.Random(1)
    words = [bytes(rng.choice(b"abcdeinrst \xc3\xa9") for _ in range(rng.randint(1, 60))) for _ in range(300)]
    for w in words:
        assert b"".join(library.decode_single_token_bytes(i) for i in tk.merge(w, ranks)) == w
    for text in ("unbelievably", " internationalization", " aaaaaaaaaaaaaaaa", " Zzyzxqw"):
        assert tk.merge(text.encode(), ranks) == library.encode_ordinary(text)


def test_transducer_holds_exactly_its_words(ranks, tmp_path):
    rng = random.Random(2)
    words = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 7))) + rng.choice(["ing", "ed", "s", ""]) for _ in range(3000)}
    blob = tk.Transducer.build([w.encode() for w in words], lambda w: tk.merge(w, ranks))
    (tmp_path / "t").write_bytes(blob)
    t = tk.Transducer(str(tmp_path / "t"))
    for w in words:
        assert t.ids(w.encode()) == tk.merge(w.encode(), ranks)
    for _ in range(3000):
        w = "".join(rng.choice("abcdeing") for _ in range(rng.randint(0, 9)))
        assert (t.ids(w.encode()) is not None) == (w in words)
    # endings are shared: far fewer states than a trie has
    assert int.from_bytes(blob[:8], "little") < len({w[:k] for w in words for k in range(len(w) + 1)}) / 2


@pytest.mark.parametrize("lexicon", [65_536, 3])
def test_corpus_as_the_public_encoder(spark, library, lexicon):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)] + [(1, "Hello")], "id long, text string").withColumns({"ids": F.lit("x"), "word": F.lit(1), "key": F.lit(2)})
    got = tk.encode_column(df, "id", "text", lexicon_words=lexicon).collect()
    assert sorted((r["id"], list(r["ids"])) for r in got) == sorted([(i, library.encode_ordinary(t or "")) for i, t in enumerate(TEXTS)] + [(1, library.encode_ordinary("Hello"))])


def test_empty_table(spark):
    assert tk.encode_column(spark.createDataFrame([], "id long, text string"), "id", "text").collect() == []
    only_null = spark.createDataFrame([(1, None)], "id long, text string")
    assert [tuple(r) for r in tk.encode_column(only_null, "id", "text").collect()] == [(1, [])]
