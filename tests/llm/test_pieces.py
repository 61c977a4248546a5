import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import pieces

public_tokenizers = pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "", None, " ", "  ", "hello  world ", "<s> a </s>", "<unk> <0x41>", "a\n\tb", "▁", "▁▁a ▁b", "\x00a", "日本語\U0001f600", "ﬁ é", "a\n\n b \n  c", "� x",
    "a" * 1000, "ab" * 3000, " " * 500 + "x" + " " * 17, "\n", "a\n", " \n ", "x\xa0y　z  ", "same", "same", "The quick brown fox, isn't it? 12.5%",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def same(encoder, library, texts):
    flat, ends = encoder.encode(texts)
    back = encoder.pieces.decode(flat, ends)
    for text, a, b, decoded in zip(texts, ends[:-1], ends[1:], back):
        want = library.encode(text or "")
        assert flat[a:b].tolist() == want, text
        assert decoded == library.decode(want), text


def test_ids_and_texts_are_those_of_the_library(library):
    encoder, choose = pieces.Encoder(PATH, keep=500), random.Random(1)
    same(encoder, library, TEXTS)
    letters = ["a", "b", "e", "t", "th", "in", "er", " ", "  ", "▁", "\n", "é", "日", "，", "\U0001f600", "1", ".", "'", "ing", "tion", "    ", "\t", "ا"]
    known = [library.id_to_piece(i).replace("▁", " ") for i in range(259, 32000)]
    for _ in range(15):
        same(encoder, library, ["".join(choose.choice(letters) for _ in range(choose.randint(0, 60))) for _ in range(100)])
        same(encoder, library, ["".join(choose.choice(known) for _ in range(choose.randint(1, 30))) for _ in range(100)])
        codes = lambda: choose.choice([choose.randint(32, 126), choose.randint(0, 0x2FFF), choose.randint(0x10000, 0x1FFFF)])
        same(encoder, library, ["".join(chr(codes()) for _ in range(choose.randint(0, 30))) for _ in range(50)])


def test_long_texts_without_words(library):
    encoder, choose = pieces.Encoder(PATH), random.Random(2)
    for text in (" " * 30_000, "a" * 30_000, "ab" * 15_000, "".join(choose.choice("abcdefgh") for _ in range(30_000)), "word " * 50_000):
        same(encoder, library, [text])


def test_any_ids_are_decoded_as_the_library_does(library):
    own, choose = pieces.Pieces(PATH), random.Random(3)
    rows = [
        [choose.choice([choose.randint(0, 300), choose.randint(0, 31999), choose.choice([0, 1, 2, 259, 28705])]) for _ in range(choose.randint(0, 12))]
        for _ in range(3000)
    ]
    got = own.decode(np.array([i for r in rows for i in r], np.int32), np.cumsum([0, *map(len, rows)]))
    for row, text in zip(rows, got):
        assert text == library.decode(row), row


def test_query_rows(documents, library):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (3, "again"), (3, "again")]
    docs = documents(rows).withColumn("n_tokens", F.lit("clash")).withColumn("decoded", F.lit(1))
    got = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in pieces.digest(docs).collect())
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    ids = [(i, library.encode(t or "")) for i, t in rows]
    assert got == sorted((str(i), len(n), sha(",".join(map(str, n))), sha(library.decode(n))) for i, n in ids)
    assert pieces.digest(documents([])).count() == 0


def test_other_columns_stay_and_clashes_are_refused(documents):
    docs = documents([(1, "a b"), (2, None)])
    ids = pieces.encode(docs, PATH)
    assert ids.columns == ["doc_id", "ids", "lang", "source", "n_chars"]
    back = pieces.decode(ids.withColumn("ids", F.when(F.col("doc_id") == 1, F.col("ids"))), PATH, text="out").collect()
    assert {(r.doc_id, r.out, r.lang) for r in back} == {(1, "a b", "en"), (2, "", "en")}
    with pytest.raises(ValueError):
        pieces.encode(docs, PATH, ids="LANG")
    with pytest.raises(ValueError):
        pieces.decode(ids, PATH, text="ids")
