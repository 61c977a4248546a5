import random
import zlib

import numpy as np
import pytest

from millrace.llm import records

public_tokenizers = pytest.importorskip("public_tokenizers")
TEXTS = [
    "The quick brown fox, isn't it?", "", None, "   \n\t ", "Ünïcode straße İstanbul ǅ é é ﬁ 𝄞 日本語 テスト", "a\x1cb c\x1d d", "x\x01y \x01 z", "1234 56.78 --- !!! ...", "don't DON'T 's 're word's, word.",
    "<|endoftext|> and <|startoftext|>", "tab\tnew\nline\xa0nbsp em ́mark", "w" * 3000, "word " * 500, "same", "same",
]

PARTS = [
    "İ", "İ.", "a", "B", "ß", "é", "e\u0301", "ǅ", "ﬁ", "Σ", "ς", "ΑΣ", "'s", "'S", "don't", ".", ",", "!", " ", "  ", "\n", "\x01", " \x01 ", "1", "23", "<|endoftext|>",
    "<|startoftext|>", "<|EndOfText|>", "\u0307", "\u0301", "\xa0", "\u3000", "\x85", "\x1c", "日本", "\U0001f600", "\u212a", "²", "_", "hello", "World", "\u200b", "ｆｕｌｌ",
]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_are_those_of_the_library(name):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    encoder = records.WordEncoder(public_tokenizers.path(name), 2, keep=20)
    assert encoder.by_words == (name == "word_bpe_49k.json")
    choose = random.Random(4)
    made = ["".join(choose.choice(PARTS) for _ in range(choose.randint(0, 12))) for _ in range(3000)]
    for text in TEXTS * 2 + made:
        want = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        assert np.frombuffer(encoder.encode(text), encoder.kind).tolist() == want, text


def test_other_tokenizer_in_records(documents):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    (row,) = records.token_records(documents([(1, "hello big world")]), path).collect()
    ids = Tokenizer.from_file(path).encode("hello big world").ids + [2]
    assert (row.n_tokens, row.ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))


def test_round_trip(spark, documents, tokenizer):
    rows = [(7 * i % 31, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (3, "again"), (3, "again"), (2**40, "far")]
    got = records.token_records(documents(rows).withColumnRenamed("lang", "shard")).collect()
    key = lambda r: (r[0] is not None, r[0] or 0)
    want, start = [], 0
    for i, t in sorted(rows, key=lambda r: (*key(r), r[1] or "")):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in ordered] == [w[0] for w in want]
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted((str(w[0]), w[2], w[3]) for w in want)
    single = {w[0]: w for w in want if sum(v[0] == w[0] for v in want) == 1}
    assert all(tuple(r)[:4] == single[r.doc_id] for r in got if r.doc_id in single)


def test_random_access_and_damage(spark, documents, tmp_path):
    rows = [(i, f"text number {i} " * (i % 5)) for i in range(60)]
    folder = str(tmp_path / "out")
    shards = records.write_records(documents(rows), folder, public_tokenizers.path("word_bpe_49k.json"))
    assert sum(n for _, n, _ in shards) == 60
    every = {(r.shard, r.position): r for r in records.read_records(spark, folder, shards).collect()}
    shard, count, _ = shards[0]
    for position in reversed(range(count)):
        ((number, ids),) = records.read_at(folder, shard, [position])
        assert (number, len(ids)) == (every[shard, position].doc_id, every[shard, position].n_tokens)
    path = tmp_path / "out" / f"{records.shard_name(shard)}.rec"
    whole = path.read_bytes()
    for damage in (whole[:40] + bytes([whole[40] ^ 1]) + whole[41:], whole[:-3], bytes([whole[0] ^ 1]) + whole[1:]):
        path.write_bytes(damage)
        with open(path, "rb") as source, pytest.raises(ValueError):
            list(records.read_stream(source))


def test_no_rows(documents):
    assert records.token_records(documents([])).count() == 0
