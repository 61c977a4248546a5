import collections
import zlib

import numpy as np
import pytest

import corpus_pipeline
from millrace.llm import decontaminate, quality, simhash
from millrace.llm import queries as llm
from millrace.session import scratch, shared_folder

public_tokenizers = pytest.importorskip("public_tokenizers")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
WORDS = "the of and to in is that for it as was with be by on not he his but at are this have from".split()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A small corpus with junk, copies, a benchmark passage, odd rows and an extra column."""
    folder = tmp_path_factory.mktemp("corpus")
    random = np.random.default_rng(8)
    rows, labels = [], []
    item = " ".join(f"item{i} {w}" for i, w in enumerate(WORDS))
    for i in range(240):
        text = " ".join(random.choice(WORDS, 60).tolist()) + f" u{i}."
        junk = i % 6 == 0
        if junk:
            text = text.upper().replace(" ", "!! ")
        if i % 20 == 7:
            text = rows[-1][1]
        if i % 40 == 9:
            text = f"{text} {item}"
        rows.append((i, text, "en" if i % 3 else "de", f"src{i % 6}", len(text)))
        labels.append((i, int(not junk), 0))
    rows += [(500, None, "en", "src1", 0), (501, "", None, "src1", 0), (502, "short one", "en", None, 9)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_every_stage_on_its_own_input(spark, tables):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{tables}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.materialise(stage(spark, docs, tables), name)
        seen[name] = ([tuple(r) for r in docs.collect()], [tuple(r) for r in out.collect()])
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == COLUMNS
        docs = out
    before, after = seen["quality"]
    scores = {r.doc_id: r.predicted for r in quality.digest(spark.read.parquet(f"{tables}/documents.parquet"), spark.read.parquet(f"{tables}/labels.parquet")).collect()}
    assert sorted(map(repr, after)) == sorted(repr(r) for r in before if scores[r[0]])
    kept = {r[0] for r in after}
    assert not kept & {i for i in range(0, 240, 6) if i % 20 != 7} and len(kept) >= 195
    before, after = seen["near_copies"]
    prints = {r[0]: simhash.fingerprint(r[1]) for r in before}
    first = []
    for i in sorted(prints):
        group = {i}
        while True:
            more = {j for j in prints for g in group if (prints[j] ^ prints[g]).bit_count() <= 3}
            if more == group:
                break
            group = more
        first.append(min(group))
    assert sorted(r[0] for r in after) == sorted(set(first)) and len(after) < len(before)
    before, after = seen["decontaminate"]
    item = decontaminate.Automaton([("1", decontaminate.words_of(" ".join(f"item{i} {w}" for i, w in enumerate(WORDS))))], 13)
    clean = []
    for r in before:
        words = decontaminate.words_of(r[1])
        hits = sum(b - a for a, b in item.spans(words)[0])
        if not (hits and 20 * hits >= len(words)):
            clean.append(r)
    assert sorted(map(repr, after)) == sorted(map(repr, clean)) and len(clean) < len(before)
    before, after = seen["mix"]
    assert set(after) <= set(before) and max(collections.Counter(after).values()) <= 2
    before, after = seen["tokens"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = [(r[0], np.array([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 2], "<u4")) for r in sorted(before, key=lambda r: r[0])]
    starts = np.cumsum([0, *[len(ids) for _, ids in want]])
    assert sorted(t[:4] for t in after) == sorted((i, int(s), len(ids), zlib.crc32(ids.tobytes())) for (i, ids), s in zip(want, starts))
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, tables).collect()) == sorted(after)


def test_names():
    assert {n.split("_")[0] for n in llm.QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(llm.ORACLES) <= set(llm.QUERIES) and len(corpus_pipeline.STAGES) == 5


def test_a_scratch_block_leaves_only_results(spark, tables, tmp_path):
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/millrace")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = lambda: sorted(s.getPath().getName() for s in files.listStatus(path)) if files.exists(path) else []
    before = names()
    with scratch(spark):
        corpus_pipeline.run(spark, tables).write.parquet(str(tmp_path / "out"))
    assert names() == before and spark.read.parquet(str(tmp_path / "out")).count() > 0


def test_odd_rows_and_columns(spark, tables, tmp_path):
    text = "the of and to in is that for it as was with be by on not he his but at"
    odd = [(None, text, None, None, 1), (None, text, None, None, 1), (7001, None, None, None, None), (7001, "", "xx", "web", 0), (7002, "word " * 60_000, "en", "src1", 5)]
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    more = docs.unionByName(spark.createDataFrame(odd, docs.schema)).selectExpr("*", "1 AS row", "'x' AS found", "2 AS epoch", "3 AS score", "4 AS component_id", "5 AS tokens")
    names = more.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, more, tables)
        if name == "tokens":
            assert out.count() == more.count()
            break
        more = corpus_pipeline.materialise(out, name)
        assert more.columns == names


def test_empty_tables_pass_every_stage(spark, tables, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{tables}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
