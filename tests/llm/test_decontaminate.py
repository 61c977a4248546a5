import hashlib
import random

import pytest

from millrace.llm import decontaminate as dec

ITEMS = "item_id long, text string, extra string"


def words(text):
    out, word = [], ""
    for c in (text or "") + " ":
        c = chr(ord(c) + 32) if "A" <= c <= "Z" else c
        if "0" <= c <= "9" or "a" <= c <= "z" or ord(c) > 127:
            word += c
        else:
            out, word = out + [word] if word else out, ""
    return out


def slow(text, items, window=13):
    doc, hit, names = words(text), set(), set()
    for name, item in items:
        item = words(item)
        size = min(window, len(item))
        grams = {tuple(item[i : i + size]) for i in range(len(item) - size + 1)} if item else set()
        for at in range(len(doc) - size + 1):
            if tuple(doc[at : at + size]) in grams:
                hit |= set(range(at, at + size))
                names.add("null" if name is None else str(name))
    return len(doc), hit, names


def corpus(seed):
    rnd = random.Random(seed)
    vocabulary = ["a", "B", "c1", "ü", "d", "e"]
    items = [(i % 9, " ".join(rnd.choices(vocabulary, k=rnd.choice([1, 2, 4, 5, 7, 9])))) for i in range(12)] + [(None, "Zz, zz! zz"), (77, None), (78, "..."), (10, "zz a")]
    docs = [(i, rnd.choice([" ", ", ", "\n"]).join(rnd.choices([*vocabulary, "zz"], k=rnd.randint(0, 60)))) for i in range(40)]
    return docs + [(40, None), (41, ""), (41, ""), (None, "a b zz zz zz")], items


@pytest.mark.parametrize("seed,block", [(0, 500_000), (1, 10), (2, 25)])
def test_against_all_windows(spark, documents, seed, block, monkeypatch):
    docs, items = corpus(seed)
    monkeypatch.setattr(dec.match_items, "__defaults__", (*dec.match_items.__defaults__[:-1], block))
    frame = spark.createDataFrame([(*i, "x") for i in items], ITEMS)
    got = sorted(tuple(map(str, r)) for r in dec.digest(documents(docs), frame, window=4).collect())
    want = []
    for i, text in docs:
        n, hit, names = slow(text, items, 4)
        listed = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        want.append(tuple(map(str, (i, n, len(hit), len(names), listed, len(hit) > 0 and 20 * len(hit) >= n))))
    assert got == sorted(want)


def test_long_items_and_texts():
    rnd = random.Random(4)
    items = [(str(i), words(" ".join(f"w{rnd.randint(0, 30)}" for _ in range(300)))) for i in range(5)]
    machine = dec.Automaton(items, 13)
    doc = [b.decode() for b in dec.words_of(" ".join(f"w{rnd.randint(0, 40)}" for _ in range(3000)))]
    doc[500:560], doc[2000:2013] = items[1][1][20:80], items[3][1][:13]
    encoded = dec.Automaton([(n, [w.encode() for w in ws]) for n, ws in items], 13)
    spans, names = encoded.spans([w.encode() for w in doc])
    _, hit, want = slow(" ".join(doc), [(n, " ".join(ws)) for n, ws in items])
    assert names == want and {i for a, b in spans for i in range(a, b)} == hit and machine.shortest == 13


def test_spans_are_cut_and_documents_dropped(spark, documents):
    item = " ".join(f"t{i}" for i in range(20))
    docs = documents([(1, f"Before it, é: {item.upper()}! after " + "more " * 500), (2, item), (3, "clean"), (4, None)]).withColumnRenamed("lang", "found")
    items = spark.createDataFrame([(1, item, "x")], ITEMS)
    assert sorted(r.doc_id for r in dec.drop_contaminated(docs, items).collect()) == [1, 3, 4]
    cut = {r.doc_id: r.text for r in dec.remove_spans(docs, items, max_share=0.5).collect()}
    assert cut[1].startswith("Before it, é: ! after more") and set(cut) == {1, 3, 4}
    assert dec.drop_contaminated(docs, items).columns == docs.columns


def test_blocks_are_bounded_and_built_by_tasks(spark, monkeypatch):
    rnd = random.Random(9)
    items = spark.createDataFrame([(i, " ".join(rnd.choices("abcdefgh", k=20)), "x") for i in range(200)], ITEMS)
    monkeypatch.setattr(dec, "Automaton", None)  # the driver builds none
    paths = dec.write_automata(items.where("item_id < 0"), "item_id", "text", 13, 500)
    assert paths == []
    monkeypatch.undo()
    paths = dec.write_automata(items, "item_id", "text", 13, 500)
    assert len(paths) == 8
    sizes = [len(dec._automaton(p).vocabulary) for p in paths]
    assert max(sizes) <= 8 and sum(len({n for of in dec._automaton(p).items_of.values() for n in of}) for p in paths) == 200


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], ITEMS)
    assert dec.digest(documents([]), none).count() == 0
    assert [r.contaminated for r in dec.digest(documents([(1, "a b")]), none).collect()] == [False]
