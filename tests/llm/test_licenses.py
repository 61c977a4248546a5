import random
import re

import pytest

from millrace.llm import licenses


@pytest.fixture(scope="module")
def scanner():
    return licenses.Scanner(licenses.TEMPLATES)


def test_every_template_is_found_whole(scanner):
    for name, variants in licenses.TEMPLATES.items():
        for variant in variants:
            text = f"Ünder the tree 𝄞 it stood.\n{variant}\nAnd more of it came along that day."
            rows = [r for r in scanner.scan(text) if r[0] == name]
            assert rows, variant
            _, start, end, _, _, missing, added = rows[0]
            assert (missing, added) == ("", "")
            assert text[start:end].split() == re.sub(r"\.$", "", variant).split()


def test_changed_words_are_named(scanner):
    text = licenses.TEMPLATES["MIT"][0].replace("free of charge", "at no charge").replace("furnished", "kindly furnished")
    (row,) = scanner.scan(text)
    assert row[0] == "MIT" and row[5].split() == ["free", "of"] and row[6].split() == ["at", "no", "kindly"]


@pytest.mark.parametrize("text", ["Licensed under the Apache License, Version 1.1.", "Licensed under CC BY-ND 4.0.", "the license of it", "copyright", "permission to use it"])
def test_other_wordings_are_not(scanner, text):
    assert scanner.scan(text) == []


def test_each_of_many_is_found(scanner):
    filler = "word " * 300
    text = (filler + "Released under the MIT License.\n") * 12 + "Licensed under CC BY-NC 4.0.\n" * 500
    rows = scanner.scan(text)
    assert sum(r[0] == "MIT" for r in rows) == 12 and sum(r[0] == "CC-BY-NC-4.0" for r in rows) == 500


def test_rows(documents):
    docs = documents([(1, "Released under the MIT License."), (1, "Released under the MIT License."), (None, "x\nReleased under the MIT License."), (2, None), (3, ""), (4, "license " * 20_000)])
    rows = sorted((str(r.doc_id), r.license, r.start, r.end, r.exact) for r in licenses.find(docs).collect())
    assert rows == [("1", "MIT", 0, 30, True), ("1", "MIT", 0, 30, True), ("None", "MIT", 2, 32, True)]
    assert licenses.find(documents([])).count() == 0


MIT = licenses.TEMPLATES["MIT"][0]
EDITED = " ".join("x" if i % 12 == 5 else w for i, w in enumerate(MIT.split()))


@pytest.mark.parametrize(
    "name,fragment,notice",
    [
        ("Apache-2.0", "Licensed under the Apache License, Version 1.1.", "Licensed under the Apache Software License, Version 2.0."),
        ("MIT", " ".join(MIT.split()[:100]), EDITED),
        ("MIT", " ".join(MIT.split()[100:]), EDITED),
    ],
)
def test_a_longer_fragment_does_not_hide_an_edited_notice(scanner, name, fragment, notice):
    alone = scanner.scan(notice)
    assert [r[0] for r in alone] == [name]
    for text in (f"{fragment} {notice}", f"{notice} {fragment}", f"{fragment} {notice} {fragment} {notice} {fragment}"):
        rows = scanner.scan(text)
        found = {text[r[1] : r[2]] for r in rows}
        assert found == {notice[alone[0][1] : alone[0][2]]} and len(rows) == text.count(notice)


@pytest.mark.parametrize("size", [700, 1400, 3000])
@pytest.mark.parametrize("before", [0, 600, 2500])
def test_templates_of_any_size_are_found(documents, size, before):
    rnd = random.Random(size)
    words = ["".join(rnd.choices("abcdefghijkl", k=rnd.randint(2, 9))) for _ in range(size)]
    other = ["".join(rnd.choices("mnopqrst", k=rnd.randint(2, 9))) for _ in range(before)]
    held = [w if i % 20 else "xx" for i, w in enumerate(words)]  # a twentieth changed
    text = " ".join([*other, *held, *other])
    (row,) = licenses.find(documents([(1, text)]), {"own": (" ".join(words),)}).collect()
    assert text[row.start : row.end].split()[-1] == held[-1] and len(row.missing.split()) == sum(i % 20 == 0 for i in range(size))


def test_nested_findings_far_apart_are_dropped(scanner):
    inner = "Licensed under CC BY-NC 4.0."
    own = licenses.Scanner({"outer": (" ".join([f"license{i} {inner}" for i in range(6)]),), "inner": (inner,)})
    rows = own.scan(" ".join([f"license{i} {inner}" for i in range(6)]))
    assert [r[0] for r in rows] == ["outer"]


def places(words, block):
    """Whether a template stands anywhere: all stretches, by the longest common subsequence."""
    needed = (1 - licenses.MISSING) * len(words)
    for low in range(len(block)):
        row = [0] * (len(words) + 1)
        for high in range(low, min(len(block), low + 2 * len(words))):
            last = 0
            for i, w in enumerate(words):
                last, row[i + 1] = row[i + 1], (last + 1 if w == block[high] else max(row[i + 1], row[i]))
            if row[-1] >= needed and 2 * row[-1] >= licenses.LIKENESS * (len(words) + high + 1 - low):
                return True
    return False


def test_against_all_templates_at_all_places(documents):
    rnd = random.Random(6)
    vocabulary = ["".join(rnd.choices("abcdefghijklmnop", k=rnd.randint(4, 9))) for _ in range(60)]
    templates = {f"t{k}": (" ".join(rnd.sample(vocabulary, k=rnd.randint(8, 25))),) for k in range(6)}
    rows = []
    for i in range(120):
        words = rnd.choices(vocabulary, k=rnd.randint(0, 20))
        held = templates[f"t{rnd.randrange(6)}"][0].split()
        for _ in range(rnd.randint(0, 4)):
            at = rnd.randrange(len(held))
            held[at : at + rnd.randint(0, 1)] = rnd.choices(vocabulary, k=rnd.randint(0, 1))
        at = rnd.randint(0, len(words))
        rows.append((i, " ".join([*words[:at], *held, *words[at:]])))
    got = {i: set() for i, _ in rows}
    for r in licenses.find(documents(rows), templates).collect():
        got[r.doc_id].add(r.license)
    want = {i: {n for n, (v,) in templates.items() if places(v.split(), text.split())} for i, text in rows}
    assert got == want and sum(map(bool, want.values())) > 40


def test_runs_and_alignments():
    words, block = "a b c d e".split(), "a b x c d e a b c".split()
    assert licenses.anchors(words, [*block, None])[:2] == [(3, 0, 6), (3, 2, 3)]
    masks = {w: sum(1 << j for j, v in enumerate(block) if v == w) for w in block}
    assert licenses.common(words, masks, 0, 6) == 5 and licenses.common(words, masks, 3, 9) == 3
    assert licenses.fitted(words, block) == [(0, 0), (1, 1), (2, 3), (3, 4), (4, 5)]
    assert [licenses.least_run(n) for n in (1, 2, 7)] == [1, 2, 3]
