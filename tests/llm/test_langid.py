from __future__ import annotations

import random

import pytest

from lavra.llm import langid

LETTERS = {"aa": "abcdeé", "bb": "bcdfgh", "cc": "uvwxyz"}


def text(language, seed, n=60):
    draw = random.Random(seed)
    syllables = ["".join(draw.choices(LETTERS[language], k=2)) for _ in range(6)]
    shared = ["".join(random.Random(language).choices(LETTERS[language], k=3)) for _ in range(9)]
    return " ".join("".join(draw.choices(syllables + shared, k=2)) for _ in range(n))


def plain_phrases(content: bytes, sample: list[bytes]) -> int:
    """Greedy longest phrases by substring search, over the whole text."""
    count, i = 0, 0
    while i < len(content):
        n = 1
        while i + n < len(content) and any(content[i : i + n + 1] in s for s in sample):
            n += 1
        i += n
        count += 1
    return count


@pytest.mark.parametrize("block", [1, 2, 5, 64, 512])
def test_phrases_equal_plain_search(monkeypatch, block):
    """However the text is cut for parsing, phrases are those of one pass over it."""
    monkeypatch.setattr(langid, "BLOCK", block)
    samples = {k: [text(k, s, 30) for s in range(3)] for k in LETTERS}
    model = langid.train(samples)
    texts = [text("aa", 50), text("bb", 51, 300), "qqq é?! 123", "", "ab" * 700, "ŵŷ", "a" * 900]
    texts += [samples["aa"][0] * 3, text("cc", 52, 40) + samples["bb"][1]]
    cleaned = [langid.normalised(t) for t in texts]
    found = langid.phrases(cleaned, model)
    for row, content in zip(found, cleaned, strict=True):
        for count, language in zip(row, model.languages, strict=True):
            sample = [langid.normalised(t) for t in samples[language]]
            assert count == plain_phrases(content, sample)


def labelled(n=40):
    return [(10 * i + j, text(k, 100 * i + j), k) for i in range(n) for j, k in enumerate(LETTERS)]


def test_accuracy_on_rows_not_learned_from(docs):
    frame = docs(*labelled())
    held = langid.is_held_out(frame["doc_id"])
    model = langid.fit(frame.where(~held))
    found = langid.identify(frame.where(held), model).collect()
    assert len(found) > 15
    assert sum(r["lang"] == r["lang_pred"] for r in found) / len(found) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in found)


def test_odd_texts(docs):
    rows = labelled(8)
    frame = docs(*rows)
    model = langid.fit(frame)
    odd = docs(
        (1, None), (2, ""), (3, " 12 ,.\n"), (4, text("cc", 9) * 400), (None, text("bb", 8)), (6, "漢字")
    ).selectExpr("*", "'x' AS lang_pred", "'y' AS found", "'z' AS score")
    found = {r["doc_id"]: r for r in langid.identify(odd, model).collect()}
    assert [found[i]["lang_pred"] for i in (1, 2, 3, 4, None)] == ["und", "und", "und", "cc", "bb"]
    assert found[6]["lang_pred"] in LETTERS
    assert found[1]["score"] == 0 and found[4]["found"] == "y"


def test_nothing_learned_and_one_language(docs):
    frame = docs((1, "words here", None), (2, "more", None))
    model = langid.fit(frame)
    assert {r["lang_pred"] for r in langid.identify(frame, model).collect()} == {"und"}
    alone = langid.fit(docs((1, "words here", "aa")))
    (row,) = langid.identify(docs((3, "here")), alone).collect()
    assert (row["lang_pred"], row["score"]) == ("aa", 1.0)


def test_ties_go_to_the_smaller_name():
    model = langid.train({"b": ["same words"], "a": ["same words"]})
    found = langid.predict(["same"], model)
    assert (found["lang_pred"][0], found["score"][0]) == ("a", 0.0)


def test_held_out_rows_teach_nothing(docs):
    import zlib

    rows = [(i, "words", "aa") for i in range(30)] + [(None, "words", "aa")]
    frame = docs(*rows)
    learned = {r["doc_id"] for r in frame.where(~langid.is_held_out(frame["doc_id"])).collect()}
    assert learned == {i for i, _, _ in rows if i is None or zlib.crc32(str(i).encode()) % 4 != 2}


@pytest.mark.parametrize("columns", [["*"], ["*", "'q' AS lang_pred", "2 AS score"]])
def test_stage_keeps_columns_and_clean_rows(docs, columns):
    rows = labelled(6)
    frame = docs(*rows, (9001, None), (9002, "12"), rows[0]).selectExpr(*columns)
    kept = langid.keep_identified(frame)
    assert kept.columns == frame.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted([*(r[0] for r in rows), rows[0][0]])
    assert langid.keep_identified(docs()).count() == 0


def test_copies_take_one_place_of_the_sample(docs):
    """Whatever its place in the order, a text with many copies is learned from once."""
    texts = [text("aa", seed) for seed in range(20)]
    rows = [(100 * i + k, t, "aa") for i, t in enumerate(texts) for k in range(70)]
    found = langid.labelled_sample(docs(*rows)).collect()
    assert sorted(r["place"] for r in found) == list(range(1, 21))
    assert len({r["text"] for r in found}) == 20


def test_sample_has_whole_texts(docs, monkeypatch):
    """Short texts where there are enough of them, else longer ones, whole; bounded in all."""
    short = [(i, f"short {text('aa', i, 20)}", "aa") for i in range(200)]
    long = [(1000 + i, text("aa", 500 + i, 900), "aa") for i in range(50)]
    rows = short + long + [(2000 + i, text("bb", i, 900), "bb") for i in range(5)]
    rows += [(3000, text("cc", 1, 40_000), "cc")]
    found = langid.labelled_sample(docs(*rows), 64).collect()
    whole = {t for _, t, _ in rows}
    assert all(r["text"] in whole for r in found)
    per = {k: [r["text"] for r in found if r["lang"] == k] for k in LETTERS}
    assert {k: len(v) for k, v in per.items()} == {"aa": 64, "bb": 5, "cc": 0}
    assert all(t.startswith("short") for t in per["aa"])
    assert langid._first(per["bb"], 64, 2 * len(per["bb"][0]) + 100) == per["bb"][:2]
    assert langid._first(per["bb"], 64, 10) == per["bb"][:1]


def test_sample_is_that_of_all_hashes(docs, monkeypatch):
    """Raising the threshold ends at the texts of smallest hash, whatever it began with."""
    rows = [(i, text("aa", i, 10), "aa") for i in range(300)]
    frame = docs(*rows)
    hashed = frame.selectExpr("text", "shiftrightunsigned(xxhash64(text), 1) AS h").orderBy("h")
    expected = [r["text"] for r in hashed.limit(4).collect()]
    found = langid.labelled_sample(frame, 4).orderBy("place").collect()
    assert [r["text"] for r in found] == expected


def test_model_is_bounded(docs, monkeypatch):
    frame = docs(*labelled(20))
    whole = sum(p.nbytes for p in langid.fit(frame).parsers)
    monkeypatch.setattr(langid, "MODEL_BYTES", whole // 3)
    model = langid.fit(frame)
    assert 0 < sum(p.nbytes for p in model.parsers) <= whole // 3 and len(model.languages) == 3
