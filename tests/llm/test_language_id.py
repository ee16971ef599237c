"""Cross-parsing language ID: held-out accuracy, automata, edge cases."""

import numpy as np

from llm_helpers import edge_rows, frame, rng  # noqa: F401

from tramline.llm import language_id as L
from tramline.llm.common import held_out, table

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = table(spark, SF, "documents")
    model = L.fit(docs, chars=30_000)
    got = L.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    rows = got.collect()
    assert len(rows) > 100
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.96
    assert all(0 <= r.score <= 1 for r in rows)


def test_automaton_accepts_exactly_the_substrings(rng):
    word = [rng.randrange(3) for _ in range(40)]
    moves = L.suffix_automaton(word)
    held = {tuple(word[i:j]) for i in range(40) for j in range(i, 41)}
    for _ in range(500):
        probe = tuple(rng.randrange(3) for _ in range(rng.randint(0, 7)))
        state = 0
        for x in probe:
            state = moves[state].get(x) if state is not None else None
        assert (state is not None) == (probe in held)


def greedy_phrases(text, sample):
    n, i = 0, 0
    while i < len(text):
        j = i + 1
        while j < len(text) and text[i:j + 1] in sample:
            j += 1
        n, i = n + 1, j
    return n


def test_rates_equal_a_greedy_parse(rng, monkeypatch):
    monkeypatch.setattr(L, "BLOCK", 1 << 12)
    monkeypatch.setattr(L, "ROWS", 2)
    samples = tuple((name, "".join(rng.choice(letters) for _ in range(300)))
                    for name, letters in (("p", "abcd "), ("q", "abef ")))
    texts = ["".join(rng.choice("abcdefz ") for _ in range(rng.randint(0, 90)))
             for _ in range(40)]
    got = L.rates(texts, samples)
    parsed = [bytes(x - 1 if x else 32 for x in L._classes(t)).decode() for t in texts]
    cleaned = [bytes(x - 1 if x else 32 for x in L._classes(s)).decode() for _, s in samples]
    for t, row in zip(parsed, got):
        expected = [greedy_phrases(t, s) / len(t) if t else 1.0 for s in cleaned]
        assert np.allclose(row, expected)


def test_edge_rows(frame, edge_rows):
    model = L.Model((("aa", "the cat sat on the mat " * 20), ("bb", "der hund und die katze " * 20)))
    got = L.predict(frame(edge_rows), model).collect()
    assert len(got) == len(edge_rows)
    for r in got:
        if r.doc_id in (1, 2, 3):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
        else:
            assert r.lang_pred in ("aa", "bb")
        assert r.held_out == (r.doc_id is not None and
                              __import__("zlib").crc32(str(r.doc_id).encode()) % 5 == 0)


def test_digits_and_marks_are_und(frame):
    model = L.Model((("aa", "some words"),))
    got = L.predict(frame([(1, "12 34 !?"), (2, "...")]), model).collect()
    assert {r.lang_pred for r in got} == {"und"}


def test_without_labels_all_are_und(frame, edge_rows):
    docs = frame(edge_rows)
    model = L.fit(docs)
    assert model.samples == ()
    assert {r.lang_pred for r in L.predict(docs, model).collect()} == {"und"}


def test_only_learning_rows_are_used(spark):
    docs = table(spark, SF, "documents")
    assert L.fit(docs).samples == L.fit(docs.where(~held_out())).samples


def test_stage_keeps_text_and_rejects_noise(spark, frame, rng):
    words = ["the", "cat", "sat", "under", "nine", "green", "trees", "with", "apples", "and"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(80))) for i in range(1, 60)]
    noise = "".join(rng.choice("bcdfghjklmnpqrstvwxzBCDFGHJKLMNPQRSTVWXZéßñ") for _ in range(2000))
    docs = frame(rows, lang="en").union(frame([(900, noise), (901, "42"), (902, None)]))
    out = L.keep_languages(spark, docs, "")
    assert out.columns == docs.columns
    assert {r.doc_id for r in out.collect()} == {i for i, _ in rows}


def test_rare_languages_do_not_stop_the_rejection(spark, frame, rng):
    """Beside a large language, one with an empty text, one with two letters,
    and one of a few hundred characters, whose texts must stay."""
    def prose(words, n):
        return " ".join(rng.choice(words) for _ in range(n))

    large = ["the", "cat", "sat", "under", "nine", "green", "trees", "with", "apples", "and"]
    small = ["кот", "сидит", "под", "девятью", "зелёными", "деревьями", "вместе", "яблоки"]
    rows = [(i, prose(large, 80)) for i in range(1, 90)]
    noise = ["".join(rng.choice(letters) for _ in range(2000)) for letters in
             ("bcdfghjklmnpqrstvwxzBCDFGHJKLMNPQRSTVWXZéßñ", "adehinprstuw ", "квзйцшщжхюяыдт")]
    docs = frame(rows, lang="en")
    rare = [(1001, "", "aa"), (1002, "ab", "ab"), (1003, prose(small, 60), "ru")]
    for i, text, lang in rare:
        assert not frame([(i, text)]).where(~held_out()).isEmpty()  # it is learned from
        docs = docs.union(frame([(i, text)], lang=lang))
    docs = docs.union(frame([*((2000 + k, x) for k, x in enumerate(noise)),
                             (3000, prose(small, 80)), (3001, prose(large, 80))]))
    kept = {r.doc_id for r in L.keep_languages(spark, docs, "").collect()}
    assert kept == {i for i, _ in rows} | {1002, 1003, 3000, 3001}


def test_limits_of_large_languages_are_one(rng):
    """Every long sample has the lowest rate of all, with rare ones or without."""
    def sample(words):
        return " ".join(rng.choice(words) for _ in range(2000))

    large = (("p", sample(["one", "two", "three", "seven", "eleven"])),
             ("q", sample(["eins", "zwei", "drei", "sieben", "elf"])))
    limits = L._reject_rates(large)
    assert limits[0] == limits[1] < 1
    assert L._reject_rates((("a", ""), *large, ("z", "xy"))) == (1.0, *limits, 1.0)


def test_all_sampled_documents_are_learned_from(frame):
    """400 long documents share a sample, from within their texts; few short
    ones give it whole."""
    long = [(i, f"<{i}>" + "".join(f" d{i}w{k}" for k in range(300))) for i in range(200)]
    docs = frame(long, lang="aa").union(frame([(900, "few short words"), (901, "and some")],
                                              lang="bb"))
    learned = {r.doc_id for r in docs.where(~held_out()).collect()}
    samples = dict(L.fit(docs).samples)
    used = {int(w[1:].split("w")[0]) for w in samples["aa"].split() if w[0] == "d" and "w" in w}
    assert used == {i for i, _ in long if i in learned}
    assert 55_000 < len(samples["aa"]) <= 60_000
    assert sum(f"<{i}>" in samples["aa"] for i in learned) < 20  # not their openings
    assert set(samples["bb"].split("\n")) - {""} == {t for i, t in [(900, "few short words"),
                                                                     (901, "and some")]
                                                     if i in learned}


def test_empty_table(frame, edge_rows):
    assert L.predict(frame([]), L.fit(frame([]))).count() == 0
    assert L.predict(frame([]), L.fit(frame(edge_rows, lang="en"))).count() == 0
