"""Benchmark decontamination: planted passages, edits, the lemma's bound."""

import random

import pytest

from llm_helpers import edge_rows, frame, rng  # noqa: F401

from tramline.llm import decontaminate as D

ITEMS = [(i, " ".join("".join(random.Random(100 * i + j).choice("abcdefghijklmnop")
                              for _ in range(3 + (i + j) % 6)) for j in range(12 + 4 * i)))
         for i in range(8)]


@pytest.fixture
def benchmark(spark):
    return spark.createDataFrame([*ITEMS, (50, None), (51, ""), (52, "short"), (0, ITEMS[0][1])],
                                 "item_id long, text string")


def prose(rng, n):
    return " ".join("".join(rng.choice("qrstuvwxyzaeiou") for _ in range(rng.randint(2, 9)))
                    for _ in range(n))


def distance_to_substring(pattern, text):
    row = [0] * (len(text) + 1)
    for i, x in enumerate(pattern, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_alignment_equals_brute_force(rng):
    """Every piece within its edit budget is found, and no other."""
    s = D.Settings()
    index = D.Index(ITEMS[:4], s)
    texts = []
    for k in range(80):
        piece = list(ITEMS[k % 4][1])
        for _ in range(rng.randint(0, 16)):
            at = rng.randrange(len(piece))
            piece[at:at + 1] = rng.choice([[], ["z"], ["y", piece[at]]])
        texts.append(prose(rng, 20) + " " + "".join(piece) + " " + prose(rng, 20))
    for text, hits in zip(texts, D.find(texts, index)):
        raw = D._folded(D.normalised(text))[0].tobytes()
        expected = {index.owner[p] for p in range(len(index.size))
                    if distance_to_substring(index.bytes[p, :index.size[p]].tobytes(), raw)
                    <= index.edits[p]}
        assert {h[0] for h in hits} == expected


def test_planted_passages(frame, benchmark, rng, edge_rows):
    clean = [(100 + i, prose(rng, 80)) for i in range(30)]
    planted = []
    for k, (item, text) in enumerate(ITEMS):
        host = prose(rng, 60)
        planted.append((200 + k, f"{host}\n{text.upper()}  {host}"))           # case
        planted.append((300 + k, host + " " + text.replace(" ", " \n ") + "."))  # white space
        planted.append((400 + k, text))                                           # alone
    rows = [*edge_rows, *clean, *planted]
    got = D.decontaminate(frame(rows), benchmark).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None and r.doc_id >= 200:
            assert r.contaminated and r.doc_id % 100 in r["items"]
        else:
            assert not r.contaminated and r["items"] == [] and r.hits == []


def test_part_of_a_long_item(frame, benchmark, rng):
    part = ITEMS[7][1][30:180]
    r = D.decontaminate(frame([(1, f"{prose(rng, 30)} {part} {prose(rng, 30)}")]),
                        benchmark).first()
    assert r["items"] == [7]


def test_places_are_characters_of_the_text(frame, benchmark):
    text = "é\U0001F600 " * 5 + ITEMS[2][1] + " ü"
    hit = D.decontaminate(frame([(1, text)]), benchmark).first().hits[0]
    assert abs(hit["first"] - text.index(ITEMS[2][1])) <= 2
    assert abs(hit["last"] - len(text) + 2) <= 2 and hit.edits == 0


def test_many_blocks_give_the_same(frame, benchmark, rng):
    rows = [(i, f"{prose(rng, 20)} {t}") for i, t in ITEMS]
    one = D.decontaminate(frame(rows), benchmark).orderBy("doc_id").collect()
    many = D.decontaminate(frame(rows), benchmark, D.Settings(block_bytes=200, batch_bytes=300))
    assert [r["items"] for r in many.orderBy("doc_id").collect()] == [r["items"] for r in one]


def test_empty_tables(spark, frame, benchmark):
    assert D.decontaminate(frame([]), benchmark).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    assert not D.decontaminate(frame([(1, ITEMS[0][1])]), none).first().contaminated


def test_short_items_match_whole_words(spark, frame, rng):
    """Items too short for the lemma: verbatim, between borders of words."""
    items = [(1, "capital of Norway 7?"), (2, "北京是中国首都"), (3, "été à Paris"), (4, "oslo"),
             (5, "Norwegen"), (6, ITEMS[1][1])]
    short = spark.createDataFrame(items, "item_id long, text string")
    texts = {
        10: (f"{prose(rng, 9)} Capital  of\nNorway 7? {prose(rng, 9)}", [1]),
        11: ("我知道北京是中国首都。", [2]), 12: ("été à paris", [3]), 13: ("(été à Paris)", [3]),
        14: ("l'été à parisien", []), 15: ("vété à paris", []), 16: ("capital of Norway 8?", []),
        17: ("in norwegens hills", []), 18: ("norwegen, oslo", [5]), 19: (ITEMS[1][1], [6]), 20: ("", [])}
    rows = [(i, t) for i, (t, _) in texts.items()]
    got = {r.doc_id: r for r in D.decontaminate(frame(rows), short).collect()}
    assert {i: r["items"] for i, r in got.items()} == {i: x for i, (_, x) in texts.items()}
    assert [(h["first"], h["last"], h.edits) for h in got[11].hits] == [(3, 10, 0)]
    h = got[10].hits[0]
    assert texts[10][0][h["first"]:h["last"]] == "Capital  of\nNorway 7?"
    only = short.where("item_id IN (2, 3, 4, 5)")
    for least, found in ((1, [4, 5]), (9, [])):  # the option; no item long enough for pieces
        r = D.decontaminate(frame([(1, "norwegen, oslo")]), only, D.Settings(least_exact=least))
        assert r.first()["items"] == found


def test_blocks_are_indexed_outside_the_driver(spark, frame, benchmark, rng, edge_rows, monkeypatch):
    """One block's text at a time is in the driver, and no index is; the hits
    of many blocks are those of one."""
    rows = [*edge_rows, *((i or None, f"{prose(rng, 9)} {t} {ITEMS[3][1]}") for i, t in ITEMS)]
    rows += rows[-2:]
    one = D.decontaminate(frame(rows), benchmark).collect()
    monkeypatch.setattr(D, "Index", None)
    s = D.Settings(block_bytes=200)
    n, each = D.blocks(benchmark, s)
    sizes = [sum(len(t.encode()) for _, t in items) for items in each]
    assert n == len(sizes) > 3 and max(sizes) < sum(sizes) / 2
    assert sum(sizes) == sum(len(t) for _, t in ITEMS) + len(ITEMS[0][1]) + len("short")
    docs = frame(rows)
    many = D.decontaminate(docs, benchmark, s).collect()

    def plain(got):
        return sorted(((r.doc_id, r.contaminated, r["items"], sorted(set(map(tuple, r.hits))))
                       for r in got), key=str)
    assert plain(many) == plain(one) and sum(r.contaminated for r in many) == len(ITEMS) + 2
    found = D.with_hits(docs, benchmark, "found", s)
    assert found.columns == [*docs.columns, "found"] and found.count() == len(rows)
