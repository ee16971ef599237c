"""Chat snapshots against brute force and the SQL twin."""

import random

import pytest

from tramline.llm import chat_format as C

SCHEMA = "conv_id long, turn int, role string, text string, k int"


def brute_force(rows):
    convs = {}
    for conv, turn, role, text, _ in set(rows):
        if conv is not None and turn is not None:
            convs.setdefault(conv, []).append((turn, role, text))

    def order(t):
        return (t[0], t[1] is not None, t[1] or "", t[2] is not None, t[2] or "")
    convs = {c: sorted(v, key=order) for c, v in convs.items()}
    out = []
    for c, v in convs.items():
        equal = [d for d, w in convs.items() if w == v]
        longer = any(len(w) > len(v) and w[:len(v)] == v for w in convs.values())
        if c == min(equal) and not longer:
            text = "".join(f"<|{r or ''}|>\n{t or ''}\n" for _, r, t in v)
            out.append((c, len(v), len(equal), text))
    return sorted(out)


def rendered(frame):
    parts = {}
    for r in C.chat_format(frame).collect():
        parts.setdefault((r.conv_id, r.n_turns, r.n_equal), []).append((r.segment, r.text))
    return sorted((*k, "".join(t for _, t in sorted(v))) for k, v in parts.items())


@pytest.mark.parametrize("seed, size", [(1, 256), (2, 2), (3, 3)])
def test_equals_brute_force(spark, monkeypatch, seed, size):
    monkeypatch.setattr(C, "SLICE", size)
    rnd = random.Random(seed)
    rows = []
    for conv in range(60):
        for turn in range(rnd.randint(0, 7)):
            rows.append((conv, turn, rnd.choice(["user", "assistant"]) if turn else "user",
                         rnd.choice("ab") if turn else "hi", 0))
    rows += rows[:9] + [(None, 0, "user", "x", 0), (3, None, "user", "x", 0)]
    rows += [(70, 0, None, None, 0), (71, 0, "", None, 0), (72, 0, "", "", 0), (73, 0, None, None, 0),
             (73, 1, "user", "more", 0), (74, 5, "user", "a", 0), (74, 5, "user", "b", 0),
             (75, 5, "user", "a", 0)]
    assert rendered(spark.createDataFrame(rows, SCHEMA).repartition(3)) == brute_force(rows)


def test_long_conversation_and_its_snapshots(spark):
    turns = [("user" if i % 2 == 0 else "assistant", f"turn {i}") for i in range(600)]
    rows = [(conv, i, *turns[i], 0) for conv, n in ((1, 600), (2, 300), (3, 599), (4, 256), (5, 1))
            for i in range(n)]
    got = C.chat_format(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.conv_id for r in got} == {1} and sorted(r.segment for r in got) == [0, 1, 2]


def test_empty_table(spark):
    assert C.chat_format(spark.createDataFrame([], SCHEMA)).count() == 0
