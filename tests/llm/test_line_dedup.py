"""Line dedup against brute force; the bit-parallel distance alone."""

import random
import time

import pytest
from pyspark.sql import functions as F

from llm_helpers import edge_rows, frame, rng  # noqa: F401

from tramline.llm.line_dedup import Settings, drop_repeated_lines, edit_distance, line_dedup


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edited(text, n, rnd):
    chars = list(text)
    for _ in range(n):
        at = rnd.randrange(len(chars)) if chars else 0
        kind = rnd.random() if chars else 1.0
        if kind < 0.35:
            chars[at] = rnd.choice("abcéd ")
        elif kind < 0.65:
            del chars[at]
        else:
            chars.insert(at, rnd.choice("abcéd"))
    return "".join(chars)


@pytest.mark.parametrize("k", [1, 2, 3])
def test_distance(spark, rng, k):
    pairs = []
    while len(pairs) < 600:
        a = "".join(rng.choice("abcé ") for _ in range(rng.randint(k + 1, 30)))
        b = edited(a, rng.randint(0, k + 3), rng)
        if len(b) > k and abs(len(a) - len(b)) <= k:
            pairs.append((a, b, distance(a, b)))
    got = spark.createDataFrame(pairs, "a string, b string, d int").withColumn(
        "e", F.expr(edit_distance("a", "b", k)))
    assert got.where(f"(d <= {k} AND e <> d) OR (d > {k} AND e <= {k})").isEmpty()


def brute_force(rows, s):
    """(doc_id, n_lines, n_exact, n_near, text) of each (doc_id, hash, text)."""
    def place(r, n):
        return (r[0] is not None, r[0] or 0, r[1], n)

    first = {}
    for r in rows:
        for n, line in enumerate((r[2] or "").split("\n")):
            if len(line.strip(" ")) >= s.least_chars:
                first[line] = min(first.get(line, place(r, n)), place(r, n))
    order = sorted(first, key=first.get)
    near = {a for i, a in enumerate(order) for b in order[:i]
            if abs(len(a) - len(b)) <= s.edits and distance(a, b) <= s.edits}
    out = []
    for r in rows:
        if r[2] is None:
            out.append((r[0], 0, 0, 0, None))
            continue
        lines, kept, exact, close = r[2].split("\n"), [], 0, 0
        for n, line in enumerate(lines):
            if line in first and first[line] != place(r, n):
                exact += 1
            elif line in near:
                close += 1
            else:
                kept.append(line)
        out.append((r[0], len(lines), exact, close, "\n".join(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed, edits, limit, crowd, levels", [
    (1, 2, 1_000_000, None, 4), (2, 1, 0, None, 4), (3, 3, 1_000_000, None, 4),
    (4, 2, 1_000_000, 2, 1), (5, 2, 0, 2, 3), (6, 1, 1_000_000, 1, 6), (7, 3, 1_000_000, 3, 2)])
def test_equals_brute_force(frame, edge_rows, seed, edits, limit, crowd, levels):
    """Also with every group of more than one, two or three lines as a crowd."""
    rnd = random.Random(seed)
    words = ["alpha", "beta", "gamma", "délta", "eps", "zeta zeta", "eta", "theta", "iota"]
    base = [" ".join(rnd.choice(words) for _ in range(rnd.randint(2, 9))) for _ in range(40)]
    rows = [(rnd.randrange(150) if i % 50 else None, "\n".join(
        edited(rnd.choice(base), rnd.choice([0, 0, 1, 2, 3, 4]), rnd)
        for _ in range(rnd.randint(0, 6)))) for i in range(160)]
    rows += rows[:4] + [r for r in edge_rows if r[0] != 7]
    s = Settings(edits=edits, broadcast_hashes=limit, crowd=crowd, levels=levels)
    docs = frame(rows)
    hashed = [tuple(r) for r in docs.select("doc_id", F.xxhash64("text"), "text").collect()]
    assert sorted(map(tuple, line_dedup(docs, s).collect()), key=str) == brute_force(hashed, s)


def test_hot_line_and_hot_segment(frame):
    """A line in every document, and many near variants of one line."""
    rows = [(i, f"this very line opens each of the documents\nnumber {i:05d} of a long list "
                "of lines that differ in digits") for i in range(300)]
    got = {r.doc_id: r for r in line_dedup(frame(rows)).collect()}
    assert got[0].n_exact == got[0].n_near == 0
    assert all(got[i].n_exact == 1 for i in range(1, 300))
    assert sum(r.n_near for r in got.values()) > 250


def test_crowd_of_lines_with_one_opening(spark, frame):
    """Twenty thousand different lines that share a third: only those with a
    near copy go, and lines meet few others."""
    rnd = random.Random(1)
    letters = "abcdefghijklmnopqrstuvwxyz"
    lines = ["Posted by the editor on " + "".join(rnd.choices(letters, k=30)) for _ in range(20_000)]
    for i in range(100, len(lines), 100):
        lines[i] = edited(lines[i - 57], 2, rnd)
    started = time.time()
    s = Settings(short_exact=10, crowd=64)
    got = line_dedup(frame(list(enumerate(lines))), s).where("n_near > 0").collect()
    near = {i for i in range(100, len(lines), 100) if lines[i] != lines[i - 57]}
    assert {r.doc_id for r in got} == near
    assert time.time() - started < 300


def test_stage_keeps_columns_and_drops_emptied(spark, frame, edge_rows):
    line = "a line that is long enough to count as one"
    docs = frame([*edge_rows, (20, line), (21, line), (22, f"{line}\nand another line of its own")])
    out = drop_repeated_lines(spark, docs, "")
    assert out.columns == docs.columns
    got = {r.doc_id: r for r in out.collect()}
    assert 21 not in got and got[22].text == "and another line of its own"
    assert got[22].n_chars == len(got[22].text)
    assert got[1].text is None and got[2].text == "" and got[3].text == " \n\t "


def test_exact_repeats_of_short_lines(spark, frame):
    """Within a document at any length, across documents from ten characters."""
    long = "a line that is long enough for the near test"
    rows = [(1, "tiny\n\ntiny\n \nover ten chars\n\ntiny "), (2, f"tiny\nover ten chars\nx\n{long}\nx"),
            (3, "over ten charts\n\t\r\n\t\r\ntiny"), (None, "y\ny"), (2, "tiny\nother\ntiny")]
    rows += rows[:1]
    got = sorted(((r.doc_id or 0, r.n_exact, r.n_near, r.text)
                  for r in line_dedup(frame(rows)).collect()))
    first = (1, 1, 0, "tiny\n\n \nover ten chars\n\ntiny ")
    assert got == sorted([first, first, (2, 2, 0, f"tiny\nx\n{long}"), (3, 0, 0, rows[2][1]),
                          (0, 1, 0, "y"), (2, 1, 0, "tiny\nother")])
    kept = drop_repeated_lines(spark, frame(rows), "").collect()
    assert sorted(r.text for r in kept) == sorted(x[3] for x in got)
    assert all(r.n_chars == len(r.text) for r in kept)


def test_empty_table(frame):
    assert line_dedup(frame([])).count() == 0


def test_no_python_in_the_plan(frame, edge_rows):
    plan = line_dedup(frame(edge_rows).select("doc_id", "text"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
