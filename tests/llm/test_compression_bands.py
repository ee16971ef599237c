"""Compression bands against a plain count, edge cases, and kinds of junk."""

import random
import re

from llm_helpers import edge_rows, frame, rng  # noqa: F401

from tramline.llm.compression_bands import Bands, compression_bands

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    hit = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = text.split("\n")
    dups = sum(bool(WORD.search(x)) and x in lines[:i] for i, x in enumerate(lines))
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dups, len(hit))


def test_counts_equal_a_plain_count(frame, rng, edge_rows):
    alphabet = ["a", "bé", "c#", "\n", "\n", "d", " ", "e|f"]
    rows = [r for r in edge_rows if r[0] != 7]
    rows += [(100 + i, " ".join(rng.choice(alphabet) for _ in range(rng.randint(0, 90))))
             for i in range(60)]
    got = compression_bands(frame(rows)).collect()
    assert len(got) == len(rows)
    texts = {r[0]: r[1] for r in rows}
    for r in got:
        counts = plain_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert not (r.base_failed and r.kept)


def test_null_and_empty_are_not_kept(frame):
    for r in compression_bands(frame([(1, None), (2, "")])).collect():
        assert (r.n_words, r.base_failed, r.kept, r.verdict) == (0, True, False, "empty")


def test_bands_reject_repetition_and_noise(frame):
    rnd = random.Random(3)
    syllables = ["an", "er", "in", "th", "ou", "re", "ti", "on", "ed", "st", "ha", "es"]
    prose = " ".join("".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 4)))
                     for _ in range(400))
    noise = "".join(chr(rnd.randint(0x4E00, 0x9FFF)) + (" " if i % 5 == 0 else "")
                    for i in range(2000))
    almost = " ".join(f"item{i % 9}{i % 7} of the list" for i in range(500))
    got = {r.doc_id: r.verdict for r in compression_bands(
        frame([(1, prose), (2, noise), (3, almost)])).collect()}
    assert got[1] == "in_band" and got[3] == "repetitive" and got[2] != "repetitive"


def test_long_chunk_of_repetition_inside_prose(frame):
    rnd = random.Random(4)
    prose = " ".join("".join(rnd.choice("abcdefghijklmno") for _ in range(rnd.randint(2, 9)))
                     for _ in range(3000))
    mixed = prose[:9000] + " buy now" * 900
    r = compression_bands(frame([(1, mixed)]), Bands()).first()
    assert r.bad_chunk_share > 0.25 and not r.kept


def test_empty_table_and_clashing_names(frame, edge_rows):
    assert compression_bands(frame([])).count() == 0
    clash = frame(edge_rows).selectExpr("*", "1 AS kept", "2 AS ratio", "3 AS m")
    got = compression_bands(clash)
    assert got.columns.count("kept") == 1 and got.count() == len(edge_rows)
    assert len({r.ratio for r in got.where("doc_id = 5").collect()}) == 1
