"""Language identification by cross-parsing entropy.

For each language, a suffix automaton of a sample of its labelled text accepts
every substring of that sample. A text is parsed greedily into the longest
phrases each automaton accepts; the language that needs the fewest phrases
per byte wins. Automata become dense transition tables, and the texts of an
Arrow batch are parsed in lockstep, one byte of every block per numpy step.

Texts are parsed whole, as lower-case UTF-8 with every ASCII non-letter read
as one blank, in blocks of ``BLOCK`` bytes (a phrase ends with its block, for
all languages alike).

Defined results: a null text, or one without a letter, is ``und`` with score
0; equal rates go to the alphabetically first language; score is the margin
1 - best rate / second best rate, or 1 - rate if one language was learned;
without any labelled text every document is ``und``. A text of at least
``least_bytes`` is rejected if its rate is above the limit of the language that
parses it best; a language with too little labelled text for a limit rejects
none of the texts that it alone parses best. Repeated rows each get their own
row; an empty table gives an empty table; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm.common import held_out, python_ready, scratch_name, table, with_release

BLOCK = 256
#: Blocks parsed in lockstep (with ``BLOCK``, this bounds the memory of a batch
#: of texts; a longer text is one batch).
ROWS = 16_384

SCHEMA = "lang_pred string, score double, rate double, rejected boolean"

#: Class of each byte: 0 for a blank, else 1 + the byte (ASCII non-letters are blanks).
_CLASS = np.array([b + 1 if b >= 0x80 or chr(b).isalpha() else 0 for b in range(256)],
                  dtype=np.uint16)


def _classes(text: str) -> np.ndarray:
    """Byte classes of a text; runs of blanks count once, outer ones not at all."""
    c = _CLASS[np.frombuffer(text.lower().encode(), dtype=np.uint8)]
    keep = c > 0
    keep[1:] |= c[:-1] > 0
    if len(c):
        keep[0] = c[0] > 0
    c = c[keep]
    return c[:-1] if len(c) and c[-1] == 0 else c


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton that accepts every substring;
    state 0 is the start."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for x in symbols:
        new = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and x not in moves[p]:
            moves[p][x] = new
            p = link[p]
        if p != -1:
            q = moves[p][x]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                clone = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and moves[p].get(x) == q:
                    moves[p][x] = clone
                    p = link[p]
                link[q] = link[new] = clone
        last = new
    return moves


class Parser:
    """Phrase counts against one language's sample.

    ``step[state * width + symbol]`` holds twice the next state, plus 1 if the
    symbol starts a new phrase. The last symbol is padding: it changes nothing.
    """

    def __init__(self, sample: np.ndarray, symbol_of: np.ndarray, width: int):
        moves = suffix_automaton(symbol_of[sample].tolist())
        # State 0 is the start; no phrase is open only there.
        step = np.empty((len(moves), width), dtype=np.int32)
        fresh = np.ones(width, dtype=np.int32)  # an unknown symbol: a phrase of its own
        for x, q in moves[0].items():
            fresh[x] = 2 * q + 1
        step[:] = fresh
        for s, out in enumerate(moves[1:], 1):
            for x, q in out.items():
                step[s, x] = 2 * q
        step[:, width - 1] = 2 * np.arange(len(moves))
        self.step, self.width = step.ravel(), width

    def phrases(self, blocks: np.ndarray) -> np.ndarray:
        """Phrases of each column of ``blocks`` (position by block)."""
        count = np.zeros(blocks.shape[1], dtype=np.int32)
        state = np.zeros(blocks.shape[1], dtype=np.int32)
        for row in blocks:
            state *= self.width
            state += row
            got = self.step.take(state)
            count += got & 1
            state = got >> 1
        return count


@dataclass(frozen=True)
class Model:
    """Samples by language, and for each the phrase rate above which a long text
    that it parses best is in none of them (none given: no text is)."""
    samples: tuple[tuple[str, str], ...]
    reject_rates: tuple[float, ...] = ()
    #: Texts of fewer bytes are never rejected for their rate.
    least_bytes: int = 200


@lru_cache(maxsize=2)
def _parsers(samples: tuple[tuple[str, str], ...]):
    coded = [(lang, _classes(text)) for lang, text in samples]
    used = np.unique(np.concatenate([c for _, c in coded])) if coded else np.array([], int)
    symbol_of = np.full(257, len(used), dtype=np.int32)  # one symbol for all unseen bytes
    symbol_of[used] = np.arange(len(used))
    width = len(used) + 2
    return symbol_of, width, [(lang, Parser(c, symbol_of, width)) for lang, c in coded]


def rates(texts: list[str], samples: tuple[tuple[str, str], ...]) -> np.ndarray:
    """Phrases per byte, text by language; 0 bytes give rate 1."""
    symbol_of, width, parsers = _parsers(samples)
    total = np.zeros((len(texts), len(parsers)))
    sizes = np.zeros(len(texts), dtype=np.int64)
    start = 0
    while start < len(texts):
        coded, held, stop = [], 0, start
        while stop < len(texts) and (stop == start or held < ROWS * BLOCK):
            coded.append(symbol_of[_classes(texts[stop])])
            held += len(coded[-1])
            stop += 1
        sizes[start:stop] = [len(c) for c in coded]
        total[start:stop] = _phrases(coded, sizes[start:stop], parsers, width)
        start = stop
    return np.where(sizes[:, None] > 0, total / np.maximum(sizes, 1)[:, None], 1.0)


def _phrases(coded: list[np.ndarray], sizes: np.ndarray, parsers, width: int) -> np.ndarray:
    n_blocks = -(-sizes // BLOCK)
    owner = np.repeat(np.arange(len(coded)), n_blocks)
    flat = np.full(int(n_blocks.sum()) * BLOCK, width - 1, dtype=np.int32)
    at = 0
    for c, n in zip(coded, n_blocks):
        flat[at:at + len(c)] = c
        at += int(n) * BLOCK
    grid = flat.reshape(-1, BLOCK)
    total = np.zeros((len(coded), len(parsers)))
    for a in range(0, len(grid), ROWS):
        part = np.ascontiguousarray(grid[a:a + ROWS].T)
        for k, (_, parser) in enumerate(parsers):
            total[:, k] += np.bincount(owner[a:a + ROWS], parser.phrases(part), len(coded))
    return total


def fit(docs: DataFrame, chars: int = 60_000, docs_per_lang: int = 400) -> Model:
    """Learn from a bounded sample of the labelled documents: about
    ``docs_per_lang`` of each language (chosen by a hash of the id) share its
    ``chars`` characters as evenly as their lengths allow; each gives one piece
    of at most ``chars`` / 40 that starts at a hashed place. Documents held out
    are never used. ``lang`` serves as the label only."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull()
                          & F.col("text").isNotNull() & ~held_out()
                          ).select("doc_id", "text", "lang")
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n"))
              .collect()}
    if not counts:
        return Model(())
    share = F.create_map(*[F.lit(x) for lang, n in counts.items()
                           for x in (lang, min(1.0, docs_per_lang / n))])
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)) / float(1 << 32)
    most = chars // 40
    over = F.greatest(F.char_length("text") - most, F.lit(0)) + 1
    rows = (labelled.where(place < share[F.col("lang")])
            .withColumn("at", F.xxhash64(F.lit(11), "doc_id"))
            .select("lang", "doc_id", "at", F.substring(
                "text", (F.pmod("at", over) + 1).cast("int"), F.lit(most)).alias("piece"))
            .collect())
    pieces: dict[str, list[tuple[int, int, str]]] = {}
    for r in rows:
        pieces.setdefault(r["lang"], []).append((r["at"], r["doc_id"], r["piece"]))
    samples = tuple((lang, _sample(sorted(found), chars)) for lang, found in sorted(pieces.items()))
    return Model(samples, _reject_rates(samples))


def _sample(pieces: list[tuple[int, int, str]], chars: int) -> str:
    """At most ``chars`` characters of (hash, id, text), in their order: as many
    of each as of any other, or the whole text if it is shorter; a line each."""
    take, left = {}, chars
    for n, i in enumerate(sorted(range(len(pieces)), key=lambda i: len(pieces[i][2]))):
        take[i] = min(len(pieces[i][2]), max(0, left // (len(pieces) - n) - 1))
        left -= take[i] + 1
    lines = []
    for i, (at, _, text) in enumerate(pieces):
        first = (at >> 20) % (len(text) - take[i] + 1)
        lines.append(text[first:first + take[i]] + "\n")
    return "".join(lines)[:chars]


def _reject_rates(samples: tuple[tuple[str, str], ...],
                  least_bytes: int = Model.least_bytes) -> tuple[float, ...]:
    """A limit for each language. The common one is the lowest rate of a long
    sample's characters in random order (its last tenth, shuffled, against its
    rest), for every language whose own last tenth parses better than that. Any
    other has a limit of its own: the rate of its whole sample, shuffled, if half
    of the sample parses the other half better. A language whose sample is too
    short for that, or parses no better in order, has none (1), and takes no
    other language's limit away."""
    rng = np.random.default_rng(7)

    def rate(text: str, sample: str) -> float:
        return rates([text], (("", sample),))[0, 0]

    def shuffled(text: str) -> str:
        return "".join(rng.permutation(list(text)))

    own, noise = {}, {}
    for lang, text in samples:
        cut = len(text) * 9 // 10
        if len(_classes(text[cut:])) >= least_bytes:
            own[lang] = rate(text[cut:], text[:cut])
            noise[lang] = rate(shuffled(text[cut:]), text[:cut])
    common = min((noise[k] for k in noise if own[k] < noise[k]), default=0.0)
    limits = []
    for lang, text in samples:
        limit = common
        if own.get(lang, 1.0) >= common:
            half = len(text) // 2
            limit = 1.0
            if len(_classes(text[half:])) >= least_bytes:
                random_order = rate(shuffled(text), text)
                if rate(text[half:], text[:half]) < random_order:
                    limit = random_order
        limits.append(float(limit))
    return tuple(limits)


def identify(texts: list[str | None], model: Model) -> pd.DataFrame:
    whole = [t or "" for t in texts]
    langs = [lang for lang, _ in model.samples]
    known = np.array([bool(langs) and has_letter(t) for t in texts], dtype=bool)
    if not langs:
        r = np.ones((len(texts), 1))
        langs = ["und"]
    else:
        r = rates(whole, model.samples)
    best = r.argmin(axis=1)  # the first of equals; languages are sorted
    ordered = np.sort(r, axis=1)
    first = ordered[:, 0]
    second = ordered[:, 1] if r.shape[1] > 1 else np.ones(len(r))
    score = np.where(second > 0, 1 - first / np.maximum(second, 1e-12), 0.0)
    sizes = np.array([len(t.encode()) for t in whole])
    limits = np.array(model.reject_rates or [1.0] * r.shape[1])
    # Languages that parse a text equally well: the lowest limit counts.
    limit = np.where(r == first[:, None], limits, np.inf).min(axis=1)
    odd = (sizes >= model.least_bytes) & (first > limit)
    return pd.DataFrame({
        "lang_pred": np.where(known, np.array(langs, dtype=object)[best], "und"),
        "score": np.where(known, np.clip(score, 0, 1), 0.0),
        "rate": first, "rejected": ~known | odd})


def language(text: Column | str, model: Model, spark: SparkSession) -> Column:
    """Struct column (lang_pred, score, rate, rejected) of a text column."""
    shared = spark.sparkContext.broadcast(model)  # languages x chars, a bounded sample

    @F.pandas_udf(SCHEMA)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        return with_release((identify(list(b), shared.value) for b in batches),
                            _parsers.cache_clear)
    return run.asNondeterministic()(text)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    spark = python_ready(docs)
    return docs.select("doc_id", held_out().alias("held_out"),
                       language("text", model, spark).alias("m")).select("doc_id", "held_out", "m.*")


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the rows of ``docs`` whose text is in a learned
    language; all columns as they were. Texts without a letter go, and long
    texts that parse as badly as random characters. A null text goes."""
    python_ready(docs)
    name = scratch_name(docs, "language_of_text")
    found = docs.withColumn(name, language("text", fit(docs), spark))
    return found.where(~F.col(name)["rejected"]).drop(name)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict(docs, fit(docs))
