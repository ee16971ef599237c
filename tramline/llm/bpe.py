"""Byte-level BPE encoding and decoding with the tokenizers library.

A rank file (token bytes in base64, rank) is turned into the library's own
form: every byte is written as one printable character (the byte table
below), and a token's merges are all its cuts into two known tokens, in rank
order. Texts are split by the pattern and their new pieces encoded by the
library, batch by batch as they arrive in Arrow; the ids of a text are decoded by reversing the byte table. Token borders may fall inside a
character: such tokens decode to bytes that are no valid UTF-8 alone, which
is why decoding joins bytes first and reads characters last.

Defined results: a null text counts as empty, gives no ids and decodes to the
empty text; ids that the vocabulary does not have raise an error; an empty table
gives an empty table, repeated rows a row each; other columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm.common import python_ready, table, with_release

#: Distinct pieces of text (matches of the pattern) whose ids a worker keeps;
#: beyond it the store starts anew, so memory is bounded.
KNOWN_PIECES = 500_000
#: Texts of these characters (Latin letters, general punctuation) are split by
#: the regex module, others by the tokenizers library: the two know different
#: versions of the Unicode tables, which agree here, and the former is faster.
PLAIN = r"[\x00-\u024F\u2000-\u206F]*"


def byte_characters() -> list[str]:
    """The character that stands for each byte: printable bytes for
    themselves, the others in order from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return [chr(b) if b in set(printable) else chr(0x100 + rest.index(b)) for b in range(256)]


class Codec:
    """Encoder and decoder for one rank file and one splitting pattern."""

    def __init__(self, path: str, pattern: str):
        import regex
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        table_ = byte_characters()
        name = {t: "".join([table_[b] for b in t]) for t in ranks}
        merges = [(name[t[:i]], name[t[i:]])
                  for t, _ in sorted(ranks.items(), key=lambda x: x[1])
                  for i in range(len(t) - 1, 0, -1) if t[:i] in ranks and t[i:] in ranks]
        model = models.BPE(vocab={name[t]: r for t, r in ranks.items()}, merges=merges,
                           ignore_merges=True)
        self.tokenizer = Tokenizer(model)
        # Pieces are split off before the library is called, so that a piece
        # seen before is not encoded again.
        self.tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(
            add_prefix_space=False, use_regex=False)
        self.split = pre_tokenizers.Split(Regex(pattern), "isolated")
        self.find = regex.compile(pattern).findall
        self.plain = regex.compile(PLAIN).fullmatch
        self.known: dict[str, tuple[int, ...]] = {}
        # Decoding goes back from the library's own token names to bytes.
        byte_of = {c: b for b, c in enumerate(table_)}
        size = max(ranks.values()) + 1
        self.bytes_of: list[bytes] = [b""] * size
        for token, i in self.tokenizer.get_vocab().items():
            self.bytes_of[i] = bytes([byte_of[c] for c in token])
        self.digits = [str(i) for i in range(size)]
        self.lengths = np.array([len(b) for b in self.bytes_of])

    def pieces(self, text: str) -> list[str]:
        """Matches of the pattern, in order; they cover the text."""
        if text.isascii() or self.plain(text):
            return self.find(text)
        return [p for p, _ in self.split.pre_tokenize_str(text)]

    def encode(self, text: str) -> list[int]:
        pieces = self.pieces(text)
        known = self.known
        try:
            return list(chain.from_iterable(map(known.__getitem__, pieces)))
        except KeyError:
            pass
        new = [p for p in set(pieces) if p not in known]
        if len(known) + len(new) > KNOWN_PIECES:
            known.clear()
            new = list(set(pieces))
        found = self.tokenizer.encode_batch_fast(new, add_special_tokens=False)
        # Tuples of numbers are no concern of the garbage collector's.
        known.update((p, tuple(e.ids)) for p, e in zip(new, found))
        return list(chain.from_iterable(map(known.__getitem__, pieces)))

    def offsets(self, text: str, ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """First and one-past-last character of each token, by way of bytes: a
        token that begins or ends inside a character spans that character."""
        raw = np.frombuffer(text.encode(), dtype=np.uint8)
        char_at = np.cumsum((raw & 0xC0) != 0x80) - 1  # of each byte
        ends = np.cumsum(self.lengths[np.array(ids, dtype=np.int64)])
        starts = np.concatenate([[0], ends[:-1]]) if len(ids) else ends
        if not len(ids):
            return starts, ends
        return char_at[starts], char_at[ends - 1] + 1

    def decode_bytes(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def decode(self, ids) -> str:
        """Text of a run of ids; characters cut at its ends become U+FFFD."""
        return self.decode_bytes(ids).decode("utf-8", errors="replace")


@lru_cache(maxsize=4)
def codec(path: str | None = None, pattern: str | None = None) -> Codec:
    """The codec of a worker process; by default the multilingual rank file."""
    import os
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    import public_tokenizers
    return Codec(path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                 pattern or public_tokenizers.PATTERN)


def encode(text: Column | str, path: str | None = None, pattern: str | None = None) -> Column:
    """Struct column (ids, starts, ends): token ids with character offsets."""
    @F.pandas_udf("ids array<int>, starts array<int>, ends array<int>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        c = codec(path, pattern)

        def spans(texts: pd.Series) -> pd.DataFrame:
            rows = []
            for t in texts:
                ids = c.encode(t or "")
                rows.append((np.array(ids, dtype=np.int32), *c.offsets(t or "", ids)))
            return pd.DataFrame(rows, columns=["ids", "starts", "ends"])
        return with_release(map(spans, batches), c.known.clear)
    return run(text)


def decode(ids: Column | str, path: str | None = None, pattern: str | None = None) -> Column:
    """Binary column: the bytes that an array of token ids stands for."""
    @F.pandas_udf("binary")
    def run(rows: pd.Series) -> pd.Series:
        c = codec(path, pattern)
        return pd.Series([c.decode_bytes(r if r is not None else ()) for r in rows], dtype=object)
    return run(ids)


def round_trip(text: Column | str, path: str | None = None, pattern: str | None = None) -> Column:
    """Struct column: token count and digests of ids and decoded bytes. Ids of
    a text are encoded, decoded and digested in one pass and never stored."""
    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string, exact boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        c = codec(path, pattern)

        def digests(texts: pd.Series) -> pd.DataFrame:
            rows = []
            for t in texts:
                ids = c.encode(t or "")
                back = c.decode_bytes(ids)
                listed = ",".join(map(c.digits.__getitem__, ids)).encode()
                rows.append((len(ids), hashlib.sha256(listed).hexdigest(),
                             hashlib.sha256(back).hexdigest(), back == (t or "").encode()))
            return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256",
                                               "exact"])
        return with_release(map(digests, batches), c.known.clear)
    return run.asNondeterministic()(text)


def token_digests(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id and the round trip's digests."""
    python_ready(docs)
    return docs.select("doc_id", round_trip("text").alias("r")).select("doc_id", "r.*")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"))
