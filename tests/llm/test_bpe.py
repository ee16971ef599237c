"""Byte-level BPE against the tiktoken library, and exact round trips."""

import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_helpers import edge_rows, frame  # noqa: F401

from tramline.llm.bpe import codec, decode, encode, token_digests


@pytest.fixture(scope="module")
def peer():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("peer", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=80), st.text(alphabet="ab '\n\t-.é漢\U0001F600", max_size=120)))
def test_ids_equal_the_peer(peer, text):
    c = codec()
    ids = c.encode(text)
    assert ids == peer.encode_ordinary(text)
    assert c.decode(ids) == text


def test_offsets_cover_split_characters():
    c = codec()
    text = "naïve 漢字\U0001F600 end"
    ids = c.encode(text)
    starts, ends = c.offsets(text, ids)
    assert starts[0] == 0 and ends[-1] == len(text)
    for i, a, z in zip(ids, starts, ends):
        piece = c.bytes_of[i]
        assert piece in text[a:z].encode()  # a cut character is spanned whole
    assert c.offsets("", [])[0].size == 0


def test_digests_of_edge_rows(frame, edge_rows, peer):
    got = token_digests(frame(edge_rows)).collect()
    assert len(got) == len(edge_rows)
    texts = {r[0]: r[1] or "" for r in edge_rows}
    for r in got:
        ids = peer.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_columns_round_trip(frame, edge_rows):
    docs = frame(edge_rows)
    back = docs.withColumn("t", encode("text")).withColumn("b", decode("t.ids"))
    for r in back.select("text", "b", "t").collect():
        assert bytes(r.b).decode() == (r.text or "")
        assert len(r.t.ids) == len(r.t.starts) == len(r.t.ends)


def test_empty_table(frame):
    assert token_digests(frame([])).count() == 0
