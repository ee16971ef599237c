"""Archives: round trip, other writers' ZIP files, ZIP64, contents by range."""

import base64
import hashlib
import io
import zipfile

import pytest

from tramline.llm import warc_zip as W
from tramline.session import fresh_dir

PAGES = [(1, "http://a/", "<p>same</p>"), (2, None, "<p>same</p>"), (3, "http://c/\r\nx", None),
         (4, "http://d/", ""), (5, "http://e/", "é\U0001F600" * 5000), (None, "http://f/", "lone"),
         (None, "http://g/", "<p>same</p>"), (2, "http://h/", "<p>same</p>"),
         (2**62 + 1, "http://i/", "big id"), (2**62 + 3, "http://j/", "big id"), (9, "u", "\r\n\r\n")]


def expected():
    out = []
    for page, _, html in PAGES:
        raw = (html or "").encode()
        ids = [p for p, _, h in PAGES if (h or "") == (html or "") and p is not None]
        top = max(ids, default=None)
        own = page == top
        out.append((page, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                    "response" if own else "revisit", None if own else top))
    return sorted(out, key=str)


@pytest.fixture
def pages(spark):
    return spark.createDataFrame([(*p, 0) for p in PAGES],
                                 "page_id long, url string, html string, payload long")


def test_round_trip(spark, pages):
    folder = fresh_dir(spark, "warc-test")
    manifest = W.write_archives(pages, folder)
    assert sum(r.n_records for r in manifest.collect()) == len(PAGES)
    for paths in (manifest, W.list_archives(spark, folder)):
        rows = W.read_archives(paths).collect()
        got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                      for r in rows), key=str)
        assert got == expected()
    assert {bytes(r.payload).decode() for r in rows if r.record_type == "response"} \
        == {h or "" for _, _, h in PAGES}


def test_archives_are_plain_zip_files(spark, pages):
    """Python's own reader finds the members, and gunzips the records."""
    import gzip
    n = 0
    for r in W.write_archives(pages, fresh_dir(spark, "warc-test")).collect():
        with zipfile.ZipFile(r.path.removeprefix("file:")) as z:
            assert z.testzip() is None
            assert sorted(z.namelist()) == ["archive/data.warc.gz", "indexes/index.cdxj"]
            n += gzip.decompress(z.read("archive/data.warc.gz")).count(b"WARC/1.1\r\n")
    assert n == len(PAGES)


def test_small_archives_and_ranges(spark, pages, monkeypatch):
    rows = [(i, f"http://x/{i}", f"page {i} " * 50, None) for i in range(40)]
    source = iter([(f"u{i}", W.warc_record(i, u, h, None)) for i, u, h, _ in rows])
    monkeypatch.setattr(W, "ARCHIVE_BYTES", 1500)
    monkeypatch.setattr(W, "RANGE_BYTES", 300)
    folder = fresh_dir(spark, "warc-test")
    written = []
    while True:
        uri, n = W._write_archive(folder, source)
        if not n:
            break
        written.append((uri, n))
    assert len(written) > 2 and sum(n for _, n in written) == 40
    assert sum(len(list(W._ranges(u))) for u, _ in written) > len(written)


class Buffer:
    def __init__(self, raw):
        self.raw, self.size = raw, len(raw)

    def read(self, first, length):
        return self.raw[first:first + length]


@pytest.mark.parametrize("zip64, comment", [(False, b""), (True, b""), (False, b"PK\5\6 in a comment"),
                                            (True, b"x" * 300)])
def test_directory(zip64, comment, monkeypatch):
    if zip64:  # force 64-bit records as if the archive were huge
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        z.comment = comment
        for i in range(5):
            z.writestr(f"archive/é{i}.warc.gz", bytes([65 + i]) * (20 + i))
    members = W.directory(Buffer(out.getvalue()))
    assert len(members) == 5
    for i in range(5):
        at, size, method = members[f"archive/é{i}.warc.gz"]
        assert out.getvalue()[at:at + size] == bytes([65 + i]) * (20 + i) and method == 0


def test_broken_files_raise():
    with pytest.raises(ValueError):
        W.directory(Buffer(b"not an archive at all"))


def test_damaged_payload_raises():
    import zlib
    raw = zlib.decompress(W.warc_record(1, "u", "payload", None), 31).replace(b"payload\r\n", b"pAyload\r\n")
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    with pytest.raises(ValueError):
        W.parse_record(packer.compress(raw) + packer.flush(), True)


def test_empty_table(spark, pages):
    manifest = W.write_archives(pages.limit(0), fresh_dir(spark, "warc-test"))
    assert manifest.count() == 0 and W.read_archives(manifest).count() == 0
