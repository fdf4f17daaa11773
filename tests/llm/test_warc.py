"""Archives that are read in pieces: a piece may end anywhere."""

import gzip
import io

import pytest
from pyspark.sql import Row

from contestry.llm import warc

MEMBERS = [gzip.compress(text, mtime=0) for text in (b"first record", b"", b"x" * 5000, b"last")]


class Pieces(io.BytesIO):
    """Gives at most `most` bytes at a time."""

    def __init__(self, data, most):
        super().__init__(data)
        self.most = most

    def read(self, n=-1):
        return super().read(self.most)


@pytest.mark.parametrize("most", range(1, 60))
def test_members_are_told_wherever_a_piece_ends(most):
    data = b"".join(MEMBERS)
    assert io.BufferedReader(warc.Inflated(Pieces(data, most))).read() == gzip.decompress(data)


@pytest.mark.parametrize("most", [1, 2, 7, 1 << 18])
def test_plain_bytes_pass_also_where_a_piece_begins_like_a_member(most):
    for plain in (b"WARC/1.1\r\n\x1f\x8b and more", b"\x1f", b"W", b"", b"1234567" + MEMBERS[0]):
        assert io.BufferedReader(warc.Inflated(Pieces(plain, most))).read() == plain


def test_records_are_read_wherever_a_piece_ends():
    kind = Row("record_id", "record_type", "target_uri", "warc_date", "content_type", "payload_digest", "refers_to", "page_id", "payload_bytes", "payload")
    made = [(i, b"y" * i) for i in range(100)]
    whole = b"".join(warc.encode_record(kind(f"<urn:page:{i}>", "response", "http://h", None, "text/html", None, None, i, len(p), p)) for i, p in made)
    reader = warc.WarcReader({"path": "x"})
    for most in (1, 3, 1000, 1001):
        assert [(r[7], r[9]) for r in reader.records(io.BufferedReader(warc.Inflated(Pieces(whole, most))))] == made
