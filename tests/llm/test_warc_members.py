"""WARC files with many records in a member, or with damage."""

import gzip

from catalyne.llm import warc


def test_records_of_a_whole_file_and_after_damage():
    made = [warc.response(i, f"u{i}", f"<p>{i}") for i in range(5)]
    whole = b"".join(made)
    assert list(warc.members(whole)) == made
    assert list(warc.members(gzip.compress(whole))) == made
    assert list(warc.members(gzip.compress(made[0]) + gzip.compress(b"".join(made[1:])))) == made
    assert list(warc.members(made[0] + b"damage\r\n" + b"".join(made[1:]))) == made
    cut = made[0] + made[1][:60] + b"".join(made[2:])
    assert list(warc.members(cut))[-3:] == made[2:]
    far = made[1].replace(b"Content-Length: ", b"Content-Length: 9999")
    assert list(warc.members(made[0] + far + b"".join(made[2:])))[-3:] == made[2:]
    assert list(warc.members(gzip.compress(made[0]) + b"junk" + gzip.compress(made[1]))) == made[:2]
    assert list(warc.members(b"")) == list(warc.members(b"junk")) == []
