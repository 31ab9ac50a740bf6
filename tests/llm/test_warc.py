import gzip
import hashlib

import pyarrow.fs as fs
import pytest
from llm.texts import frame
from txrisk.llm import warc
from txrisk.llm.shared import new_folder

LONG = "<p>" + "é\r\n\r\n\0" * 60
PAGES = [
    (3, "http://a/\r\nX: y", LONG), (1, None, LONG), (2, "http://c/ d", LONG), (4, "u", "short"), (5, "u", "short"),
    (6, "u", None), (7, "", ""), (8, "u", "\U0001f642" * 25), (9, "u", "\U0001f642" * 25), (None, "u", LONG),
    (10, "u", "WARC/1.1\r\nContent-Length: 5\r\n\r\n" * 10), (11, "u", "z" * 3_000_000), (11, "u", "z" * 3_000_000),
    (12, "u", "z" * 3_000_000),
]
COLUMNS = "page_id bigint, url string, html string"


def expected():
    out = []
    for page_id, _, html in PAGES:
        data = (html or "").encode()
        same = [i for i, _, h in PAGES if h == html and i is not None]
        refers = min(same) if len(data) >= 100 and page_id is not None and page_id > min(same) else None
        kind = "response" if refers is None else "revisit"
        out.append((page_id, kind, len(data), hashlib.sha256(data).hexdigest(), refers))
    return sorted(out, key=repr)


def test_round_trip(spark):
    found = warc.archive(frame(spark, PAGES, COLUMNS, 3)).collect()
    assert sorted((tuple(r) for r in found), key=repr) == expected()


def test_members_stand_alone_and_hold_what_the_stream_held(spark):
    folders = [new_folder(spark, name) for name in ("mono", "members")]
    archives = warc.write_archives(warc.with_revisits(frame(spark, PAGES, COLUMNS, 2)), folders[0])
    files = warc.normalise(archives, folders[1]).collect()
    mono = {r.path.rsplit("/", 1)[1]: r.path for r in archives.collect()}
    assert sum(r.n_records for r in files) == len(PAGES)
    for r in files:
        system, path = fs.FileSystem.from_uri(r.path)
        raw = system.open_input_file(path).readall()
        index = system.open_input_file(fs.FileSystem.from_uri(r["index"])[1]).readall().decode().splitlines()
        members = []
        for line in index:
            offset, length, name = line.split(" ", 2)
            members.append(gzip.decompress(raw[int(offset) : int(offset) + int(length)]))
            assert warc.parse(members[-1])[0]["warc-record-id"] == name
        stream = system.open_input_file(fs.FileSystem.from_uri(mono[r.path.rsplit("/", 1)[1]])[1]).readall()
        assert b"".join(members) == gzip.decompress(stream) == gzip.decompress(raw)


def test_cut_archive_is_an_error(tmp_path):
    path = tmp_path / "a.warc.gz"
    path.write_bytes(gzip.compress(warc.record(1, "u", b"x" * 500, "d", None))[:-60])
    with pytest.raises(ValueError, match="ends within a record"):
        list(warc._records(f"file://{path}"))


def test_empty_table(spark):
    assert warc.archive(frame(spark, [], COLUMNS)).collect() == []
