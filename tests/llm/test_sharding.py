import hashlib
from collections import Counter, defaultdict

import pytest
from llm.texts import awkward, frame, prose
from txrisk.llm import sharding


def brute(rows, limit):
    """doc -> (bits, bytes of the bucket), splitting bucket by bucket."""
    docs = []
    for i, text in rows:
        data = (text or "").encode()
        digest = hashlib.md5(f"{'' if i is None else i}:".encode() + data).hexdigest()[:15]
        docs.append((i, bin(int(digest, 16))[2:].zfill(60), len(data)))
    out, todo = [], [("", docs)]
    while todo:
        bits, own = todo.pop()
        size = sum(d[2] for d in own)
        if size <= limit or len(bits) == 60:
            out += [(d[0], bits, size) for d in own]
        else:
            for b in "01":
                todo.append((bits + b, [d for d in own if d[1][len(bits)] == b]))
    return out


@pytest.mark.parametrize("limit", [10**9, 6000, 400])
def test_shards_equal_bucket_by_bucket_splitting(spark, limit):
    rows = [r for r in awkward() if r[0] not in (15,)] + [(100 + i, prose(i, 10 + i)) for i in range(80)]
    found = sharding.shards(frame(spark, rows), limit).collect()
    want = Counter(brute(rows, limit))
    assert Counter((r.doc_id, r.shard, r.shard_bytes) for r in found) == want
    assert all(r.depth == len(r.shard) for r in found)


def test_equal_rows_are_chained(spark):
    rows = [(7, "x" * 100)] * 50 + [(None, "y" * 70)] * 33 + [(1, "z" * 5000), (2, "z")]
    found = sharding.shards(frame(spark, rows, partitions=4), 1000).collect()
    assert Counter(r.doc_id for r in found) == Counter(i for i, _ in rows)
    size = defaultdict(int)
    for r in found:
        size[r.shard] += r.bytes
    assert all(size[r.shard] == r.shard_bytes for r in found)
    assert sorted(s for s in size.values() if s > 1000) == [5000]
    assert sharding.directory(sharding.shards(frame(spark, rows), 1000)).count() == len(size)


def test_empty_table(spark):
    assert sharding.shards(frame(spark, [])).collect() == []
