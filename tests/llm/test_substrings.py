import random

import numpy as np
import pytest
from llm.texts import awkward, frame
from pyspark.sql import functions as F
from txrisk.llm import substrings
from txrisk.llm.words import Texts


def brute(rows):
    seen, out = set(), []
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for a in range(len(data) - 99):
            if data[a : a + 100] in seen:
                gone[a : a + 100] = b"\1" * 100
            seen.add(data[a : a + 100])
        spans = sum(1 for j in range(len(gone)) if gone[j] and (j == 0 or not gone[j - 1]))
        kept = bytes(x for x, y in zip(data, gone) if not y)
        out.append((i, len(data), sum(gone), spans, kept))
    return out


def corpus():
    rng = random.Random(5)
    line = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    passage = line("abcdé ", 400)
    rows = [
        (20, "x" * 99), (21, "a" * 500), (22, "ab" * 300), (23, passage), (24, "zz" + passage[50:] + "q"),
        (25, passage[:149] + "!" + passage[150:]), (26, "x" * 100 + "y" * 100 + "x" * 100), (27, "ab" * 200 + "c"),
        (28, passage[:100]), (29, passage[100:] + passage[100:]),
    ]
    for i in range(60):
        at = rng.randrange(200)
        rows.append((30 + i, line("xyz", 50) + passage[at : at + 180] + line("xyz", 60)))
    return rows + awkward()


@pytest.mark.parametrize("bucket_bytes", [substrings.BUCKET_BYTES, 3000])
def test_kept_bytes_equal_brute_force(spark, monkeypatch, bucket_bytes):
    monkeypatch.setattr(substrings, "BUCKET_BYTES", bucket_bytes)
    rows = corpus()
    found = substrings.without_repeats(frame(spark, rows, partitions=3)).collect()
    got = sorted(((r[0], *r[1:4], bytes(r[4])) for r in found), key=repr)
    assert got == sorted(brute(rows), key=repr)


def test_copies_in_one_part_fill_several_buckets(spark, monkeypatch):
    monkeypatch.setattr(substrings, "BUCKET_BYTES", 200_000)
    tables = []

    def stored(df, name):
        tables.append((name, kept := substrings_stored(df, name)))
        return kept

    substrings_stored = substrings.stored
    monkeypatch.setattr(substrings, "stored", stored)
    rng = random.Random(8)
    text = "".join(rng.choice("abcdefgh ") for _ in range(1000))
    found = substrings.without_repeats(frame(spark, [(i, text) for i in range(3000)], partitions=1)).collect()
    assert sum(len(r.kept) for r in found) == 1000
    assert all(r.n_removed == (1000 if r.doc_id else 0) for r in found)
    first = next(t for name, t in tables if name == "suffixes")
    sizes = {r.bucket: r.bytes for r in first.groupBy("bucket").agg(F.sum("size").alias("bytes")).collect()}
    assert sum(sizes.values()) > 20 * 200_000
    assert max(sizes.values()) < 2 * 200_000


def test_empty_table(spark):
    assert substrings.without_repeats(frame(spark, [])).collect() == []


def test_multikey_order_sorts_and_groups():
    rng = random.Random(1)
    texts = [bytes(rng.choice(b"\0ab") for _ in range(rng.randrange(20))) for _ in range(500)]
    order, group = substrings.multikey_order(texts)
    assert [texts[i] for i in order] == sorted(texts)
    ranked = [texts[i] for i in order]
    assert all((ranked[i] == ranked[i - 1]) == (group[i] == group[i - 1]) for i in range(1, 500))
    assert all(a < b for a, b in zip(order, order[1:]) if texts[a] == texts[b])


def test_long_texts_are_cut_into_pieces_without_loss(monkeypatch):
    data = np.random.default_rng(2).integers(97, 123, 5000).astype(np.uint8)
    chunk = Texts(0, data, np.array([0, 1200, 1250, 5000]))
    whole = substrings.runs(chunk)
    monkeypatch.setattr(substrings, "PIECE", 700)
    pieces = substrings.runs(chunk)

    def strings(found):
        return {(s, a) for _, x, y, a, _ in zip(*found) for s in range(x, y + 1)}

    assert strings(whole) == strings(pieces)
    assert {s for s, _ in strings(whole)} == {*range(0, 1101), *range(1250, 4901)}


def test_found_runs_are_kept_and_joined_without_their_texts(spark, monkeypatch):
    tables, kept = [], substrings.stored
    monkeypatch.setattr(substrings, "stored", lambda df, name: tables.append((name, found := kept(df, name))) or found)
    rows = corpus()
    found = substrings.without_repeats(frame(spark, rows, partitions=3)).collect()
    assert sorted(((r[0], *r[1:4], bytes(r[4])) for r in found), key=repr) == sorted(brute(rows), key=repr)
    suffixes = [table for name, table in tables if name == "suffixes"]
    assert len(suffixes) == len(substrings.BLOCKS)
    for table in suffixes:
        # the head of a bucket has its two edges, nothing else has text
        assert {f.name for f in table.schema if f.dataType.simpleString() == "binary"} == {"low", "high"}
        assert table.where("NOT head AND (low IS NOT NULL OR high IS NOT NULL)").isEmpty()
