import zlib

import numpy as np
import public_tokenizers
from llm.texts import awkward, frame, prose
from tokenizers import Tokenizer
from txrisk.llm import tokens
from txrisk.llm.shared import new_folder

PATH = public_tokenizers.path(tokens.VOCABULARY)
ODD = [
    "don't we'll''s '' 's", "<|endoftext|>x <|startoftext|>", "ª²½x µm × a b c ﬁ İx Σς ΑΣ",
    "日本語 test a\x1cb\x0bc\x85d", "12 345.67e8", "ÀÉß ẞ STRASSE", "é ́x",
]


def test_encoder_equals_the_library_and_forgets(monkeypatch):
    library = Tokenizer.from_file(PATH)
    texts = ODD + [t or "" for _, t in awkward()]
    want = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    for limit in (10**6, 3):
        monkeypatch.setattr(tokens, "REMEMBERED", limit)
        encoder = tokens.Encoder(PATH)
        for _ in range(2):
            assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == want


def test_files_read_back_in_order(spark):
    rows = awkward() + [(100 + i, t) for i, t in enumerate(ODD)]
    docs = frame(spark, rows)
    path = new_folder(spark, "tokens")
    tokens.write_tokens(docs, path, PATH, file_bytes=4000)
    library = Tokenizer.from_file(PATH)
    found = sorted(tokens.read_tokens(spark, path).collect(), key=lambda r: r.start)
    ids = [r.doc_id for r in found]
    assert ids == sorted(ids, key=lambda i: (i is not None, i)) and len(ids) == len(rows)
    texts = dict(rows)
    start = 0
    for r in found:
        if r.doc_id is not None:
            want = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids + [2]
            assert r.ids == want
        assert r.start == start and r.n_tokens == len(r.ids)
        start += r.n_tokens
    sums = {(r.doc_id, r.start): r.ids_crc32 for r in tokens.token_digest(spark, path).collect()}
    want = {(r.doc_id, r.start): zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in found}
    assert sums == want
    assert spark.read.parquet(path).select("file_no").distinct().count() > 1


def test_empty_table(spark):
    assert tokens.tokenised(frame(spark, []), PATH).collect() == []


def test_files_are_encoded_grouped_and_indexed_for_selective_reads(spark, monkeypatch):
    import pyarrow.parquet as pq

    monkeypatch.setattr(tokens, "ROW_GROUP_BYTES", 1 << 20)
    rows = [(i, prose(i, 400 + i % 200)) for i in range(3000)]
    path = new_folder(spark, "tokens")
    tokens.write_tokens(frame(spark, rows), path, PATH, file_bytes=1 << 30)
    (file,) = spark.read.parquet(path).inputFiles()
    found = pq.ParquetFile(file.removeprefix("file:"))
    meta = found.metadata
    assert meta.num_row_groups > 2 and meta.num_rows == 3000
    columns = {meta.row_group(0).column(j).path_in_schema: meta.row_group(0).column(j) for j in range(meta.num_columns)}
    ids = next(c for name, c in columns.items() if name.startswith("ids"))
    assert "RLE_DICTIONARY" in ids.encodings
    for name in ("doc_id", "n_tokens", "local_start"):
        column = columns[name]
        assert {"DELTA_BINARY_PACKED", "RLE_DICTIONARY"} & set(column.encodings)
        assert column.has_offset_index and column.has_column_index
    # metadata of some documents, and ids of one, without the rest of the columns
    some = tokens.read_tokens(spark, path).where("doc_id BETWEEN 2000 AND 2010")
    plan = some.select("doc_id", "n_tokens")._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\\n") if "ReadSchema" in line]
    assert all("ids" not in line.split("ReadSchema")[1] for line in scans)
    assert any("GreaterThanOrEqual(doc_id,2000)" in line for line in scans)
    library = Tokenizer.from_file(PATH)
    one = tokens.read_tokens(spark, path).where("doc_id = 2500").first()
    assert one.ids == library.encode(rows[2500][1], add_special_tokens=False).ids + [2]


def test_random_strings_equal_the_library():
    import random

    rng, library, encoder = random.Random(3), Tokenizer.from_file(PATH), tokens.Encoder(PATH)
    assert encoder.cuts
    alphabet = "abSTRvelldm'''  \\n\\t5 6é ÀßÿÑ×÷<|>.!?-_日ª\\x0b\\x85́x"
    whole = ["<|endoftext|>", "'s", "'RE", "'ll ", "don't", "I'VE", "''s", "'"]
    texts = [
        "".join(rng.choice(whole) if rng.random() < 0.15 else rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
        for _ in range(5000)
    ]
    want = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == want
    # a file with other rules goes to the library whole
    encoder.cuts = False
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts[:200])] == want[:200]


def test_very_long_texts_are_whole(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(tokens, "PIECE_BYTES", 5000)
    library, encoder = Tokenizer.from_file(PATH), tokens.Encoder(PATH)
    texts = [prose(1, 4000), "", "ab1'" * 4000, "x y " * 6000, "日本 語" * 2000, "z"]
    found = {}
    for first, counts, ids in tokens._whole_rows(encoder, pa.array(texts)):
        ends = np.cumsum(counts)
        found |= {first + i: ids[b - n : b].tolist() for i, (n, b) in enumerate(zip(counts, ends))}
    want = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    assert [found[i] for i in range(len(texts))] == want


def test_pieces_whose_hashes_collide_are_told_apart(monkeypatch):
    library, encoder = Tokenizer.from_file(PATH), tokens.Encoder(PATH)
    monkeypatch.setattr(tokens, "range_hashes", lambda data, a, b: (b - a).astype(np.uint64))
    texts = ["one two three four", "six ten red blue 12 !!", "one ten"]
    want = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == want
