import hashlib
from collections import Counter

import pytest
from llm.texts import awkward, frame, prose
from txrisk.llm import lines

SPACE = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def brute(rows, documents, code_points=1):
    held = Counter(k for _, text in rows for k in {key(x) for x in (text or "").split("\n")})
    out = []
    for i, text in rows:
        own = (text or "").split("\n")
        kept = [x for x in own if len(key(x)) < code_points or held[key(x)] < documents]
        out.append((i, len(own), len(own) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return Counter(out)


def shared(n):
    """Documents with lines that many, some and few of them hold, in several spellings."""
    out = []
    for i in range(n):
        own = [prose(1000 + i, 6), " All rights reserved.\t", "", prose(i % 7, 5), f"  {prose(i % 40, 4).upper()}"]
        own += ["ÀÉ  ", " ÀÉ", "x"] if i % 3 == 0 else ["all Rights RESERVED.", "all rights reserved."]
        out.append((200 + i, "\n".join(own)))
    return out


@pytest.mark.parametrize("documents, code_points", [(10, 1), (3, 4), (1, 1), (2, 0)])
def test_rows_equal_brute_force(spark, documents, code_points):
    rows = awkward() + shared(60)
    rows += [(400, "x\n" * 3000 + "y"), (401, " " * 100_000 + "z" + " " * 100_000 + "z"), (None, "x"), (400, "\n\n")]
    found = lines.digest(lines.without_shared_lines(frame(spark, rows), documents, code_points)).collect()
    assert Counter(tuple(r) for r in found) == brute(rows, documents, code_points)


def test_a_very_long_text_is_whole(spark):
    rows = [(i, "footer") for i in range(9)] + [(50, "\n".join(f"line {j}\nfooter" for j in range(150_000)))]
    found = {r.doc_id: r for r in lines.digest(lines.without_shared_lines(frame(spark, rows))).collect()}
    assert (found[50].n_lines, found[50].n_dropped) == (300_000, 150_000)
    assert all(found[i].n_dropped == 1 for i in range(9))


def test_other_columns_stay(spark):
    docs = frame(spark, shared(12)).withColumnRenamed("size", "n_lines").withColumnRenamed("hash", "places")
    found = lines.without_shared_lines(docs)
    assert set(found.select("rest.*").columns) == set(docs.columns) - {"text"}
    assert found.count() == 12


def test_empty_table(spark):
    assert lines.digest(lines.without_shared_lines(frame(spark, []))).collect() == []


def test_runs_are_levelled_and_counts_meet_across_levels(spark):
    runs = lines.Runs(spark, files=2, limit=10, fanout=2)
    total = Counter()
    for batch in range(7):
        counts = [(bytes([h]), 1 + (h * batch) % 4) for h in range(40) if (h + batch) % 3]
        total.update(dict(counts))
        runs.add(spark.createDataFrame(counts, "hash binary, documents bigint"))
    assert [len(level) for level in runs.levels] == [1, 1, 1]
    found = {bytes(r.hash) for r in runs.all_frequent().collect()}
    assert found == {h for h, n in total.items() if n >= 10}
