"""Stages in their order on the smallest tables, each held against what its operator says."""

import corpus_pipeline
import pytest
from llm.test_near_dup import brute as near_dup_brute
from llm.texts import words
from txrisk.llm.shared import stored, table

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF_DIR, "documents"), []
    out.append(("documents", docs))
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF_DIR), "stage")
        out.append((name, docs))
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_all_but_the_last_keep_the_columns(stages):
    for _, df in stages[1:-1]:
        assert df.dtypes == stages[0][1].dtypes


def test_near_duplicates_leave_one_of_each_group(stages):
    rows = [(r.doc_id, r.text) for r in stages[1][1].collect()]
    kept = [i for i, (_, _, keep) in near_dup_brute(rows, 5).items() if keep]
    assert ids(stages[2][1]) == sorted(kept)


def test_no_benchmark_passage_is_left(spark, stages):
    items = [tuple(words(r.text)) for r in table(spark, SF_DIR, "benchmark").collect()]
    before, after = ({r.doc_id: words(r.text) for r in s[1].collect()} for s in stages[2:4])

    def holds(w):
        text = " " + " ".join(w) + " "
        return any(" " + " ".join(x) + " " in text for x in items)

    assert not any(holds(w) for w in after.values())
    lost = set(before) - set(after)
    assert len(lost) <= 2 + sum(holds(w) for w in before.values())


def test_mixing_uses_every_document(stages):
    before, after = ids(stages[3][1]), ids(stages[4][1])
    assert set(before) == set(after)
    assert max(after.count(i) for i in set(after)) <= 2


def test_tokens_of_every_row_follow_one_another(stages):
    rows = sorted(stages[5][1].collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == ids(stages[4][1])
    assert all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:]))


COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def odd_documents(spark, rows):
    from llm.texts import frame

    return frame(spark, [(i, t, None, "hot" if i else None, 1) for i, t in rows], COLUMNS)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_odd_rows_and_empty_tables(spark, name, stage):
    from llm.texts import awkward

    rows = awkward() + [(20, "x" * 2_000_000), (21, "many words " * 100_000)]
    docs = stored(odd_documents(spark, rows), "odd")
    found = stored(stage(spark, docs, SF_DIR), "stage")
    if name == "token ids":
        found = found.collect()
        assert sorted(str(r.doc_id) for r in found) == sorted(str(i) for i, _ in rows)
        return
    assert found.dtypes == docs.dtypes
    left = {(r.doc_id, r.text) for r in found.collect()}
    assert left <= set(rows)
    if name in ("decontamination", "mixing"):
        assert left == set(rows)
    if name == "near duplicates":
        # one of the copies under ids 10, 11, 12 and none, one of two equal rows, all rows without words
        assert found.count() == len(rows) - 5
    assert stage(spark, stored(odd_documents(spark, []), "none"), SF_DIR).dtypes == docs.dtypes
    assert stage(spark, stored(odd_documents(spark, []), "none"), SF_DIR).count() == 0
