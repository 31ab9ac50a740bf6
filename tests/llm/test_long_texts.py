"""Texts of several megabytes, with and without white space, through every operator that reads documents."""

import hashlib
import random
from collections import Counter

import pytest
from llm.texts import frame
from txrisk.llm import decontaminate, mixing, near_dup, pii, quality, sharding, toxicity

WORDS = 350_000


def long_prose(seed):
    rng = random.Random(seed)
    known = ["".join(rng.choice("aeioustrln") for _ in range(rng.randint(2, 9))) for _ in range(20_000)]
    return " ".join(rng.choices(known, k=WORDS))


PASSAGE = " ".join(f"item{i}word" for i in range(60))
LONG = long_prose(1)
TEXTS = {
    1: LONG,
    2: LONG,
    3: LONG + " " + PASSAGE,
    4: "x" * 3_000_000,
    5: "7" * 2_000_000,
    6: "mail m7@host.example, " * 100_000,
    7: "",
}


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, list(TEXTS.items()), partitions=3).cache()


def test_personal_data(docs):
    found = {r.doc_id: r for r in pii.digest(pii.find(docs)).collect()}
    assert found[6].n_email == 100_000 and found[1].n_email == found[4].n_email == 0
    spans = ",".join(f"email:{22 * i + 5}:{22 * i + 20}" for i in range(100_000))
    assert found[6].base_sha256 == hashlib.sha256(spans.encode()).hexdigest()
    assert found[5].n_card == found[5].n_phone == 0


def test_shards(docs):
    found = sharding.shards(docs, 1 << 20).collect()
    assert {r.doc_id: r.bytes for r in found} == {i: len(t) for i, t in TEXTS.items()}


def test_near_duplicates(docs):
    found = {r.doc_id: (r.component_id, r.kept) for r in near_dup.near_duplicates(docs).collect()}
    assert found == {1: (1, True), 2: (1, False), 3: (1, False), **{i: (i, True) for i in (4, 5, 6, 7)}}


def test_mixing(spark):
    rows = [(i, t, "one") for i, t in TEXTS.items()]
    mixed = mixing.mix(frame(spark, rows, "doc_id bigint, text string, source string"), mixing.Target(1.0))
    found = mixed.select("row.doc_id", "tokens").collect()
    assert Counter(tuple(r) for r in found) == Counter((i, len(t.split())) for i, t in TEXTS.items())


def test_benchmark_matches(spark, docs):
    benchmark = spark.createDataFrame([(9, PASSAGE)], "item_id bigint, text string")
    found = decontaminate.benchmark_matches(docs, benchmark).collect()
    assert {r.doc_id for r in found} == {3}


def test_quality(spark, docs):
    found = {r.doc_id: r for r in quality.quality(docs, frame(spark, [], "doc_id bigint, quality int")).collect()}
    assert {i: (r.n_words, r.word_chars) for i, r in found.items()} == {
        i: (len(t.split()), sum(map(len, t.split()))) for i, t in TEXTS.items()
    }
    assert not found[1].base_failed and found[4].base_failed and found[6].base_failed


def test_toxicity(spark, docs):
    labels = [(1, 0), (4, 1)]
    network = toxicity.fit(docs, frame(spark, labels, "doc_id bigint, toxic int"))
    found = {r.doc_id: r.score for r in toxicity.score(docs, network).collect()}
    assert set(found) == set(TEXTS) and found[1] == found[2]
    assert all(0 <= score <= 1 for score in found.values())
