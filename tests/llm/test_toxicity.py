import random
import zlib

import numpy as np
import pytest
from llm.texts import awkward, frame, prose
from txrisk.llm import toxicity

LABELS = "doc_id bigint, toxic int"


def corpus(n=600):
    """Every third document has bad words: two known ones, or words of one bad beginning."""
    rng, rows, labels = random.Random(8), [], []
    for i in range(1000, 1000 + n):
        w = prose(i, rng.randint(20, 150)).split()
        bad = i % 3 == 0
        if bad:
            for _ in range(max(2, len(w) // 30)):
                stem = "zqxv" + "".join(rng.choice("aeiou") for _ in range(4))
                w.insert(rng.randrange(len(w)), rng.choice(["vile", "rotten", stem]))
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    return rows, labels


@pytest.fixture(scope="module")
def network(spark):
    rows, labels = corpus()
    labels += [(None, 1), (1001, None), (1002, 7)]
    return toxicity.fit(frame(spark, rows), frame(spark, labels, LABELS))


def test_held_out_documents_are_told_apart(spark, network):
    rows, labels = corpus()
    truth = dict(labels)
    found = toxicity.score(frame(spark, rows), network).collect()
    assert {r.doc_id: r.held_out for r in found} == {
        i: zlib.crc32(str(i).encode()) % 3 == 1 for i, _ in rows
    }
    hit = [r.predicted == truth[r.doc_id] for r in found if r.held_out]
    assert np.mean(hit) > 0.95
    assert all(r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in found)


def test_held_out_labels_teach_nothing(spark):
    rows, labels = corpus(200)
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, y in labels]
    a = toxicity.fit(frame(spark, rows), frame(spark, labels, LABELS))
    b = toxicity.fit(frame(spark, rows), frame(spark, turned, LABELS))
    assert (a.tables == b.tables).all() and (a.pool == b.pool).all()


def test_awkward_rows(spark, network):
    rows = awkward()
    found = toxicity.score(frame(spark, rows), network).collect()
    assert len(found) == len(rows)
    empty = {r.score for r in found if r.doc_id in (5, 6, 7)}
    assert len(empty) == 1 and not np.isnan(empty.pop())
    docs = frame(spark, rows)
    assert toxicity.clean(docs, network).columns == docs.columns
    assert toxicity.score(frame(spark, []), network).collect() == []


@pytest.mark.parametrize("labels", [[], [(1000, 1)], [(1000, 0), (1001, None)]])
def test_without_both_classes_scores_are_the_share(spark, labels):
    rows, _ = corpus(10)
    found = toxicity.score(frame(spark, rows), toxicity.fit(frame(spark, rows), frame(spark, labels, LABELS)))
    assert len({r.score for r in found.collect()}) == 1


def test_gradients_equal_differences():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3, toxicity.WINDOW, toxicity.INPUTS))
    y = np.array([0.0, 1.0, 1.0])
    weights = {k: v.astype(np.float64) for k, v in toxicity.train(np.zeros((0, 1)), None).items()}

    def loss(w):
        inputs = x.reshape(-1, toxicity.INPUTS)
        places = np.arange(len(inputs)).reshape(3, -1)
        logit = toxicity.Network(None, w, None).window_logits(inputs, places).astype(np.float64)
        return np.mean(np.log1p(np.exp(logit)) - y * logit)

    found = toxicity._gradients(x, y, weights)
    for name, value in weights.items():
        at = tuple(0 for _ in value.shape)
        near = []
        for by in (0.02, -0.02):
            w = {k: v.copy() for k, v in weights.items()}
            w[name][at] += by
            near.append(loss(w))
        assert found[name][at] == pytest.approx((near[0] - near[1]) / 0.04, rel=0.05, abs=2e-4)


def test_windows_cover_every_word():
    bounds = np.array([0, 0, 5, 5 + 32, 37 + 33, 70 + 200])
    places, owner = toxicity.overlapping(bounds)
    for t, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
        own = places[owner == t]
        assert set(own[own < bounds[-1]].tolist()) == set(range(a, b)) and len(own)
