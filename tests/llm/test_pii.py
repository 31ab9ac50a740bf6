import hashlib
import re

from llm.texts import awkward, frame
from txrisk.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TEXTS = [
    "a@b.c_d@e.f, x@y a@b.co.uk-", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.0255 9.9.9.99999999999999999999",
    "4111 1111-1111 1111 and 4111111111111111 " + "1 " * 300, "+1 (017) 555-7713 +" + "1" * 20 + " +12  (",
    "\U0001f642é a@b.cc \U0001f642 10.0.0.1 ñ +49 30 1234567", "9" * 5000 + "." + "1" * 4000,
    "x." * 3000 + "@", "+1+2+34567890123", "@@a@b@c.d@e.f.g", "a@b.c " * 300,
]


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "card":
        total = 0
        for i, c in enumerate(reversed(digits)):
            v = int(c) * (1 + i % 2)
            total += v - 9 * (v > 9)
        return 12 <= len(digits) <= 19 and total % 10 == 0
    return True


def base(text):
    found = [
        (m.start(), rank, kind, m.end())
        for rank, (kind, pattern) in enumerate(PATTERNS.items())
        for m in re.finditer(pattern, text or "")
        if valid(kind, m[0])
    ]
    return sorted(found)


def test_base_spans_equal_brute_force(spark):
    rows = awkward() + [(100 + i, t) for i, t in enumerate(TEXTS)]
    found = pii.digest(pii.find(frame(spark, rows))).collect()
    assert len(found) == len(rows)
    texts = dict(rows)
    for r in found:
        want = base(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x[2] == k for x in want) for k in PATTERNS]
        written = ",".join(f"{k}:{a}:{b}" for a, _, k, b in want)
        assert r.base_sha256 == hashlib.sha256(written.encode()).hexdigest()
        assert set(written.split(",")) - {""} <= set(r.spans.split(","))


def test_added_kinds_need_their_checksum_or_context(spark):
    texts = [
        "pay to DE89370400440532013000 or GB82 WEST 1234 5698 7654 32", "DE89370400440532013001",
        "social security 123-45-6789", "order 123-45-6789", "ssn 000-45-6789",
    ]
    found = {r.doc_id: r.spans for r in pii.digest(pii.find(frame(spark, list(enumerate(texts))))).collect()}
    assert [x.split(":")[0] for x in found[0].split(",")] == ["iban", "iban"]
    assert [found[i] for i in (1, 3, 4)] == [""] * 3
    assert found[2] == "ssn:16:27"


def test_context_moves_the_score(spark):
    rows = [(0, "seen 10.0.0.1"), (1, "server address 10.0.0.1"), (2, "version 10.0.0.1")]
    score = {r.doc_id: r.found[0].score for r in pii.find(frame(spark, rows)).collect()}
    assert score[2] < score[0] < score[1]


def test_empty_table(spark):
    assert pii.digest(pii.find(frame(spark, []))).collect() == []


def test_no_python_in_the_plan(spark):
    plan = pii.digest(pii.find(frame(spark, awkward())))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
