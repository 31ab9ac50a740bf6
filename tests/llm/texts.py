"""Small tables with the awkward rows, and words as the operators count them."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
EXTRA = ", id bigint, key string, bucket int, size string, tokens double, hash string, score string"


def words(text, lower=True):
    text = text or ""
    if lower:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return WORD.findall(text)


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("aeiourstln") for _ in range(rng.randint(2, 8))) for _ in range(n))


def awkward():
    """(doc_id, text): null and empty texts, blanks, ties, repeated rows, copies, odd characters."""
    base = prose(1, 80)
    return [
        (5, None),
        (6, ""),
        (7, " \t\n\x0b "),
        (8, "one"),
        (9, "One"),
        (10, base),
        (11, base.upper()),
        (12, base + " more"),
        (13, "é\U0001f642 " * 30),
        (14, prose(2, 3000)),
        (15, "x" * 5000),
        (15, "x" * 5000),
        (None, base),
        (None, None),
    ]


def frame(spark, rows, columns="doc_id bigint, text string", partitions=2):
    """The rows with further columns whose names the operators use themselves, holding nulls."""
    width = len(columns.split(","))
    extra = (None,) * (len(EXTRA.split(",")) - 1)
    rows = [tuple(r[:width]) + extra for r in rows]
    return spark.createDataFrame(rows, columns + EXTRA).repartition(partitions)
