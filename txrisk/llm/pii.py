"""Personal data in whole texts. DataFrame functions only.

Regular expressions propose spans, checksum validators (Luhn, mod 97) and number ranges confirm
them, and words before a span raise or lower its score. A kind whose pattern is strict starts high
and is kept whatever the context; a kind that looks like ordinary numbers needs the context.

Positions come from the text between matches: splitting at the pattern gives what lies between, so a
match starts at the running sum of the lengths of what is before it. Everything happens in the row;
nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The four base patterns. Local parts and digit runs start where their run starts or
#: a match ended, which changes no match and keeps long runs from being tried at every character.
EMAIL = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: What the method adds to the base kinds.
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn")
PATTERNS = dict(zip(KINDS, (EMAIL, IP, CARD, PHONE, IBAN, SSN)))
#: A character that every match of a kind holds; texts without it are not searched.
NEEDS = dict(zip(KINDS, ("@", ".", None, "+", None, "-")))
#: Score of a confirmed span without context; base kinds are kept at any score.
PRIOR = {"email": 0.95, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "ssn": 0.3}
#: Words in the CONTEXT characters before a span that make its kind likelier.
CONTEXT = 40
WORDS = {
    "email": "mail|e-mail|contact|write",
    "ip": "ip|address|host|server|login",
    "card": "card|visa|credit|debit|payment|karte|carte|tarjeta",
    "phone": "phone|tel|call|fax|mobile|telefon|teléfono",
    "iban": "iban|account|bank|konto|compte|cuenta",
    "ssn": "ssn|social|security|insurance",
}
#: Words that speak against personal data of any kind.
AGAINST = "version|release|example|order|serial|isbn"
RAISE, LOWER, LEAST = 0.4, 0.2, 0.5


def _prefix_sums(lengths: Column) -> Column:
    """Running sums of an array, by doubling: each step adds what lies 1, 2, 4 ... places before."""
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(lengths) + 1)).cast("int"))

    def step(sums: Column, k: Column) -> Column:
        by = F.least(F.pow(F.lit(2), k).cast("int"), F.size(sums))
        zeros = F.array_repeat(F.lit(0).cast("bigint"), by)
        return F.zip_with(
            sums, F.concat(zeros, F.slice(sums, F.lit(1), F.size(sums) - by)), lambda x, y: x + y
        )

    return F.aggregate(steps, lengths, step)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Sum of the digits, every second from the right doubled and its digits added, in tens."""
    back = F.reverse(digits)
    twice = F.translate(back, "0123456789", "0246813579")

    def add(total: Column, i: Column) -> Column:
        digit = F.when(i % 2 == 1, F.substr(back, i, F.lit(1))).otherwise(F.substr(twice, i, F.lit(1)))
        return total + digit.cast("int")

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def mod_97(account: Column) -> Column:
    """An account number whose first four characters go last, letters counting from 10, is 1 mod 97."""
    plain = F.replace(account, F.lit(" "), F.lit(""))
    moved = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))

    def add(rest: Column, i: Column) -> Column:
        code = F.ascii(F.substr(moved, i, F.lit(1)))
        return F.when(code < 65, rest * 10 + code - 48).otherwise(rest * 100 + code - 55) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), add) == 1


def confirmed(kind: str, match: Column) -> Column:
    if kind == "ip":
        part = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
        return match.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        digits = _digits(match)
        return F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    if kind == "iban":
        return mod_97(match)
    if kind == "ssn":
        return ~match.rlike("^(?:000|666|9)") & ~match.rlike("-00-") & ~match.rlike("-0000$")
    return F.lit(True)


def _score(kind: str, before: Column) -> Column:
    near = F.lower(F.right(before, F.lit(CONTEXT)))
    said = F.when(near.rlike(rf"\b(?:{WORDS[kind]})\b"), RAISE).otherwise(0.0)
    denied = F.when(near.rlike(rf"\b(?:{AGAINST})\b"), LOWER).otherwise(0.0)
    return F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.lit(PRIOR[kind]) + said - denied)), 2)


def _span(kind: str, rank: int, text: Column, end: Column, before: Column) -> Column:
    return F.struct(
        (end - F.length(text)).alias("start"),
        F.lit(rank).alias("rank"),
        F.lit(kind).alias("kind"),
        end.alias("end"),
        F.when(confirmed(kind, text), _score(kind, before)).alias("score"),
    )


def _is_kind(kind: str):
    return lambda x: x["kind"] == kind


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, found): for each row of docs (doc_id, text) all its spans, an array of (start, rank,
    kind, end, score) by start, then by the kind's rank in KINDS.

    Positions count code points and the end is exclusive. A null text counts as empty and has no
    spans. A null doc_id is carried along; repeated rows are searched each. Other columns of docs
    are not read. Matches of a kind never overlap; spans of different kinds may.
    """
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    rows = rows.withColumn("digit", F.col("text").rlike("[0-9]"))
    none = F.array().cast("array<string>")
    for kind in KINDS:
        asked = F.lit(True) if kind == "email" else F.col("digit")
        if NEEDS[kind]:
            asked = asked & (F.instr("text", NEEDS[kind]) > 0)
        matches = F.regexp_extract_all("text", F.lit(PATTERNS[kind]), F.lit(0))
        rows = rows.withColumn(f"m_{kind}", F.when(asked, matches).otherwise(none))
        gaps = F.split("text", PATTERNS[kind], -1)
        rows = rows.withColumn(f"g_{kind}", F.when(F.size(f"m_{kind}") > 0, gaps).otherwise(none))
    for rank, kind in enumerate(KINDS):
        # gaps and matches in turn: a match starts where all before it ends
        pair = F.zip_with(
            F.slice(f"g_{kind}", F.lit(1), F.size(f"m_{kind}")),
            f"m_{kind}",
            lambda g, m: (F.length(g) + F.length(m)).cast("bigint"),
        )
        ends = F.zip_with(
            _prefix_sums(pair), f"m_{kind}", lambda e, m: F.struct(e.alias("end"), m.alias("text"))
        )
        spans = F.zip_with(
            ends,
            F.slice(f"g_{kind}", F.lit(1), F.size(f"m_{kind}")),
            lambda x, before: _span(kind, rank, x["text"], x["end"], before),
        )
        least = 0.0 if kind in BASE else LEAST
        spans = F.filter(spans, lambda x: x["score"] >= least)
        empty = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint,score:double>>")
        rows = rows.withColumn(f"s_{kind}", F.when(F.size(f"m_{kind}") > 0, spans).otherwise(empty))
    found = F.array_sort(F.concat(*[F.col(f"s_{kind}") for kind in KINDS]))
    return rows.select("doc_id", found.alias("found"))


def digest(found: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) from the result of find()."""

    def written(spans: Column) -> Column:
        return F.array_join(
            F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))),
            ",",
        )

    base = F.filter("found", lambda x: x["rank"] < len(BASE))
    counts = [
        F.size(F.filter("found", _is_kind(k))).cast("bigint").alias(f"n_{k}") for k in BASE
    ]
    return found.select(
        "doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written(F.col("found")).alias("spans")
    )
