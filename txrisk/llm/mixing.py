"""Source mixing by temperature, realised as budgeted block permutations. DataFrame functions only.

Weights are token shares to a common exponent between 0 (all sources alike) and 1 (as they come),
scaled to sum to one. The exponent is the largest that still meets a target entropy, or the least
under which no source repeats more often than a limit; it is found by bisection,
PER_JOB halvings a job.
A source's budget is met by whole passes over its documents and a part of one more. A pass is a
permutation of the source's blocks and of the documents in each block, both ordered by hashes; the
last pass ends in the document that would exceed the budget.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import stored

#: Tokens of a block of documents, on average; a block is ordered within one task.
BLOCK_TOKENS = 1 << 20
#: Steps of the exponent's bisection and how many of them one job takes.
HALVINGS = 32
PER_JOB = 8


@dataclass(frozen=True)
class Target:
    """max_passes: no source is repeated more often. Or entropy: of the weights, in nats.

    budget: tokens of the mixture; without one, as many as use every source once at least."""

    max_passes: float | None = None
    entropy: float | None = None
    budget: int | None = None


def with_tokens(docs: DataFrame) -> DataFrame:
    """Every column of docs as one struct, its source as a key that is never null, its words (runs
    of characters other than space and 0x09 to 0x0D), and a hash that places the document."""
    source = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("null"))
    text = F.coalesce(F.col("text"), F.lit(""))
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        source.alias("key"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("tokens"),
        F.md5(F.concat_ws(":", doc_id, text)).alias("place"),
    )


def total_tokens(docs: DataFrame) -> int:
    return with_tokens(docs).agg(F.sum("tokens")).first()[0] or 0


def exponent(sources: DataFrame, target: Target) -> float:
    """The bisected exponent for sources (key, tokens); those without tokens have no part in it."""
    sources = sources.where("tokens > 0")
    total = sources.agg(F.sum("tokens")).first()[0]
    if not total:
        return 1.0
    shares = sources.select(F.col("key"), (F.col("tokens") / F.lit(float(total))).alias("share"))
    low, high = 0.0, 1.0
    for _ in range(HALVINGS // PER_JOB):
        step = (high - low) / (1 << PER_JOB)
        tried = shares.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(1 << PER_JOB))))
        tried = tried.withColumn("w", F.pow("share", F.lit(low) + F.col("j") * F.lit(step)))
        sums = tried.groupBy("j").agg(
            F.sum("w").alias("z"),
            F.sum(F.col("w") * F.log("w")).alias("wlogw"),
            F.max(F.col("w") / F.col("share")).alias("most"),
            F.min(F.col("w") / F.col("share")).alias("least"),
        )
        if target.entropy is not None:
            # falls as the exponent grows
            fits = F.log("z") - F.col("wlogw") / F.col("z") >= F.lit(float(target.entropy))
            edge = sums.agg(F.max(F.when(fits, F.col("j")))).first()[0]
            if edge is None:
                return 0.0
            if edge == 1 << PER_JOB:
                return high
        else:
            # passes of the most repeated source; they fall as the exponent grows
            scale = (
                F.lit(1.0) / F.col("least")
                if target.budget is None
                else F.lit(target.budget / total) / F.col("z")
            )
            fits = F.col("most") * scale <= F.lit(float(target.max_passes) * (1 + 1e-12))
            first = sums.agg(F.min(F.when(fits, F.col("j")))).first()[0]
            if first is None:
                return 1.0
            if first == 0:
                return low
            edge = first - 1
        low, high = low + edge * step, low + (edge + 1) * step
    return low if target.entropy is not None else high


def budgets(sources: DataFrame, target: Target) -> DataFrame:
    """(key, tokens, weight, budget) for each source; budgets are whole tokens, rounded down.

    A limit of passes also holds where no exponent can meet it: a budget beyond it is cut there."""
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    alpha = exponent(sources, target)
    # a source without tokens has no share and takes no budget
    some = F.col("tokens") > 0
    share = F.col("tokens") / F.lit(float(max(total, 1)))
    powers = sources.withColumn("w", F.when(some, F.pow(share, F.lit(alpha))).otherwise(0.0))
    sums = powers.agg(
        F.sum("w").alias("z"), F.max(F.when(some, F.col("tokens") / F.col("w"))).alias("most")
    ).first()
    z = sums["z"] or 1.0
    budget = target.budget if target.budget is not None else z * (sums["most"] or 0.0)
    wanted = F.lit(float(budget)) * F.col("w") / F.lit(z)
    # a hair above, so that a source meant to be used once is used whole
    wanted = F.floor(wanted * F.lit(1 + 1e-12) + F.lit(1e-6))
    if target.max_passes is not None:
        wanted = F.least(wanted, F.floor(F.col("tokens") * F.lit(float(target.max_passes))))
    return powers.select(
        "key",
        "tokens",
        (F.col("w") / F.lit(z)).alias("weight"),
        wanted.cast("bigint").alias("budget"),
    )


def mix(docs: DataFrame, target: Target, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(row, source, tokens, pass, block, before): the documents of the mixture, once for each time
    they are used.

    row holds all columns of docs (doc_id, text, source and any other, of any name). source is the
    source's key. pass counts from 0; block is the rank of the document's block in that pass, and
    before counts the source's tokens ahead of the block over all passes, so before / budget brings
    the blocks of all sources into an order that keeps the weights throughout. A null source is a
    source of its own. Documents without words cost nothing and are used once, in pass 0. Rows that
    repeat a document are used together. A budget below the tokens of a pass's first document takes
    none of that pass.

    Scale: documents meet the table of blocks by a join on (source, block), which Spark broadcasts
    while that table is small. A hot source is many blocks, whose number grows with its tokens. Only
    totals of blocks are put in order for a whole source; documents are put in order only in the one
    block in which a source's budget ends.
    """
    rows = with_tokens(docs)
    light = stored(rows.select("key", "place", "tokens"), "documents")
    sources = light.groupBy("key").agg(F.sum("tokens").alias("tokens"))
    plan = budgets(stored(sources, "sources"), target)
    some = F.col("source_tokens") > 0
    plan = plan.withColumnRenamed("tokens", "source_tokens").withColumns(
        {
            "blocks": F.greatest(F.lit(1), F.ceil(F.col("source_tokens") / F.lit(block_tokens))),
            "whole": F.when(some, F.floor(F.col("budget") / F.col("source_tokens"))).otherwise(0),
        }
    )
    plan = plan.withColumn("rest", F.col("budget") - F.col("whole") * F.col("source_tokens"))
    plan = stored(plan, "budgets")
    blocks = plan.select("key", "blocks")

    totals = _in_buckets(light, blocks).groupBy("key", "bucket").agg(F.sum("tokens").alias("size"))
    passes = totals.join(plan, "key").withColumn(
        "pass", F.explode(F.expr("sequence(0, cast(whole as int))"))
    )
    shuffled = Window.partitionBy("key", "pass").orderBy(_order("bucket"), "bucket")
    passes = passes.withColumns(
        {
            "block": F.row_number().over(shuffled) - 1,
            "ahead": F.sum("size").over(shuffled) - F.col("size"),
        }
    )
    # what the last pass may still take of a block
    room = F.when(F.col("pass") == F.col("whole"), F.col("rest") - F.col("ahead"))
    passes = passes.select(
        "key",
        "bucket",
        "pass",
        "block",
        (F.col("pass") * F.col("source_tokens") + F.col("ahead")).alias("before"),
        F.when(room < F.col("size"), F.greatest(room, F.lit(0))).alias("room"),
    )
    passes = stored(passes, "passes")
    ending = passes.where("room > 0").select("key", "bucket", "pass", "room")
    inside = Window.partitionBy("key", "bucket", "pass").orderBy(_order("place"))
    cut = _in_buckets(light.where("tokens > 0"), blocks).join(ending, ["key", "bucket"])
    cut = cut.withColumns({"order": _order("place"), "sum": F.sum("tokens").over(inside)})
    cut = cut.where("sum <= room").groupBy("key", "bucket", "pass").agg(F.max("order").alias("cut"))
    passes = stored(passes.join(cut, ["key", "bucket", "pass"], "left"), "passes")

    used = _in_buckets(rows, blocks).join(passes, ["key", "bucket"])
    taken = F.when(F.col("tokens") == 0, F.col("pass") == 0).otherwise(
        F.col("room").isNull() | F.coalesce(_order("place") <= F.col("cut"), F.lit(False))
    )
    return used.where(taken).select(
        "row", F.col("key").alias("source"), "tokens", "pass", "block", "before"
    )


def _in_buckets(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    number = F.conv(F.substring("place", 1, 8), 16, 10).cast("bigint")
    return rows.join(blocks, "key").withColumn("bucket", number % F.col("blocks")).drop("blocks")


def _order(column: str) -> Column:
    """Where a block or document stands in its pass: a hash, so each pass has its own order."""
    return F.md5(F.concat_ws(":", F.col("pass").cast("string"), F.col(column).cast("string")))
