"""Shards by extendible hashing: the directory is indexed by leading hash bits, and only a bucket
over the byte limit splits on its next bit. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import stored

#: Bits of a document's hash.
BITS = 60
#: Bits that one round looks at beyond those where an even split would fit.
SPARE_BITS = 5
LIMIT_BYTES = 1 << 20


def hashed(docs: DataFrame) -> DataFrame:
    """(doc_id, hash, bytes) of every row: leading bits of the MD5 of doc_id and text, and the bytes
    of the text; a null text is empty, a null doc_id hashes as an empty one."""
    text = F.coalesce(F.col("text"), F.lit(""))
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    digest = F.md5(F.concat_ws(":", doc_id, text))
    number = F.conv(F.substring(digest, 1, BITS // 4), 16, 10).cast("bigint")
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        number.alias("hash"),
        F.octet_length(text).cast("bigint").alias("bytes"),
    )


def leading(depth: Column) -> Column:
    """The hash's first bits, as a number."""
    return F.call_function("shiftright", F.col("hash"), (F.lit(BITS) - depth).cast("int"))


def buckets(rows: DataFrame, limit: int) -> DataFrame:
    """(depth, prefix, bytes, n_docs): the directory's buckets. One over the limit has all BITS, so
    its rows share one hash.

    A round sums bytes by the finest prefix it looks at, then by every shorter one, which is small
    by comparison. A node is a bucket if it fits and its parent does not. Rounds go on below the
    nodes that are still too large, on their rows only; there are at most BITS / SPARE_BITS."""
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    above, found, open_ = 0, None, rows
    depth = min(BITS, SPARE_BITS + max(0, -(-total // limit) - 1).bit_length())
    while True:
        finest = open_.groupBy(leading(F.lit(depth)).alias("p")).agg(
            F.sum("bytes").alias("bytes"), F.count("*").alias("n_docs")
        )
        nodes = finest.withColumn(
            "depth", F.explode(F.sequence(F.lit(above), F.lit(depth)))
        ).withColumn("prefix", F.call_function("shiftright", "p", F.lit(depth) - F.col("depth")))
        nodes = nodes.groupBy("depth", "prefix").agg(
            F.sum("bytes").alias("bytes"), F.sum("n_docs").alias("n_docs")
        )
        nodes = stored(nodes, "nodes")
        over = nodes.where((F.col("bytes") > limit) & (F.col("depth") < depth))
        parents = over.select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
        child = F.call_function("shiftright", "prefix", F.lit(1)).alias("parent")
        reached = nodes.select("*", child).join(parents, ["depth", "parent"], "left_semi")
        # the root of the first round; in later ones the roots are known to be over the limit
        if above == 0:
            reached = reached.unionByName(nodes.where("depth = 0").select("*", child))
        reached = reached.select("depth", "prefix", "bytes", "n_docs")
        fits = reached.where((F.col("bytes") <= limit) | (F.lit(depth) == BITS) & (F.col("depth") == BITS))
        found = fits if found is None else found.unionByName(fits)
        left = reached.where((F.col("depth") == depth) & (F.col("bytes") > limit))
        if depth == BITS or not left.head(1):
            return stored(found, "buckets")
        left = left.select(F.col("prefix").alias("_p"))
        open_ = open_.join(left, leading(F.lit(depth)) == F.col("_p"), "left_semi")
        above, depth = depth, min(BITS, depth + 2 * SPARE_BITS)


def shards(docs: DataFrame, limit: int = LIMIT_BYTES) -> DataFrame:
    """(doc_id, shard, depth, bytes, shard_bytes) for each row of docs (doc_id, text).

    shard is the bucket's bits as text, empty while one shard holds all. No shard exceeds the limit
    unless it is a single document that does. Rows that are equal in doc_id and text have one hash
    and cannot part by splitting: a bucket of them over the limit is cut into chained shards, named
    by its bits and a number, of as many rows as fit. An empty table has no shards. Other columns are
    not read.
    """
    rows = stored(hashed(docs).withColumn("part", F.spark_partition_id()), "hashed")
    found = buckets(rows, limit).select("depth", "prefix", F.col("bytes").alias("shard_bytes"), "n_docs")
    # at most BITS + 1 depths; a document meets a bucket at one of them
    depths = sorted(r[0] for r in found.select("depth").distinct().collect()) or [0]
    placed = rows.withColumn("depth", F.explode(F.lit(depths)))
    placed = placed.withColumn("prefix", leading(F.col("depth")))
    placed = placed.join(found, ["depth", "prefix"])
    bits = F.lpad(F.bin(F.col("prefix")), F.col("depth"), F.lit("0"))
    bits = F.when(F.col("depth") == 0, F.lit("")).otherwise(bits)
    columns = ["doc_id", "shard", "depth", "bytes", "shard_bytes"]
    normal = (F.col("shard_bytes") <= limit) | (F.col("n_docs") == 1)
    fitting = placed.where(normal).withColumn("shard", bits).select(*columns)
    return fitting.unionByName(_chained(placed.where(~normal), bits, limit).select(*columns))


def _chained(rows: DataFrame, bits: Column, limit: int) -> DataFrame:
    """Equal rows in shards of as many as fit. Their numbers come from the counts of the parts the
    table was written in and the place within a part, so no task holds them all."""
    parts = rows.groupBy("prefix", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("prefix").orderBy("part")
    parts = parts.withColumn("before", F.sum("n").over(before) - F.col("n")).drop("n")
    within = Window.partitionBy("prefix", "part").orderBy("doc_id")
    numbered = rows.withColumn("nth", F.row_number().over(within) - 1).join(parts, ["prefix", "part"])
    per_shard = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.col("bytes")))
    nth = F.floor((F.col("before") + F.col("nth")) / per_shard)
    size = F.least(per_shard, F.col("n_docs") - nth * per_shard) * F.col("bytes")
    return numbered.withColumns(
        {"shard": F.concat_ws("-", bits, nth.cast("string")), "shard_bytes": size.cast("bigint")}
    )


def directory(docs_in_shards: DataFrame) -> DataFrame:
    """(shard, depth, n_docs, bytes): one row for each shard, from the result of shards()."""
    return docs_in_shards.groupBy("shard", "depth").agg(
        F.count("*").alias("n_docs"), F.sum("bytes").alias("bytes")
    )
