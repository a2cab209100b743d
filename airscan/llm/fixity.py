"""Merkle fixity audit of WARC replicas.

Leaves are the digests of records at their offsets. A node of the lowest level covers the records that begin in one
range of ``RANGE`` bytes of a file, and each higher node ``FAN`` ranges of the level below, up to one root per file. Two
replicas are compared from the roots down: only ranges below a mismatching node are looked at, and at the end the
records of the mismatching lowest ranges. These are aligned by their digests, so that a lost, added or longer record is
one finding, though all offsets behind it differ.

All groups are bounded: a range by its bytes, an inner node by ``FAN``. Offsets are sums over two levels (blocks of
records within a file, records within a block), so a file that holds a third of all records is not one task.

Null urls and contents count as empty. Pages without an id go to a file of their own. Repeated rows (equal in page_id,
url and content) are one record; different contents of one page_id follow each other by digest. Empty tables give an
empty result. Very long pages are hashed whole. Columns other than page_id, url and html are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airscan.sources.local import staged

RANGE = 1 << 16
FAN = 16
PAGES = 4096  # page ids of one file
BLOCK = 64  # page ids of one block of offsets
CROWD = 1024  # records of one page id beyond which its block is cut by digest


def warc_record(page_id: Column, url: Column, content: Column) -> Column:
    """A page as a WARC resource record."""
    lines = [
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Target-URI: "), url, F.lit("\r\nWARC-Record-ID: <urn:page:"),
        page_id, F.lit(">\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(content).cast("string"),
        F.lit("\r\n\r\n"), content, F.lit("\r\n\r\n"),
    ]
    return F.concat(*lines)


def records(pages: DataFrame, content: Column) -> DataFrame:
    """One row per record of a replica: file, page_id, url, length and digest; the bytes are read once and not kept."""
    page_id = F.col("page_id").cast("bigint")
    record = warc_record(F.coalesce(page_id.cast("string"), F.lit("")), F.coalesce("url", F.lit("")), content)
    file = F.coalesce(F.expr(f"(page_id - pmod(page_id, {PAGES})) div {PAGES}").cast("string"), F.lit("none"))
    rows = pages.select(
        file.alias("file"), page_id.alias("page_id"), F.octet_length(record).cast("bigint").alias("length"),
        F.sha2(record.cast("binary"), 256).alias("digest"),
    )
    return staged(rows.distinct(), "fixity-records")


def manifest(rows: DataFrame) -> DataFrame:
    """The records with their byte offsets in their files, ordered by page_id (null first), then digest."""
    crowded = rows.groupBy("file", "page_id").count().filter(F.col("count") > CROWD)
    digits = F.least(F.lit(8), F.ceil(F.log(F.col("count") / CROWD) / F.log(F.lit(16.0))) + 1).cast("int")
    crowded = crowded.select(F.col("file").alias("f"), F.col("page_id").alias("p"), digits.alias("digits"))
    rows = rows.join(crowded, (F.col("file") == F.col("f")) & F.col("page_id").eqNullSafe(F.col("p")), "left")
    alone = F.col("digits").isNotNull()
    block = F.struct(
        F.expr(f"(page_id - pmod(page_id, {BLOCK})) div {BLOCK}").alias("ids"),
        F.when(alone, F.col("page_id")).otherwise(F.lit(None)).alias("crowded"),
        F.when(alone, F.expr("substring(digest, 1, digits)")).otherwise(F.lit("")).alias("digits"),
    )
    rows = rows.withColumn("block", block).drop("f", "p", "digits")
    sizes = rows.groupBy("file", "block").agg(F.sum("length").alias("size"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("file", "block", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("base"))
    within = Window.partitionBy("file", "block").orderBy("page_id", "digest").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.col("base") + F.coalesce(F.sum("length").over(within), F.lit(0))
    placed = rows.join(sizes, ["file", "block"]).withColumn("offset", offset)
    return staged(placed.select("file", "offset", "length", "digest", "page_id"), "fixity-manifest")


def hashed(children: Column) -> Column:
    return F.sha2(F.array_join(F.sort_array(children), "\n").cast("binary"), 256)


def tree(leaves: DataFrame, levels: int) -> list[DataFrame]:
    """Nodes of every level (file, range, hash), from the lowest to the roots, each a written table."""
    place = F.lpad(F.col("offset").cast("string"), 20, "0")
    child = F.concat_ws(" ", place, F.col("length").cast("string"), F.col("digest"))
    nodes = [
        leaves.groupBy("file", F.expr(f"offset div {RANGE}").alias("range")).agg(hashed(F.collect_list(child)).alias("hash"))
    ]
    nodes[0] = staged(nodes[0], "fixity-nodes")
    for _ in range(levels):
        child = F.concat_ws(" ", F.lpad(F.pmod("range", F.lit(FAN)).cast("string"), 4, "0"), "hash")
        above = nodes[-1].groupBy("file", F.expr(f"range div {FAN}").alias("range"))
        nodes.append(staged(above.agg(hashed(F.collect_list(child)).alias("hash")), "fixity-nodes"))
    return nodes


def differing(a: DataFrame, b: DataFrame, above: DataFrame | None) -> DataFrame:
    """Ranges whose hashes differ or that one replica lacks, below the given mismatching ranges of the level above."""
    if above is not None:
        below = F.expr(f"range div {FAN}") == F.col("top")
        top = above.select(F.col("file").alias("f"), F.col("range").alias("top"))
        a, b = (x.join(top, (F.col("file") == F.col("f")) & below, "left_semi") for x in (a, b))
    b = b.withColumnRenamed("hash", "other")
    return a.join(b, ["file", "range"], "full_outer").filter("not (hash <=> other)").select("file", "range")


def placed(rows: DataFrame, length: str) -> DataFrame:
    """``rows`` of one replica with ``among``, their offset less the records before them that only this replica holds.

    Sums over two levels, lengths within a range and ranges within a file, so that no window holds a whole file's records.
    """
    alone = F.when(F.col("alone"), F.col(length)).otherwise(F.lit(0))
    rows = rows.withColumn("range", F.expr(f"offset div {RANGE}"))
    sizes = rows.groupBy("file", "range").agg(F.sum(alone).alias("size"))
    earlier = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("file", "range", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("base"))
    within = Window.partitionBy("file", "range").orderBy("offset").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("base") + F.coalesce(F.sum(alone).over(within), F.lit(0))
    return rows.join(sizes, ["file", "range"]).withColumn("among", F.col("offset") - before).drop("range", "base")


def audit(first: DataFrame, second: DataFrame) -> DataFrame:
    """Damage by which two replicas' manifests differ, one row each: file, page_id, kind, byte_offset, second_offset, length,
    second_length, first_digest and second_digest, null where a replica lacks the record.

    ``kind`` is changed (one record of that id differs), missing (only in the first replica), extra (only in the
    second) or moved. Records below mismatching ranges are aligned by their digests, so what merely follows a lost, added
    or longer record is not reported. Moved are records of both replicas that lie at another offset and at another
    place among the records of both: one put elsewhere, and those it passed. Where an id has several differing records, or none is known, they are
    reported as missing and extra. Records of a file are distinct, as ``records`` makes them.
    """
    end = first.select("offset").unionByName(second.select("offset")).agg(F.max("offset")).first()[0] or 0
    levels = 0
    while end // RANGE >= FAN**levels:
        levels += 1
    trees = [tree(replica, levels) for replica in (first, second)]
    found = None
    for level in range(levels, -1, -1):
        found = differing(trees[0][level], trees[1][level], found)
        found = staged(found, "fixity-differing")
    bad = found.select(F.col("file").alias("f"), F.col("range").alias("r"))
    here = (F.col("file") == F.col("f")) & (F.expr(f"offset div {RANGE}") == F.col("r"))
    sides = [replica.join(bad, here, "left_semi") for replica in (first, second)]
    held = [side.select("file", "digest", "length", F.lit(True).alias("held")) for side in sides]
    a, b = (
        staged(side.join(other, ["file", "digest", "length"], "left").withColumn("alone", F.col("held").isNull()), "fixity-sides")
        for side, other in zip(sides, reversed(held), strict=True)
    )
    a, b = (placed(side, "length") for side in (a, b))
    names = {"offset": "second_offset", "among": "second_among", "page_id": "second_id"}
    moved = a.filter("not alone").join(
        b.filter("not alone").drop("alone", "held").withColumnsRenamed(names), ["file", "digest", "length"]
    ).filter("among != second_among and offset != second_offset").select(
        "file", "page_id", F.lit("moved").alias("kind"), F.col("offset").alias("byte_offset"), "second_offset",
        "length", F.col("length").alias("second_length"), F.col("digest").alias("first_digest"),
        F.col("digest").alias("second_digest"),
    )
    record = F.struct("offset", "length", "digest")
    one = F.when((F.count(F.lit(1)) == 1) & F.first("page_id").isNotNull(), F.min(record))
    pairs = [
        side.filter("alone").groupBy("file", "page_id").agg(one.alias(name)).filter(F.col(name).isNotNull())
        for side, name in ((a, "x"), (b, "y"))
    ]
    changed = staged(pairs[0].join(pairs[1], ["file", "page_id"]), "fixity-changed")
    rest = [
        side.filter("alone").join(changed.select("file", "page_id"), ["file", "page_id"], "left_anti").select(
            "file", "page_id", record.alias(name), F.lit(None).cast(changed.schema[other].dataType).alias(other)
        )
        for side, name, other in ((a, "x", "y"), (b, "y", "x"))
    ]
    kind = F.when(F.col("x").isNull(), "extra").when(F.col("y").isNull(), "missing").otherwise("changed")
    damage = changed.unionByName(rest[0]).unionByName(rest[1]).select(
        "file", "page_id", kind.alias("kind"), F.col("x.offset").alias("byte_offset"), F.col("y.offset").alias("second_offset"),
        F.col("x.length").alias("length"), F.col("y.length").alias("second_length"),
        F.col("x.digest").alias("first_digest"), F.col("y.digest").alias("second_digest"),
    )
    return damage.unionByName(moved)
