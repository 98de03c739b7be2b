"""WARC records and Merkle fixity audits.

A record of an archive file has an ordinal, a byte offset and a length. Its leaf is the SHA-256 of
its offset, length and bytes; a node is the SHA-256 of the ordered leaves or nodes of a fixed range of
ordinals (``FANOUT`` to one), so replicas of a file have equal roots exactly when they hold the same
records at the same offsets. An audit joins the roots of two replicas and goes down only below nodes
that differ, level by level, to the records that were changed, are missing or were added. Trees are
DataFrames of nodes; no file passes through one task, however many records it has.

Defined results for odd rows: a NULL payload is an empty one; NULL and empty urls give an empty target
line; records that share an ordinal (repeated rows) are told apart by their leaf and both stay in the
tree; a file with no record has no root and is reported record by record against the other replica; two
empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from geoloom.operators.checkpoints import materialise

FANOUT = 16


def warc_record(record_id: Column, url: Column, payload: Column) -> Column:
    """Bytes of a WARC/1.1 resource record: header, payload, two line ends."""
    body = F.coalesce(payload.cast("binary"), F.lit(b""))
    head = F.concat(F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:record:"), F.coalesce(record_id.cast("string"), F.lit("")),
                    F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")), F.lit("\r\nContent-Length: "),
                    F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(head.cast("binary"), body, F.lit(b"\r\n\r\n"))


def archive(records: DataFrame, file: str, order: list[str], content: str) -> DataFrame:
    """Lay records out in files: ``file, ordinal, offset, length, leaf`` plus the columns of ``order``, as a written table.

    ``records`` needs a column ``_block`` that grows with ``order`` within a file and bounds the rows of a
    window. Contents leave as hashes, so that later steps move a few numbers per record.
    """
    slim = materialise(records.select(
        F.col(file).alias("file"), *order, "_block", F.octet_length(content).cast("bigint").alias("length"),
        F.sha2(F.col(content), 256).alias("digest")))
    inside = W.partitionBy("file", "_block").orderBy(*order, "digest").rowsBetween(W.unboundedPreceding, -1)
    sums = slim.groupBy("file", "_block").agg(F.sum("length").alias("bytes"), F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("file").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    bases = sums.select("file", "_block", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("b_bytes"),
                        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("b_n"))
    placed = slim.withColumns({"p_bytes": F.coalesce(F.sum("length").over(inside), F.lit(0)), "p_n": F.count(F.lit(1)).over(inside)})
    placed = placed.join(bases, ["file", "_block"]).select(
        "file", (F.col("b_n") + F.col("p_n")).alias("ordinal"), (F.col("b_bytes") + F.col("p_bytes")).alias("offset"), "length", "digest", *order)
    return materialise(placed.withColumn("leaf", leaf()).drop("digest"))


def leaf() -> Column:
    return F.sha2(F.concat_ws(":", "offset", "length", "digest"), 256)


def tree(leaves: DataFrame, fanout: int = FANOUT, height: int | None = None) -> list[DataFrame]:
    """Levels of nodes ``file, node, hash``: level 0 has a node per ``fanout`` ordinals, the last has node 0 only."""
    if height is None:
        height = tree_height(leaves.agg(F.max("ordinal")).first()[0], fanout)
    levels = [materialise(leaves.groupBy("file", F.floor(F.col("ordinal") / fanout).alias("node")).agg(_joined("ordinal", "leaf")))]
    for _ in range(height):
        levels.append(levels[-1].groupBy("file", F.floor(F.col("node") / fanout).alias("parent")).agg(
            _joined("node", "hash")).withColumnRenamed("parent", "node"))
    return levels


def tree_height(highest: int | None, fanout: int) -> int:
    """Levels above level 0 until every file has one node."""
    n, top = 0, (highest or 0) // fanout
    while top:
        top //= fanout
        n += 1
    return n


def _joined(order: str, value: str) -> Column:
    """Hash of an ordered range: at most ``fanout`` children, more only where ordinals repeat."""
    return F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order, value))),
                                           lambda x: F.concat_ws(":", x[order], x[value])), "\n"), 256).alias("hash")


def audit(ours: DataFrame, theirs: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """Records in which two replicas differ: ``file, ordinal, status`` and offset, length and leaf on both sides.

    ``status`` is ``changed``, ``missing`` (ours alone) or ``extra`` (theirs alone).
    """
    top = [r.agg(F.max("ordinal")).first()[0] for r in (ours, theirs)]
    height = tree_height(max((t for t in top if t is not None), default=None), fanout)
    mine, other = tree(ours, fanout, height), tree(theirs, fanout, height)
    wrong = None
    for level in reversed(range(height + 1)):
        a, b = mine[level], other[level].withColumnRenamed("hash", "other")
        if wrong is not None:  # only children of nodes that differ
            children = wrong.select("file", F.explode(F.sequence(F.col("node") * fanout, F.col("node") * fanout + fanout - 1)).alias("node"))
            a, b = a.join(children, ["file", "node"], "left_semi"), b.join(children, ["file", "node"], "left_semi")
        wrong = materialise(a.join(b, ["file", "node"], "full").filter(~F.col("hash").eqNullSafe(F.col("other"))).select("file", "node"))
    ordinals = wrong.select("file", F.explode(F.sequence(F.col("node") * fanout, F.col("node") * fanout + fanout - 1)).alias("ordinal"))
    a, b = (r.join(ordinals, ["file", "ordinal"], "left_semi") for r in (ours, theirs))
    # Records that share an ordinal are paired in the order of their leaves.
    nth = F.row_number().over(W.partitionBy("file", "ordinal").orderBy("leaf"))
    sides = [r.withColumn("nth", nth).select("file", "ordinal", "nth", *[F.col(c).alias(f"{side}_{c}") for c in ("offset", "length", "leaf")])
             for r, side in ((a, "our"), (b, "their"))]
    status = F.when(F.col("their_leaf").isNull(), "missing").when(F.col("our_leaf").isNull(), "extra").otherwise("changed")
    return sides[0].join(sides[1], ["file", "ordinal", "nth"], "full").filter(
        ~F.col("our_leaf").eqNullSafe(F.col("their_leaf"))).withColumn("status", status).drop("nth")
