"""Exact deduplication by distributed radix partitioning, most significant bytes first.

A document's key is its length in bytes followed by the bytes of its text with white space squeezed. Each round
splits every group by the next bytes of the key. A group of one row is done, and so is one whose bytes have ended:
its texts are equal, byte by byte, and no digest takes part. Rounds take wider digits as they go on (``DIGITS``),
so the number of rounds follows the longest text that still has a twin, not the number of its bytes.

Scale: a round counts with a map-side combine, so a group that holds a third of all rows sends one row per task. The
rows get their group back through a sort-merge join whose large side adaptive execution splits. Whole texts move once, in the
join that follows the first digit; after it only rows that share length and first bytes with another row are left.

Defined results: null text counts as empty and all empty texts are one group. A null id loses against any id. Rows
that repeat an id are rows of their own: exactly one row of each group is kept. An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import chain, repeat

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermart.llm.frames import Scratch, first_row, numbered, squeezed, unpacked

# Bytes of the digit in each round; the last width repeats.
DIGITS = (64, 8192, 262_144, 1 << 20)


def _grouped(df: DataFrame, *key: str) -> DataFrame:
    """Groups of two rows and more: the row that stays, and the size."""
    return (
        df.groupBy(*key)
        .agg(F.min(first_row(F.col("id"), F.col("rid"))).alias("keep"), F.count("*").alias("size"))
        .where(F.col("size") > 1)
    )


def _split(scratch: Scratch, rows: DataFrame, digits=DIGITS) -> list[DataFrame]:
    """(rid, keep, size) of every row that has a twin. rows: rid, id, n, head (the first digit), key (the text)."""
    groups = scratch.write(_grouped(rows, "n", "head"), "groups")
    shared = rows.join(groups.hint("merge"), ["n", "head"]) if groups.head(1) else None
    if shared is None:  # nothing has a twin: spare the shuffle of all texts
        shared = rows.where("false").select("*", *[F.lit(None).cast(groups.schema[c].dataType).alias(c) for c in ("keep", "size")])
    rest = F.expr(f"substring(cast(key as binary), {digits[0] + 1})").alias("rest")
    left = scratch.write(shared.select("rid", "id", "n", "keep", "size", rest), "left")
    found, done = [], digits[0]
    for width in chain(digits[1:], repeat(digits[-1])):
        found.append(left.where(F.col("n") <= done).select("rid", "keep", "size"))
        open_rows = left.where(F.col("n") > done)
        if not open_rows.head(1):
            break
        step = open_rows.select(
            "rid", "id", "n", F.col("keep.rid").alias("parent"), F.expr(f"substring(rest, 1, {width})").alias("digit"), "rest"
        )
        # Written first: the join below then has two shuffles of its own, and its large partitions can be split.
        groups = scratch.write(_grouped(step.drop("rest"), "parent", "digit"), "groups")
        left = scratch.write(
            step.join(groups.hint("merge"), ["parent", "digit"]).select(
                "rid", "id", "n", "keep", "size", F.expr(f"substring(rest, {width + 1})").alias("rest")
            ),
            "left",
        )
        done += width
    return found


def exact_groups(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", scratch: Scratch | None = None, **more: Column
) -> DataFrame:
    """Every row of ``docs`` as struct ``doc``, with its group: keep_id, group_size, kept.

    ``more``: further columns computed per row while the table is read once; they may use ``squeezed``.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    key = squeezed(docs[text])
    size = F.octet_length(key)
    head = F.substring(key.cast("binary"), 1, DIGITS[0])
    rows = numbered(docs, scratch, n=size, head=head, **more)
    keyed = rows.select("rid", F.col("doc")[id_col].alias("id"), "n", "head", squeezed(F.col("doc")[text]).alias("key"))
    found = _split(scratch, keyed)
    twins = found[0]
    for part in found[1:]:
        twins = twins.unionByName(part)
    keep = F.col("keep")
    return rows.join(twins, "rid", "left").select(
        "doc",
        F.when(keep.isNull(), F.col("doc")[id_col]).otherwise(keep["id"]).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (keep.isNull() | (keep["rid"] == F.col("rid"))).alias("kept"),
        *more,
    )


def exact_dedup(docs: DataFrame, text: str = "text", id_col: str = "doc_id", scratch: Scratch | None = None) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they were."""
    groups = exact_groups(docs, text, id_col, scratch)
    return groups.where("kept").select(*unpacked(groups))


def op10_exact_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    digest = F.sha2(squeezed(docs["text"]).cast("binary"), 256)
    groups = exact_groups(docs, text_sha256=digest)
    return groups.select(F.col("doc.doc_id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


ORACLE = """
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS norm FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm)
"""
