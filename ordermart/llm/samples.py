"""Folds by document id, and bounded samples of labelled rows for training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermart.llm.frames import Scratch

BROADCAST_LABELS = 10_000


def fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def stratified(labelled: DataFrame, label: str, key: Column, per_label: int, scratch: Scratch) -> DataFrame:
    """About ``per_label`` rows of each label, chosen by a hash of the key; rows in short supply all stay.

    The counts are one row per label, written and counted: up to ``BROADCAST_LABELS`` of them are broadcast, so that no
    text is shuffled by its label, which few tasks would have to take.
    """
    counts = scratch.write(labelled.groupBy(label).agg(F.count("*").alias("label_rows")), "labels")
    if counts.count() <= BROADCAST_LABELS:
        counts = F.broadcast(counts)
    chance = F.shiftrightunsigned(F.xxhash64(F.lit("sample"), key), 11) / F.lit(float(1 << 53))
    return labelled.join(counts, label).where(chance * F.col("label_rows") < per_label).drop("label_rows")
