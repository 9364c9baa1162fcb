"""Helpers the operators share: free column names, scratch tables, row identity, word blocks."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermart.session import delete_path, fresh_dir

# The white space of the contracts, space and tab to carriage return.
SPACE = "\\x20\\x09-\\x0D"
WORD = f"[^{SPACE}]+"
# Runs that are not yet one plain space. A single space is left alone, which makes the pattern cheap.
LOOSE_SPACE = f"[\\x09-\\x0D][{SPACE}]*|\\x20[{SPACE}]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def free_name(wanted: str, *frames: DataFrame) -> str:
    """A column name that none of the frames has (names compare without case)."""
    taken = {c.lower() for df in frames for c in df.columns}
    name = wanted
    while name.lower() in taken:
        name += "_"
    return name


def whole_row(docs: DataFrame) -> Column:
    """All columns as one struct, so that names of the caller cannot clash with an operator's own."""
    return F.struct(*[docs[f"`{c}`"] for c in docs.columns])


def unpacked(df: DataFrame, row: str = "doc") -> list[Column]:
    """The columns of the struct made by whole_row."""
    return [F.col(row)[c].alias(c) for c in df.schema[row].dataType.names]


def squeezed(text: Column) -> Column:
    """Text with each run of white space as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), LOOSE_SPACE, " ")


def ascii_lower(text: Column) -> Column:
    """A to Z lower-cased and nothing else."""
    return F.translate(text, UPPER, LOWER)


class Scratch:
    """Tables one call writes to the shared folder; they survive lost executors, and session.clear_stage deletes them."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.path = fresh_dir(spark, "llm")
        self._made = 0

    def place(self, name: str) -> str:
        self._made += 1
        return f"{self.path}/{name}-{self._made}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Compute once and read back as a plain scan; the lineage ends here."""
        path = self.place(name)
        df.write.option("compression", "zstd").parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        back.scratch_path = path
        return back

    def drop(self, *frames: DataFrame) -> None:
        """Delete tables that no later step reads."""
        for df in frames:
            delete_path(self.spark, df.scratch_path)

    def clear(self) -> None:
        """Delete all tables; frames that read them end with them."""
        delete_path(self.spark, self.path)


def numbered(docs: DataFrame, scratch: Scratch, **more: Column) -> DataFrame:
    """Write documents as (rid, doc, ...): rid identifies a row even where ids repeat or are null."""
    own = [value.alias(name) for name, value in more.items()]
    return scratch.write(docs.select(F.monotonically_increasing_id().alias("rid"), whole_row(docs).alias("doc"), *own), "rows")


def first_row(id_col: Column, rid: Column) -> Column:
    """Order among equal rows: smallest id first, null ids last, then the row number."""
    return F.struct(id_col.isNull().alias("no_id"), id_col.alias("id"), rid.alias("rid"))


def word_blocks(text: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """Words of a text, split at space and tab to carriage return, about ``size`` bytes at a time."""
    if len(text) <= size:
        yield text.split()
        return
    start = 0
    while start < len(text):
        end = min(len(text), start + size)
        while end < len(text) and text[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        yield text[start:end].split()
        start = end
