"""Fill-in-the-middle: a text cut into prefix, middle and suffix by one regular expression of its own.

``regexp_count`` gives the number n of units (lines) of a text. Hashes of the id choose two cuts among its n + 1 places, a
units from the start and b. The text's own pattern is then

    (?s)\\A((?:unit){a}+)((?:unit){b - a}+)(.*+)\\z

whose three groups are prefix, middle and suffix: one match captures all three, and ``regexp_replace`` writes them in the
order of the form. Counted possessive repeats run as a loop: no stack grows with the number of lines, and nothing is tried
twice, so the work is linear in the text.

Built-in functions only: a row is a task's own work, without a shuffle, and nothing is held but the text and its result.

Defined results: null text counts as empty. A text that is empty or contains a sentinel stays as it is (form plain, null
lengths). A null id counts as empty text in the hash; rows that repeat an id and a text get the same cuts. Other columns
pass through; columns named like the made ones are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermart.llm.frames import free_name

# The unit and the sentinels of the contract. Possessive repeats match the same and never look back.
UNIT = "[^\\n]*+\\n|[^\\n]++"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
ORDERS = {"psm": f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2", "spm": f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2"}


def _hashes(seed: int, id_col: Column) -> list[Column]:
    """The first four 8-digit groups of the hash of seed and id, as numbers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def fill_in_middle(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", seed: int = 7, percent: int = 100, percent_spm: int = 50
) -> DataFrame:
    """``docs`` with n, form, prefix_chars, middle_chars and output.

    percent: of the texts that are not plain by themselves, how many are transformed; percent_spm: of these, how many
    have their suffix first.
    """
    work = free_name("work", docs)
    name = lambda c: F.col(f"`{work}`.{c}")
    whole = F.coalesce(docs[f"`{text}`"], F.lit(""))
    h1, h2, h3, h4 = _hashes(seed, docs[f"`{id_col}`"])
    marked = F.contains(whole, F.lit(PREFIX)) | F.contains(whole, F.lit(SUFFIX)) | F.contains(whole, F.lit(MIDDLE))
    plain = (whole == "") | marked | (h3 % 100 >= percent)
    form = F.when(plain, "plain").when(h4 % 100 < percent_spm, "spm").otherwise("psm")
    docs = docs.withColumn(work, F.struct(F.regexp_count(whole, F.lit(UNIT)).cast("long").alias("n"), h1.alias("h1"), h2.alias("h2"), form.alias("form"), whole.alias("whole")))
    first, second = name("h1") % (name("n") + 1), name("h2") % (name("n") + 1)
    a, b = F.least(first, second), F.greatest(first, second)
    unit = f"(?:{UNIT})"
    pattern = F.concat(F.lit(f"(?s)\\A({unit}{{"), a.cast("string"), F.lit(f"}}+)({unit}{{"), (b - a).cast("string"), F.lit("}+)(.*+)\\z"))
    order = F.when(name("form") == "spm", ORDERS["spm"]).otherwise(ORDERS["psm"])
    output = F.when(name("form") == "plain", name("whole")).otherwise(F.regexp_replace(name("whole"), pattern, order))
    out = docs.withColumns({"n": name("n"), "form": name("form"), "output": output})
    # Texts with cuts have no sentinel of their own, so the lengths can be read off the output.
    at = lambda mark: F.instr(F.col("output"), mark).cast("long")
    chars = F.char_length("output").cast("long")
    cut = F.when(F.col("form") == "psm", at(SUFFIX) - 4).when(F.col("form") == "spm", at(MIDDLE) - at(PREFIX) - 3)
    middle = F.when(F.col("form") != "plain", chars - at(MIDDLE) - 2)
    return out.withColumns({"prefix_chars": cut, "middle_chars": middle}).drop(work)


def restored(output: Column, form: Column) -> Column:
    """The text an output was made of."""
    middle = F.substring_index(output, MIDDLE, -1)
    rest = F.substring_index(output, MIDDLE, 1)
    psm = F.concat(F.substring(F.substring_index(rest, SUFFIX, 1), 4, 1 << 30), middle, F.substring_index(rest, SUFFIX, -1))
    spm = F.concat(F.substring_index(rest, PREFIX, -1), middle, F.substring(F.substring_index(rest, PREFIX, 1), 4, 1 << 30))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op12_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = fill_in_middle(docs)
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return out.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        digest(F.col("output")).alias("output_sha256"), digest(restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )


ORACLE = """
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS parts,
    sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), u AS (
  SELECT *, list_filter(list_transform(parts, lambda x, i: x || CASE WHEN i < len(parts) THEN chr(10) ELSE '' END), lambda x: x <> '') AS units,
    list_transform([1, 9, 17, 25], lambda k: CAST('0x' || substr(h, k, 8) AS BIGINT)) AS g
  FROM t
), c AS (
  SELECT *, len(units) AS n, least(g[1] % (len(units) + 1), g[2] % (len(units) + 1)) AS a,
    greatest(g[1] % (len(units) + 1), g[2] % (len(units) + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain'
      WHEN g[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM u
), p AS (
  SELECT doc_id, n, form, text, coalesce(array_to_string(units[1:a], ''), '') AS prefix,
    coalesce(array_to_string(units[a + 1:b], ''), '') AS middle, coalesce(array_to_string(units[b + 1:n], ''), '') AS suffix
  FROM c
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""
