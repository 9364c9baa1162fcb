"""Fill-in-the-middle against a plain version."""

import hashlib
import re

from pyspark.sql import functions as F

from ordermart.llm.fim import fill_in_middle, restored


def plain_version(doc_id, text, seed=7, percent=100, percent_spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return n, "plain", None, None, text
    if h[3] % 100 < percent_spm:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


TEXTS = [
    None, "", "\n", "\n\n\n", "one", "one\n", "a\nb\nc", "a\r\nb\x0b c\n\nd", "$1 \\ $ {2}\n[x]\n(y)\n", "🙂 é\n日本\n" * 7, "x <P> y\nz", "<S>",
    "a<M>", "<P\n>S>\nM>", "P>\n<\n<S\n>", "line\n" * 200_000, "no break " * 100_000, "\n" * 300_000, "nul\x00byte\nand more",
]


def test_all_forms_and_cuts(spark):
    rows = [(i * 31 + k, t) for i in range(6) for k, t in enumerate(TEXTS)] + [(None, "a\nb\nc\n"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    for how in ({}, {"percent": 40, "percent_spm": 80, "seed": 3}):
        out = fill_in_middle(df, **how).withColumn("back", restored(F.col("output"), F.col("form")))
        seen = set()
        for r in out.collect():
            assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == plain_version(r["doc_id"], r["text"], **how)
            assert r["back"] == (r["text"] or "")
            seen.add(r["form"])
        assert seen == {"plain", "psm", "spm"}


def test_other_columns_pass_and_made_ones_are_replaced(spark, edge_docs, no_docs):
    out = fill_in_middle(edge_docs)
    assert set(out.columns) == set(edge_docs.columns) | {"n", "form", "prefix_chars", "middle_chars", "output"}
    assert len(out.columns) == len(set(out.columns))
    for r in out.collect():
        assert r["work"] == r["rid"] == "own"
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == plain_version(r["doc_id"], r["text"])
    assert fill_in_middle(no_docs).collect() == []


def test_no_shuffle_and_no_python(spark, edge_docs):
    plan = fill_in_middle(edge_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
