"""The pipeline: each stage on its predecessor's rows, over the small table, edge rows and an empty table."""

from collections import Counter

import corpus_pipeline
from test_duplicates import brute_components, brute_print, squeezed
from test_text_operators import check_pieces

from ordermart.llm import rules


def staged(spark, docs, folder, tmp_path):
    """Rows of each stage, written and read again as the driver does."""
    out = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{name}")
        out[name] = docs = spark.read.parquet(f"{tmp_path}/{name}")
    return out


def test_stages_of_the_small_table(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = staged(spark, docs, sf_dir, tmp_path)
    rows = {name: df.collect() for name, df in out.items()}
    assert all(out[name].columns == docs.columns for name in list(out)[:-1])
    ids = {name: [r["doc_id"] for r in rows[name]] for name in rows}

    verdicts = {r["doc_id"]: r["kept"] for r in rules.op4_quality_rules(spark, sf_dir).collect()}
    assert sorted(ids["quality_rules"]) == sorted(i for i, kept in verdicts.items() if kept)

    first = {}
    for r in rows["quality_rules"]:
        key = squeezed(r["text"])
        first[key] = min(r["doc_id"], first.get(key, r["doc_id"]))
    assert sorted(ids["exact_dedup"]) == sorted(first.values())

    prints = {r["doc_id"]: brute_print(r["text"]) for r in rows["exact_dedup"]}
    roots = brute_components(prints.values())
    lowest = {}
    for i, p in prints.items():
        lowest[roots[p]] = min(i, lowest.get(roots[p], i))
    assert sorted(ids["simhash_near_dedup"]) == sorted(lowest.values())

    assert set(ids["mixing"]) <= set(ids["simhash_near_dedup"])
    texts = {r["doc_id"]: r["text"] for r in rows["mixing"]}
    if max(Counter(ids["mixing"]).values()) == 1:
        check_pieces(rows["packing"], sorted(texts.items()))
    assert {r["doc_id"] for r in rows["packing"]} == set(ids["mixing"])
    assert corpus_pipeline.run(spark, sf_dir).count() == len(rows["packing"])


def test_stages_of_edge_rows_and_of_no_rows(spark, edge_docs, no_docs, edge_dir, tmp_path):
    out = staged(spark, edge_docs, edge_dir, tmp_path / "edge")
    assert out["simhash_near_dedup"].columns == edge_docs.columns
    assert out["packing"].count() > 0
    for name, stage in corpus_pipeline.STAGES:
        # Each stage alone on rows that no stage before has cleaned.
        assert stage(spark, edge_docs, edge_dir).count() > 0, name
    assert all(df.count() == 0 for df in staged(spark, no_docs, edge_dir, tmp_path / "none").values())
