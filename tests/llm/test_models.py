"""Mixing, classifier, language network and language model against brute force and held-out rows."""

import math
import re
from collections import Counter, defaultdict
from zlib import crc32

import duckdb
import numpy as np
import pytest

from ordermart.llm import classifier, eliasfano, langid, lm, mixing
from ordermart.llm.samples import fold


def mix_inputs(spark):
    """One hot source, a small one, one without tokens, a null one; ids and texts that repeat."""
    rows = [(i, "w " * (1 + i % 7), "hot") for i in range(600)]
    rows += [(1000 + i, "w " * (1 + i % 5), f"s{i % 4}") for i in range(200)]
    rows += [(2000 + i, "", "silent") for i in range(3)] + [(3000 + i, "a b c", None) for i in range(20)]
    rows += [(1, "w w", "hot")] * 3 + [(None, None, "s1"), (None, "x", None)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)


def brute_weights(tokens, entropy, repeats):
    share = np.array(list(tokens.values()), float) / sum(tokens.values())

    def of(a):
        w = share**a
        return w / w.sum()

    def bisect(meets):  # meets at 0 but perhaps not at 1
        low, high = 0.0, 1.0
        if meets(1.0):
            return 1.0
        for _ in range(60):
            mid = (low + high) / 2
            low, high = (mid, high) if meets(mid) else (low, mid)
        return low

    even = bisect(lambda a: -(of(a) * np.log(of(a))).sum() >= entropy * math.log(len(share)))
    rare = bisect(lambda a: (of(a) / share).max() > repeats)
    return dict(zip(tokens, of(max(even, rare if (of(0.0) / share).max() > repeats else 0.0)), strict=True))


@pytest.mark.parametrize(("entropy", "repeats"), [(0.95, 4.0), (0.5, 4.0), (0.999, 1.5)])
def test_mix_meets_weights_and_budgets(spark, entropy, repeats, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", 40)
    rows, docs = mix_inputs(spark)
    tokens = Counter()
    for _, text, source in rows:
        tokens[source] += len((text or "").split())
    tokens = {s: n for s, n in tokens.items() if n}
    weights = brute_weights(tokens, entropy, repeats)
    drawn = Counter()
    for r in mixing.mixed(docs, entropy=entropy, repeats=repeats).collect():
        drawn[r["source"]] += len((r["text"] or "").split())
    total = sum(tokens.values())
    assert set(drawn) == set(tokens)
    for source, weight in weights.items():
        budget = weight * total
        assert budget - 8 <= drawn[source] <= budget + 1.01, (source, drawn[source], budget)
        assert drawn[source] <= repeats * tokens[source] + 1


def test_draws_are_a_prefix_of_the_permutation(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", 2000)
    monkeypatch.setattr(mixing, "ENTROPY", 0.999)
    rows = [r.asDict() for r in mixing.op1_mixing(spark, sf_dir).collect()]
    docs = {i: (s, len((t or "").encode().split())) for i, t, s in duckdb.execute(f"SELECT doc_id, text, source FROM '{sf_dir}/documents.parquet'").fetchall()}
    every = defaultdict(set)
    for i, (source, _) in docs.items():
        every[source].add(i)
    by_pass = defaultdict(list)
    for r in rows:
        assert docs[r["doc_id"]] == (r["source"], r["n_tokens"])
        by_pass[r["source"], r["pass"]].append(r)
    for source in {r["source"] for r in rows}:
        passes = max(p for s, p in by_pass if s == source)
        for p in range(passes):
            assert {r["doc_id"] for r in by_pass[source, p]} == every[source]
        last = by_pass[source, passes]
        taken = sum(r["n_tokens"] for p in range(passes + 1) for r in by_pass[source, p])
        longest = max(n for s, n in docs.values() if s == source)
        assert last[0]["budget"] - longest <= taken <= last[0]["budget"]
        assert len({r["doc_id"] for r in last}) == len(last)


def test_mixing_edges(spark, edge_docs, no_docs):
    assert mixing.mixed(edge_docs).schema == edge_docs.schema
    assert mixing.mixed(no_docs).collect() == []
    one = spark.createDataFrame([(i, "a b", "x") for i in range(9)], "doc_id long, text string, source string")
    assert mixing.mixed(one).count() == 9
    plan = mixing.mixed(edge_docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_ftrl_separates_and_bias_alone_scores_the_empty_text():
    rows = [classifier.features(t.encode()) for t in ["good fine words here", "BAD!! BAD!! JUNK!!"] * 60]
    w = classifier.ftrl(rows, np.array([1.0, 0.0] * 60), 600)
    score = lambda t: classifier._probability(float(w[classifier.features(t)[0]] @ classifier.features(t)[1]) + float(w[-1]))
    assert score(b"good fine words") > 0.8 and score(b"JUNK!! BAD!!") < 0.2
    assert classifier.features(b" \n")[0].size == 0
    index, value = classifier.features(b"a b a b")
    assert abs((value * value).sum() - 1) < 1e-12 and classifier.AGAIN in index


def test_classifier_on_held_out_labels(spark, sf_dir):
    rows = {r["doc_id"]: r for r in classifier.op5_quality_classifier(spark, sf_dir).collect()}
    labels = duckdb.execute(f"SELECT doc_id, quality FROM '{sf_dir}/labels.parquet'").fetchall()
    for i, r in rows.items():
        assert r["held_out"] == (crc32(str(i).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    held = [(rows[i]["predicted"], q) for i, q in labels if rows[i]["held_out"]]
    assert sum(a == b for a, b in held) / len(held) > 0.9


def test_gradient_of_the_byte_network():
    rng = np.random.default_rng(0)
    w = {n: a.astype(np.float64) for n, a in langid.new_weights(3, hidden=4).items()}
    w = {n: a.astype(np.float32) for n, a in w.items()}
    bytes_ = rng.integers(0, 256, (9, 5))
    mask, labels = np.ones((9, 5), np.float32), np.array([0, 1, 2, 0, 1])
    mask[6:, 1] = 0

    def loss():
        p = langid.label_positions(w, bytes_)[0][:, np.arange(5), labels]
        return float(-(np.log(p.astype(np.float64)) * mask).sum() / mask.sum())

    g = langid.gradients(w, bytes_, mask, labels)
    for name in w:
        flat, step = w[name].reshape(-1), 2e-2
        k = int(np.abs(g[name].reshape(-1)).argmax())
        before = flat[k]
        flat[k] = before + step
        up = loss()
        flat[k] = before - step
        down = loss()
        flat[k] = before
        assert abs((up - down) / (2 * step) - g[name].reshape(-1)[k]) < 0.05 * abs(g[name].reshape(-1)[k]) + 1e-4, name


def test_windows_pool_to_the_mean_of_positions():
    model = langid.Model(["a", "b"], langid.new_weights(2))
    texts = [b"x" * 300, b"", "é bc".encode() * 40, b"q"]
    pooled = model.pooled(texts, span=16, lanes=3)
    for k, text in enumerate(texts):
        total = np.zeros(2)
        for a in range(0, len(text), 16):
            bytes_, mask = langid.laid_out([text[a : a + 16]], 16)
            total += (langid.label_positions(model.weights, bytes_)[0] * mask[:, :, None]).sum(axis=(0, 1))
        assert np.allclose(pooled[k], total / max(1, len(text)), atol=1e-5)


def test_language_of_held_out_documents(spark, sf_dir):
    rows = {r["doc_id"]: r for r in langid.op6_language_id(spark, sf_dir).collect()}
    truth = duckdb.execute(f"SELECT doc_id, lang FROM '{sf_dir}/documents.parquet'").fetchall()
    held = [(rows[i]["lang_pred"], lang) for i, lang in truth if rows[i]["held_out"] and rows[i]["lang_pred"] != "und"]
    assert all(rows[i]["held_out"] == (crc32(str(i).encode()) % 5 == 0) for i, _ in truth)
    assert sum(a == b for a, b in held) / len(held) > 0.9


def test_no_letters_no_language(spark, edge_dir):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "12 _ 3!²½"), (4, "½ ok")], "doc_id long, text string")
    found = langid.identify(docs, langid.Model(["en"], langid.new_weights(1)), "text").collect()
    assert [(r["lang_pred"], r["score"]) for r in found] == [("und", 0.0)] * 3 + [("en", 1.0)]
    assert {r["lang_pred"] for r in langid.identify(docs, langid.Model([], {}), "text").collect()} == {"und"}


def test_elias_fano_against_plain_arrays(tmp_path):
    rng = np.random.default_rng(1)
    for n, top in ((0, 1), (1, 0), (1, 10**6), (5, 3), (1000, 10**4), (20_000, 10**12), (2000, 2001)):
        values = np.unique(rng.integers(0, top + 1, n)) if n else np.empty(0, np.int64)
        sequence = eliasfano.EliasFano(eliasfano.EliasFano.encode(values, "x"), "x")
        if len(values):
            assert (sequence.get(np.arange(len(values))).astype(np.int64) == values).all()
        asked = np.concatenate([rng.integers(0, top + 5, 500), values[:300]])
        at = {int(v): k for k, v in enumerate(values)}
        assert (sequence.find(asked.astype(np.uint64)) == [at.get(int(v), -1) for v in asked]).all()
    lists = [np.unique(rng.integers(0, 500, rng.integers(0, 20))) for _ in range(300)]
    pointers = np.concatenate(([0], np.cumsum([len(x) for x in lists])))
    eliasfano.save_arrays(f"{tmp_path}/x", eliasfano.Successors.encode(pointers, np.concatenate(lists), "s"))
    found = eliasfano.Successors(eliasfano.map_arrays(f"{tmp_path}/x"), "s")
    context, ids = rng.integers(0, 300, 4000), rng.integers(0, 500, 4000)
    expected = [pointers[c] + np.searchsorted(lists[c], i) if i in lists[c] else -1 for c, i in zip(context, ids, strict=True)]
    assert (found.find(context, ids)[0] == expected).all()
    assert (found.find(context, ids)[1] == pointers[context]).all()


def brute_model(rows):
    """The interpolated model in dictionaries."""
    split = lambda t: (t or "").encode().lower().split() + [None]
    one, two, three = Counter(), Counter(), Counter()
    for i, t in rows:
        if crc32(b"" if i is None else str(i).encode()) % 5 != 1:
            w = split(t)
            one.update(w)
            two.update(zip(w, w[1:], strict=False))
            three.update(zip(w, w[1:], w[2:], strict=False))
    n, v = sum(one.values()), len(one)
    given2, given3 = defaultdict(float), defaultdict(float)
    for (a, _), c in two.items():
        given2[a] += (c - lm.DISCOUNT) / one[a] if c >= lm.LEAST else 0
    for (a, b, _), c in three.items():
        given3[a, b] += (c - lm.DISCOUNT) / two[a, b] if c >= lm.LEAST else 0
    out = []
    for i, t in rows:
        w = split(t)
        base = score = 0.0
        for k, x in enumerate(w):
            p = (one[x] + 0.5) / (n + 0.5 * (v + 1))
            base += math.log10(p)
            if k and one[w[k - 1]]:
                c = two[w[k - 1], x]
                p = (1 - given2[w[k - 1]]) * p + (c - lm.DISCOUNT if c >= lm.LEAST else 0) / one[w[k - 1]]
                if k > 1 and two[w[k - 2], w[k - 1]] >= lm.LEAST:
                    c = three[w[k - 2], w[k - 1], x]
                    p = (1 - given3[w[k - 2], w[k - 1]]) * p + (c - lm.DISCOUNT if c >= lm.LEAST else 0) / two[w[k - 2], w[k - 1]]
            score += math.log10(p)
        out.append((i, len(w), sum(one[x] > 0 for x in w), n, base, score))
    return out


@pytest.mark.parametrize(("shard_tokens", "shard_bytes"), [(4_000_000, 256 << 20), (20_000, 60_000)])
def test_language_model_against_dictionaries(spark, sf_dir, small_texts, shard_tokens, shard_bytes, monkeypatch):
    monkeypatch.setattr(lm, "SHARD_BYTES", shard_bytes)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").repartition(5)
    trie = lm.train_trie(docs.where(fold(docs["doc_id"], 5) != 1).select("text"), shard_tokens)
    rows = {r["doc_id"]: r for r in lm.score_texts(docs, trie, "text").collect()}
    for i, tokens, known, n, base, score in brute_model(small_texts):
        r = rows[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (tokens, known, n)
        assert abs(r["base_score"] - base) < 1e-9 * tokens and abs(r["score"] - score) < 1e-3 * tokens


def test_language_model_over_edge_rows(spark, edge_dir, edge_rows):
    found = sorted(map(str, ((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 3)) for r in lm.op8_lm_scoring(spark, edge_dir).collect())))
    expected = sorted(map(str, ((i, t, k, n, round(b, 3)) for i, t, k, n, b, _ in brute_model([r[:2] for r in edge_rows]))))
    assert found == expected


def test_language_model_learns_more_than_word_counts(spark, sf_dir):
    rows = [r for r in lm.op8_lm_scoring(spark, sf_dir).collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_pairs_and_triples_seen_once_are_in_the_model(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, "d e f")], "doc_id long, text string")
    rows = lm.score_texts(spark.createDataFrame([(3, "a b c"), (4, "a e c")], "doc_id long, text string"), lm.train_trie(docs.select("text")), "text").collect()
    seen, mixed_up = (next(r for r in rows if r["doc_id"] == i) for i in (3, 4))
    # All words are as frequent: only the pairs and triples tell the texts apart.
    assert abs(seen["base_score"] - mixed_up["base_score"]) < 1e-9 and seen["score"] > mixed_up["score"] + 0.5
