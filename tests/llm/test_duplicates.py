"""Exact and near deduplication against brute force."""

import random

import numpy as np
import xxhash

from ordermart.llm import simhash
from ordermart.llm.components import components
from ordermart.llm.exact import exact_dedup, exact_groups
from ordermart.llm.frames import Scratch, word_blocks

SPACES = " \t\n\r\x0b\x0c"


def squeezed(text):
    out, gap = [], False
    for c in text or "":
        if c in SPACES:
            gap = gap or out.append(" ") is None
        else:
            out.append(c)
            gap = False
    return "".join(out)


def test_exact_groups_of_all_lengths(spark):
    random.seed(5)
    bases = ["".join(random.choice("abcd") for _ in range(n)) for n in (0, 1, 63, 64, 65, 8255, 8256, 8257, 9000, 270_400, 1_400_000)]
    texts = [b for b in bases for _ in range(2)] + [b[:-1] + "!" for b in bases if b] + [None, " \t", " ", "\n"]
    rows = [(i, t) for i, t in enumerate(texts)]
    found = {r["id"]: r for r in exact_groups(spark.createDataFrame(rows, "doc_id long, text string")).selectExpr("doc.doc_id as id", "keep_id", "group_size", "kept").collect()}
    for i, t in rows:
        group = [j for j, u in rows if squeezed(u) == squeezed(t)]
        assert (found[i]["keep_id"], found[i]["group_size"], found[i]["kept"]) == (min(group), len(group), i == min(group))


def test_exact_dedup_keeps_one_row_of_each_text_and_all_columns(spark, edge_docs, edge_rows, no_docs):
    kept = exact_dedup(edge_docs)
    assert kept.schema == edge_docs.schema
    texts = sorted(squeezed(r["text"]) for r in kept.collect())
    assert texts == sorted({squeezed(r[1]) for r in edge_rows})
    assert all(r["rid"] == "own" for r in kept.collect())
    assert exact_dedup(no_docs).collect() == []


def brute_print(text, shingle=3):
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[k : k + shingle]) for k in range(len(words) - shingle + 1)] if len(words) >= shingle else [b" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    prints = sorted(set(prints))
    parent = {p: p for p in prints}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for i, p in enumerate(prints):
        for q in prints[:i]:
            if bin(p ^ q).count("1") <= 2:
                a, b = root(p), root(q)
                parent[max(a, b)] = min(a, b)
    return {p: root(p) for p in prints}


def test_query_against_brute_force(spark, sf_dir, small_texts):
    rows = {r["doc_id"]: r for r in simhash.op9_simhash_near_dedup(spark, sf_dir).collect()}
    prints = {i: brute_print(t) for i, t in small_texts}
    roots = brute_components(prints.values())
    first = {}
    for i, p in prints.items():
        first[roots[p]] = min(i, first.get(roots[p], i))
    assert {i: (r["fingerprint"], r["component_id"]) for i, r in rows.items()} == {i: (f"{p:016x}", first[roots[p]]) for i, p in prints.items()}


def test_blocks_of_words_give_the_same_print():
    random.seed(1)
    text = " ".join(random.choice(["a", "bb", "ccc", "é"]) + str(random.randint(0, 9)) for _ in range(2000)).encode()
    assert [w for block in word_blocks(text, 97) for w in block] == text.split()
    whole = simhash.fingerprint(text)
    before = simhash.word_blocks
    simhash.word_blocks = lambda t: word_blocks(t, 50)
    try:
        assert simhash.fingerprint(text) == whole == brute_print(text.decode())
    finally:
        simhash.word_blocks = before


def crowd(n, seed):
    """Fingerprints in tight clusters, so that many keys are shared by many."""
    rng = random.Random(seed)
    out = {0, (1 << 64) - 1, 1 << 63}
    while len(out) < n:
        p = rng.getrandbits(64) if rng.random() < 0.1 else rng.choice(sorted(out))
        for _ in range(rng.randint(0, 4)):
            p ^= 1 << rng.randrange(64)
        out.add(p)
    return sorted(out)


def test_bit_sliced_counters_find_just_the_near_lanes():
    prints = np.array(crowd(300, 2), np.uint64)
    planes = simhash.planes_of(prints)
    near, _ = simhash.near_lanes(planes, prints, np.zeros((len(prints), planes.shape[1]), np.uint64), list(range(64)))
    assert (near[:, : len(prints)] == (np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 2)).all()


def test_groups_give_all_pairs_once_and_are_abandoned():
    for n, seed in ((1, 1), (63, 2), (512, 3), (513, 4), (1500, 5)):
        prints = np.array(crowd(n, seed)[:n], np.uint64)
        i, j, _ = simhash.compared(prints)
        a, b = np.nonzero(np.tril(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 2, -1))
        assert sorted(zip(i.tolist(), j.tolist(), strict=True)) == sorted(zip(a.tolist(), b.tolist(), strict=True))
    rng = np.random.default_rng(6)
    far = np.unique(rng.integers(0, 1 << 63, 2000, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
    # A key's block: 32 bits are the same in all; those planes come last and are not read.
    keyed = np.unique(far << np.uint64(32) | np.uint64(0xABCD1234))
    for prints, most in ((far, 48), (keyed, 40)):
        i, _, read = simhash.compared(prints)
        groups = -(-len(prints) // simhash.GROUP)
        assert len(i) == int(np.tril(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 2, -1).sum())
        assert read <= most * groups * (groups + 1) // 2


def test_links_of_small_blocks_and_of_crowds_give_the_same_components(spark):
    prints = crowd(400, 3)
    expected = brute_components(prints)
    df = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fingerprint long").repartition(3)
    for block in (3, 2048):
        scratch = Scratch(spark)
        roots = {r["fingerprint"] % (1 << 64): r["root"] % (1 << 64) for r in simhash.near_groups(df, scratch, block).collect()}
        groups = {}
        for p in prints:
            groups.setdefault(roots.get(p, p), set()).add(p)
        wanted = {}
        for p, r in expected.items():
            wanted.setdefault(r, set()).add(p)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(0, 200)] + [(1000, j) for j in range(1001, 1100)] + [(5, 5)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "u long, v long"), Scratch(spark)).collect()}
    assert found == {i: 0 for i in range(201)} | {j: 1000 for j in range(1000, 1100)}


def test_near_dedup_keeps_one_row_of_each_component(spark, edge_docs, edge_rows, no_docs):
    kept = simhash.simhash_dedup(edge_docs)
    assert kept.schema == edge_docs.schema
    roots = brute_components(brute_print(r[1]) for r in edge_rows)
    assert sorted(roots[brute_print(r["text"])] for r in kept.collect()) == sorted(set(roots.values()))
    assert simhash.simhash_dedup(no_docs).collect() == []
