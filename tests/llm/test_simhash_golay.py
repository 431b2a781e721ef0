import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from glyphmill.llm import simhash_golay
from glyphmill.llm.components import connected_components


def plain_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
    if not words:
        return 0
    parts = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_golay_code_is_perfect():
    index = simhash_golay.golay_index()
    assert (np.bincount(index) == 2048).all()


def test_four_differing_bits_share_a_key():
    rng = np.random.default_rng(1)
    own = rng.integers(0, 2**64, 3000, dtype=np.uint64)
    other = own.copy()
    for _ in range(4):
        other ^= np.uint64(1) << rng.integers(0, 64, len(own)).astype(np.uint64)
    left, right = (set(zip(*(x.tolist() for x in simhash_golay.golay_keys(v)))) for v in (own, other))
    assert {place for _, place in left & right} == set(range(len(own)))


def test_groups_match_brute_force(make_docs):
    random.seed(3)
    words = [f"w{i}" for i in range(300)]
    texts = ["", None, " \t", "one", "One", "one two three", "É x", "a\x0bb\x85c d e", "long " * 20000]
    for _ in range(25):
        base = [random.choice(words) for _ in range(150)]
        texts.append(" ".join(base))
        for _ in range(random.randint(0, 4)):
            copy = list(base)
            copy[random.randrange(150)] = random.choice(words)
            texts.append(" ".join(copy).upper() if random.random() < 0.3 else "  ".join(copy))
    rows = [(1000 - i, t) for i, t in enumerate(texts)] + [(3, texts[12]), (3, texts[12]), (None, texts[12]), (None, "only this")]
    docs = make_docs(rows).withColumn("Root", F.lit("mine"))
    found = simhash_golay.near_duplicates(docs).collect()
    prints = {t: plain_fingerprint(t) for _, t in rows}
    nodes = sorted(set(prints.values()))
    links = [(a, b) for i, a in enumerate(nodes) for b in nodes[i + 1 :] if (a ^ b).bit_count() <= 4]
    assert links
    group = plain_components(nodes, links)
    least = {}
    for i, t in rows:
        if i is not None:
            least[group[prints[t]]] = min(i, least.get(group[prints[t]], i))
    assert len(found) == len(rows)
    for row in found:
        assert row["fp"] % (1 << 64) == prints[row["text"]]
        assert row["component_id"] == least.get(group[prints[row["text"]]])
    kept = simhash_golay.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(least.values()) and ids.count(None) == 1


def test_hot_keys_are_cut_into_parts(spark):
    near = [1 << i | 1 << j for i in range(64) for j in range(i)] + [0]
    rows = spark.createDataFrame([(x if x < 1 << 63 else x - (1 << 64),) for x in near], "fp bigint")
    links = simhash_golay.near_links(rows, part=64)
    assert links.count() < 60_000
    assert {r["root"] for r in connected_components(links).collect()} == {min(r["fp"] for r in rows.collect())}
    with pytest.raises(ValueError):
        simhash_golay.near_links(rows, max_bits=5)


def test_empty_table(make_docs):
    assert simhash_golay.near_duplicates(make_docs([])).count() == 0
    assert simhash_golay.drop_near_duplicates(make_docs([])).count() == 0


def test_components_of_chains_stars_and_loops(spark):
    random.seed(5)
    links = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1200)] + [(5000, 5000), (7, 7)]
    links += [(random.randrange(2000, 2300), random.randrange(2000, 2300)) for _ in range(200)]
    random.shuffle(links)
    found = connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    real = [(a, b) for a, b in links if a != b]
    assert {r["node"]: r["root"] for r in found} == plain_components({n for pair in real for n in pair}, real)
    assert len(found) == len({r["node"] for r in found})
