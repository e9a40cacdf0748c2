import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from samples import EDGE, documents, words

from foliant.llm import graph, simhash

THREE = simhash.Setup(words=3, bits=64, differing=3, ratio=0)


def plain_fingerprint(text, setup):
    """Fingerprint words and shingle count, straight from the definition."""
    lowered = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    found = re.findall(rb"[^\x20\x09-\x0D]+", lowered)
    k = setup.words
    shingles = [b" ".join(found[i : i + k]) for i in range(len(found) - k + 1)] or ([b" ".join(found)] if found else [])
    out = []
    for seed in range(42, 42 + setup.bits // 64):
        hashes = [xxhash.xxh64_intdigest(s, seed) for s in shingles]
        out.append(sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes) > 0))
    return out, len(shingles)


def plain_groups(rows, setup):
    """Smallest id of the group of every row, by comparing all pairs."""
    prints = [plain_fingerprint(t, setup) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, n) in enumerate(prints):
        for j, (b, m) in enumerate(prints[:i]):
            near = sum((x ^ y).bit_count() for x, y in zip(a, b)) <= setup.differing
            if near and (a == b and n == m or not setup.ratio or min(n, m) >= setup.ratio * max(n, m)):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return [least.get(find(i)) for i in range(len(rows))]


def near_copies():
    rows = [(100 + i, words(i, 60)) for i in range(30)]
    for i in range(40):
        changed = words(i % 10, 60).split(" ")
        changed[(i * 7) % 60] = f"other{i}"
        rows.append((200 + i, " ".join(changed)))
    return rows + [(300 + i, words(3, 60)) for i in range(5)]


@pytest.mark.parametrize("setup", [THREE, simhash.Setup()], ids=["three bits", "similarity"])
def test_groups_match_all_pairs(spark, setup):
    rows = EDGE + near_copies()
    found = simhash.near_duplicates(documents(spark, rows), setup).select("doc_id", "w0", "component_id").collect()
    wanted = [
        (i, plain_fingerprint(t, setup)[0][0], c) for (i, t), c in zip(rows, plain_groups(rows, setup))
    ]
    by = lambda x: repr(x)
    assert sorted(((r[0], r[1] & (1 << 64) - 1, r[2]) for r in found), key=by) == sorted(wanted, key=by)


def test_blocks_lose_no_link(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 8)
    values = {int(b) ^ int((1 << rng.integers(0, 63)) | (1 << rng.integers(0, 63))) for b in base for _ in range(60)}
    nodes = spark.createDataFrame([(v, v, 9) for v in values], "node long, w0 long, n long")

    def roots(block_rows):
        links = simhash.link(nodes, THREE, block_rows=block_rows)
        return {tuple(r) for r in graph.components(links).collect()}

    whole = roots(4096)
    assert whole == roots(16) and len(whole) > 300


def test_chains_hold_for_every_linked_pair():
    """The strong form of the pigeonhole: some chain keeps its budget at every length."""
    rng = np.random.default_rng(2)
    for setup in (THREE, simhash.Setup()):
        widths = [w for _, _, w in setup.segments()]
        assert sum(widths) == setup.bits and len(widths) > setup.differing
        for _ in range(200):
            hit = set(rng.choice(setup.bits, rng.integers(0, setup.differing + 1), replace=False).tolist())
            ends = np.cumsum(widths)
            counts = [sum(e - w <= b < e for b in hit) for e, w in zip(ends, widths)]
            m = len(widths)
            assert any(
                all(sum(counts[(s + i) % m] for i in range(n)) <= n * setup.differing // m for n in range(1, m + 1))
                for s in range(m)
            )


def test_components_of_a_chain_and_loops(spark):
    links = [(i, i + 1) for i in range(200)] + [(5, 5), (900, 901), (901, 900), (None, 3)]
    found = graph.components(spark.createDataFrame(links, "a long, b long"))
    assert {r.node: r.root for r in found.collect()} == {**{i: 0 for i in range(201)}, 900: 900, 901: 900}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_hooks_join_only_what_is_linked(spark):
    links = [(3, 2), (2, 1), (7, 9), (9, 8), (5, 5), (4, None)]
    found = graph.hooks(spark.createDataFrame(links, "a long, b long"))
    assert {r.node: r.root for r in found.collect()} == {3: 1, 2: 1, 9: 7, 8: 7}


def test_empty_table(spark):
    assert simhash.near_duplicates(documents(spark, []), THREE).select(F.max("component_id")).first()[0] is None
