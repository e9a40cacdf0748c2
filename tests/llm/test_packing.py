import itertools
import random
from collections import defaultdict

import pytest
from samples import EXTRA

from foliant.llm import packing


def padding(limits, lengths, counts):
    return sum(c * (min(x for x in limits if x >= n) - n) for n, c in zip(lengths, counts))


def test_limits_are_optimal():
    rng = random.Random(1)
    for _ in range(150):
        lengths = sorted(rng.sample(range(40), rng.randint(1, 8)))
        counts, buckets = [rng.randint(1, 9) for _ in lengths], rng.randint(1, 5)
        limits = packing.optimal_limits(lengths, counts, buckets)
        best = min(
            padding({*some, lengths[-1]}, lengths, counts)
            for k in range(min(buckets, len(lengths)))
            for some in itertools.combinations(lengths[:-1], k)
        )
        assert len(limits) <= buckets and padding(limits, lengths, counts) == best
    assert packing.optimal_limits([], [], 3) == []


def test_every_token_is_packed_once_and_batches_are_full(spark):
    rng = random.Random(2)
    rows = [(i // 2, rng.choice([0, 1, 3, 40, 41, 99, 250, 1001])) for i in range(600)]
    rows += [(None, 7), (None, 7), (5, None), (6, -3)]
    extra = ", ".join(f"{c} string" for c in EXTRA if c != "n_tokens")
    lengths = spark.createDataFrame([(*r, *["x"] * len(EXTRA)) for r in rows], f"doc_id long, n_tokens long, {extra}")
    plan = packing.Plan(max_length=100, buckets=4, budget=300)
    found = packing.pack(lengths, plan).collect()
    wanted = sorted((repr(i), max(n or 0, 0)) for i, n in rows)
    pieces = defaultdict(list)
    for r in found:
        assert 0 <= r.length <= 100 and r.start == r.piece * 100 and r.length <= r.padded
        pieces[r.doc_id].append(r)
    assert sum(r.length for r in found) == sum(n for _, n in wanted)
    assert sum(1 for r in found if r.piece == 0) == len(rows)
    batches = defaultdict(list)
    for r in found:
        batches[r.bucket, r.batch].append(r)
    last = {b: max(n for c, n in batches if c == b) for b, _ in batches}
    for (bucket, number), part in batches.items():
        room = 300 // max(part[0].padded, 1)
        assert len({r.padded for r in part}) == 1
        assert sorted(r.slot for r in part) == list(range(len(part))) and len(part) <= room
        assert len(part) == room or number == last[bucket]
    assert all(sorted({n for b, n in batches if b == x}) == list(range(last[x] + 1)) for x in last)


def test_no_rows_and_impossible_plans(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, n_tokens long")).count() == 0
    with pytest.raises(ValueError):
        packing.Plan(max_length=10, budget=5)
