import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from samples import EDGE, documents, words
from tokenizers import Tokenizer

from foliant.llm import bins, queries

DATA = "/root/testdata/sf0.001"


def one_by_one(lengths, room):
    """Best-two-fit over a list of pieces, sequence by sequence."""
    left, out = sorted(lengths, reverse=True), []
    while left:
        inside, free = [], room
        for n in list(left):
            if n <= free:
                inside.append(n)
                left.remove(n)
                free -= n
        if len(inside) > 1 and free:
            gap = free + inside[-1]
            pairs = [(a + b, a, b) for i, a in enumerate(left) for b in left[i + 1 :] if inside[-1] < a + b <= gap]
            if pairs:
                _, a, b = max(pairs)
                left.append(inside.pop())
                inside += [a, b]
                left.remove(a)
                left.remove(b)
                left.sort(reverse=True)
        out.append(tuple(sorted(inside, reverse=True)))
    return out


def test_equals_filling_one_sequence_after_another():
    rng = random.Random(1)
    for _ in range(300):
        room = rng.randint(1, 40)
        lengths = [rng.randint(1, room) for _ in range(rng.randint(0, 80))]
        found = bins.best_two_fit(Counter(lengths), room)
        assert [f.lengths for f in found for _ in range(f.times)] == one_by_one(lengths, room)


def test_replacement_saves_a_sequence():
    # Greedy filling puts 6 and 3 together and leaves one unit free; 6 takes 2 and 2 instead.
    assert [f.lengths for f in bins.best_two_fit({6: 1, 3: 1, 2: 2}, 10)] == [(6, 2, 2), (3,)]


def test_few_fillings_whatever_the_numbers():
    rng = random.Random(2)
    counts = {n: rng.randrange(10**9) for n in range(1, 1025)}
    found = bins.best_two_fit(counts, 1024)
    held = Counter()
    for f in found:
        assert sum(f.lengths) <= 1024 and f.times > 0
        for n in f.lengths:
            held[n] += f.times
    assert held == {n: c for n, c in counts.items() if c} and len(found) < 2500
    tokens = sum(n * c for n, c in counts.items())
    assert sum(f.times for f in found) < 1.03 * tokens / 1024


def test_only_the_first_piece_is_shorter():
    for n in range(1, 60):
        found = bins.cut(n, 10)
        assert [s for s, _ in found] == list(np.cumsum([0, *(m for _, m in found)]))[:-1]
        assert all(m == 10 for _, m in found[1:]) and 0 < found[0][1] <= 10 and sum(m for _, m in found) == n


def checked(packed, rows, room):
    """Asserts what holds of every packing; gives the number of sequences."""
    tokenizer = Tokenizer.from_file(queries.byte_bpe())
    wanted = Counter((i, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids) + (2,)) for i, t in rows)
    inside, documents_ = defaultdict(list), defaultdict(list)
    for r in packed:
        ids = tuple(np.frombuffer(r.ids, "<u4").tolist())
        assert len(ids) == r.length
        inside[r.sequence_id].append((r.offset, r.length))
        documents_[r.doc_id].append((r.piece, r.start, ids))
    for places in inside.values():
        places.sort()
        assert [o for o, _ in places] == [int(x) for x in np.cumsum([0, *(n for _, n in places)])[:-1]]
        assert sum(n for _, n in places) <= room
    assert sorted(inside) == list(range(len(inside)))
    assert sum(len(ids) * n for (_, ids), n in wanted.items()) == sum(n for p in inside.values() for _, n in p)
    for (i, ids), n in wanted.items():
        for number, (start, length) in enumerate(bins.cut(len(ids), room)):
            assert documents_[i].count((number, start, ids[start : start + length])) >= n
    return len(inside)


@pytest.mark.parametrize("room", [1, 7, 1024])
def test_any_rows(spark, room):
    rows = [(i, t[:300] if t else t) for i, t in EDGE] if room < 1024 else EDGE + [(50 + i, words(i, 30 * i)) for i in range(40)]
    packed = bins.pack(documents(spark, rows), queries.byte_bpe(), room).collect()
    n = checked(packed, rows, room)
    assert n == sum(f.times for f in bins.best_two_fit(Counter(r.length for r in packed), room))


def test_no_rows(spark):
    assert bins.pack(documents(spark, []), queries.byte_bpe()).count() == 0


def test_query_and_sequences(spark):
    docs = queries.table(spark, DATA, "documents")
    packed = bins.pack(docs, queries.byte_bpe())
    rows = packed.collect()
    n = checked(rows, [(r.doc_id, r.text) for r in docs.collect()], 1024)
    tokens = sum(r.length for r in rows)
    assert n <= -(-tokens // 1024) * 1.02 + 1
    found = {r.sequence_id: r for r in bins.sequences(packed).collect()}
    assert len(found) == n and sum(len(r.ids) // 4 for r in found.values()) == tokens
    for r in rows:
        ids = found[r.sequence_id].ids
        assert ids[4 * r.offset : 4 * (r.offset + r.length)] == r.ids
    shown = queries.op12_best_two_fit(spark, DATA)
    assert shown.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert shown.count() == len(rows)
