import random

import numpy as np
import pytest
from samples import EDGE, documents, words

from foliant.llm import bwt, repeats


def plain_ranges(texts, length):
    """Removed ranges by counting every string."""
    seen = {}
    for t in texts:
        for i in range(len(t) - length + 1):
            seen[t[i : i + length]] = seen.get(t[i : i + length], 0) + 1
    out = []
    for t in texts:
        ranges = []
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                if ranges and i <= ranges[-1][1]:
                    ranges[-1] = (ranges[-1][0], i + length)
                else:
                    ranges.append((i, i + length))
        out.append(ranges)
    return out


def rows_with_passages():
    passage = words(50, 40)
    rows = [(100 + i, words(i, 30, 10_000) + passage[i : i + 90 + i] + words(i + 60, 20, 10_000)) for i in range(40)]
    rows += [(200 + i, "ab" * (20 + i)) for i in range(12)]
    rows += [(300, "ü😀" * 40), (301, "x" + "ü😀" * 40 + "y"), (302, "z" * 24), (303, "z" * 25)]
    return rows + EDGE[:3] + EDGE[4:]


@pytest.mark.parametrize(
    "levels, group_bytes", [((8, 20), 1 << 20), ((8, 20), 600), ((13,), 1), ((), 1)], ids=repr
)
def test_removed_ranges_match_counting(spark, levels, group_bytes):
    rows = rows_with_passages()
    done = repeats.remove_repeats(documents(spark, rows), 25, levels=levels, group_bytes=group_bytes)
    found = done.select("doc_id", "text", "spans", "n_bytes", "n_removed", "kept").collect()
    texts = [(t or "").encode() for _, t in rows]
    wanted = {}
    for (doc_id, text), data, ranges in zip(rows, texts, plain_ranges(texts, 25)):
        wanted.setdefault((doc_id, text), []).append((ranges, data))
    assert len(found) == len(rows)
    for r in found:
        ranges, data = wanted[r.doc_id, r.text][0]
        assert [(s.low, s.high) for s in r.spans] == ranges
        assert r.n_bytes == len(data) and r.n_removed == sum(b - a for a, b in ranges)
        kept = bytes(c for i, c in enumerate(data) if not any(a <= i < b for a, b in ranges))
        assert bytes(r.kept) == kept


def test_whole_characters_leave_text(spark):
    rows = [(1, "é" + "日本語" * 20 + "a"), (2, "ü" + "日本語" * 20 + "b")]
    done = repeats.remove_repeats(documents(spark, rows), 20, levels=(7,), whole_characters=True)
    assert {bytes(r.kept).decode() for r in done.collect()} == {"éa", "üb"}


def test_no_rows(spark):
    assert repeats.remove_repeats(documents(spark, []), 25, levels=(8,)).count() == 0


def test_every_string_lies_inside_an_anchor():
    rng = random.Random(4)
    for _ in range(60):
        length, size = 20, rng.choice([5, 9, 20])
        texts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 120))) for _ in range(4)]
        offsets = np.cumsum([0, *map(len, texts)])
        data = np.frombuffer(b"".join(texts), np.uint8)
        text, mark, start, stop, _ = repeats.anchors(data, offsets, size, length)
        marks = {}
        for t, h, a, b in zip(text, mark, start, stop):
            assert offsets[t] <= a < b <= offsets[t + 1]
            for i in range(a, b - length + 1):
                marks.setdefault((t, i), set()).add(int(h))
        by_string = {}
        for t, body in enumerate(texts):
            for i in range(len(body) - length + 1):
                here = marks[t, int(offsets[t]) + i]
                by_string.setdefault(body[i : i + length], []).append(here)
        # Equal strings share an anchor.
        assert all(set.intersection(*found) for found in by_string.values())


def test_transform_finds_repeats_of_one_group():
    rng = random.Random(1)
    for _ in range(100):
        length = rng.choice([3, 5, 8])
        texts = [bytes(rng.choice(b"ab\0\xff") for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(1, 6))]
        groups = np.array([rng.randint(0, 1) for _ in texts])
        flags, offsets = bwt.repeated_starts(texts, groups, length)
        strings = [(g, t[i : i + length]) for t, g in zip(texts, groups) for i in range(len(t) - length + 1)]
        for t, g, o in zip(texts, groups, offsets):
            for i in range(len(t)):
                twice = i + length <= len(t) and strings.count((g, t[i : i + length])) > 1
                assert flags[o + i] == twice


def test_borders_by_increasing_common_prefix():
    data = b"banana bandana" * 3
    codes = np.frombuffer(data + b"\0", np.uint8).astype(np.uint16) + 2
    order = bwt.suffix_order(codes, 10)
    transform = np.where(order > 0, codes[order - 1], 0).astype(np.uint16)
    borders = bwt.short_prefixes(transform, 10)
    body = data + b"\0"
    for i in range(1, len(order)):
        a, b = body[order[i - 1] :], body[order[i] :]
        assert borders[i] == (a[:10] != b[:10])


def test_equal_rows_send_their_surroundings_once(monkeypatch):
    sizes, whole = [], bwt.repeated_starts
    monkeypatch.setattr(bwt, "repeated_starts", lambda texts, *a: sizes.append(sum(map(len, texts))) or whole(texts, *a))
    data, other = words(1, 100).encode(), words(2, 10).encode() + words(1, 100).encode()
    part = repeats.batch(
        repeats.pa.schema([("g", repeats.pa.int64()), ("ctx", repeats.pa.int64()), ("data", repeats.pa.binary())]),
        [7] * 501, [1] * 500 + [2], [data] * 500 + [other],
    )
    found = repeats.pa.Table.from_batches(repeats._shards(400)(iter([part.slice(0, 300), part.slice(300)])))
    assert sizes == [len(data) + len(other)]
    assert sorted(found.column("ctx").to_pylist()) == [1, 2]


def test_equal_rows_and_a_text_with_their_passage(spark):
    passage = words(1, 100)
    rows = [(1, words(3, 30) + passage)] * 60 + [(2, passage + words(4, 30)), (3, words(5, 90))]
    texts = [t.encode() for _, t in rows]
    for group_bytes in (1 << 20, 300):
        done = repeats.remove_repeats(documents(spark, rows), 100, levels=(20, 60), group_bytes=group_bytes)
        found = {r.doc_id: [(s.low, s.high) for s in r.spans] for r in done.collect()}
        assert found == {i: ranges for (i, _), ranges in zip(rows, plain_ranges(texts, 100))}
