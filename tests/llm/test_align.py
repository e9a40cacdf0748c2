import base64
import hashlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from samples import EDGE, documents, words
from tokenizers import Tokenizer

from foliant.llm import align, queries

DATA = "/root/testdata/sf0.001"
EMPTY = (0, 0, 0, 0, 0, 0, "")


@pytest.fixture(scope="module")
def tools():
    """Both tokenizers straight from their libraries, and the bytes of their ids."""
    from sentencepiece import SentencePieceProcessor

    first = Tokenizer.from_file(queries.byte_bpe())
    first.encode_special_tokens = True
    ranks = open(queries.byte_bpe().replace(".json", ".tiktoken"), "rb").read().splitlines()
    shown_a = {int(n): base64.b64decode(x) for x, n in (line.split() for line in ranks)}
    second = SentencePieceProcessor(model_file=queries.piece_bpe())

    def shown_b(i):
        piece = second.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()

    return first, shown_a, second, shown_b


def plain_groups(tools, text):
    """Groups of (ids of A, ids of B), by walking both token rows; None where a side does not give the bytes back."""
    first, shown_a, second, shown_b = tools
    if not text:
        return None
    a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
    bytes_a, bytes_b = [shown_a[i] for i in a], [shown_b(i) for i in b]
    if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
        return None
    groups, i, j, at_a, at_b, own = [], 0, 0, 0, 0, ([], [])
    while i < len(a) or j < len(b):
        if at_a <= at_b:
            own[0].append(a[i])
            at_a, i = at_a + len(bytes_a[i]), i + 1
        else:
            own[1].append(b[j])
            at_b, j = at_b + len(bytes_b[j]), j + 1
        if at_a == at_b:
            groups.append(own)
            own = ([], [])
    return groups


def brute_force(tools, rows):
    every = [plain_groups(tools, t) for _, t in rows]
    linked = [Counter((a, b) for x, y in g or [] for a in x for b in y) for g in every]
    count = Counter(pair for one in linked for pair in one)
    highest = defaultdict(int)
    for (a, _), n in count.items():
        highest[a] = max(highest[a], n)
    out = []
    for (i, _), groups, own in zip(rows, every, linked):
        if groups is None:
            out.append((i, *EMPTY))
            continue
        line = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((
            i, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(own.values()),
            sum(n for p, n in own.items() if count[p] == highest[p[0]]),
            sum(n * count[p] for p, n in own.items()), hashlib.sha256(line.encode()).hexdigest(),
        ))
    return out


ODD = [
    (20, " leads and ends "), (21, "a  b   c    d" + " " * 40 + "e"), (22, "x<|endoftext|>y </s> <s> <unk> <0x41>"),
    (23, "a▁b"), (24, "日本語のテキスト。混ぜる\n\n\tтекст"), (25, "😀😃👩‍👩‍👧‍👦 ﷽ \u0000 ​"), (26, "."), (27, " "), (28, "\n.\n,"),
    (29, "=" * 500 + "-" * 333), (30, "naïve café ½ ① ﬁ"), (None, "the same text"), (None, "the same text"),
    (31, "the same text"), (31, "the same text"), (32, "1234567890" * 40),
]


def listed(df):
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr)


@pytest.mark.parametrize("block", [align.BLOCK, 40], ids=["one block", "many blocks"])
def test_matches_brute_force(spark, tools, block):
    rows = EDGE + ODD
    found = align.align(documents(spark, rows), queries.byte_bpe(), queries.piece_bpe(), block=block)
    assert listed(found) == sorted(brute_force(tools, rows), key=repr)


def test_query_matches_brute_force(spark, tools):
    rows = [(r.doc_id, r.text) for r in queries.table(spark, DATA, "documents").collect()]
    assert listed(queries.op11_alignment(spark, DATA)) == sorted(brute_force(tools, rows), key=repr)


def test_no_rows(spark):
    found = align.align(documents(spark, []), queries.byte_bpe(), queries.piece_bpe())
    assert found.count() == 0 and found.columns[0] == "doc_id"


def test_pointers_reach_the_last_token_of_every_component():
    rng = np.random.default_rng(3)
    for _ in range(200):
        n = int(rng.integers(1, 60))
        ends = [np.unique(np.r_[rng.choice(n, int(rng.integers(1, n + 1)), replace=False) + 1, n]) for _ in "ab"]
        groups = align.linked(*ends)
        common = np.intersect1d(*ends)
        for of, own in zip((groups.of_a, groups.of_b), ends):
            assert (of == np.searchsorted(common, own)).all()
    # One component over all tokens: chains as long as the text.
    a, b = np.r_[np.arange(2, 4001, 2), 4001], np.r_[np.arange(1, 4001, 2), 4001]
    assert len(align.linked(a, b).first_a) == 2


def test_large_groups_give_their_pairs_in_portions():
    rng = np.random.default_rng(4)
    a, b = rng.integers(0, 9, 300), rng.integers(0, 7, 200)
    groups = align.Groups(np.zeros(300, int), np.zeros(200, int), np.array([0, 300]), np.array([0, 200]))
    wanted = Counter((int(x), int(y)) for x in a for y in b)
    for most in (10**6, 20):
        found, portions = Counter(), 0
        for of, pairs, times in align.links(a, b, groups, most):
            portions += 1
            for p, t in zip(pairs.tolist(), times.tolist()):
                found[p >> align.BITS, p & (1 << align.BITS) - 1] += t
        assert found == wanted
    assert portions > 1


def test_planes_give_numbers_back():
    for values in ([], [0], [1, 2**32 - 1, 70_000]):
        assert align.from_planes(align.planes(np.array(values, np.int64))).tolist() == values


def test_words_are_as_the_library_has_them(tools):
    first, _, second, _ = tools
    texts = [words(5, 300), *(t for _, t in EDGE + ODD if t)]
    one, two = align.BytePieces(queries.byte_bpe()), align.MergedPieces(queries.piece_bpe())
    for text, a, b in zip(texts, one(pa.array([" " + t for t in texts])), two(pa.array(texts))):
        assert np.frombuffer(a, "<u4").tolist() == first.encode(" " + text, add_special_tokens=False).ids
        assert np.frombuffer(b, "<u4").tolist() == second.encode(text)
