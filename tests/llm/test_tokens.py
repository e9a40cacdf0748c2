import itertools
import random
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from samples import EDGE, documents
from tokenizers import Tokenizer

from foliant.llm import queries, tokens
from foliant.llm.common import new_path

PATH = queries.byte_bpe()


def plain_ids(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids


def test_words_give_the_ids_of_whole_texts():
    alphabet = ["a", "b", "é", " ", " ", "\n", "\t", "'s", "1", "²", "!", "…", " ", "\xa0", "’", "日", "\r", "😀",
                "<|endoftext|>", "don't"]
    rng, own = random.Random(2), tokens.Encoder(PATH)
    whole = Tokenizer.from_file(PATH)
    for _ in range(300):
        texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 12))) for _ in range(10)]
        wanted = [np.array(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
        assert list(own(pa.array(texts))) == wanted


@pytest.mark.parametrize("files, frame", [(1, 1 << 17), (4, 100), (3, 1)])
def test_files_hold_all_documents_in_order(spark, files, frame):
    rows = EDGE if frame > 1 else [r for r in EDGE if len(r[1] or "") < 200]
    folder = new_path(spark, "tokens-test")
    written = tokens.with_starts(
        tokens.write_tokens(documents(spark, rows), folder, PATH, files=files, frame_tokens=frame)
    )
    found = tokens.read_tokens(written, folder).orderBy("part", "place").collect()
    wanted = [[*plain_ids(t), 0] for _, t in rows]
    order = [r.doc_id for r in found]
    assert order == sorted(order, key=lambda x: (x is not None, x or 0))
    ids = [np.frombuffer(r.ids, "<u4").tolist() for r in found]
    assert sorted(zip(map(repr, order), ids)) == sorted(zip([repr(i) for i, _ in rows], wanted))
    assert [r.start for r in found] == [0, *itertools.accumulate(map(len, ids))][:-1]
    sums = tokens.checksums(tokens.read_tokens(written, folder)).collect()
    assert sorted(r.ids_crc32 for r in sums) == sorted(zlib.crc32(np.array(x, "<u4").tobytes()) for x in wanted)
    some = tokens.read_tokens(written, folder, wanted=(4, 5)).collect()
    assert sorted(r.doc_id for r in some) == [4, 4, 5]


def test_only_wanted_frames_are_read_and_damage_is_seen(spark):
    rows = [(i, f"text number {i}") for i in range(50)]
    folder = new_path(spark, "tokens-test")
    files = tokens.with_starts(tokens.write_tokens(documents(spark, rows), folder, PATH, files=1, frame_tokens=20))
    path = Path(files.first().path)
    with path.open("rb") as file:
        table, index = tokens.read_tail(file, path.stat().st_size)
    assert len(table) > 5 and index[0][2] == 0
    # Damage in the last frame is not noticed by a reader of the first documents.
    data = bytearray(path.read_bytes())
    data[int(table[-1][0] + table[-1][1]) - 1] ^= 0xFF
    path.write_bytes(data)
    crc = path.with_name(f".{path.name}.crc")
    assert not crc.exists()
    assert [r.doc_id for r in tokens.read_tokens(files, folder, wanted=(0, 2)).collect()] == [0, 1, 2]
    with pytest.raises(Exception, match="checksum|[Zz]std|decompress"):
        tokens.read_tokens(files, folder).collect()


def test_no_rows(spark):
    assert tokens.round_trip(documents(spark, []), PATH).count() == 0
    assert tokens.token_counts(documents(spark, []), PATH).count() == 0
