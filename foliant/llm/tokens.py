"""Token ids of whole texts, and a compressed file format for them.

A token file is a row of independent zstandard frames.  Each holds documents: a
header with their number, ids and lengths, then all their token ids as unsigned
32-bit integers, little-endian.  A long document goes on in the next frame.  Two
skippable frames end the file: an index of the frames (first document, its
place among the tokens) and, last, a seek table in the public layout of the
zstandard seekable format with a checksum for each frame.  A reader loads the
end of a file, and then only the frames that hold what is asked for.
"""

from __future__ import annotations

import re
import struct
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import batch, mapped, new_path, per_process, staged, text_rows
from .words import WordTable, in_portions

# Token ids per frame, and level of compression.
FRAME_TOKENS = 1 << 17
LEVEL = 1

# Fixed values of the zstandard seekable format.
SKIPPABLE, SEEK_MAGIC, CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
INDEX_FRAME = 0x184D2A50

# Words whose ids a worker remembers, and characters of text that are looked up at a time.
REMEMBERED = 1_000_000
AT_ONCE = 1 << 22

# White space, as Unicode has it.
WHITE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

# Words that begin with these have no space before them.
RAW = "\n.,"

# Marks the first word of a text, which has no space before it.
FIRST = "\0"


class Encoder:
    """Ids of texts, as bytes of unsigned 32-bit integers, by a tokenizer file.

    A byte-level tokenizer first cuts a text into pieces.  Where no white space
    follows other white space and points and commas follow letters or digits,
    pieces begin at every space, line feed, point and comma.  Such a text is cut
    there into words, each with what stands before it, and only words not met
    before go to the tokenizer; this is the same as encoding the text.  All other
    texts, and those with a special token's string, go to the tokenizer whole.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        size = self.tokenizer.get_vocab_size()
        self.bytes_of = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(size)])
        # What a text may not hold to be cut, strings with a meaning of their own among it.
        self.odd = "|".join([WHITE + WHITE, r"[^\pL\pN][.,]", r"\x00", *map(re.escape, specials)])
        self.table = WordTable(self.learn, remembered)

    def whole(self, texts: Sequence[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(list(texts), add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def learn(self, fresh: list[str]) -> dict[str, bytes]:
        """New words are laid end to end; the bytes each token stands for tell them apart."""
        learned = dict(zip(["", "\n"], self.whole([" ", "\n"])))
        first = [w for w in fresh if w[:1] == FIRST]
        learned.update(zip(first, self.whole([w[1:] for w in first])))
        words = [w for w in fresh if w and w != "\n" and w[0] != FIRST]
        for low in range(0, len(words), 2000):
            part = words[low : low + 2000]
            # A point or comma would join marks at the end of the word before; a letter keeps it apart.
            texts = [w if w[0] == "\n" else " a" + w if w[0] in RAW else " " + w for w in part]
            found = self.tokenizer.encode_batch_fast(["".join(texts)], add_special_tokens=False)[0]
            ids = np.array(found.ids, "<u4")
            ends = np.cumsum([len(t.encode()) for t in texts])
            reached = np.searchsorted(np.cumsum(self.bytes_of[ids]), ends) + 1
            starts = np.r_[0, reached[:-1]] + [w[0] in ".," for w in part]
            data = ids.tobytes()
            learned.update(
                (w, data[4 * a : 4 * b]) for w, a, b in zip(part, starts.tolist(), reached.tolist())
            )
        return learned

    def __call__(self, texts: pa.Array) -> Iterator[bytes]:
        for part in in_portions(texts, AT_ONCE):
            odd = pc.match_substring_regex(part, self.odd)
            plain = part.filter(pc.invert(odd))
            for mark in RAW:
                plain = pc.replace_substring(plain, mark, " " + mark)
            found = self.table.ids(pc.binary_join_element_wise(FIRST, plain, ""), " ")
            for text, whole in zip(part, odd.to_pylist()):
                yield self.whole([text.as_py()])[0] if whole else next(found)


def encoder(path: str, remembered: int = REMEMBERED) -> Encoder:
    return per_process(f"tokens {path} {remembered}", lambda: Encoder(path, remembered))


def token_counts(
    docs: DataFrame,
    tokenizer: str,
    end: int = 1,
    key: str = "doc_id",
    text: str = "text",
    remembered: int = REMEMBERED,
) -> DataFrame:
    """``doc_id`` and ``n_tokens`` of every row, ``end`` added to each; nulls count as empty.

    A worker keeps the ids of ``remembered`` words; fewer save memory and cost time.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, remembered)
        for rows in batches:
            counts = [len(x) // 4 + end for x in encode(rows.column("text"))]
            yield batch(schema, rows.column("doc_id"), counts)

    return mapped(text_rows(docs, key, text), run, "doc_id long, n_tokens long")


def _file_system(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (
        pafs.LocalFileSystem(), path
    )


class FrameWriter:
    """Writes one token file; ``add`` takes documents in their order."""

    def __init__(self, out, frame_tokens: int = FRAME_TOKENS):
        self.out, self.frame_tokens = out, frame_tokens
        self.entries: list[tuple[int, int, int]] = []
        self.index: list[tuple[int, int, int]] = []
        self.docs: list[tuple[int, int, int]] = []
        self.ids: list[bytes] = []
        self.held = self.written = self.n_docs = 0
        self.packer = zstandard.ZstdCompressor(level=LEVEL)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """A document; its flags say whether the id is null and whether it goes on from the last frame."""
        flags, rest = int(doc_id is None), memoryview(ids)
        self.n_docs += 1
        while True:
            room = (self.frame_tokens - self.held) * 4
            part, rest = rest[:room], rest[room:]
            self.docs.append((doc_id or 0, flags, len(part) // 4))
            self.ids.append(bytes(part))
            self.held += len(part) // 4
            if self.held >= self.frame_tokens:
                self.flush()
            if not rest:
                return
            flags |= 2

    def flush(self) -> None:
        if not self.docs:
            return
        head = np.array(self.docs, "<i8")
        content = struct.pack("<I", len(head)) + head.tobytes() + b"".join(self.ids)
        packed = self.packer.compress(content)
        self.entries.append((len(packed), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))
        self.index.append((self.docs[0][0], self.docs[0][1], self.written))
        self.out.write(packed)
        self.written += self.held
        self.docs, self.ids, self.held = [], [], 0

    def close(self) -> None:
        self.flush()
        index = np.array(self.index, "<i8").tobytes()
        self.out.write(struct.pack("<II", INDEX_FRAME, len(index)) + index)
        table = np.array(self.entries, "<u4").tobytes() + struct.pack(
            "<IBI", len(self.entries), CHECKSUMS, SEEK_MAGIC
        )
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)


def read_tail(handle, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Seek table (offset, packed size, size, checksum) and index (document, flags, tokens before)."""
    handle.seek(size - 9)
    frames, _, magic = struct.unpack("<IBI", handle.read(9))
    if magic != SEEK_MAGIC:
        raise ValueError("not a seekable token file")
    table = 12 * frames + 9
    handle.seek(size - table - 8 - 24 * frames)
    index = np.frombuffer(handle.read(24 * frames), "<i8").reshape(-1, 3)
    handle.seek(size - table)
    entries = np.frombuffer(handle.read(12 * frames), "<u4").reshape(-1, 3).astype(np.int64)
    offsets = np.cumsum(entries[:, 0]) - entries[:, 0]
    return np.column_stack([offsets, entries]), index


def read_frame(packed: bytes, size: int, checksum: int) -> list[tuple[int | None, bool, np.ndarray]]:
    """Documents of a frame: id, whether it goes on from the frame before, token ids."""
    content = zstandard.ZstdDecompressor().decompress(packed, max_output_size=size)
    if len(content) != size or xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != checksum:
        raise ValueError("a frame's checksum does not hold")
    (n,) = struct.unpack_from("<I", content)
    head = np.frombuffer(content, "<i8", 3 * n, 4).reshape(-1, 3)
    ids = np.frombuffer(content, "<u4", -1, 4 + 24 * n)
    ends = np.cumsum(head[:, 2])
    return [
        (None if flags & 1 else int(doc), bool(flags & 2), ids[end - count : end])
        for (doc, flags, count), end in zip(head.tolist(), ends.tolist())
    ]


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int = 0,
    files: int | None = None,
    frame_tokens: int = FRAME_TOKENS,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Writes all documents in ascending order of id; one row per file comes back.

    Rows are ranged by (id, text), so a hot id is no hot file unless its rows are
    equal too; null ids come first, null texts count as empty, repeated rows are
    all written.  A file gets its name when it is complete: a task that is run
    twice leaves one file, whichever run ends first.
    """
    spark = docs.sparkSession
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = text_rows(docs, key, text)
    ordered = rows.repartitionByRange(files, "doc_id", F.xxhash64("text"))
    ordered = ordered.sortWithinPartitions("doc_id", F.xxhash64("text")).withColumn(
        "part", F.spark_partition_id()
    )
    schema = pa.schema(
        [("part", pa.int32()), ("path", pa.string()), ("bytes", pa.int64()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]
    )
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        for rows in batches:
            if not rows.num_rows:
                continue
            if writer is None:
                encode = encoder(tokenizer)
                system, root = _file_system(folder)
                system.create_dir(root, recursive=True)
                part = rows.column("part")[0].as_py()
                draft, path = f"{root}/.{part:06d}-{uuid.uuid4().hex}", f"{root}/{part:06d}.tok"
                out = system.open_output_stream(draft)
                writer = FrameWriter(out, frame_tokens)
            for doc_id, ids in zip(rows.column("doc_id").to_pylist(), encode(rows.column("text"))):
                writer.add(doc_id, ids + end)
        if writer is not None:
            writer.close()
            size = out.tell()
            out.close()
            if system.get_file_info(path).type == pafs.FileType.NotFound:
                system.move(draft, path)
            else:  # another run of this task was first; its file is the same
                system.delete_file(draft)
            yield batch(schema, [part], [path], [size], [writer.n_docs], [writer.written])

    return staged(
        mapped(ordered, run, "part int, path string, bytes long, n_docs long, n_tokens long"), "token-files"
    )


def read_tokens(
    files: DataFrame, folder: str, wanted: tuple[int, int] | None = None
) -> DataFrame:
    """Documents of token files: ``part``, ``place`` in it, ``doc_id``, ``start``, ``ids`` (binary).

    ``files`` has ``part``, ``path``, ``bytes`` and ``before``, the number of tokens
    of all files before, from which ``start`` counts on.  With ``wanted``, lowest and
    highest id, only frames that may hold such documents are loaded and unpacked.
    Checksums of the frames that are read are compared.
    """
    schema = pa.schema(
        [("part", pa.int32()), ("place", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())]
    )

    def documents(handle, part: int, size: int, before: int) -> Iterator[list]:
        table, index = read_tail(handle, size)
        first, last = 0, len(table)
        if wanted is not None:
            known = np.where(index[:, 1] & 1, np.iinfo(np.int64).min, index[:, 0])
            first = max(0, int(np.searchsorted(known, wanted[0], "left")) - 1)
            last = int(np.searchsorted(known, wanted[1], "right"))
        open_: list | None = None
        at = before + (int(index[first, 2]) if first < len(index) else 0)
        for place, (offset, packed, full, checksum) in enumerate(table[first:last].tolist(), first):
            handle.seek(offset)
            for number, (doc, goes_on, ids) in enumerate(read_frame(handle.read(packed), full, checksum)):
                if goes_on and open_ is not None:
                    open_[4].append(ids.tobytes())
                elif not goes_on:
                    if open_ is not None:
                        yield open_
                    open_ = [part, place * (1 << 32) + number, doc, at, [ids.tobytes()]]
                at += ids.size
        if open_ is not None:
            yield open_

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = _file_system(folder)
        for rows in batches:
            columns = (rows.column(c).to_pylist() for c in ("part", "path", "bytes", "before"))
            for part, path, size, before in zip(*columns):
                with system.open_input_file(path) as handle:
                    held, total = [], 0
                    for row in documents(handle, part, size, before):
                        if wanted and not (row[2] is not None and wanted[0] <= row[2] <= wanted[1]):
                            continue
                        row[4] = b"".join(row[4])
                        held.append(row)
                        total += len(row[4])
                        if total >= 1 << 23:
                            yield batch(schema, *map(list, zip(*held)))
                            held, total = [], 0
                    if held:
                        yield batch(schema, *map(list, zip(*held)))

    return mapped(
        files.select("part", "path", "bytes", "before"), run, "part int, place long, doc_id long, start long, ids binary"
    )


def with_starts(files: DataFrame) -> DataFrame:
    """Adds ``before``, the number of tokens of all files before; one row per file is summed up."""
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("before", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0).cast("long")))


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Writes token files into the shared folder and reads them back."""
    spark: SparkSession = docs.sparkSession
    folder = new_path(spark, "tokens")
    files = with_starts(write_tokens(docs, folder, tokenizer, end_id))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return read_tokens(files.repartition(parts, "part"), folder)


def checksums(tokens: DataFrame) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32`` of documents read back."""
    return tokens.select(
        "doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
