"""Token ids in binary files: independent zstandard frames, a seek table, checksums.

A file is a row of zstandard frames; each holds the little-endian unsigned 32-bit
ids of some documents, with zstandard's own content checksum.  A skippable frame
with the document index and one with the seek table end it:

    frame*  skippable(index)  skippable(seek table)

The seek table follows the public seekable format: per frame its compressed size,
its size and the low 32 bits of the XXH64 of its content, then the number of
frames, a descriptor byte and the magic number.  The last entry is the index
itself, with decompressed size 0.  Any zstandard reader can read such a file from
front to back; one that knows the table decompresses only the frames it needs.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator
from itertools import accumulate
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskit.llm import token_ids
from corpuskit.session import checkpoint_dir, cut_lineage

END = 0
FRAME_IDS = 1 << 18
# Fixed values of the public seekable format.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
HAS_CHECKSUMS = 0x80
ENTRY = np.dtype([("packed", "<u4"), ("size", "<u4"), ("check", "<u4")])
# Per document: its id, 1 if that is null, its frame, its first id in the frame, its number of ids.
INDEX = np.dtype([("doc_id", "<i8"), ("no_id", "<u4"), ("frame", "<u4"), ("at", "<u8"), ("n", "<u8")])
MANIFEST = "shard int, path string, n_docs bigint, n_ids bigint"


def checksum(data: bytes | memoryview) -> int:
    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


class Writer:
    """Appends documents to one open binary stream."""

    def __init__(self, out, level: int = 3, frame_ids: int = FRAME_IDS) -> None:
        self.out, self.frame_ids = out, frame_ids
        self.compressor = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        self.entries: list[tuple[int, int, int]] = []
        self.index: list[tuple[int, int, int, int, int]] = []
        self.held: list[np.ndarray] = []
        self.size = self.n_ids = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        """A document lies in one frame; a longer one than ``frame_ids`` has a frame of its own."""
        if self.size and self.size + len(ids) > self.frame_ids:
            self.flush()
        self.index.append((doc_id or 0, int(doc_id is None), len(self.entries), self.size, len(ids)))
        self.held.append(ids.astype("<u4"))
        self.size += len(ids)
        self.n_ids += len(ids)

    def flush(self) -> None:
        if self.size:
            data = np.concatenate(self.held).tobytes()
            packed = self.compressor.compress(data)
            self.out.write(packed)
            self.entries.append((len(packed), len(data), checksum(data)))
            self.held, self.size = [], 0

    def close(self) -> None:
        self.flush()
        index = self.compressor.compress(np.array(self.index, INDEX).tobytes())
        self.out.write(struct.pack("<II", SKIPPABLE, len(index)) + index)
        self.entries.append((len(index) + 8, 0, checksum(index)))
        table = np.array(self.entries, ENTRY).tobytes() + struct.pack("<IBI", len(self.entries), HAS_CHECKSUMS, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()


class Reader:
    """Reads documents from a random-access stream, decompressing only their frames."""

    def __init__(self, source, size: int) -> None:
        self.source = source
        frames, flags, magic = struct.unpack("<IBI", self.bytes_at(size - 9, 9))
        if magic != SEEKABLE or flags != HAS_CHECKSUMS:
            raise ValueError("no seek table at the end of the file")
        width = frames * ENTRY.itemsize
        self.entries = np.frombuffer(self.bytes_at(size - 9 - width, width), ENTRY)
        self.starts = [0, *accumulate(int(n) for n in self.entries["packed"])]
        raw = self.bytes_at(self.starts[-2], int(self.entries["packed"][-1]))[8:]
        if checksum(raw) != self.entries["check"][-1]:
            raise ValueError("the document index is damaged")
        self.index = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), INDEX)
        self.held: tuple[int, np.ndarray] | None = None

    def bytes_at(self, start: int, size: int) -> bytes:
        self.source.seek(start)
        data = self.source.read(size)
        if len(data) != size:
            raise ValueError("the file is cut short")
        return data

    def frame(self, n: int) -> np.ndarray:
        if self.held is None or self.held[0] != n:
            packed, size, check = (int(v) for v in self.entries[n])
            data = zstandard.ZstdDecompressor().decompress(self.bytes_at(self.starts[n], packed), max_output_size=size)
            if len(data) != size or checksum(data) != check:
                raise ValueError(f"frame {n} is damaged")
            self.held = n, np.frombuffer(data, "<u4")
        return self.held[1]

    def documents(self, wanted: Iterable[int] | None = None) -> Iterator[tuple[int | None, np.ndarray]]:
        """``(doc_id, ids)`` in file order, of all documents or of those ids."""
        keep = np.ones(len(self.index), bool)
        if wanted is not None:
            keep = np.isin(self.index["doc_id"], np.array(list(wanted), np.int64)) & (self.index["no_id"] == 0)
        for doc_id, no_id, frame, at, n in self.index[keep].tolist():
            yield (None if no_id else doc_id), self.frame(frame)[at : at + n]


def open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return pafs.FileSystem.from_uri(path) if ":/" in path else (pafs.LocalFileSystem(), path)


def write_files(
    docs: DataFrame,
    folder: str,
    text: str = "text",
    doc_id: str = "doc_id",
    path: str | None = None,
    drops_space: bool = False,
    end: int = END,
) -> DataFrame:
    """Encode texts and write them in ascending id order; returns the list of files, in order.

    One range partition is one file.  A task writes under a name of its own and
    renames at the end, so a repeated task replaces its file as a whole.  Null ids
    come first, repeated ids follow each other.
    """
    path = path or token_ids.default_path("byte_bpe_50k.json")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        encode = token_ids.encoder(path, drops_space).encode
        fs, where = open_fs(folder)
        fs.create_dir(where, recursive=True)
        name = f"{where}/ids-{context.partitionId():06d}.zst"
        fresh = f"{name}.{context.taskAttemptId()}.writing"
        writer = Writer(fs.open_output_stream(fresh, compression=None))
        for batch in batches:
            keys = iter(batch.column(0).to_pylist())
            for texts in token_ids.array_groups(batch.column(1)):
                for ids, key in zip(encode(texts, end), keys):
                    writer.add(key, ids)
        writer.close()
        fs.move(fresh, name)
        row = [context.partitionId(), f"{folder}/ids-{context.partitionId():06d}.zst", len(writer.index), writer.n_ids]
        yield pa.RecordBatch.from_arrays(
            [pa.array([v], t) for v, t in zip(row, [pa.int32(), pa.string(), pa.int64(), pa.int64()])],
            names=["shard", "path", "n_docs", "n_ids"],
        )

    source = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    ordered = source.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    return cut_lineage(ordered.mapInArrow(rows, MANIFEST))


def read_files(files: DataFrame, doc_ids: list[int] | None = None) -> DataFrame:
    """``(shard, doc_id, at, ids)`` from written files; ``at``: ids of the file before the document.

    ``doc_ids`` names the requested documents; only their frames are decompressed.
    """
    schema = "shard int, doc_id bigint, at bigint, ids binary"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fs, where = open_fs(path)
                with fs.open_input_file(where) as source:
                    yield from read_file(shard, Reader(source, source.size()), doc_ids)

    # One row per file, each a task of its own.
    parts = max(1, files.count())
    return files.select("shard", "path").repartition(parts, "shard").mapInArrow(rows, schema)


def read_file(shard: int, reader: Reader, doc_ids: list[int] | None, ids_each: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The documents of one file in batches of about ``ids_each`` ids."""
    index = reader.index
    before = np.cumsum(index["n"]) - index["n"]
    keep = np.ones(len(index), bool)
    if doc_ids is not None:
        keep = np.isin(index["doc_id"], np.array(doc_ids, np.int64)) & (index["no_id"] == 0)
    held: list[tuple[int, int | None, int, bytes]] = []
    size = 0
    names, types = ["shard", "doc_id", "at", "ids"], [pa.int32(), pa.int64(), pa.int64(), pa.binary()]

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)

    for at, (doc_id, ids) in zip(before[keep].tolist(), reader.documents(doc_ids)):
        held.append((shard, doc_id, at, ids.tobytes()))
        size += len(ids)
        if size >= ids_each:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def id_digests(files: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` read back from the files.

    ``start`` counts the ids of all documents before it, over all files.
    """
    sizes = sorted((r["shard"], r["n_ids"]) for r in files.select("shard", "n_ids").collect())  # one per file
    bases = [0, *accumulate(n for _, n in sizes)]
    base = files.sparkSession.createDataFrame([(s, b) for (s, _), b in zip(sizes, bases)], "shard int, base bigint")
    read = read_files(files).select("shard", "doc_id", "at", (F.length("ids") / 4).cast("bigint").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
    rows = read.join(F.broadcast(base), "shard")  # one row per file
    return rows.select("doc_id", (F.col("at") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")


def fresh_folder(docs: DataFrame) -> str:
    """A new folder for files in the shared folder of the cluster."""
    return f"{checkpoint_dir(docs.sparkSession)}/token-files-{uuid4().hex}"


def round_trip(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Write all texts and read the digests back: null and empty texts are the end id alone."""
    return id_digests(write_files(docs, fresh_folder(docs), text, doc_id))
