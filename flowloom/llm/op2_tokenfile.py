"""Token-id files of patched frame-of-reference blocks, as a Spark data source.

A file holds whole documents in order. Their ids are one sequence, cut into blocks of 1,024. A block stores its minimum
and the differences to it at the bit width that a share of them (a percentile) needs; the rest are exceptions, stored
with their place. An index at the end of the file gives where each block starts, so a reader can begin at any id without
unpacking what comes before.

    magic | blocks ... | documents: ids, which are null, counts | block starts | six 64-bit numbers | magic
    block: minimum u32, values u16, width u8, 0, exceptions u16, 0 u16 | packed words u32 | places u16 | values u32

Each task writes files of its own under a new name; only the list written at the commit makes them part of the table. So a
task that runs twice or is lost leaves nothing that is read.
"""

from __future__ import annotations

import json
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)

from flowloom.llm.batches import slices, texts_of
from flowloom.llm.encoded import library_ids

BLOCK = 1024
_LANES = 32
_MAGIC = b"PFORIDS1"
_HEAD = struct.Struct("<IHBBHH")
_TAIL = struct.Struct("<6Q")
_LIST = "_files.json"
_SLICE = 2 << 20
#: Ids after which a task begins a new file, at the next document.
FILE_IDS = 1 << 24


# Blocks


def pack(values: np.ndarray, percentile: float) -> list[bytes]:
    """Blocks of 1,024 unsigned 32-bit values; the last may be shorter."""
    if not len(values):
        return []
    count = -(-len(values) // BLOCK)
    padded = np.full(count * BLOCK, values[-1], np.uint32)
    padded[: len(values)] = values
    rows = padded.reshape(count, BLOCK)
    low = rows.min(axis=1)
    over = rows - low[:, None]
    rank = min(BLOCK - 1, max(0, int(np.ceil(percentile * BLOCK)) - 1))
    widths = np.ceil(np.log2(np.partition(over, rank, axis=1)[:, rank].astype(np.float64) + 1)).astype(np.int64)
    # Values that need more bits than the block's width; none can at 32.
    apart = over > ((np.uint64(1) << widths.astype(np.uint64)) - np.uint64(1)).astype(np.uint32)[:, None]
    out: list[bytes] = [b""] * count
    for width in np.unique(widths):
        chosen = np.flatnonzero(widths == width)
        bits = _pack_bits(np.where(apart[chosen], 0, over[chosen]), int(width))
        for words, k in zip(bits, chosen, strict=True):
            places = np.flatnonzero(apart[k])
            held = min(BLOCK, len(values) - k * BLOCK)
            places = places[places < held]
            head = _HEAD.pack(int(low[k]), held, int(width), 0, len(places), 0)
            out[k] = head + words.tobytes() + places.astype("<u2").tobytes() + over[k][places].astype("<u4").tobytes()
    return out


def _pack_bits(rows: np.ndarray, width: int) -> np.ndarray:
    """Lane j of a block holds its values j, j + 32, ...; each lane packs 32 values into `width` words."""
    lanes = rows.reshape(len(rows), BLOCK // _LANES, _LANES).astype(np.uint32)
    words = np.zeros((len(rows), width, _LANES), "<u4")
    for i in range(BLOCK // _LANES if width else 0):
        word, shift = divmod(i * width, 32)
        words[:, word] |= lanes[:, i] << np.uint32(shift)
        if shift + width > 32:
            words[:, word + 1] |= lanes[:, i] >> np.uint32(32 - shift)
    return words.reshape(len(rows), -1)


def unpack(data: bytes, starts: np.ndarray) -> np.ndarray:
    """The values of the blocks that begin at the given places in `data`."""
    heads = [_HEAD.unpack_from(data, s) for s in starts]
    out = np.zeros((len(heads), BLOCK), np.uint32)
    widths = np.array([h[2] for h in heads], np.int64)
    for width in np.unique(widths):
        chosen = np.flatnonzero(widths == width)
        size = 4 * int(width) * _LANES
        body = b"".join(data[starts[k] + _HEAD.size : starts[k] + _HEAD.size + size] for k in chosen)
        out[chosen] = _unpack_bits(np.frombuffer(body, "<u4").reshape(len(chosen), int(width), _LANES), int(width))
    for k, (start, (_, _, width, _, apart, _)) in enumerate(zip(starts, heads, strict=True)):
        if apart:
            at = int(start) + _HEAD.size + 4 * width * _LANES
            out[k][np.frombuffer(data, "<u2", apart, at)] = np.frombuffer(data, "<u4", apart, at + 2 * apart)
    out += np.array([h[0] for h in heads], np.uint32)[:, None]
    if len(heads) and all(h[1] == BLOCK for h in heads[:-1]):
        return out.reshape(-1)[: (len(heads) - 1) * BLOCK + heads[-1][1]]
    return np.concatenate([row[: h[1]] for row, h in zip(out, heads, strict=True)] or [np.zeros(0, np.uint32)])


def _unpack_bits(words: np.ndarray, width: int) -> np.ndarray:
    lanes = np.zeros((len(words), BLOCK // _LANES, _LANES), np.uint32)
    mask = np.uint32((1 << width) - 1)
    for i in range(BLOCK // _LANES if width else 0):
        word, shift = divmod(i * width, 32)
        value = words[:, word] >> np.uint32(shift)
        if shift + width > 32:
            value = value | (words[:, word + 1] << np.uint32(32 - shift))
        lanes[:, i] = value & mask
    return lanes.reshape(len(words), BLOCK)


# Files


class FileWriter:
    """Writes one file; holds at most some blocks of ids and 17 bytes for each document."""

    def __init__(self, folder: fs.FileSystem, path: str, percentile: float):
        self.file, self.path, self.percentile = folder.open_output_stream(path), path, percentile
        self.file.write(_MAGIC)
        self.at, self.starts, self.rest, self.total = len(_MAGIC), [], np.zeros(0, np.uint32), 0
        self.docs: list[np.ndarray] = []
        self.nulls: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []

    def add(self, docs: np.ndarray, nulls: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        self.docs.append(docs)
        self.nulls.append(nulls)
        self.counts.append(counts)
        self.total += len(ids)
        ids = np.concatenate([self.rest, ids])
        whole = len(ids) // BLOCK * BLOCK
        self._write(ids[:whole])
        self.rest = ids[whole:]

    def _write(self, ids: np.ndarray) -> None:
        blocks = pack(ids, self.percentile)
        for block in blocks:
            self.starts.append(self.at)
            self.at += len(block)
        self.file.write(b"".join(blocks))

    def close(self) -> dict:
        self._write(self.rest)
        docs, nulls = np.concatenate(self.docs), np.concatenate(self.nulls)
        table = docs.astype("<i8").tobytes() + nulls.astype(np.uint8).tobytes()
        table += np.concatenate(self.counts).astype("<u8").tobytes()
        index = np.array(self.starts, "<u8").tobytes()
        tail = _TAIL.pack(self.at, self.at + len(table), len(docs), len(self.starts), self.total, BLOCK)
        self.file.write(table + index + tail + _MAGIC)
        self.file.close()
        return {"name": self.name, "docs": len(docs), "ids": self.total}


    @property
    def name(self) -> str:
        return self.path.rpartition("/")[2]


class FileReader:
    """Reads documents of one file through its index."""

    def __init__(self, folder: fs.FileSystem, path: str):
        self.file = folder.open_input_file(path)
        end = self.file.size() - len(_MAGIC)
        tail = self.file.read_at(_TAIL.size + len(_MAGIC), end - _TAIL.size)
        if tail[_TAIL.size :] != _MAGIC:
            raise ValueError(f"{path} is not a whole token file")
        table, index, docs, blocks, self.total, _ = _TAIL.unpack_from(tail)
        self.blocks_end = table
        data = self.file.read_at(17 * docs, table)
        self.docs = np.frombuffer(data, "<i8", docs)
        self.nulls = np.frombuffer(data, np.uint8, docs, 8 * docs).astype(bool)
        self.counts = np.frombuffer(data, "<u8", docs, 9 * docs).astype(np.int64)
        self.starts = np.frombuffer(self.file.read_at(8 * blocks, index), "<u8").astype(np.int64)

    def ids(self, first: int, last: int) -> np.ndarray:
        """Ids first to last - 1 of the file."""
        if last <= first:
            return np.zeros(0, np.uint32)
        a, b = first // BLOCK, -(-last // BLOCK)
        begin = int(self.starts[a])
        end = int(self.starts[b]) if b < len(self.starts) else self.blocks_end
        values = unpack(self.file.read_at(end - begin, begin), self.starts[a:b] - begin)
        return values[first - a * BLOCK : last - a * BLOCK]


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a qualified path, and the path in it. Hadoop's other names of object stores are known too."""
    scheme, _, rest = path.partition(":")
    if scheme in ("s3a", "s3n"):
        path = f"s3:{rest}"
    return fs.FileSystem.from_uri(path) if "/" not in scheme and rest else (fs.LocalFileSystem(), path)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as Spark's readers and writers understand it: without one it is in the default file system."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    known = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return known.makeQualified(folder).toString()


# Data source


class _Written(WriterCommitMessage):
    def __init__(self, files: list[dict]):
        self.files = files


def _listed(folder: fs.FileSystem, path: str) -> bool:
    return folder.get_file_info(f"{path}/{_LIST}").type != fs.FileType.NotFound


def _drop(folder: fs.FileSystem, path: str, names: list[str]) -> None:
    for name in names:
        if folder.get_file_info(f"{path}/{name}").type != fs.FileType.NotFound:
            folder.delete_file(f"{path}/{name}")


class _Writer(DataSourceArrowWriter):
    def __init__(self, options):
        self.path, self.percentile = options["path"], float(options.get("percentile", "0.98"))
        self.file_ids = int(options.get("file_ids", str(FILE_IDS)))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        folder, path = _opened(self.path)
        folder.create_dir(path, recursive=True)
        files, writer = [], None
        try:
            for batch in iterator:
                writer = self._add(batch, folder, path, part, files, writer)
            if writer is not None:
                files.append(writer.close() | {"part": part, "at": len(files)})
        except BaseException:
            _drop(folder, path, [*(f["name"] for f in files), *([writer.name] if writer else [])])
            raise
        return _Written(files)

    def _add(self, batch: pa.RecordBatch, folder: fs.FileSystem, path: str, part: int, files: list[dict], writer):
        if batch.num_rows:
            doc_ids, ids = batch.column(0), batch.column(1)
            counts = np.diff(ids.offsets.to_numpy()).astype(np.int64)
            values = ids.flatten().to_numpy(zero_copy_only=False).astype(np.uint32)
            nulls = np.asarray(doc_ids.is_null())
            docs = doc_ids.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
            if writer is None:
                name = f"{path}/ids-{part:06d}-{len(files):06d}-{uuid.uuid4().hex}.pfor"
                writer = FileWriter(folder, name, self.percentile)
            writer.add(docs, nulls, counts, values)
            if writer.total >= self.file_ids:
                files.append(writer.close() | {"part": part, "at": len(files)})
                writer = None
        return writer

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        # One line for each file, whatever it holds.
        files = sorted((f for m in messages if m for f in m.files), key=lambda f: (f["part"], f["at"]))
        folder, path = _opened(self.path)
        folder.create_dir(path, recursive=True)
        if _listed(folder, path):
            self.abort(messages)
            raise FileExistsError(f"{self.path} holds token files already")
        with folder.open_output_stream(f"{path}/{_LIST}") as file:
            file.write("".join(json.dumps(f) + "\n" for f in files).encode())

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        """Files without a list are not read; those that tasks have finished are deleted, tasks that fail delete their own."""
        folder, path = _opened(self.path)
        _drop(folder, path, [f["name"] for m in messages if m for f in m.files])


class _File(InputPartition):
    def __init__(self, name: str, start: int):
        self.name, self.start = name, start


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]

    def partitions(self) -> list[InputPartition]:
        folder, path = _opened(self.path)
        with folder.open_input_stream(f"{path}/{_LIST}") as file:
            files = [json.loads(line) for line in file.read().decode().splitlines()]
        out, start = [], 0
        for entry in files:
            out.append(_File(entry["name"], start))
            start += entry["ids"]
        return out or [_File("", 0)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if not partition.name:
            return
        folder, path = _opened(self.path)
        reader = FileReader(folder, f"{path}/{partition.name}")
        before = np.concatenate([[0], np.cumsum(reader.counts)])
        first = 0
        while first < len(reader.docs):
            last = max(first + 1, int(np.searchsorted(before, before[first] + (_SLICE >> 2), side="right")) - 1)
            values = reader.ids(int(before[first]), int(before[last]))
            ends = (before[first : last + 1] - before[first]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(reader.docs[first:last], mask=reader.nulls[first:last]),
                    pa.array(partition.start + before[first:last]),
                    pa.array(reader.counts[first:last]),
                    pa.Array.from_buffers(
                        pa.binary(), last - first, [None, pa.py_buffer(4 * ends), pa.py_buffer(values.astype("<u4"))]
                    ),
                ],
                ["doc_id", "start", "n_tokens", "ids"],
            )
            first = last


class TokenFiles(DataSource):
    """Format `pforids`: reads (doc_id, start, n_tokens, ids as little-endian 32-bit), writes (doc_id, array of ids)."""

    @classmethod
    def name(cls) -> str:
        return "pforids"

    def schema(self) -> str:
        return "doc_id bigint, start bigint, n_tokens bigint, ids binary"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options)


# Encoding with the library


def write_ids(
    docs: DataFrame, path: str, tokenizer: str, end: int | None = 0, percentile: float = 0.98,
    id_col: str = "doc_id", text_col: str = "text",
) -> None:
    """Write the ids of all texts to token files at `path`, in ascending id order, null ids first.

    A null text counts as empty and gives only the end id. Rows with the same id stay apart, ordered by text. Only the two
    columns are read. Texts are shuffled once, by ranges of (id, text), so one id with many rows spreads over tasks as far as its texts differ.
    A path that holds token files already is an error: starts count from the first document of all files of a path.
    """
    spark = docs.sparkSession
    path = qualified(spark, path)
    if _listed(*_opened(path)):
        raise FileExistsError(f"{path} holds token files already")
    spark.dataSource.register(TokenFiles)
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )
    # The hash orders rows of one id by text without comparing long texts.
    tie = F.xxhash64("text")
    ranged = rows.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _SLICE):
            encoded = [library_ids(text, tokenizer, end) for text in texts_of(batch.column("text"))]
            ends = np.cumsum([0, *(len(e) // 4 for e in encoded)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(encoded), "<i4")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], ["doc_id", "ids"])

    encoded = ranged.mapInArrow(run, "doc_id bigint, ids array<int>")
    encoded.write.format("pforids").option("path", path).option("percentile", str(percentile)).mode("append").save()


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files at `path`: doc_id, `start` (ids of all documents before it), n_tokens and `ids`."""
    spark.dataSource.register(TokenFiles)
    return spark.read.format("pforids").option("path", qualified(spark, path)).load()


def digest(ids: DataFrame) -> DataFrame:
    """Check sums of what `read_ids` gives."""
    return ids.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
