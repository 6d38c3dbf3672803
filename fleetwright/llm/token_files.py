"""Token ids in binary files, coded by an adaptive range coder.

A file is a run of segments; a segment holds whole documents in ascending id order:

    header     magic "FTI2", then little-endian: documents (u32), blocks (u32),
               ids per block (u32), groups of four bits per id (u32), distinct ids (u32,
               0 if too many to be told), ids (u64), bytes of the directory (u32), crc32
               of all this and the directory (u32)
    directory  zlib: per document its id (i64), whether it has one (u8) and its number
               of ids (u64); per block its payload's bytes (u32), the crc32 of its
               payload (u32) and of its ids (u32); per distinct id itself (u32) and its
               share of the segment's (u32), column by column
    payloads   one after the other

Blocks have the stated number of ids, the last one what is left; each is coded from a
fresh start and the directory's shares, so any of them can be checked and read alone
(`read_blocks`).

Writing sorts the documents by range partitions: a task writes one file in one pass.
Its name follows from the partition and it appears under that name when whole, so a
task that runs again replaces its own work. Files go through the file system of their
folder's address, which every executor must reach.

Defined cases: a NULL or empty text is its end id alone; documents without id come
first; documents with one id come in the order of their texts. Other columns are not
read. An empty table gives no segments and an empty result. A document of any length
is one document of one segment.
"""

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from fleetwright.llm import range_coder
from fleetwright.llm.common import materialise, sized
from fleetwright.llm.tokens import column_encoder, vocabulary_path
from fleetwright.session import scratch_path

VOCABULARY, END_ID = "word_bpe_49k.json", 1
# A segment ends with the document that reaches this many ids; its blocks are as many
# as there are lanes, if they then have a length between these.
SEGMENT_IDS = 1 << 22
SHORTEST_BLOCK, LONGEST_BLOCK = 256, 1_024

# Texts encoded at a time.
TEXT_BYTES, TEXT_ROWS = 16 << 20, 1 << 14

_MAGIC = b"FTI2"
_HEADER, _CRC = struct.Struct("<4sIIIIIQI"), struct.Struct("<I")


# ---- segments ---------------------------------------------------------------

@dataclass
class Segment:
    """A segment's documents and blocks, and where its payloads begin."""

    ids: list
    sizes: np.ndarray
    block_sizes: np.ndarray
    groups: int
    shares: tuple
    bytes: np.ndarray
    payload_crcs: np.ndarray
    id_crcs: np.ndarray
    payloads: int


def write_segment(keys: list, sizes: np.ndarray, ids: np.ndarray) -> bytes:
    """A segment of documents `keys` with `sizes` ids each."""
    block = int(np.clip(-(-len(ids) // range_coder.LANES), SHORTEST_BLOCK, LONGEST_BLOCK))
    block_sizes = np.minimum(len(ids) - np.arange(0, len(ids), block), block)
    groups = max(1, -(-int(ids.max()).bit_length() // 4))
    shares = range_coder.shares(ids)
    payloads = range_coder.encode(ids, block_sizes, groups, shares)
    plain = np.ascontiguousarray(ids, "<u4")
    crcs = [zlib.crc32(plain[k:k + block]) for k in range(0, len(plain), block)]
    directory = zlib.compress(b"".join([
        np.array([k or 0 for k in keys], "<i8").tobytes(), np.array([k is not None for k in keys], "u1").tobytes(),
        np.asarray(sizes).astype("<u8").tobytes(), np.array([len(p) for p in payloads], "<u4").tobytes(),
        np.array([zlib.crc32(p) for p in payloads], "<u4").tobytes(), np.array(crcs, "<u4").tobytes(),
        *(column.astype("<u4").tobytes() for column in shares)]))
    header = _HEADER.pack(_MAGIC, len(keys), len(payloads), block, groups, len(shares[0]), len(ids), len(directory))
    return b"".join([header, _CRC.pack(zlib.crc32(header + directory)), directory, *payloads])


def read_directory(data) -> Segment:
    magic, documents, blocks, block, groups, distinct, total, length = _HEADER.unpack_from(data)
    begin = _HEADER.size + _CRC.size
    packed = data[begin:begin + length]
    if magic != _MAGIC or (zlib.crc32(data[:_HEADER.size] + packed),) != _CRC.unpack_from(data, _HEADER.size):
        raise ValueError("not a segment of token ids, or a damaged directory")
    columns, place = zlib.decompress(packed), 0

    def column(kind: str, rows: int) -> np.ndarray:
        nonlocal place
        values = np.frombuffer(columns, kind, rows, place)
        place += values.nbytes
        return values

    ids, has_id, sizes = column("<i8", documents), column("u1", documents), column("<u8", documents)
    of_blocks = [column("<u4", blocks) for _ in range(3)]
    return Segment(
        [i if h else None for i, h in zip(ids.tolist(), has_id.tolist())], sizes.astype(np.int64),
        np.minimum(total - np.arange(0, total, block, dtype=np.int64), block), groups,
        (column("<u4", distinct), column("<u4", distinct)), *of_blocks, begin + length)


def read_blocks(data, segment: Segment, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids of blocks `first` to `last` (excluded), checked."""
    last = len(segment.bytes) if last is None else last
    ends = segment.payloads + np.cumsum(segment.bytes, dtype=np.int64)
    payloads = [bytes(data[end - size:end]) for end, size in zip(ends[first:last].tolist(), segment.bytes[first:last].tolist())]
    if any(zlib.crc32(p) != crc for p, crc in zip(payloads, segment.payload_crcs[first:last].tolist())):
        raise ValueError("a block of token ids is damaged")
    sizes = segment.block_sizes[first:last]
    ids = range_coder.decode(payloads, sizes, segment.groups, segment.shares)
    starts = np.cumsum(sizes) - sizes
    for start, size, crc in zip(starts.tolist(), sizes.tolist(), segment.id_crcs[first:last].tolist()):
        if zlib.crc32(ids[start:start + size].astype("<u4")) != crc:
            raise ValueError("a block of token ids does not decode to what was written")
    return ids


# ---- files ------------------------------------------------------------------

def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of an address; `file:/x` and `file:///x` are the local path /x."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def write_files(docs: DataFrame, folder: str, vocabulary: str = VOCABULARY, end_id: int = END_ID,
                text: str = "text", key: str = "doc_id") -> DataFrame:
    """Write all documents' ids below `folder`; returns the written segments as
    (part, path, offset, bytes, documents, ids), in the order part, offset."""
    path = vocabulary_path(vocabulary)

    def written(batches: Iterator[pa.RecordBatch]):
        encode = column_encoder(path).encode
        part = TaskContext.get().partitionId()
        system, root = _file_system(folder)
        system.create_dir(root, recursive=True)
        name = f"{root}/part-{part:06d}.ids"
        temporary = f"{name}.{uuid.uuid4().hex}"
        segments, keys, sizes, held, total, place = [], [], [], [], 0, 0
        with system.open_output_stream(temporary) as out:
            def flush():
                nonlocal keys, sizes, held, total, place
                data = write_segment(keys, np.concatenate(sizes), np.concatenate(held))
                out.write(data)
                segments.append((place, len(data), len(keys), total))
                place += len(data)
                keys, sizes, held, total = [], [], [], 0

            for batch in sized(batches, "_text", TEXT_BYTES, TEXT_ROWS):
                ids, counts = encode(batch.column("_text"), end_id)
                ends, first = np.cumsum(counts), 0
                while first < batch.num_rows:
                    before = int(ends[first - 1]) if first else 0
                    last = min(int(np.searchsorted(ends, before + SEGMENT_IDS - total)) + 1, batch.num_rows)
                    keys += batch.column("_key")[first:last].to_pylist()
                    sizes.append(counts[first:last])
                    held.append(ids[before:ends[last - 1]])
                    total += int(ends[last - 1]) - before
                    if total >= SEGMENT_IDS:
                        flush()
                    first = last
            if keys:
                flush()
        if not segments:
            system.delete_file(temporary)
            return
        system.move(temporary, name)
        columns = list(zip(*segments))
        yield pa.RecordBatch.from_arrays(
            [pa.array([part] * len(segments), pa.int32()), pa.array([f"{folder}/part-{part:06d}.ids"] * len(segments)),
             *(pa.array(c, pa.int64()) for c in columns)], ["part", "path", "offset", "bytes", "documents", "ids"])

    rows = docs.select(F.col(key).cast("bigint").alias("_key"), F.col(text).alias("_text"))
    in_order = rows.repartitionByRange("_key").sortWithinPartitions("_key", "_text")
    # Run once and written down: the files are made here and not again.
    return materialise(in_order.mapInArrow(
        written, "part int, path string, offset bigint, bytes bigint, documents bigint, ids bigint"), "segments")


def read_files(segments: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files.

    A task reads and decodes one segment at a time. Only the segments' own rows, one
    for millions of ids, are put in one order.
    """
    before = Window.orderBy("part", "offset").rowsBetween(Window.unboundedPreceding, -1)
    placed = segments.withColumn("first", F.coalesce(F.sum("ids").over(before), F.lit(0)))

    def read(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for row in batch.to_pylist():
                system, path = _file_system(row["path"])
                with system.open_input_file(path) as file:
                    data = file.read_at(row["bytes"], row["offset"])
                segment = read_directory(data)
                ids = np.ascontiguousarray(read_blocks(data, segment), "<u4")
                ends = np.cumsum(segment.sizes)
                starts = ends - segment.sizes
                crcs = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(segment.ids, pa.int64()), pa.array(starts + row["first"], pa.int64()),
                     pa.array(segment.sizes, pa.int64()), pa.array(crcs, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"])

    # One segment per task where there are as many tasks: by its number, not by a hash.
    count = max(segments.count(), 1)
    numbered = placed.withColumn("n", F.row_number().over(Window.orderBy("part", "offset")))
    spread = numbered.repartitionByRange(count, "n") if count > 1 else numbered
    return spread.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def round_trip(docs: DataFrame, **options) -> DataFrame:
    """Write `docs` to new files of the shared folder, and read them back."""
    folder = scratch_path(docs.sparkSession, "token_ids")
    return read_files(write_files(docs, folder, **options))
