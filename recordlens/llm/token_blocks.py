"""Token ids in binary files of patched frame-of-reference blocks.

File layout, all numbers little-endian:

| part | content |
| --- | --- |
| header | magic ``PFORTOK1``, u32 ids in a block, u32 blocks, u64 ids, u64 documents |
| documents | for each document: i64 id, u64 ids (a null id is the least i64) |
| index | for each block: u64 start of the block behind the index |
| blocks | u32 least id, u8 width, u8 0, u16 exceptions, packed ids, u16 exception places, u32 exception values |

A block holds ``BLOCK`` ids (the last one fewer). The block's least id is taken off, what is left is packed at the
narrowest width that fits the asked share of the ids (a percentile), and the others are exceptions: their low
bits are packed, their whole values follow in a list. A reader finds any block through the index.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlens.llm.common import parts, running
from recordlens.llm.vocabularies import encoder
from recordlens.sources.scratch import materialize, scratch_path

BLOCK = 512
PERCENTILE = 90.0
#: Ids in one file at most, but for a document that alone has more.
FILE_IDS = 4_000_000
#: Blocks that are packed at a time; each id is taken apart to 32 bytes.
PACKED = 256
_MAGIC = b"PFORTOK1"
_HEADER = struct.Struct("<8sIIQQ")
_BLOCK_HEAD = np.dtype([("least", "<u4"), ("width", "u1"), ("zero", "u1"), ("exceptions", "<u2")])
_NULL = -(1 << 63)
_FIELDS = "doc_id long, n_tokens long, ids binary"


def encode_ids(ids: np.ndarray, percentile: float = PERCENTILE) -> tuple[list[bytes], np.ndarray]:
    """The blocks of an array of ids and the start of each block among them."""
    out, starts, place = [], [], 0
    full = len(ids) // BLOCK * BLOCK
    whole = ids[:full].reshape(-1, BLOCK)
    matrices = [whole[at : at + PACKED] for at in range(0, len(whole), PACKED)]
    if len(ids) > full:
        matrices.append(ids[full:].reshape(1, -1))
    for matrix in matrices:
        least = matrix.min(1)
        rest = matrix - least[:, None]
        kth = max(0, int(np.ceil(matrix.shape[1] * percentile / 100)) - 1)
        fits = np.partition(rest, kth, axis=1)[:, kth]
        widths = np.where(fits > 0, np.floor(np.log2(np.maximum(fits, 1))).astype(np.int64) + 1, 0)
        packed: list[bytes | None] = [None] * len(matrix)
        for width in np.unique(widths).tolist():
            rows = np.flatnonzero(widths == width)
            if width == 0:
                body = np.empty((len(rows), 0), np.uint8)
            elif width == 16:
                body = (rest[rows] & 0xFFFF).astype("<u2").view(np.uint8)
            else:
                bits = np.unpackbits(rest[rows].astype("<u4").view(np.uint8).reshape(len(rows), -1, 4), axis=2, bitorder="little")
                body = np.packbits(bits[:, :, :width].reshape(len(rows), -1), axis=1, bitorder="little")
            over = rest[rows] >> np.uint32(width) != 0 if width < 32 else np.zeros((len(rows), matrix.shape[1]), bool)
            counts = over.sum(1)
            heads = np.zeros(len(rows), _BLOCK_HEAD)
            heads["least"], heads["width"], heads["exceptions"] = least[rows], width, counts
            at, places = np.nonzero(over)
            places, values = places.astype("<u2"), rest[rows[at], places].astype("<u4")
            ends = np.cumsum(counts)
            for i, row in enumerate(rows.tolist()):
                a, b = int(ends[i] - counts[i]), int(ends[i])
                packed[row] = heads[i].tobytes() + body[i].tobytes() + places[a:b].tobytes() + values[a:b].tobytes()
        for block in packed:
            starts.append(place)
            place += len(block)
            out.append(block)
    return out, np.array(starts, "<u8")


def decode_block(block: bytes | memoryview, n: int) -> np.ndarray:
    """The ``n`` ids of one block."""
    head = np.frombuffer(block, _BLOCK_HEAD, 1)[0]
    width, exceptions, at = int(head["width"]), int(head["exceptions"]), _BLOCK_HEAD.itemsize
    size = (n * width + 7) // 8
    raw = np.frombuffer(block, np.uint8, size, at)
    if width == 0:
        rest = np.zeros(n, np.uint32)
    elif width == 16:
        rest = raw.view("<u2").astype(np.uint32)
    else:
        bits = np.zeros((n, 32), np.uint8)
        bits[:, :width] = np.unpackbits(raw, bitorder="little")[: n * width].reshape(n, width)
        rest = np.packbits(bits, axis=1, bitorder="little").view("<u4").reshape(n).astype(np.uint32)
    if exceptions:
        at += size
        places = np.frombuffer(block, "<u2", exceptions, at)
        rest[places] = np.frombuffer(block, "<u4", exceptions, at + 2 * exceptions)
    return rest + np.uint32(head["least"])


def encode_file(doc_ids: list[int | None], ids: list[bytes], percentile: float = PERCENTILE) -> bytes:
    """The bytes of one file that holds the given documents in the given order."""
    sizes = [len(x) // 4 for x in ids]
    blocks, starts = encode_ids(np.frombuffer(b"".join(ids), "<u4"), percentile)
    table = np.array([(_NULL if d is None else d, n) for d, n in zip(doc_ids, sizes, strict=True)], "<i8")
    head = _HEADER.pack(_MAGIC, BLOCK, len(blocks), sum(sizes), len(sizes))
    return b"".join([head, table.tobytes(), starts.tobytes(), *blocks])


class TokenFile:
    """A file's documents and ids."""

    def __init__(self, content: bytes) -> None:
        magic, self.block, self.n_blocks, self.n_ids, n = _HEADER.unpack_from(content)
        if magic != _MAGIC:
            raise ValueError("not a file of token blocks")
        table = np.frombuffer(content, "<i8", 2 * n, _HEADER.size).reshape(n, 2)
        self.doc_ids = [None if d == _NULL else d for d in table[:, 0].tolist()]
        self.ends = np.cumsum(table[:, 1])
        self.starts = self.ends - table[:, 1]
        at = _HEADER.size + 16 * n
        self.index = np.frombuffer(content, "<u8", self.n_blocks, at)
        self.body = memoryview(content)[at + 8 * self.n_blocks :]

    def ids(self, first: int, last: int) -> np.ndarray:
        """The ids at the places from ``first`` up to ``last`` of the file; reads only the blocks that hold them."""
        if last <= first:
            return np.empty(0, np.uint32)
        a, b = first // self.block, -(-last // self.block)
        found = [
            decode_block(self.body[int(self.index[i]) :], min(self.block, self.n_ids - i * self.block))
            for i in range(a, b)
        ]
        return np.concatenate(found)[first - a * self.block : last - a * self.block]


def token_ids(docs: DataFrame, vocabulary: str, end: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids``: ids of every whole text and the end id, as unsigned 16- or 32-bit integers.

    16 bits are used where all ids of a document fit; two bytes an id less to shuffle.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            for at in range(0, len(batch), 500):
                keys, texts = batch.column(0).slice(at, 500), batch.column(1).slice(at, 500)
                ids, offsets = encode(texts)
                ids = np.insert(ids, offsets[1:], end)
                offsets = offsets + np.arange(len(offsets))
                sizes = np.diff(offsets)
                short = np.maximum.reduceat(ids, offsets[:-1]) < 1 << 16
                out = [
                    (ids[a:b].astype("<u2") if s else ids[a:b]).tobytes()
                    for a, b, s in zip(offsets[:-1].tolist(), offsets[1:].tolist(), short.tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays([keys, pa.array(sizes, pa.int64()), pa.array(out, pa.binary())], names=["doc_id", "n_tokens", "ids"])

    return docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(run, _FIELDS)


def _wide(ids: bytes, n: int) -> bytes:
    return ids if len(ids) == 4 * n else np.frombuffer(ids, "<u2").astype("<u4").tobytes()


def write_tokens(tokens: DataFrame, borders: list[int], folder: str, percentile: float = PERCENTILE) -> DataFrame:
    """Write documents of ids (see ``token_ids``) to files under ``folder`` in ascending order of their ids, nulls first.

    Returns one row for each file: ``file, part, place, n_docs, n_ids, start`` with ``start`` the ids of all files
    before. Runs jobs. ``borders`` (see ``id_borders``) cut the ids into ranges, each sorted and written by one task in files of
    ``FILE_IDS`` ids; an id that fills several ranges has its rows dealt over them. So the ids are made once and shuffled
    once, without a pass to sample them. A file is written under a name of its attempt and then renamed, so a
    repeated task leaves the same files. ``folder`` is a URI of a store that pyarrow knows and all executors reach.
    Rows with equal ids are all kept, in any order among them.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder.removeprefix('file:')}")
        store.create_dir(root, recursive=True)
        part, place, keys, ids, total = -1, 0, [], [], 0

        def save() -> pa.RecordBatch:
            name = f"{root}/tokens-{part:06d}-{place:06d}.pfor"
            attempt = f"{root}/.{uuid.uuid4().hex}"
            with store.open_output_stream(attempt) as out:
                out.write(encode_file(keys, ids, percentile))
            store.move(attempt, name)
            row = {"file": [name.rpartition("/")[2]], "part": [part], "place": [place], "n_docs": [len(keys)], "n_ids": [total]}
            return pa.RecordBatch.from_pydict(row, schema=pa.schema([("file", pa.string()), ("part", pa.int64()), ("place", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

        for some in (some for batch in batches for some in parts(batch)):
            for key, n, raw, own in zip(*(some.column(i).to_pylist() for i in range(4)), strict=True):
                if keys and (own != part or total + n > FILE_IDS):
                    yield save()
                    place, keys, ids, total = place + 1, [], [], 0
                if own != part:
                    part, place = own, 0
                keys.append(key)
                ids.append(_wide(raw, n))
                total += n
        if keys:
            yield save()

    low, high = _range(F.col("doc_id"), borders, False), _range(F.col("doc_id"), borders, True)
    dealt = tokens.withColumn("part", low + F.pmod(F.xxhash64("ids"), high - low + 1))
    ordered = dealt.repartition(len(borders) + 1, "part").sortWithinPartitions("part", F.col("doc_id").asc_nulls_first())
    files = materialize(
        ordered.mapInArrow(run, "file string, part long, place long, n_docs long, n_ids long"), "token-files"
    )
    # Summed over all tasks and written, so that a join knows its size however many files there are.
    started = running(files, [F.col("part"), F.col("place")], "n_ids", "start")
    return materialize(started.select("file", "part", "place", "n_docs", "n_ids", "start"), "token-starts")


def id_borders(docs: DataFrame, doc_id: str = "doc_id") -> list[int]:
    """Ids that cut the rows into ranges of about equal number, one for each shuffle partition. Runs a job over the ids."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.coalesce(F.col(doc_id).cast("long"), F.lit(_NULL))
    found = docs.agg(F.percentile_approx(key, [i / n for i in range(1, n)] or [0.5], 100 * n)).first()[0]
    return sorted(found or [])


def _range(doc_id: Column, borders: list[int], last: bool) -> Column:
    """How many borders are below an id, or not above it."""
    key, n = F.coalesce(doc_id, F.lit(_NULL)), len(borders)

    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo).cast("long")
        mid = (lo + hi) // 2
        border = F.lit(borders[mid]).cast("long")
        return F.when(border <= key if last else border < key, search(mid + 1, hi)).otherwise(search(lo, mid))

    return search(0, n)


def read_tokens(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids, ids_crc32`` of every document of the files.

    ``files`` has one row for each file (of some million ids); Spark broadcasts it while its measured size allows that.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                file = TokenFile(content)
                for at in range(0, len(file.doc_ids), 500):
                    n = min(500, len(file.doc_ids) - at)
                    a, ends = file.starts[at : at + n], file.ends[at : at + n]
                    part = file.ids(int(a[0]), int(ends[-1])).astype("<u4")
                    each = [part[i:j] for i, j in zip((a - a[0]).tolist(), (ends - a[0]).tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(file.doc_ids[at : at + n], pa.int64()),
                            pa.array(a + start, pa.int64()),
                            pa.array(ends - a, pa.int64()),
                            pa.array([x.tobytes() for x in each], pa.binary()),
                            pa.array([zlib.crc32(x) for x in each], pa.int64()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids", "ids_crc32"],
                    )

    content = spark.read.format("binaryFile").option("pathGlobFilter", "*.pfor").load(folder)
    named = content.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    placed = named.join(files.select("file", "start"), "file").select("start", "content")
    return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary, ids_crc32 long")


def token_files(spark: SparkSession, docs: DataFrame, vocabulary: str, end: int) -> DataFrame:
    """Encode, write and read back: ``doc_id, start, n_tokens, ids, ids_crc32``. Runs jobs.

    Null and empty texts have the end id only. Repeated ids and rows are kept. An empty table gives no rows.
    Only ``doc_id`` and ``text`` are read, so other columns don't matter.
    """
    folder = scratch_path(spark, "pfor")
    files = write_tokens(token_ids(docs, vocabulary, end), id_borders(docs), folder)
    if files.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids binary, ids_crc32 long")
    return read_tokens(spark, folder, files)
