"""Token ids of a corpus in files of compressed bit or byte planes, with a chunk index.

Documents are dealt into shards of ascending keys. A shard is one stream of ids, cut into blocks of a fixed number of
ids; the last may be shorter. A block is transposed into planes (byte k, or bit k, of all its ids together), every plane
is compressed with zstandard on its own, and a plane of zeros takes no room. The chunk index has for every block its
shard, the number of its first id there, its ids and its bytes; the document index has the same for documents.

Block payload: ``TWPL``, then little-endian u8 version, u8 planes (4 bytes or 32 bits), u16 zero, u32 ids, one u32
length per plane (0: all zero), and the planes. Payloads and indexes are kept in Parquet as a container, so that any
store Spark reaches will do and a lost task leaves nothing half written. They lie in ``kind=block``, ``kind=chunk`` and
``kind=document`` of the folder.

A null or empty text is a document of the end id alone. Repeated keys are separate documents, in the order of a hash of
their texts; null keys come first. An empty table gives empty files. Only the columns named are read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillweave.llm.encoding import token_ids
from tillweave.llm.textwords import pieces

BLOCK_IDS = 1 << 16
_MAGIC = b"TWPL"


def encode_block(ids: np.ndarray, planes: str = "byte") -> bytes:
    data = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if planes == "bit":
        bits = np.unpackbits(data, axis=1, bitorder="little")
        rows = np.packbits(bits.T, axis=1, bitorder="little")
    else:
        rows = data.T
    compressor = zstandard.ZstdCompressor(level=3)
    parts = [compressor.compress(row.tobytes()) if row.any() else b"" for row in rows]
    head = struct.pack("<4sBBHI", _MAGIC, 1, len(parts), 0, len(data))
    return head + struct.pack(f"<{len(parts)}I", *map(len, parts)) + b"".join(parts)


def decode_block(payload: bytes) -> np.ndarray:
    magic, version, count, _, n = struct.unpack_from("<4sBBHI", payload)
    if magic != _MAGIC or version != 1 or count not in (4, 32):
        raise ValueError("not a block of planes")
    sizes = struct.unpack_from(f"<{count}I", payload, 12)
    width = n if count == 4 else -(-n // 8)
    rows = np.zeros((count, width), np.uint8)
    at = 12 + 4 * count
    decompressor = zstandard.ZstdDecompressor()
    for row, size in zip(rows, sizes, strict=True):
        if size:
            row[:] = np.frombuffer(decompressor.decompress(payload[at : at + size], max_output_size=width), np.uint8)
        at += size
    if count == 32:
        bits = np.unpackbits(rows, axis=1, count=n, bitorder="little")
        rows = np.packbits(bits.T, axis=1, bitorder="little").T
    return np.ascontiguousarray(rows.T).view("<u4").ravel()


def write_ids(
    docs: DataFrame,
    folder: str,
    vocabulary: str,
    *,
    key: str = "doc_id",
    text: str = "text",
    end_id: int = 1,
    block_ids: int = BLOCK_IDS,
    planes: str = "byte",
) -> None:
    """Write the ids of all rows, each followed by ``end_id``, in ascending order of the key."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    order = [F.col("key"), F.xxhash64("text")]  # a key of very many rows is spread by the second
    kind = rows.schema["key"].dataType.simpleString()
    schema = f"shard int, kind string, first long, n long, bytes long, key {kind}, payload binary"
    key_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]

    def rows_of(shard, name, first, n, size, keys, payloads) -> pa.RecordBatch:
        count = len(first)
        columns = [
            pa.array([shard] * count, pa.int32()),
            pa.array([name] * count, pa.string()),
            pa.array(first, pa.int64()),
            pa.array(n, pa.int64()),
            pa.array(size, pa.int64()) if size is not None else pa.nulls(count, pa.int64()),
            keys if keys is not None else pa.nulls(count, key_type),
            pa.array(payloads, pa.binary()) if payloads is not None else pa.nulls(count, pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["shard", "kind", "first", "n", "bytes", "key", "payload"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        held, waiting, first, done = [], 0, 0, 0

        def cut(ids: np.ndarray) -> Iterator[pa.RecordBatch]:
            payload = encode_block(ids, planes)
            yield rows_of(shard, "block", [done], [len(ids)], [len(payload)], None, [payload])
            yield rows_of(shard, "chunk", [done], [len(ids)], [len(payload)], None, None)

        for piece in pieces(batches, "text"):
            words, ids, begin = token_ids(vocabulary, piece.column(1))
            size = np.diff(begin) + 1
            starts = np.cumsum(size) - size
            stream = np.full(int(size.sum()), end_id, np.uint32)
            inside = np.ones(len(stream), bool)
            inside[starts + size - 1] = False
            stream[inside] = ids
            yield rows_of(shard, "document", first + starts, size, None, piece.column(0), None)
            first += len(stream)
            held.append(stream)
            waiting += len(stream)
            if waiting >= block_ids:
                stream = np.concatenate(held)
                whole = waiting - waiting % block_ids
                for at in range(0, whole, block_ids):
                    yield from cut(stream[at : at + block_ids])
                    done += block_ids
                held, waiting = [stream[whole:]], waiting - whole
        if waiting:
            yield from cut(np.concatenate(held))

    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt.mapInArrow(write, schema).write.partitionBy("kind").option("compression", "uncompressed").parquet(folder)


def read_ids(spark: SparkSession, folder: str, key_type: str, *, key: str = "doc_id", ids: bool = True) -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of every document, and its ids if wanted, from the files alone.

    ``start`` counts the ids of all documents before, ``ids_crc32`` is taken over little-endian unsigned 32-bit ids. A
    shard's blocks and documents stream past in order; a task holds the ids of one document and one block.
    """
    schema = f"shard int, first long, n long, bytes long, key {key_type}, payload binary, kind string"
    read = lambda kind: spark.read.schema(schema).parquet(folder).where(F.col("kind") == kind)
    documents = read("document").select("shard", "first", "n", "key")
    totals = documents.groupBy("shard").agg(F.sum("n").alias("total"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("shard", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))
    documents = documents.join(bases, "shard")
    # A document follows the block that holds its last id.
    events = (
        read("block")
        .select("shard", "first", "n", F.lit(None).cast(key_type).alias("key"), "payload", F.lit(0).alias("base"))
        .withColumn("at", F.col("first"))
        .unionByName(
            documents.withColumn("payload", F.lit(None).cast("binary")).withColumn("at", F.expr("first + n - 1"))
        )
        .withColumn("is_doc", F.col("payload").isNull())
    )
    events = events.repartition("shard").sortWithinPartitions("shard", "at", "is_doc")
    events = events.select("shard", "first", "n", "key", "payload", "base", "is_doc")

    def documents_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, begin, stream = None, 0, np.empty(0, "<u4")
        for batch in batches:
            taken, start, n, crc, held = [], [], [], [], []
            shards, firsts, sizes, bases = (batch.column(i).to_pylist() for i in (0, 1, 2, 5))
            for i, (shard, first, size, base) in enumerate(zip(shards, firsts, sizes, bases, strict=True)):
                if shard != current:
                    current, begin, stream = shard, 0, np.empty(0, "<u4")
                payload = batch.column(4)[i].as_py()
                if payload is not None:
                    stream = np.concatenate([stream, decode_block(payload)])
                    continue
                own = stream[first - begin : first - begin + size]
                if len(own) != size:
                    raise ValueError(f"shard {shard} ends before a document does")
                stream, begin = stream[first - begin + size :], first + size
                body = own.tobytes()
                taken.append(i)
                start.append(base + first)
                n.append(size)
                crc.append(zlib.crc32(body))
                held.append(body if ids else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(3).take(pa.array(taken, pa.int64())),
                    *(pa.array(x, pa.int64()) for x in (start, n, crc)),
                    pa.array(held, pa.binary()),
                ],
                ["key", "start", "n_tokens", "ids_crc32", "ids"],
            )

    out = events.mapInArrow(documents_of, f"key {key_type}, start long, n_tokens long, ids_crc32 long, ids binary")
    out = out.withColumnRenamed("key", key)
    return out if ids else out.drop("ids")
