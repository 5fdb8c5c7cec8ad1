"""Token-id output in bit planes.

Ids are written in ascending ``doc_id`` order as segments. A segment is one file image:

    header      magic ``BPS1``, version, plane kind, ids per chunk, ids, documents, chunks
    chunks      fixed-size id blocks, transposed into byte planes (4) or bit planes (32),
                each plane a zstandard frame of its own
    chunk index per chunk its number of ids, per plane its offset and size
    doc index   zstandard frame: doc_ids, null flags, tokens of each document
    trailer     offsets of both indexes, magic

Planes of high bits are nearly constant and shrink to a few bytes. The chunk index lets a
reader open any id range alone (``read_ids``). Segments are rows of a Parquet table in the
shared folder (``image`` binary, no further compression), so Spark's commit protocol decides
which attempt of a task counts and any executor can read any segment.
"""
from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored
from .tokens import token_path, worker_encoder

TOKENIZER, KIND, END_ID = "word_bpe_49k.json", "lower_words", 2
CHUNK_IDS = 65_536
SEGMENT_IDS = 1 << 20
#: Text encoded at a time: the larger, the more pieces of a block are ones it has already.
BLOCK_BYTES = 8 << 20
_MAGIC = b"BPS1"
_HEAD, _TAIL = "<4sHHIQII", "<QQ4s"
_PLANES = {"byte": 4, "bit": 32}

SEGMENTS = "part int, seq int, n_docs long, n_ids long, image binary"
DOCS = "part int, seq int, doc_id long, local_start long, n_tokens long, ids_crc32 long"


# --- the format ---------------------------------------------------------------------

def to_planes(ids: np.ndarray, planes: str) -> list[bytes]:
    """The planes of one block of unsigned 32-bit ids, lowest bits first."""
    octets = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if planes == "byte":
        return [octets[:, k].tobytes() for k in range(4)]
    bits = np.unpackbits(octets, axis=1, bitorder="little")
    return [np.packbits(bits[:, k], bitorder="little").tobytes() for k in range(32)]


def from_planes(frames: list[bytes], n: int, planes: str) -> np.ndarray:
    """Inverse of ``to_planes``."""
    if planes == "byte":
        octets = np.stack([np.frombuffer(f, np.uint8) for f in frames], axis=1)
    else:
        bits = np.stack([np.unpackbits(np.frombuffer(f, np.uint8), count=n, bitorder="little") for f in frames], axis=1)
        octets = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(octets).view("<u4").reshape(-1)


def write_segment(ids: np.ndarray, doc_ids: list[int | None], n_tokens: list[int],
                  planes: str = "byte", chunk_ids: int = CHUNK_IDS, level: int = 3) -> bytes:
    """The file image of one segment."""
    press = zstandard.ZstdCompressor(level=level).compress
    count = _PLANES[planes]
    n_chunks = -(-len(ids) // chunk_ids)
    out = bytearray(struct.pack(_HEAD, _MAGIC, 1, count, chunk_ids, len(ids), len(doc_ids), n_chunks))
    index = bytearray()
    for k in range(n_chunks):
        block = ids[k * chunk_ids:(k + 1) * chunk_ids]
        index += struct.pack("<I", len(block))
        for plane in to_planes(block, planes):
            frame = press(plane)
            index += struct.pack("<QI", len(out), len(frame))
            out += frame
    at_index = len(out)
    out += index
    at_docs = len(out)
    out += press(np.array([d or 0 for d in doc_ids], "<i8").tobytes()
                 + np.array([d is None for d in doc_ids], np.uint8).tobytes()
                 + np.array(n_tokens, "<i8").tobytes())
    return bytes(out + struct.pack(_TAIL, at_index, at_docs, _MAGIC))


def _open(image: bytes):
    magic, version, count, chunk_ids, n_ids, n_docs, n_chunks = struct.unpack_from(_HEAD, image)
    at_index, at_docs, tail = struct.unpack_from(_TAIL, image, len(image) - struct.calcsize(_TAIL))
    if magic != _MAGIC or tail != _MAGIC or version != 1:
        raise ValueError("not a bit-plane segment, or a truncated one")
    return count, chunk_ids, n_ids, n_docs, n_chunks, at_index, at_docs


def read_ids(image: bytes, start: int = 0, stop: int | None = None) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a segment; opens only the chunks that hold them."""
    count, chunk_ids, n_ids, _, n_chunks, at_index, _ = _open(image)
    stop = n_ids if stop is None else min(stop, n_ids)
    if start >= stop:
        return np.zeros(0, "<u4")
    planes = next(k for k, v in _PLANES.items() if v == count)
    step, expand = 4 + 12 * count, zstandard.ZstdDecompressor().decompress
    first, blocks = start // chunk_ids, []
    for k in range(first, -(-stop // chunk_ids)):
        at = at_index + k * step
        n = struct.unpack_from("<I", image, at)[0]
        places = struct.iter_unpack("<QI", image[at + 4:at + step])
        blocks.append(from_planes([expand(image[a:a + size]) for a, size in places], n, planes))
    return np.concatenate(blocks)[start - first * chunk_ids:stop - first * chunk_ids]


def read_docs(image: bytes) -> tuple[list[int | None], np.ndarray]:
    """doc_ids and tokens of each document of a segment, in order."""
    _, _, _, n, _, _, at_docs = _open(image)
    raw = zstandard.ZstdDecompressor().decompress(image[at_docs:len(image) - struct.calcsize(_TAIL)])
    doc_ids = np.frombuffer(raw, "<i8", n).tolist()
    null = np.frombuffer(raw, np.uint8, n, 8 * n)
    return [None if x else d for d, x in zip(doc_ids, null)], np.frombuffer(raw, "<i8", n, 9 * n)


# --- Spark --------------------------------------------------------------------------

def _write_part(path: str, kind: str, end_id: int, planes: str, chunk_ids: int, segment_ids: int):
    schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64()),
                        ("image", pa.binary())])

    def run(batches):
        encoder = worker_encoder(path, kind, BLOCK_BYTES)
        part, seq = TaskContext.get().partitionId(), 0
        held, doc_ids, n_tokens, n = [], [], [], 0

        def segment():
            image = write_segment(np.concatenate(held), doc_ids, n_tokens, planes, chunk_ids)
            return pa.RecordBatch.from_pylist([{"part": part, "seq": seq, "n_docs": len(doc_ids), "n_ids": n, "image": image}],
                                              schema=schema)

        for batch in batches:
            names = batch.column(0).to_pylist()
            for first, ids, ends in encoder.blocks(batch.column(1), end_id):
                begin = done = 0
                for k, end in enumerate(ends.tolist()):
                    doc_ids.append(names[first + k])
                    n_tokens.append(end - begin)
                    n, begin = n + end - begin, end
                    if n >= segment_ids:
                        held.append(ids[done:end])
                        yield segment()
                        held, doc_ids, n_tokens, n, seq, done = [], [], [], 0, seq + 1, end
                held.append(ids[done:])
        if doc_ids:
            yield segment()

    return run


def write_planes(spark: SparkSession, docs: DataFrame, tokenizer: str | None = None, kind: str = KIND,
                 end_id: int = END_ID, planes: str = "byte", chunk_ids: int = CHUNK_IDS,
                 segment_ids: int = SEGMENT_IDS) -> DataFrame:
    """Encode ``docs`` (``doc_id``, ``text``) and write the segments; returns their table.

    Order: ascending doc_id, null ids first; rows that share one by the first characters of
    their text, then by the input partition they come from, so that a doc_id of many rows,
    equal ones too, spans many ranges. Null and empty texts are the end id alone; strings of
    special tokens in a text are ordinary text; repeated rows are kept; an empty table gives
    no segment; other columns are not read. A segment closes with the document that takes it to ``segment_ids``, so a
    task holds one segment and one document at a time.
    """
    # the range keys are sampled to the driver: short prefixes, not texts
    order = ["doc_id", "head", "place"]
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                          F.substring(F.col("text").cast("string"), 1, 64).alias("head"), F.spark_partition_id().alias("place")) \
        .repartitionByRange(*order).sortWithinPartitions(*order, "text").select("doc_id", "text")
    images = ordered.mapInArrow(_write_part(tokenizer or token_path(TOKENIZER), kind, end_id, planes, chunk_ids, segment_ids),
                                SEGMENTS)
    return stored(spark, images, "token-planes", compression="uncompressed")


def _read_part(batches):
    schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("doc_id", pa.int64()), ("local_start", pa.int64()),
                        ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
    for batch in batches:
        for part, seq, image in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            image = image.as_py()
            ids = memoryview(read_ids(image).tobytes())
            doc_ids, n_tokens = read_docs(image)
            ends = np.cumsum(n_tokens)
            starts = ends - n_tokens
            crcs = [zlib.crc32(ids[4 * a:4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
            n = len(doc_ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * n, pa.int32()), pa.array([seq] * n, pa.int32()), pa.array(doc_ids, pa.int64()),
                 pa.array(starts, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array(crcs, pa.int64())], schema=schema)


def read_planes(segments: DataFrame) -> DataFrame:
    """Per document, read back from the segments: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it: running totals over the parts (one
    row per written file) and over the segments of a part.
    """
    sizes = segments.groupBy("part", "seq").agg(F.sum("n_ids").alias("n"))
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n"))
    part_base = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_base"))
    base = sizes.select("part", "seq", (F.sum("n").over(Window.partitionBy("part").orderBy("seq")) - F.col("n")).alias("base")) \
        .join(part_base, "part").select("part", "seq", (F.col("base") + F.col("part_base")).alias("base"))
    docs = segments.select("part", "seq", "image").mapInArrow(_read_part, DOCS)
    return docs.join(base, ["part", "seq"]).select("doc_id", (F.col("base") + F.col("local_start")).alias("start"),
                                                   "n_tokens", "ids_crc32")
