"""Token-id output as directly addressable codes.

An id is cut into 8-bit chunks, least first. Level k holds the k-th chunk of every id that has one, a bitmap that says
which of them go on at level k + 1, and a rank directory (set bits before every 512th), so that one token is read by one
lookup a level without decoding a block. A token file is a Parquet table of segments: each row has the documents of
one stretch of ascending doc_id, their lengths, and the encoded ids.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import dealt_by_id, lean, materialize, partitions, small_batches
from tidemark.llm.tokens import encoder

MAGIC = b"DAC1"
RANK_BYTES = 64
SEGMENT_TOKENS = 1 << 18
SEGMENT_DOCS = 4096

FILE_SCHEMA = "part long, segment long, doc_ids array<bigint>, lengths array<bigint>, n_tokens long, codes binary"


class Dac:
    """Directly addressable codes over unsigned 32-bit integers."""

    def __init__(self, n: int, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.n, self.levels = n, levels

    def __len__(self) -> int:
        return self.n

    @classmethod
    def encode(cls, ids: np.ndarray) -> Dac:
        rest, levels = np.ascontiguousarray(ids, dtype="<u4"), []
        while True:
            chunks = rest.astype(np.uint8)
            more = rest > 255
            bits = np.packbits(more, bitorder="little")
            counts = np.add.reduceat(np.bitwise_count(bits).astype(np.uint32), np.arange(0, len(bits), RANK_BYTES)) if len(bits) else np.zeros(0, np.uint32)
            ranks = np.concatenate([np.zeros(1, np.uint32), np.cumsum(counts, dtype=np.uint32)[:-1]]) if len(counts) else np.zeros(0, np.uint32)
            levels.append((chunks, bits, ranks.astype("<u4")))
            if not more.any():
                return cls(len(ids), levels)
            rest = rest[more] >> np.uint32(8)

    def to_bytes(self) -> bytes:
        parts = [MAGIC, struct.pack("<QB", self.n, len(self.levels))]
        for chunks, bits, ranks in self.levels:
            parts += [struct.pack("<Q", len(chunks)), chunks.tobytes(), bits.tobytes(), ranks.tobytes()]
        return b"".join(parts)

    @classmethod
    def from_bytes(cls, data: bytes) -> Dac:
        if data[:4] != MAGIC:
            raise ValueError("not a token block")
        n, count = struct.unpack_from("<QB", data, 4)
        at, levels = 13, []
        for _ in range(count):
            (m,) = struct.unpack_from("<Q", data, at)
            at += 8
            wide, blocks = (m + 7) // 8, -(-((m + 7) // 8) // RANK_BYTES)
            chunks = np.frombuffer(data, np.uint8, m, at)
            bits = np.frombuffer(data, np.uint8, wide, at + m)
            ranks = np.frombuffer(data, "<u4", blocks, at + m + wide)
            levels.append((chunks, bits, ranks))
            at += m + wide + 4 * blocks
        return cls(n, levels)

    def __getitem__(self, i: int) -> int:
        """The i-th id: one chunk, one bit and one rank a level."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value, shift = 0, 0
        for chunks, bits, ranks in self.levels:
            value |= int(chunks[i]) << shift
            byte, bit = divmod(i, 8)
            if not bits[byte] >> bit & 1:
                return value
            block = byte // RANK_BYTES
            before = int(ranks[block]) + int(np.bitwise_count(bits[block * RANK_BYTES : byte]).sum(dtype=np.int64))
            i, shift = before + int(bits[byte] & ((1 << bit) - 1)).bit_count(), shift + 8
        return value

    def decode(self) -> np.ndarray:
        """All ids at once, for whole reads."""
        values = np.zeros(0, np.uint32)
        for chunks, bits, _ in reversed(self.levels):
            here, more = chunks.astype(np.uint32), np.unpackbits(bits, bitorder="little", count=len(chunks)).view(bool)
            if len(values):
                here[more] |= values << np.uint32(8)
            values = here
        return values


def write_token_file(docs: DataFrame, path: str, end_id: int = 2, rows_per_range: int = 1024) -> tuple[DataFrame, str]:
    """Encode every whole text (null: empty), append end_id, and write a token file in ascending doc_id order.

    Null doc_ids come first; documents of one id are ordered by a hash of their text, and repeated rows are each written, so an id
    with very many documents is spread over ranges. Very long texts are encoded whole; an empty table gives an empty
    file; further columns of any name are left out. Returns the table as read back and its place, which goes when the application ends.
    """
    dealt, ranges = dealt_by_id(docs, rows_per_range)
    ordered = dealt.select("doc_id", "text", F.col("at").alias("part"), "o", "h").repartition(max(partitions(docs.sparkSession), min(ranges, 64), -(-ranges // 64)), "part").sortWithinPartitions("part", "o", "h", "text").select("doc_id", "text", "part")
    end = struct.pack("<I", end_id)

    def run(batches):
        encode = encoder(path)
        part, segment, ids, lengths, held, size = None, 0, [], [], [], 0

        def block():
            tokens = np.frombuffer(b"".join(held), "<u4")
            row = {"part": [part], "segment": [segment], "doc_ids": [list(ids)], "lengths": [list(lengths)], "n_tokens": [len(tokens)], "codes": [Dac.encode(tokens).to_bytes()]}
            return pa.RecordBatch.from_pydict(row, schema=arrow)

        arrow = pa.schema([("part", pa.int64()), ("segment", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("n_tokens", pa.int64()), ("codes", pa.binary())])
        for b in batches:
            for at in range(0, b.num_rows, 256):
                piece = b.slice(at, 256)
                keys, names = piece.column(0).to_pylist(), piece.column(2).to_pylist()
                for key, name, data in zip(keys, names, encode(piece.column(1).to_pylist()), strict=True):
                    if held and (name != part or size >= SEGMENT_TOKENS or len(ids) >= SEGMENT_DOCS):
                        yield block()
                        segment = segment + 1 if name == part else 0
                        ids, lengths, held, size = [], [], [], 0
                    part = name
                    held.append(data + end)
                    ids.append(key)
                    lengths.append(len(data) // 4 + 1)
                    size += lengths[-1]
        if held:
            yield block()

    small_batches(docs.sparkSession)
    return materialize(ordered.mapInArrow(lean(run), FILE_SCHEMA), "tokens")


def read_token_file(file: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, all from the decoded blocks of the file.

    A document is a row for each time it was written, null ids included; a file without blocks gives no rows.
    """
    inside = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each of the bounded ranges
    sizes = file.select("part", "segment", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n")).select("part", F.coalesce(F.sum("n").over(across), F.lit(0)).alias("part_start"))
    starts = sizes.withColumn("segment_start", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).drop("n_tokens").join(parts, "part")

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                row = {k: b.column(j)[i] for j, k in enumerate(b.schema.names)}
                ids = Dac.from_bytes(memoryview(row["codes"].as_buffer())).decode()
                lengths = row["lengths"].values.to_numpy(zero_copy_only=False)
                ends = np.cumsum(lengths)
                data = memoryview(np.ascontiguousarray(ids, dtype="<u4")).cast("B")
                crcs = [zlib.crc32(data[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(row["part"], len(ends)), pa.repeat(row["segment"], len(ends)), row["doc_ids"].values, pa.array(ends - lengths), pa.array(lengths), pa.array(crcs, pa.int64())],
                    names=["part", "segment", "doc_id", "at", "n_tokens", "ids_crc32"],
                )

    read = file.select("part", "segment", "doc_ids", "lengths", "codes").mapInArrow(lean(run), "part long, segment long, doc_id long, at long, n_tokens long, ids_crc32 long")
    return read.join(starts, ["part", "segment"]).select("doc_id", (F.col("part_start") + F.col("segment_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
