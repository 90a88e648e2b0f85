"""Operator 4, token ids in binary files: every id in the vocabulary's least
number of bits, blocks whose offsets allow vectorised numpy unpacking and
random access.

A file: header (magic, version, bits, ids per block, ids, documents), the blocks,
then block offsets, document ids, null flags and lengths, and the footer's place.
Bits run from the lowest of each id, bytes in order.

Defined cases: a null or empty text is its end id alone; null doc_ids come first
and are read back as null; repeated doc_ids follow each other by text; an empty
table gives no file and an empty result; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kerbflow.llm import files
from kerbflow.llm.common import word_ids, written
from kerbflow.session import scratch_path

# This format's magic and header layout.
MAGIC = b"KFID0001"
HEAD = struct.Struct("<8sHHIQQ")
MANIFEST = "part long, piece long, path string, n_docs long, n_ids long"
DOCS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    wide = ((ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & 1).astype(np.uint8)
    return np.packbits(wide.ravel(), bitorder="little").tobytes()


def unpack_bits(raw: bytes, bits: int, n: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(raw, f"<u{bits // 8}", n).astype("<u4")
    wide = np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little")[:n * bits].reshape(n, bits)
    return (wide.astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(axis=1, dtype=np.uint32).astype("<u4")


def file_bytes(doc_ids: list, ids: list[bytes], bits: int, block: int) -> list[bytes]:
    """The parts of one file; ``ids`` holds each document's ids as unsigned 32-bit integers."""
    flat = np.frombuffer(b"".join(ids), "<u4")
    parts = [HEAD.pack(MAGIC, 1, bits, block, len(flat), len(doc_ids))]
    offsets = [HEAD.size]
    for i in range(0, len(flat), block):
        parts.append(pack_bits(flat[i:i + block], bits))
        offsets.append(offsets[-1] + len(parts[-1]))
    parts += [np.array(offsets, "<u8").tobytes(),
              np.array([x or 0 for x in doc_ids], "<i8").tobytes(),
              np.array([x is None for x in doc_ids], "u1").tobytes(),
              np.array([len(x) // 4 for x in ids], "<u8").tobytes(),
              struct.pack("<Q8s", offsets[-1], MAGIC)]
    return parts


class TokenFile:
    """Random access to one file: ``docs()`` and ``ids(start, n)``."""

    def __init__(self, path: str):
        filesystem, name = files.open_fs(path)
        self.f = filesystem.open_input_file(name)
        magic, version, self.bits, self.block, self.n_ids, self.n_docs = HEAD.unpack(self.f.read(HEAD.size))
        size = self.f.size()
        self.f.seek(size - 16)
        footer, end = struct.unpack("<Q8s", self.f.read(16))
        if magic != MAGIC or end != MAGIC or version != 1:
            raise ValueError(f"{path} is not a token file")
        n_blocks = -(-self.n_ids // self.block)
        self.f.seek(footer)
        raw = self.f.read(size - 16 - footer)
        if len(raw) != 8 * (n_blocks + 1) + 17 * self.n_docs:
            raise ValueError(f"{path}: footer of {len(raw)} bytes for {n_blocks} blocks, {self.n_docs} documents")
        self.offsets = np.frombuffer(raw, "<u8", n_blocks + 1)
        at = 8 * (n_blocks + 1)
        self.doc_ids = np.frombuffer(raw, "<i8", self.n_docs, at)
        self.nulls = np.frombuffer(raw, "u1", self.n_docs, at + 8 * self.n_docs)
        self.lengths = np.frombuffer(raw, "<u8", self.n_docs, at + 9 * self.n_docs).astype(np.int64)

    def ids(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from place ``start``, reading only the blocks that hold them."""
        if n <= 0:
            return np.zeros(0, "<u4")
        a, b = start // self.block, -(-(start + n) // self.block)
        self.f.seek(int(self.offsets[a]))
        raw = self.f.read(int(self.offsets[b] - self.offsets[a]))
        base = int(self.offsets[a])
        out = [unpack_bits(raw[int(self.offsets[k]) - base:int(self.offsets[k + 1]) - base], self.bits,
                           min(self.block, self.n_ids - k * self.block)) for k in range(a, b)]
        return np.concatenate(out)[start - a * self.block:][:n]

    def close(self):
        self.f.close()


def least_bits(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def write_tokens(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int, keeps_space: bool = False,
                 folder: str | None = None, ids_per_file: int = 8_000_000, block: int = 65_536) -> DataFrame:
    """Encode, append ``end_id`` and write all documents in ascending doc_id order; the manifest."""
    from tokenizers import Tokenizer
    bits = least_bits(max(Tokenizer.from_file(tokenizer).get_vocab_size(), end_id + 1))
    folder = folder or scratch_path(spark, "token-ids")
    end = np.array([end_id], "<u4").tobytes()

    def write(batches):
        encode = word_ids(tokenizer, keeps_space).encode
        names, ids, n, piece = [], [], 0, 0

        def flush():
            path = files.new_file(folder, f"part-{files.partition_id():05d}-{piece:05d}", ".ids",
                                  file_bytes(names, ids, bits, block))
            return pa.RecordBatch.from_pydict({"part": [files.partition_id()], "piece": [piece], "path": [path],
                                               "n_docs": [len(names)], "n_ids": [n]})

        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                for d, x in zip(part.column(0).to_pylist(), encode(part.column(1).to_pylist())):
                    names.append(d)
                    ids.append(x + end)
                    n += len(x) // 4 + 1
                    if n >= ids_per_file:
                        yield flush()
                        names, ids, n, piece = [], [], 0, piece + 1
        if names:
            yield flush()

    ordered = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
               .repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions("doc_id", "text"))
    return written(spark, ordered.mapInArrow(write, MANIFEST), "token-manifest")


def read_tokens(manifest: DataFrame) -> DataFrame:
    """Per document from the files: doc_id, start, n_tokens, ids_crc32."""
    # One row per file; the running sum over files is the only unpartitioned step.
    order = Window.orderBy("part", "piece").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(order), F.lit(0)))

    def read(batches):
        for b in batches:
            for path, start, n_docs, n_ids in zip(*(b.column(c).to_pylist() for c in ("path", "start", "n_docs", "n_ids"))):
                f = TokenFile(path)
                if (f.n_docs, f.n_ids) != (n_docs, n_ids) or f.lengths.sum() != n_ids:
                    raise ValueError(f"{path} doesn't hold what the manifest says")
                ends = np.cumsum(f.lengths)
                crc = np.empty(n_docs, np.int64)
                for i in range(0, n_docs, 2048):
                    j = min(i + 2048, n_docs)
                    base = int(ends[i] - f.lengths[i])
                    flat = f.ids(base, int(ends[j - 1]) - base)
                    for k in range(i, j):
                        crc[k] = zlib.crc32(flat[int(ends[k] - f.lengths[k]) - base:int(ends[k]) - base].tobytes())
                f.close()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(f.doc_ids, pa.int64(), mask=f.nulls.astype(bool)), pa.array(start + ends - f.lengths),
                     pa.array(f.lengths), pa.array(crc)], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return placed.repartition(max(1, manifest.count())).mapInArrow(read, DOCS)


def token_files_query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    import public_tokenizers
    return read_tokens(write_tokens(spark, docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2))
