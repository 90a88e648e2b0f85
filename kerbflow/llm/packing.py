"""Operator 5, best-fit packing: a plan over the histogram of piece lengths, then
pieces take the planned places by joining on their rank within their length.

Only documents longer than a sequence are cut, into whole sequences; the first
piece may be shorter. The driver sees one count for each length up to the
sequence's and a plan of a few thousand patterns, whatever the size of the corpus.

Defined cases: a null or empty text is its end id alone; null doc_ids pass
through; repeated rows are documents of their own; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbflow.llm.common import Shared, slices, small_batches, word_ids, written

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces_of(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, keeps_space: bool = True,
              with_ids: bool = False) -> DataFrame:
    """The pieces of every document, with their ids (little-endian, 32 bits) if asked for."""
    end = np.array([end_id], "<u4").tobytes()
    small_batches(docs.sparkSession)

    def cut(batches):
        encode = word_ids(tokenizer, keeps_space).encode
        for part in slices(batches, 256):
            rows = []
            for d, x in zip(part.column(0).to_pylist(), encode(part.column(1).to_pylist())):
                x += end
                n = len(x) // 4
                first = (n - 1) % capacity + 1
                for k, s in enumerate([0, *range(first, n, capacity)]):
                    raw = x[4 * s:4 * (first if k == 0 else s + capacity)]
                    rows.append((d, k, s, len(raw) // 4, zlib.crc32(raw), raw if with_ids else None))
            cols = list(zip(*rows))
            arrays = [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays.append(pa.array(cols[5], pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
            .mapInArrow(cut, PIECES + (", ids binary" if with_ids else "")))


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Best-fit decreasing over counts: (sequences, [(length, times, offset)]) patterns.

    Lengths go down; sequences that are alike stand together as one group. Pieces
    of a length go to the groups with the least room that still holds them, then to
    new sequences. A length splits one group and opens two at most, so there are
    at most three groups for each length.
    """
    room: list[list] = [[] for _ in range(capacity + 1)]      # groups by room left: [sequences, pattern]
    for length in sorted(counts, reverse=True):
        n = counts[length]
        r = length
        while n and r <= capacity:
            if not room[r]:
                r += 1
                continue
            m, pattern = room[r].pop()
            k = min(r // length, n)
            full = min(m, n // k)
            if m > full:
                room[r].append((m - full, pattern))
            left = r - k * length
            room[left].append((full, [*pattern, (length, k, capacity - r)]))
            n -= full * k
            if n:
                r = length                                     # the least room first, again
        k = capacity // length
        if n >= k:
            room[capacity - k * length].append((n // k, [(length, k, 0)]))
        if n % k:
            room[capacity - n % k * length].append((1, [(length, n % k, 0)]))
    return [g for groups in room for g in groups]


def slots(patterns, shift: int) -> list[np.ndarray]:
    """The plan as sorted arrays: key (length and first rank), rank, times, first sequence, offset."""
    rows, sequence, used = [], 0, {}
    for m, pattern in patterns:
        for length, k, offset in pattern:
            rank = used.get(length, 0)
            used[length] = rank + m * k
            rows.append((length << shift | rank, rank, k, sequence, offset))
        sequence += m
    rows.sort()
    return [np.array(c, np.int64) for c in zip(*rows)] if rows else [np.zeros(0, np.int64)] * 5


def with_rank(pieces: DataFrame, buckets: int) -> tuple[DataFrame, dict[int, int]]:
    """``pieces`` with their rank within their length, and the histogram of lengths.

    A length can hold a large share of all rows, so each is ranked in ``buckets``
    parts, whose sizes give the rank at which a part begins.
    """
    p = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    sizes = p.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}    # a row per length
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = p.withColumn("k", F.row_number().over(inside)).join(first, ["length", "bucket"])
    return ranked.withColumn("rank", F.col("first") + F.col("k") - 1).drop("bucket", "k", "first"), counts


def place(pieces: DataFrame, capacity: int = 2048, buckets: int | None = None) -> DataFrame:
    """``pieces`` (with a ``length`` each) with ``sequence_id`` and ``offset``.

    ``pieces`` is read several times, so it should be a written table.
    """
    spark = pieces.sparkSession
    ranked, counts = with_rank(pieces, buckets or max(8, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    shift = 44
    shared = Shared(spark, slots(plan(counts, capacity), shift))
    fields = [f for f in ranked.schema if f.name != "rank"]

    def take(batches):
        key, first, times, sequence, offset = shared.value
        for b in batches:
            length = b.column("length").to_numpy(zero_copy_only=False)
            rank = b.column("rank").to_numpy(zero_copy_only=False)
            i = np.searchsorted(key, length << shift | rank, "right") - 1
            nth = rank - first[i]
            seq, off = sequence[i] + nth // times[i], offset[i] + nth % times[i] * length
            cols = [b.column(f.name) for f in fields]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(seq), pa.array(off)],
                                             names=[*(f.name for f in fields), "sequence_id", "offset"])

    from pyspark.sql.types import LongType, StructField, StructType
    return ranked.mapInArrow(take, StructType([*fields, StructField("sequence_id", LongType()),
                                               StructField("offset", LongType())]))


def sequences(placed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids (binary), doc_ids. A sequence is at most
    ``capacity`` ids, which bounds each group."""
    g = placed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("p"))
    return g.select("sequence_id", F.concat_ws("", F.transform("p", lambda x: F.hex(x["ids"]))).alias("h"),
                    F.col("p.doc_id").alias("doc_ids")).select("sequence_id", F.unhex("h").alias("ids"), "doc_ids")


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 2048, keeps_space: bool = True) -> DataFrame:
    pieces = written(docs.sparkSession, pieces_of(docs, tokenizer, end_id, capacity, keeps_space), "pieces")
    return place(pieces, capacity).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def packing_query(docs: DataFrame) -> DataFrame:
    import public_tokenizers
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
