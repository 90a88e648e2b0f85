"""Operator 1, n-gram Jaccard join by MinHash bands.

Texts are lower-cased and split at white space; the n-grams of a text are its
distinct runs of ``n`` words (all its words, where it has fewer). Documents with
equal n-gram sets form a class, which is joined once, whatever its size. Band and
row counts are chosen for a target recall at the threshold; classes that share a
band hash are candidates, and the pairs within each connected set of candidates
are verified on their full n-gram sets (64-bit hashes). A large set is cut in
blocks, every pair of blocks being a group of its own; within a group, shared
n-grams are counted through postings, and what leaves it is one row per class and
a spanning forest of its links, not all pairs.

Defined cases: texts without words (null, empty) have no n-grams and join
nothing; rows with a null doc_id stand alone, too; rows that repeat a doc_id with
another text belong to the class of their own text; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbflow.llm.common import slices, small_batches, text_bytes, worker_freed, written
from kerbflow.llm.components import components

N_WORDS, THRESHOLD = 5, (4, 5)       # similarity of 0.8 as a fraction, so that it is compared exactly


def bands_for(similarity: float, recall: float, rows: int = 5) -> int:
    """The least number of bands of ``rows`` rows that finds pairs at ``similarity`` with ``recall``."""
    return int(np.ceil(np.log(1 - recall) / np.log(1 - similarity ** rows)))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_SEPARATOR = re.compile(rb"[\x09-\x0d\x20]")
_IN_WORD = np.array([not (9 <= c <= 13 or c == 32) for c in range(256)])
_BYTE = np.random.default_rng(20240301).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS = [np.ones(1, np.uint64)]


def _powers(n: int) -> np.ndarray:
    if len(_POWERS[0]) < n:
        with np.errstate(over="ignore"):
            _POWERS[0] = np.cumprod(np.full(max(n, 256), 0x9E3779B97F4A7C15, np.uint64))
    return _POWERS[0]


def word_hashes(text: bytes, chunk: int = 1 << 20) -> np.ndarray:
    """A 64-bit hash of each word (bytes between white space), in order: a polynomial over
    the word's bytes with random coefficients, for all words of a chunk at once."""
    out, at = [], 0
    while at < len(text):
        cut = _SEPARATOR.search(text, at + chunk)
        end = cut.start() if cut else len(text)
        raw = np.frombuffer(text, np.uint8, end - at, at)
        inside = _IN_WORD[raw].view(np.int8)
        edges = np.flatnonzero(np.diff(inside, prepend=np.int8(0), append=np.int8(0)))
        at = end + 1
        if not len(edges):
            continue
        starts = edges[::2]
        starts, sizes = starts - starts[0], edges[1::2] - starts
        body = raw[edges[0]:]
        place = np.arange(len(body)) - np.repeat(starts, np.diff(np.append(starts, len(body))))
        place[~_IN_WORD[body]] = 0
        values = _BYTE[body] * _powers(int(sizes.max()))[place]
        values[~_IN_WORD[body]] = 0
        out.append(_mix(np.add.reduceat(values, starts) + sizes.astype(np.uint64)))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def ngrams(text: bytes, n: int = N_WORDS) -> np.ndarray:
    """Sorted distinct hashes of the text's n-grams."""
    h = word_hashes(text.decode().lower().encode())
    if not len(h):
        return h
    k = min(n, len(h))
    g = np.zeros(len(h) - k + 1, np.uint64)
    for i in range(k):
        g = (g + h[i:len(h) - k + 1 + i]) * np.uint64(0x9E3779B97F4A7C15 + 2 * i)
        g ^= g >> np.uint64(29)
    return np.unique(_mix(g))


def minhash(grams: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    best = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(grams), 1024):
        np.minimum(best, (grams[at:at + 1024, None] * a + b).min(axis=0), out=best)
    return best


def signatures(docs: DataFrame, bands: int, rows: int, n: int = N_WORDS) -> DataFrame:
    """doc_id, node (16 bytes that stand for the n-gram set, null without words), bands (a hash each)."""
    small_batches(docs.sparkSession)
    rng = np.random.default_rng(20240229)
    a = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64)

    def scan(batches):
        with np.errstate(over="ignore"):
            worker_freed()
            for batch in slices(batches):
                nodes, keys = [], []
                for t in batch.column(1):
                    g = ngrams(t.as_buffer().to_pybytes(), n)
                    if not len(g):
                        nodes.append(None)
                        keys.append(None)
                        continue
                    nodes.append(node_of(g))
                    low = _mix(minhash(g, a, b)).reshape(bands, rows)
                    key = np.arange(bands, dtype=np.uint64)
                    for r in range(rows):
                        key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + low[:, r])
                    keys.append(key.view(np.int64))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(nodes, pa.binary()),
                                                  pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "node", "bands"])

    return docs.select("doc_id", text_bytes(F.col("text")).alias("t")).mapInArrow(
        scan, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, node binary, bands array<long>")


def node_of(g: np.ndarray) -> bytes:
    from xxhash import xxh3_128_digest
    return xxh3_128_digest(g.tobytes())


def block_links(left: list[tuple], right: list[tuple] | None, threshold=THRESHOLD):
    """Links between (node, weight, n-grams) of two blocks, or within one if ``right`` is None.

    Returns for each node with a link [classes linked, documents linked], and a spanning forest.
    """
    over, under = threshold
    both = left + (right or [])
    sizes = np.array([len(g) for _, _, g in both])
    owner = np.repeat(np.arange(len(both)), sizes)
    flat = np.concatenate([g for _, _, g in both])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    first = np.flatnonzero(np.append(True, flat[1:] != flat[:-1]))
    count = np.diff(np.append(first, len(flat)))
    shared = np.flatnonzero(count > 1)                        # n-grams that more than one of them has
    weight = np.array([w for _, w, _ in both])
    found: dict[bytes, list[int]] = {}
    parent = list(range(len(both)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    gram = np.repeat(np.arange(len(first)), count)
    by_owner = np.argsort(owner, kind="stable")
    begin = np.concatenate(([0], np.cumsum(sizes)))
    many = np.zeros(len(first), bool)
    many[shared] = True
    for i in range(len(left)):
        mine = gram[by_owner[begin[i]:begin[i + 1]]]
        mine = mine[many[mine]]
        if not len(mine):
            continue
        length = count[mine]
        ends = np.cumsum(length)
        at = np.arange(ends[-1]) - np.repeat(ends - length, length) + np.repeat(first[mine], length)
        common = np.bincount(owner[at], minlength=len(both))
        near = under * common >= over * (sizes[i] + sizes - common)
        near[i] = False
        if right is not None:
            near[:len(left)] = False
        near = np.flatnonzero(near)
        if not len(near):
            continue
        mine_found = found.setdefault(both[i][0], [0, 0])
        mine_found[0] += len(near)
        mine_found[1] += int(weight[near].sum())
        for j in near.tolist():
            if right is not None:
                other = found.setdefault(both[j][0], [0, 0])
                other[0] += 1
                other[1] += int(weight[i])
            x, y = root(i), root(j)
            if x != y:
                parent[max(x, y)] = min(x, y)
    forest = [(both[i][0], both[root(i)][0]) for i in range(len(both)) if root(i) != i]
    return found, forest


def ngram_join(docs: DataFrame, n: int = N_WORDS, threshold=THRESHOLD, recall: float = 0.9999, rows: int = 5,
               block: int = 512, distinct_texts: bool = False) -> DataFrame:
    """doc_id, copy_of (least id with the same n-grams), class_id (least id that links lead to),
    n_links (documents at the threshold or above, copies included).
    Ids can be of any type with an order; with ``distinct_texts`` rows that repeat id and text are verified once."""
    spark = docs.sparkSession
    bands = bands_for(threshold[0] / threshold[1], recall, rows)
    sig = written(spark, signatures(docs, bands, rows, n), "ngram-bands")
    joined = sig.where("node IS NOT NULL AND doc_id IS NOT NULL")
    classes = written(spark, joined.groupBy("node").agg(F.min("doc_id").alias("copy_of"), F.count("*").alias("copies"),
                                                        F.first("bands").alias("bands")), "ngram-classes")
    keys = classes.select("node", F.explode("bands").alias("key"))
    hubs = keys.groupBy("key").agg(F.min("node").alias("v"), F.count("*").alias("n")).where("n > 1").drop("n")
    edges = keys.join(hubs, "key").select(F.col("node").alias("u"), "v")
    sets = written(spark, components(edges, "ngram-candidates"), "ngram-sets")
    blocks = (sets.groupBy("root").agg(F.count("*").alias("n"))
              .select("root", F.ceil(F.col("n") / block).cast("int").alias("blocks")))
    # Every class goes to each pair of blocks that has its own; almost all sets are one block.
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    placed = (classes.drop("bands").join(sets, "node").join(blocks, "root").withColumn("mine", mine)
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("node", "copies", F.col("copy_of").alias("doc_id"), "root", "mine",
                      F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j")))
    with_text = placed.join(docs.select("doc_id", text_bytes(F.col("text")).alias("t")), "doc_id").drop("doc_id")
    if distinct_texts:
        with_text = with_text.dropDuplicates()

    def verify(key, group):
        with np.errstate(over="ignore"):
            i, j = key[1].as_py(), key[2].as_py()
            sides: tuple[dict, dict] = {}, {}
            for node, w, at, t in zip(*(group.column(c).to_pylist() for c in ("node", "copies", "mine", "t"))):
                side = sides[at != i]
                if node not in side:
                    g = ngrams(t, n)
                    if node_of(g) == node:           # a row that repeats the id with another text is not the class's
                        side[node] = (node, w, g)
            left, right = (list(s.values()) for s in sides)
            found, forest = ({}, []) if not left or i != j and not right else block_links(left, right if i != j else None, threshold)
            rows_ = [(k, None, a, b) for k, (a, b) in found.items()] + [(u, v, 0, 0) for u, v in forest]
            cols = list(zip(*rows_)) or [(), (), (), ()]
            return pa.table([pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.binary()),
                             pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64())],
                            names=["node", "to", "classes", "documents"])

    links = written(spark, with_text.groupBy("root", "i", "j").applyInArrow(
        verify, "node binary, to binary, classes long, documents long"), "ngram-links")
    counts = links.where("to IS NULL").groupBy("node").agg(F.sum("documents").alias("linked"))
    roots = components(links.where("to IS NOT NULL").select(F.col("node").alias("u"), F.col("to").alias("v")), "ngram-links")
    named = classes.drop("bands").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("copy_of").alias("class_id"))
    named = (named.join(least, "root").join(counts, "node", "left")
             .select("node", "copy_of", "class_id", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links")))
    found = joined.select("doc_id", "node").join(named, "node").drop("node")
    alone = (sig.where("node IS NULL OR doc_id IS NULL")
             .select("doc_id", F.col("doc_id").alias("copy_of"), F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links")))
    return found.unionByName(alone)


SMALL = 200_000         # row keys (20 MB) that may be broadcast


def row_key(doc_id, text):
    """Text that sorts like the id, nulls last, then by a hash of the text; equal for rows with equal id and text only."""
    order = F.lpad(F.hex(doc_id.cast("long").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
    body = F.md5(F.coalesce(F.concat(F.lit("="), text), F.lit("")).cast("binary"))
    return F.concat(F.coalesce(F.concat(F.lit("0"), order), F.lit("1")), body)


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each class: that with the least doc_id, nulls last. Rows are told apart by id and
    text; of rows equal in both one is left. Rows without words stay."""
    spark = docs.sparkSession
    name = "row_key"
    while name in docs.columns:
        name += "_"
    keyed = docs.withColumn(name, row_key(F.col("doc_id"), F.col("text")))
    found = ngram_join(keyed.select(F.col(name).alias("doc_id"), "text"), distinct_texts=True, **options)
    # Rows with words that are equal have links to each other; rows with equal keys are in one class.
    rows = written(spark, found.where("n_links > 0").groupBy("doc_id")
                   .agg(F.min("class_id").alias("class_id"), F.count("*").alias("n")), "ngram-rows")
    pick = lambda which, to: written(spark, rows.where(which).select(F.col("doc_id").alias(name)), to)      # noqa: E731
    gone, again = pick("doc_id <> class_id OR n > 1", "ngram-gone"), pick("doc_id = class_id AND n > 1", "ngram-again")
    # Written, counted keys of 49 letters: few enough, they are broadcast, so that the texts aren't shuffled.
    few = lambda df: F.broadcast(df) if df.count() <= SMALL else df        # noqa: E731
    once = keyed.join(few(again), name, "left_semi").dropDuplicates([name])
    return keyed.join(few(gone), name, "left_anti").unionByName(once).select(docs.columns)


def ngram_join_query(docs: DataFrame) -> DataFrame:
    return ngram_join(docs)
