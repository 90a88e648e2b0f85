"""Operator 12, ranked lexical search by the Best Position Algorithm.

Items (the stated query set) are handled in blocks; one block's terms go to every
task. For each block:

1. Every document is split into terms once. A row per document with its length
   and its counts of the block's terms is written; nothing is shuffled.
2. N, L and the document frequencies are counted from those rows, over all
   documents, and give every term's weight and every document's m.
3. A task deals its documents into segments of at most ``SEGMENT`` postings. For
   each term a segment holds the impact list (documents by falling impact
   ``(1000000000 tf) div (1000 tf + 12 m)``) and, for direct access, the place of
   every document in it.
4. Per item and segment the lists are read from the top side by side. Each new
   document is looked up in all lists, which gives its whole score and marks its
   places there as seen. A list's best position is the end of its seen prefix;
   the threshold is the weighted sum of the impacts at the best positions (0 for
   a list that is seen to its end), the most that an unseen document can score.
   Reading stops when the threshold is strictly below the k-th score, so ties are
   never missed. The best k so far are carried from segment to segment.
5. At most k rows per item and task are ranked by (score, doc_id).

The lists are read in growing runs (16, 32, 64, ... entries), so the stopping
test is done after runs; that changes how much is read, not the result.

Defined cases: a null or term-less document counts in no statistic and is never
returned; null doc_ids come after all others among equal scores; repeated rows
are documents of their own; a null or term-less item returns nothing; items that
share an item_id are ranked each for itself; an item's terms are held whole, as
are one document's counts of them; empty tables give an empty result; other
columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from kerbflow.llm.common import Shared, text_bytes, written

# Digits, letters and all bytes of non-ASCII characters belong to terms; only A-Z are lower-cased.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
SEGMENT = 4_000_000         # postings of a segment, about 200 MB with its places
BLOCK = 200_000             # (item, term) pairs of a block of items


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


# -- best positions --------------------------------------------------------------------------------------------

class ImpactList:
    """Documents of one term in a segment: by impact for sorted access, by number for direct access."""

    __slots__ = ("docs", "impacts", "by_doc", "place")

    def __init__(self, docs: np.ndarray, impacts: np.ndarray):
        order = np.lexsort((docs, -impacts))
        self.docs, self.impacts = docs[order], impacts[order]
        self.place = np.argsort(self.docs, kind="stable")
        self.by_doc = self.docs[self.place]

    def find(self, docs: np.ndarray):
        """(which of ``docs`` are here, their places)."""
        at = np.searchsorted(self.by_doc, docs)
        at[at == len(self.by_doc)] = 0
        here = self.by_doc[at] == docs
        return here, self.place[at[here]]


def best_positions(lists: list[tuple[int, ImpactList]], n_docs: int, floor: list[int], k: int, run: int = 16):
    """((documents, scores) with score above 0 that can be among the best k, entries read in order).

    ``floor``: scores that other segments have reached.
    """
    met = np.zeros(n_docs, dtype=bool)
    seen = [np.zeros(len(x.docs) + 1, dtype=bool) for _, x in lists]        # the last is never seen
    best = [0] * len(lists)                                                 # entries in the seen prefix
    top = np.sort(np.array(floor, dtype=np.int64))[::-1][:k]
    docs, scores, start, read = [], [], 0, 0
    while lists:
        ahead = [x.docs[start:start + run] for _, x in lists]
        read += sum(map(len, ahead))
        new = np.unique(np.concatenate(ahead))
        new = new[~met[new]]
        if len(new):
            met[new] = True
            total = np.zeros(len(new), dtype=np.int64)
            for (weight, x), mark in zip(lists, seen):
                here, places = x.find(new)
                total[here] += weight * x.impacts[places]
                mark[places] = True
            low = top[-1] if len(top) == k else 1
            able = total >= max(low, 1)
            docs.append(new[able])
            scores.append(total[able])
            top = np.sort(np.concatenate([top, total[able]]))[::-1][:k]
        threshold = 0
        for i, ((weight, x), mark) in enumerate(zip(lists, seen)):
            best[i] += int(np.argmin(mark[best[i]:]))
            if best[i] < len(x.docs):
                threshold += weight * int(x.impacts[max(best[i] - 1, 0)])
        if threshold == 0 or len(top) == k and threshold < top[-1]:
            break
        start, run = start + run, run * 2
    none = np.zeros(0, dtype=np.int64)
    return (np.concatenate([none, *docs]).astype(np.int64), np.concatenate([none, *scores])), read


class Segment:
    """Impact lists of the block's terms over some documents."""

    def __init__(self, batches: list[pa.RecordBatch], n_docs: int, total_terms: int):
        rows = pa.Table.from_batches(batches)
        self.n = rows.num_rows
        self.ids = rows.column("doc_id").combine_chunks() if self.n else None
        counts, terms, tfs, lengths = [], [], [], []
        for b in batches:
            lists = b.column("terms")
            counts.append(np.diff(lists.offsets.to_numpy()))
            terms.append(lists.flatten().to_numpy())
            tfs.append(b.column("tfs").flatten().to_numpy())
            lengths.append(b.column("n").to_numpy())
        counts, terms = np.concatenate(counts), np.concatenate(terms)
        tfs, lengths = np.concatenate(tfs).astype(np.int64), np.concatenate(lengths).astype(np.int64)
        m = 75 + (25 * lengths * n_docs) // total_terms
        docs = np.repeat(np.arange(self.n, dtype=np.int32), counts)
        impacts = (1_000_000_000 * tfs) // (1000 * tfs + 12 * m[docs])
        order = np.argsort(terms, kind="stable")
        terms, self._docs, self._impacts = terms[order], docs[order], impacts[order]
        here, starts = np.unique(terms, return_index=True)
        self._range = dict(zip(here.tolist(), zip(starts.tolist(), [*starts[1:].tolist(), len(terms)])))
        self._lists: dict[int, ImpactList] = {}

    def list_of(self, term: int) -> ImpactList | None:
        if term not in self._range:
            return None
        if term not in self._lists:
            a, b = self._range[term]
            self._lists[term] = ImpactList(self._docs[a:b], self._impacts[a:b])
        return self._lists[term]


# -- the search ------------------------------------------------------------------------------------------------

def _item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, item_id, terms, counts) of the items that have terms; item tells rows apart."""
    rows = items.select(F.monotonically_increasing_id().alias("item"), F.col(id_col).alias("item_id"),
                        text_bytes(F.col(text_col)).alias("text"))

    def split(batches):
        for b in batches:
            found = [Counter(terms_of(t.as_py())) for t in b.column("text")]
            keep = [i for i, c in enumerate(found) if c]
            yield pa.RecordBatch.from_arrays(
                [b.column("item").take(pa.array(keep, pa.int64())), b.column("item_id").take(pa.array(keep, pa.int64())),
                 pa.array([list(found[i]) for i in keep], pa.list_(pa.binary())),
                 pa.array([list(found[i].values()) for i in keep], pa.list_(pa.int64()))],
                ["item", "item_id", "terms", "counts"])

    kind = dict(rows.dtypes)["item_id"]
    return rows.mapInArrow(split, f"item long, item_id {kind}, terms array<binary>, counts array<long>")


def _forward(docs: DataFrame, id_col: str, text_col: str, vocabulary: Shared) -> DataFrame:
    """(doc_id, n, terms, tfs) of every document with a term: its length and its counts of the vocabulary's terms."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_bytes(F.col(text_col)).alias("text"))

    def count(batches):
        number = vocabulary.value
        known = number.__contains__
        for b in batches:
            keep, lengths, terms, tfs = [], [], [], []
            for i, t in enumerate(b.column("text")):
                words = terms_of(t.as_py())
                if words:
                    c = Counter(filter(known, words))
                    keep.append(i)
                    lengths.append(len(words))
                    terms.append([number[w] for w in c])
                    tfs.append(list(c.values()))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(keep, pa.int64())), pa.array(lengths, pa.int64()),
                 pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int32()))], ["doc_id", "n", "terms", "tfs"])

    return rows.mapInArrow(count, f"doc_id {dict(rows.dtypes)['doc_id']}, n long, terms array<int>, tfs array<int>")


def _order(entry):
    """By falling score, then rising id, nulls last."""
    score, doc_id = entry
    return (-score, doc_id is None, 0 if doc_id is None else doc_id)


def _search_block(docs: DataFrame, block: list, id_col: str, text_col: str, k: int, segment: int) -> DataFrame:
    """(item, doc_id, score): at most k rows per item and task, the best k of each item among them."""
    spark = docs.sparkSession
    vocabulary = {t: i for i, t in enumerate(sorted({bytes(t) for r in block for t in r["terms"]}))}
    forward = written(spark, _forward(docs, id_col, text_col, Shared(spark, vocabulary)), "search-forward")
    n_docs, total = forward.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = {r["t"]: r["df"] for r in forward.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect()}
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * f + 1))) for t, f in df.items()}
    # A term that no document has, or that weighs nothing, adds nothing.
    asked = Shared(spark, [(r["item"], [(c * weight[v], v) for t, c in zip(r["terms"], r["counts"])
                                        if weight.get(v := vocabulary[bytes(t)], 0) > 0]) for r in block])
    doc_type = to_arrow_type(forward.schema["doc_id"].dataType)

    def look(batches):
        items, best, held, size = asked.value, {}, [], 0

        def flush():
            seg = Segment(held, n_docs, total)
            for item, terms in items:
                lists = [(w, x) for w, t in terms if (x := seg.list_of(t)) is not None]
                if not lists:
                    continue
                so_far = best.get(item, [])
                (found, scores), _ = best_positions(lists, seg.n, [s for s, _ in so_far], k)
                if len(scores) > k:             # more than k are told apart by id only where scores are equal
                    keep = scores >= np.sort(scores)[-k]
                    found, scores = found[keep], scores[keep]
                best[item] = sorted(so_far + list(zip(scores.tolist(), seg.ids.take(pa.array(found)).to_pylist())), key=_order)[:k]

        for b in batches:
            at = 0
            while at < b.num_rows:              # cut where the segment is full
                counts = np.diff(b.column("terms").offsets.to_numpy())[at:]
                fits = int(np.searchsorted(np.cumsum(counts), segment - size, side="right"))
                fits = max(fits, 0 if held else 1)
                if fits:
                    held.append(b.slice(at, fits))
                    size += int(counts[:fits].sum())
                    at += fits
                if at < b.num_rows:
                    flush()
                    held, size = [], 0
        if held:
            flush()
        out = [(item, d, s) for item, rows in best.items() for s, d in rows]
        item, doc, score = zip(*out) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(doc, doc_type), pa.array(score, pa.int64())],
                                         ["item", "doc_id", "score"])

    return written(spark, forward.mapInArrow(look, f"item long, doc_id {dict(forward.dtypes)['doc_id']}, score long"), "search-best")


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text",
           k: int = 20, block: int = BLOCK, segment: int = SEGMENT) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of every item, from rank 1."""
    spark = docs.sparkSession
    asked = written(spark, _item_terms(items, item_col, text_col), "search-items")
    pairs = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = max(1, -(-pairs // block))
    best = None
    for i in range(blocks):
        rows = asked.where(F.pmod(F.hash("item"), F.lit(blocks)) == i).select("item", "terms", "counts").collect()
        if rows:
            found = _search_block(docs, rows, id_col, text_col, k, segment)
            best = found if best is None else best.unionByName(found)
    if best is None:
        best = docs.select(F.lit(0).cast("long").alias("item"), F.col(id_col).alias("doc_id"), F.lit(0).cast("long").alias("score")).limit(0)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def lexical_search_query(docs: DataFrame, items: DataFrame) -> DataFrame:
    return search(docs, items)


ORACLE_SQL = r"""
WITH doc_terms AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM benchmark
), asked AS (
  SELECT item_id, term, count(*) AS q FROM (SELECT item_id, unnest(terms) AS term FROM items) GROUP BY ALL
), stats AS (
  SELECT count(*) AS big_n, sum(len(terms))::BIGINT AS big_l FROM doc_terms WHERE len(terms) > 0
), postings AS (
  SELECT doc_id, term, count(*) AS tf, any_value(n) AS n
  FROM (SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM doc_terms) GROUP BY doc_id, term
), weights AS (
  SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM postings, stats GROUP BY term, big_n
), scores AS (
  SELECT a.item_id, p.doc_id,
         sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * big_n) // big_l))))::BIGINT AS score
  FROM asked a JOIN postings p USING (term) JOIN weights USING (term), stats GROUP BY ALL
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY rank <= 20
"""
