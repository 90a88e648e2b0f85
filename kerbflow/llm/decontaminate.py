"""Operator 7, benchmark decontamination: a generalised suffix automaton of the
normalised test items; training tokens stream through it, the longest matching
length is tracked at every word, and spans that cover a window are hit.

A window is ``window`` consecutive words of an item; an item with fewer words,
but not none, is one window itself. The automaton is built from item words alone;
items beyond ``shard_words`` words go to further automata, so that each one a
task holds is bounded and every document streams through all of them.

Defined cases: a null or empty text has no words and no hit; null or wordless
items have no windows; repeated items (or item ids) each count once by id; an
empty benchmark leaves all documents clean; null doc_ids pass through; other
columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from kerbflow.llm.common import Shared, free_name, slices, text_bytes, worker_held

#: Lower-cases A-Z, keeps 0-9, a-z and every non-ASCII byte, and makes all else a space.
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
                   for c in range(256))
RESULT = ("doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
          "items array<string>, spans array<struct<start:int,end:int>>")


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


class SuffixAutomaton:
    """Suffix automaton of several word sequences, each state with its items.

    ``windows[state]`` has (length, items) of the shortest window lengths that
    the state's strings stand for; a state inherits those of its suffix link.
    """

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        seqs = []
        for name, words in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            if ids:
                seqs.append((name, ids))
        for _, ids in seqs:
            last = 0
            for c in ids:
                last = self._extend(last, c)
        self._mark(seqs)
        self.shortest = min((min(window, len(ids)) for _, ids in seqs), default=0)

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if c in nxt[last]:                              # the string is there already: at most split its state
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else self._split(last, c, q)
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._split(p, c, q)
        return cur

    def _split(self, p: int, c: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        copy = len(nxt)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = copy
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = copy
            p = link[p]
        return copy

    def _mark(self, seqs) -> None:
        """Items of each window, held by the state whose strings include it."""
        at: dict[tuple[int, int], set[str]] = {}
        for name, ids in seqs:
            state, matched = 0, 0
            whole = min(self.window, len(ids))
            for k, c in enumerate(ids):
                state, matched = self.next[state][c], matched + 1
                while self.length[self.link[state]] >= whole:
                    state = self.link[state]
                matched = min(matched, self.length[state])
                if k + 1 >= whole:
                    at.setdefault((state, whole), set()).add(name)
        self.own: dict[int, list[tuple[int, frozenset]]] = {}
        for (state, m), names in at.items():
            self.own.setdefault(state, []).append((m, frozenset(names)))
        # Chains with any window, so that streaming looks no further than needed.
        self.marked = [-1] * len(self.next)
        for s in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            self.marked[s] = s if s in self.own else self.marked[self.link[s]]

    def stream(self, ids: list[int], offset: int, hit: list, found: set) -> None:
        """Follow word ids of the vocabulary; add (start, end) hits and item names."""
        nxt, link, length, marked = self.next, self.link, self.length, self.marked
        state = matched = 0
        for k, c in enumerate(ids):
            while state and c not in nxt[state]:
                state = link[state]
                matched = length[state]
            to = nxt[state].get(c)
            if to is None:
                state = matched = 0
                continue
            state, matched = to, matched + 1
            s = marked[state]
            longest = 0
            while s > 0:
                for m, names in self.own[s]:
                    if m <= matched:
                        longest = max(longest, m)
                        found |= names
                s = marked[link[s]]
            if longest:
                end = offset + k + 1
                if hit and end - longest <= hit[-1][1]:
                    while len(hit) > 1 and hit[-2][1] >= end - longest:
                        hit.pop()
                    hit[-1] = (min(hit[-1][0], end - longest), end)
                else:
                    hit.append((end - longest, end))


def match(words: list[bytes], automata: list[SuffixAutomaton]) -> tuple[list[tuple[int, int]], set[str]]:
    """Merged hit spans (word places, end exclusive) and the ids of items with occurring windows."""
    spans, found = [], set()
    for a in automata:
        if not a.shortest or len(words) < a.shortest:
            continue
        get = a.vocabulary.get
        ids = np.fromiter((get(w, 0) for w in words), np.int64, len(words))
        known = np.flatnonzero(np.diff(np.concatenate(([0], (ids > 0).view(np.int8), [0]))))
        for s, e in zip(known[::2].tolist(), known[1::2].tolist()):
            if e - s >= a.shortest:
                hit: list = []
                a.stream(ids[s:e].tolist(), s, hit, found)
                spans += hit
    merged: list = []
    for s, e in sorted(spans):
        if merged and s <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(e, merged[-1][1]))
        else:
            merged.append((s, e))
    return merged, found


def item_shards(benchmark: DataFrame, shard_words: int) -> list[list[tuple[str, list[bytes]]]]:
    """The items' words in shards. Test sets are bounded; the bound is checked here."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("i"), text_bytes(F.col("text")).alias("t"))
    size = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    if size > MAX_BENCHMARK_BYTES:
        raise ValueError(f"the benchmark has {size} bytes; a test set of up to {MAX_BENCHMARK_BYTES} is expected")
    shards, n = [[]], 0
    for i, t in rows.distinct().orderBy("i", "t").toLocalIterator():
        words = words_of(bytes(t))
        if n and n + len(words) > shard_words:
            shards.append([])
            n = 0
        shards[-1].append(("null" if i is None else i, words))
        n += len(words)
    return shards


#: Bound of the test items that tasks receive; more than all public test sets together need.
MAX_BENCHMARK_BYTES = 256 << 20


def _automata(shared, window: int) -> list[SuffixAutomaton]:
    return worker_held((shared.id, window), lambda: [SuffixAutomaton(s, window) for s in shared.value])


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 13, min_share: float = 0.05,
                  shard_words: int = 2_000_000) -> DataFrame:
    """Per document: its words, hit words, items, merged spans, and whether it is contaminated.

    Contaminated: some word is hit and hit words are at least ``min_share`` of all.
    """
    shared = Shared(docs.sparkSession, item_shards(benchmark, shard_words))
    per_million = round(min_share * 1_000_000)

    def scan(batches):
        automata = _automata(shared, window)
        for b in batches:
            out = [[] for _ in range(8)]
            for d, t in zip(b.column(0).to_pylist(), b.column(1)):
                words = words_of(t.as_buffer().to_pybytes())
                spans, items = match(words, automata)
                n_hit = sum(e - s for s, e in spans)
                names = sorted(items)
                for col, v in zip(out, (d, len(words), n_hit, len(names),
                                        hashlib.sha256(",".join(names).encode()).hexdigest(),
                                        n_hit > 0 and 1_000_000 * n_hit >= per_million * len(words), names,
                                        [{"start": s, "end": e} for s, e in spans])):
                    col.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(),
                 pa.bool_(), pa.list_(pa.string()), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))))],
                names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items", "spans"])

    return docs.select("doc_id", text_bytes(F.col("text")).alias("t")).mapInArrow(scan, RESULT)


def flag(docs: DataFrame, benchmark: DataFrame, window: int = 13, min_share: float = 0.05,
         shard_words: int = 2_000_000) -> DataFrame:
    """``docs``, row by row, with the column ``contaminated`` added last (``contaminated_`` beside one of that name)."""
    shared = Shared(docs.sparkSession, item_shards(benchmark, shard_words))
    per_million = round(min_share * 1_000_000)
    at = docs.columns.index("text")
    names = [*docs.columns, free_name("contaminated", docs.columns)]

    def scan(batches):
        automata = _automata(shared, window)
        for b in slices(batches):
            out = []
            for t in b.column(at).to_pylist():
                words = words_of((t or "").encode())
                n_hit = sum(e - s for s, e in match(words, automata)[0])
                out.append(n_hit > 0 and 1_000_000 * n_hit >= per_million * len(words))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.bool_())], names=names)

    return docs.mapInArrow(scan, StructType([*docs.schema.fields, StructField(names[-1], BooleanType())]))


def remove_spans(docs: DataFrame, benchmark: DataFrame, max_share: float = 0.5, **options) -> DataFrame:
    """Documents without the words of their hit spans; those beyond ``max_share`` are dropped.

    The text keeps its other words, joined by one space, where any word is removed.
    Rows are matched one by one, so repeated doc_ids and null ids keep their own text.
    """
    shared = Shared(docs.sparkSession, item_shards(benchmark, options.get("shard_words", 2_000_000)))
    window = options.get("window", 13)
    names = docs.columns
    at = names.index("text")

    def cut(batches):
        automata = _automata(shared, window)
        for b in batches:
            texts, keep = [], []
            for t in b.column(at).to_pylist():
                raw = (t or "").encode()
                words = words_of(raw)
                spans, _ = match(words, automata)
                n_hit = sum(e - s for s, e in spans)
                keep.append(not n_hit or n_hit <= max_share * len(words))
                if not n_hit:
                    texts.append(t)
                    continue
                gone = {i for s, e in spans for i in range(s, e)}
                clean, place, out = raw.translate(WORD_BYTES), 0, []
                for i, w in enumerate(words):
                    place = clean.index(w, place)
                    if i not in gone:
                        out.append(raw[place:place + len(w)])
                    place += len(w)
                texts.append(b" ".join(out).decode())
            cols = [pa.array(texts, b.schema.field(at).type) if i == at else b.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(cols, schema=b.schema).filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(cut, docs.schema)


def decontaminate_query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return decontaminate(docs, benchmark).drop("items", "spans")


ORACLE_SQL = r"""
WITH dw AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), iw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS m, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM bw WHERE len(w) > 0)
), lens AS (
  SELECT DISTINCT m FROM iw
), occ AS (
  SELECT r, i, m, array_to_string(w[i:i + m - 1], ' ') AS win
  FROM (SELECT r, m, w, unnest(range(1, len(w) - m + 2)) AS i FROM dw, lens WHERE len(w) >= m)
), hits AS (
  SELECT r, i, m, item_id FROM occ JOIN iw USING (m, win)
), n AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + m)) AS p FROM hits) GROUP BY r
), items AS (
  SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS names
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS s FROM hits) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN n USING (r) LEFT JOIN items USING (r)
"""
