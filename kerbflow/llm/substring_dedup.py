"""Operator 10, substring dedup by repeated-phrase automata.

A window is ``window`` consecutive words; a word is removed if it lies in a
window whose word sequence starts anywhere else, too. Steps:

1. Each text is cut at anchors: the least hash among the 8-grams of a window.
   Equal windows have equal anchors, and neighbouring windows mostly share one, so
   anchors are a small part of all windows. Anchors seen once can't lie in a
   recurring window; the other ones give segments (all windows of one anchor).
2. Distinct segments are dealt in shards of whole anchors, bounded in bytes. A
   shard counts its windows, word by word, with the segments' counts from all
   documents; runs of recurring windows are the confirmed phrases.
3. The shard's phrases are compiled to an Aho-Corasick automaton, and its segments
   stream through it; equal segments of all documents have equal hits, so each
   text goes through once, and its hits are joined to every occurrence.
4. The places are joined to their documents and their words removed.

An anchor with more segments than fit a shard (a phrase in very many contexts) is
counted by key over all tasks instead, and streams in salted parts. No step
gathers a group that grows with the corpus.

Defined cases: texts with fewer words than a window keep all; null texts have no
words; null or repeated doc_ids are told apart by their text, and repeated rows
are each other's copies; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbflow.llm.common import text_bytes, written
from kerbflow.llm.ngram_join import _mix, word_hashes

GRAM = 8


def anchors(text: bytes, window: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(8-gram hashes, the anchor's place for each window start)."""
    h = word_hashes(text)
    n = len(h) - gram + 1
    g = np.zeros(n, np.uint64)
    for i in range(gram):
        g = (g + h[i:n + i]) * np.uint64(0x9E3779B97F4A7C15 + 2 * i)
        g ^= g >> np.uint64(29)
    g = _mix(g)
    span, starts = window - gram + 1, len(h) - window + 1
    at = np.empty(starts, np.int64)
    for i in range(0, starts, _CHUNK):
        # The place in the low bits: the least value is then the leftmost least hash, and tells where it is.
        part = g[i:i + _CHUNK + span - 1]
        low = (part & ~_PLACE) | np.arange(len(part), dtype=np.uint64)
        width = 1
        while 2 * width <= span:                       # least of 1, 2, 4, ... neighbours
            low, width = np.minimum(low[:-width], low[width:]), 2 * width
        if width < span:
            low = np.minimum(low[:len(low) - (span - width)], low[span - width:])
        at[i:i + len(low)] = (low & _PLACE).astype(np.int64) + i
    return g.view(np.int64), at


_CHUNK = 1 << 19
_PLACE = np.uint64((1 << 20) - 1)


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _identified(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", text_bytes(F.col("text")).alias("t")).withColumn("key", F.xxhash64("doc_id", "t"))


def _scan(docs: DataFrame, window: int) -> DataFrame:
    """Per document: its words, the digest of all of them, and its distinct anchors with their counts."""
    def scan(batches):
        with np.errstate(over="ignore"):
            for b in batches:
                out: list[list] = [[] for _ in range(4)]
                for t in b.column(1):
                    raw = t.as_buffer().to_pybytes()
                    words = raw.split()
                    u = n = np.zeros(0, np.int64)
                    if len(words) >= window:
                        g, at = anchors(raw, window)
                        u, n = np.unique(g[np.unique(at)], return_counts=True)
                    for c, x in zip(out, (len(words), _digest(words), u, np.minimum(n, 2).astype(np.int8))):
                        c.append(x)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(2), pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()),
                     pa.array(out[2], pa.list_(pa.int64())), pa.array(out[3], pa.list_(pa.int8()))],
                    names=["doc_id", "key", "n_words", "digest", "anchors", "times"])

    return _identified(docs).select("doc_id", "t", "key").mapInArrow(
        scan, "doc_id long, key long, n_words long, digest string, anchors array<long>, times array<tinyint>")


def _segments(candidates: DataFrame, window: int, flush: int = 100_000) -> DataFrame:
    """Two kinds of rows: each occurrence (doc_id, key, start, id) of a recurring anchor's segment, the words of
    all its windows; and each distinct segment (id, anchor, segment, n), once a task and flush, with its count."""
    def cut(batches):
        from xxhash import xxh3_128_digest
        seen: dict[bytes, list] = {}

        def distinct():
            cols = list(zip(*((i, *v) for i, v in seen.items()))) or [(), (), (), ()]
            none = [None] * len(seen)
            return _rows(none, none, none, *cols)

        with np.errstate(over="ignore"):
            for b in batches:
                rows: list[list] = [[] for _ in range(4)]
                for d, k, t, again in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3)):
                    raw = t.as_buffer().to_pybytes()
                    words = raw.split()
                    if len(words) < window:
                        continue
                    g, at = anchors(raw, window)
                    first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
                    last = np.append(first[1:], len(at)) - 1
                    code = g[at[first]]
                    wanted = np.isin(code, np.array(again.as_py(), np.int64))
                    for s, e, a in zip(first[wanted].tolist(), last[wanted].tolist(), code[wanted].tolist()):
                        text = b" ".join(words[s:e + window])
                        i = xxh3_128_digest(text)
                        if i in seen:
                            seen[i][2] += 1
                        else:
                            seen[i] = [a, text, 1]
                        for c, x in zip(rows, (d, k, s, i)):
                            c.append(x)
                none = [None] * len(rows[0])
                yield _rows(*rows, none, none, none)
                if len(seen) >= flush:
                    yield distinct()
                    seen.clear()
        yield distinct()

    return candidates.select("doc_id", "key", "t", "again").mapInArrow(
        cut, "doc_id long, key long, start int, id binary, anchor long, segment binary, n long")


def _rows(*cols) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.binary(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                      names=["doc_id", "key", "start", "id", "anchor", "segment", "n"])


def _runs(places, window: int) -> list[tuple[int, int]]:
    """(first word, end) of each run of neighbouring windows."""
    p = np.sort(np.array(places))
    return [(int(r[0]), int(r[-1]) + window) for r in np.split(p, np.flatnonzero(np.diff(p) > 1) + 1)]


def _found(ids: list, spans: list) -> pa.Table:
    return pa.table([pa.array(ids, pa.binary()),
                     pa.array([[{"s": s, "e": e} for s, e in x] for x in spans],
                              pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())])))], names=["id", "spans"])


def _confirm_and_locate(window: int):
    """For a shard of distinct segments with all segments of its anchors: count its windows, compile an
    automaton of the confirmed phrases, stream the segments through it."""
    def run(group):
        texts: dict[bytes, list] = {}
        for i, t, n in zip(*(group.column(c).to_pylist() for c in ("id", "segment", "n"))):
            if i in texts:
                texts[i][1] += n
            else:
                texts[i] = [t, n]
        count: dict[bytes, int] = {}
        cuts = []
        for t, n in texts.values():
            ends = [-1] + [k for k, c in enumerate(t) if c == 32] + [len(t)]
            mine = [t[ends[k] + 1:ends[k + window]] for k in range(len(ends) - window)]
            cuts.append(mine)
            for w in mine:
                count[w] = count.get(w, 0) + n
        phrases = set()
        for (t, _), mine in zip(texts.values(), cuts):
            places = [k for k, w in enumerate(mine) if count[w] > 1]
            if places:
                words = t.split(b" ")
                phrases |= {b" ".join(words[s:e]) for s, e in _runs(places, window)}
        del cuts, count
        if not phrases:
            return _found([], [])
        automaton, numbers = automaton_of(sorted(phrases))
        hits = [(i, x) for i, (t, _) in texts.items() if (x := occurrences(automaton, numbers, t.split(b" ")))]
        return _found([i for i, _ in hits], [x for _, x in hits])
    return run


def _windows(distinct: DataFrame, window: int) -> DataFrame:
    """(id, at, code, n): every window of the distinct segments, by a 64-bit hash of its words."""
    def cut(batches):
        from xxhash import xxh3_64_intdigest
        for b in batches:
            for i in range(0, b.num_rows, 4096):
                part = b.slice(i, 4096)
                ids, places, codes, counts = [], [], [], []
                for d, s, n in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).to_pylist()):
                    ends = [-1] + [k for k, c in enumerate(s) if c == 32] + [len(s)]
                    for k in range(len(ends) - window):
                        ids.append(d)
                        places.append(k)
                        codes.append(xxh3_64_intdigest(s[ends[k] + 1:ends[k + window]]))
                        counts.append(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.binary()), pa.array(places, pa.int32()),
                     pa.array(np.array(codes, np.uint64).view(np.int64)), pa.array(counts, pa.int64())],
                    names=["id", "at", "code", "n"])

    return distinct.select("id", "segment", "n").mapInArrow(cut, "id binary, at int, code long, n long")


def _phrases(confirmed: DataFrame, window: int) -> DataFrame:
    """(anchor, phrase): each run of recurring windows of a distinct segment, once."""
    def cut(batches):
        for b in batches:
            rows: list[list] = [[], []]
            for a, s, places in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                words = s.split(b" ")
                for x, y in _runs(places, window):
                    rows[0].append(a)
                    rows[1].append(b" ".join(words[x:y]))
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.binary())],
                                             names=["anchor", "phrase"])

    return confirmed.select("anchor", "segment", "places").mapInArrow(cut, "anchor long, phrase binary").distinct()


def automaton_of(phrases: list[bytes]):
    """An Aho-Corasick automaton over word numbers, and the numbers."""
    import ahocorasick
    numbers: dict[bytes, int] = {}
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for p in phrases:
        key = tuple(numbers.setdefault(w, len(numbers) + 1) for w in p.split(b" "))
        automaton.add_word(key, len(key))
    automaton.make_automaton()
    return automaton, numbers


def occurrences(automaton, numbers: dict[bytes, int], words: list[bytes]) -> list[tuple[int, int]]:
    """Merged (start, end) word places that phrases cover."""
    get, spans = numbers.get, []
    for end, size in automaton.iter(tuple(get(w, 0) for w in words)):
        s, e = end - size + 1, end + 1
        while spans and spans[-1][1] >= s:
            s = min(s, spans.pop()[0])
        spans.append((s, e))
    return spans


def _hot_spans(segs: DataFrame, window: int, hot_segments: int) -> DataFrame:
    """(id, spans) for anchors with too many distinct segments for one task: windows are counted by key over
    all tasks, and the segments of an anchor stream in salted parts through the automaton of its phrases."""
    spark = segs.sparkSession
    distinct = written(spark, segs.groupBy("id").agg(F.first("anchor").alias("anchor"), F.first("segment").alias("segment"),
                                                     F.sum("n").alias("n")), "repeat-hot")
    windows = _windows(distinct, window)
    recurring = windows.groupBy("code").agg(F.sum("n").alias("n")).where("n > 1").select("code")
    places = windows.join(recurring, "code").groupBy("id").agg(F.collect_list("at").alias("places"))
    phrases = _phrases(distinct.join(places, "id"), window)
    salts = distinct.groupBy("anchor").agg(F.ceil(F.count("*") / hot_segments).cast("int").alias("salts"))
    own = distinct.join(salts, "anchor").withColumn("salt", F.pmod(F.xxhash64("id"), "salts").cast("int"))
    spread = (phrases.join(salts, "anchor").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))))

    def locate(left, right):
        if not left.num_rows:
            return _found([], [])
        automaton, numbers = automaton_of(left.column("phrase").to_pylist())
        hits = [(i, x) for i, t in zip(right.column("id").to_pylist(), right.column("segment").to_pylist())
                if (x := occurrences(automaton, numbers, t.split(b" ")))]
        return _found([i for i, _ in hits], [x for _, x in hits])

    return (spread.select("anchor", "salt", "phrase").groupBy("anchor", "salt")
            .cogroup(own.select("anchor", "salt", "id", "segment").groupBy("anchor", "salt"))
            .applyInArrow(locate, SPANS))


SPANS = "id binary, spans array<struct<s:int,e:int>>"


def covered(docs: DataFrame, window: int = 35, shard_bytes: int = 6 << 20, hot_segments: int = 20_000):
    """(scan, candidates, spans): every document's scan row; those with a recurring anchor, with text;
    and the places of recurring windows as (doc_id, key, spans)."""
    spark = docs.sparkSession
    scanned = written(spark, _scan(docs, window), "repeat-scan")
    one = F.explode(F.arrays_zip("anchors", "times")).alias("x")
    each = scanned.where(F.size("anchors") > 0).select("doc_id", "key", one).select(
        "doc_id", "key", F.col("x.anchors").alias("anchor"), F.col("x.times").alias("times"))
    often = each.groupBy("anchor").agg(F.sum("times").alias("n")).where("n > 1").select("anchor")
    again = written(spark, each.join(often, "anchor").groupBy("key", "doc_id").agg(F.collect_set("anchor").alias("again")),
                    "repeat-anchors")
    d, a = _identified(docs).alias("d"), again.alias("a")
    candidates = written(spark, d.join(a, (F.col("d.key") == F.col("a.key")) & F.col("d.doc_id").eqNullSafe(F.col("a.doc_id")))
                         .select("d.doc_id", "d.key", "d.t", "a.again"), "repeat-candidates")
    segments = written(spark, _segments(candidates, window), "repeat-segments")
    segs = segments.where("n IS NOT NULL").select("id", "anchor", "segment", "n")
    size = segs.agg(F.sum(F.octet_length("segment")).alias("b")).first()["b"] or 0
    # Whole anchors share a shard; an anchor beyond hot_segments would be too much for one, and goes the other way.
    hot = written(spark, segs.groupBy("anchor").agg(F.count("*").alias("rows")).where(F.col("rows") > hot_segments).select("anchor"),
                  "repeat-hot-anchors")
    shard = F.pmod(F.xxhash64("anchor"), F.lit(int(size // shard_bytes) + 1)).alias("shard")
    locate = _confirm_and_locate(window)
    spans = (segs.join(hot, "anchor", "left_anti").select(shard, "id", "segment", "n")
             .groupBy("shard").applyInArrow(lambda group: locate(group), SPANS))
    if not hot.isEmpty():
        spans = spans.unionByName(_hot_spans(segs.join(hot, "anchor", "left_semi"), window, hot_segments))
    spans = written(spark, spans, "repeat-spans")
    found = (segments.where("n IS NULL").select("doc_id", "key", "start", "id").join(spans, "id")
             .select("doc_id", "key", F.transform("spans", lambda x: F.struct(
                 (x["s"] + F.col("start")).alias("start"), (x["e"] + F.col("start")).alias("end"))).alias("spans")))
    return scanned, candidates, found.groupBy("key", "doc_id").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def repeats(docs: DataFrame, window: int = 35, with_text: bool = False, **options) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and, if asked for, the kept words of documents that lost some)."""
    scanned, candidates, spans = covered(docs, window, **options)
    c, s = candidates.alias("c"), spans.alias("s")
    touched = (c.join(s, (F.col("c.key") == F.col("s.key")) & F.col("c.doc_id").eqNullSafe(F.col("s.doc_id")))
               .select("c.doc_id", "c.key", "c.t", "s.spans"))

    def cut(batches):
        for b in batches:
            rows: list[list] = [[] for _ in range(3)]
            for t, ranges in zip(b.column(2), b.column(3).to_pylist()):
                words = t.as_buffer().to_pybytes().split()
                gone = np.zeros(len(words), bool)
                for r in ranges:
                    gone[r["start"]:r["end"]] = True
                kept = [words[i] for i in np.flatnonzero(~gone)]
                for col, v in zip(rows, (int(gone.sum()), _digest(kept), b" ".join(kept) if with_text else None)):
                    col.append(v)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(rows[0], pa.int64()),
                                              pa.array(rows[1], pa.string()), pa.array(rows[2], pa.binary())],
                                             names=["doc_id", "key", "n_removed", "kept", "text"])

    # Repeated rows lose the same words; one row of each stands for all.
    cut_rows = (touched.mapInArrow(cut, "doc_id long, key long, n_removed long, kept string, text binary")
                .dropDuplicates(["doc_id", "key"]))
    a, r = scanned.drop("anchors", "times").alias("a"), cut_rows.alias("r")
    return (a.join(r, (F.col("a.key") == F.col("r.key")) & F.col("a.doc_id").eqNullSafe(F.col("r.doc_id")), "left")
            .select("a.doc_id", "a.n_words", F.coalesce("r.n_removed", F.lit(0)).alias("n_removed"),
                    F.coalesce("r.kept", "a.digest").alias("kept_sha256"),
                    *([F.col("r.text").cast("string").alias("kept_text")] if with_text else [])))


def substring_dedup_query(docs: DataFrame) -> DataFrame:
    return repeats(docs)
