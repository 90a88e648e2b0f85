"""Operator 2, toxicity: Levenshtein automata intersected with a lexicon trie,
context-window scores, and a logistic model over both.

The lexicon is learned from labelled rows (at most ``max_labels``, the documented
bound of the sample; chosen by a hash of the id, all of them below the bound):
words that stand in toxic documents far more often than chance allows, in
several different contexts, so that copies of one document prove nothing. Many
such words with one beginning become a stem. Each word of a text (for a stem, its
beginning) is matched against the trie of the lexicon within one edit (two from
eight letters of the entry on);
misspellings that clean training documents use as well are not hits. A hit counts
less in a quotation or a report of speech and more in an address.

Defined cases: a null or empty text has no hits and gets the score of such texts;
null doc_ids count as the id '' when the held-out part is chosen and have no
label; of repeated labels the largest holds; repeated documents are scored one by
one; without labels of both kinds the score is the share of toxic labels, 0
without any; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kerbflow.llm.common import Shared, remainder, slices, small_batches, worker_freed, worker_held, written

_WORD = re.compile(r"[^\W_]+")
_QUOTES = re.compile("[\"«»“”„]")
# Cues of reported speech and of address in the four languages.
REPORTS = frozenset("said says wrote called quoted quote according dit disait écrit citation selon sagte schrieb nannte "
                    "zitat laut dijo escribió llamó cita según".split())
ADDRESS = frozenset("you your youre tu toi vous votre du dich dir ihr sie tú usted ustedes vosotros".split())
FEATURES = ("exact", "fuzzy", "density", "strongest", "quoted")


def edits_of(entry: str, fixed: bool = False) -> int:
    """Edits within which a word (for a stem, its beginning) is a misspelling; a fixed entry must stand as it is."""
    return 0 if fixed or len(entry) < 4 else 1 if len(entry) < 8 else 2


class LexiconTrie:
    """Terms and stems in one trie; ``match`` runs a word's Levenshtein automaton over it.

    A state of the automaton is (place in the word, edits so far); a node of the
    trie is left as soon as its state set is empty. A stem matches every word that
    begins like it (with ``stem_edits``, also with a misspelt beginning), a term only
    whole words. A word (its beginning) within k edits of an entry has
    one of the entry's k + 1 parts unchanged, at most k places off: only entries
    with such a part (and a fitting length) are looked at.
    """

    def __init__(self, terms, stems, stem_edits: bool = False):
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[int] = [-1]                  # edits allowed where a term ends here
        self.stem_ends: list[int] = [-1]
        self.under: list[int] = [0]                  # entries (bits) below the node
        self.parts: dict[tuple[int, int, int], dict[str, int]] = {}      # (edits, place, length) -> part -> entries
        entries = [(t, False, edits_of(t)) for t in terms] + [(s, True, edits_of(s, not stem_edits)) for s in stems]
        for bit, (entry, is_stem, k) in enumerate(entries):
            node = 0
            self.under[0] |= 1 << bit
            for ch in entry:
                if ch not in self.children[node]:
                    self.children[node][ch] = len(self.children)
                    self.children.append({})
                    self.ends.append(-1)
                    self.stem_ends.append(-1)
                    self.under.append(0)
                node = self.children[node][ch]
                self.under[node] |= 1 << bit
            (self.stem_ends if is_stem else self.ends)[node] = k
            for i in range(k + 1):
                x, y = i * len(entry) // (k + 1), (i + 1) * len(entry) // (k + 1)
                found = self.parts.setdefault((k, x, y - x), {})
                found[entry[x:y]] = found.get(entry[x:y], 0) | 1 << bit
        self.most = max((k for _, _, k in entries), default=-1)
        self.entries = entries
        self.fits: dict[int, int] = {}
        # All parts with their places as one pattern: most words end here.
        ways = [f".{{{max(0, x - k)},{x + k}}}(?:{'|'.join(map(re.escape, sorted(found)))})"
                for (k, x, _), found in sorted(self.parts.items())]
        self.maybe = re.compile("|".join(ways), re.S).match if ways else (lambda w: None)

    def _fitting(self, n: int) -> int:
        """Entries that a word of ``n`` letters can match by length."""
        if n not in self.fits:
            self.fits[n] = sum(1 << i for i, (e, is_stem, k) in enumerate(self.entries)
                               if n >= len(e) - k and (is_stem or n <= len(e) + k))
        return self.fits[n]

    def candidates(self, word: str) -> int:
        n, mask = len(word), 0
        if not self.maybe(word):
            return 0
        for (k, x, size), found in self.parts.items():
            for p in range(max(0, x - k), min(x + k, n - size) + 1):
                mask |= found.get(word[p:p + size], 0)
        return mask & self._fitting(n) if mask else 0

    def match(self, word: str) -> int | None:
        """Least edits to any entry, or None."""
        mask = self.candidates(word)
        if not mask:
            return None
        best, n, most = None, len(word), self.most

        def spread(states: dict[int, int]) -> dict[int, int]:
            for i in sorted(states):                              # letters of the word that the entry lacks
                e, j = states[i], i
                while j < n and e < most and states.get(j + 1, 99) > e + 1:
                    e, j = e + 1, j + 1
                    states[j] = e
            return states

        todo = [(0, spread({0: 0}))]
        while todo:
            node, states = todo.pop()
            e = states.get(n, 99)
            if e <= self.ends[node] and (best is None or e < best):
                best = e
            low = min(states.values())
            if low <= self.stem_ends[node] and (best is None or low < best):
                best = low
            for ch, child in self.children[node].items():
                if not self.under[child] & mask:
                    continue
                after: dict[int, int] = {}
                for i, e in states.items():
                    if i < n and word[i] == ch:
                        if after.get(i + 1, 99) > e:
                            after[i + 1] = e
                    elif e < most and i < n and after.get(i + 1, 99) > e + 1:
                        after[i + 1] = e + 1                      # another letter
                    if e < most and after.get(i, 99) > e + 1:
                        after[i] = e + 1                          # the entry has a letter more
                if after:
                    todo.append((child, spread(after)))
        return best


class Matcher:
    """Words to hits, remembered: 0 none, 1 a term as it stands, 2 a misspelling."""

    def __init__(self, terms, stems, benign, limit: int = 300_000):
        self.trie, self.benign, self.limit = LexiconTrie(terms, stems, stem_edits=True), benign, limit
        self.seen: set[str] = set()
        self.hits: dict[str, int] = {}

    def found(self, words: list[str]) -> set[str]:
        kinds = set(words)
        new = kinds - self.seen
        if new:
            if len(self.seen) > self.limit:
                self.seen, self.hits, new = set(), {}, kinds
            for w in new:
                e = self.trie.match(w)
                if e == 0 or e is not None and w not in self.benign:
                    self.hits[w] = 1 if e == 0 else 2
            self.seen |= new
        return kinds & self.hits.keys()


def features(text: str | None, matcher: Matcher, window: int = 8) -> tuple[tuple[float, ...], list[tuple[int, int, float]]]:
    """The document's features, and its hits as (start, end, weight in context)."""
    low = (text or "").lower()
    words = _WORD.findall(low)
    found = matcher.found(words)
    if not found:
        return (0.0,) * len(FEATURES), []
    spans = [m.span() for m in _WORD.finditer(low)]
    marks = [m.start() for m in _QUOTES.finditer(low)]
    lines = [0, *(m.end() for m in re.finditer("\n", low))]
    exact = fuzzy = strongest = quoted = 0.0
    out = []
    for i, w in enumerate(words):
        if w not in found:
            continue
        s, e = spans[i]
        line = lines[np.searchsorted(lines, s, "right") - 1]
        inside = (np.searchsorted(marks, s) - np.searchsorted(marks, line)) % 2 == 1
        near = set(words[max(0, i - window):i + window + 1])
        weight = (0.3 if inside else 0.6 if near & REPORTS else 1.0) + (0.3 if near & ADDRESS else 0.0)
        quoted += inside
        if matcher.hits[w] == 1:
            exact += weight
        else:
            fuzzy += weight
        strongest = max(strongest, weight)
        out.append((s, e, weight))
    return (math.log1p(exact), math.log1p(fuzzy), min(1.0, 10 * (exact + fuzzy) / len(words)), strongest,
            quoted / len(out)), out


def _word_counts(train: DataFrame) -> DataFrame:
    """(word, pos, neg): toxic and clean training documents with the word."""
    def count(batches):
        pos, neg = Counter(), Counter()

        def rows():
            words = list(pos.keys() | neg.keys())
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([pos[w] for w in words], pa.int64()),
                                               pa.array([neg[w] for w in words], pa.int64())], names=["word", "pos", "neg"])
        worker_freed()
        for b in slices(batches):
            for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                (pos if y else neg).update(set(_WORD.findall(t.lower())))
            if len(pos) + len(neg) > 300_000:
                yield rows()
                pos.clear()
                neg.clear()
        if pos or neg:
            yield rows()

    return (train.select("text", "toxic").mapInArrow(count, "word string, pos long, neg long")
            .groupBy("word").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))


def _surprise(n_pos: int, n_neg: int):
    """Log-likelihood ratio (G squared) of an entry's toxic share against the base share."""
    base = n_pos / (n_pos + n_neg)
    n = F.col("pos") + F.col("neg")
    part = lambda k, share: F.when(k > 0, k * F.log(k / (n * share))).otherwise(0.0)
    return 2 * (part(F.col("pos"), base) + part(F.col("neg"), 1 - base))


def learn_lexicon(train: DataFrame, n_pos: int, n_neg: int, min_surprise: float = 30.0, min_share: float = 0.9,
                  min_contexts: int = 4, max_candidates: int = 20_000, max_entries: int = 2_000,
                  stem_words: int = 5) -> tuple[list[str], list[str], list[str]]:
    """Terms, stems and benign near-misses, from a written table (text, toxic)."""
    spark = train.sparkSession
    words = written(spark, _word_counts(train), "toxic-words")
    starts = (words.where("pos > 0 OR neg > 0")
              .select(F.explode(F.transform(F.sequence(F.lit(4), F.greatest(F.lit(4), F.least(F.length("word"), F.lit(12)))),
                                            lambda k: F.substr(F.col("word"), F.lit(1), k))).alias("entry"), "pos", "neg")
              .where(F.length("entry") >= 4).groupBy("entry")
              .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum((F.col("pos") > 0).cast("long")).alias("kinds")))
    whole = words.where(F.length("word") >= 3).select(F.col("word").alias("entry"), "pos", "neg")
    unusual = lambda df: (df.withColumn("g", _surprise(n_pos, n_neg))                     # noqa: E731
                          .where((F.col("g") >= min_surprise) & (F.col("pos") >= min_share * (F.col("pos") + F.col("neg"))))
                          .orderBy(F.desc("g"), "entry").limit(max_candidates))
    stems = {r.entry: r.pos for r in unusual(starts.where(F.col("kinds") >= stem_words)).collect()}
    # The longest beginning that holds (nearly) all of a shorter one's occurrences stands for it.
    kept: list[str] = []
    for s in sorted(stems, key=lambda x: (len(x), x)):
        if not any(s.startswith(k) for k in kept):
            while True:
                longer = [x for x in stems if len(x) == len(s) + 1 and x.startswith(s) and stems[x] >= 0.98 * stems[s]]
                if not longer:
                    break
                s = longer[0]
            kept.append(s)
    # A stem also finds what is within its edits of a word that begins like it; a word that allows more stays a term.
    terms = [r.entry for r in unusual(whole).collect()
             if not any(r.entry.startswith(k) and edits_of(r.entry) <= edits_of(k) for k in kept)]
    shared = Shared(spark, (frozenset(terms), tuple(kept)))

    def contexts(batches):
        from zlib import crc32
        words_, stems_ = shared.value
        begins = re.compile("|".join(map(re.escape, stems_))).match if stems_ else (lambda w: None)
        for b in slices(batches):
            rows = set()
            for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if y:
                    ws = ["", *_WORD.findall(t.lower()), ""]
                    for i in range(1, len(ws) - 1):
                        w = ws[i]
                        entries = [w] if w in words_ else []
                        if m := begins(w):
                            entries.append(m[0])
                        if entries:
                            c = crc32(f"{ws[i - 1]} {w} {ws[i + 1]}".encode())
                            rows.update((e, c) for e in entries)
            cols = list(zip(*rows)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64())], names=["entry", "c"])

    seen = (train.select("text", "toxic").mapInArrow(contexts, "entry string, c long").distinct().groupBy("entry").count()
            .where(F.col("count") >= min_contexts).orderBy(F.desc("count"), "entry").limit(max_entries))
    strong = {r.entry for r in seen.collect()}
    terms, stem_list = [t for t in terms if t in strong], [s for s in kept if s in strong]
    lexicon = Shared(spark, (terms, stem_list))

    def near(batches):
        trie = LexiconTrie(*lexicon.value, stem_edits=True)
        for b in batches:
            hit = [w for w in b.column(0).to_pylist() if (trie.match(w) or 0) > 0]
            yield pa.RecordBatch.from_arrays([pa.array(hit, pa.string())], names=["word"])

    benign = words.where("neg > 0").select("word").mapInArrow(near, "word string")
    return terms, stem_list, [r.word for r in benign.collect()]


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.02, rounds: int = 40) -> np.ndarray:
    """Weights and, last, the intercept, by Newton's method with a ridge per row."""
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        return np.append(np.zeros(x.shape[1]), math.log(max(share, 1e-9) / max(1 - share, 1e-9)))
    a = np.hstack([x, np.ones((len(x), 1))])
    w, penalty = np.zeros(a.shape[1]), np.append(np.full(x.shape[1], ridge), 1e-6) * max(1.0, len(y) ** 0.5)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = a.T @ (a * (p * (1 - p) + 1e-9)[:, None]) + np.diag(penalty)
        step = np.linalg.solve(h, a.T @ (y - p) - penalty * w)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _matcher(shared) -> Matcher:
    def build():
        terms, stems, benign = shared.value
        return Matcher(terms, stems, frozenset(benign))
    return worker_held(shared.id, build)


def score(docs: DataFrame, labels: DataFrame, fold: int = 5, max_labels: int = 200_000, with_hits: bool = False,
          with_rows: bool = False) -> DataFrame:
    """doc_id, held_out, score, predicted (and the features; and hits with their places and weights; and
    ``row``, the scored row of ``docs`` with all its columns)."""
    spark = docs.sparkSession
    small_batches(spark)
    # At most max_labels rows of 12 bytes: the proven bound of this broadcast.
    sample = (labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(remainder(F.col("doc_id"), fold) != 0)
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labels))
    sample = written(spark, sample, "toxic-labels")
    train = written(spark, docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
                    .join(F.broadcast(sample), "doc_id").select("text", "toxic"), "toxic-train")
    sizes = {r.toxic: r.n for r in train.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_neg = sizes.get(0, 0)
    n_pos = sum(sizes.values()) - n_neg
    lexicon = learn_lexicon(train, n_pos, n_neg) if n_pos and n_neg else ([], [], [])
    shared = Shared(spark, lexicon)
    source = docs if with_rows else docs.select("doc_id", "text")
    id_at, text_at = source.columns.index("doc_id"), source.columns.index("text")

    def scan(batches):
        matcher = _matcher(shared)
        for b in slices(batches):
            rows = [features(t, matcher) for t in b.column(text_at).to_pylist()]
            whole = [pa.StructArray.from_arrays(b.columns, names=b.schema.names)] if with_rows else []
            hits = [[{"start": s, "end": e, "weight": w} for s, e, w in h] for _, h in rows] if with_hits else [[] for _ in rows]
            yield pa.RecordBatch.from_arrays(
                [b.column(id_at), *(pa.array([r[0][k] for r in rows], pa.float64()) for k in range(len(FEATURES))),
                 pa.array(hits, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("weight", pa.float64())]))), *whole],
                names=["doc_id", *FEATURES, "hits", *(["row"] if with_rows else [])])

    schema = "doc_id long, " + ", ".join(f"{f} double" for f in FEATURES) + ", hits array<struct<start:int,end:int,weight:double>>"
    if with_rows:
        schema = StructType.fromDDL(schema).add("row", source.schema, False)
    found = written(spark, source.mapInArrow(scan, schema), "toxic-features")
    fit = found.join(F.broadcast(sample), "doc_id").select(*FEATURES, "toxic").toArrow()
    x = np.column_stack([fit.column(f).to_numpy() for f in FEATURES])
    w = fit_logistic(x, (fit.column("toxic").to_numpy() > 0).astype(float))
    line = F.lit(float(w[-1]))
    for f, v in zip(FEATURES, w):
        line = line + F.col(f) * float(v)
    s = (1 / (1 + F.exp(-line))).alias("score")
    out = found.select("doc_id", (remainder(F.col("doc_id"), fold) == 0).alias("held_out"), s, *FEATURES,
                       *(["hits"] if with_hits else []), *(["row"] if with_rows else []))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def toxicity_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, labels).select("doc_id", "held_out", "score", "predicted", *FEATURES)
