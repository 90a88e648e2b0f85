"""Operator 8, LM scoring by a probabilistic suffix tree.

Symbols are words (A-Z lower-cased) and the end of a text. A context is a suffix of
the text before a symbol: the last three bytes of the last word (order 1), that
word (2), the last two words (3), and so on up to ``depth`` words; the start of a
text is a word, too. A context's own suffix is that of the order below. Words,
contexts and grams are told apart by 63-bit hashes. All counts are Spark
aggregates over all training documents:

* A context is tested if it stands ``min_count`` (at order 1 ``min_ending``) times or
  more.
* It stores a symbol seen ``cut`` times or more after it if the symbol's count there
  gains more than ``penalty`` nats over the suffix's distribution. Stored symbols
  have their counts less ``discount``; the rest of the mass is shared like the
  suffix's among the others:

      P(s | c) = (n(c s) - discount) / n(c) if s is stored, else e(c) P(s | suffix of c)

  At order 1, below all words that can be counted there, symbols are classes (the
  last two bytes of a word), and a class is divided by its words' shares: what a
  text ends with tells much about words too rare to be counted after it.
* Divergence test: a context is kept if the training tokens after it gain more
  than ``penalty`` nats for each of its symbols over its suffix's distribution:
  its count times the divergence, against the cost of what it stores, so more
  text keeps more contexts. The suffixes of kept contexts are kept.
* A token is scored in its longest kept context. Down the suffix chain its log
  share is the root's, plus log e of each of its kept contexts, plus a term of its
  own for each stored gram, so a text's score is a sum over what its keys find. An
  order's kept table is sent to every task while the counted rows of all tables
  sent are within ``SMALL``; those of other orders are sorted into files, which each
  Python worker maps from its own disk: no token's key is written or shuffled.

The root is the words' distribution with 0.1 added to each count, which is also
the base score. Nothing is capped: more text gives more contexts and grams.

Defined cases: a null or empty text is its end token alone; null doc_ids count
as the id '' when the held-out part is chosen; repeated rows are scored and
counted one by one; without training documents N and V are 0 and the root is
uniform; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import tempfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbflow.llm import files
from kerbflow.llm.common import Shared, remainder, text_bytes, worker_held, written
from kerbflow.session import scratch_path

END, START = 0x452821E638D01377, 0x3E4C89452821E638      # hashes of the end and the start of a text
ROOT = 0x243F6A8885A308D3       # the context of no words
ENDINGS = 0x13198A2E03707344    # what the contexts of order 1 are mixed with
GRAMS = 0x24A4093822299F31      # what tells a gram's key from a context's
SMALL = 4_000_000               # rows of 16 bytes that may be sent to every task
CHUNK = 2_000_000               # tokens that a task counts before it passes counts on
BLOCK = 2_000_000               # rows of a larger table in a file
_MASK = np.int64(2 ** 63 - 1)


def mix(word, context):
    """The hash of a context from its last word and the context before that; a gram's from its symbol and context."""
    x = np.asarray(context).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.asarray(word).astype(np.uint64)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return (x ^ (x >> np.uint64(32))).astype(np.int64) & _MASK


def gram_key(symbol, context):
    """The hash under which a context's stored symbol is looked up; never that of the context one word longer."""
    return mix(symbol, np.asarray(context) ^ np.int64(GRAMS))


def _powers() -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.full(256, 0x9E3779B97F4A7C15, dtype=np.uint64))


_LOWER = np.array([32 if 9 <= c <= 13 else c + 32 if 65 <= c <= 90 else c for c in range(256)], dtype=np.uint8)
_POWERS = _powers()
_VALUE = np.where(np.arange(256) == 32, 0, np.arange(1, 257)).astype(np.uint64)
START_TAIL, END_TAIL = 0x0A0A0A, 0x0A200A           # no word holds a line's end


def _bounds(texts) -> np.ndarray:
    """Where each text starts in the array's bytes, and where the last one ends."""
    kind = np.int64 if pa.types.is_large_binary(texts.type) else np.int32
    return np.frombuffer(texts.buffers()[1], kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)


def _pieces(batch, most: int = 1 << 19):
    """Slices of a batch of about ``most`` bytes of text (a longer text is one by itself)."""
    ends, at = _bounds(batch.column("t")), 0
    while at < batch.num_rows:
        n = max(1, int(np.searchsorted(ends, ends[at] + most, side="right")) - 1 - at)
        yield batch.slice(at, n)
        at += n


class Tokens:
    """The tokens of some texts: hashes and tails with a START before each text, places of the tokens, tokens by text.

    A word is a run without white space; its hash is a polynomial of its bytes, all computed over the texts' bytes at once.
    """

    def __init__(self, texts):
        bounds, data = _bounds(texts), texts.buffers()[2]
        raw = _LOWER[np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]]] if bounds[-1] > bounds[0] else np.zeros(0, np.uint8)
        bounds = bounds - bounds[0]
        inside = raw != 32
        edge = np.zeros(len(raw) + 1, dtype=bool)
        edge[bounds] = True                                                   # words end where texts do
        starts = np.flatnonzero(inside & (edge[:-1] | np.concatenate([[True], ~inside[:-1]])))
        ends = np.flatnonzero(inside & (edge[1:] | np.concatenate([~inside[1:], [True]]))) + 1
        if len(starts):
            first, body = starts - starts[0], raw[starts[0]:]
            lengths = np.diff(np.append(first, len(body)))                    # with the white space after a word
            letter = np.arange(len(body)) - np.repeat(first, lengths)
            value = _VALUE[body]
            if lengths.max() > 256:
                value += np.where(value > 0, (letter >> 8).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93), np.uint64(0))
                letter &= 255
            value *= _POWERS[letter]
            hashes = mix(np.add.reduceat(value, first), ends - starts)
        else:
            hashes = np.zeros(0, np.int64)
        back = lambda k: np.where(ends - starts >= k, raw[np.maximum(ends - k, 0)], 32).astype(np.int64)       # noqa: E731
        tails = back(1) | back(2) << 8 | back(3) << 16 if len(starts) else hashes
        words = np.diff(np.searchsorted(starts, bounds))
        self.sizes = words + 1
        self.starts = np.cumsum(self.sizes + 1) - self.sizes - 1
        total = int(self.sizes.sum()) + len(words)
        self.flat, self.tails = np.full(total, END, dtype=np.int64), np.full(total, END_TAIL, dtype=np.int64)
        at = np.arange(len(starts)) + 2 * np.repeat(np.arange(len(words)), words) + 1
        self.flat[at], self.tails[at] = hashes, tails
        self.flat[self.starts], self.tails[self.starts] = START, START_TAIL
        places = np.ones(total, dtype=bool)
        places[self.starts] = False
        self.places = np.flatnonzero(places)
        self.symbols, self.classes = self.flat[self.places], class_of(self.tails[self.places])

    def contexts(self, orders: int) -> list[np.ndarray]:
        """For orders 1 to ``orders`` the context of every token; -1 where the text has fewer words before it."""
        before = self.places - np.repeat(self.starts, self.sizes)             # START and words before each token
        out = [ending_context(self.tails)[self.places - 1]]
        ending = mix(self.flat, ROOT)                                         # contexts that end at each place
        for words in range(1, orders):
            out.append(np.where(before >= words, ending[self.places - 1], -1))
            if words < orders - 1:
                ending = mix(self.flat, np.concatenate([[0], ending[:-1]]))
        return out


def class_of(tails):
    return tails & 0xFFFF


def ending_context(tails) -> np.ndarray:
    """Contexts of order 1."""
    return mix(tails, ENDINGS)


class KeyTable:
    """63-bit hashes, sorted, with a value each; their first bits lead to the few keys that share them."""

    def __init__(self, keys: np.ndarray, values: np.ndarray | None = None):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], None if values is None else values[order]
        bits = max(1, len(keys).bit_length() + 1)
        self.shift = np.int64(63 - bits)
        self.start = np.searchsorted(self.keys >> self.shift, np.arange((1 << bits) + 1)).astype(np.int32)

    def places(self, asked: np.ndarray) -> np.ndarray:
        """Where each asked key (0 or more) is; -1 if it is not here."""
        out = np.full(len(asked), -1, dtype=np.int64)
        first = asked >> self.shift
        at, end = self.start[first], self.start[first + 1]
        todo = np.flatnonzero(at < end)
        at, end = at[todo], end[todo]
        while len(todo):
            hit = self.keys[at] == asked[todo]
            out[todo[hit]] = at[hit]
            more = ~hit & (at + 1 < end)
            todo, at, end = todo[more], at[more] + 1, end[more]
        return out

    def find(self, asked: np.ndarray):
        """(which are here, the values of those)."""
        at = self.places(asked)
        here = at >= 0
        return here, self.values[at[here]]


def sorted_files(df: DataFrame, name: str) -> list[tuple[int, str]]:
    """(key, value) as files of ``BLOCK`` rows or so, all keys in order: (rows, URI) of each."""
    folder = scratch_path(df.sparkSession, name)
    parts = max(1, -(-df.count() // BLOCK))
    dealt = df.select("key", F.col("value").cast("float")).repartitionByRange(parts, "key").sortWithinPartitions("key")

    def put(batches):
        cols = [[b.column(k).to_numpy() for k in (0, 1)] for b in batches if b.num_rows]
        if cols:
            keys, values = (np.concatenate(c) for c in zip(*cols))
            yield pa.RecordBatch.from_pydict({"first": keys[:1], "n": [len(keys)], "uri": [files.new_file(folder, "keys", ".bin", [keys.tobytes(), values.tobytes()])]})

    return [(r["n"], r["uri"]) for r in sorted(dealt.mapInArrow(put, "first long, n long, uri string").collect(), key=lambda r: r["first"])]


class MappedTable(KeyTable):
    """A table of ``sorted_files``, copied to a file of this worker that has no name and goes with it, and mapped: what is
    asked for stays in memory while there is room, as pages of a file."""

    def __init__(self, blocks: list[tuple[int, str]]):
        n = sum(size for size, _ in blocks)
        self.keys, self.values = self._room(n, np.int64), self._room(n, np.float32)
        at = 0
        for size, uri in blocks:
            data = files.read_file(uri)
            self.keys[at:at + size] = np.frombuffer(data, np.int64, size)
            self.values[at:at + size] = np.frombuffer(data, np.float32, size, 8 * size)
            at += size
        bits = max(1, n.bit_length() - 1)
        self.shift = np.int64(63 - bits)
        self.start = self._room((1 << bits) + 1, np.int64 if n >= 1 << 31 else np.int32)
        for first in range(0, 1 << bits, BLOCK):
            prefixes = np.arange(first, min(first + BLOCK, 1 << bits))
            self.start[prefixes] = np.searchsorted(self.keys, prefixes << self.shift)
        self.start[1 << bits] = n

    @staticmethod
    def _room(n: int, kind) -> np.ndarray:
        with tempfile.TemporaryFile() as f:
            return np.asarray(np.memmap(f, kind, "w+", shape=(n,))) if n else np.zeros(0, kind)


def _counted(rows: DataFrame, columns: str, take) -> DataFrame:
    """Rows of ``take(Tokens)`` (equal arrays, named by ``columns``) and how often (n) each stands in the texts ``t``.

    Tasks count ``CHUNK`` of them at a time before Spark adds the counts.
    """
    names = columns.split()

    def count(batches):
        held, n = [], 0
        for b in batches:
            for part in _pieces(b):
                held.append(take(Tokens(part.column("t"))))
                n += len(held[-1][0])
                if n >= CHUNK:
                    yield counted(held)
                    held, n = [], 0
        if held:
            yield counted(held)

    def counted(held):
        cols = [np.concatenate(x) for x in zip(*held)]
        key = mix(cols[1], cols[0])
        order = np.argsort(key)
        key = key[order]
        at = np.flatnonzero(np.concatenate([np.ones(min(1, len(key)), dtype=bool), key[1:] != key[:-1]]))
        first, n = order[at], np.diff(np.append(at, len(key)))
        return pa.RecordBatch.from_arrays([*(pa.array(c[first]) for c in cols), pa.array(n.astype(np.int64))], names=[*names, "n"])

    return (rows.select("t").mapInArrow(count, ", ".join(f"{c} long" for c in [*names, "n"]))
            .groupBy(*names).agg(F.sum("n").alias("n")))


def count_words(rows: DataFrame) -> DataFrame:
    """(sym, tail, c): how often each word and the end stand in the texts."""
    return _counted(rows, "sym tail", lambda x: (x.symbols, x.tails[x.places])).withColumnRenamed("n", "c")


def count_grams(rows: DataFrame, order: int, candidates: Shared | None) -> DataFrame:
    """(ctx, sym, n) of one order; ``candidates`` (if it is given) holds the contexts that can reach the least count."""
    def take(x: Tokens):
        ctx = x.contexts(order)[-1]
        fine = ctx >= 0
        if candidates is not None:
            fine[fine] = worker_held(candidates.id, lambda: KeyTable(candidates.value)).places(ctx[fine]) >= 0
        return ctx[fine], (x.classes if order == 1 else x.symbols)[fine]
    return _counted(rows, "ctx sym", take)


def _mapped(df: DataFrame, columns: str, compute) -> DataFrame:
    """Columns computed in numpy from those of ``df``."""
    names = columns.split()

    def apply(batches):
        for b in batches:
            cols = compute({c: b.column(c).to_numpy() for c in b.schema.names})
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=names)
    return df.mapInArrow(apply, ", ".join(f"{c} {'double' if c == 'value' else 'long'}" for c in names))


def _few(df: DataFrame, bound: int = SMALL) -> DataFrame:
    """``df`` to be broadcast if it has been written and its counted rows are within the bound."""
    return F.broadcast(df) if df.count() <= bound else df


def learn(rows: DataFrame, words: DataFrame, n_train: int, v: int, depth: int, min_ending: int, min_count: int, cut: int,
          discount: float, penalty: float):
    """[(order, (key, value, state))] of the kept contexts (log10 e) and their stored grams (log10 of what they add), written."""
    spark, texts, scale = rows.sparkSession, rows.count(), n_train + 0.1 * (v + 1)
    heads = words.where(F.col("sym") != END).select("sym", "tail", "c").unionByName(
        spark.createDataFrame([(START, START_TAIL, texts)], "sym long, tail long, c long"))
    share = F.log((F.col("c") + 0.1) / scale)
    classes = (words.groupBy(class_of_column(F.col("tail")).alias("sym"))
               .agg(F.log(F.sum(F.col("c") + 0.1) / scale).alias("low")).withColumn("root", F.col("low")))
    known = words.where(F.col("c") >= cut).select("sym", class_of_column(F.col("tail")).alias("class"), share.alias("root"))

    tables = []
    for order in range(1, depth + 2):
        if order == 1:
            level = _mapped(heads.groupBy("tail").agg(F.sum("c").alias("n")).where(F.col("n") >= min_ending), "ctx suffix total",
                            lambda x: (ending_context(x["tail"]), np.full(len(x["n"]), ROOT), x["n"]))
        elif order == 2:
            level = _mapped(heads.where(F.col("c") >= min_count), "ctx suffix total",
                            lambda x: (mix(x["sym"], ROOT), ending_context(x["tail"]), x["c"]))
        else:
            # One word longer: what came after a context is its last word now, and the suffix grows by it as well.
            longer = tables[-1][0].where((F.col("n") >= min_count) & (F.col("sym") != END))
            level = _mapped(longer.select("ctx", "suffix", "sym", "n"), "ctx suffix total",
                            lambda x, first=order == 3: (mix(x["sym"], x["ctx"]), mix(x["sym"], ROOT if first else x["suffix"]), x["n"]))
        level = written(spark, level, f"lm-candidates-{order}")
        n_level = level.count()
        if not n_level:
            break
        able = Shared(spark, level.select("ctx").toArrow().column(0).to_numpy()) if n_level <= SMALL else None
        grams = count_grams(rows, order, able).where(F.col("n") >= (min(cut, 2) if order == 1 else cut))
        if order == 1:
            found = grams.join(_few(classes), "sym")
        elif order == 2:
            found = grams.join(known, "sym")
        else:
            found = grams
        found = found.join(_few(level), "ctx")
        if order == 2:
            # The suffix's share of a word: its class's there, divided by the words' own shares.
            below, below_mass, _ = tables[-1]
            lift = below.select(F.col("ctx").alias("suffix"), F.col("sym").alias("class"), (F.col("high") - F.col("root")).alias("lift"))
            out = below_mass.select(F.col("ctx").alias("suffix"), F.col("escape").alias("out"))
            found = (found.join(_few(out), "suffix", "left").join(_few(lift), ["suffix", "class"], "left")
                     .withColumn("low", F.col("root") + F.coalesce("lift", "out", F.lit(0.0))))
        elif order > 2:
            found = found.join(tables[-1][0].select(F.col("ctx").alias("suffix"), "sym", F.col("high").alias("low"), "root"), ["suffix", "sym"])
        # The larger tables keep what can't be joined from smaller ones; shares are good to seven digits.
        own = F.col("n") * (F.log(F.col("n") / F.col("total")) - F.col("low")) > penalty
        found = written(spark, found.select("ctx", "sym", "n", F.col("low").cast("float"), F.col("root").cast("float"), own.alias("own")),
                        f"lm-grams-{order}")
        mass = (found.groupBy("ctx").agg(F.coalesce(F.sum(F.when(F.col("own"), F.col("n"))), F.lit(0)).alias("held"), F.count_if("own").alias("kinds"),
                                         F.coalesce(F.sum(F.when(F.col("own"), F.exp("low"))), F.lit(0.0)).alias("low"))
                .join(_few(level), "ctx").select("ctx", "suffix", "total", "held", "kinds", (
                    F.log((F.col("total") - F.col("held") + discount * F.col("kinds")) / F.col("total"))
                    - F.log(F.greatest(1 - F.col("low"), F.lit(1e-9)))).alias("escape")))
        mass = written(spark, mass, f"lm-mass-{order}")
        high = F.when(F.col("own"), F.log((F.col("n") - discount) / F.col("total"))).otherwise(F.col("escape") + F.col("low"))
        full = found.join(_few(mass), "ctx").withColumn("high", high)
        gain = (F.coalesce(F.sum(F.when(F.col("own"), F.col("n") * (F.col("high") - F.col("low")))), F.lit(0.0))
                + F.first((F.col("total") - F.col("held")) * F.col("escape")))
        kept = (full.groupBy("ctx").agg(gain.alias("gain"), F.first("kinds").alias("kinds"))
                .where(F.col("gain") > penalty * (F.col("kinds") + 1)).select("ctx"))
        tables.append((full, mass, kept))
    out, longer = [], None
    for order, (full, mass, kept) in reversed(list(enumerate(tables, 1))):          # a kept context's suffixes are kept
        kept = _few(written(spark, (kept if longer is None else kept.unionByName(longer)).distinct(), "lm-kept"))
        states = mass.join(kept, "ctx", "left_semi")
        longer = states.select(F.col("suffix").alias("ctx"))
        grams = full.where("own").join(kept, "ctx", "left_semi").withColumn("value", F.col("high") - F.col("low") - F.col("escape"))
        grams = _mapped(grams.select("ctx", "sym", "value"), "key value", lambda x: (gram_key(x["sym"], x["ctx"]), x["value"]))
        both = states.select(F.col("ctx").alias("key"), F.col("escape").alias("value"), F.lit(True).alias("state")).unionByName(
            grams.withColumn("state", F.lit(False)))
        out.append((order, written(spark, both.withColumn("value", F.col("value") / math.log(10)), f"lm-tree-{order}")))
    return out[::-1]


def class_of_column(tail):
    return tail.bitwiseAND(F.lit(0xFFFF))


def sent_tables(tree) -> tuple[dict, dict]:
    """{order: (states, grams)}, each as keys and values, of the orders whose tables together are within ``SMALL`` rows, and the
    other orders' as ``sorted_files``."""
    sent, mapped, rows = {}, {}, 0
    for order, df in tree:
        n = df.count()
        if rows + n <= SMALL:
            rows += n
            t = df.toArrow()
            sent[order] = tuple((part.column("key").to_numpy(), part.column("value").to_numpy().astype(np.float32))
                                for part in (t.filter(pc.equal(t.column("state"), x)) for x in (True, False)))
        else:
            mapped[order] = tuple(sorted_files(df.where(x), f"lm-sorted-{order}") for x in ("state", "NOT state"))
    return sent, mapped


def head_words(words: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent words by hash, with their counts: all with at least 2**k, for the least k that fits ``most``."""
    sizes = dict(words.groupBy(F.floor(F.log2("c")).alias("k")).agg(F.count("*").alias("n")).collect())
    n, least = 0, 63
    for k in sorted(sizes, reverse=True):
        if n + sizes[k] > most:
            break
        n, least = n + sizes[k], k
    t = words.where(F.floor(F.log2("c")) >= least).select("sym", "c").toArrow()
    return t.column("sym").to_numpy(), t.column("c").to_numpy()


def tree_gains(x: Tokens, kept: dict) -> np.ndarray:
    """What each token gains by the tables of all orders."""
    gain = np.zeros(len(x.symbols))
    todo = np.arange(len(x.symbols))                # tokens that may have a kept context of this order
    for order, ctx in enumerate(x.contexts(max(kept, default=0)) if kept else [], 1):
        symbols, (states, grams) = x.classes if order == 1 else x.symbols, kept[order]
        todo = todo[ctx[todo] >= 0]
        here, value = states.find(ctx[todo])
        todo = todo[here]                           # the suffixes of kept contexts are kept
        gain[todo] += value
        here, value = grams.find(gram_key(symbols[todo], ctx[todo]))
        gain[todo[here]] += value
    return gain


def score(docs: DataFrame, fold: int = 10, depth: int = 2, min_ending: int = 10, min_count: int = 50, cut: int = 3, discount: float = 0.75,
          penalty: float = 5.0, max_counts: int = 200_000) -> DataFrame:
    """Train on documents outside the held-out fold; score all."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", (remainder(F.col("doc_id"), fold) == 0).alias("held_out"), text_bytes(F.col("text")).alias("t"))
    train = rows.where("NOT held_out")
    words = written(spark, count_words(train), "lm-words")
    n_train, v = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    norm = math.log10(n_train + 0.1 * (v + 1))
    sent, mapped = sent_tables(learn(train, words, n_train, v, depth, min_ending, min_count, cut, discount, penalty))
    shared = Shared(spark, (sent, mapped, head_words(words, max_counts)))

    def tables():
        found, more, (sym, c) = shared.value
        kept = {k: tuple(KeyTable(*x) for x in v) for k, v in found.items()} | {k: tuple(map(MappedTable, v)) for k, v in more.items()}
        return kept, KeyTable(sym, np.log10(c + 0.1) - norm)

    def scan(batches):
        from pyspark import TaskContext
        (kept, head), row = worker_held(shared.id, tables), TaskContext.get().partitionId() << 40
        for b in batches:
            for part in _pieces(b):
                x = Tokens(part.column("t"))
                n, tokens, text = len(x.sizes), x.symbols, np.repeat(np.arange(len(x.sizes)), x.sizes)
                here, logs = head.find(tokens)
                known = np.bincount(text[here], minlength=n)
                base = np.bincount(text[here], weights=logs, minlength=n).astype(float)        # of no tokens: integers
                gain = tree_gains(x, kept)
                rest = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(np.bincount(text[~here], minlength=n))]).astype(np.int32), tokens[~here])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + n)), part.column("doc_id"), part.column("held_out"), pa.array(x.sizes),
                     pa.array(known.astype(np.int64)), pa.array(base), pa.array(np.bincount(text, weights=gain, minlength=n).astype(float)), rest],
                    names=["row", "doc_id", "held_out", "n_tokens", "head_known", "head_base", "gain", "rest"])
                row += n

    # Row numbers hold because the scan's result is written before it is read again.
    kind = dict(rows.dtypes)["doc_id"]
    out = written(spark, rows.mapInArrow(scan, f"row long, doc_id {kind}, held_out boolean, n_tokens long, head_known long, head_base double, "
                                               "gain double, rest array<long>"), "lm-scores")
    c = F.coalesce("c", F.lit(0))
    tail = (out.select("row", F.explode("rest").alias("sym")).join(words, "sym", "left").groupBy("row")
            .agg(F.sum((c > 0).cast("long")).alias("tail_known"), F.sum(F.log10(c + 0.1) - norm).alias("tail_base")))
    found, gain = out.drop("rest").join(tail, "row", "left"), F.col("gain")
    base = F.col("head_base") + F.coalesce("tail_base", F.lit(0.0))
    return found.select("doc_id", "held_out", "n_tokens", (F.col("head_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
                        F.lit(n_train).cast("long").alias("train_tokens"), base.alias("base_score"), (base + gain).alias("score"))


def suffix_tree_query(docs: DataFrame) -> DataFrame:
    return score(docs)
