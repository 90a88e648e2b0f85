"""Shared helpers of the training-data operators: table access, scratch tables
in the shared folder, word splitting and the cached word tokenizer."""

from __future__ import annotations

import gc
import re
import sys
import uuid
from array import array

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbflow.session import scratch_path

# Word separators of the contracts as a Java/RE2 character class: space and \t \n \v \f \r.
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Rows of whole texts go to Python workers a few MB at a time (Spark's own bound is 64 MB a task on both sides)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared scratch folder and read back.

    Cuts the lineage at a reliable copy: a lost executor costs only the tasks
    that were running, and later jobs over the frame don't compute it again.
    """
    path = scratch_path(spark, name)
    df.write.parquet(path)
    # Shuffle files of finished stages go when the driver collects its garbage; on disk they would add up till then.
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def free_name(name: str, columns) -> str:
    """``name``, or the first of ``name_``, ``name__``, ... that is no column yet (in any case of letters)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def remainder(doc_id, modulus: int):
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the text ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % modulus


def text_bytes(text):
    """The text as UTF-8 bytes, empty where null (Python workers split bytes faster than strings)."""
    return F.coalesce(text, F.lit("")).cast("binary")


class Shared:
    """A broadcast value with an id that is the same in every Python worker."""

    def __init__(self, spark: SparkSession, value):
        self.id = uuid.uuid4().hex
        self.broadcast = spark.sparkContext.broadcast(value)

    @property
    def value(self):
        return self.broadcast.value


def _ids(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


class _Learned(dict):
    """Words to their ids, learned when they are first asked for."""

    def __init__(self, learn):
        super().__init__()
        self.learn = learn

    def __missing__(self, word: str) -> bytes:
        ids = self[word] = self.learn(word)
        return ids


class WordIds:
    """Token ids of whole texts by a ``tokenizers`` file, through a cache of words.

    Both public BPE files treat a run of non-space characters the same wherever
    it stands (the byte-level one together with the space before it), so a text's
    ids are those of its words in order. Cuts are made only at a space or newline
    that follows a non-space character; texts with any other white space go
    through the tokenizer whole, as do texts that hold the content of an added token
    (in any case of letters, since a normaliser may change it). A word of Latin-1
    letters and ASCII marks after them is one piece and another of either pattern:
    its letters go to the BPE model directly. The cache holds two generations of
    ``limit`` bytes of words and ids, which changes speed only.

    If the space counts, a word of the cache stands for itself and a space before it;
    one after a newline has that before it, and any other piece of text a "\r", which
    no text that is split holds. Words between single spaces and newlines are cut by
    ``str.split``; the rare text with a run of them is cut again by a pattern. If the
    space does not count, a text of Latin-1 is put in lower case and its commas and full
    stops are cut off before, so that a word is learned once whatever it is followed by; a
    text where another mark comes before one of them is cut into pieces by the pattern.
    """

    _ODD = re.compile("[" + "".join(map(chr, (9, 11, 12, 13, *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                                              0x2028, 0x2029, 0x202F, 0x205F, 0x3000))) + "]")
    _KEEP_SPACE = re.compile("[ \n]*[^ \n]+|[ \n]+")
    _PLAIN = re.compile(r"([^\W\d_]+)([!-/:-@\[-`{-~]*)")
    _LOWER = bytes(range(256)).decode("latin-1").lower().replace("\n", " ").encode("latin-1")
    # Latin-1 in lower case: a run of letters, one digit, what follows an apostrophe in English, a run of marks.
    _PIECE = re.compile("[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]+|[0-9\xb2\xb3\xb9\xbc-\xbe]|'(?:[stmd]|re|ve|ll)"
                        "|[^ a-z0-9\xaa\xb2\xb3\xb5\xb9\xba\xbc-\xbe\xdf-\xf6\xf8-\xff]+")
    # Each byte as a comma or full stop, another mark, or none.
    _KIND = bytes(ord("," if c in ",." else " " if c == " " or c.isalnum() else "#") for c in map(chr, range(256)))

    def __init__(self, path: str, keeps_space: bool, limit: int = 80_000_000):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        added = [re.escape(t.content) for t in self.tok.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(added), re.I).search if added else (lambda t: None)
        self.model = self.tok.model
        self.keeps_space = keeps_space
        self.limit, self.size = limit, 0
        self.cache, self.old = _Learned(self._learn), {}
        # Byte-level BPE writes each byte as a character: printable ones as themselves, the others from 256 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [x for x in range(256) if x not in set(shown)]
        self.letters = {**{x: chr(x) for x in shown}, **{x: chr(256 + i) for i, x in enumerate(hidden)}}

    def _learn(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self._new(word)
        self.size += 180 + len(word) + len(ids)         # two objects and their place in the table
        return ids

    def _new(self, word: str) -> bytes:
        if word.isalpha() and (word.isascii() or max(word) <= "\xff"):
            return self._piece(" " + word if self.keeps_space else word.lower())
        lead, body = " " if self.keeps_space else "", word
        if self.keeps_space:
            if word in ("", "\n"):                      # a run of white space: not to be cut here
                raise KeyError(word)
            if word[0] in "\r\n":
                lead, body = word[0].strip("\r"), word[1:]
        m = self._PLAIN.fullmatch(body)
        if m and (m[1].isascii() or m[1].isalpha() and max(m[1]) <= "\xff"):
            letters, marks = m.groups()
            if marks:
                return self.cache[word[:-len(marks)]] + self.cache["\r" + marks if self.keeps_space else marks]
            return self.cache["\r\n"] + self._piece(letters) if lead == "\n" else self._piece(lead + letters)
        return _ids(self.tok.encode(lead + body, add_special_tokens=False).ids)

    def _piece(self, text: str) -> bytes:
        """Ids of one piece of the pattern, by the BPE model alone."""
        if text.isascii():
            shown = text.replace(" ", self.letters[32])
        else:
            shown = text.encode().decode("latin-1").translate(self.letters)
        return _ids([t.id for t in self.model.tokenize(shown)])

    def _split(self, text: str) -> bytes:
        ids = self.cache.__getitem__
        if not self.keeps_space:
            try:
                low = text.encode("latin-1").translate(self._LOWER)
            except UnicodeEncodeError:
                return b"".join(map(ids, text.replace("\n", " ").split(" ")))
            kinds = low.translate(self._KIND)
            if b"#," in kinds or b",," in kinds:
                return b"".join(map(ids, self._PIECE.findall(low.decode("latin-1"))))
            return b"".join(map(ids, low.replace(b",", b" ,").replace(b".", b" .").decode("latin-1").split(" ")))
        try:
            return b"".join(map(ids, ("\r" + text).replace("\n", " \n").split(" ")))
        except KeyError:
            return b"".join([ids(p[1:] if p[0] == " " and p[1:2] not in ("", " ", "\n") else "\r" + p)
                             for p in self._KEEP_SPACE.findall(text)])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        for t in texts:
            if self._ODD.search(t) or self.added(t):
                out.append(_ids(self.tok.encode(t, add_special_tokens=False).ids))
                continue
            if self.size > self.limit:
                self.old, self.cache, self.size = self.cache, _Learned(self._learn), 0
            out.append(self._split(t))
        return out


_HELD: dict = {}


def worker_held(key, build):
    """``build()``, kept in this Python worker until another operator asks for its own.

    Workers are used again by later tasks: what one operator remembers (a cache of
    words, an automaton) must not stay beside what the next one builds.
    """
    if _HELD.get("key") != key:
        worker_freed()
        _HELD.update(key=key, value=build())
    return _HELD["value"]


def worker_freed() -> None:
    """Drops what an earlier operator left in this Python worker."""
    if _HELD:
        _HELD.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()


def slices(batches, rows: int = 500):
    """Arrow batches as slices of at most ``rows`` rows: the Python texts that a task has at a time."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def word_ids(path: str, keeps_space: bool) -> WordIds:
    """One tokenizer and cache per Python worker and file."""
    import os
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return worker_held(("tokens", path, keeps_space), lambda: WordIds(path, keeps_space))
