"""Operator 6, personal data: format-preserving Feistel pseudonyms.

Values are found by shape and validated (card numbers by Luhn, IBANs by their
check digits, dates by the calendar, addresses by their octets), then permuted by
a keyed Feistel network within their format: separators, length, letter case and
check digits stay valid. The permutation depends on the key, the kind and the
size of the domain alone, so equal values get equal pseudonyms in all documents
and different values different ones. Secrets are replaced whole, whatever their
length, in chunks of at most 200 letters and digits. Dates are those of the years
1 to 9999, also before a time of day (``T10:00``); those of 1900 to 2099 are
permuted among themselves, and all others among themselves.

Defined cases: null and empty texts stay as they are; null ids pass through;
repeated rows are treated alike; an empty table gives an empty result; all other
columns are kept as they are.
"""

from __future__ import annotations

import datetime
import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbflow.llm.common import free_name, slices, small_batches, worker_freed

_DAY0 = datetime.date(1900, 1, 1).toordinal()
_DAYS = datetime.date(2100, 1, 1).toordinal() - _DAY0
_OTHER_DAYS = datetime.date.max.toordinal() - _DAYS
_CHUNK = 200
_CODE = {c: i for i, c in enumerate("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ")}


class Permutation:
    """A keyed permutation of 0 .. n-1 for any n: Feistel rounds over the least even
    number of bits that hold n, repeated until the value is below n. Domains too small
    for that to hide a value are shifted by a keyed amount that is never zero."""

    def __init__(self, key: bytes, rounds: int = 8):
        self.key, self.rounds = key, rounds

    def _round(self, tweak: bytes, i: int, half: int, mask: int) -> int:
        data = tweak + bytes([i]) + half.to_bytes(64, "big")
        return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=64).digest(), "big") & mask

    def __call__(self, x: int, n: int, tweak: str) -> int:
        t = f"{tweak}:{n}:".encode()
        if n < 2:
            return x
        if n < 4096:
            return (x + 1 + self._round(t, 255, 0, (1 << 64) - 1) % (n - 1)) % n
        w = ((n - 1).bit_length() + 1) // 2
        mask = (1 << w) - 1
        while True:
            left, right = x >> w, x & mask
            for i in range(self.rounds):
                left, right = right, left ^ self._round(t, i, right, mask)
            x = left << w | right
            if x < n:
                return x


def _permuted(chars: str, perm: Permutation, tweak: str, hexadecimal: bool = False) -> str:
    """Digits stay digits and letters letters of their case, place by place."""
    radix = [10 if c.isdigit() and not hexadecimal else 16 if hexadecimal else 26 for c in chars]
    value, n = 0, 1
    for c, r in zip(chars, radix):
        d = int(c, 16) if hexadecimal else int(c) if r == 10 else ord(c.lower()) - 97
        value, n = value * r + d, n * r
    value = perm(value, n, f"{tweak}/{''.join('x' if r == 16 else 'd' if r == 10 else 'a' for r in radix)}")
    out = []
    for c, r in zip(reversed(chars), reversed(radix)):
        value, d = divmod(value, r)
        x = f"{d:x}" if hexadecimal else str(d) if r == 10 else chr(97 + d)
        out.append(x.upper() if c.isupper() else x)
    return "".join(reversed(out))


def luhn_digit(body: str) -> str:
    total = 0
    for i, c in enumerate(reversed(body)):
        d = int(c) * (2 - i % 2)
        total += d - 9 * (d > 9)
    return str(-total % 10)


def _refill(shape: str, digits: str, is_slot=str.isdigit) -> str:
    it = iter(digits)
    return "".join(next(it) if is_slot(c) else c for c in shape)


def _card(m, perm):
    digits = re.sub(r"\D", "", m[0])
    if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1]:
        return None
    body = _permuted(digits[:-1], perm, "card")
    return _refill(m[0], body + luhn_digit(body))


def _iban_check(country: str, bban: str) -> int:
    return 98 - int("".join(str(_CODE[c]) for c in bban + country + "00")) % 97


def _iban(m, perm):
    raw = re.sub(r" ", "", m[0])
    country, check, bban = raw[:2], raw[2:4], raw[4:]
    if not 15 <= len(raw) <= 34 or _iban_check(country, bban) != int(check):
        return None
    new = _permuted(bban, perm, "iban" + country)
    return _refill(m[0], country + f"{_iban_check(country, new):02d}" + new, str.isalnum)


def _ssn(m, perm):
    a, b, c = int(m[0][:3]), int(m[0][4:6]), int(m[0][7:])
    if a in (0, 666) or a >= 900 or b == 0 or c == 0:
        return None
    x = perm(((a - 1 - (a > 666)) * 99 + b - 1) * 9999 + c - 1, 898 * 99 * 9999, "ssn")
    x, c = divmod(x, 9999)
    a, b = divmod(x, 99)
    a += 1 + (a + 1 >= 666)
    return f"{a:03d}-{b + 1:02d}-{c + 1:04d}"


def _ip(m, perm):
    parts = m[0].split(".")
    if any(int(p) > 255 or p != str(int(p)) for p in parts):
        return None
    value = int.from_bytes(bytes(map(int, parts)), "big")
    return ".".join(map(str, perm(value, 1 << 32, "ip").to_bytes(4, "big")))


def _phone(m, perm):
    digits = re.sub(r"\D", "", m[0])
    if not 8 <= len(digits) <= 15:
        return None
    keep = max(0, len(digits) - 10)               # the country's part; the national number is linked without it
    return _refill(m[0], digits[:keep] + _permuted(digits[keep:], perm, "phone"))


def _other_day(day: int, perm: Permutation) -> int:
    """The pseudonym of a day within 1900 to 2099, or of one outside."""
    if 0 <= day - _DAY0 < _DAYS:
        return _DAY0 + perm(day - _DAY0, _DAYS, "date")
    x = perm(day - 1 if day < _DAY0 else day - 1 - _DAYS, _OTHER_DAYS, "date")
    return x + 1 if x + 1 < _DAY0 else x + 1 + _DAYS


def _date(m, perm):
    """Year first, day first, or month first: with slashes, where the second number can't be a month.
    Month-first dates are permuted among those that can only be read so."""
    a, b, c = (int(x) for x in re.findall(r"\d+", m[0]))
    year_first = m[0][:4].isdigit()
    month_first = not year_first and b > 12 and "/" in m[0]
    try:
        day = datetime.date(*((a, b, c) if year_first else (c, a, b) if month_first else (c, b, a))).toordinal()
    except ValueError:
        return None
    day = _other_day(day, perm)
    while month_first and datetime.date.fromordinal(day).day <= 12:
        day = _other_day(day, perm)
    new = datetime.date.fromordinal(day)
    sep = re.search(r"\D", m[0])[0]
    if year_first:
        return f"{new.year:04d}{sep}{new.month:02d}{sep}{new.day:02d}"
    x, y = (new.month, new.day) if month_first else (new.day, new.month)
    return f"{x:02d}{sep}{y:02d}{sep}{new.year:04d}"


def _email(m, perm):
    local = m[1]
    slots = "".join(c for c in local if c.isascii() and c.isalnum())
    return _refill(local, _permuted(slots, perm, "email@" + m[2].lower()), lambda c: c.isascii() and c.isalnum()) + "@" + m[2] \
        if slots else None


def _aws(m, perm):
    return m[1] + _permuted(m[2], perm, "key")


def _assigned(m, perm):
    value = m[2]
    slots = "".join(c for c in value if c.isascii() and c.isalnum())
    if len(slots) < 6:
        return None
    hexadecimal = re.fullmatch(r"[0-9a-f]+", slots) is not None
    # A chunk's permutation depends on its place and the chunk before.
    new, tweak = [], "secret"
    for at in range(0, len(slots), _CHUNK):
        chunk = slots[at:at + _CHUNK]
        new.append(_permuted(chunk, perm, tweak, hexadecimal))
        tweak = f"secret/{at + _CHUNK}/{chunk}"
    return m[1] + _refill(value, "".join(new), lambda c: c.isascii() and c.isalnum())


# In this order: what an earlier kind replaced is not looked at again.
KINDS = (
    ("email", re.compile(r"(?<![A-Za-z0-9._%+-])([A-Za-z0-9._%+-]{1,64})@([A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})+)"), _email),
    ("key", re.compile(r"(?<![A-Za-z0-9])(AKIA|ASIA)([A-Z0-9]{16})(?![A-Za-z0-9])"), _aws),
    ("secret", re.compile(r"(?i)((?<![a-z])(?:password|passwd|pwd|secret|token|api[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?)"
                          r"([^\s\"']{6,})"), _assigned),
    ("iban", re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"), _iban),
    ("date", re.compile(r"(?<![\w./-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4}|"
                        r"\d{1,2}-\d{1,2}-\d{4})(?:(?![\w/-]|\.\d)|(?=[Tt](?:[01]\d|2[0-4])(?::?[0-5]\d|[Zz]?(?!\w))))"), _date),
    ("ip", re.compile(r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)"), _ip),
    ("ssn", re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"), _ssn),
    ("card", re.compile(r"(?<![\w-])\d(?:[ -]?\d){12,18}(?![\w-])"), _card),
    ("phone", re.compile(r"(?<![\w+.-])(?:\+\d{1,3}(?:[ .-]?\(\d{1,4}\))?(?:[ .-]?\d{1,4}){2,6}|"
                         r"\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?![\w-])"), _phone),
)
NAMES = tuple(k for k, _, _ in KINDS)
_MAYBE = re.compile(r"[0-9@=:]")


def pseudonymise(text: str, perm: Permutation) -> tuple[str, dict[str, int]]:
    """The text with pseudonyms, and how many values of each kind it had."""
    counts: dict[str, int] = {}
    if not _MAYBE.search(text):
        return text, counts
    # Pieces of the text; a tuple holds a pseudonym, which no later kind looks at.
    out: list = [text]
    for name, pattern, change in KINDS:
        parts: list = []
        for piece in out:
            if not isinstance(piece, str):
                parts.append(piece)
                continue
            at = 0
            for m in pattern.finditer(piece):
                new = change(m, perm)
                if new is not None:
                    parts += [piece[at:m.start()], (new,)]
                    at = m.end()
                    counts[name] = counts.get(name, 0) + 1
            parts.append(piece[at:])
        out = parts
    return "".join(p if isinstance(p, str) else p[0] for p in out), counts


def pseudonymise_docs(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with the texts replaced and a column ``pii`` (map of kind to count) added last (``pii_`` beside one of that name)."""
    at = docs.columns.index(text)
    names = [*docs.columns, free_name("pii", docs.columns)]
    secret = hashlib.sha256(key.encode()).digest()

    small_batches(docs.sparkSession)

    def scan(batches):
        perm = Permutation(secret)
        worker_freed()
        for b in slices(batches):
            texts, found = [], []
            for t in b.column(at).to_pylist():
                new, n = (t, {}) if t is None else pseudonymise(t, perm)
                texts.append(new)
                found.append(list(n.items()))
            cols = [pa.array(texts, b.schema.field(at).type) if i == at else b.column(i) for i in range(b.num_columns)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(found, pa.map_(pa.string(), pa.int32()))], names=names)

    from pyspark.sql.types import IntegerType, MapType, StringType, StructField, StructType
    return docs.mapInArrow(scan, StructType([*docs.schema.fields, StructField(names[-1], MapType(StringType(), IntegerType()))]))


def pii_query(docs: DataFrame, key: str = "op6-pseudonyms") -> DataFrame:
    out = pseudonymise_docs(docs.select("doc_id", "text"), key)
    count = lambda k: F.coalesce(F.try_element_at("pii", F.lit(k)), F.lit(0)).cast("long")
    return out.select("doc_id", "text", *[count(k).alias(f"n_{k}") for k in NAMES])
