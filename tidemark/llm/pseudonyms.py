"""PII: format-preserving pseudonyms by a keyed Feistel permutation.

A validated value (card number, IBAN, telephone number, social security number, IP address, date, e-mail address, access
key) is a number in the domain of its format.  A Feistel network over the next even power of two, walked until it falls back
into the domain, permutes that domain under a secret key: equal values get equal pseudonyms in every document, different
values different ones, and the key reads them back.  Separators, prefixes and check digits keep their form.
"""

from __future__ import annotations

import datetime
import hashlib
import hmac
import ipaddress
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbuf as tb

ROUNDS = 10
#: A key for tests and trials; give a secret one.
TRIAL_KEY = b"trial key, not secret"
KINDS = ("card", "iban", "phone", "ssn", "ip", "date", "email", "key")

_PATTERN = re.compile(
    r"""(?P<email>(?<![\w.+-])[\w%+-]+(?:\.[\w%+-]+)*@(?:[\w-]+\.)+[^\W\d_]{2,24}(?![\w-]))"""
    r"""|(?P<key>(?<![A-Z0-9])(?:AKIA|ASIA)[A-Z2-7]{16}(?![A-Z0-9]))"""
    r"""|(?P<iban>(?<![A-Z0-9])[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,4})?(?![A-Z0-9]))"""
    r"""|(?P<ip6>(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:.]))"""
    r"""|(?P<ip>(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9]))"""
    r"""|(?P<date>(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}[./-][0-9]{2}[./-][0-9]{4})(?![0-9]|[./-][0-9]))"""
    r"""|(?P<ssn>(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-]))"""
    r"""|(?P<phone>(?<![0-9+(])(?:\+1[ .-]?)?(?:\([0-9]{3}\)[ ]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9]))"""
    r"""|(?P<world>(?<![0-9+])\+[1-9](?:[ ()./-]{0,3}[0-9]){6,14}(?![0-9]))"""
    r"""|(?P<card>(?<![0-9])(?:[0-9][ -]?){12,18}[0-9](?![0-9]))"""
)
_HINT = re.compile(r"[0-9@]|AKIA|ASIA")
_LOWER, _UPPER, _DIGIT = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
_BASE32 = _UPPER + "234567"
_DAY0, _DAYS = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal() - datetime.date(1900, 1, 1).toordinal() + 1


def permuted(x: int, domain: int, key: bytes, tweak: bytes, back: bool = False) -> int:
    """The image of x under the keyed permutation of 0..domain-1 (its preimage with back)."""
    if domain < 2:
        return x
    half = max(1, ((domain - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    size = (half + 7) // 8
    rounds = range(ROUNDS - 1, -1, -1) if back else range(ROUNDS)

    def f(r: int, v: int) -> int:
        said = hashlib.blake2b(tweak + bytes([r]) + v.to_bytes(size, "big"), key=key[:64], digest_size=max(size, 8)).digest()
        return int.from_bytes(said, "big") & mask

    while True:
        left, right = x >> half, x & mask
        for r in rounds:
            if back:
                left, right = right ^ f(r, left), left
            else:
                left, right = right, left ^ f(r, right)
        x = left << half | right
        if x < domain:  # else walk on: the cycle leads back into the domain
            return x


def _letters(text: str, key: bytes, tweak: bytes, back: bool) -> str:
    """Letters and digits of a text permuted as one number, each within its class; all else stays."""
    domain, x = 1, 0
    sets = [next((s for s in (_LOWER, _UPPER, _DIGIT) if c in s), None) for c in text]
    for c, s in zip(text, sets, strict=True):
        if s:
            domain, x = domain * len(s), x * len(s) + s.index(c)
    x = permuted(x, domain, key, tweak + "".join({_LOWER: "a", _UPPER: "A", _DIGIT: "0"}.get(s, c) for c, s in zip(text, sets, strict=True)).encode(), back)
    out = []
    for c, s in reversed(list(zip(text, sets, strict=True))):
        if s:
            x, k = divmod(x, len(s))
            c = s[k]
        out.append(c)
    return "".join(reversed(out))


def _digits(text: str) -> str:
    return "".join(c for c in text if c in _DIGIT)


def _refilled(text: str, digits: str) -> str:
    it = iter(digits)
    return "".join(next(it) if c in _DIGIT else c for c in text)


def _check_digit(body: str) -> str:
    """The digit that makes body + digit pass the Luhn test."""
    total = sum(d if k % 2 else (2 * d - 9 if d > 4 else 2 * d) for k, d in enumerate(int(c) for c in reversed(body)))
    return str(-total % 10)


def _is_card(text: str) -> bool:
    d = _digits(text)
    return 13 <= len(d) <= 19 and d[0] != "0" and len(set(d)) > 1 and _check_digit(d[:-1]) == d[-1]


def _card(text: str, key: bytes, back: bool) -> str | None:
    if not _is_card(text):
        return None
    d = _digits(text)
    # the first digit (the network) stays, the last follows from the others
    n = len(d) - 2
    x = permuted(int(d[1:-1]), 10**n, key, b"card" + d[0].encode() + bytes([n]), back)
    body = d[0] + str(x).zfill(n)
    return _refilled(text, body + _check_digit(body))


def _is_world(text: str) -> bool:
    return 8 <= len(_digits(text)) <= 15 and text[-1] in _DIGIT


def _mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def _is_iban(text: str) -> bool:
    plain = text.replace(" ", "")
    return 15 <= len(plain) <= 34 and _mod97(plain) == 1


def _iban(text: str, key: bytes, back: bool) -> str | None:
    if not _is_iban(text):
        return None
    plain = text.replace(" ", "")
    body = _letters(plain[4:], key, b"iban" + plain[:2].encode(), back)
    check = 98 - _mod97(plain[:2] + "00" + body)
    it = iter(f"{plain[:2]}{check:02d}{body}")
    return "".join(c if c == " " else next(it) for c in text)


def _assigned(d: str) -> bool:
    return not (d[0] in "01" or d[3] in "01" or d[1:3] == "11")


def _phone(text: str, key: bytes, back: bool) -> str | None:
    d = _digits(text)
    d = d[-10:]
    if not _assigned(d):
        if text[0] not in "+(":
            return None
        # +1 or parentheses say what it is: all other numbers are permuted among themselves
        other = permuted(int(d), 10**10, key, b"phone other", back)
        while _assigned(f"{other:010d}"):
            other = permuted(other, 10**10, key, b"phone other", back)
        return _refilled(text, _digits(text)[:-10] + f"{other:010d}")
    area, exchange, line = int(d[:3]), int(d[3:6]), int(d[6:])
    codes = [a for a in range(200, 1000) if a % 100 != 11]
    x = permuted((codes.index(area) * 800 + exchange - 200) * 10_000 + line, len(codes) * 800 * 10_000, key, b"phone", back)
    x, line = divmod(x, 10_000)
    area, exchange = divmod(x, 800)
    lead = len(_digits(text)) - 10
    return _refilled(text, _digits(text)[:lead] + f"{codes[area]}{exchange + 200}{line:04d}")


def _ssn(text: str, key: bytes, back: bool) -> str | None:
    area, group, serial = (int(x) for x in text.split("-"))
    areas = [a for a in range(1, 900) if a != 666]
    if area not in areas or group == 0 or serial == 0:
        return None
    x = permuted((areas.index(area) * 99 + group - 1) * 9999 + serial - 1, len(areas) * 99 * 9999, key, b"ssn", back)
    x, serial = divmod(x, 9999)
    area, group = divmod(x, 99)
    return f"{areas[area]:03d}-{group + 1:02d}-{serial + 1:04d}"


def _ip(text: str, key: bytes, back: bool) -> str | None:
    parts = text.split(".")
    if any(int(p) > 255 or p != str(int(p)) for p in parts):
        return None
    x = permuted(int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, key, b"ip", back)
    return ".".join(map(str, x.to_bytes(4, "big")))


def _world(text: str, key: bytes, back: bool) -> str | None:
    if not _is_world(text):
        return None
    # the country code stays: what stands before the first space, or two digits
    lead = re.match(r"\+([0-9]{1,3})(?=[ ()./-])", text)
    kept = len(lead[1]) if lead else 2
    d = _digits(text)
    n = len(d) - kept
    x = permuted(int(d[kept:]), 10**n, key, b"world" + d[:kept].encode() + bytes([n]), back)
    return _refilled(text, d[:kept] + str(x).zfill(n))


def _ip6(text: str, key: bytes, back: bool) -> str | None:
    if sum(map(bool, text.split(":"))) < 2 or not any(c in _DIGIT for c in text):
        return None
    upper = text != text.lower()
    if upper and text != text.upper():
        return None
    try:
        ipaddress.IPv6Address(text)
    except ValueError:
        return None
    sizes = [len(g) for g in text.split(":")]
    x, n = int(text.replace(":", ""), 16), sum(sizes)
    while True:  # a number without digits, or in capitals without letters, would not be known again
        x = permuted(x, 16**n, key, b"ip6" + bytes(sizes), back)
        plain = f"{x:0{n}x}"
        new, at = [], 0
        for size in sizes:
            new.append(plain[at : at + size])
            at += size
        if any(c in _DIGIT for c in plain) and (not upper or plain != plain.upper()):
            return (":".join(new)).upper() if upper else ":".join(new)


@lru_cache(maxsize=1)
def _month_first() -> tuple[list[int], dict[int, int]]:
    """The days that only month-first dates can be, after the 12th of a month, and their places."""
    days = [d for d in range(_DAYS) if datetime.date.fromordinal(_DAY0 + d).day > 12]
    return days, {d: k for k, d in enumerate(days)}


def _date(text: str, key: bytes, back: bool) -> str | None:
    iso = text[4] == "-"
    swapped = False
    try:
        if iso:
            day = datetime.date.fromisoformat(text)
        else:
            if text[2] != text[5]:
                return None
            first, second, year = int(text[:2]), int(text[3:5]), int(text[6:])
            swapped = second > 12  # the month stands first
            day = datetime.date(year, first, second) if swapped else datetime.date(year, second, first)
    except ValueError:
        return None
    x = day.toordinal() - _DAY0
    if not 0 <= x < _DAYS:
        return None
    if swapped:
        days, place = _month_first()
        day = datetime.date.fromordinal(_DAY0 + days[permuted(place[x], len(days), key, b"date month first", back)])
        return f"{day.month:02d}{text[2]}{day.day:02d}{text[2]}{day.year:04d}"
    day = datetime.date.fromordinal(_DAY0 + permuted(x, _DAYS, key, b"date", back))
    return day.isoformat() if iso else f"{day.day:02d}{text[2]}{day.month:02d}{text[2]}{day.year:04d}"


def _email(text: str, key: bytes, back: bool) -> str | None:
    name, _, host = text.rpartition("@")
    labels = host.split(".")  # the last label stays, and so the address stays well formed
    return _letters(name, key, b"email", back) + "@" + ".".join([_letters(".".join(labels[:-1]), key, b"host", back), labels[-1]])


def _key(text: str, key: bytes, back: bool) -> str | None:
    x = 0
    for c in text[4:]:
        x = x * 32 + _BASE32.index(c)
    x = permuted(x, 32**16, key, b"key" + text[:4].encode(), back)
    return text[:4] + "".join(_BASE32[x >> 5 * (15 - k) & 31] for k in range(16))


_OF = {"card": _card, "iban": _iban, "phone": _phone, "world": _world, "ssn": _ssn, "ip": _ip, "ip6": _ip6, "date": _date, "email": _email, "key": _key}
#: Forms that count as another kind.
_COUNTED = {"world": "phone", "ip6": "ip"}
#: Patterns that may take in groups after the value: (validation, what stands between groups).
_RUNS = {"card": (_is_card, " -"), "iban": (_is_iban, " "), "world": (_is_world, " ()./-")}


def _end(kind: str, run: str) -> int:
    """Where the value in a run of groups ends: the longest run of its first groups that validates, or 0."""
    valid, between = _RUNS[kind]
    ends = [len(run), *(k for k in range(len(run) - 1, 0, -1) if run[k] in between)]
    return next((k for k in ends if valid(run[:k])), 0)


class Pseudonyms:
    """Replaces validated values of texts; equal values are permuted once and remembered."""

    def __init__(self, key: bytes, back: bool = False):
        self.key, self.back = hmac.new(key, b"pseudonyms", "sha256").digest(), back
        self._of = lru_cache(maxsize=100_000)(self._value)

    def _value(self, kind: str, text: str) -> tuple[str, int] | None:
        """The pseudonym of the value that text starts with, and the value's length."""
        end = _end(kind, text) if kind in _RUNS else len(text)
        new = _OF[kind](text[:end], self.key, self.back) if end else None
        while new and end < len(text) and _end(kind, new + text[end:]) != end:  # walk on, or it would be read back with other groups
            new = _OF[kind](new, self.key, self.back)
        return (new, end) if new else None

    def replace(self, text: str) -> tuple[str, dict[str, int]]:
        """(the text with pseudonyms, how many values of each kind it had)."""
        found: dict[str, int] = {}
        if not _HINT.search(text):
            return text, found

        out, at = [], 0
        while m := _PATTERN.search(text, at):
            value = self._of(m.lastgroup, m[0])
            new, size = value or (m[0], len(m[0]))
            if value:
                kind = _COUNTED.get(m.lastgroup, m.lastgroup)
                found[kind] = found.get(kind, 0) + 1
            out += text[at : m.start()], new
            at = m.start() + size
        return "".join(out) + text[at:], found


def pseudonymised(docs: DataFrame, key: bytes = TRIAL_KEY, back: bool = False, digest: bool = False) -> DataFrame:
    """(doc_id, text, n_<kind> for each kind) for each row of docs.

    Values that fail validation (check digits, ranges, calendar) stay; of a run of groups in the form of a card number or IBAN
    the longest beginning that validates is the value; telephone numbers with +1 or parentheses may have any digits, those with another
    + and country code 8 to 15 in all.  Dates are read day first, and month first where that is the only reading.  Letters outside
    ASCII stay in an address.  A null text stays null and has no values.
    With digest, text is its SHA-256 in hex (null: that of an empty text).  With back, pseudonyms are read back.
    """

    def run(batches):
        names = Pseudonyms(key, back)
        for batch in batches:
            for part in tb.slices(batch, "text"):
                out = [names.replace(t) if t is not None else (None, {}) for t in part.column("text").to_pylist()]
                texts = [hashlib.sha256((t or "").encode()).hexdigest() for t, _ in out] if digest else [t for t, _ in out]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, pa.string()), *(pa.array([f.get(k, 0) for _, f in out], pa.int64()) for k in KINDS)], ["doc_id", "text", *(f"n_{k}" for k in KINDS)])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, text string, " + ", ".join(f"n_{k} long" for k in KINDS))


def op4_feistel_pseudonyms(spark, sf_dir: str) -> DataFrame:
    """pseudonymised() of all documents under the trial key."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pseudonymised(docs)
