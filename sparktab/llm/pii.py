"""Personal data replaced by format-preserving pseudonyms.

Numbers and dates that validate (check digits, ranges, calendars) are permuted within their own
format by a keyed Feistel network: the pseudonym has the same length, separators, letter case and
valid check digits, and under one key equal values have equal pseudonyms in all documents, whatever
their separators.  A permutation has no collisions, so different values stay different.
"""

from __future__ import annotations

import datetime as dt
import hmac
import re
from bisect import bisect_left
from collections.abc import Callable
from math import isqrt
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktab.llm.common import map_arrow

ROUNDS = 10


def _round_bytes(b: int) -> int:
    """Bytes of a round's number: 8 more than a half ``range(b)`` needs, so all of it is mixed evenly."""
    return max(16, (b.bit_length() + 7) // 8 + 8)


class Feistel:
    """Keyed permutations of ``range(n)`` without fixed points.

    A Feistel network over two equal halves, walked along its cycle until it is back in range, is a
    permutation p; what is used is ``inverse(p(x) + 1)``, one step along a keyed cycle through all
    values, so a pseudonym never equals its value (unless there is only one)."""

    def __init__(self, key: bytes):
        self.key = key

    def _round(self, tweak: bytes, r: int, x: int, size: int) -> int:
        """A keyed number of ``size`` bytes."""
        message = tweak + bytes([r]) + x.to_bytes((x.bit_length() + 7) // 8 or 1, "big")
        out = hmac.digest(self.key, message, "sha256")
        for i in range(1, -(-size // len(out))):
            out += hmac.digest(self.key, i.to_bytes(4, "big") + message, "sha256")
        return int.from_bytes(out[:size], "big")

    def _forward(self, x: int, b: int, tweak: bytes) -> int:
        left, right = divmod(x, b)
        size = _round_bytes(b)
        for r in range(ROUNDS):
            left, right = right, (left + self._round(tweak, r, right, size)) % b
        return left * b + right

    def _backward(self, x: int, b: int, tweak: bytes) -> int:
        left, right = divmod(x, b)
        size = _round_bytes(b)
        for r in reversed(range(ROUNDS)):
            left, right = (right - self._round(tweak, r, left, size)) % b, left
        return left * b + right

    def permute(self, x: int, n: int, tweak: str) -> int:
        if not 0 <= x < n:
            raise ValueError("value out of range")
        if n == 1:
            return x
        t, b = f"{tweak}/{n}".encode(), isqrt(n - 1) + 1
        y = self._forward(x, b, t)
        while y >= n:
            y = self._forward(y, b, t)
        y = self._backward((y + 1) % n, b, t)
        while y >= n:
            y = self._backward(y, b, t)
        return y


def luhn_digit(payload: str) -> str:
    """Check digit of a digit string."""
    total = 0
    for i, c in enumerate(reversed(payload)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def iban_digits(s: str) -> int:
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97


# The country calling codes of two digits.  Those that begin with 1 or 7 have one digit, all
# others three.
TWO_DIGIT_COUNTRIES = {20, 27, 30, 31, 32, 33, 34, 36, 39, 40, 41, 43, 44, 45, 46, 47, 48, 49, 51, 52, 53, 54, 55, 56, 57, 58,
                       60, 61, 62, 63, 64, 65, 66, 81, 82, 84, 86, 90, 91, 92, 93, 94, 95, 98}


def country_digits(number: str) -> int:
    """How many leading digits of an international number are its country code."""
    return 1 if number[0] in "17" else 2 if int(number[:2]) in TWO_DIGIT_COUNTRIES else 3


def _fill(template: str, digits: str) -> str:
    """``template`` with its digits replaced in order."""
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in template)


class Pseudonymizer:
    """Finds the kinds of ``KINDS`` in a text and replaces what validates."""

    def __init__(self, key: bytes):
        self.f = Feistel(key)

    def digits(self, s: str, kind: str) -> str:
        return str(self.f.permute(int(s), 10 ** len(s), f"{kind}{len(s)}")).zfill(len(s)) if s else s

    def email(self, m: re.Match) -> str:
        """The local part, letters to letters and digits to digits; the domain stays."""
        local, domain = m.group(1), m.group(2)
        sizes = [10 if c.isdigit() else 26 if c.isascii() and c.isalpha() else 1 for c in local]
        x = 0
        for c, n in zip(local, sizes):
            x = x * n + (int(c) if n == 10 else ord(c.lower()) - 97 if n == 26 else 0)
        total = 1
        for n in sizes:
            total *= n
        shape = "".join("d" if n == 10 else "a" if n == 26 else c for c, n in zip(local, sizes))
        x = self.f.permute(x, total, "email/" + shape)
        out = []
        for c, n in zip(reversed(local), reversed(sizes)):
            x, d = divmod(x, n)
            out.append(str(d) if n == 10 else (chr(65 + d) if c.isupper() else chr(97 + d)) if n == 26 else c)
        return "".join(reversed(out)) + domain

    def card(self, m: re.Match) -> str | None:
        """Payment card numbers: the leading digit and a valid check digit stay."""
        s = re.sub(r"\D", "", m.group())
        if not 13 <= len(s) <= 19 or luhn_digit(s[:-1]) != s[-1] or len(set(s)) == 1:
            return None
        body = s[0] + self.digits(s[1:-1], "card" + s[0])
        return _fill(m.group(), body + luhn_digit(body))

    def iban(self, m: re.Match) -> str | None:
        """Country, length and valid check digits stay; account digits and letters are permuted."""
        s = re.sub(r"\s", "", m.group())
        if not 15 <= len(s) <= 34 or iban_digits(s) != 1:
            return None
        sizes = [10 if c.isdigit() else 26 for c in s[4:]]
        x, total = 0, 1
        for c, n in zip(s[4:], sizes):
            x, total = x * n + (int(c) if n == 10 else ord(c) - 65), total * n
        x = self.f.permute(x, total, "iban" + s[:2] + "".join("d" if n == 10 else "a" for n in sizes))
        body = []
        for n in reversed(sizes):
            x, d = divmod(x, n)
            body.append(str(d) if n == 10 else chr(65 + d))
        body = "".join(reversed(body))
        check = 98 - int("".join(str(int(c, 36)) for c in body + s[:2] + "00")) % 97
        it = iter(f"{s[:2]}{check:02d}{body}")
        return "".join(c if c.isspace() else next(it) for c in m.group())

    def ssn(self, m: re.Match) -> str | None:
        """Area 001-899 without 666, group 01-99, serial 0001-9999."""
        area, group, serial = map(int, m.group(1, 2, 3))
        if area in (0, 666) or area >= 900 or not group or not serial:
            return None
        a = area - 1 - (area > 666)
        x = self.f.permute((a * 99 + group - 1) * 9999 + serial - 1, 898 * 99 * 9999, "ssn")
        x, serial = divmod(x, 9999)
        a, group = divmod(x, 99)
        return f"{a + 1 + (a >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"

    def phone(self, m: re.Match) -> str | None:
        """The country code stays; the national number is permuted among those of its length, so it has one
        pseudonym with and without the code, whatever the separators."""
        s = m.group()
        digits = re.sub(r"\D", "", s)
        if not 9 <= len(digits) <= 15:
            return None
        keep = country_digits(digits) if s[0] == "+" else 0
        return _fill(s, digits[:keep] + self.digits(digits[keep:], "phone"))

    def ip(self, m: re.Match) -> str | None:
        parts = [int(x) for x in m.group().split(".")]
        if any(p > 255 for p in parts) or any(len(x) > 1 and x[0] == "0" for x in m.group().split(".")):
            return None
        x = self.f.permute(int.from_bytes(bytes(parts), "big"), 1 << 32, "ip")
        return ".".join(map(str, x.to_bytes(4, "big")))

    _FIRST, _LAST = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()

    def _day(self, y: int, mo: int, d: int) -> dt.date | None:
        """Pseudonym of a calendar day between 1900 and 2099; linked across date formats."""
        try:
            n = dt.date(y, mo, d).toordinal()
        except ValueError:
            return None
        if not self._FIRST <= n <= self._LAST:
            return None
        return dt.date.fromordinal(self._FIRST + self.f.permute(n - self._FIRST, self._LAST - self._FIRST + 1, "date"))

    def iso_date(self, m: re.Match) -> str | None:
        d = self._day(int(m.group(1)), int(m.group(3)), int(m.group(4)))
        return d and f"{d.year:04d}{m.group(2)}{d.month:02d}{m.group(2)}{d.day:02d}"

    def local_date(self, m: re.Match) -> str | None:
        """Day, month, year with dots or dashes; month, day, year with slashes where that is a date."""
        a, b, y, sep = int(m.group(1)), int(m.group(3)), int(m.group(4)), m.group(2)
        swap = sep == "/" and a <= 12
        d = self._day(y, a, b) if swap else self._day(y, b, a)
        if d is None:
            return None
        p, q = (d.month, d.day) if swap else (d.day, d.month)
        return f"{p:02d}{sep}{q:02d}{sep}{d.year:04d}"


# Kinds in the order in which they claim text, with their patterns.
KINDS: tuple[tuple[str, re.Pattern, Callable], ...] = (
    ("email", re.compile(r"(?<![\w.+-])([A-Za-z0-9._%+-]+)(@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})"), Pseudonymizer.email),
    ("iban", re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?![A-Za-z0-9])"), Pseudonymizer.iban),
    ("ip", re.compile(r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)"), Pseudonymizer.ip),
    ("date", re.compile(r"(?<![\d./-])(\d{4})([-/.])(\d{2})\2(\d{2})(?!\d)"), Pseudonymizer.iso_date),
    ("date", re.compile(r"(?<![\d./-])(\d{2})([-/.])(\d{2})\2(\d{4})(?!\d)"), Pseudonymizer.local_date),
    ("ssn", re.compile(r"(?<![\d-])(\d{3})-(\d{2})-(\d{4})(?![\d-])"), Pseudonymizer.ssn),
    ("card", re.compile(r"(?<!\w)(?<!\d[.,])(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{1,7}|\d{4}([ -])\d{6}\2\d{4,5})(?!\w)"), Pseudonymizer.card),
    ("phone", re.compile(r"(?<![\w+])(?<!\d[.-])(?:(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}"
                         r"|\+\d{1,3}(?:[ .-]?\d{2,4}){2,4})(?!\w|[.-]\d)"), Pseudonymizer.phone),
)
NAMES = ("email", "iban", "ip", "date", "ssn", "card", "phone")


def pseudonymize_text(text: str, p: Pseudonymizer) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with pseudonyms, and ``(kind, start, end)`` of what was replaced in the original.
    Where kinds overlap the earlier one in ``KINDS`` holds the text."""
    found: list[tuple[int, int, str, str]] = []     # sorted and disjoint
    if not (re.search(r"\d", text) or "@" in text):
        return text, []
    for kind, pattern, make in KINDS:
        for m in pattern.finditer(text):
            s, e = m.span()
            i = bisect_left(found, e, key=itemgetter(0))    # the last claimed span that starts before this one ends
            if i and found[i - 1][1] > s:
                continue
            new = make(p, m)
            if new is not None:
                found.insert(i, (s, e, kind, new))
    out, at = [], 0
    for s, e, _, new in found:
        out += [text[at:s], new]
        at = e
    return "".join(out) + text[at:], [(k, s, e) for s, e, k, _ in found]


def pseudonymize(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, text`` (with pseudonyms) ``, found`` (kind, start, end in the original,
    code points) and a count ``n_<kind>`` per kind.

    Null texts stay null and hold nothing; empty texts stay empty.  What matches a format but does
    not validate stays as it is.  Null ids and repeated rows stay, other columns are ignored, an
    empty table gives an empty result.  Row-wise: no shuffle, and no table of pseudonyms to keep.
    """
    def make():
        p = Pseudonymizer(key)

        def fn(b: pa.RecordBatch) -> pa.RecordBatch:
            texts, spans = [], []
            for t in b.column(1).to_pylist():
                new, found = pseudonymize_text(t, p) if t else (t, [])
                texts.append(new)
                spans.append(found)
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            cols = [b.column(0), pa.array(texts, pa.string()),
                    pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in f] for f in spans], kind)]
            cols += [pa.array([sum(1 for x in f if x[0] == k) for f in spans], pa.int64()) for k in NAMES]
            return pa.record_batch(cols, names=["doc_id", "text", "found"] + [f"n_{k}" for k in NAMES])
        return fn
    return map_arrow(docs, [F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")],
                     "doc_id long, text string, found array<struct<kind string, start long, end long>>, "
                     + ", ".join(f"n_{k} long" for k in NAMES), make)
