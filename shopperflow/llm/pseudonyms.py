"""Personal data: format-preserving pseudonyms from a keyed Feistel permutation.

Found are e-mail addresses, IPv4 addresses, telephone numbers, payment card numbers (Luhn), IBANs (mod
97), social security numbers, dates and secrets assigned to names such as token or password. Only values
that pass their check are touched. Each kind is numbered within its valid values, and the number goes
through a permutation of exactly that range (Feistel rounds on the next power of four, walked on until
it falls into the range). So a pseudonym is again a valid value of the same form, equal values get equal
pseudonyms in every document, different ones different pseudonyms, and the key leads back.

Kept as they are: separators, letter case, a telephone number's country code, an address's last domain
label, an IBAN's country, a secret's name, letters outside ASCII.

Defined results: null text stays null, empty stays empty, both with no finds; overlapping finds: the
leftmost, then the kind first in KINDS; repeated rows are treated alike; empty tables give no rows.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame

from .arrays import annotated

KINDS = ("email", "secret", "iban", "ip", "phone", "card", "ssn", "date")
ROUNDS = 8
_FIRST, _LAST = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()

_FIND = re.compile(
    r"(?P<email>(?<![\w.%+-])[\w.%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}(?![\w-]))"
    r"|(?P<secret>(?i:\b(?:token|secret|password|passwd|pwd|api[_-]?key|access[_-]?key|auth)\b)\W{0,5}[=:][^\w+/]{0,5}[A-Za-z0-9_+/-]{16,})"
    r"|(?P<iban>(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w))"
    r"|(?P<ip>(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\w|\.[0-9]))"
    r"|(?P<phone>(?<![\w+])\+1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?!\w)"
    r"|(?<![\w+])\+(?!1[ .(-])[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[ .-]?[0-9]{2,4}){2,4}(?!\w|\.[0-9])"
    r"|(?<![\w.(+-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[.-][0-9]{4}(?![\w.-]*[0-9]))"
    r"|(?P<card>(?<![\w.-])(?:[0-9]{4}(?P<s1>[ -])[0-9]{4}(?P=s1)[0-9]{4}(?P=s1)[0-9]{1,7}|[0-9]{4}(?P<s2>[ -])[0-9]{6}(?P=s2)[0-9]{5}|[0-9]{13,19})(?!\w|[.-][0-9]))"
    r"|(?P<ssn>(?<![\w.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?!\w|[.-][0-9]))"
    r"|(?P<date>(?<![\w./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{2}[./-][0-9]{2}[./-][0-9]{4})(?!\w|[./-][0-9]))"
)
#: Every find holds a digit or an @; a secret without a digit is taken for a word.
_HINT = re.compile(r"[0-9@]")


class Pseudonyms:
    def __init__(self, key: bytes):
        self.key = key
        self._known: dict[tuple[str, str], str | None] = {}

    def __getstate__(self):
        return {"key": self.key, "_known": {}}

    # --- the permutation

    def _half(self, kind: str, size: int, turn: int, value: int, bits: int) -> int:
        width = (bits + 7) // 8
        said = f"{kind}|{size}|{turn}|".encode() + value.to_bytes(width, "big")
        return int.from_bytes(hashlib.blake2b(said, key=self.key[:64], digest_size=min(64, width + 8)).digest(), "big") % (1 << bits)

    def permuted(self, kind: str, value: int, size: int, back: bool = False) -> int:
        """A permutation of range(size), another one for each kind and size."""
        bits = max(1, ((size - 1).bit_length() + 1) // 2)
        while True:
            left, right = value >> bits, value & ((1 << bits) - 1)
            if back:
                for turn in reversed(range(ROUNDS)):
                    left, right = right ^ self._half(kind, size, turn, left, bits), left
            else:
                for turn in range(ROUNDS):
                    left, right = right, left ^ self._half(kind, size, turn, right, bits)
            value = left << bits | right
            if value < size:
                return value

    def _symbols(self, kind: str, text: str, back: bool, alphabet: Callable[[str], str]) -> str:
        """Permutes all characters that belong to an alphabet, together, as one number of mixed radix."""
        sets = [alphabet(c) for c in text]
        value, size = 0, 1
        for c, held in zip(text, sets):
            if held:
                value, size = value * len(held) + held.index(c.lower()), size * len(held)
        form = "".join(chr(64 + len(s)) if s else "." for s in sets)
        value = self.permuted(f"{kind}|{form}", value, size, back) if size > 1 else value
        out = []
        for c, held in zip(reversed(text), reversed(sets)):
            if held:
                value, at = divmod(value, len(held))
                c = held[at].upper() if c.isupper() else held[at]
            out.append(c)
        return "".join(reversed(out))

    # --- the kinds; each returns None for a value that fails its check

    def email(self, text: str, back: bool) -> str:
        kept = text.rindex(".")
        return self._symbols("email", text[:kept], back, _letter_or_digit) + text[kept:]

    def secret(self, text: str, back: bool) -> str | None:
        start = re.search(r"[=:][^\w+/]*", text).end()
        value = text[start:]
        if not any(c.isdigit() for c in value):
            return None
        hexadecimal = re.fullmatch("[0-9a-f]+|[0-9A-F]+", value)
        if hexadecimal and value.upper() == value:
            return text[:start] + self._symbols("secret", value.lower(), back, _hex).upper()
        return text[:start] + self._symbols("secret", value, back, _hex if hexadecimal else _letter_or_digit)

    def iban(self, text: str, back: bool) -> str | None:
        plain = text.replace(" ", "")
        if not 15 <= len(plain) <= 34 or _mod97(plain[4:] + plain[:4]) != 1:
            return None
        inner = self._symbols("iban", plain[4:], back, _letter_or_digit)
        full = plain[:2] + f"{98 - _mod97(inner + plain[:2] + '00'):02d}" + inner
        return _laid_over(text, full)

    def ip(self, text: str, back: bool) -> str | None:
        parts = text.split(".")
        if any(int(p) > 255 or (p[0] == "0" and p != "0") for p in parts):
            return None
        value = self.permuted("ip", int.from_bytes(bytes(map(int, parts)), "big"), 2**32, back)
        return ".".join(map(str, value.to_bytes(4, "big")))

    def phone(self, text: str, back: bool) -> str | None:
        code = re.match(r"\+[0-9]{1,3}(?=[ .(-])|\+1|\+[0-9]{2}|", text).group()
        digits = re.sub("[^0-9]", "", text[len(code):])
        if not 8 <= len(digits) + len(code) - 1 <= 15 or len(digits) < 6:
            return None
        value = self.permuted(f"phone{len(digits)}", int(digits), 10 ** len(digits), back)
        return code + _laid_over(text[len(code):], f"{value:0{len(digits)}d}")

    def card(self, text: str, back: bool) -> str | None:
        digits = re.sub("[^0-9]", "", text)
        if not 13 <= len(digits) <= 19 or _luhn(digits) or not int(digits):
            return None
        body = len(digits) - 1
        value = f"{self.permuted(f'card{body}', int(digits[:-1]), 10**body, back):0{body}d}"
        return _laid_over(text, value + str(-_luhn(value + "0") % 10))

    def ssn(self, text: str, back: bool) -> str | None:
        area, group, serial = map(int, text.split("-"))
        if area in (0, 666) or area >= 900 or not group or not serial:
            return None
        areas = [a for a in range(1, 900) if a != 666]
        value = (areas.index(area) * 99 + group - 1) * 9999 + serial - 1
        value, serial = divmod(self.permuted("ssn", value, len(areas) * 99 * 9999, back), 9999)
        area, group = divmod(value, 99)
        return f"{areas[area]:03d}-{group + 1:02d}-{serial + 1:04d}"

    def date(self, text: str, back: bool) -> str | None:
        read = _read_date(text)
        if read is None:
            return None
        form, day = read
        value = day.toordinal() - _FIRST
        while True:  # until it reads in the same form
            value = self.permuted(f"date{form}", value, _LAST - _FIRST + 1, back)
            said = dt.date.fromordinal(value + _FIRST).strftime(form)
            if (again := _read_date(said)) and again[0] == form:
                return said

    # --- texts

    def value(self, kind: str, text: str, back: bool = False) -> str | None:
        return getattr(self, kind)(text, back)

    def _held(self, kind: str, text: str) -> str | None:
        if len(self._known) > 100_000:
            self._known.clear()
        at = kind, text
        if at not in self._known:
            self._known[at] = self.value(kind, text)
        return self._known[at]

    def text(self, text: str | None) -> tuple[str | None, list[tuple[str, int, int]]]:
        """The text with pseudonyms, and kind, start, stop (code points) of every find in the old text."""
        if not text or not _HINT.search(text):
            return text, []
        finds: list[tuple[str, int, int]] = []

        def put(m: re.Match) -> str:
            kind = next(k for k in KINDS if m.group(k) is not None)
            new = self._held(kind, m.group())
            if new is None:
                return m.group()
            finds.append((kind, m.start(), m.end()))
            return new

        return _FIND.sub(put, text), finds


def _letter_or_digit(c: str) -> str:
    return "0123456789" if "0" <= c <= "9" else "abcdefghijklmnopqrstuvwxyz" if "a" <= c.lower() <= "z" and c.isascii() else ""


def _hex(c: str) -> str:
    return "0123456789abcdef"


def _luhn(digits: str) -> int:
    """0 for a valid number."""
    return sum(int(d) if i % 2 == 0 else (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for i, d in enumerate(reversed(digits))) % 10


def _mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text)) % 97


def _laid_over(form: str, symbols: str) -> str:
    """`symbols` in the places of letters and digits of `form`."""
    left = iter(symbols)
    return "".join(next(left) if c.isalnum() else c for c in form)


def _read_date(text: str) -> tuple[str, dt.date] | None:
    """The form a date reads in (day before month if both would do), if it is a day of 1900 to 2099."""
    s = text[4] if text[:4].isdigit() else text[2]
    for form in ([f"%Y{s}%m{s}%d"] if text[:4].isdigit() else [f"%d{s}%m{s}%Y", f"%m{s}%d{s}%Y"]):
        try:
            day = dt.datetime.strptime(text, form).date()
        except ValueError:
            continue
        if _FIRST <= day.toordinal() <= _LAST:
            return form, day
    return None


def pseudonymised(documents: DataFrame, key: bytes, text: str = "text", passed: list[str] | None = None) -> DataFrame:
    """Replaces the text column (its place among the columns changes) and adds n_private and private, the finds."""
    tool = Pseudonyms(key)

    def make(part: pa.RecordBatch) -> dict:
        done = [tool.text(t) for t in part.column("__text").to_pylist()]
        return {
            text: [t for t, _ in done],
            "n_private": [len(f) for _, f in done],
            "private": [[{"kind": k, "start": a, "stop": b} for k, a, b in f] for _, f in done],
        }

    schema = f"`{text}` string, n_private long, private array<struct<kind:string,start:long,stop:long>>"
    return annotated(documents, text, make, schema, passed)
