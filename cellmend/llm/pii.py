"""Format-preserving pseudonyms for personal data in texts.

A value is found by its pattern, validated (Luhn, mod 97, calendar, ranges),
turned into its number among all values of its format, and permuted there by a
keyed Feistel network. So a card stays a valid card, a date a date, equal values
get equal pseudonyms in every document, and without the key there is no way
back. With the key ``restore`` undoes it.
"""

from __future__ import annotations

import datetime
import re
from dataclasses import dataclass
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cellmend.llm.common import map_arrow

ROUNDS = 8
_DIGITS, _HEX = "0123456789", "0123456789abcdef"
_LOWER, _UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
_DAYS = datetime.date(2100, 1, 1).toordinal() - _FIRST_DAY

#: One alternative per kind, tried in this order at each place. No quantifier
#: over free text can run back and forth, however long the text.
_PATTERN = re.compile("|".join([
    r"(?P<phone>(?<![\w+])(?:\+\d{1,3}[ .-]?)(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}(?!\d)"
    r"|(?<![\w(])\(\d{3}\) ?\d{3}-\d{4}(?!\d)|(?<![\w-])\d{3}-\d{3}-\d{4}(?![\w-])"
    r"|(?<![\w.-])\d{3}\.\d{3}\.\d{4}(?![\w-]|\.\d))",
    r"(?P<abroad>(?<![\w+])\+[1-9]\d{0,2}(?:[ .-]\d{2,4}){2,4}(?![\d-]))",
    r"(?P<ip>(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d))",
    r"(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))",
    r"(?P<date>(?<![\w/.-])(?:\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})(?![\w/-]))",
    r"(?P<iban>(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)"
    r"(?![A-Za-z0-9]))",
    r"(?P<card>(?<![\w-])(?:\d{4}(?P<gap>[ -])\d{4}(?P=gap)\d{4}(?P=gap)\d{1,7}"
    r"|\d{4}(?P<wide>[ -])\d{6}(?P=wide)\d{5}|\d{13,19})(?![\w-]))",
    r"(?P<key>(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9]))",
    r"(?P<secret>(?<![A-Za-z])(?:password|passwd|pwd|token|secret|api[_-]?key)"
    r" ?[=:] ?[\"']?(?P<value>[A-Za-z0-9+/_-]{8,}+))",
    r"(?P<mail>@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8})",
]), re.ASCII)
_LOCAL = _DIGITS + _LOWER + _UPPER + "._%+-"
#: Characters that are numbered together; a longer value is taken in such pieces.
PIECE = 256
_MAYBE = re.compile(r"[0-9@]|(?:password|passwd|pwd|token|secret|key) ?[=:]")


def luhn_digit(digits: str) -> str:
    """The check digit behind ``digits``."""
    total = sum(sum(divmod(2 * int(d), 10)) if i % 2 == 0 else int(d)
                for i, d in enumerate(reversed(digits)))
    return str(-total % 10)


def iban_digits(country: str, account: str) -> str:
    return f"{98 - int(''.join(str(int(c, 36)) for c in account + country + '00')) % 97:02d}"


@dataclass(frozen=True)
class Permutation:
    """A keyed permutation of the numbers below ``size``, its own for each kind."""
    key: bytes
    kind: str
    size: int

    def _half(self, number: int, part: int, bits: int) -> int:
        data = f"{self.kind}/{self.size}/{part}/{number}".encode()
        n = (bits + 7) // 8
        if n <= 64:
            return int.from_bytes(blake2b(data, key=self.key, digest_size=n).digest(), "big") & ((1 << bits) - 1)
        blocks = [blake2b(data + b"/%d" % i, key=self.key).digest() for i in range(-(-n // 64))]
        return int.from_bytes(b"".join(blocks)[:n], "big") & ((1 << bits) - 1)

    def _walk(self, number: int, parts: range, back: bool) -> int:
        half = ((self.size - 1).bit_length() + 1) // 2
        mask = (1 << half) - 1
        while True:
            left, right = number >> half, number & mask
            for part in parts:
                if back:
                    left, right = right ^ self._half(left, part, half), left
                else:
                    left, right = right, left ^ self._half(right, part, half)
            number = (left << half) | right
            if number < self.size:
                return number

    def there(self, number: int) -> int:
        return self._walk(number, range(ROUNDS), False) if self.size > 1 else number

    def back(self, number: int) -> int:
        return self._walk(number, range(ROUNDS - 1, -1, -1), True) if self.size > 1 else number


def _alphabet(char: str, all_hex: bool) -> str:
    if all_hex:
        return _HEX
    return next((a for a in (_DIGITS, _LOWER, _UPPER) if char in a), char)


def _number(text: str, alphabets: list[str]) -> tuple[int, int]:
    value, size = 0, 1
    for char, alphabet in zip(text, alphabets):
        value, size = value * len(alphabet) + alphabet.index(char), size * len(alphabet)
    return value, size


def _text(number: int, alphabets: list[str]) -> str:
    out = []
    for alphabet in reversed(alphabets):
        number, place = divmod(number, len(alphabet))
        out.append(alphabet[place])
    return "".join(reversed(out))


class Pseudonyms:
    """Pseudonyms under one key; ``restoring`` turns them back."""

    def __init__(self, key: bytes, restoring: bool = False):
        self.key, self.restoring = key, restoring
        self.moved = lru_cache(maxsize=1 << 16)(self._moved)

    def _moved(self, kind: str, number: int, size: int) -> int:
        permutation = Permutation(self.key, kind, size)
        return permutation.back(number) if self.restoring else permutation.there(number)

    def spelled(self, kind: str, text: str, alphabets: list[str]) -> str:
        number, size = _number(text, alphabets)
        return _text(self.moved(kind, number, size), alphabets)

    def lengthy(self, kind: str, text: str, alphabets: list[str]) -> str:
        """``spelled`` for values of any length: piece by piece, each permuted in
        a way that depends on all of the value before it."""
        out, before = [], b""
        for i in range(0, len(text), PIECE):
            own = text[i:i + PIECE]
            of = kind if i == 0 else f"{kind}/{before.hex()}"
            new = self.spelled(of, own, alphabets[i:i + PIECE])
            out.append(new)
            before = blake2b(before + (new if self.restoring else own).encode(), digest_size=16).digest()
        return "".join(out)

    def digits(self, kind: str, text: str) -> str:
        return self.spelled(kind, text, [_DIGITS] * len(text))

    @staticmethod
    def _refilled(text: str, digits: str) -> str:
        """``text`` with its digits replaced in order."""
        rest = iter(digits)
        return "".join(next(rest) if c in _DIGITS else c for c in text)

    def phone(self, text: str) -> str:
        digits = re.sub(r"\D", "", text)
        prefix, local = digits[:-10], digits[-10:]
        planned = lambda x: prefix in ("", "1") and x[0] >= "2" and x[3] >= "2"  # a number of the American plan
        if planned(local):
            number = (int(local[:3]) - 200) * 800 + int(local[3:6]) - 200
            number = self.moved("phone", number * 10_000 + int(local[6:]), 800 * 800 * 10_000)
            front, line = divmod(number, 10_000)
            area, office = divmod(front, 800)
            return self._refilled(text, f"{prefix}{area + 200}{office + 200}{line:04d}")
        while True:  # a number outside the plan must stay outside: those of the plan are taken by its own
            local = self.digits("phone", local)
            if not planned(local):
                return self._refilled(text, prefix + local)

    def abroad(self, text: str) -> str | None:
        """An international number: its country code stays."""
        code = re.match(r"\+\d+", text).group()
        digits = re.sub(r"\D", "", text[len(code):])
        if not 8 <= len(code) - 1 + len(digits) <= 15:
            return None
        return code + self._refilled(text[len(code):], self.digits("phone" + code, digits))

    def ip(self, text: str) -> str | None:
        parts = [int(p) for p in text.split(".")]
        if max(parts) > 255:
            return None
        number = self.moved("ip", int.from_bytes(bytes(parts), "big"), 1 << 32)
        return ".".join(map(str, number.to_bytes(4, "big")))

    def ssn(self, text: str) -> str | None:
        area, group, serial = (int(p) for p in text.split("-"))
        if area in (0, 666) or area >= 900 or not group or not serial:
            return None
        number = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
        rest, serial = divmod(self.moved("ssn", number, 898 * 99 * 9999), 9999)
        area, group = divmod(rest, 99)
        return f"{area + 1 + (area >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"

    def date(self, text: str) -> str | None:
        gap = next(c for c in text if c in "-/.")
        parts = text.split(gap)
        orders = ((0, 1, 2),) if gap == "-" else ((2, 0, 1), (2, 1, 0)) if gap == "/" else ((2, 1, 0),)
        for order in orders:
            try:
                day = datetime.date(*(int(parts[i]) for i in order)).toordinal() - _FIRST_DAY
            except ValueError:
                continue
            if 0 <= day < _DAYS:
                break
        else:
            return None
        moved = day
        while True:  # a month-first date must read month first again, a day-first one day first
            moved = self.moved("date", moved, _DAYS)
            new = datetime.date.fromordinal(moved + _FIRST_DAY)
            if gap != "/" or (new.day > 12) == (order == (2, 1, 0)) or order == (2, 0, 1):
                break
        fields = {order[0]: f"{new.year:04d}", order[1]: f"{new.month:02d}", order[2]: f"{new.day:02d}"}
        return gap.join(fields[i] for i in range(3))

    def iban(self, text: str) -> str | None:
        bare = text.replace(" ", "")
        country, account = bare[:2], bare[4:]
        if not 11 <= len(account) <= 30 or iban_digits(country, account) != bare[2:4]:
            return None
        account = self.spelled("iban" + country, account, [_alphabet(c, False) for c in account])
        rest = iter(country + iban_digits(country, account) + account)
        return "".join(c if c == " " else next(rest) for c in text)

    def card(self, text: str) -> str | None:
        digits = re.sub(r"\D", "", text)
        if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
            return None
        body = digits[0] + self.digits("card" + digits[0], digits[1:-1])
        return self._refilled(text, body + luhn_digit(body))

    def key_id(self, text: str) -> str:
        return text[:4] + self.spelled("key", text[4:], [_DIGITS + _UPPER] * 16)

    def secret(self, text: str) -> str:
        all_hex = all(c in _HEX for c in text)
        return self.lengthy("secret", text, [_alphabet(c, all_hex) for c in text])

    def mail(self, local: str) -> str:
        return self.lengthy("mail", local, [_alphabet(c, False) for c in local])

    def text(self, text: str) -> tuple[str, int]:
        """The text with all values replaced, and how many there were."""
        if not _MAYBE.search(text):
            return text, 0
        out, last, n, behind = [], 0, 0, 0
        for found in _PATTERN.finditer(text):
            start, end = found.span()
            before, behind = behind, end
            kind = next(k for k in ("phone", "abroad", "ip", "ssn", "date", "iban", "card", "key", "secret", "mail")
                        if found.group(k))
            if kind == "mail":
                # What stands before the mark, back to whatever was found last.
                head = text[before:start]
                local = head[len(head.rstrip(_LOCAL)):]
                if not local:
                    continue
                start, end = start - len(local), start
                new = self.mail(local)
            elif kind == "secret":
                start, end = found.span("value")
                new = self.secret(found.group("value"))
            else:
                new = getattr(self, "key_id" if kind == "key" else kind)(found.group())
            if new is None:
                continue
            out += [text[last:start], new]
            last, n = end, n + 1
        return ("".join([*out, text[last:]]), n) if n else (text, 0)


def pseudonymise(docs: DataFrame, key: bytes, restoring: bool = False) -> DataFrame:
    """``docs`` with every personal value in ``text`` replaced; a column
    ``n_replaced`` (long) tells how many there were.

    Telephone and card numbers, IP addresses, social security numbers, dates,
    IBANs, access keys, values of passwords and tokens, and the local part of
    e-mail addresses. What only looks like a value (a card that fails Luhn, a
    30 February) stays. ``restoring`` reverses a result made with the same key.

    A null text stays null with 0 replaced, an empty one empty. All other
    columns pass unchanged, null or not; ``n_replaced`` replaces a column of
    that name. Repeated rows are treated alike. No shuffle.
    """
    columns = [c for c in docs.columns if c != "n_replaced"]

    def replace(batches):
        own = Pseudonyms(key, restoring)
        for batch in batches:
            texts, counts = [], np.zeros(batch.num_rows, np.int64)
            for i, text in enumerate(batch.column("text")):
                text = text.as_py()
                if text is not None:
                    text, counts[i] = own.text(text)
                texts.append(text)
            yield {c: batch.column(c) for c in columns} | {
                "text": pa.array(texts, pa.string()), "n_replaced": counts}

    kinds = dict(docs.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in columns)
    return map_arrow(docs.select(*[f"`{c}`" for c in columns]), replace, f"{schema}, n_replaced long",
                     [*columns, "n_replaced"])
