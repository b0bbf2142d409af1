"""Format-preserving pseudonyms for personal data.

Found values are permuted within their format by a keyed Feistel network with
cycle-walking, so the same value has the same pseudonym in every document and
the text keeps its shape: separators, letter case, number of digits, a valid
check digit, a valid date. Texts are rewritten where they stand; no row moves.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from bazaar.llm import kernels
from bazaar.llm.feistel import permute

_CUE = np.zeros(256, bool)
_CUE[[*range(0x30, 0x3A), 0x40]] = True  # every kind below holds a digit or an @
_FIRST, _LAST = datetime.date(1900, 1, 1), datetime.date(2100, 1, 1)
#: Character classes that a value's characters are permuted within.
_ALPHABETS = [
    "0123456789",
    "abcdefghijklmnopqrstuvwxyz",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþ",
    "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ",
]
_CLASS = {c: (a, i) for a in _ALPHABETS for i, c in enumerate(a)}
_HEX = ("0123456789abcdef", "0123456789ABCDEF")
#: What is looked for, in order of precedence.
_KINDS = regex.compile(
    r"""
      (?P<email>[\w.%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})
    | (?<![\w.])(?P<ip>\d{1,3}(?:\.\d{1,3}){3})(?![\w]|\.\d)
    | (?<!\w)(?P<iban>[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?)(?!\w)
    | (?<!\w)(?P<hex>(?=[a-fA-F]*\d)[0-9a-fA-F]{32,})(?!\w)
    | (?<!\w)(?P<date>\d{4}-\d{2}-\d{2}|\d{1,2}[./]\d{1,2}[./]\d{4})(?![\w]|[./-]\d)
    | (?<!\w)(?P<ssn>\d{3}-\d{2}-\d{4})(?![\w]|-\d)
    | (?<!\w)(?P<number>\d{4}(?:[ -]\d{4}){2,3}(?:[ -]\d{1,3})?|\d{13,19})(?!\w)
    | (?<![\w+])(?P<phone>\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}
        | \(\d{3}\)[ ]?\d{3}[ .-]\d{4} | \d{3}[.-]\d{3}[.-]\d{4} | 0\d{9,11})(?!\w)
    """,
    regex.VERBOSE,
)


def luhn(digits: str) -> int:
    """The check digit that follows these digits."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def _mixed(value: str, key: bytes, kind: bytes, alphabets: dict | None = None) -> str:
    """Permute all characters that belong to an alphabet, as one number; others stay."""
    own = [(alphabets or _CLASS).get(c) for c in value]
    n, number = 1, 0
    for x in own:
        if x:
            n *= len(x[0])
            number = number * len(x[0]) + x[1]
    if n == 1:
        return value
    shape = "".join(x[0][0] if x else c for x, c in zip(own, value, strict=True))
    number = permute(number, n, key, kind + shape.encode())
    out = []
    for x, c in zip(reversed(own), reversed(value), strict=True):
        if x:
            number, i = divmod(number, len(x[0]))
            c = x[0][i]
        out.append(c)
    return "".join(reversed(out))


def _refill(shape: str, digits: str) -> str:
    """The digits in the places of the old ones."""
    some = iter(digits)
    return "".join(next(some) if c.isdigit() else c for c in shape)


def _digits(value: str) -> str:
    return "".join(c for c in value if c.isdigit())


def _email(value: str, key: bytes) -> str:
    user, _, host = value.rpartition("@")
    return f"{_mixed(user, key, b'email')}@{host}"


def _ip(value: str, key: bytes) -> str | None:
    parts = [int(x) for x in value.split(".")]
    if max(parts) > 255:
        return None
    number = permute(int.from_bytes(bytes(parts), "big"), 1 << 32, key, b"ip")
    return ".".join(map(str, number.to_bytes(4, "big")))


def _iban(value: str, key: bytes) -> str | None:
    """Country kept; the account permuted; check digits made anew (only valid ones are taken)."""
    plain = value.replace(" ", "")
    number = lambda s: int("".join(str(int(c, 36)) for c in s))
    if number(plain[4:] + plain[:4]) % 97 != 1:
        return None
    account = _mixed(plain[4:], key, b"iban")
    check = 98 - number(account + plain[:2] + "00") % 97
    some = iter(f"{plain[:2]}{check:02d}{account}")
    return "".join(c if c == " " else next(some) for c in value)


def _hexadecimal(value: str, key: bytes) -> str:
    base = _HEX[value != value.lower()]
    return _mixed(value, key, b"hex", {c: (base, int(c, 16)) for c in "0123456789abcdefABCDEF"})


def _date(value: str, key: bytes) -> str | None:
    """Valid dates of 1900 to 2099 change places; the layout stays."""
    mark = next(c for c in value if not c.isdigit())
    parts = [int(x) for x in value.split(mark)]
    year, month, day = parts if mark == "-" else parts[::-1]
    try:
        date = datetime.date(year, month, day)
    except ValueError:
        return None
    if not _FIRST <= date < _LAST:
        return None
    date = _FIRST + datetime.timedelta(permute((date - _FIRST).days, (_LAST - _FIRST).days, key, b"date"))
    return f"{date:%Y-%m-%d}" if mark == "-" else f"{date.day:02d}{mark}{date.month:02d}{mark}{date.year}"


def _number(value: str, key: bytes) -> str | None:
    """Card and account numbers; where the last digit is a valid check digit, it stays one."""
    digits = _digits(value)
    if not 13 <= len(digits) <= 19:
        return None
    if luhn(digits[:-1]) == int(digits[-1]):
        body = _mixed(digits[:-1], key, b"card")
        return _refill(value, body + str(luhn(body)))
    return _refill(value, _mixed(digits, key, b"number"))


def _ssn(value: str, key: bytes) -> str | None:
    return None if value[:3] == "000" else _refill(value, _mixed(_digits(value), key, b"ssn"))


def _phone(value: str, key: bytes) -> str | None:
    """Country code kept; the digits after it are permuted whatever separates them."""
    head = regex.match(r"\+\d{1,3}(?=[ .(-])|\+\d", value)
    code = head[0] if head else ""
    digits = _digits(value[len(code) :])
    if not 7 <= len(digits) <= 14:
        return None
    return code + _refill(value[len(code) :], _mixed(digits, key, b"phone" + code.encode()))


_CHANGES: dict[str, Callable[[str, bytes], str | None]] = {
    "email": _email, "ip": _ip, "iban": _iban, "hex": _hexadecimal, "date": _date, "ssn": _ssn, "number": _number,
    "phone": _phone,
}


def rewrite(text: str, key: bytes) -> tuple[str, list[str]]:
    """The text with pseudonyms, and the kinds of the values in it, in order."""
    kinds: list[str] = []

    def change(found) -> str:
        kind = found.lastgroup
        new = _CHANGES[kind](found[0], key)
        if new is None:
            return found[0]
        kinds.append(kind)
        return new

    return _KINDS.sub(change, text), kinds


def _rewritten(column: pa.Array, key: bytes) -> tuple[pa.Array, list[list[str]]]:
    """Only texts with a digit or an @ are looked at one by one."""
    data, offsets = kernels.text_bytes(column)
    marks = np.concatenate([[0], np.cumsum(_CUE[data])])
    rows = np.flatnonzero(marks[offsets[1:]] > marks[offsets[:-1]])
    kinds: list[list[str]] = [[] for _ in range(len(column))]
    if not len(rows):
        return column, kinds
    new: list[str | None] = [None] * len(column)
    for row in rows.tolist():
        new[row], kinds[row] = rewrite(column[row].as_py(), key)
    seen = np.zeros(len(column), bool)
    seen[rows] = True
    return pa.compute.if_else(pa.array(seen), pa.array(new, column.type), column), kinds


def pseudonymised(docs: DataFrame, key: bytes, text_column: str = "text") -> DataFrame:
    """The rows of ``docs``, with all columns and in place, with pseudonyms in the text.

    Emails (the part before the @), IPv4 addresses, IBANs, card and account
    numbers of 13 to 19 digits, social security and phone numbers, hexadecimal
    secrets of 32 digits or more and dates are changed when valid; other text
    stays as it is. Null texts stay null, empty ones empty; repeated rows are
    changed alike; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.schema.get_field_index(text_column)
            for part in kernels.slices(batch, text_column):
                new, _ = _rewritten(part.column(place), key)
                yield pa.record_batch([new if i == place else c for i, c in enumerate(part.columns)], schema=part.schema)

    return docs.mapInArrow(run, docs.schema)


def pseudonyms(docs: DataFrame, key: bytes, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, rewritten ``text`` and ``kinds`` (of the values changed, in order) of every row; see ``pseudonymised``."""
    docs = docs.select(docs[id_column].cast("bigint").alias("doc_id"), docs[text_column].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in kernels.slices(batch, "text"):
                new, kinds = _rewritten(part.column(1), key)
                yield pa.record_batch(
                    [part.column(0), new, pa.array(kinds, pa.list_(pa.string()))], names=["doc_id", "text", "kinds"]
                )

    return docs.mapInArrow(run, "doc_id bigint, text string, kinds array<string>")
