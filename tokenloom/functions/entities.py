"""HTML character references decoded by built-in functions, as ``html.unescape`` of Python's library does.

A text is cut at its ampersands, and each piece is looked at on its own: no reference spans two of them. Names come from the
standard library's table when the expression is built.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable
from functools import cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# A name may not hold these; 32 characters is the most that a reference may have before its semicolon.
_NAME = r"[^\t\n\f <&#;]{1,32}"
_LAST = 0x10FFFF
_BUCKETS = 256


@cache
def _named() -> tuple[str, str]:
    """Values of all names as JSON, in buckets by CRC-32 (a map is searched entry by entry), and a pattern of the names that
    need no semicolon, longest first. JSON is one constant to plan, where a map expression would be thousands."""
    buckets: list[dict[str, str]] = [{} for _ in range(_BUCKETS)]
    for name, value in html5.items():
        buckets[zlib.crc32(name.encode()) % _BUCKETS][name] = value
    bare = sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True)
    return json.dumps(buckets), f"^({'|'.join(map(re.escape, bare))})"


def _value_of(name: Column) -> Column:
    table = F.from_json(F.lit(_named()[0]), "array<map<string,string>>")
    return F.get(table, F.pmod(F.crc32(name), F.lit(_BUCKETS)).cast("int"))[name]


def _character(code: Column) -> Column:
    """The character of a code point: four big-endian bytes, decoded."""
    return F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")


def _replaced_codes() -> dict[int, str]:
    """Numbers that stand for another character: NUL, carriage return, and the Windows characters between 128 and 159."""
    out = {0: "�", 13: "\r"}
    for n in range(0x80, 0xA0):
        try:
            out[n] = bytes([n]).decode("cp1252")
        except UnicodeDecodeError:
            out[n] = chr(n)
    return out


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once and spelled once in the plan."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _numbered(code: Column) -> Column:
    """The text of a numeric reference: nothing for non-characters and controls, a question mark for what is no code point."""
    swap = F.from_json(F.lit(json.dumps({str(k): v for k, v in _replaced_codes().items()})), "map<string,string>")
    dropped = (
        code.between(1, 8) | (code == 11) | code.between(14, 31) | (code == 127) | code.between(0xFDD0, 0xFDEF) | (code.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    )
    wrong = code.between(0xD800, 0xDFFF) | (code > _LAST)
    plain = F.when(wrong, "�").when(dropped, "").otherwise(_character(code))
    return F.coalesce(F.when(code < 160, swap[code.cast("string")]), plain)


def _code_of(number: Column) -> Column:
    """The number behind ``#`` or ``#x``; more digits than any code point has stand for one beyond the last."""

    def value(digits: Column) -> Column:
        known = F.when(F.substring(number, 2, 1).isin("x", "X"), F.conv(digits, 16, 10)).otherwise(digits).try_cast("long")
        return F.when(F.length(digits) > 7, F.lit(_LAST + 1)).otherwise(F.coalesce(known, F.lit(0)))

    return _with(F.regexp_replace(number, "^#[xX]?0*", ""), value)


def _piece(text: Column) -> Column:
    """What stands for ``&`` and the text behind it."""

    def behind(name: Column) -> Column:
        return F.substr(text, F.length(name) + 1)

    def by_number(number: Column) -> Column:
        return F.concat(_with(_code_of(number), _numbered), F.regexp_replace(behind(number), "^;", ""))

    def by_name(name: Column) -> Column:
        """``name`` ends in a semicolon, or is empty."""
        known = _with(_value_of(name), lambda v: F.when(v.isNotNull(), F.concat(v, behind(name))))
        return F.coalesce(F.when(name != "", known), _with(F.regexp_extract(text, _named()[1], 0), by_start))

    def by_start(bare: Column) -> Column:
        return F.when(bare == "", F.concat(F.lit("&"), text)).otherwise(F.concat(_value_of(bare), behind(bare)))

    number = F.regexp_extract(text, r"^#(?:[0-9]+|[xX][0-9a-fA-F]+)", 0)
    named = F.when(F.startswith(text, F.lit("#")), F.concat(F.lit("&"), text)).otherwise(_with(F.regexp_extract(text, f"^{_NAME};", 0), by_name))
    return _with(number, lambda n: F.when(n != "", by_number(n)).otherwise(named))


def decoded_references(text: Column) -> Column:
    """``text`` with its character references decoded; null stays null."""
    pieces = F.split(text, "&")
    rest = F.transform(F.slice(pieces, F.lit(2), F.greatest(F.lit(0), F.size(pieces) - 1)), _piece)
    return F.when(F.contains(text, F.lit("&")), F.concat(F.get(pieces, F.lit(0)), F.array_join(rest, ""))).otherwise(text)
