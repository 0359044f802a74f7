"""B1: HTML character references decoded in one pass, as a column expression.

The text is cut at its references, each reference is decoded by itself, and the pieces are joined
again, so nothing is decoded twice (``&amp;lt;`` becomes ``&lt;``). Names come from the standard
library's table (longest name first where the semicolon is missing), split by hash into small maps that
Spark folds into one constant; numbers are decimal or hexadecimal. Null stays null; an unknown name and a
bare ``&`` stay as they are.
"""

from __future__ import annotations

import json
import zlib
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsframe.functions.memo import per_session

REF_RE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
BUCKETS = 1024
REPLACEMENT = "\ufffd"


def _buckets() -> str:
    rows: list[dict[str, str]] = [{} for _ in range(BUCKETS)]
    for name, text in html5.items():
        rows[zlib.crc32(name.encode()) % BUCKETS][name] = text
    return json.dumps(rows)


def _open_names() -> str:
    """The names that need no semicolon, longest first."""
    return "|".join(sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n)))


def _c1(code: int) -> str:
    """What a reference to a C1 control means: the character of that byte in Windows-1252, if it has one."""
    try:
        return bytes([code]).decode("cp1252")
    except UnicodeDecodeError:
        return chr(code)


def _character(code: Column) -> Column:
    """The character of a code point; the leading space keeps a byte order mark from being dropped."""
    bits = F.unhex(F.concat(F.lit("00000020"), F.lpad(F.hex(code), 8, "0")))
    return F.substring(F.decode(bits, "UTF-32"), 2, 1)


def _number(ref: Column) -> Column:
    """Text of a numeric reference."""
    sixteen = F.substring(ref, 3, 1).isin("x", "X")
    digits = F.regexp_replace(F.regexp_extract(ref, "^&#[xX]?0*([0-9a-fA-F]*)", 1), "^$", "0")
    far = F.length(digits) > F.when(sixteen, 6).otherwise(7)  # past the last code point
    code = F.when(far, F.lit(0x110000)).when(sixteen, F.conv(digits, 16, 10)).otherwise(digits).cast("long")
    control = (code.between(1, 8) | (code == 0x0B) | code.between(0x0E, 0x1F) | (code == 0x7F)
               | code.between(0xFDD0, 0xFDEF) | (code.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE))
    c1 = F.array(*[F.lit(_c1(c)) for c in range(0x80, 0xA0)])
    return (F.when((code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF), REPLACEMENT)
            .when(code.between(0x80, 0x9F), F.get(c1, (code - 0x80).cast("int")))
            .when(control, "").otherwise(_character(code)))


def _name(ref: Column) -> Column:
    """Text of a named reference."""
    maps = F.from_json(F.lit(_buckets()), "array<map<string,string>>")

    def look(name: Column) -> Column:
        return F.try_element_at(F.get(maps, F.pmod(F.crc32(name.cast("binary")), F.lit(BUCKETS)).cast("int")), name)

    name = F.substring(ref, 2, 40)
    short = F.regexp_extract(name, f"^({_open_names()})", 1)
    return F.coalesce(look(name), F.when(short != "", F.concat(look(short), F.substr(name, F.length(short) + 1))), ref)


def _expression(text: Column) -> Column:
    refs = F.regexp_extract_all(text, F.lit(REF_RE), F.lit(0))
    gaps = F.split(text, REF_RE, -1)
    after = F.slice(gaps, F.lit(2), F.size(refs))
    tail = F.zip_with(refs, after, lambda r, g: F.concat(F.when(r.startswith("&#"), _number(r)).otherwise(_name(r)), g))
    return F.when(~text.contains("&"), text).otherwise(F.concat(F.get(gaps, 0), F.array_join(tail, "")))


@per_session
def _of_column(name: str) -> Column:
    return _expression(F.col(name))


def unescape(col) -> Column:
    """B1: ``col`` (a column name or an expression) with every character reference decoded once."""
    return _of_column(col) if isinstance(col, str) else _expression(col)
