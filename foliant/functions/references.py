"""Character references of pages as characters, in built-in expressions.

Names and their characters are those of the HTML standard, taken from Python's own
table of it; they go into a plan as one literal.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let

# A name may lack its semicolon only if the standard lists it so; it then also counts at
# the start of a longer word.
_BARE = sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True)
_NAMED = json.dumps(html5)
_REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"

# The most frequent names; numbers from 128 to 159 stand for these characters.
_FREQUENT = {"amp;": "&", "lt;": "<", "gt;": ">", "quot;": '"', "nbsp;": " ", "#39;": "'"}
_WINDOWS = "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(0x80, 0xA0))


def _numbered(n: Column) -> Column:
    """The character of a number; what is no character becomes a sign or nothing, as in browsers."""
    char = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    low = n.bitwiseAND(0xFFFF)
    control = n.between(1, 8) | (n == 11) | n.between(14, 31) | (n == 127)
    return (
        F.when(n.isNull() | (n == 0) | (n > 0x10FFFF) | n.between(0xD800, 0xDFFF), "�")
        .when(n.between(0x80, 0x9F), F.substring(F.lit(_WINDOWS), (n - 0x7F).cast("int"), F.lit(1)))
        .when(control | n.between(0xFDD0, 0xFDEF) | (low >= 0xFFFE), "")
        .otherwise(char)
    )


def _character(reference: Column, names: Column) -> Column:
    """What a reference, without its ampersand, stands for; itself if for nothing."""
    digits = F.regexp_replace(F.regexp_extract(reference, r"\A#([0-9]+)", 1), r"\A0+(?=.)", "")
    hexes = F.regexp_replace(F.regexp_extract(reference, r"\A#[xX]([0-9a-fA-F]+)", 1), r"\A0+(?=.)", "")
    number = F.when(digits != "", digits.try_cast("bigint")).when(F.length(hexes) <= 8, F.conv(hexes, 16, 10).try_cast("bigint"))
    frequent = F.lit(None).cast("string")
    for name, char in _FREQUENT.items():
        frequent = F.when(reference == name, char).otherwise(frequent)

    def by_name(start: Column) -> Column:
        rest = F.substring(reference, F.length(start) + 1, F.length(reference))
        return F.when(start != "", F.concat(F.element_at(names, start), rest)).otherwise(F.concat(F.lit("&"), reference))

    begun = let(F.regexp_extract(reference, rf"\A(?:{'|'.join(_BARE)})", 0), by_name)
    return F.when(reference.startswith("#"), F.coalesce(frequent, let(number, _numbered))).otherwise(
        F.coalesce(frequent, F.element_at(names, reference), begun)
    )


def unescape(text: Column) -> Column:
    """The text with every character reference replaced, once and from left to right."""

    def replaced(t: Column) -> Column:
        names = F.from_json(F.lit(_NAMED), "map<string,string>")
        found = F.regexp_extract_all(t, F.lit(_REFERENCE), F.lit(0))

        def joined(chars: Column) -> Column:
            between = F.split(t, _REFERENCE)
            return F.array_join(F.transform(between, lambda part, i: F.concat(part, F.coalesce(F.get(chars, i), F.lit("")))), "")

        chars = F.transform(found, lambda r: _character(F.substring(r, 2, 40), names))
        return F.when(F.contains(t, F.lit("&")), let(chars, joined)).otherwise(t)

    return let(text, replaced)
