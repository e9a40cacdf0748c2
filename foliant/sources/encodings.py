"""Encodings of pages that state none, found from their bytes.

Every candidate that decodes all bytes is scored by the characters it gives: those that
are usual in the texts it is used for count for it, all others against it, and so does a
capital letter behind a small one.  The first of the best candidates wins.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Candidates in the order in which equal scores are decided, with the scripts
# they are used for, or the letters where several are used for one script.
WESTERN = "àáâãäåæçèéêëìíîïñòóôõöøùúûüýÿßœšž"
CENTRAL = "ąćęłńóśźżáčďéěíňřšťúůýžőűäöüßăâîşţđë"
CANDIDATES = {
    "windows-1252": WESTERN,
    "windows-1250": CENTRAL,
    "windows-1255": ("HEBREW",),
    "windows-1251": ("CYRILLIC",),
    "koi8-r": ("CYRILLIC",),
    "windows-1253": ("GREEK",),
    "windows-1256": ("ARABIC",),
    "euc_kr": ("HANGUL",),
    "shift_jis": ("HIRAGANA", "KATAKANA", "CJK", "IDEOGRAPHIC"),
    "euc_jp": ("HIRAGANA", "KATAKANA", "CJK", "IDEOGRAPHIC"),
    "gb18030": ("CJK", "IDEOGRAPHIC"),
    "big5": ("CJK", "IDEOGRAPHIC"),
}
SIGNS = "–—‘’‚“”„…€«»°©®·¡¿ºª§ №„، ؟،؛、。「」！？：；，（）・ー"

# Kana tell Japanese from Chinese texts, whose codes overlap.
KANA = 0.2


@lru_cache(1 << 16)
def _script(char: str) -> str:
    return unicodedata.name(char, "").split(" ")[0].split("-")[0]


def _score(text: str, usual: str | tuple[str, ...]) -> float:
    """Share of usual characters among those beyond ASCII, less what speaks against them; at most 1."""
    odd = [c for c in text if c > "\x7f"]
    if not odd:
        return 1.0
    if isinstance(usual, str):
        fits = sum(c in usual or c.lower() in usual or c in SIGNS for c in odd)
    else:
        fits = sum(_script(c) in usual or c in SIGNS or _script(c) == "FULLWIDTH" for c in odd)
        if usual[0] == "CJK":
            fits -= sum(_script(c) in ("HIRAGANA", "KATAKANA") for c in odd)
        elif usual[0] == "HIRAGANA" and sum(_script(c) in usual[:2] for c in odd) < KANA * len(odd):
            fits -= len(odd) // 10
    # A capital behind a small letter is a letter read by the wrong table.
    wrong = sum(a.islower() and b.isupper() for a, b in zip(text, text[1:]) if b > "\x7f")
    return (fits - wrong) / len(odd)


def detected(body: bytes) -> str:
    """The encoding of bytes that say nothing of it; UTF-8 if they are ASCII or nothing else fits."""
    if body.count(0) * 4 > len(body):
        return "utf-16-le" if body[1::2].count(0) >= body[::2].count(0) else "utf-16-be"
    try:
        body.decode("utf-8")
        return "utf-8"
    except UnicodeDecodeError:
        pass
    best, found = 0.0, "windows-1252"
    for encoding, usual in CANDIDATES.items():
        try:
            score = _score(body.decode(encoding), usual)
        except UnicodeDecodeError:
            # A few single-byte tables have gaps; a page may still hit one.
            if encoding != "windows-1252":
                continue
            score = _score(body.decode(encoding, "replace"), usual)
        if score > best + 1e-9:
            best, found = score, encoding
    return found


# Bytes of a page in which its own statement of an encoding is looked for.
DECLARED_WITHIN = 2048
BYTE_ORDER_MARKS = ((b"\xef\xbb\xbf", "utf-8-sig"), (b"\xff\xfe", "utf-16"), (b"\xfe\xff", "utf-16"))


def encoding_of(body: bytes, given: str | None = None) -> str:
    """By the byte order mark, else the given one, else the page's own, else by its bytes."""
    for mark, encoding in BYTE_ORDER_MARKS:
        if body.startswith(mark):
            return encoding
    if given:
        return given
    declared = re.search(rb"""<meta\b[^>]*?charset\s*=\s*["']?\s*([\w.:-]+)""", body[:DECLARED_WITHIN], re.I)
    return declared[1].decode("ascii", "replace") if declared else detected(body)


def decode(body: bytes, given: str | None = None) -> str:
    """Text of a page, broken bytes replaced; an unknown encoding is looked for in the bytes."""
    try:
        return body.decode(encoding_of(body, given), errors="replace")
    except LookupError:
        return body.decode(detected(body), errors="replace")


def decoded(body: Column) -> Column:
    """Texts of pages stored as bytes; null stays null.  Runs in Arrow batches: bytes have no built-in statistics."""

    @F.pandas_udf(T.StringType())
    def texts(bodies: pd.Series) -> pd.Series:
        return bodies.map(decode, na_action="ignore").astype("object")

    return texts(body)
