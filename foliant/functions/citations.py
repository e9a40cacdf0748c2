"""Scripture citations: the books, their short forms, and the search patterns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .patterns import WEB_SPACE

# Canonical books in order, by testament.
OLD_TESTAMENT = """
Genesis, Exodus, Leviticus, Numbers, Deuteronomy, Joshua, Judges, Ruth,
1 Samuel, 2 Samuel, 1 Kings, 2 Kings, 1 Chronicles, 2 Chronicles, Ezra,
Nehemiah, Esther, Job, Psalms, Proverbs, Ecclesiastes, Song of Solomon, Isaiah,
Jeremiah, Lamentations, Ezekiel, Daniel, Hosea, Joel, Amos, Obadiah, Jonah,
Micah, Nahum, Habakkuk, Zephaniah, Haggai, Zechariah, Malachi
"""
NEW_TESTAMENT = """
Matthew, Mark, Luke, John, Acts, Romans, 1 Corinthians, 2 Corinthians,
Galatians, Ephesians, Philippians, Colossians, 1 Thessalonians,
2 Thessalonians, 1 Timothy, 2 Timothy, Titus, Philemon, Hebrews, James,
1 Peter, 2 Peter, 1 John, 2 John, 3 John, Jude, Revelation
"""

# Every short form of a book, by book.
SHORT_FORMS = """
Genesis: Gen, Gen.
Exodus: Ex, Ex., Exo, Exo., Exod, Exod.
Leviticus: Lev, Lev.
Numbers: Num, Num., Numb, Numb.
Deuteronomy: Deut, Deut., Dt
Joshua: Jos, Josh, Josh.
Judges: Jdg, Jg, Judg, Judg.
Ruth: Ru
1 Samuel: 1 Sa, 1 Sam, 1 Sam., 1Sa, 1Sam, I Sa, I Sam, I Samuel
2 Samuel: 2 Sa, 2 Sam, 2 Sam., 2Sa, 2Sam, II Sa, II Sam, II Samuel
1 Kings: 1 Kgs, 1 Kgs., 1 Ki, 1Kgs, 1Ki, I Kgs, I Ki, I Kings
2 Kings: 2 Kgs, 2 Kgs., 2 Ki, 2Kgs, 2Ki, II Kgs, II Ki, II Kings
1 Chronicles: 1 Chr, 1 Chr., 1 Chron, 1Chr, 1Chron, I Chr, I Chron, I Chronicles
2 Chronicles: 2 Chr, 2 Chr., 2 Chron, 2Chr, 2Chron, II Chr, II Chron, II Chronicles
Ezra: Ezr
Nehemiah: Neh, Neh.
Esther: Est, Est., Esth, Esth.
Psalms: Ps, Ps., Psa, Psa., Psalm, Pss, Pss.
Proverbs: Pr, Pro, Pro., Prov, Prov.
Ecclesiastes: Ecc, Eccl, Eccl., Eccles, Qoh
Song of Solomon: Cant, Cant., Canticles, SOS, SS, Sg of Sol, Song, Song of Sol, Song of Sol., Song of Song, Song of Songs
Isaiah: Is, Isa, Isa.
Jeremiah: Jer, Jer.
Lamentations: Lam, Lam.
Ezekiel: Eze, Eze., Ezek, Ezek., Ezk
Daniel: Dan, Dan., Dn
Hosea: Hos, Hos.
Joel: Jl
Obadiah: Ob, Obad, Obad.
Jonah: Jnh, Jon, Jon.
Micah: Mi, Mic, Mic.
Nahum: Na, Nah, Nah.
Habakkuk: Hab, Hab., Hb
Zephaniah: Zep, Zeph, Zeph., Zp
Haggai: Hag, Hag., Hg
Zechariah: Zc, Zec, Zech, Zech.
Malachi: Mal, Mal., Ml
Matthew: Matt, Matt., Mt, Mt.
Mark: Mk, Mk., Mr, Mr., Mrk, Mrk.
Luke: Lk, Lk., Lu, Lu., Luk, Luk.
John: Jn, Jn., Jno, Joh, Joh.
Acts: Ac, Ac.
Romans: Rm, Ro, Ro., Rom, Rom.
1 Corinthians: 1 Co, 1 Cor, 1 Cor., 1Co, 1Cor, I Co, I Cor, I Corinthians
2 Corinthians: 2 Co, 2 Cor, 2 Cor., 2Co, 2Cor, II Co, II Cor, II Corinthians
Galatians: Ga, Gal, Gal.
Ephesians: Eph, Eph., Ephes
Philippians: Phil, Phil., Php, Pp
Colossians: Col, Col.
1 Thessalonians: 1 Th, 1 Thes, 1 Thess, 1 Thess., 1Th, 1Thes, 1Thess, I Th, I Thes, I Thess, I Thessalonians
2 Thessalonians: 2 Th, 2 Thes, 2 Thess, 2 Thess., 2Th, 2Thes, 2Thess, II Th, II Thes, II Thess, II Thessalonians
1 Timothy: 1 Ti, 1 Tim, 1 Tim., 1Ti, 1Tim, I Ti, I Tim, I Timothy
2 Timothy: 2 Ti, 2 Tim, 2 Tim., 2Ti, 2Tim, II Ti, II Tim, II Timothy
Titus: Ti, Tit, Tit.
Philemon: Phlm, Phlm., Phm, Phm.
Hebrews: Heb, Heb.
James: Jas, Jas., Jm
1 Peter: 1 Pe, 1 Pet, 1 Pet., 1Pe, 1Pet, I Pe, I Pet, I Peter
2 Peter: 2 Pe, 2 Pet, 2 Pet., 2Pe, 2Pet, II Pe, II Pet, II Peter
1 John: 1 Jn, 1 Jn., 1 Joh, 1Jn, 1Joh, I Jn, I Joh, I John
2 John: 2 Jn, 2 Jn., 2 Joh, 2Jn, 2Joh, II Jn, II Joh, II John
3 John: 3 Jn, 3 Jn., 3 Joh, 3Jn, 3Joh, III Jn, III Joh, III John
Jude: Jud, Jud.
Revelation: Apoc, Rev, Rev., Rv
"""

# Bounds of a Quran citation.
SURAHS = 114
AYAHS = 300

# Canonical name under which Quran citations are listed.
QURAN = "S."


def _names(block: str) -> list[str]:
    return [name.strip() for name in block.replace("\n", " ").split(",")]


def testaments() -> dict[str, str]:
    return {name: "OT" for name in _names(OLD_TESTAMENT)} | {
        name: "NT" for name in _names(NEW_TESTAMENT)
    }


def short_forms() -> dict[str, str]:
    """Every short form and its canonical book."""
    rows = (line.split(": ") for line in SHORT_FORMS.strip().splitlines())
    return {form: book for book, forms in rows for form in forms.split(", ")}


def _alternatives(tokens: list[str]) -> str:
    """One branch per first character, so that most positions fail at once."""
    branches: dict[str, list[str]] = {}
    for token in sorted(tokens, key=len, reverse=True):
        branches.setdefault(token[0], []).append(token[1:])
    return "|".join(f"{head}(?:{'|'.join(tails)})" for head, tails in branches.items())


def bible_pattern() -> str:
    """A token on word boundaries, dots and space, chapter:verse and maybe an end.

    A dotted form is its bare form plus one more dot, hence up to two dots.
    """
    forms = set(short_forms()) | set(testaments())
    bare = [f for f in forms if not f.endswith(".")]
    dotted = [f for f in bare if f + "." in forms]
    plain = [f for f in bare if f + "." not in forms]
    return (
        r"(?<!\w)(?=[A-Z1-3])"
        rf"(?:(?:{_alternatives(dotted)})(?!\w)\.{{0,2}}|(?:{_alternatives(plain)})(?!\w)\.?)"
        rf"[{WEB_SPACE}]*\d{{1,3}}:\d{{1,3}}(?:-\d{{1,3}})?"
    )


def quran_pattern() -> str:
    return rf"(?<![A-Za-z])[SQ]\.?[{WEB_SPACE}]{{0,2}}\d{{1,3}}:\d{{1,3}}(?:-\d{{1,3}})?"


def has_numbers(text: Column) -> Column:
    """Cheap test that every text with a citation passes."""
    return text.rlike(r"\d:\d")


def cited(text: Column) -> Column:
    """All Bible and Quran citations of a text, as written."""
    return F.concat(cited_bible(text), cited_quran(text))


def cited_bible(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(bible_pattern()), F.lit(0))


def cited_quran(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(quran_pattern()), F.lit(0))


def token_of(citation: Column) -> Column:
    return F.regexp_replace(citation, rf"\.*[{WEB_SPACE}]*\d{{1,3}}:[\d-]+\z", "")


def numbers_of(citation: Column) -> tuple[Column, Column, Column]:
    """Chapter (or surah), first verse and last verse, the last NULL if absent."""
    digits = F.regexp_extract(citation, r"\d{1,3}:[\d-]+\z", 0)
    parts = F.split(F.translate(digits, "-", ":"), ":")
    return tuple(F.get(parts, i).cast("int") for i in range(3))


def reference(book: Column, chapter: Column, start: Column, end: Column) -> Column:
    base = F.concat(book, F.lit(" "), chapter.cast("string"), F.lit(":"), start.cast("string"))
    return F.when(end.isNull(), base).otherwise(F.concat(base, F.lit("-"), end.cast("string")))


def verse_key(book: Column, chapter: Column, start: Column, end: Column) -> Column:
    """Natural key of a verse; Quran keys carry no book, a missing end is `null`."""
    parts = F.concat_ws(
        "|", chapter, start, F.coalesce(end.cast("string"), F.lit("null"))
    )
    return F.when(book == QURAN, parts).otherwise(F.concat(book, F.lit("|"), parts))


def verse_id(scheme: Column, key: Column) -> Column:
    """Stable id from the natural key, so no table has to hand ids out."""
    return F.sha2(F.concat(scheme, F.lit("|"), key), 256)


def quran_in_bounds(surah: Column, start: Column, end: Column) -> Column:
    return (
        surah.between(1, SURAHS)
        & start.between(1, AYAHS)
        & (end.isNull() | ((end >= start) & (end <= AYAHS)))
    )


def token_table(spark: SparkSession) -> DataFrame:
    """Token, scheme, canonical book and testament: a fixed table of a few hundred rows."""
    where = testaments()
    rows = [(t, "bible", b, where[b]) for t, b in short_forms().items() if not t.endswith(".")]
    rows += [(b, "bible", b, t) for b, t in where.items()]
    listed = [f"('{t}', '{s}', '{b}', '{w}')" for t, s, b, w in rows]
    listed += [f"('{t}', 'quran', '{QURAN}', NULL)" for t in ("S", "Q")]
    return spark.sql(
        f"SELECT * FROM VALUES {', '.join(listed)} AS t(token, scheme, book, testament)"
    )
