"""Cleaning of names and numbers as they come from Swedish public sources."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from causalgrid.session import small_batches

# UTF-8 letters that were read as Windows-1252 or Latin-1.
MOJIBAKE = {
    "Ã…": "Å",
    "Ã„": "Ä",
    "Ã–": "Ö",
    "Ã¥": "å",
    "Ã¤": "ä",
    "Ã¶": "ö",
    "Ã©": "é",
    "Ã¸": "ø",
}

# Letters written as base plus combining mark, and their single-character form.
DECOMPOSED = {unicodedata.normalize("NFD", letter): letter for letter in "ÅÄÖÉåäöé"}

# Fixed value: column names that are taken to hold names of places.
NAME_COLUMNS = re.compile("name|region|kommun|lan|municipality|ort|stad", re.IGNORECASE)


def _replaced(c: Column, table: dict[str, str]) -> Column:
    return reduce(lambda acc, kv: F.replace(acc, F.lit(kv[0]), F.lit(kv[1])), table.items(), c)


# Ranges without characters that normalisation changes or moves.
MAY_COMPOSE = r"[^\x{0000}-\x{02FF}\x{2002}-\x{20CF}]"


def repair_mojibake(c: Column) -> Column:
    # all of them begin with the same letter, and most texts have none of it
    return F.when(F.contains(c, F.lit("Ã")), _replaced(c, MOJIBAKE)).otherwise(c)


def repair_latin1(c: Column) -> Column:
    """Undo one wrong Latin-1 reading of UTF-8 bytes where that is possible at all."""
    raw = F.encode(c, "ISO-8859-1")
    single_bytes = c.rlike(r"\A[\x00-\xFF]*\z")
    # the bytes of other strings cannot be asked for, hence the nested conditions
    return F.when(single_bytes, F.when(F.is_valid_utf8(raw), F.decode(raw, "UTF-8")).otherwise(c)).otherwise(c)


def compose(c: Column) -> Column:
    """NFC for the letters of the Swedish alphabet, with built-in functions only."""
    return _replaced(c, DECOMPOSED)


# Fixed value: texts that are held as Python strings at a time.
TEXTS_AT_A_TIME = 100


@F.arrow_udf(StringType())
def _composed(texts: pa.Array) -> pa.Array:
    def part(begin: int) -> pa.Array:
        own = texts.slice(begin, TEXTS_AT_A_TIME).to_pylist()
        return pa.array([t if t is None else unicodedata.normalize("NFC", t) for t in own], pa.string())

    return pa.concat_arrays([part(k) for k in range(0, max(1, len(texts)), TEXTS_AT_A_TIME)])


def compose_any(c: Column) -> Column:
    """NFC for any script; Spark has no built-in for it.

    Letters below U+0300 stay as they are under NFC, and so do dashes, quotes and currency signs, so only texts
    with another character are handed to Python, in batches that are bounded by their bytes.
    """
    small_batches(SparkSession.active())
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(_composed(F.when(c.rlike(MAY_COMPOSE), c)), c)


def clean_name(c: Column, any_script: bool = False) -> Column:
    repaired = repair_latin1(repair_mojibake(c))
    return compose_any(repaired) if any_script else compose(repaired)


def name_columns(df: DataFrame) -> list[str]:
    return [c for c, kind in df.dtypes if kind == "string" and NAME_COLUMNS.search(c)]


def clean_names(df: DataFrame, columns: Sequence[str] | None = None, any_script: bool = False) -> DataFrame:
    """Clean the given columns, or every string column that looks like a name; NULL stays NULL."""
    chosen = [c for c in (columns if columns is not None else name_columns(df)) if c in df.columns]
    return df.withColumns({c: clean_name(F.col(c), any_script) for c in chosen})


def null_audit(before: DataFrame, after: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL counts per column before and after a cleaning step; they must not differ."""
    def counts(df: DataFrame, label: str) -> DataFrame:
        one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
        return one.unpivot([], list(columns), "column", label)

    return counts(before, "nulls_before").join(counts(after, "nulls_after"), "column")


def strip_code_suffix(c: Column) -> Column:
    """``Stockholm (0180)`` to ``Stockholm``."""
    return F.trim(F.regexp_replace(c, r"\s*\(\d+\)\s*$", ""))


def plain_code(c: Column) -> Column:
    """``0180`` to 180; NULL if it is no number."""
    return F.trim(c).try_cast("int")


def locale_double(c: Column) -> Column:
    """Numbers with a decimal comma or point; NULL if unreadable, NaN or infinite."""
    x = F.trim(F.replace(c, F.lit(","), F.lit("."))).try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


# What Windows-1252 has in place of the control characters 0x80 to 0x9F.
WINDOWS_1252 = {
    0x80: "€", 0x82: "‚", 0x83: "ƒ", 0x84: "„", 0x85: "…", 0x86: "†", 0x87: "‡", 0x88: "ˆ", 0x89: "‰", 0x8A: "Š", 0x8B: "‹", 0x8C: "Œ",
    0x8E: "Ž", 0x91: "‘", 0x92: "’", 0x93: "“", 0x94: "”", 0x95: "•", 0x96: "–", 0x97: "—", 0x98: "˜", 0x99: "™", 0x9A: "š", 0x9B: "›",
    0x9C: "œ", 0x9E: "ž", 0x9F: "Ÿ",
}


def _as_declared(content: Column, declared: str) -> Column | None:
    """Text in the declared encoding, NULL where the bytes do not fit it; None for an unknown name."""
    name = declared.lower().replace("_", "-")
    utf8 = F.when(F.is_valid_utf8(content), F.decode(content, "UTF-8"))
    if name in ("utf-8", "utf8"):
        return utf8
    if name in ("us-ascii", "ascii"):
        return F.when(~F.hex(content).rlike("^(..)*[89A-F]"), utf8)
    if name in ("iso-8859-1", "latin1", "latin-1"):
        return F.decode(content, "ISO-8859-1")
    if name in ("windows-1252", "cp1252"):
        latin1 = F.decode(content, "ISO-8859-1")
        return F.translate(latin1, "".join(map(chr, WINDOWS_1252)), "".join(WINDOWS_1252.values()))
    if name in ("utf-16be", "utf-16le"):
        # whole code units, surrogates in pairs
        unit, high, low = ("{0}..", "D[89AB]..", "D[C-F]..") if name == "utf-16be" else ("..{0}", "..D[89AB]", "..D[C-F]")
        plain = unit.format("(?:[0-9A-CEF].|D[0-7])")
        fits = F.hex(content).rlike(f"^(?:{plain}|{high}{low})*$")
        return F.when(fits, F.decode(F.when(fits, content), name.upper()))
    return None


def decode_bytes(content: Column, declared: str = "utf-8") -> Column:
    """Bytes to text: the declared encoding, then UTF-8, then Latin-1; NULL if damaged.

    An unknown encoding, or bytes that do not fit the declared one, go on to the next. A
    replacement character in the result means the damage was done before the bytes were
    stored. Latin-1 accepts every byte, so nothing can come after it.
    """
    wanted = _as_declared(content, declared)
    rest = [_as_declared(content, "utf-8"), F.decode(content, "ISO-8859-1")]
    text = F.coalesce(*([] if wanted is None else [wanted]), *rest)
    return F.when(~F.contains(text, F.lit("�")), text)


def charset_of(content_type: Column) -> Column:
    """``application/json; charset=ISO-8859-1`` to ``iso-8859-1``; UTF-8 if not given."""
    found = F.lower(F.regexp_extract(content_type, r"(?i)charset=\s*\"?([\w.:-]+)", 1))
    return F.when(found != "", found).otherwise("utf-8")
