"""Tokens, HTML elements and percentages out of whole texts."""

from __future__ import annotations

import html.entities
import json
import re
import zlib
from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F

from .safe import _col, to_double

# What separates words, and the percentage a rate page quotes.
NOT_WORD = r"[^\p{L}\p{N}]+"
PERCENT = r"([0-9]+\.[0-9]+)%"

# Markup that is no text of the page.
HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b.*?(?:</\1\s*>|\z)"

# Names of character references, most of them with the semicolon that ends them, and the letters
# that the numbers 128 to 159 stand for; both by the standard library's tables.
NAMES = html.entities.html5
# A name is looked up by its checksum among the few names of a slot.
SLOTS = 4096
# What can be a reference; the longest name has 32 characters with its semicolon.
REFERENCE = r"^(?:#[xX][0-9A-Fa-f]+;?|#[0-9]+;?|[A-Za-z][A-Za-z0-9]{1,30};?)"
C1 = "".join(bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(128, 160))
REPLACEMENT = 0xFFFD


def spaced_words(text: Column | str) -> Column:
    """Lower-case words in order, one blank between them."""
    return F.trim(F.regexp_replace(F.lower(_col(text)), NOT_WORD, " "))


def word_array(spaced: Column | str) -> Column:
    """Words of a text that ``spaced_words`` made; a text without words has none."""
    return F.array_remove(F.split(_col(spaced), " "), "")


def words(text: Column | str) -> Column:
    """Lower-case words in order, by one pass of the pattern."""
    return F.array_remove(F.split(F.lower(_col(text)), NOT_WORD), "")


def count_words(word_list: Column, wanted: list[str] | tuple[str, ...]) -> Column:
    return F.size(F.filter(word_list, lambda w: w.isin(*wanted)))


def _name_slots() -> Column:
    """The names and their characters by slot, a constant."""
    slots: list[dict[str, str]] = [{} for _ in range(SLOTS)]
    for name, chars in NAMES.items():
        slots[zlib.crc32(name.encode()) % SLOTS][name] = chars
    return F.from_json(F.lit(json.dumps(slots)), "array<map<string,string>>")


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is named."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _of_code(code: Column) -> Column:
    """The character of a number."""
    code = F.when((code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF),
                  REPLACEMENT).otherwise(code)
    return F.when(code.between(128, 159), F.substr(F.lit(C1), (code - 127).cast("int"))
                  .substr(1, 1)).otherwise(
        F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))


def _of_number(reference: Column) -> Column:
    """What a numbered reference stands for; beyond eight digits no number is a character."""
    digits = F.rtrim(F.ltrim(F.substring(reference, 2, 1 << 30), F.lit("xX0")), F.lit(";"))
    short = F.substring(F.concat(F.lit("0"), digits), 1, 9)
    number = F.when(F.lower(F.substring(reference, 2, 1)) == "x", F.conv(short, 16, 10)).otherwise(short)
    return _bound(number.cast("bigint"), _of_code)


def _of_name(reference: Column) -> Column:
    """(length, characters) of the longest name that the reference begins with, else null."""
    lengths = F.sequence(F.length(reference), F.lit(2), F.lit(-1))

    def look_up(n: Column) -> Column:
        name = F.substring(reference, F.lit(1), n)
        slot = F.get(_name_slots(), (F.crc32(name.cast("binary")) % SLOTS).cast("int"))
        return F.struct(n.alias("length"), F.try_element_at(slot, name).alias("chars"))

    found = F.filter(F.transform(lengths, look_up), lambda f: f["chars"].isNotNull())
    return F.get(found, F.lit(0))


def _after_ampersand(piece: Column) -> Column:
    """What follows an ampersand, with the reference at its start decoded if there is one."""
    unchanged = F.concat(F.lit("&"), piece)

    def decoded(reference: Column) -> Column:
        rest = F.substr(piece, F.length(reference) + 1)
        named = _bound(_of_name(reference), lambda f: F.when(
            f.isNotNull(), F.concat(f["chars"], F.substr(piece, f["length"] + 1))).otherwise(unchanged))
        return (F.when(reference == "", unchanged)
                .when(F.startswith(reference, F.lit("#")), F.concat(_of_number(reference), rest))
                .otherwise(named))

    return _bound(F.regexp_extract(piece, REFERENCE, 0), decoded)


def decode_references(text: Column | str) -> Column:
    """Character references, named and numbered, become their characters in one pass."""
    t = _col(text)
    pieces = F.transform(F.split(t, "&"), lambda piece, i: F.when(i == 0, piece).otherwise(
        _after_ampersand(piece)))
    return F.when(F.contains(t, F.lit("&")), F.array_join(pieces, "")).otherwise(t)


def element_texts(page: Column | str, wanted: Sequence[tuple[str, str | None]]) -> Column:
    """Texts of the first elements with the given tags and ids, as an array in that order.

    Tags inside an element are removed; null where there is none. Elements inside comments, scripts
    and styles do not count. The page is gone through once for them, and all are decoded alike.
    """
    def first(shown: Column, tag: str, element_id: str | None) -> Column:
        attrs = r"(?:\s[^>]*)?"
        if element_id is not None:
            attrs = rf"\s(?:[^>]*\s)?id\s*=\s*[\"']?{re.escape(element_id)}[\"']?{attrs}"
        element = F.regexp_extract(shown, rf"(?is)<{tag}{attrs}>.*?</{tag}\s*>", 0)
        return F.when(element != "", element)

    found = _bound(F.regexp_replace(_col(page), HIDDEN, ""),
                   lambda shown: F.array(*[first(shown, *w) for w in wanted]))
    return F.transform(F.transform(found, lambda e: F.regexp_replace(e, "<[^>]+>", "")),
                       decode_references)


def element_text(page: Column | str, tag: str, element_id: str | None = None) -> Column:
    """Text of the first such element; null where there is none."""
    return F.get(element_texts(page, [(tag, element_id)]), F.lit(0))


def percent(text: Column | str) -> Column:
    """The first percentage with a decimal point, as a fraction; null where there is none."""
    return to_double(F.nullif(F.regexp_extract(_col(text), PERCENT, 1), F.lit(""))) / 100.0


def strip_suffix(code: Column | str, suffix: str) -> Column:
    return F.replace(_col(code), F.lit(suffix), F.lit(""))
