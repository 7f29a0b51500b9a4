"""Character references of markup as column expressions (SF34).

The text is cut before each ampersand; a piece that begins with a reference has it
replaced, so that each reference is read once and none arises from another's result.
Names come from Python's own table of HTML names: a whole name counts first, with its
semicolon if it has one, and else the longest known beginning of at least two letters.
Numbers follow the standard: those of the old Windows code page mean its characters, NUL
and what is no character become the replacement character, and controls vanish.
"""

from __future__ import annotations

import json
from functools import cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from hylle.functions.text import bound

REFERENCE = r"^&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
REPLACEMENT = "\ufffd"
LAST = 0x10FFFF


@cache
def name_tables() -> tuple[str, str]:
    """JSON of all names, and of those that need no semicolon."""
    bare = {name: text for name, text in html5.items() if not name.endswith(";")}
    return json.dumps(html5), json.dumps(bare)


@cache
def longest_bare_name() -> int:
    return max(len(name) for name in html5 if not name.endswith(";"))


@cache
def replaced_numbers() -> str:
    """JSON of the numbers that stand for another character."""
    found = {0: REPLACEMENT, 0x0D: "\r"}
    for n in range(0x80, 0xA0):
        try:
            found[n] = bytes([n]).decode("cp1252")
        except UnicodeDecodeError:
            found[n] = chr(n)
    return json.dumps(found)


def table(content: str, key: str = "string") -> Column:
    """A literal map; Catalyst reads the JSON once, when it plans."""
    return F.from_json(F.lit(content), f"map<{key},string>")


def of_number(value: Column) -> Column:
    """The character of a reference's number; a number too large is NULL."""
    return bound(value, character)


def character(number: Column) -> Column:
    control = number.between(0x1, 0x8) | number.between(0xE, 0x1F) | number.between(0x7F, 0x9F) | (number == 0xB)
    no_character = number.between(0xFDD0, 0xFDEF) | (number.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    plain = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    return F.coalesce(
        F.try_element_at(table(replaced_numbers()), number.cast("string")),
        F.when(number.isNull() | (number > LAST) | number.between(0xD800, 0xDFFF), F.lit(REPLACEMENT)),
        F.when(control | no_character, F.lit("")),
        plain,
    )


def of_digits(head: Column) -> Column:
    digits = F.ltrim(F.regexp_extract(head, "^#([0-9]+)", 1), F.lit("0"))
    number = F.when(F.length(digits) <= 7, F.concat(F.lit("0"), digits).try_cast("bigint"))
    return of_number(number)


def of_hex(head: Column) -> Column:
    digits = F.ltrim(F.regexp_extract(head, "^#[xX]([0-9a-fA-F]+)", 1), F.lit("0"))
    number = F.when(F.length(digits) <= 6, F.conv(F.concat(F.lit("0"), digits), 16, 10).try_cast("bigint"))
    return of_number(number)


def of_name(head: Column) -> Column:
    names, bare = name_tables()
    sizes = F.sequence(F.least(F.length(head) - 1, F.lit(longest_bare_name())), F.lit(2), F.lit(-1))
    beginnings = F.filter(
        F.when(F.length(head) > 2, F.transform(sizes, lambda n: F.left(head, n))),
        lambda x: F.try_element_at(table(bare), x).isNotNull(),
    )
    begin = F.try_element_at(beginnings, F.lit(1))
    by_begin = F.concat(F.try_element_at(table(bare), begin), F.substring(head, F.length(begin) + 1, F.length(head)))
    common = F.lit(None).cast("string")
    for name in ("apos;", "quot;", "gt;", "lt;", "amp;"):
        common = F.when(head == name, F.lit(html5[name])).otherwise(common)
    return F.coalesce(common, F.try_element_at(table(names), head), by_begin, F.concat(F.lit("&"), head))


def unescaped(text: Column) -> Column:
    def read(piece: Column) -> Column:
        return bound(F.regexp_extract(piece, REFERENCE, 1), lambda head: replaced(piece, head))

    def replaced(piece: Column, head: Column) -> Column:
        new = (
            F.when(head.rlike("^#[xX]"), of_hex(head)).when(head.startswith("#"), of_digits(head)).otherwise(of_name(head))
        )
        return F.when(head == "", piece).otherwise(F.concat(new, F.substring(piece, F.length(head) + 2, F.length(piece))))

    def read_all(whole: Column) -> Column:
        pieces = F.transform(F.split(whole, "(?=&)"), read)
        return F.when(whole.contains("&"), F.array_join(pieces, "")).otherwise(whole)

    return bound(text, read_all)
