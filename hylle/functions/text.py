"""Text, price, size and id rules as column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from hylle import fixed_values as V

# Blanks in the Unicode sense: the space and the odd ones.
ODD_BLANKS = "".join(
    chr(c)
    for c in (
        *range(0x09, 0x0E), *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
        0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
    )
)
BLANK = f"[ {ODD_BLANKS}]"
FOLD = "(?iu)"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bound(value: Column, rule) -> Column:
    """``rule`` of a value that it names many times, the value being worked out once.

    Catalyst writes an expression out wherever it is named; a lambda's argument is not.
    """
    return F.get(F.transform(F.array(value), rule), F.lit(0))


def text_or_empty(c: Column | str) -> Column:
    return F.coalesce(col(c), F.lit(""))


def has_text(c: Column | str) -> Column:
    """True unless the value is NULL or empty."""
    return text_or_empty(c) != ""


def filled(c: Column | str) -> Column:
    """NULL in place of an empty text."""
    return F.nullif(col(c), F.lit(""))


def strip(c: Column | str) -> Column:
    return F.btrim(col(c), F.lit(" " + ODD_BLANKS))


def group_of(c: Column | str, pattern: str, group: int = 1) -> Column:
    """A group of the first match, NULL where nothing matches."""
    return filled(F.regexp_extract(col(c), pattern, group))


def to_double(c: Column) -> Column:
    return F.replace(c, F.lit(","), F.lit(".")).try_cast("double")


def shortest_terms(terms: Iterable[str]) -> list[str]:
    """Drop terms that hold another term: a text with them has the shorter one too."""
    terms = list(dict.fromkeys(terms))
    return [t for t in terms if not any(o != t and o in t for o in terms)]


def contains_any(text: Column | str, terms: Sequence[str]) -> Column:
    found = F.lit(False)
    for i, term in enumerate(shortest_terms(terms)):
        hit = col(text).contains(term)
        found = hit if i == 0 else found | hit
    return found


def first_label(
    text: Column | str,
    groups: Iterable[tuple[str, Sequence[str]]],
    default: str | None = None,
) -> Column:
    """Label of the first group with a term in the text, in group order."""
    branches = None
    for label, terms in groups:
        hit = contains_any(text, terms)
        branches = F.when(hit, label) if branches is None else branches.when(hit, label)
    return branches.otherwise(F.lit(default)) if default is not None else branches


def clean_text(c: Column | str) -> Column:
    """One blank between words, commas for semicolons, no quotes or apostrophes.

    Characters are mapped in one pass and most texts then need no regex at all.
    """
    mapped = F.translate(text_or_empty(c), ODD_BLANKS + ";", " " * len(ODD_BLANKS) + ",")
    spaced = F.when(mapped.contains("  "), F.regexp_replace(mapped, " {2,}", " ")).otherwise(mapped)
    unquoted = F.replace(F.trim(spaced), F.lit('"'), F.lit(""))
    return F.replace(unquoted, F.lit("'"), F.lit(""))


def parse_price(c: Column | str, header_text: str | None = None) -> Column:
    """First number of the text, 0.0 without one (or for the page header text)."""
    text = col(c)
    if header_text is not None:
        text = F.when(~text.contains(header_text), text)
    return F.coalesce(to_double(group_of(text, V.PRICE)), F.lit(0.0))


def parse_unit_price(c: Column | str) -> Column:
    """struct(price, unit) of texts like ``kr 20,17 /l``."""
    text = F.replace(F.replace(col(c), F.lit("kr"), F.lit("")), F.lit("&nbsp;"), F.lit(" "))
    pattern = V.UNIT_PRICE.replace(r"\s", BLANK)
    return F.struct(
        to_double(group_of(text, pattern, 1)).alias("price"),
        group_of(text, pattern, 2).alias("unit"),
    )


def stable_product_id(name: Column | str, info: Column | str) -> Column:
    """Letters and digits of name and info, lower case, cut to a fixed length."""
    joined = F.concat(text_or_empty(name), F.lit("_"), text_or_empty(info))
    kept = F.regexp_replace(joined, r"[^\p{L}\p{N}_]", "")
    return F.substring(F.lower(kept), 1, V.PRODUCT_ID_LENGTH)


def is_upper(c: Column) -> Column:
    """At least one cased letter and none in lower case."""
    return (F.upper(c) == c) & (F.lower(c) != c)


# Casting an empty text raises and catches inside the cast, so amounts are read
# from a match that is NULL, never empty. The match is its own column in the hot
# path: one regex pass over the info, then cheap reads of a few characters.


def size_match(info: Column | str) -> Column:
    return group_of(info, FOLD + V.SIZE, 0)


def multipack_match(info: Column | str) -> Column:
    return group_of(info, FOLD + V.MULTIPACK, 0)


def leading_amount(match: Column | str) -> Column:
    return to_double(F.regexp_extract(col(match), V.AMOUNT, 0))


def trailing_unit(match: Column | str) -> Column:
    return F.lower(F.regexp_extract(col(match), r"[^0-9\s]+$", 0))


def multipack_size(match: Column | str) -> Column:
    return to_double(F.regexp_extract(col(match), "[xX](" + V.AMOUNT + ")", 1))


def multipack_count(match: Column | str) -> Column:
    return F.regexp_extract(col(match), "[0-9]+", 0)


def size_quantity(info: Column | str) -> Column:
    return leading_amount(size_match(info))


def size_unit(info: Column | str) -> Column:
    return trailing_unit(size_match(info))


def fat_content(info: Column | str) -> Column:
    return to_double(group_of(info, V.PERCENTAGE))


def pack_word_count(info: Column | str) -> Column:
    return group_of(info, FOLD + V.PACK_QUANTITY)


def pack_quantity(info: Column | str) -> Column:
    """The N of ``N x size``, else the N of a pack word."""
    count = multipack_count(multipack_match(info))
    return F.coalesce(count, pack_word_count(info)).try_cast("bigint")


def unit_size(info: Column | str) -> Column:
    return multipack_size(multipack_match(info))


def unit_size_unit(info: Column | str) -> Column:
    return trailing_unit(multipack_match(info))


def egg_size(info: Column | str) -> Column:
    return F.upper(group_of(info, FOLD + V.EGG_SIZE))


def egg_quantity(info: Column | str) -> Column:
    return group_of(info, FOLD + V.EGG_QUANTITY).try_cast("bigint")


def egg_type(lower_info: Column | str) -> Column:
    return first_label(lower_info, V.EGG_TYPES)


def cheese_preparation(lower_info: Column | str) -> Column:
    return first_label(lower_info, V.CHEESE_PREPARATIONS)


def cheese_aging(info: Column | str) -> Column:
    return F.concat(group_of(info, FOLD + V.AGING, 1), F.lit(" måneder"))


def cheese_type(lower_info: Column | str) -> Column:
    return first_label(lower_info, [(t.capitalize(), (t,)) for t in V.CHEESE_TYPES])


def dietary_flag(lower_info: Column | str, flag: str) -> Column:
    return contains_any(lower_info, dict(V.DIETARY_TERMS)[flag])


def flavour(lower_both: Column | str) -> Column:
    return first_label(lower_both, [(f.capitalize(), (f,)) for f in V.FLAVOURS])


def product_type(lower_both: Column | str) -> Column:
    return first_label(lower_both, [(n.capitalize(), words) for n, words in V.PRODUCT_TYPES])


def subcategory(lower_name_info: Column | str) -> Column:
    return first_label(lower_name_info, V.SUBCATEGORIES, V.OTHER_SUBCATEGORY)


def brand(info: Column | str, lower_info_name: Column | str) -> Column:
    """Dictionary brand, else an upper-case part of info, else a short last part."""
    known = first_label(lower_info_name, [(label, (key,)) for key, label in V.BRANDS])
    parts = F.transform(F.split(col(info), ","), strip)
    shouted = F.filter(parts, lambda p: is_upper(p) & (F.length(p) > 1))
    last = F.element_at(parts, -1)
    return F.coalesce(
        known,
        F.try_element_at(shouted, F.lit(1)),
        F.when(col(info).contains(",") & (F.length(last) < V.BRAND_PART_LIMIT), last),
    )


def subtitle_brand(info: Column | str) -> Column:
    """Last word of a subtitle with more than one word."""
    words = F.split(strip(info), rf"{BLANK}+")
    return F.when(F.size(words) > 1, F.element_at(words, -1))


def info_parts(info: Column | str) -> Column:
    """struct(volume, volume_unit, fat_percentage, brand) read per comma part.

    A part is a volume, else a fat percentage, else a brand; of several parts of
    one kind the last counts.
    """
    volume = (FOLD + V.VOLUME_PART).replace(r"\s", BLANK)
    fat = (FOLD + V.FAT_PART).replace(r"\s", BLANK)
    parts = F.transform(F.split(text_or_empty(info), ","), strip)

    def is_brand(part: Column) -> Column:
        return is_upper(part) | contains_any(F.upper(part), V.KNOWN_BRAND_PARTS)

    volumes = F.filter(parts, lambda p: p.rlike(volume))
    rest = F.filter(parts, lambda p: ~p.rlike(volume))
    fats = F.filter(rest, lambda p: p.rlike(fat))
    brands = F.filter(rest, lambda p: ~p.rlike(fat) & is_brand(p))
    last_volume = F.try_element_at(volumes, F.lit(-1))
    last_fat = F.try_element_at(fats, F.lit(-1))
    return F.struct(
        to_double(F.regexp_extract(last_volume, volume, 1)).alias("volume"),
        F.lower(group_of(last_volume, volume, 2)).alias("volume_unit"),
        to_double(F.regexp_extract(last_fat, fat, 1)).alias("fat_percentage"),
        F.try_element_at(brands, F.lit(-1)).alias("brand"),
    )


def dictionary_hits(text: Column | str, entries: Sequence[tuple[str, str]]) -> Column:
    """All (priority, keyword, label) entries whose keyword is in the text.

    The dictionary is a literal of fixed size, so the containment join becomes a
    filter over it: rows never leave their task and no pairs are built.
    """
    table = F.array(
        *[
            F.struct(
                F.lit(i).alias("priority"), F.lit(k).alias("keyword"), F.lit(v).alias("label")
            )
            for i, (k, v) in enumerate(entries)
        ]
    )
    return F.filter(table, lambda e: F.contains(col(text), e["keyword"]))
