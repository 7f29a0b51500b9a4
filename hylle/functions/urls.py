"""URL rules as column expressions."""

from __future__ import annotations

import re
from urllib.parse import urlsplit

from pyspark.sql import Column
from pyspark.sql import functions as F

from hylle import fixed_values as V
from hylle.functions import entities
from hylle.functions.text import bound, col, filled, group_of, has_text, strip
from hylle.profiles import StoreProfile

HTTP = "^https?://"
SCHEME = "^[A-Za-z][A-Za-z0-9+.-]*:"
AUTHORITY = "^([A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*"


def is_product_url(url: Column | str, profile: StoreProfile) -> Column:
    """A link to a product: below the store's marker and in no special section.

    The first store also asks for a digit or a further path segment.
    """
    u, marker = col(url), profile.product_marker
    tail = F.try_element_at(F.split(u, marker), F.lit(2))
    ok = u.contains(marker) & (F.coalesce(tail, F.lit("")) != "")
    for section in profile.excluded_sections:
        ok = ok & ~u.contains(section)
    if marker == V.FIRST_STORE_MARKER:
        ok = ok & ~u.endswith(marker) & tail.rlike("[0-9/]")
    return F.coalesce(ok, F.lit(False))


def with_base(url: Column | str, base_url: str) -> Column:
    """The base in front of a URL without http(s); missing URLs stay as they are."""
    u = col(url)
    return F.when(has_text(u) & ~u.rlike(HTTP), F.concat(F.lit(base_url), u)).otherwise(u)


# A path with a step "." or "..", or with an empty step.
HAS_STEPS = r"(^|/)\.\.?(/|;|$)|//"


def without_steps(segments: Column) -> Column:
    """The path of these segments with "." and ".." taken, by a fold that keeps a stack."""
    taken = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda stack, step: F.when(step == "..", F.slice(stack, 1, F.greatest(F.size(stack) - 1, F.lit(0))))
        .when(step == ".", stack)
        .otherwise(F.concat(stack, F.array(step))),
    )
    last = F.element_at(segments, -1)
    path = F.array_join(F.when(last.isin(".", ".."), F.concat(taken, F.array(F.lit("")))).otherwise(taken), "/")
    return F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path))


def resolve(url: Column | str, base_url: str) -> Column:
    """A link as seen from the base page: absolute, host-, root- or folder-relative.

    Steps "." and ".." in relative links are taken, as far as the root; absolute and
    host-relative links keep theirs. Blanks before a link and line breaks and tabs in it
    do not count, nor does a mark without a query or fragment behind it.
    """
    base = urlsplit(base_url)
    origin = f"{base.scheme}://{base.netloc}"
    folder = base.path.rsplit("/", 1)[0] + "/"
    odd_folder = F.lit(bool(re.search(HAS_STEPS, folder)))

    def taken(u: Column) -> Column:
        """A root- or folder-relative link with its steps taken."""
        path = F.regexp_extract(u, r"^(?s)((?:[^?#]*/)?[^/;?#]*)", 1)
        steps = F.split(path, "/")
        # empty segments of the folder and the link go, but for the first and the last
        within = F.concat(F.array(*[F.lit(x) for x in folder.split("/")[:-1]]), steps)
        inner = F.filter(F.slice(within, 2, F.greatest(F.size(within) - 2, F.lit(0))), lambda x: x != "")
        segments = F.when(u.startswith("/"), steps).otherwise(
            F.concat(F.slice(within, 1, 1), inner, F.slice(within, -1, 1))
        )
        after = F.substring(u, F.length(path) + 1, F.length(u))
        return F.concat(F.lit(origin), bound(segments, without_steps), after)

    def seen(u: Column) -> Column:
        odd = F.regexp_extract(u, "^[^?#]*", 0).rlike(HAS_STEPS) | (odd_folder & ~u.startswith("/"))
        return (
            F.when(u == "", F.lit(base_url))
            .when(u.rlike(SCHEME), u)
            .when(u.startswith("//"), F.concat(F.lit(f"{base.scheme}:"), u))
            .when(u.startswith("?"), F.concat(F.lit(origin + base.path), u))
            .when(u.startswith("#"), F.concat(F.lit(base_url), u))
            .when(odd, taken(u))
            .when(u.startswith("/"), F.concat(F.lit(origin), u))
            .when(u.isNotNull(), F.concat(F.lit(origin + folder), u))
        )

    def bare(u: Column) -> Column:
        other = u.rlike("^(?!https?:|//)" + SCHEME[1:])
        return F.when(other, u).otherwise(F.regexp_replace(u, r"\??#?$", ""))

    clean = F.translate(F.ltrim(col(url), F.lit(" " + "".join(map(chr, range(1, 32))))), "\t\r\n", "")
    return bound(clean, lambda u: bound(bare(u), seen))


def without_query(url: Column | str) -> Column:
    return F.substring_index(col(url), "?", 1)


def listing_base(url: Column | str) -> Column:
    """URL without query, trailing slashes and a trailing empty filter."""
    return F.regexp_replace(F.rtrim(without_query(url), F.lit("/")), "filters=$", "")


def with_cursor(url: Column | str, page: Column) -> Column:
    """The URL of a listing page, first store: cursor replaced or added."""
    u, n = col(url), page.cast("string")
    return (
        F.when(~u.contains("?"), F.concat(u, F.lit("?filters=&cursor="), n))
        .when(
            u.contains("cursor="),
            F.regexp_replace(u, F.lit("cursor=[0-9]+"), F.concat(F.lit("cursor="), n)),
        )
        .otherwise(F.concat(u, F.lit("&cursor="), n))
    )


def form_decoded(c: Column) -> Column:
    return F.coalesce(F.try_url_decode(c), c)


def form_encoded(c: Column) -> Column:
    encoded = F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A"))
    return F.replace(encoded, F.lit("%7E"), F.lit("~"))


def with_page(url: Column | str, page: Column, base_url: str) -> Column:
    """The URL of a listing page, second store.

    The ``page`` parameter is replaced in place or added last. Blank parameters and
    the fragment go; values of a repeated parameter move to its first place.
    """
    address = F.substring_index(col(url), "#", 1)
    path = F.regexp_replace(without_query(address), AUTHORITY, "")
    path = F.regexp_replace(path, ";[^/]*$", "")
    query = F.regexp_extract(address, r"(?s)\?(.*)$", 1)
    given = F.transform(
        F.filter(F.split(query, "&"), lambda p: p.rlike("(?s)=.")),
        lambda p: F.struct(
            form_decoded(F.substring_index(p, "=", 1)).alias("k"),
            form_decoded(F.regexp_extract(p, "(?s)=(.*)$", 1)).alias("v"),
        ),
    )
    given = F.filter(given, lambda p: p["k"] != "page")
    all_keys = F.transform(
        F.filter(F.split(query, "&"), lambda p: p.rlike("(?s)=.")),
        lambda p: form_decoded(F.substring_index(p, "=", 1)),
    )
    keys = F.array_distinct(F.concat(all_keys, F.array(F.lit("page"))))
    paired = F.flatten(
        F.transform(
            keys,
            lambda k: F.when(
                k == "page", F.array(F.concat(F.lit("page="), page.cast("string")))
            ).otherwise(
                F.transform(
                    F.filter(given, lambda p: p["k"] == k),
                    lambda p: F.concat(form_encoded(p["k"]), F.lit("="), form_encoded(p["v"])),
                )
            ),
        )
    )
    return resolve(F.concat(path, F.lit("?"), F.array_join(paired, "&")), base_url)


def category_slug(url: Column | str) -> Column:
    return F.coalesce(group_of(url, "/categories/[0-9]+-([^/]+)/"), F.lit("unknown"))


def title_case(c: Column | str) -> Column:
    """Upper case for a letter after anything but a letter, lower case for the rest."""
    words = F.split(col(c), r"(?<=[^\p{L}])(?=\p{L})")
    upper_first = F.transform(
        words,
        lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1 << 30))),
    )
    return F.array_join(upper_first, "")


def slug_title(slug: Column | str) -> Column:
    return title_case(F.replace(col(slug), F.lit("-"), F.lit(" ")))


def main_category_name(slug: Column | str) -> Column:
    return F.concat(F.lit(V.MAIN_CATEGORY_PREFIX), slug_title(slug))


def last_segment(url: Column | str) -> Column:
    return F.element_at(F.split(F.rtrim(col(url), F.lit("/")), "/"), -1)


def product_id_from_url(url: Column | str) -> Column:
    """Path after the last marker; a hash of the URL where there is none.

    NULL for a missing or empty URL: an id shared by all of them would make them one
    product, so the caller makes one from the row's place.
    """
    u = col(url)
    tail = F.element_at(F.split(u, V.SECOND_STORE_MARKER), -1)
    has_tail = u.contains(V.SECOND_STORE_MARKER) & (tail != "")
    return F.when(has_tail, F.rtrim(tail, F.lit("/"))).when(has_text(u), F.md5(u))


def link_label(text: Column | str) -> Column:
    """Label without check mark and without the count in parentheses."""
    plain = strip(F.replace(col(text), F.lit("✓"), F.lit("")))
    return F.coalesce(strip(group_of(plain, r"^([^(]+)")), plain)


def unescaped(c: Column | str) -> Column:
    """Text with its character references replaced, each once (see ``entities``)."""
    return entities.unescaped(col(c))


def is_subcategory_link(name: Column | str, url: Column | str) -> Column:
    return has_text(name) & F.coalesce(col(url).contains(V.CATEGORY_MARKER), F.lit(False))


def absolute_or_null(url: Column | str, base_url: str) -> Column:
    """An image or product link as absolute URL, NULL without a link."""
    return bound(filled(url), lambda u: F.when(u.rlike(HTTP), u).otherwise(resolve(u, base_url)))
