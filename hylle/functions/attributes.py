"""Attribute objects with any keys, as VARIANT columns (SF31, SF36, SC8).

The rules that make attributes know a closed set of fields; what is stored may hold more,
nested ones too. An open object keeps all of them through a write and a read, and merging
two takes the later one's value key by key.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hylle.functions.text import col
from hylle.schema import ATTRIBUTE_FIELDS


def no_keys() -> Column:
    return F.parse_json(F.lit("{}"))


def from_text(text: Column | str) -> Column:
    """The object of a JSON text; anything else counts as one without keys."""
    t = col(text)
    return F.coalesce(F.when(t.rlike(r"^\s*\{"), F.try_parse_json(t)), no_keys())


def from_fields(fields: Column | str) -> Column:
    """The object of the typed fields that are not missing."""
    return F.coalesce(F.parse_json(F.to_json(col(fields))), no_keys())


def fields_of(attributes: Column | str) -> Column:
    """The known fields, typed; a value of another type counts as missing."""
    a = col(attributes)
    return F.struct(
        *[F.try_variant_get(a, f"$.{name}", kind.simpleString()).alias(name) for name, kind in ATTRIBUTE_FIELDS]
    )


def keys_of(attributes: Column) -> Column:
    return attributes.cast(T.MapType(T.StringType(), T.VariantType()))


def merged(earlier: Column | str, later: Column | str) -> Column:
    """Both objects' keys; where both have one, the later value counts, a JSON null too."""
    both = F.map_zip_with(
        keys_of(F.coalesce(col(earlier), no_keys())),
        keys_of(F.coalesce(col(later), no_keys())),
        lambda _, old, new: F.coalesce(new, old),
    )
    return F.to_variant_object(both)
