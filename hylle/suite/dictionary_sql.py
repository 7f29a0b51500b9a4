"""SQL fragments of the text rules, written for the checking engine."""

from __future__ import annotations

from hylle import fixed_values as V


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def any_term(text: str, terms) -> str:
    return "(" + " OR ".join(f"contains({text}, {quoted(t)})" for t in terms) + ")"


def first_label(text: str, groups, default: str = "NULL") -> str:
    arms = " ".join(f"WHEN {any_term(text, terms)} THEN {quoted(label)}" for label, terms in groups)
    return f"(CASE {arms} ELSE {default} END)"


def capitalised(words):
    return [(w[0].upper() + w[1:], (w,)) for w in words]


def clean(col: str) -> str:
    return (
        f"replace(replace(replace(trim(regexp_replace(coalesce({col}, ''), '\\s+', ' ', 'g')), "
        f"';', ','), '\"', ''), chr(39), '')"
    )


def grab(col: str, pattern: str, group: int, fold: bool = True) -> str:
    flags = ", 'i'" if fold else ""
    return f"nullif(regexp_extract({col}, '{pattern}', {group}{flags}), '')"


def number(expr: str) -> str:
    return f"try_cast(replace({expr}, ',', '.') AS DOUBLE)"


# The patterns of sizes, multipacks, packs and prices.
SIZE = r"(\d+(?:[.,]\d+)?)\s*(l|ml|g|kg|dl|cl|stk)"
MULTI = r"(\d+)x(\d+(?:[.,]\d+)?)\s*(g|ml|l|kg|stk)"
PACK = r"(\d+)\s*(?:pk|stk|pakk|pakning)"

PRICE = (
    r"coalesce(try_cast(replace(regexp_extract({0}, '(\d+[,.]\d+|\d+)', 1), ',', '.') AS DOUBLE), 0.0)"
)
PRICE1 = "CASE WHEN contains({0}, 'Hopp til hovedinnhold') THEN 0.0 ELSE " + PRICE + " END"


def brand(info: str, swap: str) -> str:
    known = first_label(swap, [(label, (key,)) for key, label in V.BRANDS])
    parts = f"list_transform(string_split({info}, ','), lambda x: trim(x))"
    shouted = f"list_filter({parts}, lambda x: upper(x) = x AND lower(x) <> x AND length(x) > 1)[1]"
    last = f"trim(string_split({info}, ',')[-1])"
    return (
        f"coalesce({known}, {shouted}, "
        f"CASE WHEN contains({info}, ',') AND length({last}) < 20 THEN {last} END)"
    )


def subcategory(both: str) -> str:
    return first_label(both, V.SUBCATEGORIES, "'other'")


def multi_or_pack(info: str) -> str:
    return f"try_cast(coalesce({grab(info, MULTI, 1)}, {grab(info, PACK, 1)}) AS BIGINT)"


ATTRIBUTES = {
    "size_quantity": number(grab("ci", SIZE, 1)),
    "size_unit": f"lower({grab('ci', SIZE, 2)})",
    "fat_content": number(grab("ci", r"(\d+(?:[.,]\d+)?)%(?:\s+fett)?", 1, False)),
    "pack_quantity": multi_or_pack("ci"),
    "unit_size": number(grab("ci", MULTI, 2)),
    "unit_size_unit": f"lower({grab('ci', MULTI, 3)})",
    **{flag: any_term("li", terms) for flag, terms in V.DIETARY_TERMS},
    "flavor": first_label("both_", capitalised(V.FLAVOURS)),
    "product_type": first_label(
        "both_", [(n[0].upper() + n[1:], words) for n, words in V.PRODUCT_TYPES]
    ),
    # fixed values: the patterns of egg sizes and numbers and of aging
    "egg_size": f"upper({grab('ci', r'(?:str\.?|størrelse)\s*(xs|s|m|l|xl)', 1)})",
    "egg_quantity": f"try_cast({grab('ci', r'(\d+)\s*(?:stk|egg)', 1)} AS BIGINT)",
    "egg_type": first_label("li", V.EGG_TYPES),
    "cheese_type": first_label("li", capitalised(V.CHEESE_TYPES)),
    "aging": f"{grab('ci', r'(\d+)\s*(?:mnd|måned)', 1)} || ' måneder'",
    "preparation": first_label("li", V.CHEESE_PREPARATIONS),
}
EGG = ("egg_size", "egg_quantity", "egg_type")
CHEESE = ("cheese_type", "aging", "preparation")
FIRST_STORE_ONLY = (*[f for f, _ in V.DIETARY_TERMS], "flavor", "product_type", *CHEESE)


def cleaned(source: str) -> str:
    """The source with clean and lower-case texts beside its columns."""
    return f"""(SELECT *, lower(ci) AS li, lower(cn || ' ' || ci) AS both_, lower(ci || ' ' || cn) AS swap_
 FROM (SELECT *, {clean('name')} AS cn, {clean('info')} AS ci, coalesce(info, '') <> '' AS ok FROM {source} AS s0) AS s1)"""


def enriched(source: str, store: int, keep: str) -> str:
    """Columns in ``keep`` plus brand, subcategory and every attribute."""
    columns = []
    for name, rule in ATTRIBUTES.items():
        if store == 2 and name in FIRST_STORE_ONLY:
            kind = "BOOLEAN" if name in dict(V.DIETARY_TERMS) else "VARCHAR"
            columns.append(f"CAST(NULL AS {kind}) AS {name}")
            continue
        guard = "ok"
        if name in EGG:
            guard = "ok AND sub_ = 'egg'"
        elif name in CHEESE:
            guard = "ok AND sub_ = 'ost'"
        columns.append(f"CASE WHEN {guard} THEN {rule} END AS {name}")
    return f"""(SELECT {keep}, brand_ AS brand, sub_ AS subcategory, {', '.join(columns)}
 FROM (SELECT *,
   CASE WHEN ok THEN coalesce(nullif(brand, ''), {brand('ci', 'swap_')}) ELSE brand END AS brand_,
   CASE WHEN ok THEN coalesce(nullif(subcategory, ''), {subcategory('both_')}) ELSE subcategory END AS sub_
  FROM {cleaned(source)} AS s2) AS s3)"""
