"""The two stores as data: what differs between them, nothing else."""

from __future__ import annotations

from dataclasses import dataclass

from hylle import fixed_values as V


@dataclass(frozen=True)
class StoreProfile:
    """Differences between stores that the shared operators read."""

    name: str
    product_marker: str
    excluded_sections: tuple[str, ...]
    header_text: str | None
    attribute_groups: tuple[str, ...]
    base_url: str = "https://shop.example"
    page_cap: int = V.PAGE_CAP


STORE1 = StoreProfile(
    name="store1",
    product_marker=V.FIRST_STORE_MARKER,
    excluded_sections=V.FIRST_STORE_SECTIONS,
    header_text=V.HEADER_TEXT,
    attribute_groups=("size", "fat", "pack", "dietary", "features", "egg", "cheese"),
)

STORE2 = StoreProfile(
    name="store2",
    product_marker=V.SECOND_STORE_MARKER,
    excluded_sections=V.SECOND_STORE_SECTIONS,
    header_text=None,
    attribute_groups=("size", "fat", "pack", "egg"),
)
