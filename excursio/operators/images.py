"""Image list rules."""

from __future__ import annotations

from excursio.functions.arrays import first_by_key
from excursio.functions.sql import Sql, keep
from excursio.functions.text import contains_any
from excursio.settings import IMAGE_JUNK


def usable(url: Sql, junk=IMAGE_JUNK) -> Sql:
    """Not empty, no SVG, and none of the unwanted words in the address."""
    return (
        f"({url} IS NOT NULL AND {url} <> '' AND NOT endswith({url}, '.svg') "
        f"AND NOT {contains_any(url, junk)})"
    )


def filter_images(images: Sql, junk=IMAGE_JUNK) -> Sql:
    """Usable images, first of each address, in order."""
    return first_by_key(keep(images, lambda i: usable(f"{i}.url", junk)), lambda i: f"{i}.url")
