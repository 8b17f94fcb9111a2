"""String rules: names, links, tracker entries, readable sizes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def full_match(name: Column, pattern: str) -> Column:
    """The whole name matches, letters in either case; an empty pattern matches nothing."""
    return name.rlike(f"(?i)\\A(?:{pattern})\\z") if pattern else F.lit(False)


def excluded(name: Column, names: list[str]) -> Column:
    """The name is listed, letters as given."""
    return name.isin(names) if names else F.lit(False)


def links(html: Column) -> Column:
    """Targets of all href attributes in double quotes."""
    return F.regexp_extract_all(html, F.lit('(?i)href="([^"]+)"'), F.lit(1))


def resolve(base: Column, link: Column) -> Column:
    """A link of a page made absolute: absolute, from the host's root, or from the page's folder."""
    root = F.regexp_extract(base, "^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    bare = F.regexp_replace(base, "[?#].*$", "")
    folder = F.when(bare == root, F.concat(root, F.lit("/"))).otherwise(F.regexp_replace(bare, "[^/]*$", ""))
    scheme = F.regexp_extract(base, "^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1)
    return F.when(link.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), link).when(link.startswith("//"), F.concat(scheme, link)).when(link.startswith("/"), F.concat(root, link)).otherwise(F.concat(folder, link))


def edition_date(link: Column) -> Column:
    """The date of the first MM-DD-YYYY in a link; null if it isn't one."""
    text = F.regexp_extract(link, r"(\d{2}-\d{2}-\d{4})", 1)
    return F.try_to_timestamp(text, F.lit("MM-dd-yyyy")).cast("date")


def tile_of_url(url: Column, prefix: str = "") -> Column:
    """``z, x, y`` out of a tile URL that holds ``prefix``; null for other names."""
    pattern = r"(\d+)/(\d+)/(\d+)(?:\.[A-Za-z0-9]+)?(?:\?|$)"
    part = lambda i: F.regexp_extract(url, pattern, i).cast("long")
    return F.when(url.contains(prefix) & url.rlike(pattern), F.struct(part(1).alias("z"), part(2).alias("x"), part(3).alias("y")))


def request_class(wire: Column, encoded: Column, decoded: Column) -> Column:
    """Of a request: opaque (no sizes told), cached (fewer bytes on the wire than the body has), downloaded."""
    return F.when((wire == 0) & (encoded == 0) & (decoded == 0), "opaque").when((encoded > 0) & (wire < encoded), "cached").otherwise("downloaded")


def readable_bytes(n: Column) -> Column:
    return F.when(n < 1024, F.concat(n.cast("string"), F.lit(" B"))).when(n < 1048576, F.concat(F.format_string("%.1f", n / 1024.0), F.lit(" KB"))).otherwise(F.concat(F.format_string("%.2f", n / 1048576.0), F.lit(" MB")))


#: Fixed values of the zoom ramp: hue and lightness from the lowest to the highest level, chroma.
HUES, LIGHTS, CHROMA = (264, 29), (0.55, 0.63), 0.25


def zoom_colour(level: Column, top: Column, alpha: float | None = None) -> Column:
    """An OKLCH colour for a zoom level, along a ramp up to the level ``top``."""
    share = F.least(F.greatest(level / F.greatest(top, F.lit(1)), F.lit(0.0)), F.lit(1.0))
    on = lambda ends: ends[0] + (ends[1] - ends[0]) * share
    tail = "" if alpha is None else f" / {alpha}"
    return F.format_string(f"oklch(%.3f {CHROMA} %.1f{tail})", on(LIGHTS), on(HUES))
