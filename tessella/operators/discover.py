"""Finding tilesets and naming them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.functions.text import links, resolve

METADATA = "name string, scheme string, minzoom int, maxzoom int, url_template string, tiles long, bounds array<double>, data_bounds array<double>"


def page_links(pages: DataFrame) -> DataFrame:
    """``page_id, link`` of every href, made absolute."""
    return pages.select("page_id", "url", F.explode(links(F.col("html"))).alias("__l")).select("page_id", resolve(F.col("url"), F.col("__l")).alias("link"))


def tilesets(files: DataFrame) -> DataFrame:
    """From metadata files (``folder``, "" for the root, and ``content``): ``path, name, valid``, the root first.

    Content that does not parse is listed as not valid, under its folder's name.
    """
    parsed = F.from_json("content", METADATA, {"mode": "PERMISSIVE"})
    valid = F.col("content").rlike(r"(?s)^\s*\{.*\}\s*$") & F.coalesce(F.try_parse_json("content").isNotNull(), F.lit(False))
    named = files.where(~F.col("folder").contains("/")).select(F.col("folder").alias("path"), F.when(valid, parsed["name"]).alias("__n"), valid.alias("valid"))
    return named.select("path", F.coalesce("__n", F.when(F.col("path") == "", "tileset").otherwise(F.col("path"))).alias("name"), "valid").orderBy(F.col("path") != "", "path")


def distinct_labels(sets: DataFrame, label: str = "name", detail: str = "path") -> DataFrame:
    """Labels made distinct: one used more than once gets its detail in brackets."""
    n = F.count("*").over(Window.partitionBy(label))
    return sets.withColumn(label, F.when(n > 1, F.concat(F.col(label), F.lit(" ("), F.col(detail), F.lit(")"))).otherwise(F.col(label)))


def menu(local: DataFrame, connected: DataFrame, key: str) -> DataFrame:
    """Local tilesets and, besides, those connected that are not local."""
    return local.select(key, F.lit("local").alias("origin")).union(connected.select(key).distinct().join(local.select(key), key, "left_anti").select(key, F.lit("connected").alias("origin")))


def source_template(spec: Column, template: Column) -> Column:
    """The tile URL of a source: a spec with {z} as it is, else its folder and the metadata's template."""
    return F.when(spec.contains("{z}"), spec).otherwise(F.concat(F.rtrim(spec, F.lit("/")), F.lit("/"), template))


def first_tileset(sets: DataFrame) -> DataFrame:
    """The tileset to open with: the root's, or else the first by name; none gives no row."""
    return sets.orderBy(F.col("path") != "", "path").limit(1)


def present(files: DataFrame) -> DataFrame:
    """Folders with a metadata file one level down, whatever is in it: ``path``, in order."""
    return files.where((F.col("folder") != "") & ~F.col("folder").contains("/")).select(F.concat(F.lit("./"), F.col("folder")).alias("path"), F.col("folder").alias("name")).distinct()


def listed_folders(pages: DataFrame) -> DataFrame:
    """``url, folder``: folders right below a listing's own address, from its links; of other hosts or deeper ones none.

    ``pages`` has url, ending in a slash, and html.
    """
    each = pages.select("url", F.explode(links(F.col("html"))).alias("_l")).select("url", resolve(F.col("url"), F.col("_l")).alias("_to"))
    rest = F.expr("substring(_to, length(url) + 1)")
    below = F.col("_to").startswith(F.col("url")) & rest.rlike("^[^/?#]+/$")
    return each.where(below).select("url", F.url_decode(F.regexp_replace(F.regexp_replace(rest, "/$", ""), r"\\+", "%2B")).alias("folder")).distinct()


def site(manifest: DataFrame, listing: DataFrame, metadata: DataFrame) -> DataFrame:
    """``url, folder, label, template``: a site's tilesets, from its manifest where it has one, else from its listing.

    ``manifest`` and ``listing`` have url and folder, ``metadata`` url, folder and content.  A tileset
    counts if its metadata can be read and has a template; labels that several share get the folder.
    """
    without = listing.join(manifest.select("url").distinct(), "url", "left_anti")
    known = manifest.select("url", "folder").unionByName(without.select("url", "folder")).distinct()
    read = known.join(metadata, ["url", "folder"]).select("url", "folder", F.from_json("content", METADATA, {"mode": "PERMISSIVE"}).alias("m")).where("m.url_template is not null and m.url_template <> ''")
    name = F.when(F.length("m.name") > 0, F.col("m.name"))
    same = F.count("*").over(Window.partitionBy("url", "m.name"))
    plain = F.coalesce(name, F.col("folder"))
    label = F.when(same > 1, F.concat(plain, F.lit(" ("), F.col("folder"), F.lit(")"))).otherwise(plain)
    return read.select("url", "folder", label.alias("label"), F.concat("url", "folder", F.lit("/"), F.col("m.url_template")).alias("template"))


def facts(files: DataFrame) -> DataFrame:
    """``folder, place, fact, value``: what to tell of a tileset, in order, from its metadata."""
    m = F.from_json("content", METADATA + ", crs string, format string, convention string, bytes long", {"mode": "PERMISSIVE"})
    scheme = F.coalesce("m.scheme", F.lit("mercator"))
    crs = F.coalesce("m.crs", F.when(scheme == "geographic", "EPSG:4326").otherwise("EPSG:3857"))
    row = lambda fact, value: F.struct(F.lit(fact).alias("fact"), value.alias("value"))
    told = F.array(
        row("name", F.coalesce("m.name", F.lit("(unnamed)"))),
        row("scheme", F.concat(scheme, F.lit(" / "), crs)),
        row("zooms", F.concat(F.col("m.minzoom").cast("string"), F.lit("-"), F.col("m.maxzoom").cast("string"))),
        row("format", F.concat(F.col("m.format"), F.lit(" ("), F.coalesce("m.convention", F.lit("xyz")), F.lit(")"))),
        row("tiles", F.format_number("m.tiles", 0)),
        row("size", F.when(F.col("m.bytes").isNotNull(), F.concat(F.format_string("%.1f", F.col("m.bytes") / 1e6), F.lit(" MB")))),
    )
    each = files.select("folder", m.alias("m")).select("folder", F.posexplode(F.filter(told, lambda f: f["value"].isNotNull())).alias("place", "f"))
    return each.select("folder", "place", "f.fact", "f.value")


def as_json(sets: DataFrame) -> DataFrame:
    """One row: the list of tilesets as a document, in order of path."""
    entries = F.array_sort(F.collect_list(F.struct("path", "name")))
    return sets.agg(F.to_json(entries).alias("tilesets"))
