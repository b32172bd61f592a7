"""File links listed on web pages."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curveloom.functions.scalar import last_token

# An anchor tag, whose quoted values may hold any character, and a link that names its own scheme or host.
ANCHOR = r"""(?i)<a\s(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
ABSOLUTE = r"(?i)^([a-z][a-z0-9+.-]*:|//)"


def site_root(url: Column) -> Column:
    return F.regexp_extract(url, r"^(https?://[^/]+)", 1)


def page_links(
    pages: DataFrame, base: Column, extension: str | None = None, attribute: str = "href", html: str = "html",
    css_class: str | None = None,
) -> DataFrame:
    """One row per anchor with the attribute: ``page_id, file, link`` with ``link = base/file``.

    Values may be in double, single or no quotes, and names in either case. A link with a scheme or host of its own stays
    as it is. With an ``extension`` only the files whose text after the last dot equals it are kept, and with a
    ``css_class`` only anchors of that class.
    """
    files = _anchors(pages, base.alias("_base"), attribute, html, css_class)
    absolute = F.col("_found").rlike(ABSOLUTE)
    files = files.select("page_id", "_base", absolute.alias("_absolute"),
                         F.when(absolute, F.col("_found")).otherwise(F.ltrim(F.col("_found"), F.lit("/"))).alias("file"))
    if extension is not None:
        files = files.where(last_token(F.col("file"), ".") == extension)
    link = F.when(F.col("_absolute"), F.col("file")).otherwise(F.concat_ws("/", "_base", "file"))
    return files.select("page_id", "file", link.alias("link"))


def resolved_links(
    pages: DataFrame, url: Column, extension: str | None = None, attribute: str = "href", html: str = "html",
    css_class: str | None = None,
) -> DataFrame:
    """One row per anchor with the attribute: ``page_id, file, link``, the link as a browser on the page would follow it.

    ``file`` is the attribute's text. A link without a scheme or host starts at the page's own directory, or at its root
    if it begins with a slash, and its ``.`` and ``..`` are followed, never above the root. With an ``extension`` only links whose path
    ends in it are kept, whatever query or fragment comes behind, and with a ``css_class`` only anchors of that class.
    """
    found = _anchors(pages, url.alias("_url"), attribute, html, css_class).select("page_id", "_url", F.col("_found").alias("file"))
    parts = found.select("page_id", "file", *_parsed("_url", "_p"), *_parsed("file", "_l"))
    own, there = [F.col("_l" + c) for c in _PARTS], [F.col("_p" + c) for c in _PARTS]
    root = F.concat(F.when(own[0] != "", own[0]).otherwise(there[0]), F.when(own[1] != "", own[1]).otherwise(there[1]))
    elsewhere = (own[0] != "") | (own[1] != "")
    same_page = ~elsewhere & (own[2] == "")
    directory = F.regexp_replace(F.when(there[2] == "", "/").otherwise(there[2]), "[^/]*$", "")
    path = F.when(elsewhere | own[2].startswith("/"), own[2]).when(same_page, there[2]).otherwise(F.concat(directory, own[2]))
    query = F.when(same_page & (own[3] == ""), there[3]).otherwise(own[3])
    # What follows another scheme than that of pages is no path: mailto:, data: and the like stay as they are.
    opaque = (own[0] != "") & (own[1] == "")
    placed = parts.select("page_id", "file", opaque.alias("_opaque"), root.alias("_root"), path.alias("_path"), query.alias("_query"),
                          own[4].alias("_fragment"))
    placed = placed.withColumn("_path", _without_dots(F.col("_path")))
    if extension is not None:
        placed = placed.where(~F.col("_opaque") & F.col("_path").endswith("." + extension))
    link = F.when(F.col("_opaque"), F.col("file")).otherwise(F.concat("_root", "_path", "_query", "_fragment"))
    return placed.select("page_id", "file", link.alias("link"))


# Scheme, host, path, query and fragment of a link, as RFC 3986 takes them apart (fixed pattern).
_PARTS = ("scheme", "host", "path", "query", "fragment")
_SPLIT = r"^([A-Za-z][A-Za-z0-9+.-]*:)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?(#.*)?$"


def _parsed(column: str, prefix: str) -> list[Column]:
    return [F.regexp_extract(column, "(?s)" + _SPLIT, k).alias(prefix + part) for k, part in enumerate(_PARTS, 1)]


def _without_dots(path: Column) -> Column:
    """The path with its dot segments followed: a fold over its segments, of which ``..`` takes the last one away."""
    segments = F.split(path, "/")
    last = F.element_at(segments, -1)
    kept = F.aggregate(
        F.slice(segments, 2, F.size(segments)), F.array(F.lit("").cast("string")),
        lambda done, s: F.when(s == ".", done).when(s == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1)))).otherwise(
            F.array_append(done, s)))
    followed = F.array_join(F.when(last.isin(".", ".."), F.array_append(kept, F.lit(""))).otherwise(kept), "/")
    return F.when(path.startswith("/") & path.rlike(r"/[.]{1,2}(/|$)"), followed).otherwise(path)


def _anchors(pages: DataFrame, base: Column, attribute: str, html: str, css_class: str | None) -> DataFrame:
    """``page_id``, the base and ``_found``, the attribute of each anchor that has it."""
    tags = pages.select("page_id", base, F.explode(F.regexp_extract_all(F.col(html), F.lit(ANCHOR), 0)).alias("_tag"))
    if css_class is not None:
        classes = F.split(F.coalesce(_attribute(F.col("_tag"), "class"), F.lit("")), r"\s+")
        tags = tags.where(F.array_contains(classes, css_class))
    return tags.withColumn("_found", _attribute(F.col("_tag"), attribute)).drop("_tag").where("_found IS NOT NULL")


def _attribute(tag: Column, name: str) -> Column:
    """The attribute's value; NULL if the tag lacks it. Quoted values before it are passed over whole."""
    before = r"""(?i)^<a(?:\s+[^\s=>"']+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>"']++))?)*?\s+"""
    value = before + name + r"""\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)"""
    found = F.regexp_extract(tag, value, 1)
    return F.when(found != "", F.regexp_replace(found, r"""^["']|["']$""", ""))
