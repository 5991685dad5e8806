"""URL columns. Plain regular expressions, as ``parse_url`` rejects URLs that browsers accept."""

from pyspark.sql import Column, functions as F

from sparkloom.functions.columns import bind

_SCHEME = r"^([a-zA-Z][a-zA-Z0-9+.\-]*):"
_NETLOC = r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//([^/?#]*)"
_PATH = r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)"
_ROOT = r"^((?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?(?://[^/?#]*)?)"
_TAIL_PARAMS = r";[^/]*$"


def url_scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, _SCHEME, 1))


def url_netloc(url: Column) -> Column:
    """Host with its port, exactly as written; '' when absent."""
    return F.regexp_extract(url, _NETLOC, 1)


def url_path(url: Column) -> Column:
    """Path without query, fragment and the parameters of its last segment."""
    return F.regexp_replace(F.regexp_extract(url, _PATH, 1), _TAIL_PARAMS, "")


def url_slug(url: Column) -> Column:
    """File name under which a page is stored."""
    name = F.replace(F.btrim(url_path(url), F.lit("/")), F.lit("/"), F.lit("_"))
    name = F.when(name == "", F.lit("index")).otherwise(name)
    return F.when(name.endswith(".html"), name).otherwise(F.concat(name, F.lit(".html")))


def is_detail_page(url: Column, section: str = "animals") -> Column:
    """True when the path has a segment below ``section``."""
    return url_path(url).rlike(rf"^/*\Q{section}\E/[^/]")


def is_valid_link(url: Column, excluded: tuple[str, ...] = ("/lists/",)) -> Column:
    """True when the lower-cased path has none of the excluded parts."""
    path = F.lower(url_path(url))
    valid = F.lit(True)
    for part in excluded:
        valid = valid & ~path.contains(part)
    return valid


def in_section(url: Column, section: str = "animals") -> Column:
    return url.contains(f"/{section}/")


def same_site(a: Column, b: Column) -> Column:
    return url_netloc(a) == url_netloc(b)


def _without_dots(segments: Column) -> Column:
    """Resolve ``.`` and ``..`` in path segments."""
    walked = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda done, s: F.when(s == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
        .when(s == ".", done)
        .otherwise(F.concat(done, F.array(s))),
    )
    ends_in_dots = F.element_at(segments, -1).isin(".", "..")
    path = F.array_join(F.when(ends_in_dots, F.concat(walked, F.array(F.lit("")))).otherwise(walked), "/")
    return F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path))


def _join_relative(base: Column, href: Column) -> Column:
    """Resolve a reference that has no host of its own."""
    local = F.regexp_replace(href, _SCHEME, "")
    path = F.regexp_extract(local, r"^([^?#]*)", 1)
    query = F.regexp_extract(local, r"^[^?#]*(\?[^#]+)", 1)
    fragment = F.regexp_extract(local, r"(#.+)$", 1)
    base_path = F.regexp_extract(base, _PATH, 1)
    base_query = F.regexp_extract(base, r"^[^?#]*(\?[^#]+)", 1)
    folder = F.regexp_extract(url_path(base), r"^(.*/)[^/]*$", 1)
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    rooted = F.split(path, "/")
    below = F.split(F.concat(folder, path), "/")
    last = F.size(below)
    below = F.filter(below, lambda s, i: (s != "") | (i == 0) | (i == last - 1))
    resolved = F.when(path == "", base_path).when(path.startswith("/"), _without_dots(rooted)).otherwise(_without_dots(below))
    new_query = F.when((path == "") & (query == ""), base_query).otherwise(query)
    return F.concat(F.regexp_extract(base, _ROOT, 1), resolved, new_query, fragment)


def resolve_url(base: Column, href: Column) -> Column:
    """Join a link with the URL of its page.

    Links from the root without dot segments, by far the most, need no segment walk.
    """

    def joined(h: Column) -> Column:
        scheme = url_scheme(h)
        bare = F.regexp_replace(h, r"\??#?$", "")
        plain = h.rlike(r"^/(?!/)") & ~h.contains("/.") & ~h.rlike(r"\?#|[?#]$")
        return (
            F.when(h == "", base)
            .when(plain, F.concat(F.regexp_extract(base, _ROOT, 1), h))
            .when((scheme != "") & (scheme != url_scheme(base)), h)
            .when(h.rlike(_NETLOC), F.concat(url_scheme(base), F.lit(":"), F.regexp_replace(bare, _SCHEME, "")))
            .otherwise(_join_relative(base, h))
        )

    return bind(F.regexp_replace(F.ltrim(href), r"[\t\r\n]", ""), joined)
