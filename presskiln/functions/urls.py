"""URL columns: splitting, normalising, resolving and testing."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from presskiln.functions.binding import let

# Schemes whose last path segment may carry ";parameters".
PARAMETER_SCHEMES = (
    "", "ftp", "hdl", "prospero", "http", "https", "shttp", "rtsp", "rtsps", "rtspu",
    "sip", "sips", "mms", "sftp", "tel",
)
# Schemes with a "//host" part.
HOST_SCHEMES = (
    "", "ftp", "http", "gopher", "nntp", "telnet", "imap", "wais", "file", "mms", "https",
    "shttp", "snews", "prospero", "rtsp", "rtsps", "rtspu", "rsync", "svn", "svn+ssh",
    "sftp", "nfs", "git", "git+ssh", "ws", "wss", "itms-services",
)
# Schemes under which a relative reference has a meaning.
RELATIVE_SCHEMES = (
    "", "ftp", "http", "gopher", "nntp", "imap", "wais", "file", "https", "shttp", "mms",
    "prospero", "rtsp", "rtsps", "rtspu", "sftp", "svn", "svn+ssh", "ws", "wss",
)
# Search address, its origin, and the domain and path marker of an article.
SEARCH_ORIGIN = "https://news.google.com"
SEARCH_QUERY = "/search?q={term}&hl=en-GB&gl=GB&ceid=GB:en"
ARTICLE_DOMAIN = "news.sky.com"
ARTICLE_MARKER = "/story/"
# Fixed value: hrefs that never lead to a page.
DEAD_HREF = r"^(#|javascript:|mailto:)"
# Fixed value: a numbered listing page.
LISTING_PAGE = r"/topic/[^/]+/\d+"

# Blanks at both ends, and tab, CR and LF anywhere, are not part of a URL. A cleaned URL thus
# holds no tab, and a tab can mark places in it while it is taken apart.
_NOISE = r"(?U)^[\s\x00-\x20]+|[\s\x1c-\x1f]+\z|[\t\r\n]"
_SCHEME = r"[A-Za-z][A-Za-z0-9+.-]*"


def _any_of(schemes: tuple[str, ...]) -> str:
    return "|".join(s.replace("+", r"\+") for s in schemes if s)


# RFC 3986, appendix B: scheme, host, path, query.
_GENERIC = rf"(?s)^(?:({_SCHEME}):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?\z"
# The same with the closing slashes and, under some schemes, parameters of the path split off.
_REST = r"(?:\?([^#]*))?(?:#.*)?\z"
_PIECES = (
    rf"(?s)^(?:(?:((?i:{_any_of(PARAMETER_SCHEMES)})):|(?!{_SCHEME}:))"
    rf"(?://([^/?#]*+))?+([^?#]*?)/*+(?:;[^/?#]*)?(?=[?#]|\z){_REST}"
    rf"|({_SCHEME}):(?://([^/?#]*+))?+([^?#]*?)/*+(?=[?#]|\z){_REST})"
)
_IP_LITERAL = r"\[(?:[0-9a-f:.%]+|v[0-9a-f]+\.[^\]\t]+)\]"


def clean_url(url: Column) -> Column:
    return F.regexp_replace(url, _NOISE, "")


def url_parts(url: Column) -> Column:
    """``[scheme, host, path, query]`` of a URL, as it is written; one pass of one pattern."""
    return F.split(F.regexp_replace(clean_url(url), _GENERIC, "$1\t$2\t$3\t$4"), "\t")


def normalize_url(url: Column) -> Column:
    """Lower-case host, default scheme https, no trailing slash, parameters or fragment.

    NULL where a host with brackets is no IP literal. A chain of replacements in which each
    step reads only the one before: parts shared by branches would be worked out again in
    every branch.
    """
    pieces = F.split(F.regexp_replace(clean_url(url), _PIECES, "$1$5://$2$6\t$3$7?$4$8"), "\t")
    step = F.concat(F.lower(F.get(pieces, F.lit(0))), F.lit("\t"), F.get(pieces, F.lit(1)))
    hosted = _any_of(HOST_SCHEMES)
    for pattern, text in (
        ("^:", "https:"),
        (r"^([^?]*)\?\z", "$1"),
        (r"\t(?=\?|\z)", "\t/"),
        (rf"(?s)^[^\t/]*//(?=[^\t]*[\[\]])(?![^\t\[]*{_IP_LITERAL}).*", ""),
        (rf"^([^\t/]*:)//\t(?!/)|^(?!(?:{hosted}):)([^\t/]*:)//\t(?!//)", "$1$2"),
        (r"\t", ""),
    ):
        step = F.regexp_replace(step, pattern, text)
    return F.get(F.regexp_extract_all(step, F.lit("(?s)^.+"), F.lit(0)), F.lit(0))


def _fold_dots(path: Column) -> Column:
    """Path without its ``.`` and ``..`` segments."""
    segments = F.split(path, "/", -1)
    folded = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda done, segment: F.when(segment == ".", done)
        .when(segment == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
        .otherwise(F.concat(done, F.array(segment))),
    )
    closing = F.when(F.element_at(segments, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(
        F.array().cast("array<string>")
    )
    return F.array_join(F.concat(folded, closing), "/")


def _join(base: Column, href: Column) -> Column:
    """Text of ``href`` seen from a page with the parts ``base``; not normalised yet."""
    scheme, host = F.lower(F.get(base, F.lit(0))), F.get(base, F.lit(1))
    path, query = F.get(base, F.lit(2)), F.get(base, F.lit(3))
    own_scheme = F.lower(F.regexp_extract(href, f"^({_SCHEME}):", 1))
    origin = F.concat(
        F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(""),
        F.when(host != "", F.concat(F.lit("//"), host)).otherwise(""),
    )
    folder = F.when(path == "", F.lit("/")).otherwise(F.regexp_replace(path, r"[^/]*\z", ""))

    def from_here(rest: Column) -> Column:
        own_query = F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)
        own_path = F.regexp_replace(
            F.regexp_extract(rest, r"^[^?#]*", 0), r";[^/]*\z", ""
        )
        asked = F.when(own_query != "", F.concat(F.lit("?"), own_query)).otherwise("")
        target = F.when(own_path.startswith("/"), own_path).otherwise(
            F.regexp_replace(F.concat(folder, own_path), "/+", "/")
        )
        moved = let(
            target, lambda t: F.when(t.rlike(r"(^|/)\.\.?(/|\z)"), _fold_dots(t)).otherwise(t)
        )
        # Too many ".." take the leading slash along; a host needs it back.
        moved = let(
            moved, lambda m: F.when((host != "") & ~m.startswith("/"), F.concat(F.lit("/"), m)).otherwise(m)
        )
        return (
            F.when(rest.startswith("//"), F.concat(F.regexp_extract(origin, r"^[^/]*", 0), rest))
            .when(
                rest.rlike(r"^;?(?:[?#]|\z)"),
                F.concat(
                    origin, path, F.when(own_query != "", asked).otherwise(F.concat(F.lit("?"), query))
                ),
            )
            .otherwise(F.concat(origin, moved, asked))
        )

    relative = (own_scheme.isin("", scheme)) & scheme.isin(*RELATIVE_SCHEMES)
    nowhere = F.array_join(base, "") == ""
    return F.when(nowhere | ~relative, href).otherwise(
        let(F.regexp_replace(href, rf"^(?:{_SCHEME}:)?(?://(?=[/?#]|\z))?", ""), from_here)
    )


def resolve_against(base_parts: Column, href: Column) -> Column:
    """``resolve_href`` for a base that is split already, once for all links of a page."""
    dead = (href == "") | href.rlike(DEAD_HREF)
    live = F.when(~dead, clean_url(href))
    return normalize_url(let(live, lambda cleaned: F.when(cleaned.isNotNull(), _join(base_parts, cleaned))))


def resolve_href(base: Column, href: Column) -> Column:
    """Absolute, normalised target of a link found on page ``base``; NULL for dead links."""
    return resolve_against(url_parts(base), href)


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(clean_url(url), f"^(?:{_SCHEME}:)?//([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    """Path of a URL without its closing slashes, as used to compare listing addresses."""
    return F.regexp_replace(
        F.regexp_replace(clean_url(url), _PIECES, "\t$3$7"), r"\t", ""
    )


def is_same_domain(url: Column, domain: Column | str) -> Column:
    """Suffix test on the host; there is no dot boundary and a port counts as host text."""
    suffix = F.lit(domain.lower()) if isinstance(domain, str) else F.lower(domain)
    return url_host(url).endswith(suffix)


def is_article_url(
    url: Column, domain: str = ARTICLE_DOMAIN, marker: str = ARTICLE_MARKER
) -> Column:
    """Host ends with ``domain`` and the path contains ``marker``; one anchored test."""
    return url.rlike(
        rf"^(?:{_SCHEME}:)?//[^/?#]*(?i:{re.escape(domain)})(?=[/?#]|\z)[^?#]*{re.escape(marker)}"
    )


def build_search_url(term: Column) -> Column:
    """Search address of a term. ``url_encode`` differs from form encoding in ``~`` and ``*``."""
    encoded = F.replace(F.replace(F.url_encode(term), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))
    before, after = SEARCH_QUERY.split("{term}")
    return F.concat(F.lit(SEARCH_ORIGIN + before), encoded, F.lit(after))


def unwrap_href(href: Column, origin: str = SEARCH_ORIGIN) -> Column:
    """Address behind an anchor of a search page; ``./x`` belongs to the search origin."""
    return normalize_url(
        F.when(href.startswith("./"), F.concat(F.lit(origin), F.substr(href, F.lit(2)))).otherwise(href)
    )
