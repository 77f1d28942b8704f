"""Pieces of DuckDB SQL shared by the compared queries."""

from __future__ import annotations

from presskiln.catalog.tables import DOMAIN, MARKER, RUN_TS

_GENERIC = (
    r"'^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$',"
    " ['scheme', 'host', 'path', 'query']"
)
_ANCHOR = (
    r"""'(?is)<(?:!--.*?-->|script\b.*?</script>|a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|''[^'']*''))'"""
)


def parts(url: str) -> str:
    return f"regexp_extract(trim({url}), {_GENERIC})"


def path(url: str) -> str:
    return f"rtrim(regexp_replace({parts(url)}.path, ';[^/]*$', ''), '/')"


def host(url: str) -> str:
    return f"lower({parts(url)}.host)"


def normalize(url: str) -> str:
    p = parts(url)
    return (
        f"(coalesce(nullif(lower({p}.scheme), ''), 'https') || '://' || lower({p}.host)"
        f" || coalesce(nullif({path(url)}, ''), '/')"
        f" || CASE WHEN {p}.query <> '' THEN '?' || {p}.query ELSE '' END)"
    )


def title(html: str) -> str:
    body = rf"regexp_extract({html}, '(?is)<title[^>]*>(.*?)</title>', 1)"
    return rf"nullif(trim(regexp_replace({body}, '\s+', ' ', 'g')), '')"


def anchors(html: str) -> str:
    return f"regexp_extract_all({html}, {_ANCHOR}, 1)"


def href(quoted: str) -> str:
    return f"replace(substr({quoted}, 2, length({quoted}) - 2), '&amp;', '&')"


def denied(title_text: str, html: str) -> str:
    return (
        f"(coalesce(contains(lower({title_text}), 'access denied'), false)"
        f" OR (contains(lower({html}), 'access denied') AND length(lower({html})) < 2000))"
    )


def raw_path(source: str, digest: str) -> str:
    return f"'raw/' || {source} || '/{RUN_TS[:10]}/' || {digest} || '.html'"


HOSTS = f"""hosts AS (
  SELECT host, row_number() OVER (ORDER BY host) AS source_id
  FROM (SELECT DISTINCT {host('url')} AS host FROM pages))"""

# All links of all pages; the hrefs of the test pages start at the root of their site.
LINKS = f"""hrefs AS (
  SELECT page_id, url AS page_url, unnest({anchors('html')}) AS quoted FROM pages),
all_links AS (
  SELECT DISTINCT page_id, page_url, {normalize(f"{parts('page_url')}.scheme || '://' || {parts('page_url')}.host || {href('quoted')}")} AS url
  FROM hrefs WHERE length(quoted) > 2)"""

def snapshots(order: str) -> str:
    """Facts of all pages, and of the pages of one address the first in this order."""
    return f"""snaps AS (
  SELECT url, CASE WHEN contains(url, '#') THEN replace(html, '<title>', '<title>Access Denied ') ELSE html END AS html
  FROM pages),
described AS (
  SELECT {normalize('url')} AS url, url AS snapshot_url, {title('html')} AS title, sha256(html) AS content_hash,
         {denied(title('html'), 'html')} AS denied
  FROM snaps),
facts AS (
  SELECT * EXCLUDE (place) FROM (
    SELECT *, row_number() OVER (PARTITION BY url ORDER BY {order}) AS place FROM described)
  WHERE place = 1)"""


SNAPSHOTS = snapshots("snapshot_url DESC")
SNAPSHOTS_BY_CONTENT = snapshots("content_hash DESC, snapshot_url DESC")

JOBS = f"""{HOSTS},
jobs AS (
  SELECT j.*, hosts.source_id FROM (
    SELECT {normalize('url')} AS url, page_id AS job_seq, contains(url, '?') AS allow_rescrape, {host('url')} AS host
    FROM pages) j JOIN hosts USING (host)),
stored AS (SELECT {normalize('url')} AS url FROM pages WHERE starts_with(url, 'https:'))"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


__all__ = ["DOMAIN", "MARKER", "RUN_TS"]
