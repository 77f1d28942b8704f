"""What is read out of the HTML text of a page."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from presskiln.functions.binding import let
from presskiln.functions.dates import parse_date

# Patterns of the title, of the dated tags in order of preference, of the
# first JSON-LD script, and the wording and size limit of a refusal page.
TITLE = r"(?is)<title[^>]*>(.*?)</title>"
DATED_TAGS = (
    r"""(?i)<meta[^>]+property=["']article:published_time["'][^>]+content=["']([^"']+)["']""",
    r"""(?i)<meta[^>]+name=["']pubdate["'][^>]+content=["']([^"']+)["']""",
    r"""(?i)<meta[^>]+name=["']publish-date["'][^>]+content=["']([^"']+)["']""",
    r"""(?i)<time[^>]+datetime=["']([^"']+)["']""",
)
JSON_LD = r"""(?is)<script[^>]+type=["']application/ld\+json["'][^>]*>(.*?)</script>"""
JSON_LD_KEYS = ("datePublished", "dateCreated")
REFUSAL = "(?i)access denied"
REFUSAL_MAX_CHARS = 2000
WRAPPED_ARTICLE = "/articles/"

# Comments and scripts are matched so that anchors written inside them are stepped over.
_ANCHOR = (
    r"""(?is)<(?:!--.*?-->|script\b.*?</script>|a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'))"""
)
# Everything a date is read from: the tags up to the end of their value, and the scripts.
_DATED = (
    r"""(?s)<(?i:(?:meta|time)[^>]+(?:content|datetime)=["'][^"']+["']"""
    r"""|script[^>]+type=["']application/ld\+json["'][^>]*>.*?</script>)"""
)
# JSON texts that count as no value.
_EMPTY_JSON = ("null", '""', "false", "[]", "{}")


def extract_title(html: Column) -> Column:
    """Text of the first title, blanks collapsed; NULL where there is none or it is empty."""
    body = F.regexp_extract(html, TITLE, 1)
    return F.nullif(F.trim(F.regexp_replace(body, r"(?U)[\s\x1c-\x1f]+", " ")), F.lit(""))


def json_ld_date_text(html: Column) -> Column:
    """Date text of the first JSON-LD object that carries one.

    Only the first script counts. The first value that is not empty decides; if it is no
    text there is none.
    """
    return let(F.trim(F.regexp_extract(html, JSON_LD, 1), F.lit(" \t\r\n")), _date_text_of)


def _date_text_of(script: Column) -> Column:
    document = F.try_parse_json(script)
    items = F.when(
        script.startswith("["), F.try_variant_get(document, "$", "array<variant>")
    ).when(script.startswith("{"), F.array(document))
    values = F.flatten(
        F.transform(
            items,
            lambda item: F.array(
                *[F.to_json(F.try_variant_get(item, f"$.{key}", "variant")) for key in JSON_LD_KEYS]
            ),
        )
    )
    present = F.filter(
        values,
        lambda v: v.isNotNull()
        & ~v.isin(*_EMPTY_JSON)
        & F.coalesce(v.try_cast("double") != 0, F.lit(True)),
    )
    return let(
        F.get(present, F.lit(0)),
        lambda first: F.when(
            first.startswith('"'), F.try_variant_get(F.try_parse_json(first), "$", "string")
        ),
    )


def published_at(html: Column) -> Column:
    """Publication date: the first readable of the dated tags and the JSON-LD text.

    One pass cuts the page down to the few tags that can hold a date; the patterns then run
    on those, one after another: what comes behind a readable date is not looked at.
    """
    dated = F.array_join(F.regexp_extract_all(html, F.lit(_DATED), F.lit(0)), ">")

    def first_date(tags: Column) -> Column:
        # A condition only works out the branch it takes, and the parser is part of the plan twice,
        # not once per tag.
        def text(k: Column) -> Column:
            return F.coalesce(*[F.when(k == n, F.regexp_extract(tags, tag, 1)) for n, tag in enumerate(DATED_TAGS)])

        def date_of(written: Column) -> Column:
            return F.when(written != "", parse_date(written))

        of_tags = F.aggregate(
            F.sequence(F.lit(0), F.lit(len(DATED_TAGS) - 1)),
            F.lit(None).cast("timestamp"),
            lambda found, k: F.when(found.isNotNull(), found).otherwise(let(text(k), date_of)),
        )
        return F.when(tags != "", F.coalesce(of_tags, let(json_ld_date_text(tags), date_of)))

    return let(dated, first_date)


def is_access_denied(title: Column, html: Column) -> Column:
    """A refusal page: named so in its title, or short and saying so."""
    in_title = F.coalesce(title.rlike(REFUSAL), F.lit(False))
    return in_title | F.coalesce(
        (F.length(html) < REFUSAL_MAX_CHARS) & html.rlike(REFUSAL), F.lit(False)
    )


def anchors(html: Column) -> Column:
    """Array of the quoted hrefs of a page, still in their quotes; '' where none applies."""
    return F.regexp_extract_all(html, F.lit(_ANCHOR), F.lit(1))


def unquote_href(quoted: Column) -> Column:
    """Text between the quotes with its ampersands decoded."""
    inner = F.substr(quoted, F.lit(2), F.greatest(F.length(quoted) - 2, F.lit(0)))
    return F.replace(inner, F.lit("&amp;"), F.lit("&"))
