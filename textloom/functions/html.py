"""Visible text of an HTML page, as a chain of built-in expressions."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions.text import MARK, bind, strip

# Markup from left to right, whichever comes first: what holds no visible text, to its end or that
# of the page; declarations; tags, in which quoted values may hold a ">"; tags with a stray quote.
_ATTRIBUTES = r"""[^>"']*+(?:(?:"[^"]*+"|'[^']*+')[^>"']*+)*+>"""
MARKUP = (
    r"(?is)<!--.*?(?:-->|\z)"
    rf"|<(script|style|template)\b(?:{_ATTRIBUTES}|[^>]*+>).*?(?:</\1\s*>|\z)"
    r"|<[!?][^>]*+>"
    rf"|</?[a-z](?:{_ATTRIBUTES}|[^>]*+>)"
)

# Names that are references without a semicolon too; the longest that fits is meant.
BARE_NAMES = sorted((name for name in html5 if not name.endswith(";")), key=lambda name: (-len(name), name))

# Fixed value: names that pages use most. A map is searched from its start, so these are looked up first.
COMMON_NAMES = (
    "amp;", "lt;", "gt;", "quot;", "apos;", "nbsp;", "copy;", "reg;", "ndash;", "mdash;", "hellip;", "laquo;", "raquo;",
    "lsquo;", "rsquo;", "ldquo;", "rdquo;", "bull;", "middot;", "euro;", "auml;", "ouml;", "uuml;", "szlig;", "eacute;", "egrave;",
)


def _code_point(number: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")


def _references(text: Column) -> Column:
    """Replace ``&eacute;``, ``&#233;`` and ``&#xE9;`` by what they stand for, each once.

    A number that is no character, and a name that HTML does not know, stays as it is.
    """
    names = F.from_json(F.lit(json.dumps(html5)), "map<string,string>")
    common = F.from_json(F.lit(json.dumps({name: html5[name] for name in COMMON_NAMES})), "map<string,string>")

    def resolved(part: Column) -> Column:
        number = F.regexp_extract(part, "^#0*([0-9]{1,7});", 1).try_cast("long")
        number = F.coalesce(
            number, F.conv(F.nullif(F.regexp_extract(part, "^#[xX]0*([0-9a-fA-F]{1,6});", 1), F.lit("")), 16, 10).try_cast("long")
        )
        valid = (number > 0) & (number < 0x110000) & ~number.between(0xD800, 0xDFFF)
        name = F.regexp_extract(part, "^[a-zA-Z][a-zA-Z0-9]*;", 0)
        bare = F.regexp_extract(part, f"^(?:{'|'.join(BARE_NAMES)})", 0)
        named = F.coalesce(F.try_element_at(common, name), F.try_element_at(names, name))
        numbered = F.when(valid, F.concat(_code_point(number), F.regexp_replace(part, "^[^;]*;", "")))
        # What is null is not what is meant; each is evaluated once, and only if those before are null.
        return F.when(part.startswith("#"), numbered).otherwise(
            F.coalesce(
                F.concat(named, F.substr(part, F.length(name) + 1)),
                F.concat(F.try_element_at(names, F.nullif(bare, F.lit(""))), F.substr(part, F.length(bare) + 1)),
            )
        )

    def piece(part: Column, i: Column) -> Column:
        return F.when(i == 0, part).otherwise(F.coalesce(resolved(part), F.concat(F.lit("&"), part)))

    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(F.split(text, "&"), piece), "")).otherwise(text)


def page_text(html: Column | str) -> Column:
    """Text between tags, each string stripped, one per line; title text is kept."""
    text = F.col(html) if isinstance(html, str) else html
    shown = F.regexp_replace(F.replace(text, F.lit(MARK), F.lit("")), MARKUP, MARK)
    strings = F.transform(F.split(shown, MARK), lambda part: bind(_references(part), strip))
    return F.array_join(F.filter(strings, lambda part: part != ""), "\n")
