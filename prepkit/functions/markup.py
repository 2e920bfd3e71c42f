"""Tokens, figures and lists taken out of text and stored web pages."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from prepkit.functions.cells import column


def tokens(line: str | Column) -> Column:
    """Split at every single space or line end; empty tokens are kept."""
    # a single-character pattern spares the regular-expression engine
    return F.split(F.replace(column(line), F.lit("\n"), F.lit(" ")), " ")


def percent(text: str | Column) -> Column:
    """The share written as ``(13.1%)``: from the first bracket to the first ``%)``."""
    figure = F.regexp_extract(column(text), r"(?s)^[^(]*\((.*?)%\)", 1)
    return figure.try_cast("double") / F.lit(100.0)


def plain(fragment: str | Column) -> Column:
    """A fragment with its tags removed, its character references decoded and its ends trimmed."""
    return F.trim(decoded(F.regexp_replace(column(fragment), "<[^>]*>", "")))


# Named character references of running text; the ampersand comes last, as its result may look like another.
REFERENCES = (("nbsp", "\u00a0"), ("ndash", "\u2013"), ("mdash", "\u2014"), ("lsquo", "\u2018"), ("rsquo", "\u2019"), ("ldquo", "\u201c"),
              ("rdquo", "\u201d"), ("hellip", "\u2026"), ("middot", "\u00b7"), ("deg", "\u00b0"), ("quot", '"'), ("apos", "'"), ("lt", "<"), ("gt", ">"))


def decoded(text: str | Column) -> Column:
    """Text with its character references, by number or common name, turned into characters."""
    cell = column(text)
    parts = F.split(cell, "(?=&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};)")

    def numbered(part: Column) -> Column:
        dec, hexa = F.regexp_extract(part, "^&#([0-9]{1,7});", 1), F.regexp_extract(part, "^&#[xX]([0-9A-Fa-f]{1,6});", 1)
        code = F.when(dec != "", dec.cast("int")).when(hexa != "", F.conv(hexa, 16, 10).cast("int"))
        low = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return F.when(code.between(1, 0x10FFFF), F.concat(low, F.regexp_replace(part, "^&#[0-9xXA-Fa-f]+;", ""))).otherwise(part)

    out = F.when(F.contains(cell, F.lit("&#")), F.array_join(F.transform(parts, numbered), "")).otherwise(cell)
    for name, char in REFERENCES:
        out = F.replace(out, F.lit(f"&{name};"), F.lit(char))
    return F.replace(out, F.lit("&amp;"), F.lit("&"))


def matched_label(text: str | Column, labels: Sequence[str]) -> Column:
    """The first of the labels the text holds, NULL when none."""
    held = F.filter(F.array(*[F.lit(v) for v in labels]), lambda v: F.contains(column(text), v))
    return F.get(held, F.lit(0))


def lists(html: str | Column, css_class: str | None = None) -> Column:
    """Bodies of the page's ``<ul>`` blocks in order, of one class when given."""
    if css_class is None:
        return F.regexp_extract_all(column(html), F.lit(r"(?s)<ul[^>]*>(.*?)</ul>"), F.lit(1))
    name = rf"(?s)<ul[^>]*\bclass=[\"'](?:[^\"']*\s)?{re.escape(css_class)}(?:\s[^\"']*)?[\"'][^>]*>(.*?)</ul>"
    return F.regexp_extract_all(column(html), F.lit(name), F.lit(1))


def items(block: str | Column) -> Column:
    """Texts of the ``<li>`` entries of a block, tags removed."""
    found = F.regexp_extract_all(column(block), F.lit(r"(?s)<li[^>]*>(.*?)</li>"), F.lit(1))
    return F.transform(found, plain)


def list_items(html: str | Column, nth: int, css_class: str | None = None) -> Column:
    """Item texts of the page's nth list (from 0); NULL where there is none."""
    return items(F.get(lists(html, css_class), F.lit(nth)))


def captioned_series(html: str | Column, phrase: str, nth: int) -> Column:
    """The nth series of the chart whose caption holds ``phrase``, as shares.

    A chart is a ``chart-data-wrapper`` block holding a ``chart-caption`` and the
    figures as a JSON array in ``chart-data``; the first matching chart counts. An entry
    is a list of points, of which the first is its figure.
    """
    wrapper = r"(?s)<div[^>]*class=[\"'][^\"']*chart-data-wrapper[^\"']*[\"'][^>]*>(.*?)</div>"
    caption = r"(?s)<pre[^>]*class=[\"'][^\"']*chart-caption[^\"']*[\"'][^>]*>(.*?)</pre>"
    data = r"(?s)<pre[^>]*class=[\"']chart-data[\"'][^>]*>(.*?)</pre>"
    charts = F.regexp_extract_all(column(html), F.lit(wrapper), F.lit(1))
    matching = F.filter(charts, lambda c: F.contains(F.regexp_extract(c, caption, 1), F.lit(phrase)))
    body = F.regexp_extract(F.get(matching, F.lit(0)), data, 1)
    series = F.get(F.from_json(body, "array<string>"), F.lit(nth))
    entries = F.from_json(series, "array<array<double>>")
    return F.transform(entries, lambda points: F.get(points, F.lit(0)) / F.lit(100.0))


def json_number(text: str | Column, path: str) -> Column:
    """A number inside a JSON text."""
    return F.get_json_object(column(text), path).try_cast("double")
