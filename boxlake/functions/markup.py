"""Tests on page markup that need only start tags, kept on the JVM.

Comments and raw-text elements are cut first, and attribute values may contain ">", so a tag
quoted in a script or a comment is never taken for a real one.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_NOT_MARKUP = r"(?is)<!--.*?-->|<(script|style|textarea|title)\b.*?</\1\s*>"
# The rest of a start tag, one attribute at a time, with quoted values taken whole.
_ATTRIBUTES = r"""(?:\s+[^\s=>"'/]+(?:\s*=\s*(?:"[^"]*+"|'[^']*+'|[^\s>"']++))?|\s*/(?!>))*?"""


def page_text(content: Column) -> Column:
    """Decode page bytes, with a mark in place of malformed ones, as the page reader does; text passes unchanged."""
    return F.make_valid_utf8(content.cast("string"))


def markup(text: Column) -> Column:
    return F.regexp_replace(text, _NOT_MARKUP, "")


def has_element(text: Column, tag: str, attribute: str, value: str) -> Column:
    """Whether the page has a ``tag`` element whose ``attribute`` is exactly ``value``."""
    exact = re.escape(value)
    quoted = rf"""(?:"{exact}"|'{exact}'|{exact}(?=[\s>]))"""
    return markup(text).rlike(rf"(?is)<{tag}{_ATTRIBUTES}\s+{attribute}\s*=\s*{quoted}")


def hrefs(text: Column) -> Column:
    """Targets of all links on the page, in page order."""
    pattern = rf"""(?is)<a{_ATTRIBUTES}\s+href\s*=\s*(?:"([^"]*+)"|'([^']*+)'|([^\s>"']++))"""
    body = markup(text)
    groups = [F.regexp_extract_all(body, F.lit(pattern), F.lit(n)) for n in (1, 2, 3)]
    return F.transform(
        F.arrays_zip(*[g.alias(f"g{n}") for n, g in enumerate(groups)]),
        lambda found: F.replace(F.concat(found["g0"], found["g1"], found["g2"]), F.lit("&amp;"), F.lit("&")),
    )
