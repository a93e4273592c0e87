"""Notes of a CRM, from HTML to one line."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Beginnings of lines that a migration left behind, and the length that is shown.
BOILERPLATE = ("[pipeline tracker", "sheet stage", "category:", "priority:", "metadata:", "script output:", "last update:", "status (", "(phase-2")
SHOWN = 260


# The entities that notes mostly hold. The ampersand is decoded last, so that no text is decoded twice.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", "\xa0"), ("&amp;", "&"))
#: An ampersand that begins none of them.
_OTHER = "&(?!(?:" + "|".join(e[1:] for e, _ in ENTITIES) + "))"


@F.pandas_udf(T.StringType())
def _entities(text: pd.Series) -> pd.Series:
    return text.map(html.unescape, na_action="ignore")


def plain(notes: DataFrame, raw: str, name: str) -> DataFrame:
    """notes with name, the text of the HTML in column raw: line breaks kept, tags gone, entities decoded.

    Common entities are replaced in the engine; only rows that hold other ones go through Python.
    """
    bare = F.regexp_replace(F.regexp_replace(F.coalesce(raw, F.lit("")), r"(?i)<br\s*/?>", "\n"), "<[^>]+>", "")
    stripped = notes.withColumn(name, bare)
    known = F.col(name)
    for entity, text in ENTITIES:
        known = F.replace(known, F.lit(entity), F.lit(text))
    rest = F.col(name).rlike(_OTHER)
    return stripped.where(~rest).withColumn(name, known).union(stripped.where(rest).withColumn(name, _entities(name)))


def cleanup(text: Column) -> Column:
    """The remark of a plain note, else its lines without boilerplate, cut to SHOWN characters."""
    lines = F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    lower = lambda x: F.lower(x)
    remarks = F.transform(F.filter(lines, lambda x: F.startswith(lower(x), F.lit("remarks:"))), lambda x: F.trim(F.substring(x, 9, 1 << 20)))
    others = F.filter(lines, lambda x: ~F.array_contains(F.transform(F.array(*map(F.lit, BOILERPLATE)), lambda b: F.startswith(lower(x), b)), True))
    return F.left(F.coalesce(F.nullif(F.get(remarks, F.lit(0)), F.lit("")), F.array_join(others, " \xb7 ")), F.lit(SHOWN))


def without_badge(card: Column, badge: str = "Verified Company") -> Column:
    """A card's name without its badge, white space collapsed."""
    return F.trim(F.regexp_replace(F.replace(card, F.lit(badge), F.lit(" ")), r"\s+", " "))
