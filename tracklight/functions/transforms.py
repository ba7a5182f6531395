"""Scalar transforms of play counts, scores and tag text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def confidence(plays, alpha: float = 1.0) -> Column:
    return 1.0 + F.lit(float(alpha)) * F.log1p(plays)


def heard(plays) -> Column:
    return (F.col(plays) > 0).cast("int")


def clip(score, low: float = 1.0, high: float = 5.0) -> Column:
    return F.least(F.greatest(score, F.lit(float(low))), F.lit(float(high)))


def cell_weight(rating, missing: float = 0.01) -> Column:
    return F.when(F.col(rating) > 0, F.lit(1.0)).otherwise(F.lit(float(missing)))


def parse_tags(text) -> Column:
    """Tag text to ``array<string>``: comma-separated or a bracketed list of quoted or bare items; null gives [].

    A quoted item ends at the quote that opened it; a backslash escapes the character after it. Empty items are left out.
    """
    c = F.col(text) if isinstance(text, str) else text
    item = r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|[^\s,'"\[\]][^,\[\]]*"""
    unquoted = lambda t: F.when(
        t.startswith("'") | t.startswith('"'), F.regexp_replace(F.substring(t, F.lit(2), F.length(t) - 2), r"\\(.)", "$1")
    ).otherwise(F.trim(t))
    items = F.regexp_extract_all(F.regexp_replace(F.trim(c), r"^\[|\]$", ""), F.lit(item), F.lit(0))
    quoted = F.filter(F.transform(items, unquoted), lambda t: t != "")
    plain = F.filter(F.transform(F.split(c, ","), lambda t: F.trim(t)), lambda t: t != "")
    bracketed = F.trim(c).startswith("[") & F.trim(c).endswith("]")
    return F.when(c.isNull(), F.array().cast("array<string>")).when(bracketed, quoted).otherwise(plain)
