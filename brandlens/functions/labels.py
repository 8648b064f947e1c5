"""Rules for the semicolon-separated multi-label field."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from brandlens.contract import KNOWN_PRICE_LABELS, UNKNOWN_PRICE_LABEL
from brandlens.functions.text import is_blank, strip


def label_list(c: Column) -> Column:
    """Distinct labels in first-seen order; comma, colon and semicolon all separate."""
    # translate(): the first three characters are replaced, the zero-width space is dropped.
    text = F.translate(F.lower(strip(c)), "\u00a0,:\u200b", " ;;")
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), ";"), strip)
    return F.array_distinct(F.filter(parts, lambda p: p != ""))


def normal_labels(c: Column) -> Column:
    labels = label_list(c)
    return F.when(F.size(labels) == 0, F.lit(UNKNOWN_PRICE_LABEL)).otherwise(F.array_join(labels, ";"))


def known_labels(c: Column, known: list[str] = KNOWN_PRICE_LABELS) -> Column:
    return F.filter(label_list(c), lambda x: x.isin(known))


def unexpected_labels(c: Column, known: list[str] = KNOWN_PRICE_LABELS) -> Column:
    return F.filter(label_list(c), lambda x: ~x.isin([*known, UNKNOWN_PRICE_LABEL]))


def split_labels(c: Column) -> Column:
    """Struct of known and unexpected labels; the unknown marker is in neither."""
    return F.struct(known_labels(c).alias("known"), unexpected_labels(c).alias("unexpected"))


def indicators(labels: Column, order: list[str] = KNOWN_PRICE_LABELS) -> Column:
    """0/1 array in fixed label order."""
    return F.array(*[F.array_contains(labels, label).cast("int") for label in order])


def indicators_text(flags: Column, order: list[str] = KNOWN_PRICE_LABELS) -> Column:
    """Active labels in label order joined by '; ', or the unknown marker."""
    active = F.filter(
        F.array(*[F.when(flags[i] == 1, F.lit(label)) for i, label in enumerate(order)]),
        lambda x: x.isNotNull(),
    )
    return F.when(F.size(active) == 0, F.lit(UNKNOWN_PRICE_LABEL)).otherwise(F.array_join(active, "; "))


def item_count(c: Column) -> Column:
    """Non-blank items of a semicolon list, repeats counted; null counts zero."""
    items = F.filter(F.split(c, ";"), lambda p: ~is_blank(p))
    return F.when(c.isNull(), F.lit(0)).otherwise(F.size(items))
