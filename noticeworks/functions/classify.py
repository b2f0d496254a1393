"""Predicates and labels over text, driven by lists that are given, never built in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import clean_text


def words_literal(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words]) if words else F.array().cast("array<string>")


def keyword_hits(text: Column, words: Column) -> Column:
    """The words found in the text, whatever the case, in the order and spelling of the list."""
    folded = F.lower(clean_text(text))
    return F.filter(words, lambda w: F.contains(folded, F.lower(w)))


def field_keyword_hits(fields: list[Column], words: Column) -> Column:
    """``keyword_hits`` over the given fields only, blank ones skipped."""
    cleaned = F.array(*[clean_text(f) for f in fields])
    return keyword_hits(F.array_join(F.filter(cleaned, lambda x: x != ""), " "), words)


def any_word(text: Column, words: Column) -> Column:
    folded = F.coalesce(text, F.lit(""))
    return F.exists(words, lambda w: F.contains(folded, w))


def region_status(text: Column, include: list[str], exclude: list[str]) -> Column:
    """excluded before included, else review."""
    t = clean_text(text)
    return F.when(any_word(t, words_literal(exclude)), "excluded").when(any_word(t, words_literal(include)), "included").otherwise("review")


def ordered_tags(text: Column, rules: list[tuple[str, str]], other: str, none: str) -> Column:
    """All tags whose expression is found, in order of the rules; ``other`` for a text without a tag, ``none`` for no text."""
    t = F.coalesce(text, F.lit(""))
    found = F.array_compact(F.array(*[F.when(t.rlike(pattern), F.lit(tag)) for tag, pattern in rules]))
    return F.when(F.trim(t) == "", F.array(F.lit(none))).when(F.size(found) == 0, F.array(F.lit(other))).otherwise(found)


def category_hits(fields: list[Column], categories: dict[str, list[str]]) -> Column:
    """Map from each category with hits to its hits."""
    pairs = [x for name, words in categories.items() for x in (F.lit(name), field_keyword_hits(fields, words_literal(words)))]
    return F.map_filter(F.create_map(*pairs), lambda _, hits: F.size(hits) > 0)


def industry_classes(fields: list[Column], industries: dict[str, list[str]], status: Column, before: Column, matched: Column, default: str) -> Column:
    """The map from industry to hits by which a row is kept, null for a row that is not.

    Without a hit a confirmed row keeps the map it had (``before``) if that says anything, else its matched words under ``default``.
    """
    hits = category_hits(fields, industries)
    empty = F.array().cast("array<string>")
    inherited = F.when(F.coalesce(F.size(before), F.lit(0)) > 0, before).otherwise(F.create_map(F.lit(default), F.coalesce(matched, empty)))
    return F.when(F.size(hits) > 0, hits).when(status == "confirmed", inherited)


def all_hits(classes: Column) -> Column:
    """The hits of all industries in their order, each once."""
    return F.array_distinct(F.flatten(F.map_values(classes)))


def qualification_hits(title: Column, text: Column, excluded: list[str], words: list[str]) -> Column:
    """Keyword hits in the qualification text alone; none where the title holds an excluded word."""
    none = F.array().cast("array<string>")
    return F.when(any_word(clean_text(title), words_literal(excluded)), none).otherwise(keyword_hits(text, words_literal(words)))


def favoured_fund(tags: Column, source: Column, tag: str, pattern: str, words: list[str]) -> Column:
    """Is the plan paid from a fund that is looked for: by its tag, by an expression, or by a word in the source's text?"""
    text = F.coalesce(source, F.lit(""))
    return F.coalesce(F.array_contains(tags, tag), F.lit(False)) | text.rlike(pattern) | any_word(text, words_literal(words))


def fund_filter(tags: Column, source: Column, wanted: str, words: list[str], patterns: dict[str, str]) -> Column:
    """A reader's choice of fund: a word must be in the source's text, a named expression be found there, else the tag be given."""
    text = F.coalesce(source, F.lit(""))
    if not wanted:
        return F.lit(True)
    if wanted in words:
        return F.contains(text, F.lit(wanted))
    if wanted in patterns:
        return text.rlike(patterns[wanted])
    return F.coalesce(F.array_contains(tags, wanted), F.lit(False))


def needs_enrichment(content: Column, content_basis: Column, date_basis: Column, parties_known: Column, current: str, most: int = 400, pointer: str = "详见") -> Column:
    """Must the detail be read again: content of another basis, none, too long or only a pointer, a date not official, a party unknown?"""
    c = F.coalesce(content, F.lit(""))
    poor = F.coalesce(content_basis != current, F.lit(True)) | (c == "") | (F.length(c) > most) | F.startswith(c, F.lit(pointer))
    return poor | F.coalesce(date_basis != "official", F.lit(True)) | ~F.coalesce(parties_known, F.lit(False))
