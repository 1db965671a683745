"""Expressions over text columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: one tag written between angle brackets, brackets included.
TAG_PATTERN = "(<[^<>]*>)"


def tag_array(text: str | Column) -> Column:
    """All ``<tag>`` parts of a text, in order."""
    return F.regexp_extract_all(text, F.lit(TAG_PATTERN), 0)


def joined_texts(notes: str | Column, field: str = "text", separator: str = ",") -> Column:
    """The texts of an array of structs in one string; empty notes are left out."""
    notes = F.col(notes) if isinstance(notes, str) else notes
    texts = F.transform(notes, lambda note: note[field])
    return F.array_join(F.filter(texts, lambda text: text.isNotNull()), separator)
