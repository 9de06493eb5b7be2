"""Text clean-up: lower case, accent removal, keyword categories."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Mapping

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

# The combining marks that count as accents, U+0300 to U+036F.
ACCENT_FIRST, ACCENT_LAST = 0x0300, 0x036F

def _text_cleaner() -> Callable[[str | None], str | None]:
    """Built as a closure, so that tasks get it by value and need not import this package."""
    accents = re.compile(f"[{chr(ACCENT_FIRST)}-{chr(ACCENT_LAST)}]")

    def clean(text: str | None) -> str | None:
        if text is None or text.lower() in ("true", "false"):
            return text
        return accents.sub("", unicodedata.normalize("NFD", text.lower()))

    return clean


# Lower-case one string and strip its accents; "true"/"false" stay as written.
plain_text = _text_cleaner()


def normalize_text(c: Column) -> Column:
    """Lower case without accents, as an expression.

    Spark has no Unicode decomposition, so text beyond ASCII is handed to Python
    in Arrow batches.  ASCII text, which cannot hold an accent, stays in the JVM
    and is sent as NULL, which costs next to nothing.
    """
    ascii_only = F.octet_length(c) == F.char_length(c)
    lowered = F.lower(c)
    clean = plain_text

    @F.pandas_udf(T.StringType())
    def cleaned(texts: pd.Series) -> pd.Series:
        return texts.map(clean, na_action="ignore")

    return (F.when(c.isNull(), c)
            .when(ascii_only, F.when(lowered.isin("true", "false"), c).otherwise(lowered))
            .otherwise(cleaned(F.when(~ascii_only, c))))


def keyword_category(c: Column, mapping: Mapping[str, str | None]) -> Column:
    """Value of the first pattern (in mapping order) found in the text, else NULL.

    Patterns are unanchored, case-sensitive regular expressions in Java syntax.
    A pattern without a value claims nothing, so a later one may match.
    """
    rules = [(p, v) for p, v in mapping.items() if v is not None]
    if not rules:
        return F.lit(None).cast("string")
    chain = None
    for pattern, value in rules:
        hit = F.coalesce(c.rlike(pattern), F.lit(False))
        chain = F.when(hit, F.lit(value)) if chain is None else chain.when(hit, F.lit(value))
    return chain
