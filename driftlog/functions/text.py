"""Text matching and highlighting over whole texts, JVM-side.

A token is a maximal run of Unicode letters and digits, compared in lower
case. Matching is one regular-expression scan per text (no token arrays),
so it costs the same on a 20,000-word document as a split would, without
allocating the array.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

_WORD = r"[\p{L}\p{N}]"
# Python-side equivalent for splitting a query string (a parameter, not data).
_SPLIT = re.compile(r"[^\w]+|_+", re.UNICODE)


def query_tokens(query: str) -> list[str]:
    """Distinct lower-case tokens of a query string, in first-seen order."""
    out: list[str] = []
    for t in _SPLIT.split(query.lower()):
        if t and t not in out:
            out.append(t)
    return out


def _alternation(tokens: list[str]) -> str:
    return "|".join(re.escape(t) for t in tokens)


def token_pattern(tokens: list[str]) -> str:
    """Regex matching any of ``tokens`` as a whole token."""
    return rf"(?<!{_WORD})(?:{_alternation(tokens)})(?!{_WORD})"


def matches_any(text: Column, tokens: list[str]) -> Column:
    """True when the lower-cased text holds any of ``tokens`` as a token."""
    if not tokens:
        return F.lit(False)
    return F.coalesce(F.lower(text).rlike(token_pattern(tokens)), F.lit(False))


def tokens(text: Column) -> Column:
    """Token array of a text (for callers that need the tokens themselves)."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: F.length(t) > 0)


def highlight(text: Column, tokens_: list[str], pre: str = "<em>", post: str = "</em>") -> Column:
    """Wrap every whole-token, case-insensitive occurrence in ``pre``/``post``."""
    if not tokens_:
        return text
    pattern = rf"(?iu)(?<!{_WORD})({_alternation(tokens_)})(?!{_WORD})"
    return F.regexp_replace(text, pattern, f"{pre}$1{post}")
