"""Column expressions over free text: whitespace, phrases, states, signals, amounts."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed_values import PAIN_WORDS, SIGNALS, US_STATES


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once, however often `use` mentions it.

    Catalyst copies an expression to every place that mentions it (also when it pushes filters below
    projections); long regular-expression chains would run several times per row and outgrow the
    generated method.
    """
    return F.element_at(F.transform(F.array(value), use), 1)


def strip(c: Column | str) -> Column:
    """Trim every kind of white space (SQL `trim` only removes blanks)."""
    return F.regexp_replace(col(c), r"(?U)^\s+|\s+$", "")


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(col(c), F.lit(""))


def text_or_blank(c: Column | str) -> Column:
    return F.coalesce(col(c), F.lit(""))


def any_of(words: list[str]) -> str:
    """Regular expression matching any of the given literal phrases."""
    return "|".join(re.escape(w).replace(r"\ ", " ").replace(r"\-", "-") for w in words)


def contains_any(c: Column, words: list[str]) -> Column:
    test = F.lit(False)
    for word in words:
        test = test | c.contains(word)
    return test


def list_items(c: Column | str) -> Column:
    """Items of a comma list, trimmed, blanks dropped."""
    items = F.transform(F.split(col(c), ","), strip)
    return F.filter(items, lambda x: x != "")


def list_text(items: Column) -> Column:
    """Canonical comma list: distinct, sorted, joined by ', '."""
    return F.array_join(F.sort_array(F.array_distinct(items)), ", ")


def _signals(text: Column) -> Column:
    tests = {
        "sqep_mentioned": text.contains("sqep"),
        "otif_mentioned": text.contains("otif"),
        "walmart_supplier": text.contains("walmart") & contains_any(text, ["supplier", "vendor"]),
        "compliance_pain": contains_any(text, PAIN_WORDS),
    }
    return F.array_compact(F.array(*[F.when(tests[s], F.lit(s)) for s in SIGNALS]))


def detect_signals(title: Column | str, snippet: Column | str) -> Column:
    """Array of compliance signals mentioned in title and snippet, in fixed order."""
    return bind(F.lower(F.concat(text_or_blank(title), F.lit(" "), text_or_blank(snippet))), _signals)


_CODES = [code for _, code in US_STATES]
# A text naming "west virginia" also names "virginia", which comes first in the table: leave it out.
_NAMED = [(name, code) for name, code in US_STATES if name != "west virginia"]
_NAME_PATTERN = r"(?U)\b(" + any_of([n for n, _ in _NAMED]) + r")\b"


def _least_named_state(low: Column) -> Column:
    # The plain search for the last words of the names spares most texts the regular expression.
    named = contains_any(low, sorted({name.split()[-1] for name, _ in _NAMED}))
    return F.when(named, F.array_min(F.regexp_extract_all(low, F.lit(_NAME_PATTERN), F.lit(1))))


def extract_state(text: Column | str) -> Column:
    """State code found in free text, '' if none.

    The first ", XX" counts if XX is a state code; otherwise the first state of the (alphabetical)
    table whose name occurs as a whole word. One pass collects all names, the least one wins.
    """
    text = text_or_blank(text)
    code = F.nullif(F.regexp_extract(text, r"(?U),\s*([A-Z]{2})\b", 1), F.lit(""))
    table = F.create_map(*[F.lit(x) for pair in _NAMED for x in pair])
    by_name = bind(F.lower(text), lambda low: F.element_at(table, _least_named_state(low)))
    return F.coalesce(bind(code, lambda c: F.when(c.isin(_CODES), c)), by_name, F.lit(""))


def parse_amount(text: Column | str) -> Column:
    """Lower bound of a printed money range, `$10M-$50M` -> 10000000; null without `$`, number and unit."""
    pattern = r"(?i)\$([0-9]+(?:\.[0-9]+)?)\s*([KMB])"
    number = F.regexp_extract(col(text), pattern, 1)
    unit = F.upper(F.regexp_extract(col(text), pattern, 2))
    factor = F.when(unit == "K", 1e3).when(unit == "M", 1e6).when(unit == "B", 1e9)
    return (F.nullif(number, F.lit("")).cast("double") * factor).cast("bigint")


def revenue(amount: Column | str, printed: Column | str) -> Column:
    """Numeric revenue (truncated) first, else the printed range."""
    return F.coalesce(col(amount).cast("bigint"), parse_amount(printed))


def full_name(first: Column | str, last: Column | str) -> Column:
    return strip(F.concat_ws(" ", text_or_blank(first), text_or_blank(last)))


def _like_pattern(term: str) -> str:
    """Regular expression found in the texts that are LIKE `%term%`, A-Z and a-z alike (without its Unicode flag `(?i)` folds only these)."""
    pieces = ["".join("." if c == "_" else re.escape(c) for c in piece) for piece in term.split("%") if piece]
    # A piece has a fixed length, so its first place after the piece before decides: nothing is tried again.
    return "(?is)" + (pieces[0] if len(pieces) == 1 else "".join(["^", *[f"(?>.*?{piece})" for piece in pieces]]))


def matches_terms(query: str, columns: list[str]) -> Column:
    """Every white-space separated term occurs in at least one of the columns; only A-Z and a-z are the same.

    `%` and `_` in a term keep their LIKE meaning.
    """
    test = F.lit(True)
    for term in query.split():
        found = F.lit(False)
        for name in columns:
            found = found | F.coalesce(F.col(name).rlike(_like_pattern(term)), F.lit(False))
        test = test & found
    return test


def keyword_text(keywords: Column) -> Column:
    """A list of keywords as one text, blank for none."""
    return F.coalesce(F.array_join(keywords, ", "), F.lit(""))
