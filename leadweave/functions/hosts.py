"""Column expressions over web addresses: host, block lists, name guesses."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import (
    ARTICLE_BEGINNINGS,
    BLOCKED_COUNTRY_ENDINGS,
    BLOCKED_SUFFIXES,
    NAME_ENDINGS,
    SERVICE_TITLE_MAX_CHARS,
    SERVICE_WORDS,
    TITLE_MAX_CHARS,
)
from .text import any_of, bind, col, strip, text_or_blank


def host(url: Column | str) -> Column:
    """Lower-case host without scheme, user, port, path and one leading `www.`; '' for blank."""
    raw = F.regexp_extract(strip(text_or_blank(url)), r"(?i)^(?:https?://)?(?:[^/?#]*@)?([^:/?#]*)", 1)
    return F.regexp_replace(F.lower(raw), r"^www\.", "")


def website_host(url: Column | str) -> Column:
    """Host of a website for contact lookups: the scheme test minds case, and a text without any host stays as it is."""
    text = strip(text_or_blank(url))

    def whole(w: Column) -> Column:
        return F.when(w.startswith("http://") | w.startswith("https://"), w).otherwise(F.concat(F.lit("http://"), w))

    def bare(full: Column) -> Column:
        place = F.regexp_replace(F.regexp_extract(full, r"^https?://([^/?#]*)", 1), r"^.*@", "")
        name = F.lower(F.regexp_replace(F.regexp_extract(place, r"^(\[[^\]]*|[^:]*)", 1), r"^\[", ""))
        return F.lower(F.regexp_replace(F.when(name != "", name).otherwise(full), r"^www\.", ""))

    return bind(bind(text, whole), bare)


def clean_block_list(entries: Iterable[str | None]) -> list[str]:
    """User block list: lower case, trimmed, blanks dropped."""
    return sorted({e.lower().strip() for e in entries if e})


def _ends_on(domain: Column, suffixes: Iterable[str], proper: bool) -> Column:
    """Domain equals one of the suffixes or lies below it (`proper`: only below it).

    The last k labels are compared with the entries of k labels, so the test costs one hash lookup
    per label count whatever the length of the list, and stays in generated code.
    """
    by_labels = defaultdict(list)
    for suffix in sorted(set(suffixes)):
        by_labels[suffix.count(".") + 1].append(suffix)
    test = F.lit(False)
    for labels, entries in sorted(by_labels.items()):
        tail = F.substring_index(domain, ".", -labels)
        found = tail.isin(entries)
        test = test | ((found & (domain != tail)) if proper else found)
    return test


def is_blocked(domain: Column | str, user_blocked: Iterable[str] = ()) -> Column:
    """Blank, on a block list (itself or a parent), or with a foreign country ending."""
    user = clean_block_list(user_blocked)

    def test(d: Column) -> Column:
        listed = _ends_on(d, BLOCKED_COUNTRY_ENDINGS, proper=True) | _ends_on(d, BLOCKED_SUFFIXES, proper=False)
        return listed | _ends_on(d, user, proper=False) if user else listed

    return (text_or_blank(domain) == "") | bind(F.lower(strip(text_or_blank(domain))), test)


def dot_suffixes(domain: Column | str) -> Column:
    """All dot suffixes of a domain, itself included: a.b.c -> [a.b.c, b.c, c]."""
    labels = F.split(col(domain), r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )


def title_case(c: Column) -> Column:
    """Upper-case every letter that does not follow a letter (input is lower case)."""
    pieces = F.split(c, r"(?<=[^\p{L}])(?=\p{L})")
    return F.array_join(F.transform(pieces, F.initcap), "")


def name_from_host(domain: Column | str) -> Column:
    """Rough company name from a host: ending dropped, last label, title case."""
    domain = text_or_blank(domain)
    bare = F.regexp_replace(F.lower(strip(domain)), r"\.(" + any_of(NAME_ENDINGS) + r")$", "")
    return bind(
        F.substring_index(bare, ".", -1),
        lambda label: F.when(label == "", domain).otherwise(title_case(strip(label))),
    )


def _reads_like_article(piece: Column) -> Column:
    low, size = F.lower(piece), F.char_length(piece)
    return (
        (size > TITLE_MAX_CHARS)
        | low.rlike("^(?:" + any_of(ARTICLE_BEGINNINGS) + ")")
        | piece.rlike(r"(?U)^\d+\s")
        | ((size > SERVICE_TITLE_MAX_CHARS) & low.rlike(any_of(SERVICE_WORDS)))
        | piece.contains("...")
    )


def name_from_title(title: Column | str, domain: Column | str) -> Column:
    """Company name from a page title; falls back to the host when the title reads like an article."""
    piece = strip(F.split(text_or_blank(title), r"(?U)\s*[|—]\s*|\s+-\s+|\s*:\s+", 2)[0])
    # A blank title leaves a blank piece and so a blank name.
    name = bind(piece, lambda p: F.when(~_reads_like_article(p), F.regexp_replace(p, r"[.:,;!?]+$", "")))
    return F.coalesce(F.nullif(name, F.lit("")), name_from_host(domain))


def name_from_import_title(title: Column | str) -> Column:
    """Title of an import-index page without its site name."""
    return strip(F.regexp_replace(text_or_blank(title), r"(?iU)\s*-\s*ImportYeti\s*$", ""))


def not_listed(rows: DataFrame, domain: str, row_id: str, listed: DataFrame, entry: str = "entry") -> DataFrame:
    """Rows none of whose dot suffixes is in the list, for lists too long for an expression.

    Distinct domains are tested, so a domain with a third of all rows is looked up once.
    """
    distinct = rows.select(domain).distinct().select(domain, F.explode(dot_suffixes(domain)).alias(entry))
    hit = distinct.join(listed.select(entry).distinct(), entry, "left_semi").select(domain).distinct()
    return rows.join(hit, domain, "left_anti")
