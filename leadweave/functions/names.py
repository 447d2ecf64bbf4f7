"""Company-name keys and the exact name similarity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed_values import DESCRIPTOR_WORDS, LEGAL_WORDS, NAME_MATCH_PERCENT
from .text import any_of, bind, strip, text_or_blank

# Bits of a word of the bit-parallel comparison: two words and a carry add up within 63 bits.
WORD = 62
FULL = (1 << WORD) - 1


def _drop_trailing(c: Column, words: list[str]) -> Column:
    # Atomic groups keep the match linear on long runs of commas.
    return F.regexp_replace(c, r"(?:[\s,]++(?:" + any_of(words) + r")\.?+)*+[\s,]*+$", "")


def company_key(name: Column | str) -> Column:
    """Lower case, single blanks, without trailing legal words and then descriptive words."""
    n = F.regexp_replace(strip(F.lower(text_or_blank(name))), r"(?U)\s+", " ")
    return strip(_drop_trailing(_drop_trailing(n, LEGAL_WORDS), DESCRIPTOR_WORDS))


def sorted_tokens(name: Column | str) -> Column:
    """Letters and digits of a name in lower case, its words sorted and joined by one blank."""
    words = F.trim(F.regexp_replace(F.lower(text_or_blank(name)), r"[^\p{L}\p{N}]+", " "))
    return F.array_join(F.sort_array(F.split(words, " ")), " ")


def _mask(backwards: Column, letter: Column, text: Column, digits: Column) -> Column:
    """Bit i is set where letter i of a block of `text` is the given one: the block, given backwards, read as a binary number."""
    binary = F.call_function("translate", backwards, F.concat(letter, text), digits)
    return F.conv(binary, 2, 10).cast("bigint")


def lcs_length(a: str, b: str) -> Column:
    """Length of the longest common subsequence of two text columns, in built-in expressions.

    A row of the comparison table is a bit vector over the letters of `a`: a zero bit is a step up. Each letter of `b`
    updates all bits with one addition; texts of more than `WORD` letters take several words and hand carries on.
    """
    none, full = F.lit(0).cast("bigint"), F.lit(FULL).cast("bigint")
    text, number = F.col(a), F.char_length(F.col(a))
    digits = F.concat(F.lit("1"), F.repeat(F.lit("0"), number))
    block = lambda w: F.reverse(F.substr(text, w * WORD + 1, F.lit(WORD)))

    step = lambda v, m: (v + v.bitwiseAND(m)).bitwiseAND(full).bitwiseOR(v.bitwiseAND(F.bitwise_not(m)))
    whole = F.struct(F.reverse(text).alias("r"), digits.alias("d"))
    short = F.lit(WORD) - F.bit_count(bind(whole, lambda p: F.aggregate(F.transform(F.split(b, ""), lambda c: _mask(p["r"], c, text, p["d"])), full, step)))

    # From here on arrays of words, the lowest first.
    words = F.sequence(F.lit(0), F.floor((number - 1) / WORD).cast("int"))
    start = F.struct(none.alias("carry"), F.array().cast("array<bigint>").alias("out"))

    def add(s: Column, p: Column) -> Column:
        total = p["v"] + p["v"].bitwiseAND(p["m"]) + s["carry"]
        word = total.bitwiseAND(full).bitwiseOR(p["v"].bitwiseAND(F.bitwise_not(p["m"])))
        return F.struct(F.shiftright(total, WORD).alias("carry"), F.concat(s["out"], F.array(word)).alias("out"))

    def last(p: Column) -> Column:
        masks = F.transform(F.split(b, ""), lambda c: F.transform(p["r"], lambda block: _mask(block, c, text, p["d"])))
        row = lambda v, m: F.aggregate(F.zip_with(v, m, lambda x, y: F.struct(x.alias("v"), y.alias("m"))), start, add, lambda s: s["out"])
        return F.aggregate(masks, F.transform(p["r"], lambda block: full), row)

    blocks = F.struct(F.transform(words, block).alias("r"), digits.alias("d"))
    long = F.aggregate(bind(blocks, last), F.lit(0), lambda acc, v: acc + F.lit(WORD) - F.bit_count(v))
    return F.when((number == 0) | (F.length(b) == 0), 0).when(number <= WORD, short).otherwise(long).cast("int")


def ratio(lcs: Column, total_chars: Column) -> Column:
    """Similarity 100*2*lcs/total as a whole number, rounded half to even; two empty texts are alike."""
    return F.when(total_chars == 0, 100).otherwise(F.rint(lcs * 200.0 / total_chars)).cast("int")


def is_match(lcs: Column, total_chars: Column) -> Column:
    """The ratio reaches the match percentage. In whole numbers: half below it would round down to the even one."""
    return lcs * 400 > total_chars * (2 * NAME_MATCH_PERCENT - 1)


def alike(a: str, b: str) -> Column:
    """Whether two non-blank keys match. With d edits that may replace letters, no more than 2 d letters are left over, so
    pairs that match by that bound are taken as they are, and only the others are compared in full."""
    total = F.char_length(F.col(a)) + F.char_length(F.col(b))
    sure = (total - 2 * F.levenshtein(F.col(a), F.col(b))) * 200 > total * (2 * NAME_MATCH_PERCENT - 1)
    return F.when(sure, True).otherwise(is_match(lcs_length(a, b), total))
