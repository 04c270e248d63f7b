"""Text columns. Everything here is a built-in expression with no state, so it
also runs unchanged on a streaming DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values ---------------------------------------------------------------
# ASCII punctuation
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# words a CSV reader takes for a missing value (pandas 0.25 documentation)
MISSING_WORDS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "N/A", "NA", "NULL", "NaN", "n/a", "nan", "null",
]
CLS, SEP, UNK = "[CLS]", "[SEP]", "[UNK]"
QUESTION_CHARS = 150

# Regular expressions, valid in java.util.regex and RE2 alike. Java's \s knows
# ASCII only, so Unicode separators are named beside it.
WHITESPACE = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"
STRIP = rf"^{WHITESPACE}+|{WHITESPACE}+\z"
WORD = r"[\p{L}\p{M}\p{N}]+"
MARK = r"[^\t-\r\x1c-\x20\x{85}\p{Z}\p{Cc}\p{L}\p{M}\p{N}]"
TOKEN = rf"{WORD}|{MARK}"
MARKED_TOKEN = rf"\[CLS\]|\[SEP\]|{TOKEN}"
PUNCT_OR_SPACE_TOKEN = rf"^(\p{{P}}+|{WHITESPACE}+)\z"
# decimal digits, and the superscripts and subscripts that count as digits
DIGIT_TOKEN = r"^[\p{Nd}\x{b2}\x{b3}\x{b9}\x{2070}\x{2074}-\x{2079}\x{2080}-\x{2089}]+\z"


def null_tokens(text: Column) -> Column:
    """Words that stand for a missing value become null."""
    return F.when(~text.isin(MISSING_WORDS), text)


def truncate_text(text: Column, chars: int = QUESTION_CHARS) -> Column:
    """The first ``chars`` code points."""
    return F.substring(text, 1, chars)


def marked_text(first: Column, second: Column) -> Column:
    """Both questions in one text; null if either is null."""
    return F.concat(F.lit(f"{CLS} "), first, F.lit(f" {SEP} "), second, F.lit(f" {SEP} "))


def lower_text(value: Column) -> Column:
    return F.lower(value.cast("string"))


def strip(text: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.regexp_replace(text, STRIP, "")


def replace_punct(text: Column) -> Column:
    """Punctuation to blanks, then four, three and two blanks to one, one pass
    each: some longer runs keep two blanks, which is intended."""
    out = F.translate(text, PUNCTUATION, " " * len(PUNCTUATION))
    for width in (4, 3, 2):
        out = F.replace(out, F.lit(" " * width), F.lit(" "))
    return strip(out)


def tokenize(text: Column) -> Column:
    """Words and single marks. Lower-case first if case must not count."""
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def tokenize_marked(text: Column) -> Column:
    """Lower-cased words and marks of a marked text, ``[CLS]`` and ``[SEP]`` whole."""
    raw = F.regexp_extract_all(text, F.lit(MARKED_TOKEN), F.lit(0))
    return F.transform(raw, lambda t: F.when(t.isin(CLS, SEP), t).otherwise(F.lower(t)))


def drop_punct(tokens: Column) -> Column:
    """Without tokens that are only punctuation or white space. Symbols such as
    ``$`` and ``+`` are not punctuation and stay."""
    return F.filter(tokens, lambda t: ~t.rlike(PUNCT_OR_SPACE_TOKEN))


def drop_stop_words(tokens: Column, stops: list[str]) -> Column:
    if not stops:
        return tokens
    return F.filter(tokens, lambda t: ~t.isin(stops))


def drop_numbers(tokens: Column) -> Column:
    return F.filter(tokens, lambda t: ~t.rlike(DIGIT_TOKEN))


def default_piece(tokens: Column, piece: str = "<unk>") -> Column:
    """An empty token list becomes one unknown piece."""
    return F.when(F.size(tokens) == 0, F.array(F.lit(piece))).otherwise(tokens)


def join_tokens(tokens: Column) -> Column:
    return F.array_join(tokens, " ")
