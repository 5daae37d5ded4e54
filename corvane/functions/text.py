"""Line splitting, the text normaliser, tokens and n-grams as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Results depend on these exact patterns (Java regex syntax).
URL = r"\b(https?|ftp|file)://[-a-zA-Z0-9+&@#/%?=~_|!:,.;]*[-a-zA-Z0-9+&@#/%=~_|]\b"
COLONS = ":;"
TRAILING_PUNCT = r"\p{Punct}(\s+|$)"
ALONE_PUNCT = r"(^|\s+)\p{Punct}+(\s+|$)"
# "+-=" is a range, so one leading digit goes as well; "#" and "@" stay.
LEADING_PUNCT = r"(^|\s+)[<>,./?!$%^&*()_+-=]"
NON_ASCII = r"[^\x00-\x80]+"
# A match takes its separators with it: in a run every second number stays.
DIGIT_TOKENS = r"(^|\s+)\d+(\s+|$)"
SPACES = r"\s+"

LINE_END = r"\r\n|[\r\n]"
# Everything up to and including the blank counts as trimmable.
TRIMMED = "".join(map(chr, range(0x21)))


def text_lines(text: Column) -> Column:
    """Lines of a text; a final line end opens no further line, '' has none."""
    body = F.regexp_replace(text, rf"({LINE_END})\z", "")
    return F.when(text == "", F.array().cast("array<string>")).otherwise(
        F.split(body, LINE_END, -1)
    )


def lower(text: Column) -> Column:
    return F.lower(text)


def drop_urls(text: Column) -> Column:
    # The pattern needs "://", and most lines have none: skip the regex there.
    return F.when(F.contains(text, F.lit("://")), F.regexp_replace(text, URL, "")).otherwise(text)


def split_colons(text: Column) -> Column:
    return F.translate(text, COLONS, "  ")


def strip_trailing_punct(text: Column) -> Column:
    return F.regexp_replace(text, TRAILING_PUNCT, " ")


def drop_alone_punct(text: Column) -> Column:
    return F.regexp_replace(text, ALONE_PUNCT, " ")


def strip_leading_punct(text: Column) -> Column:
    return F.regexp_replace(text, LEADING_PUNCT, " ")


def drop_non_ascii(text: Column) -> Column:
    return F.regexp_replace(text, NON_ASCII, "")


def drop_digit_tokens(text: Column) -> Column:
    return F.regexp_replace(text, DIGIT_TOKENS, " ")


def squeeze(text: Column) -> Column:
    return F.btrim(F.regexp_replace(text, SPACES, " "), F.lit(TRIMMED))


def normalize(text: Column, colons: bool = True) -> Column:
    """The full normaliser; ``colons=False`` keeps ':' and ';' inside tokens."""
    out = drop_urls(lower(text))
    if colons:
        out = split_colons(out)
    out = strip_trailing_punct(out)
    out = drop_alone_punct(out)
    out = strip_leading_punct(out)
    out = drop_non_ascii(out)
    out = drop_digit_tokens(out)
    return squeeze(out)


def tokenize(text: Column, colons: bool = True) -> Column:
    """Normalised tokens; a line without any gives one empty token."""
    # Only single blanks are left between tokens.
    return F.split(normalize(text, colons), " ", -1)


def is_tag(token: Column) -> Column:
    return F.startswith(token, F.lit("#"))


def tags_of(tokens: Column) -> Column:
    return F.filter(tokens, is_tag)


def words_of(tokens: Column) -> Column:
    return F.filter(tokens, lambda t: ~is_tag(t))


def ngrams(tokens: Column, n: int) -> Column:
    """Windows of ``n`` tokens joined by a blank; none for shorter lines."""
    if n < 1:
        raise ValueError("n must be at least 1")
    last = F.size(tokens) - n + 1
    # sequence() counts down when its end is below its start, hence the guard.
    starts = F.sequence(F.lit(1), F.greatest(last, F.lit(1)))
    grams = F.transform(starts, lambda i: F.concat_ws(" ", F.slice(tokens, i, F.lit(n))))
    return F.when(last >= 1, grams).otherwise(F.array().cast("array<string>"))
