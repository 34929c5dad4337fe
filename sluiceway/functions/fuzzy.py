"""Name-similarity scores as native Column expressions (no Python in the row path)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluiceway.functions.text import strip

# The score tiers and the similarity at which the last tier starts.
EXACT = 1.0
TOKEN = 0.95
TOKEN_PREFIX = 0.85
PREFIX_MIN_LEN = 3
SIMILAR_FROM = 0.7
SIMILAR_BASE = 0.5
SIMILAR_SPAN = 0.3

# Fixed value: what separates the words of a name.
TOKEN_SEPARATORS = r"[_\-\s.]+"


def edit_ratio(a: Column, b: Column) -> Column:
    """1 - edit distance / longer length; 0 when both are empty."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, F.lit(0.0)).otherwise(
        F.lit(1.0) - F.levenshtein(a, b) / longest.cast("double")
    )


def _alike(a: Column, b: Column) -> Column:
    """Whether the lengths of two texts allow a similarity of ``SIMILAR_FROM``."""
    share = F.lit(SIMILAR_FROM - 0.01)
    return (F.length(b) >= F.length(a) * share) & (F.length(a) >= F.length(b) * share)


def clean(text: Column) -> Column:
    return F.lower(strip(F.coalesce(text, F.lit(""))))


def words_of(name: Column) -> Column:
    return F.split(name, TOKEN_SEPARATORS)


def score_clean(kw: Column, name: Column, words: Column, tokens: Column | None = None) -> Column:
    """The token score of texts that are already ``clean``, with the words of the name.

    ``tokens`` are the words and the name, where a caller has them at hand. Most texts are told apart by their lengths and
    by one look for the keyword in the name, before any word is compared.
    """
    tokens = F.array_append(words, name) if tokens is None else tokens
    ratios = F.transform(F.filter(tokens, lambda w: _alike(kw, w)), lambda w: edit_ratio(kw, w))
    graded = F.transform(
        F.filter(ratios, lambda r: r >= SIMILAR_FROM),
        lambda r: F.lit(SIMILAR_BASE)
        + F.lit(SIMILAR_SPAN) * ((r - F.lit(SIMILAR_FROM)) / F.lit(SIMILAR_SPAN)),
    )
    held = F.contains(name, kw)
    return (
        F.when((kw == "") | (name == ""), F.lit(0.0))
        .when(kw == name, F.lit(EXACT))
        .when(held & F.array_contains(words, kw), F.lit(TOKEN))
        .when(
            held & (F.length(kw) >= PREFIX_MIN_LEN) & F.exists(words, lambda w: F.startswith(w, kw)),
            F.lit(TOKEN_PREFIX),
        )
        .otherwise(F.coalesce(F.array_max(graded), F.lit(0.0)))
    )


def fuzzy_token_score(keyword: Column, target: Column) -> Column:
    """Similarity of a keyword to a name between 0 and 1.

    Exact beats whole word beats word prefix beats spelling similarity; NULL counts as
    empty and scores 0. Edit distances are computed only for rows that reach that tier and
    only between texts of similar length.
    """
    name = clean(target)
    return score_clean(clean(keyword), name, words_of(name))


def name_similarity(target: Column, name: Column) -> Column:
    """The better of plain spelling similarity and the token score."""
    spelled = edit_ratio(F.lower(target), F.lower(name))
    return F.greatest(spelled, fuzzy_token_score(target, name))
