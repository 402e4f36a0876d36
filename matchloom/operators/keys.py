"""Block keys: short strings that records of one entity are likely to share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import strip_leading_zeros, word_set, words
from ..functions.lexicon import STREET_STOP_WORDS
from .joins import by_key

CF_SCHEMES = ("prod_address", "all_digit_word", "digit_pair_set", "postal_word", "street_word_pair", "digit_name_any", "name_region")
MAX_DIGITS, RARE_WORDS, RARE_TOKENS = 4, 2, 3


def name_tokens(core: Column) -> Column:
    return F.filter(word_set(core), lambda t: F.char_length(t) >= 2)


def street_candidates(address: Column) -> Column:
    """Alphabetic address words of 3 letters or more that aren't stop words, each once."""
    return F.filter(word_set(address), lambda w: (F.char_length(w) >= 3) & w.rlike(r"^(?U)\p{L}+$") & ~w.isin(*STREET_STOP_WORDS))


def block_digits(address: Column, digits: Column | None = None, mode: str = "runs") -> Column:
    """Numbers of an address: every run of digits, or the words of the digits field (mode `tokens`)."""
    if mode == "runs":
        return F.array_distinct(F.transform(F.regexp_extract_all(address, F.lit(r"(\d+)"), 1), strip_leading_zeros))
    if mode == "tokens" and digits is not None:
        return words(digits)
    raise ValueError(f"unknown digit mode {mode!r}")


def digit_name_keys(digits: Column, first_token: Column) -> Column:
    return F.when(first_token != "", F.transform(digits, lambda d: F.concat(d, F.lit("|"), first_token))).otherwise(F.array().cast("array<string>"))


def frequencies(df: DataFrame, groups: list[str], tokens: Column, name: str = "word") -> DataFrame:
    """(groups, word, n): how often each word occurs in each group. A column `copies`, if there is one, says how many records a row stands for."""
    copies = F.col("copies") if "copies" in df.columns else F.lit(1)
    return df.select(*groups, copies.alias("_copies"), F.explode(tokens).alias(name)).groupBy(*groups, name).agg(F.sum("_copies").alias("n"))


def rarest(df: DataFrame, counts: DataFrame, groups: list[str], id_col: str, tokens: Column, most: int, out: str = "rare") -> DataFrame:
    """(groups, id, rare): of each record's words the `most` rarest, ties in word order; records without words are left out."""
    long = df.select(*groups, id_col, F.explode(tokens).alias("word"))
    place = Window.partitionBy(*groups, id_col).orderBy("n", "word")
    kept = by_key(long, counts, [*groups, "word"]).withColumn("place", F.row_number().over(place)).where(F.col("place") <= most)
    return kept.groupBy(*groups, id_col).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "word"))), lambda x: x["word"]).alias(out))


def pairs(items: Column, joiner: str) -> Column:
    """Every two of a list's items, the smaller first."""
    place = F.sequence(F.lit(0), F.size(items) - 1)
    every = F.flatten(F.transform(place, lambda i: F.transform(F.filter(place, lambda j: j > i), lambda j: F.concat(F.least(F.get(items, i), F.get(items, j)), F.lit(joiner), F.greatest(F.get(items, i), F.get(items, j))))))
    return F.when(F.size(items) > 1, F.array_distinct(every)).otherwise(F.array().cast("array<string>"))


def crossed(left: Column, right: Column, joiner: str) -> Column:
    return F.array_distinct(F.flatten(F.transform(left, lambda a: F.transform(right, lambda b: F.concat(a, F.lit(joiner), b)))))


def address_keys(digits: Column, rare_words: Column, mode: str = "all") -> Column:
    """The first two numbers, and numbers (the first four, or the first) with the two rarest street words."""
    first = F.when(F.size(digits) >= 2, F.array(F.concat(F.get(digits, 0), F.lit("#"), F.get(digits, 1)))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(first, crossed(F.slice(digits, 1, MAX_DIGITS if mode == "all" else 1), F.slice(rare_words, 1, RARE_WORDS), "@")))


def street_keys(rare_words: Column) -> Column:
    return pairs(F.slice(rare_words, 1, 3), "+")


def with_street_words(df: DataFrame, counts: DataFrame, groups: list[str], id_col: str, address: Column, most: int = 3) -> DataFrame:
    """Adds `rare_words`, a record's rarest street words; empty where it has none."""
    own = rarest(df, counts, groups, id_col, street_candidates(address), most, "rare_words")
    return by_key(df, own, [*groups, id_col], "left").withColumn("rare_words", F.coalesce("rare_words", F.array().cast("array<string>")))


def scheme_keys(scheme: str, digits: Column, long_numbers: Column, regions: Column, rare_words: Column, rare_tokens: Column) -> Column:
    """Keys of one of CF_SCHEMES, from lists."""
    first, street, names = F.slice(digits, 1, MAX_DIGITS), F.slice(rare_words, 1, RARE_WORDS), F.slice(rare_tokens, 1, RARE_WORDS)
    if scheme == "prod_address":
        return address_keys(digits, rare_words)
    found = {
        "all_digit_word": crossed(first, street, "@"),
        "digit_pair_set": pairs(first, "#"),
        "postal_word": crossed(long_numbers, street, "@"),
        "street_word_pair": pairs(F.slice(rare_words, 1, 3), "+"),
        "digit_name_any": crossed(first, names, "|"),
        "name_region": crossed(names, F.concat(long_numbers, regions), "^"),
    }
    if scheme not in found:
        raise ValueError(f"unknown key scheme {scheme!r}")
    return found[scheme]
