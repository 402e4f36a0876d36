"""Text, list and set functions as column expressions; nothing here leaves the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import lexicon as lex


def words(text: Column) -> Column:
    """Words between spaces; an empty text has none."""
    return F.filter(F.split(text, " "), lambda w: w != "")


def word_set(text: Column) -> Column:
    return F.array_distinct(words(text))


def collapse_spaces(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def join_single_letters(tokens: Column) -> Column:
    """Two or more one-letter words in a row become one word."""
    marked = F.array_join(F.transform(tokens, lambda t: F.when(t.rlike(r"^(?U)\p{L}$"), F.concat(F.lit("\x01"), t, F.lit("\x01"))).otherwise(t)), " ")
    return words(F.translate(F.regexp_replace(marked, "\x01 \x01", ""), "\x01", ""))


def tokenize(text: Column) -> Column:
    """Words of letters and digits of folded text, single letters joined."""
    return join_single_letters(words(F.trim(F.regexp_replace(text, r"[^\p{L}\p{N}]+", " "))))


def strip_junk(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.trim(text), r"^[^\p{L}\p{N}_(\[]+", ""), r"[^\p{L}\p{N}_)\].]+$", "")


def detect_website(text: Column) -> Column:
    """Main label of a name that is a web address, else an empty string."""
    return F.regexp_replace(F.element_at(F.split(F.regexp_extract(F.trim(text), lex.WEBSITE, 1), r"\."), -1), "[^a-z0-9]", "")


def split_dba(text: Column) -> Column:
    """Struct of the trading name and the alias before the marker."""
    parts = F.split(F.concat(F.lit(" "), text, F.lit(" ")), lex.DBA, 2)
    named = (F.size(parts) == 2) & (F.trim(F.get(parts, 1)) != "")
    return F.struct(F.when(named, F.trim(F.get(parts, 1))).otherwise(text).alias("name"), F.when(named, F.trim(F.get(parts, 0))).otherwise("").alias("alias"))


def repair_digit_typos(token: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(token, "(?<=[a-z])0(?=[a-z])", "o"), "(?<=[a-z])1(?=[a-z])", "l")


def lookup(table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for item in table.items() for x in item])


def legal_split(tokens: Column, forms: dict[str, str]) -> Column:
    """Struct of the words that aren't legal forms (all, if none) and the sorted set of legal forms; phrases apart."""
    table = lookup(forms)
    core = F.filter(tokens, lambda t: ~F.map_contains_key(table, t))
    return F.struct(F.when(F.size(core) > 0, core).otherwise(tokens).alias("core"), F.array_sort(F.array_distinct(F.transform(F.filter(tokens, lambda t: F.map_contains_key(table, t)), lambda t: F.element_at(table, t)))).alias("suffix"))


def acronym(core: Column) -> Column:
    kept = F.filter(words(core), lambda w: ~w.isin(*lex.ACRONYM_SKIPS))
    return F.when(F.size(kept) >= 2, F.array_join(F.transform(kept, lambda w: F.substring(w, 1, 1)), "")).otherwise("")


def strip_leading_zeros(digits: Column) -> Column:
    return F.regexp_replace(digits, "^0+(?=.)", "")


def digit_tokens(text: Column) -> Column:
    """Whole numbers of a text, ordinals included, without leading zeros, each once."""
    plain = F.transform(F.split(F.lower(text), "[^0-9a-z]+"), lambda t: F.regexp_replace(t, lex.ORDINAL, "$1"))
    return F.array_distinct(F.transform(F.filter(plain, lambda t: t.rlike("^[0-9]+$")), strip_leading_zeros))


def region_code(component: Column, aliases: dict[str, str]) -> Column:
    return F.element_at(lookup(aliases), component)


def embedding_text(name: Column, address: Column) -> Column:
    """`name | address` in lower case, spaces collapsed, junk before each gone."""
    part = lambda c: F.lower(F.regexp_replace(collapse_spaces(F.coalesce(c, F.lit(""))), r"^[#\-><\s]+", ""))
    return F.concat_ws(" | ", part(name), part(address))


def name_address_text(core: Column, address: Column) -> Column:
    return F.trim(F.concat_ws(" ", core, address))


def parse_ids(text: Column) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")


def format_ids(ids: Column) -> Column:
    return F.array_join(F.array_distinct(ids), ",")


def jaccard(a: Column, b: Column, empty: float | None = None) -> Column:
    """Shared over all words of two sets; `empty` (unknown by default) if either has none."""
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(empty).cast("double")).otherwise(F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))


def overlap(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def equal_or_unknown(a: Column, b: Column) -> Column:
    return F.when((a != "") & (b != ""), (a == b).cast("double"))


def suffix_flags(a: Column, b: Column) -> list[Column]:
    """suffix_equal, suffix_both, suffix_conflict, suffix_one_missing of two lists of legal forms in text."""
    families = lookup(lex.LEGAL_FAMILIES)
    x, y = ([F.filter(F.transform(words(c), lambda w: F.element_at(families, w)), lambda f: f.isNotNull()) for c in (a, b)])
    both = (a != "") & (b != "")
    flags = {"equal": a == b, "both": both, "conflict": (F.size(x) > 0) & (F.size(y) > 0) & ~F.arrays_overlap(x, y), "one_missing": (a == "") != (b == "")}
    return [v.cast("double").alias(f"suffix_{k}") for k, v in flags.items()]


def dot(a: Column, b: Column) -> Column:
    """Inner product of two arrays."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
