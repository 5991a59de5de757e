"""Tokenising and token lists."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicweave.functions.text import keep_tokens, words
from topicweave.scratch import Scratch

# Tag names of the Sejong tagset and the plural suffix.
COMMON_NOUN, PROPER_NOUN, FOREIGN, PREFIX, SUFFIX = "NNG", "NNP", "SL", "XPN", "XSN"
PLURAL = "들"

# One tagged token is written as START form TAG_MARK code; the codes are one
# letter per tag class.  Both marks are separators to every tokenizer here, so
# no form contains them.
START, TAG_MARK = "\x1f", "\x1e"


def tokenize_whitespace(
    df: DataFrame,
    col: str = "text",
    stopwords: Iterable[str] | DataFrame | None = None,
    min_len: int = 2,
) -> DataFrame:
    """Add ``tokens``: Unicode-whitespace words without short words and stopwords."""
    return filter_tokens(df.withColumn("tokens", words(F.col(col))), "tokens", stopwords, min_len)


def tokenize_none(df: DataFrame, col: str = "text") -> DataFrame:
    """Add ``tokens``: every whitespace-separated word."""
    return df.withColumn("tokens", words(F.col(col)))


def filter_tokens(
    df: DataFrame,
    tokens_col: str = "tokens",
    stopwords: Iterable[str] | DataFrame | None = None,
    min_len: int = 2,
) -> DataFrame:
    """Drop short tokens and stopwords from ready token lists, in place.

    ``stopwords`` as a Python collection become a literal set; as a DataFrame,
    with a ``word`` column, they are joined, however many there are.  A null
    list stays null.
    """
    if isinstance(stopwords, DataFrame):
        return _filter_by_join(df, tokens_col, stopwords, min_len)
    return df.withColumn(tokens_col, keep_tokens(F.col(tokens_col), stopwords or (), min_len))


def _filter_by_join(
    df: DataFrame, tokens_col: str, stopwords: DataFrame, min_len: int
) -> DataFrame:
    """Rows get a key of their own and are written once, since both sides of the last join read them."""
    keyed = Scratch(df.sparkSession, "tokens").table(df.withColumn("_row", F.monotonically_increasing_id()))
    kept = (
        keyed.select("_row", F.posexplode(keep_tokens(F.col(tokens_col), (), min_len)).alias("pos", "word"))
        .join(stopwords.select("word").distinct(), "word", "left_anti")
        .groupBy("_row")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "word"))).alias("_kept"))  # no more than one row's own
    )
    tokens = F.when(F.col(tokens_col).isNotNull(), F.coalesce(F.col("_kept.word"), F.array().cast("array<string>")))
    return keyed.join(kept, "_row", "left").withColumn(tokens_col, tokens).drop("_kept", "_row")


def _encoded(pairs: Column) -> Column:
    """All tagged tokens of a document as one string."""
    def letter(tag: Column) -> Column:
        return (
            F.when(tag.isin(COMMON_NOUN, PROPER_NOUN), "N")
            .when(tag == PREFIX, "P")
            .when(tag == SUFFIX, "S")
            .when(tag == FOREIGN, "L")
            .otherwise("O")
        )

    return F.array_join(
        F.transform(
            pairs, lambda p: F.concat(F.lit(START), p["form"], F.lit(TAG_MARK), letter(p["tag"]))
        ),
        "",
    )


def _piece(code: str) -> str:
    return f"{START}[^{TAG_MARK}]*{TAG_MARK}{code}"


def extract_nouns(
    df: DataFrame,
    pairs_col: str = "pairs",
    stopwords: Iterable[str] | None = None,
    min_len: int = 2,
) -> DataFrame:
    """Add ``tokens``: the nouns of tagged tokens.

    A prefix, a noun and a suffix that follow each other make one word; so do
    prefix and noun, and noun and suffix.  What is left over counts alone.
    Taking the longest such group from left to right is what a regular
    expression with ordered alternatives does, so one pass over the encoded
    document gives the groups.
    """
    p, n, s = _piece("P"), _piece("N"), _piece("S")
    group = f"{p}{n}{s}|{p}{n}|{n}{s}|{_piece('[NPSL]')}"
    plural = f"{START}{PLURAL}{TAG_MARK}S$"
    groups = F.regexp_extract_all(_encoded(F.col(pairs_col)), F.lit(f"({group})"), F.lit(1))
    without_plural = F.array_remove(
        F.transform(groups, lambda g: F.regexp_replace(g, plural, "")), ""
    )
    forms = F.transform(
        without_plural, lambda g: F.regexp_replace(g, f"{START}|{TAG_MARK}[NPSLO]", "")
    )
    nouns = F.transform(
        forms, lambda w: F.replace(F.regexp_replace(w, f"{PLURAL}$", ""), F.lit(" "), F.lit(""))
    )
    tokens = keep_tokens(nouns, stopwords or (), min_len)
    return df.withColumn("tokens", F.coalesce(tokens, F.array().cast("array<string>")))


def combine_nominals(df: DataFrame, pairs_col: str = "pairs") -> DataFrame:
    """Merge each run of adjacent nouns into one; it is proper if any part is."""
    encoded = F.array_join(
        F.transform(
            F.col(pairs_col),
            lambda p: F.concat(F.lit(START), p["form"], F.lit(TAG_MARK), p["tag"]),
        ),
        "",
    )
    noun = f"{START}[^{TAG_MARK}]*{TAG_MARK}NN[GP](?={START}|$)"
    other = f"{START}[^{TAG_MARK}]*{TAG_MARK}[^{START}]*"
    # possessive: matched in a loop, so a run may be of any length
    runs = F.regexp_extract_all(encoded, F.lit(f"((?:{noun})++|{other})"), F.lit(1))

    def merged(run: Column) -> Column:
        proper = F.contains(run, F.lit(f"{TAG_MARK}{PROPER_NOUN}"))
        tag = F.regexp_extract(run, f"{TAG_MARK}([^{TAG_MARK}]*)$", 1)
        return F.struct(
            F.regexp_replace(run, f"{START}|{TAG_MARK}[^{START}]*", "").alias("form"),
            F.when(proper & run.rlike(f"^{noun}"), PROPER_NOUN).otherwise(tag).alias("tag"),
        )

    return df.withColumn(pairs_col, F.transform(runs, merged))


def join_tokens(df: DataFrame, tokens_col: str = "tokens", out: str = "document") -> DataFrame:
    return df.withColumn(out, F.array_join(tokens_col, " "))


def doc_word_sets(tokens: DataFrame) -> DataFrame:
    """Distinct words per document; documents without words are left out."""
    return tokens.where(F.size("tokens") > 0).select(
        "doc_id", F.array_distinct("tokens").alias("words")
    )


def tokenize(
    df: DataFrame,
    tokenizer: str | Callable[[str], list[str]] = "whitespace",
    col: str = "text",
    stopwords: Iterable[str] | DataFrame | None = None,
    min_len: int = 2,
    dicts: DataFrame | None = None,
    domains: Sequence[str] = (),
    nominals: bool = False,
) -> DataFrame:
    """Add ``tokens`` by a named tokenizer or a function from text to tokens.

    ``whitespace``, ``none`` and ``tagged`` (nouns of a ready ``pairs`` column)
    are built in.  A function's tokens are kept as they are.  Before nouns are
    taken, ``tagged`` applies the named ``domains`` of the dictionaries ``dicts``
    in their order and, with ``nominals``, merges runs of nouns; ``pairs`` itself
    stays as it is.
    """
    if callable(tokenizer):
        run = tokenizer

        @F.pandas_udf("array<string>")
        def by_user(texts: pd.Series) -> pd.Series:
            return texts.map(lambda t: list(run(t)) if t else [])

        return df.withColumn("tokens", by_user(F.col(col)))
    if tokenizer == "whitespace":
        return tokenize_whitespace(df, col, stopwords, min_len)
    if tokenizer == "none":
        return tokenize_none(df, col)
    if tokenizer == "tagged":
        from topicweave.operators.dictionary import apply_dictionary  # which imports this module

        if domains and dicts is None:
            raise ValueError("domains without dictionaries")
        read = f"pairs_{uuid.uuid4().hex}"  # no column of the caller's
        tagged = df.withColumn(read, F.col("pairs"))
        for domain in domains:
            tagged = apply_dictionary(tagged, read, dicts, domain, read)
        if nominals:
            tagged = combine_nominals(tagged, read)
        return filter_tokens(extract_nouns(tagged, read, None, 0).drop(read), "tokens", stopwords, min_len)
    raise ValueError(f"unknown tokenizer {tokenizer!r}")
