"""User dictionaries: domains of terms, and their effect on tagged tokens."""

from __future__ import annotations

import uuid
from bisect import bisect_left
from collections.abc import Iterable
from functools import reduce

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topicweave.operators.tokens import COMMON_NOUN, PROPER_NOUN
from topicweave.scratch import Scratch

DICTIONARY_SCHEMA = "domain string, kind string, pos long, term string"
PAIRS = "array<struct<form:string,tag:string>>"
SPANS = "array<struct<at:int,n:int,put:array<string>,whole:boolean,since:int>>"
# tokens whose place among the terms a task remembers
MAX_PLACES = 100_000
MET = "array<struct<at:int,n:int,put:array<string>,whole:boolean>>"


def register_dictionary(
    dicts: DataFrame,
    domain: str,
    np: DataFrame | Iterable[str] = (),
    cp: DataFrame | Iterable[str] = (),
    cp_caret: DataFrame | Iterable[str] = (),
) -> DataFrame:
    """Replace ``domain`` in ``dicts`` by the given proper nouns, compounds and split terms.

    Terms come as lists or as DataFrames ``(pos, term)``; repeated terms keep
    their first place.
    """
    spark = dicts.sparkSession
    parts = []
    for kind, terms in (("np", np), ("cp", cp), ("cp_caret", cp_caret)):
        if not isinstance(terms, DataFrame):
            terms = spark.createDataFrame(list(enumerate(terms)), "pos long, term string")
        parts.append(terms.select(F.lit(kind).alias("kind"), "pos", "term"))
    fresh = parts[0].unionByName(parts[1]).unionByName(parts[2])
    fresh = (
        fresh.groupBy("kind", "term")
        .agg(F.min("pos").alias("pos"))
        .select(F.lit(domain).alias("domain"), "kind", "pos", "term")
    )
    return dicts.where(F.col("domain") != domain).unionByName(fresh)


def list_dictionary_domains(dicts: DataFrame) -> DataFrame:
    return dicts.select("domain").distinct()


def _meet(forms: list, terms: list[str], carets: dict[str, list[str]], places: dict[str, int]) -> list[dict]:
    """The longest term that begins at each token and ends with one, and caret terms that are a token.

    ``terms`` is sorted: what a joined form begins is a stretch of it, which narrows with every token.
    ``places`` remembers where the stretch of a token begins, -1 for none: most tokens come often and begin no term.
    """
    met = []
    for at, form in enumerate(forms):
        if form is None:
            continue
        low = places.get(form)
        if low is None:
            low = bisect_left(terms, form)
            if low == len(terms) or not terms[low].startswith(form):
                low = -1
            if len(places) >= MAX_PLACES:
                places.clear()
            places[form] = low
        joined, best = form, 0
        for end in range(at + 1, len(forms)) if low >= 0 else ():
            if low == len(terms) or not terms[low].startswith(joined) or forms[end] is None:
                break
            joined += forms[end]
            low = bisect_left(terms, joined, low)
            if low < len(terms) and terms[low] == joined:
                best, term = end - at + 1, joined
        if best:
            met.append({"at": at, "n": best, "put": [term], "whole": True})
        if form in carets:
            met.append({"at": at, "n": 1, "put": carets[form], "whole": False})
    return met


def _meeting(told: Broadcast):
    """``_meet`` with the shared terms; what it remembers lasts as long as a task."""
    places: dict[str, int] = {}
    return lambda row: _meet(row, *told.value, places)


def _leftmost(met: list[dict]) -> list[dict]:
    """Spans that do not overlap, from left to right, the longest first; ``since``: the end of the one before."""
    taken, since = [], 0
    for span in sorted(met, key=lambda s: (s["at"], -s["n"])):
        if span["at"] >= since:
            taken.append({**span, "since": since})
            since = span["at"] + span["n"]
    return taken


def _column(function, returned: str, col):
    """A column of an Arrow function of rows; Spark may not copy it into a lambda, where it could not run."""
    fields = [("at", pa.int32()), ("n", pa.int32()), ("put", pa.list_(pa.string())), ("whole", pa.bool_())]
    arrow = pa.list_(pa.struct(fields + [("since", pa.int32())] * (returned == SPANS)))

    def run(rows: pa.Array) -> pa.Array:
        return pa.array((function(row or []) for row in rows.to_pylist()), arrow)

    return F.arrow_udf(run, returned).asNondeterministic()(col)


def _share(spark: SparkSession, terms: DataFrame) -> Broadcast:
    """The given terms, whose size the caller has checked, on every worker."""
    rows = terms.select("whole", "term", "parts").collect()
    return spark.sparkContext.broadcast(
        (sorted(r.term for r in rows if r.whole), {r.term: r.parts for r in rows if not r.whole})
    )


def apply_dictionary(
    df: DataFrame, pairs_col: str, dicts: DataFrame, domain: str, out: str = "after", max_chars: int = 8_000_000
) -> DataFrame:
    """Add ``out``: the tagged tokens as they read with the dictionary of ``domain``.

    Neighbouring tokens whose joined form is a term become that term, the
    longest first from left to right; a token that is a caret term without its
    carets is split at them.  ``df`` needs ``doc_id``, one row each.

    Documents stay where they are: terms go to all workers, as a sorted array
    that serves as a trie.  Their characters are counted first.  A domain of more
    than ``max_chars`` is dealt into slices that are applied one after the other,
    each by a pass over the documents, so no worker or driver holds more than one.
    """
    terms = dicts.where(F.col("domain") == domain)
    whole = terms.where(F.col("kind") != "cp_caret").select(
        F.lit(True).alias("whole"), "term", F.lit(None).cast("array<string>").alias("parts")
    )
    carets = (
        terms.where(F.col("kind") == "cp_caret")
        .groupBy(F.replace("term", F.lit("^"), F.lit("")).alias("term"))
        .agg(F.min(F.split("term", r"\^")).alias("parts"))
        .select(F.lit(False).alias("whole"), "term", "parts")
    )
    # an empty term would be met nowhere
    entries = whole.distinct().unionByName(carets).where(F.char_length("term") > 0)
    chars = entries.agg(F.coalesce(F.sum(F.char_length("term")), F.lit(0))).first()[0]
    spark = df.sparkSession
    name = f"met_{uuid.uuid4().hex}"  # of no column of the table
    # a column of its own: as an expression the whole list would be cast again for every span
    df = df.withColumn(f"{name}_pairs", F.col(pairs_col).cast(PAIRS))
    pairs = F.col(f"{name}_pairs")
    forms = F.transform(pairs, lambda p: p["form"])
    if chars <= max_chars:
        told = _share(spark, entries)
        meet = _meeting(told)
        spanned = df.withColumn(name, _column(lambda row: _leftmost(meet(row)), SPANS, forms))
    else:
        scratch = Scratch(spark, "dictionary")
        n = 1 + 2 * chars // max_chars
        entries = scratch.table(entries.withColumn("slice", F.pmod(F.xxhash64("term"), F.lit(n))), "terms")
        slices = []
        for k in range(n):
            told = _share(spark, entries.where(F.col("slice") == k))
            spans = _column(_meeting(told), MET, forms)
            slices.append(scratch.table(df.select("doc_id", spans.alias("met")).where(F.size("met") > 0), "met"))
            told.destroy()
        scratch.drop(entries)
        met = reduce(DataFrame.unionByName, slices).groupBy("doc_id").agg(F.flatten(F.collect_list("met")).alias(name))
        spanned = df.join(met, "doc_id", "left").withColumn(name, _column(_leftmost, SPANS, F.col(name)))

    def put(span: Column) -> Column:
        tag = F.when(span["whole"], F.lit(PROPER_NOUN)).otherwise(F.lit(COMMON_NOUN))
        new = F.transform(span["put"], lambda form: F.struct(form.alias("form"), tag.alias("tag")))
        return F.concat(F.slice(pairs, span["since"] + 1, span["at"] - span["since"]), new.cast(PAIRS))

    last = F.try_element_at(name, F.lit(-1))
    tail = F.slice(pairs, F.coalesce(last["at"] + last["n"], F.lit(0)) + 1, F.greatest(F.size(pairs), F.lit(0)))
    return spanned.withColumn(out, F.concat(F.flatten(F.transform(name, put)), tail)).drop(name, f"{name}_pairs")
