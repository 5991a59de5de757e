"""Personal data: typed patterns as seeds, and contexts learnt from them.

E-mail and IP addresses, payment cards and phone numbers are found by fixed
patterns.  They are the seeds.  Words around a seed form lexical patterns: the
two words before it, and the words on either side.  Tokens with digits or an at
sign that no fixed pattern takes are candidates and occur in such patterns too.

Patterns and values are the two sides of a graph.  In each round a pattern's
confidence for a kind is the share of its distinct values known to be of that
kind, weighed by their own scores; patterns with enough known values and
confidence are kept, and a candidate's score is the chance that not all of its
kept patterns are wrong.  Candidates with a high score count as known in the next
round, weighed by the share of all their patterns that is kept.  After the last
round an occurrence of such a value is a span where its own context is kept, and
elsewhere only if half of the value's occurrences stand in kept contexts.

Everything is DataFrame expressions.  Edges of the graph are distinct before they
are joined, and scores are sums with partial aggregation, so common words are no
hot keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicweave.llm.exact import located, narrow
from topicweave.llm.shared import whole
from topicweave.scratch import Scratch

KINDS = ("email", "ip", "card", "phone")

# The patterns match what the given ones match, from the left and without overlap.
# Possessive runs and the look behind keep long runs of their characters linear.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: What a text must hold for a pattern to be tried.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9][ -]?[0-9][ -]?[0-9]", "phone": r"\+[0-9]"}
PART = r"^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])\.0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])\.0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])\.0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"
#: A number that ends where its token does, but for signs.
NUMBER = r"[(]?[0-9][0-9().-]*+(?=[,;:!?\"']*+(?:\s|\z))"
#: Numbers one space apart, or a token with an at sign or at least four digits.
CANDIDATE = rf"(?<!\S)(?:{NUMBER}(?: {NUMBER})++|(?:(?:[^\s0-9]*+[0-9]){{4}}|[^\s@]*+@)\S*+)"
LEAST_DIGITS = 4
SPAN = "struct<start:int,kind:int,end:int,value:string>"
MATCH = "struct<start:int,end:int,value:string,before:string,after:string>"
#: Characters of context looked at.
AROUND = 60
KNOWN = "struct<start:int,kind:int,end:int,value:string,before:string,after:string>"


def _once(value: Column, use) -> Column:
    """``use`` of a value that is evaluated a single time."""
    return F.element_at(F.transform(F.array(value), use), 1)


def places(text: Column, pattern: str, hint: str) -> Column:
    """All matches with their places in code points and the text next to them, as ``array<MATCH>``.

    The texts between the matches give the places; both come from one pass each.
    Places are summed up in parts of about the root of the number of matches, so
    that no long array is copied for each match.
    """
    none = F.array().cast(f"array<{MATCH}>")
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def joined(gaps: Column) -> Column:
        both = F.zip_with(
            gaps,
            values,
            lambda gap, value: F.struct(
                F.char_length(gap).alias("gap"), value.alias("value"), F.substring(gap, -AROUND, AROUND).alias("before")
            ),
        )
        following = F.transform(F.slice(gaps, 2, F.greatest(F.size(gaps) - 1, F.lit(0))), lambda gap: F.substring(gap, 1, AROUND))
        three = F.zip_with(both, following, lambda x, after: F.struct(x.alias("x"), after.alias("after")))
        return F.filter(three, lambda y: y["x"]["value"].isNotNull())

    held = f"struct<at:int,out:array<{MATCH}>>"
    begin = F.struct(F.lit(0).alias("at"), none.alias("out")).cast(held)

    def add(seen: Column, y: Column) -> Column:
        start = seen["at"] + y["x"]["gap"]
        end = start + F.char_length(y["x"]["value"])
        match = F.struct(
            start.alias("start"), end.alias("end"), y["x"]["value"].alias("value"), y["x"]["before"].alias("before"), y["after"].alias("after")
        )
        return F.struct(end.alias("at"), F.array_append(seen["out"], match).alias("out")).cast(held)

    def moved(part: Column, by: Column) -> Column:
        return F.transform(
            part["out"],
            lambda m: F.struct(
                (m["start"] + by).alias("start"), (m["end"] + by).alias("end"), m["value"].alias("value"), m["before"].alias("before"), m["after"].alias("after")
            ),
        )

    listed = f"struct<at:int,out:array<array<{MATCH}>>>"
    first = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{MATCH}>>").alias("out")).cast(listed)

    def follow(seen: Column, part: Column) -> Column:
        return F.struct(
            (seen["at"] + part["at"]).alias("at"), F.array_append(seen["out"], moved(part, seen["at"])).alias("out")
        ).cast(listed)

    def summed(matches: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(matches))).cast("int")
        starts = F.sequence(F.lit(0), F.floor((F.size(matches) - 1) / width).cast("int"))
        parts = F.transform(starts, lambda k: F.aggregate(F.slice(matches, k * width + 1, width), begin, add))
        all_ = F.flatten(F.aggregate(parts, first, follow, lambda seen: seen["out"]))
        return F.when(F.size(matches) > 0, all_).otherwise(none)

    return F.when(text.rlike(hint), _once(_once(F.split(text, pattern, -1), joined), summed)).otherwise(none)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(PART)
    if kind == "card":
        return F.call_function("luhn_check", digits(value))
    if kind == "phone":
        return F.length(digits(value)).between(9, 15)
    return F.lit(True)


def base_matches(text: Column) -> Column:
    """Matches of the fixed patterns with their kind, ordered by start and kind."""
    def of_kind(number: int, kind: str) -> Column:
        good = F.filter(places(text, PATTERNS[kind], HINTS[kind]), lambda s: valid(kind, s["value"]))
        fields = F.transform(
            good,
            lambda s: F.struct(
                s["start"].alias("start"), F.lit(number).alias("kind"), s["end"].alias("end"), s["value"].alias("value"),
                s["before"].alias("before"), s["after"].alias("after"),
            ),
        )
        return fields.cast(f"array<{KNOWN}>")

    return F.array_sort(F.concat(*[of_kind(number, kind) for number, kind in enumerate(KINDS)]))


def _word(text: Column, pattern: str, edge: str) -> Column:
    word = F.regexp_replace(F.lower(F.regexp_extract(text, pattern, 1)), r"[^\p{L}]", "")
    return F.when(word == "", F.lit(edge)).otherwise(word)


def contexts(before: Column, after: Column) -> Column:
    """The two lexical patterns around a match; words of another match are no context."""
    near = _word(before, r"(\S+)\s*$", "^")
    far = _word(before, r"(\S+)\s+\S+\s*$", "^")
    following = _word(after, r"^\S*\s+(\S+)", "$")
    return F.array(F.concat(F.lit("B "), far, F.lit(" "), near), F.concat(F.lit("A "), near, F.lit(" _ "), following))


def spans_of(matches: Column) -> Column:
    return F.transform(
        matches,
        lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["value"].alias("value")),
    ).cast(f"array<{SPAN}>")


def _candidate(value: Column) -> Column:
    return value.contains("@") | (F.length(digits(value)) >= LEAST_DIGITS)


def find(
    docs: DataFrame,
    rounds: int = 3,
    support: float = 3.0,
    confidence: float = 0.7,
    score: float = 0.8,
    usually: float = 0.5,
    place: str | None = None,
) -> DataFrame:
    """``doc_id, _locator, base, spans`` for every row; the spans hold the base ones and those added.

    ``usually`` is the share of a value's occurrences in kept contexts from which on the
    others are spans too; ``place`` names the column of locators, as in
    :func:`topicweave.llm.exact.deduplicate`.
    A null text is empty.  An added span never overlaps a base span of its row
    and has the kind its patterns stand for.  Ties between kinds go to the first
    listed.  Rows that repeat an id stay apart.  An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "pii")
    rows = narrow(scratch, docs, place).withColumn("text", whole())
    told = rows.withColumn("known", base_matches(F.col("text"))).withColumn("tokens", places(F.col("text"), CANDIDATE, "[0-9@]"))
    taken = F.transform("known", lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end")))
    open_ = F.transform(
        F.filter("tokens", lambda t: _candidate(t["value"]) & ~F.exists("taken", lambda b: (b["start"] < t["end"]) & (b["end"] > t["start"]))),
        lambda t: F.struct(
            t["start"].alias("start"), F.lit(-1).alias("kind"), t["end"].alias("end"), t["value"].alias("value"),
            t["before"].alias("before"), t["after"].alias("after"),
        ),
    ).cast(f"array<{KNOWN}>")
    seen = F.transform(
        F.concat("known", open_),
        lambda s: F.struct(
            s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["value"].alias("value"),
            contexts(s["before"], s["after"]).alias("patterns"),
        ),
    )
    told = told.withColumn("taken", taken).select("doc_id", "_locator", spans_of(F.col("known")).alias("base"), seen.alias("seen"))
    found = scratch.table(told, "found")
    seen = found.select("_locator", F.explode("seen").alias("s")).select("_locator", "s.*")
    edges = seen.select("value", "kind", F.explode("patterns").alias("pattern")).groupBy("pattern", "value").agg(F.max("kind").alias("kind"))
    edges = scratch.table(edges, "edges")
    known = edges.where("kind >= 0").select("value", "kind").groupBy("value").agg(F.min("kind").alias("kind")).withColumn("score", F.lit(1.0))
    known = seeds = scratch.table(known, "known")
    unknown = edges.where("kind < 0").select("pattern", "value").join(seeds.select("value"), "value", "left_anti")
    kept = None
    for _ in range(rounds):
        weighed = edges.select("pattern", "value").join(known, "value", "left")
        sums = [F.sum(F.when(F.col("kind") == k, F.col("score")).otherwise(0.0)).alias(f"s{k}") for k in range(len(KINDS))]
        patterns = weighed.groupBy("pattern").agg(F.count(F.lit(1)).alias("values"), *sums)
        most = F.greatest(*[F.col(f"s{k}") for k in range(len(KINDS))])
        kind = F.coalesce(*[F.when(F.col(f"s{k}") == most, F.lit(k)) for k in range(len(KINDS))])
        patterns = patterns.select("pattern", kind.alias("kind"), most.alias("sure"), (most / F.col("values")).alias("confidence"))
        patterns = patterns.where((F.col("sure") >= support) & (F.col("confidence") >= confidence))
        kept = scratch.table(patterns.select("pattern", "kind", "confidence"), "patterns", replaces=kept)
        doubt = F.log(1 - F.least(F.col("confidence"), F.lit(0.99)))
        of_kind = [
            F.struct(
                (1 - F.exp(F.sum(F.when(F.col("kind") == k, doubt).otherwise(0.0)))).alias("score"),
                F.lit(-k).alias("less"),
                (F.count_if(F.col("kind") == k) / F.count(F.lit(1))).alias("share"),
            )
            for k in range(len(KINDS))
        ]
        best = unknown.join(kept, "pattern", "left").groupBy("value").agg(F.greatest(*of_kind).alias("best"))
        new = best.where(F.col("best.score") >= score).select(
            "value", (-F.col("best.less")).alias("kind"), (F.col("best.score") * F.col("best.share")).alias("score")
        )
        after = scratch.table(seeds.union(new), "known")
        if known is not seeds:
            scratch.drop(known)
        known = after
    learnt = known.join(seeds.select("value"), "value", "left_anti").select("value", F.col("kind").alias("as_kind"))
    met = seen.where("kind < 0").select("_locator", "start", "end", "value", "patterns").join(learnt, "value")
    vouched = kept.select("pattern", F.col("kind").alias("as_kind"), F.lit(1).alias("vouched"))
    met = met.withColumn("pattern", F.explode("patterns")).join(vouched, ["pattern", "as_kind"], "left")
    met = met.groupBy("_locator", "start", "end", "value", "as_kind").agg(F.max(F.coalesce("vouched", F.lit(0))).alias("vouched"))
    met = scratch.table(met, "met")
    usual = met.groupBy("value").agg((F.avg("vouched") >= usually).alias("usual"))
    met = met.join(usual, "value").where("vouched = 1 OR usual")
    span = F.struct("start", F.col("as_kind").alias("kind"), "end", "value").cast(SPAN)
    added = met.groupBy("_locator").agg(F.collect_list(span).alias("added"))  # no more than one text's own tokens
    both = found.join(added, "_locator", "left")
    spans = F.array_sort(F.concat("base", F.coalesce("added", F.array().cast(f"array<{SPAN}>"))))
    return both.select("doc_id", "_locator", "base", spans.alias("spans"))


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def summary(docs: DataFrame) -> DataFrame:
    """Numbers and digests of the spans of every row."""
    found = find(docs)

    def count(number: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == number)).cast("long")

    counts = [count(number).alias(f"n_{kind}") for number, kind in enumerate(KINDS)]
    return found.select(
        "doc_id", *counts, F.sha2(written(F.col("base")).cast("binary"), 256).alias("base_sha256"), written(F.col("spans")).alias("spans")
    )


def masked(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; of overlapping spans the first decides."""
    names = F.array(*[F.lit(f"[{k}]") for k in KINDS])
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")).cast("struct<at:int,out:array<string>>")

    def put(seen: Column, s: Column) -> Column:
        parts = F.concat(
            seen["out"],
            F.array(F.substring(text, seen["at"] + 1, s["start"] - seen["at"]), F.element_at(names, s["kind"] + 1)),
        )
        later = F.struct(s["end"].alias("at"), parts.alias("out")).cast("struct<at:int,out:array<string>>")
        return F.when(s["start"] >= seen["at"], later).otherwise(
            F.struct(F.greatest(seen["at"], s["end"]).alias("at"), seen["out"].alias("out")).cast("struct<at:int,out:array<string>>")
        )

    def end(seen: Column) -> Column:
        return F.concat(F.array_join(seen["out"], ""), F.substring(text, seen["at"] + 1, F.char_length(text)))

    return F.when(F.size(spans) > 0, F.aggregate(spans, begin, put, end)).otherwise(text)


def mask(docs: DataFrame) -> DataFrame:
    """The rows with every span of :func:`find` in their text replaced; ``n_chars``, where there is one, follows."""
    rows, place = located(Scratch(docs.sparkSession, "mask"), docs)
    own = f"{place}_spans"
    spans = find(rows, place=place).where(F.size("spans") > 0).select(F.col("_locator").alias(place), F.col("spans").alias(own))
    text = masked(F.col("text"), F.coalesce(own, F.array().cast(f"array<{SPAN}>")))
    out = rows.join(spans, place, "left").withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
