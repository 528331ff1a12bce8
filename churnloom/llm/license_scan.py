"""Licence scans with ordered signature rules, with DataFrame functions only.

A text becomes its words. A rule is tried only where all of its keywords are among them. Its matches are marked in
the text, and cutting the text at the marks gives each word the number of the match that covers it; so whether an
interval of one rule lies in a match of another is a comparison of two array entries. Everything happens inside a
row: nothing is shuffled and no row waits for another.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import c, fresh
from .license_rules import CONFIDENCE, TEXT, Rule, signature_rules

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GAPS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_OPEN, _SHUT = "\x01", "\x02"


def words_of(text: Column) -> Column:
    """The words of a text: runs of digits, letters and non-ASCII characters, with A-Z lower-cased; null has none."""
    whole = F.coalesce(text.cast("string"), F.lit(""))
    # lower() also changes letters beyond ASCII, so it serves only texts without them.
    lower = F.when(F.octet_length(whole) == F.length(whole), F.lower(whole)).otherwise(F.translate(whole, _UPPER, _LOWER))
    return F.array_remove(F.split(lower, _GAPS), "")


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def _rule_table(rules: Sequence[Rule]) -> Column:
    """Rules as one constant array."""
    return F.array(
        *[
            F.struct(
                F.lit(i).alias("rank"), F.lit(r.label).alias("label"), F.array(*map(F.lit, r.keywords)).alias("keywords"),
                F.lit(r.regex).alias("regex"), F.lit(r.priority).alias("priority"),
                F.lit(CONFIDENCE[r.priority]).alias("confidence"),
            )
            for i, r in enumerate(rules)
        ]
    )


def _cover(marked: Column) -> Column:
    """For each word the number of the match that covers it, or 0."""

    def fill(piece: Column, i: Column) -> Column:
        n_words = (F.length(piece) - F.length(F.replace(piece, F.lit(" "), F.lit("")))) / 2
        return F.array_repeat(F.when(i % 2 == 1, ((i + 1) / 2).cast("int")).otherwise(F.lit(0)), n_words.cast("int"))

    return F.flatten(F.transform(F.split(marked, f"[{_OPEN}{_SHUT}]", -1), fill))


def _spans(cover: Column) -> Column:
    """First and last word of each match, in order."""
    last = F.size(cover) - 1
    places = F.sequence(F.lit(0), last)
    starts = F.filter(places, lambda i: (cover[i] > 0) & ((i == 0) | (F.get(cover, i - 1) != cover[i])))
    ends = F.filter(places, lambda i: (cover[i] > 0) & ((i == last) | (F.get(cover, i + 1) != cover[i])))
    return F.zip_with(starts, ends, lambda a, z: F.struct(a.alias("start"), z.alias("end")))


def _found(words: Column, table: Column) -> Column:
    """The rules with a match, each with its cover array and spans."""
    text = F.concat(F.lit(" "), F.array_join(words, "  "), F.lit(" "))

    def matched(text: Column) -> Column:
        tried = F.filter(table, lambda r: F.forall(r["keywords"], lambda k: F.array_contains(words, k)))
        marked = F.transform(
            tried, lambda r: F.struct(r.alias("rule"), F.regexp_replace(text, r["regex"], F.lit(f"{_OPEN}$0{_SHUT}")).alias("marked"))
        )
        hit = F.filter(marked, lambda m: F.contains(m["marked"], F.lit(_OPEN)))
        covered = F.transform(hit, lambda m: F.struct(m["rule"].alias("rule"), _cover(m["marked"]).alias("cover")))
        return F.transform(
            covered, lambda m: F.struct(m["rule"].alias("rule"), m["cover"].alias("cover"), _spans(m["cover"]).alias("spans"))
        )

    return _bind(text, matched)


def _survivors(found: Column) -> Column:
    """Spans that no stronger span holds: of higher priority, else longer, else of an earlier rule."""

    def kept(m: Column) -> Column:
        def beaten(s: Column) -> Column:
            def beats(o: Column) -> Column:
                number = o["cover"][s["start"]]
                held = (number > 0) & (number == o["cover"][s["end"]]) & (o["rule"]["rank"] != m["rule"]["rank"])
                # The match of the other rule with this number; numbers follow the spans.
                span = o["spans"][F.greatest(number, F.lit(1)) - 1]
                more = (span["end"] - span["start"]) - (s["end"] - s["start"])
                above = o["rule"]["priority"] - m["rule"]["priority"]
                return held & ((above > 0) | ((above == 0) & ((more > 0) | (o["rule"]["rank"] < m["rule"]["rank"]))))

            return F.exists(found, beats)

        clear = F.filter(m["spans"], lambda s: ~beaten(s))
        return F.transform(
            clear,
            lambda s: F.struct(
                m["rule"]["rank"].alias("rule"), m["rule"]["label"].alias("label"), s["start"].alias("start"), s["end"].alias("end"),
                m["rule"]["confidence"].alias("confidence"),
            ),
        )

    return F.flatten(F.transform(found, kept))


def scan(docs: DataFrame, phrases: dict[str, str], rules: Sequence[Rule] | None = None, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``n_words``, ``places`` and ``detections``; columns of these names are replaced.

    ``phrases`` maps a phrase of words to its label. ``places`` lists ``(label, start)`` of every place where a phrase's
    words stand consecutively (overlapping places of one phrase too). ``detections`` lists ``(rule, label, start, end,
    confidence)`` of the matches of ``rules`` (word numbers from 0, both ends included; matches of one rule do not
    overlap) that no stronger match holds; phrases take part as the first rules, of the highest priority. Texts are read
    whole; null and empty texts have no words, and their lists are empty. Rows stay as they are, repeated ones too.
    """
    own = [Rule(label, tuple(dict.fromkeys(phrase.split())), phrase, TEXT) for phrase, label in phrases.items()]
    every = [*own, *(signature_rules() if rules is None else rules)]
    table = _rule_table(every)
    keywords = F.array(*[F.lit(k) for k in dict.fromkeys(r.keywords[0] for r in every)])
    words, found, gate = fresh(docs, "words"), fresh(docs, "found"), fresh(docs, "gate")
    spots = "array<struct<label:string,start:int>>"
    kinds = "array<struct<rule:int,label:string,start:int,end:int,confidence:double>>"
    read = docs.withColumn(words, words_of(c(text)))
    gated = read.withColumn(gate, F.arrays_overlap(c(words), keywords))
    tried = gated.withColumn(found, F.when(c(gate), _found(c(words), table)))

    def places(words: Column) -> Column:
        def of(phrase: list[str], label: str) -> Column:
            def here(i: Column) -> Column:
                met = F.lit(True)
                for j, word in enumerate(phrase):
                    met = met & (F.get(words, i + j) == word)
                return met

            starts = F.filter(F.sequence(F.lit(0), F.size(words) - 1), here)
            every = F.transform(starts, lambda i: F.struct(F.lit(label).alias("label"), i.alias("start")))
            held = F.forall(F.array(*map(F.lit, dict.fromkeys(phrase))), lambda k: F.array_contains(words, k))
            return F.when(held, every).otherwise(F.array().cast(spots))

        return F.concat(F.array().cast(spots), *[of(p.split(), x) for p, x in phrases.items() if p.split()])

    names = {"n_words", "places", "detections"}
    kept = [c(x) for x in docs.columns if x.lower() not in names]
    return tried.select(
        *kept,
        F.size(c(words)).cast("long").alias("n_words"),
        F.coalesce(F.when(c(gate), places(c(words))), F.array().cast(spots)).alias("places"),
        F.coalesce(F.when(c(gate), _bind(c(found), _survivors)), F.array().cast(kinds)).alias("detections"),
    )


def joined(labels: Column) -> Column:
    """Distinct labels in order, joined by commas."""
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")
