"""Licence scans by ordered signature rules. DataFrame functions only.

A text is reduced to its lower-case words with single spaces between. The set of its words is met
with the keywords of all rules, and only the rules whose keyword it holds are matched. Every match
is a span of words. A span inside another one is suppressed, and of equal spans the rule of lower
rank stays. Spans that overlap in part are taken in order of rank, and one stays if it overlaps none
that stays already. No rows are shuffled.

Defined results: null and empty texts have no words, no labels and score 0. Equal rows get equal
results. An empty table gives an empty result. Columns of the input travel inside a struct, so no
name can clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.common import ROW, packed
from tillhouse.llm.license_rules import Rule, rules

# The base phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The lower-case words of a text as an array; empty for null."""
    # Lower-casing turns the Kelvin sign into a plain k, which lower-casing A-Z does not.
    plain = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\u03ba")))
    line = F.btrim(F.regexp_replace(plain, SEPARATORS, " "))
    return F.when(line == "", F.array().cast("array<string>")).otherwise(F.split(line, " "))


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _spans(line: Column, regex: Column) -> Column:
    """(start, end) in words of all matches of `regex` in `line`, which has a space at each end.

    The pieces between the matches tell where these stand: Spark gives matches without places.
    """
    matches = F.transform(F.regexp_extract_all(line, regex, F.lit(0)), _spaces)
    pieces = F.transform(F.split(line, regex, -1), _spaces)
    pairs = F.arrays_zip(pieces.alias("p"), matches.alias("m"))
    start = F.struct(F.lit(-1).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))

    def step(state: Column, pair: Column) -> Column:
        begin = state["at"] + pair["p"]
        end = begin + pair["m"] + 1
        return F.struct(
            (end - 1).alias("at"),
            F.concat(state["out"], F.array(F.struct(begin.alias("start"), end.alias("end")))).alias("out"),
        )

    # The last piece has no match after it.
    return F.aggregate(F.filter(pairs, lambda pair: pair["m"].isNotNull()), start, step, lambda state: state["out"])


def _table(found: list[Rule]) -> Column:
    rows = ", ".join(
        f"named_struct('rank', {r.rank}, 'label', '{r.label}', 'keyword', '{r.keyword}', 'certainty', {r.certainty}D, 'regex', r'{r.regex}')"
        for r in found
    )
    return F.expr(f"array({rows})")


_SPAN = "struct<start:int,minus_end:int,rank:int,end:int,label:string,certainty:double>"


def _resolved(spans: Column) -> Column:
    """Sorted spans without those that another one suppresses."""
    none = F.array().cast(f"array<{_SPAN}>")
    start = F.struct(F.lit(-1).alias("reach"), none.alias("out"))
    # Sorted by start, longest first, then rank: a span is inside another if one before reaches as far.
    outer = F.aggregate(
        F.array_sort(spans), start,
        lambda state, s: F.when(s["end"] <= state["reach"], state).otherwise(
            F.struct(s["end"].alias("reach"), F.concat(state["out"], F.array(s)).alias("out"))
        ),
        lambda state: state["out"],
    )

    # No span of `outer` holds another, so spans that overlap through others follow each other: they are one chain.
    step = lambda state, s: F.struct(
        s["end"].alias("reach"),
        F.when(
            s["start"] < state["reach"],
            F.concat(
                F.slice(state["out"], F.lit(1), F.size(state["out"]) - 1),
                F.array(F.concat(F.element_at(state["out"], -1), F.array(s))),
            ),
        ).otherwise(F.concat(state["out"], F.array(F.array(s)))).alias("out"),
    )
    no_chain = F.struct(F.lit(-1).alias("reach"), F.array().cast(f"array<array<{_SPAN}>>").alias("out"))
    chains = F.aggregate(outer, no_chain, step, lambda state: state["out"])

    def accepted(chain: Column) -> Column:
        """By rank, the spans that overlap none accepted before."""
        return F.aggregate(
            F.array_sort(chain, lambda a, b: a["rank"] - b["rank"]), none,
            lambda out, s: F.when(
                F.exists(out, lambda o: (o["start"] < s["end"]) & (s["start"] < o["end"])), out
            ).otherwise(F.concat(out, F.array(s))),
        )

    kept = F.transform(chains, lambda chain: F.when(F.size(chain) == 1, chain).otherwise(accepted(chain)))
    return F.array_sort(F.flatten(kept))


def detect(docs: DataFrame, extra: list[Rule] | None = None) -> DataFrame:
    """Every row of `docs` inside `ROW` with n_words, base (spans of base phrases) and detections (resolved spans).

    `extra` replaces the built-in rules.
    """
    signatures = rules() if extra is None else extra
    base = [Rule(i, label, phrase.split(" ")[0], 1.0, rf"(?<= ){phrase}(?= )") for i, (phrase, label) in enumerate(BASE.items())]
    keywords = sorted({r.keyword for r in [*signatures, *base]})
    known = F.expr("array(" + ", ".join(f"'{k}'" for k in keywords) + ")")
    rows = packed(docs).withColumn("words", words_of(F.col(f"{ROW}.text").cast("string")))
    gated = rows.select(
        ROW,
        F.size("words").cast("long").alias("n_words"),
        F.array_intersect("words", known).alias("held"),
        F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")).alias("line"),
    )

    def spans(table: list[Rule]) -> Column:
        def of(rule: Column) -> Column:
            return F.transform(
                _spans(F.col("line"), rule["regex"]),
                lambda s: F.struct(
                    s["start"].alias("start"), (-s["end"]).alias("minus_end"), rule["rank"].alias("rank"),
                    s["end"].alias("end"), rule["label"].alias("label"), rule["certainty"].alias("certainty"),
                ),
            )

        live = F.filter(_table(table), lambda rule: F.array_contains("held", rule["keyword"]))
        return F.when(F.size("held") == 0, F.array().cast(f"array<{_SPAN}>")).otherwise(F.flatten(F.transform(live, of)))

    return gated.select(ROW, "n_words", spans(base).alias("base"), _resolved(spans(signatures)).alias("detections"))


def _labels(found: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(found)), ",")


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: its words, the places of base phrases, labels, and the certainty of the best detection."""
    found = detect(docs.select("doc_id", "text"))
    starts = F.transform("base", lambda s: s["start"].cast("long"))
    base, own = F.transform("base", lambda s: s["label"]), F.transform("detections", lambda s: s["label"])
    best = F.array_max(F.transform("detections", lambda s: s["certainty"]))
    floor = F.when(F.size("base") > 0, 0.7).otherwise(0.0)
    return found.select(
        F.col(f"{ROW}.doc_id").alias("doc_id"),
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        _labels(base).alias("base_labels"),
        _labels(F.concat(base, own)).alias("labels"),
        F.greatest(F.coalesce(best, F.lit(0.0)), floor).alias("score"),
        F.size("detections").cast("long").alias("n_detections"),
    )
