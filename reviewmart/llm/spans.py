"""Places of regular expression matches, by DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewmart.llm.common import let

SPAN = "array<struct<kind:string,start:int,end:int,value:string>>"
# Matches whose places are summed up in one go; keeps long lists from being copied too often.
_RUN = 128


def none() -> Column:
    return F.array().cast(SPAN)


def found(text: Column, kind: str, pattern: str, value_group: int = 0) -> Column:
    """All leftmost non-overlapping matches as spans of code points, end exclusive.

    The text between matches and the matches themselves give all lengths; places are their
    running sums. ``value`` holds the given group of the match.
    """
    pieces = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)).alias("value"),
    )

    def summed(run: Column) -> Column:
        """Length of a run of pieces, and its spans from the run's beginning."""

        def step(state: Column, piece: Column) -> Column:
            start = state["length"] + F.length(piece["gap"])
            end = start + F.coalesce(F.length(piece["match"]), F.lit(0))
            span = F.struct(
                F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), piece["value"].alias("value")
            )
            return F.struct(
                end.alias("length"),
                F.when(piece["match"].isNull(), state["spans"])
                .otherwise(F.concat(state["spans"], F.array(span)))
                .alias("spans"),
            )

        return F.aggregate(run, F.struct(F.lit(0).alias("length"), none().alias("spans")), step)

    def placed(runs: Column) -> Column:
        def step(state: Column, run: Column) -> Column:
            shifted = F.transform(
                run["spans"],
                lambda s: F.struct(
                    s["kind"].alias("kind"),
                    (s["start"] + state["length"]).alias("start"),
                    (s["end"] + state["length"]).alias("end"),
                    s["value"].alias("value"),
                ),
            )
            return F.struct(
                (state["length"] + run["length"]).alias("length"),
                F.concat(state["parts"], F.array(shifted)).alias("parts"),
            )

        start = F.struct(F.lit(0).alias("length"), F.array().cast(f"array<{SPAN}>").alias("parts"))
        return F.flatten(F.aggregate(runs, start, step, lambda state: state["parts"]))

    runs = let(
        pieces,
        lambda all_: F.transform(
            F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / _RUN).cast("int")),
            lambda n: summed(F.slice(all_, n * _RUN + 1, _RUN)),
        ),
    )
    return F.when(text.rlike(pattern), placed(runs)).otherwise(none())


def listed(spans: Column, kinds: tuple[str, ...], by_start: bool, field: str | None = None) -> Column:
    """``kind:start:end`` joined by commas, by kind as listed and start, or the other way round; with
    ``field``, what each span has there instead, in the same order."""
    places = F.array(*(F.lit(kind) for kind in kinds))
    rank = lambda s: F.array_position(places, s["kind"]).cast("int")
    keyed = F.transform(
        spans,
        lambda s: F.struct(
            (s["start"] if by_start else rank(s)).alias("first"),
            (rank(s) if by_start else s["start"]).alias("second"),
            s["end"].alias("third"),
            s["kind"].alias("kind"),
            s["start"].alias("start"),
            (s[field] if field else F.lit(None)).cast("string").alias("shown"),
        ),
    )

    def shown(s: Column) -> Column:
        return s["shown"] if field else F.concat_ws(":", s["kind"], s["start"], s["third"])

    return F.concat_ws(",", F.transform(F.sort_array(keyed), shown))


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def blanked(text: Column, spans: Column) -> Column:
    """``text`` with blanks in place of all spans, so that everything else stays where it is."""

    def step(state: Column, s: Column) -> Column:
        begin = F.greatest(state["at"], s["start"])
        piece = F.concat(
            F.substring(text, state["at"] + 1, begin - state["at"]),
            F.repeat(F.lit(" "), F.greatest(s["end"] - begin, F.lit(0))),
        )
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.concat(state["parts"], F.array(piece)).alias("parts"),
        )

    ordered = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    return F.aggregate(
        ordered,
        start,
        step,
        lambda state: F.concat(F.array_join(state["parts"], ""), F.substring(text, state["at"] + 1, F.length(text))),
    )


def replaced(text: Column, spans: Column, united: bool = False) -> Column:
    """``text`` with each span put in place of its ``value``; of overlapping spans the first counts.

    With ``united`` that one takes the place of all that overlapping spans cover. Null values remove
    the span's text.
    """

    def step(state: Column, s: Column) -> Column:
        fresh = s["start"] >= state["at"]
        piece = F.concat(
            F.substring(text, state["at"] + 1, s["start"] - state["at"]), F.coalesce(s["value"], F.lit(""))
        )
        return F.struct(
            F.when(fresh, s["end"])
            .otherwise(F.greatest(state["at"], s["end"]) if united else state["at"])
            .alias("at"),
            F.when(fresh, F.concat(state["parts"], F.array(piece))).otherwise(state["parts"]).alias("parts"),
        )

    ordered = F.sort_array(
        F.transform(
            spans,
            lambda s: F.struct(
                s["start"].alias("start"), (-s["end"]).alias("widest"), s["end"].alias("end"), s["value"].alias("value")
            ),
        )
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    return F.aggregate(
        ordered,
        start,
        step,
        lambda state: F.concat(F.array_join(state["parts"], ""), F.substring(text, state["at"] + 1, F.length(text))),
    )
