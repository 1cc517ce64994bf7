"""Places of all matches of a pattern in a text, as DataFrame expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Matches are placed in runs of this many, so that no array grows by one element at a time
#: for long.
RUN = 256


def located(text: Column, pattern: str) -> Column:
    """The leftmost non-overlapping matches: array of struct(start, end, found) in code points.

    The pattern must not match nothing. Null texts have no matches.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    before = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
    pairs = F.arrays_zip(before.alias("gap"), found.alias("found"))
    runs = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(found) - 1) / RUN).cast("int")),
        lambda k: F.slice(pairs, k * RUN + 1, F.lit(RUN)),
    )
    kind = "array<struct<start:int,end:int,found:string>>"

    def state(at: Column, out: Column) -> Column:
        return F.struct(at.alias("at"), out.alias("out"))

    def place(acc: Column, pair: Column) -> Column:
        start = acc["at"] + F.length(pair["gap"])
        end = start + F.length(pair["found"])
        one = F.struct(start.alias("start"), end.alias("end"), pair["found"].alias("found"))
        return state(end, F.concat(acc["out"], F.array(one)))

    def run(acc: Column, part: Column) -> Column:
        return F.aggregate(
            part,
            state(acc["at"], F.array().cast(kind)),
            place,
            lambda inner: state(inner["at"], F.concat(acc["out"], F.array(inner["out"]))),
        )

    nothing = F.array().cast(kind)
    all_runs = F.aggregate(
        runs,
        state(F.lit(0), F.array().cast(f"array<{kind}>")),
        run,
        lambda acc: F.flatten(acc["out"]),
    )
    return F.when(F.size(found) > 0, all_runs).otherwise(nothing)
