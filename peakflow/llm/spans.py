"""Places of regular-expression matches as arrays, from built-in functions alone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def running_sum(a: Column) -> Column:
    """Prefix sums of an integer array, by doubling steps: n log n for an array of n items."""
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(a), F.lit(1)))).cast("int"))

    def double(acc, k):
        by = F.pow(F.lit(2), k).cast("int")
        return F.transform(acc, lambda x, i: F.when(i >= by, x + F.get(acc, i - by)).otherwise(x))

    return F.when(F.size(a) > 0, F.aggregate(steps, a, double)).otherwise(a)


def matches(text: Column, pattern: str, *groups: int) -> Column:
    """array<struct<start, end, s, g...>> of the leftmost non-overlapping matches of a pattern that matches no empty string.

    Counted in code points, end exclusive; ``g<n>`` holds group n. A text without a match costs one search.
    """
    p = F.lit(pattern)
    hits = F.regexp_extract_all(text, p, F.lit(0))
    gaps = F.split(text, pattern, -1)
    ends = running_sum(F.zip_with(F.slice(gaps, F.lit(1), F.size(hits)), hits, lambda g, h: F.length(g) + F.length(h)))
    zipped = F.arrays_zip(ends.alias("end"), hits.alias("s"), *[F.regexp_extract_all(text, p, F.lit(g)).alias(f"g{g}") for g in groups])
    made = F.transform(zipped, lambda x: F.struct((x["end"] - F.length(x["s"])).alias("start"), x["end"], x["s"], *[x[f"g{g}"] for g in groups]))
    kind = "array<struct<start:int,end:int,s:string" + "".join(f",g{g}:string" for g in groups) + ">>"
    return F.when(F.regexp_like(text, p), made.cast(kind)).otherwise(F.array().cast(kind))
