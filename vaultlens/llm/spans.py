"""Places of regular-expression matches, with built-in column functions only.

Spark returns matched strings but not their places. Cutting a text at a pattern gives the
gaps between its matches, so a match starts after all gaps and matches before it. The
running sums are taken in blocks of ``BLOCK`` matches, which keeps a text with very many
matches near linear. Every array that a lambda reads by position is a column of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 64


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def with_spans(rows: DataFrame, text: str, patterns: dict[str, str], context: int = 0) -> DataFrame:
    """``rows`` plus a column per pattern: array of struct(start, end, value, before, after) of its
    leftmost non-overlapping matches, in code points, end exclusive. ``before`` and ``after`` hold
    up to ``context`` characters next to the match, no further than the pattern's next match.
    A pattern must not match an empty string. Texts must not be null."""
    def step(d, prefix, make):
        return d.select("*", *[make(k).alias(f"_{prefix}_{k}") for k in patterns])

    col = lambda prefix, k: F.col(f"_{prefix}_{k}")
    d = step(rows, "match", lambda k: F.regexp_extract_all(text, F.lit(patterns[k]), F.lit(0)))
    d = step(d, "gap", lambda k: F.when(F.size(col("match", k)) > 0, F.split(text, patterns[k], -1)))
    d = step(d, "step", lambda k: F.when(F.size(col("match", k)) > 0, F.transform(
        col("match", k), lambda m, i: (F.length(F.get(col("gap", k), i)) + F.length(m)).cast("long"))))
    blocks = lambda k: F.floor((F.size(col("match", k)) - 1) / BLOCK).cast("int")
    d = step(d, "block", lambda k: F.when(F.size(col("match", k)) > 0, F.transform(
        F.sequence(F.lit(0), blocks(k)), lambda b: _sum(F.slice(col("step", k), b * BLOCK + 1, F.lit(BLOCK))))))
    d = step(d, "base", lambda k: F.when(F.size(col("match", k)) > 0, F.aggregate(
        col("block", k), F.array(F.lit(0).cast("long")), lambda a, x: F.array_append(a, F.element_at(a, -1) + x))))

    def place(k):
        def one(m, i):
            block = F.floor(i / BLOCK).cast("int")
            end = F.get(col("base", k), block) + _sum(F.slice(col("step", k), block * BLOCK + 1, i - block * BLOCK + 1))
            gap, rest = F.get(col("gap", k), i), F.get(col("gap", k), i + 1)
            return F.struct((end - F.length(m)).alias("start"), end.alias("end"), m.alias("value"),
                            F.right(gap, F.lit(context)).alias("before"), F.left(rest, F.lit(context)).alias("after"))
        empty = F.array().cast("array<struct<start:long,end:long,value:string,before:string,after:string>>")
        return F.when(F.size(col("match", k)) > 0, F.transform(col("match", k), one)).otherwise(empty)

    return step(d, "span", place).select(*rows.columns, *[col("span", k).alias(k) for k in patterns])


def named(kind: str, spans: Column | str) -> Column:
    """``kind:start:end`` of each span."""
    return F.transform(spans, lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))
