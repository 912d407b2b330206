"""Mix sources to target weights by iterative proportional fitting.

The tokens of each cell, a combination of source, language and topic, get a rate. A round scales the rates so that
the sampled tokens of every source are as wanted, then of every language, then of every topic, and
keeps rates at 1 at most; after some rounds all three hold at once as far as the bound allows. A document is sampled if a
number drawn from its id is below the rate of its cell, so its cell's share of tokens is right in expectation and the same
documents are drawn whatever the partitions.

Documents are summed to cells before anything is shuffled; the rounds work on cells only.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import stage

_KEY = "__dim_{}"
#: The columns that :func:`mix` adds; columns of these names are replaced.
TOKENS, RATE, SAMPLED = "__tokens", "__rate", "__sampled"


def dominant_topic(text: Column, patterns: Mapping[str, str], otherwise: str) -> Column:
    """The topic whose pattern is found most often in the whole text, the first by name of several, or ``otherwise``."""
    found = F.array(*(F.struct(F.regexp_count(F.coalesce(text, F.lit("")), F.lit(p)).alias("n"), F.lit(-i).alias("i"), F.lit(name).alias("topic"))
                      for i, (name, p) in enumerate(sorted(patterns.items()))))
    best = F.array_max(found)
    return F.when(best["n"] > 0, best["topic"]).otherwise(otherwise)


def draw(row_id: Column, seed: str = "mix") -> Column:
    """A number from [0, 1) that the id alone decides; 52 bits of an MD5."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(row_id.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def _key(value: Column) -> Column:
    """The value as text; NULL is a value of its own."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(""))


def rake(cells: DataFrame, keys: list[str], exponents: list[float], budget: float, rounds: int) -> DataFrame:
    """Add ``rate`` to cells with ``tokens``: see :func:`mix`."""
    total = cells.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    wanted = []
    for i, (key, exponent) in enumerate(zip(keys, exponents)):
        sums = cells.groupBy(key).agg(F.sum("tokens").cast("double").alias("n")).filter("n > 0").select(key, F.pow("n", F.lit(exponent)).alias("part"))
        parts = sums.agg(F.sum("part")).first()[0] or 1.0
        wanted.append(sums.select(key, (F.col("part") / parts * (budget * total)).alias(f"want{i}")))
    for part, key in zip(wanted, keys):
        cells = cells.join(part, key, "left")
    cells = stage(cells.withColumn("rate", F.lit(float(budget))), "mix-cells")
    for _ in range(rounds):
        for i, key in enumerate(keys):
            now = F.sum(F.col("tokens") * F.col("rate")).over(Window.partitionBy(key))
            cells = cells.withColumn("now", now)
            cells = cells.withColumn("rate", F.when(F.col("now") > 0, F.col("rate") * F.col(f"want{i}") / F.col("now")).otherwise(F.col("rate"))).drop("now")
        cells = stage(cells.withColumn("rate", F.least("rate", F.lit(1.0))), "mix-cells")
    return cells


def margins(docs: DataFrame, dimensions: Mapping[str, Column], exponents: Mapping[str, float], tokens: Column, budget: float = 0.6, rounds: int = 10) -> DataFrame:
    """``dimension, value, tokens, wanted, expected, residual``: how well the rates of :func:`mix` meet each margin.

    ``residual`` is the share by which the expected tokens miss those wanted. It is not zero where a value was to give more tokens than it has,
    and for the values that share cells with it, or where more rounds are needed.
    """
    names = list(dimensions)
    keys = [_KEY.format(i) for i in range(len(names))]
    rows = docs.select(*[_key(dimensions[n]).alias(k) for k, n in zip(keys, names)], tokens.cast("bigint").alias("tokens"))
    raked = rake(stage(rows.groupBy(*keys).agg(F.sum("tokens").alias("tokens")), "mix-cells"), keys, [exponents[n] for n in names], budget, rounds)
    found = [raked.groupBy(F.lit(name).alias("dimension"), F.when(F.col(key) != "", F.substring(key, 2, 1 << 30)).alias("value")).agg(
        F.sum("tokens").alias("tokens"), F.coalesce(F.max(f"want{i}"), F.lit(0.0)).alias("wanted"), F.sum(F.col("tokens") * F.col("rate")).alias("expected"))
        for i, (name, key) in enumerate(zip(names, keys))]
    every = reduce(DataFrame.union, found)
    return every.withColumn("residual", F.when(F.col("wanted") > 0, F.abs(F.col("expected") - F.col("wanted")) / F.col("wanted")).otherwise(F.lit(0.0)))


def mix(docs: DataFrame, dimensions: Mapping[str, Column], exponents: Mapping[str, float], tokens: Column, budget: float = 0.6,
        rounds: int = 10, id_col: str = "doc_id", seed: str = "mix") -> DataFrame:
    """``docs`` with ``__tokens``, ``__rate`` and ``__sampled``.

    About ``budget`` of all tokens are sampled. Among the values of each dimension they are to be shared in
    proportion to the value's tokens to the power of its exponent: 1 keeps the mixture, 0 gives every value the
    same. A value that has fewer tokens than it is to give is taken whole. NULL is a value of its own in
    every dimension, and a row without tokens has the rate of its cell. Rows that share an id (NULL too) draw the same number.
    """
    names = list(dimensions)
    keys = [_KEY.format(i) for i in range(len(names))]
    n, drawn = tokens.cast("bigint"), draw(F.col(id_col), seed)
    held = docs.select(F.struct(*docs.columns).alias("doc"), *[_key(dimensions[d]).alias(k) for k, d in zip(keys, names)], n.alias("n"), drawn.alias("drawn"))
    cells = stage(held.groupBy(*keys).agg(F.sum("n").alias("tokens")), "mix-cells")
    rates = rake(cells, keys, [exponents[d] for d in names], budget, rounds).select(*keys, "rate")
    own = [F.col("doc")[c].alias(c) for c in docs.columns if c not in (TOKENS, RATE, SAMPLED)]
    return held.join(rates, keys).select(*own, F.col("n").alias(TOKENS), F.col("rate").alias(RATE), (F.col("drawn") < F.col("rate")).alias(SAMPLED))
