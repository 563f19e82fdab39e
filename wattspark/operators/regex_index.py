"""Regex theta join by an inverted index of trigrams.

Every match of a pattern holds the pattern's longest sure run of literal characters.  The
distinct texts are indexed by their trigrams; a pattern is looked up by the rarest trigram of
its literal (an equi-join), and the literal and the regex itself only verify the candidates.
Patterns without a literal of three characters have no trigram to look up and are left to
the caller.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Shortest literal that has a trigram.
GRAM = 3
_CLOSING = {"(": ")", "[": "]"}


def required_literal(pattern: str) -> str:
    """The longest run of characters that every match of a (Java) regex holds; '' if none is
    sure.  Anything but plain characters, escaped punctuation and anchors ends a run."""
    if "|" in pattern or "(?" in pattern or "\\Q" in pattern:
        return ""
    runs, run, i = [], "", 0
    while i < len(pattern):
        c = pattern[i]
        literal = None
        if c == "\\" and i + 1 < len(pattern):
            i += 1
            literal = pattern[i] if not pattern[i].isalnum() else None
        elif c in _CLOSING:
            depth, close = 0, _CLOSING[c]
            while i < len(pattern):
                if pattern[i] == "\\":
                    i += 1
                elif pattern[i] == c:
                    depth += 1
                elif pattern[i] == close:
                    depth -= 1
                    if not depth:
                        break
                i += 1
        elif c not in ".^$*+?{}":
            literal = c
        after = pattern[i + 1:i + 2]
        if literal is None or after in ("?", "*", "{"):     # optional, or not a plain character
            runs.append(run)
            run = ""
            if c == "{":
                i = max(i, pattern.find("}", i))
        else:
            run += literal
            if after == "+":
                runs.append(run)
                run = ""
        i += 1
    return max([*runs, run], key=len)


@F.pandas_udf(T.StringType())
def _literals(patterns: pd.Series) -> pd.Series:
    return patterns.map(required_literal)


def with_literals(patterns: DataFrame, escape: bool) -> DataFrame:
    """``__pattern`` with ``__literal``."""
    literal = F.col("__pattern") if escape else _literals("__pattern")
    return patterns.withColumn("__literal", literal)


def _grams(c: Column) -> Column:
    every = F.transform(F.sequence(F.lit(1), F.length(c) - (GRAM - 1)),
                        lambda i: F.substring(c, i, F.lit(GRAM)))
    return F.explode(F.array_distinct(every))


def indexed_pairs(texts: DataFrame, patterns: DataFrame, escape: bool) -> DataFrame:
    """(``__text``, ``__pattern``) matches of distinct texts and of patterns with a literal of
    at least ``GRAM`` characters."""
    wanted = patterns.select("__pattern", "__literal", _grams(F.col("__literal")).alias("__gram"))
    wanted = wanted.checkpoint(eager=True)
    grams = wanted.select("__gram").distinct()
    index = (texts.filter(F.length("__text") >= GRAM)
             .select("__text", _grams(F.col("__text")).alias("__gram"))
             .join(grams, "__gram", "left_semi").checkpoint(eager=True))
    held = index.groupBy("__gram").agg(F.count(F.lit(1)).alias("__texts"))
    # a gram that no text holds rules its pattern out: it counts 0 and is the rarest
    rarest = (wanted.join(held, "__gram", "left")
              .groupBy("__pattern", "__literal")
              .agg(F.min(F.struct(F.coalesce("__texts", F.lit(0)).alias("n"),
                                  F.col("__gram").alias("gram"))).alias("best")))
    rarest = rarest.filter("best.n > 0").select("__pattern", "__literal", F.col("best.gram").alias("__gram"))
    found = index.join(rarest, "__gram").filter(F.contains("__text", "__literal"))
    if not escape:
        found = found.filter(F.expr("__text rlike __pattern"))
    return found.select("__text", "__pattern")
