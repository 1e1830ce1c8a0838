"""Sequence matching as Arrow-batched functions.

Matching blocks (longest common run, then the same left and right of it) have no
relational equivalent, so these run in Python, vectorised over Arrow batches.
"""

from __future__ import annotations

import difflib
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from cuelattice.functions.text import lexical_words, within_counts


def normal(token: str) -> str:
    return re.sub("[^a-z0-9]+", "", token.lower())


def matcher(a: list[str], b: list[str]) -> difflib.SequenceMatcher:
    return difflib.SequenceMatcher(a=a, b=b, autojunk=False)


@F.pandas_udf(Ty.DoubleType())
def seq_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """2 x matched / total over two word arrays. The order matters; two empty ones give 1; null counts as empty."""
    return pd.Series([matcher(list(x) if x is not None else [], list(y) if y is not None else []).ratio() for x, y in zip(a, b)], dtype="float64")


@F.pandas_udf(Ty.ArrayType(Ty.StructType([Ty.StructField("i", Ty.IntegerType()), Ty.StructField("j", Ty.IntegerType())])))
def index_map(a: pd.Series, b: pd.Series) -> pd.Series:
    """Index pairs inside equal blocks of the two token arrays' normal forms; empty normal forms take part."""

    def pairs(x, y) -> list[dict]:
        blocks = matcher([normal(t) for t in x], [normal(t) for t in y]).get_matching_blocks()
        return [{"i": m.a + k, "j": m.b + k} for m in blocks for k in range(m.size)]

    return pd.Series([pairs(x, y) if x is not None and y is not None else [] for x, y in zip(a, b)])


def merged(a: str, b: str) -> str:
    """One text of two: what only one has is taken, of two readings the longer, of equally long ones b's."""
    x, y = a.split(), b.split()
    out: list[str] = []
    for kind, i, k, j, m in matcher([normal(t) for t in x], [normal(t) for t in y]).get_opcodes():
        from_a = kind == "delete" or (kind == "replace" and k - i > m - j)
        out += x[i:k] if from_a else y[j:m]
    return " ".join(out)


@F.pandas_udf(Ty.StringType())
def mechanical_merge(a: pd.Series, b: pd.Series) -> pd.Series:
    """``merged`` for every pair; null counts as empty."""
    return pd.Series([merged(x or "", y or "") for x, y in zip(a, b)])


def valid_by_counts(text: Column, a: Column, b: Column) -> Column:
    """What can be told of a consensus without matching: not empty, no fence, word counts in bounds."""
    size = lambda c: F.size(lexical_words(c))
    return (text != "") & ~F.contains(text, F.lit("```")) & within_counts(size(text), size(a), size(b))


def ratio_bound(a: Column, b: Column) -> Column:
    """An upper bound of seq_ratio from the lengths alone; cheap, so it goes first."""
    return F.when(F.size(a) + F.size(b) == 0, 1.0).otherwise(2 * F.least(F.size(a), F.size(b)) / (F.size(a) + F.size(b)))
