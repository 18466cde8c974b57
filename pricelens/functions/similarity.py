"""Name similarity: Ratcliff-Obershelp ratio and its exact cheap upper bound."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ratio(a: str, b: str) -> float:
    """difflib ratio of the lower-cased names; argument order matters."""
    from difflib import SequenceMatcher

    return SequenceMatcher(None, a.lower(), b.lower()).ratio()


@F.pandas_udf(T.DoubleType())
def name_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Arrow-batched ratio(a, b); NULL when either name is NULL.

    One SequenceMatcher per distinct second name in the batch: its index of
    the second sequence (and the autojunk decision on it) is built once and
    reused for every first name, which gives the same ratio as a fresh
    matcher per pair.
    """
    from difflib import SequenceMatcher

    matchers: dict[str, SequenceMatcher] = {}
    out = []
    for x, y in zip(a, b):
        if x is None or y is None:
            out.append(None)
            continue
        yl = y.lower()
        sm = matchers.get(yl)
        if sm is None:
            sm = matchers[yl] = SequenceMatcher(None, "", yl)
        sm.set_seq1(x.lower())
        out.append(sm.ratio())
    return pd.Series(out, dtype="float64")


def name_len(name) -> Column:
    c = F.col(name) if isinstance(name, str) else name
    return F.char_length(F.lower(c))


def length_bound(la: Column, lb: Column) -> Column:
    """2*min(la, lb)/(la + lb): an upper bound of the ratio (and of
    1 - edit distance / max length). Two empty names -> 1.0."""
    return F.when((la + lb) == 0, F.lit(1.0)).otherwise(
        (F.least(la, lb) * 2).cast("double") / (la + lb).cast("double"))


def edit_similarity(a: Column, b: Column) -> Column:
    """1 - levenshtein/max length on lower-cased names (a native score used
    where an SQL engine must reproduce the ranking)."""
    la, lb = F.char_length(F.lower(a)), F.char_length(F.lower(b))
    m = F.greatest(la, lb)
    return F.when(m == 0, F.lit(1.0)).otherwise(
        F.lit(1.0) - F.levenshtein(F.lower(a), F.lower(b)).cast("double") / m.cast("double"))


def difflib_similarity(a: Column, b: Column) -> Column:
    return name_similarity(a, b)
