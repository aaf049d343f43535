"""Normalised indel similarity, 100 * 2 LCS / (n + m), as an Arrow function and its plain form."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bibspark.functions.text import _EDGE


def masks(a: str) -> dict[str, int]:
    """Places of each character, a bit for each."""
    at: dict[str, int] = {}
    for i, ch in enumerate(a):
        at[ch] = at.get(ch, 0) | (1 << i)
    return at


def lcs(a: str, b: str, at: dict[str, int] | None = None) -> int:
    """Length of the longest common subsequence, one machine-word operation row for each character of ``b``."""
    at = masks(a) if at is None else at
    full = (1 << len(a)) - 1
    v = full
    for ch in b:
        m = at.get(ch)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def ratio(a: str, b: str) -> float:
    """Both empty: 100."""
    n = len(a) + len(b)
    return 100.0 if n == 0 or a == b else 200.0 * lcs(a, b) / n


_seen: dict[str, np.ndarray] = {}


def _histograms(texts: list[str]) -> np.ndarray:
    """Counts of characters in 40 classes, kept for texts that come again in a worker's batches."""
    if len(_seen) > 200_000:
        _seen.clear()
    for t in texts:
        if t not in _seen:  # UTF-16 units; equal characters are equal units
            _seen[t] = np.bincount(np.frombuffer(t.encode("utf-16-le", "surrogatepass"), dtype=np.uint16) % 40, minlength=40).astype(np.int16 if len(t) < 16_000 else np.int32)
    return np.array([_seen[t] for t in texts])


def ratios(left: pd.Series, right: pd.Series, least: float = 0.0) -> np.ndarray:
    """Ratios of pairs; where counts of characters alone rule out ``least``, 0 without alignment."""
    a, b = left.fillna("").tolist(), right.fillna("").tolist()
    out = np.zeros(len(a))
    if not a:
        return out
    if least > 0:
        names = list(dict.fromkeys(a + b))
        no = {t: k for k, t in enumerate(names)}
        h = _histograms(names)
        ia, ib = np.array([no[t] for t in a]), np.array([no[t] for t in b])
        size = h.sum(1, dtype=np.int64)
        n = size[ia] + size[ib]
        apart = np.concatenate([np.abs(h[ia[k : k + 5000]] - h[ib[k : k + 5000]]).sum(1, dtype=np.int64) for k in range(0, len(ia), 5000)])
        maybe = 100.0 * (n - apart) >= least * n
    else:
        maybe = np.ones(len(a), dtype=bool)
    for k in np.flatnonzero(maybe):
        out[k] = ratio(a[k], b[k])
    return out


#: Columns of the unary form of counts; longer texts are compared count by count.
_WIDE = 6000


def bounds(a: list[str], b: list[str]) -> np.ndarray:
    """Upper bounds of the ratios of all texts of ``a`` with all of ``b``, from their counts of characters."""
    ha, hb = _histograms(a).astype(np.int64), _histograms(b).astype(np.int64)
    n, m = ha.sum(1), hb.sum(1)
    most = np.minimum(ha.max(0), hb.max(0))
    if most.sum() <= _WIDE:
        # a count of k as k ones: the common part of two counts is a scalar product
        one = lambda h: np.concatenate([h[:, [c]] > np.arange(k) for c, k in enumerate(most)] or [np.zeros((len(h), 0))], axis=1).astype(np.float32)
        common = one(ha) @ one(hb).T
    else:
        common = np.array([np.minimum(x, hb).sum(1) for x in ha])
    total = n[:, None] + m[None, :]
    return np.where(total > 0, 200.0 * common / np.maximum(total, 1), 100.0)


def indel_ratio(a, b, least: float = 0.0):
    """Column of ratios; values certainly below ``least`` may come out as 0."""

    @F.pandas_udf(T.DoubleType())
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series(ratios(x, y, least))

    return run(a, b)


def register(spark: SparkSession) -> None:
    """SQL functions ``indel_ratio(a, b)``, ``normalize_title(s)`` and ``clean_doi(s)``."""
    @F.pandas_udf(T.DoubleType())
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series(ratios(x, y))

    spark.udf.register("indel_ratio", run)
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION normalize_title(s STRING) RETURNS STRING RETURN trim(regexp_replace(regexp_replace(lower(coalesce(s, '')), '[^a-z0-9 ]', ' '), ' +', ' '))")
    bare = "regexp_replace(s, '{}', '')".format(_EDGE.replace("\\", "\\\\"))
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION clean_doi(s STRING) RETURNS STRING RETURN CASE WHEN {bare} = '' THEN s ELSE regexp_replace({bare}, 'https?://(dx\\\\.)?doi\\\\.org/', '') END")
