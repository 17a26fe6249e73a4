"""Text helpers: tokenizing, field lengths, URL filters, record stamping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlens.functions.time import to_col


def split_dropping_trailing(c, sep: str = " ") -> Column:
    """Split like a JVM ``String.split``: trailing empty tokens are dropped.

    Interior empty tokens are kept, ``""`` gives one empty token and a
    string made only of separators gives none. ``sep`` is a literal
    single character.
    """
    s = to_col(c)
    stripped = F.regexp_replace(s, "(" + _re_escape(sep) + ")+$", "")
    return (F.when(s == "", F.array(F.lit("")))
            .when(stripped == "", F.array().cast("array<string>"))
            .otherwise(F.split(stripped, _re_escape(sep), -1)))


def _re_escape(sep: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?()[]{}|\\" else ch for ch in sep)


def tokenize_words(df: DataFrame, text_col: str = "value", sep: str = " ",
                   with_position: bool = False) -> DataFrame:
    """One row per token: ``word`` (and ``pos``, 0-based), other columns kept."""
    keep = [c for c in df.columns if c != text_col]
    toks = split_dropping_trailing(F.col(text_col), sep)
    if with_position:
        return df.select(*keep, F.posexplode(toks).alias("pos", "word"))
    return df.select(*keep, F.explode(toks).alias("word"))


def field_lengths(df: DataFrame, col: str = "value", sep: str = ",") -> DataFrame:
    """One row per separated field, holding the field's length."""
    keep = [c for c in df.columns if c != col]
    lens = F.transform(split_dropping_trailing(F.col(col), sep), lambda x: F.length(x))
    return df.select(*keep, F.posexplode(lens).alias("pos", "len"))


# Static-asset suffixes dropped from page rankings.
STATIC_EXTS = ["css", "js", "png", "ico"]


def static_asset_pattern(exts=None) -> str:
    exts = exts or STATIC_EXTS
    return r"\.(" + "|".join(exts) + r")$"


def drop_static_assets(df: DataFrame, url_col: str = "url", exts=None) -> DataFrame:
    """Keep rows whose URL does not end with one of the given suffixes.

    A query string after the suffix (``a.css?x=1``) is not a suffix, so
    such a row is kept.
    """
    return df.where(~F.col(url_col).rlike(static_asset_pattern(exts)))


def stamp_records(df: DataFrame, value_col: str = "value", now_ms=None) -> DataFrame:
    """value ← ``<epoch ms>,<value>``; ``now_ms`` pins the clock for tests."""
    now = F.lit(now_ms).cast("bigint") if now_ms is not None else F.unix_millis(F.current_timestamp())
    return df.withColumn(value_col, F.concat_ws(",", now.cast("string"), F.col(value_col)))
