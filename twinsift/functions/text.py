"""Combined record text and tokenising, all as built-in Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinsift.config import COMBINED_COLUMN, COMBINED_SEPARATOR

# Fixed patterns: word split for prose (letters and digits of any script)
# and for short record codes (keeps '#', so 'Brand#2' stays one token).
WORD_PATTERN = r"[^\p{L}\p{N}]+"
CODE_PATTERN = r"[^a-z0-9#]+"
SHINGLE_WORDS = 3


def included_columns(df: DataFrame, exclude) -> list[str]:
    """Columns in source order minus ``exclude`` (list membership, not substring).

    Unknown names in ``exclude`` raise: a typo would otherwise silently leave
    a key inside the compared text.
    """
    exclude = list(exclude or [])
    unknown = [c for c in exclude if c not in df.columns]
    if unknown:
        raise ValueError(f"excluded columns not in table: {unknown}")
    drop = set(exclude)
    return [c for c in df.columns if c not in drop]


def _as_text(df: DataFrame, name: str) -> Column:
    dt = df.schema[name].dataType
    c = F.col("`" + name.replace("`", "``") + "`")
    if isinstance(dt, (T.MapType, T.StructType)):
        return F.to_json(c)
    if isinstance(dt, T.ArrayType) and not isinstance(dt.elementType, T.StringType):
        if isinstance(dt.elementType, (T.MapType, T.StructType, T.ArrayType)):
            return F.to_json(c)
        return c.cast("array<string>")
    return c


def combined_text(df: DataFrame, exclude, sep: str = COMBINED_SEPARATOR, null_marker: str | None = None) -> Column:
    """``concat_ws(sep, every column but exclude)``: NULLs are skipped, an
    all-NULL row gives ''. ``null_marker`` keeps field positions instead."""
    parts = [_as_text(df, c) for c in included_columns(df, exclude)]
    if null_marker is not None:
        def marked(p: Column, name: str) -> Column:
            if isinstance(df.schema[name].dataType, T.ArrayType):
                return F.coalesce(F.array_join(p, sep), F.lit(null_marker))
            return F.coalesce(p.cast("string"), F.lit(null_marker))
        parts = [marked(p, n) for p, n in zip(parts, included_columns(df, exclude))]
    if not parts:
        return F.lit("")
    return F.concat_ws(sep, *parts)


def with_combined_text(df: DataFrame, exclude, sep: str = COMBINED_SEPARATOR,
                       column: str = COMBINED_COLUMN, null_marker: str | None = None) -> DataFrame:
    """Silver layer: source columns plus the combined text column."""
    return df.withColumn(column, combined_text(df, exclude, sep, null_marker))


def word_tokens(text: Column, pattern: str = WORD_PATTERN) -> Column:
    """Lower-cased tokens, empty strings removed (array<string>, in order)."""
    return F.array_remove(F.split(F.lower(text), pattern), "")


def word_shingles(tokens: Column, n: int = SHINGLE_WORDS) -> Column:
    """Distinct n-word shingles (joined by one space); a text of fewer than n
    words is one shingle, no word gives [].

    Linear per text: ``zip_with`` over shifted slices. ``tokens`` should be a
    plain column reference (see ``with_features``), not a split expression,
    so the split runs once per row.
    """
    size = F.size(tokens)
    grams = tokens
    for j in range(1, n):
        grams = F.zip_with(grams, F.slice(tokens, j + 1, F.greatest(size - j, F.lit(1))),
                           lambda a, b: F.concat_ws(" ", a, b))
    return (F.when(size >= n, F.array_distinct(F.slice(grams, 1, size - (n - 1))))
            .when(size > 0, F.array(F.array_join(tokens, " "))).otherwise(F.array().cast("array<string>")))


def hashed(features: Column) -> Column:
    """Features as distinct 64-bit hashes (JVM xxhash64) for compact shuffles."""
    return F.array_distinct(F.transform(features, lambda s: F.xxhash64(s)))


def token_column(text: Column, mode: str) -> Column:
    if mode in ("shingles", "words"):
        return word_tokens(text, WORD_PATTERN)
    if mode == "tokens":
        return word_tokens(text, CODE_PATTERN)
    raise ValueError(f"unknown text mode {mode!r}")


def shingle_hashes(token_hashes: Column, n: int = SHINGLE_WORDS) -> Column:
    """Distinct 64-bit hashes of n-word shingles, built from per-token hashes
    (hash of the hashes of n consecutive tokens): the same set as hashing the
    joined shingle strings, at half the cost (no string is built). Fewer than
    ``n`` tokens are one feature: short records keep their exact copies."""
    size = F.size(token_hashes)
    grams = token_hashes
    for j in range(1, n):
        grams = F.zip_with(grams, F.slice(token_hashes, j + 1, F.greatest(size - j, F.lit(1))),
                           lambda a, b: F.xxhash64(a, b))
    out = F.when(size >= n, F.array_distinct(F.slice(grams, 1, size - (n - 1))))
    for m in range(1, n):
        whole = F.element_at(token_hashes, 1)
        for j in range(1, m):
            whole = F.xxhash64(whole, F.try_element_at(token_hashes, F.lit(j + 1)))
        out = out.when(size == m, F.array(whole))
    return out.otherwise(F.array().cast("array<bigint>"))


def _feature_from_tokens(tokens: Column, mode: str) -> Column:
    return hashed(F.array_distinct(tokens))


def with_features(df: DataFrame, text_col: str, mode: str = "shingles", out_col: str = "f",
                  keep=None) -> DataFrame:
    """Distinct hashed features of a text column: 3-word shingles
    (``shingles``), record code tokens (``tokens``) or words (``words``).

    Two projections: the token array is materialised once per row, the
    shingles then read it (a lambda over the split expression would redo
    the split for every shingle).
    """
    keep = [c for c in (keep or []) if c != text_col]
    toks = df.select(*keep, token_column(F.col(text_col), mode).alias("_toks"))
    if mode == "shingles":
        # token hashes are their own projection: the shingle step reads them
        # four times and must not recompute them
        th = toks.select(*keep, F.transform("_toks", lambda t: F.xxhash64(t)).alias("_th"))
        return th.select(*keep, shingle_hashes(F.col("_th")).alias(out_col))
    return toks.select(*keep, _feature_from_tokens(F.col("_toks"), mode).alias(out_col))
