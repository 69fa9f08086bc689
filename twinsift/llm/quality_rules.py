"""Host-level quality rules.

Each document gets four rule counts and three rule verdicts; failures of each
rule are aggregated by host, every host's failure rate is shrunk towards the
mean of all hosts with an empirical beta prior (one a rule), and the host
verdict joins back.

* words are runs of ``[^\\x20\\x09-\\x0D]``; a null text has none;
* ``base_failed``: fewer than ``MIN_WORDS`` words, or over
  ``MAX_REPEATED``% of the words inside 8-word windows seen at least twice;
* ``symbols_failed``: over ``MAX_SYMBOLS``% of the word characters are
  symbols; ``lines_failed``: more than one repeated line for ``LINE_WORDS``
  words. They say nothing about one document but count for its host;
* the beta prior of a rule is fitted by moments to the hosts' rates: mean ``m`` and
  strength ``s = m(1-m)/var - 1`` where ``var`` is the variance between hosts
  beyond binomial noise (none: the strength is that of all rows, so every
  host gets the mean);
* host rate ``(fails + m*s) / (docs + s)``; a host is rejected when the rate
  of any rule is at least ``max_host_rate`` (0.5).

Defined cases: a null host is a host of its own; an empty table gives no
rows; repeated rows count each time; null texts fail (no words); extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinsift.llm import common

MIN_WORDS = 20
MAX_REPEATED = 30
MAX_SYMBOLS = 10
LINE_WORDS = 20
WINDOW = 8
#: rule column -> column of the host's shrunk rate
RULES = {"base_failed": "host_rate", "symbols_failed": "symbol_rate", "lines_failed": "line_rate"}
SYMBOLS = "#*$%&|<>"


def repeated_words(tokens: list[bytes], window: int = WINDOW) -> int:
    """Words covered by windows of ``window`` words found twice or more."""
    n = len(tokens) - window + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    a = np.fromiter((ids.setdefault(w, len(ids)) for w in tokens), np.uint64, len(tokens))
    # The rank of every window is refined by doubling: windows of 2, 4, 8
    # words get equal ids exactly if they are equal, without hashing.
    size = 1
    while size < window:
        step = min(size, window - size)
        pair = a[: len(a) - step] * np.uint64(len(tokens) + 1) + a[step:]
        a = np.unique(pair, return_inverse=True)[1].astype(np.uint64)
        size += step
    again = np.bincount(a.astype(np.int64))[a.astype(np.int64)] > 1
    if not again.any():
        return 0
    edge = np.zeros(len(tokens) + 1, np.int64)
    at = np.flatnonzero(again)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(common.SPACES)]
    return len(lines) - len(set(lines))


def rule_counts(text: str | None) -> tuple[int, int, int, int, int]:
    text = text or ""
    tokens = common.words(text)
    return (len(tokens), len(text) - sum(map(text.count, common.SPACES)), sum(map(text.count, SYMBOLS)),
            duplicate_lines(text), repeated_words(tokens))


def document_rules(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """One row a document: id, host and the rule columns. No shuffle."""
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    thin = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).cast("string").alias("host"),
                       F.col(text_col).cast("string").alias("text"))
    id_type = thin.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [rule_counts(t) for t in batch.column(2).to_pylist()]
        cols = list(zip(*rows, strict=True)) if rows else [()] * 5
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).cast(pa.string())]
                                          + [pa.array(c, pa.int64()) for c in cols], names=["doc_id", "host", *names])

    out = common.map_batches(thin, run, f"doc_id {id_type}, host string, " + ", ".join(f"{n} long" for n in names))
    return out.withColumns({
        "base_failed": (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED),
        "symbols_failed": F.col("n_symbols") * 100 > F.col("word_chars") * MAX_SYMBOLS,
        "lines_failed": F.col("n_dup_lines") * LINE_WORDS > F.col("n_words")})


def prior(n: float, n2: float, k: float, fails: float, squares: float) -> tuple[float, float]:
    """(mean, strength) of the beta prior of a rule by moments of the hosts:
    documents, sum of squared documents, hosts, failures, and sum of
    failures^2 / documents."""
    m = fails / max(1.0, n)
    between = squares - n * m * m  # sum of docs * (rate - mean)^2
    denom = n - n2 / max(n, 1.0)
    var = (between - (k - 1) * m * (1 - m)) / denom if denom > 0 else 0.0
    return m, min(max(m * (1 - m) / var - 1, 1.0), max(n, 1.0)) if var > 1e-12 else max(n, 1.0)


def host_verdicts(rules: DataFrame, max_host_rate: float = 0.5) -> DataFrame:
    """One row a host: docs, fails (of the base rule), the shrunk rate of each
    rule, host_ok."""
    hosts = rules.groupBy("host").agg(F.count(F.lit(1)).alias("docs"),
                                      *[F.sum(F.col(r).cast("long")).alias(r) for r in RULES])
    # Moments of the hosts, weighted by their documents: one row.
    s = hosts.agg(F.sum("docs").alias("n"), F.count(F.lit(1)).alias("k"),
                  F.sum(F.col("docs") * F.col("docs").cast("double")).alias("n2"),
                  *[F.sum(r).alias(r) for r in RULES],
                  *[F.sum(F.col(r) * F.col(r) / F.col("docs")).alias(f"{r}_2") for r in RULES]).first()
    rates = {}
    for r, name in RULES.items():
        m, strength = prior(*(float(s[c] or 0) for c in ("n", "n2", "k", r, f"{r}_2")))
        rates[name] = (F.col(r) + F.lit(m * strength)) / (F.col("docs") + F.lit(strength))
    return (hosts.withColumns(rates).withColumn("host_ok", F.greatest(*rates) < max_host_rate)
            .select("host", "docs", F.col("base_failed").alias("fails"), *rates, "host_ok"))


def host_level_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                     max_host_rate: float = 0.5) -> DataFrame:
    """Rule counts, base verdict, host verdict and ``kept`` a document.

    The thin rule rows are stored once (both the host aggregate and the
    result read them); the host table joins back with hot hosts salted.
    """
    rules = common.stored(document_rules(docs, id_col, text_col, host_col), "rules")
    hosts = common.stored(host_verdicts(rules, max_host_rate), "hosts")
    hot = common.heavy_keys(hosts, "host", "docs")
    out = common.salted_join(rules, hosts.select("host", *RULES.values(), "host_ok"), "host", hot, "doc_id")
    return out.withColumn("kept", ~F.col("base_failed") & F.col("host_ok"))
