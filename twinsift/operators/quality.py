"""Data-quality rules (S4-S6): declared NOT NULL, PRIMARY KEY and FOREIGN KEY
constraints re-aimed as checks that return their violations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_null_check(df: DataFrame, columns) -> DataFrame:
    """(column_name, null_count) for each column, from one aggregate."""
    columns = list(columns)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(columns)])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("null_count"))
                      for i, c in enumerate(columns)])
    return counts.select(F.inline(pairs))


def unique_key_check(df: DataFrame, keys) -> DataFrame:
    """Key values occurring more than once, with their count (partial
    aggregation first, so a hot key costs one row per partition)."""
    keys = list(keys)
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences"))
            .where(F.col("occurrences") > 1))


def foreign_key_check(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent row (NULL passes).

    The distinct values (a partial aggregate) meet the parents; only values
    without a parent join back to the child rows, so a foreign key that is
    mostly one value never shuffles its rows to one task for the check."""
    keys = parent.select(F.col(pk).alias("_pk")).where(F.col("_pk").isNotNull())
    values = child.where(F.col(fk).isNotNull()).select(F.col(fk).alias("_fk")).distinct()
    orphans = values.join(keys, F.col("_fk") == F.col("_pk"), "left_anti")
    return child.join(orphans, F.col(fk) == F.col("_fk"), "left_semi")


def table_rules(df: DataFrame, not_null=(), primary_key: str | None = None, foreign_keys=()) -> DataFrame:
    """(rule, columns, violations) of all declared rules of a table from one
    scan: NULLs in a column, key values that occur more than once, rows whose
    foreign key has no parent. ``foreign_keys`` holds (column, parent, key).

    A row gives one entry for each rule it matters to, (rule, value); they are
    counted by value (a partial aggregate: a hot value is one row a partition),
    and the counts meet the parents' keys."""
    rules = [("not_null", c) for c in not_null] + [("primary_key", primary_key)] * bool(primary_key) + [("foreign_key", c) for c, _, _ in foreign_keys]
    if not rules:
        return df.sparkSession.createDataFrame([], "rule string, columns string, violations long")
    entries = []
    for i, (rule, column) in enumerate(rules):
        value = F.col(column).cast("string")
        entry = F.struct(F.lit(i).alias("i"), (F.lit(None).cast("string") if rule == "not_null" else value).alias("value"))
        # NULL keys count as a value, NULL foreign keys pass.
        matters = {"not_null": F.col(column).isNull(), "primary_key": F.lit(True), "foreign_key": F.col(column).isNotNull()}[rule]
        entries.append(F.when(matters, entry))
    counts = df.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).groupBy("e.i", "e.value").agg(F.count(F.lit(1)).alias("n"))
    kind = F.element_at(F.array(*[F.lit(r) for r, _ in rules]), F.col("i") + 1)
    parents = None
    first = len(rules) - len(foreign_keys)
    for j, (_, parent, key) in enumerate(foreign_keys):
        keys = parent.where(F.col(key).isNotNull()).select(F.lit(first + j).alias("i"), F.col(key).cast("string").alias("value")).distinct()
        keys = keys.withColumn("known", F.lit(True))
        parents = keys if parents is None else parents.unionByName(keys)
    counts = counts.join(parents, ["i", "value"], "left") if parents is not None else counts.withColumn("known", F.lit(None).cast("boolean"))
    found = F.when(kind == "primary_key", (F.col("n") > 1).cast("long")).when(kind == "foreign_key", F.when(F.col("known").isNull(), F.col("n")).otherwise(0)).otherwise(F.col("n"))
    sums = counts.groupBy("i").agg(F.sum(found).alias("v"))
    # A rule without an entry has no violation.
    every = df.sparkSession.createDataFrame([(i, r, c) for i, (r, c) in enumerate(rules)], "i int, rule string, columns string")
    return every.join(sums, "i", "left").select("rule", "columns", F.coalesce("v", F.lit(0)).cast("long").alias("violations"))
