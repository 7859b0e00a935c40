"""Quality gate (Q1-Q6).

Every rule is an aggregate that yields one row ``(rule, table, column,
violations)``; all rules are unioned into one report frame, so the whole gate
is one Spark job.  The report has one row per rule (a fixed, small number),
so collecting it to decide pass/fail is safe.

* Q1/Q2 null checks, Q3 "some revenue > 0" (the original's three rules);
* Q4 primary keys unique and non-null; Q5 foreign-key orphans (the declared
  keys the warehouse never enforced);
* Q6 a column profile: rows and nulls per column, in one pass per table.

Orphan checks first group the child by its key (map-side combine), then
anti-join the distinct keys: a hot key costs one row, not a third of the
table in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.values import values_frame
from ..schemas import TABLES, foreign_keys


def _row(df: DataFrame, rule: str, table: str, column: str, violations: F.Column) -> DataFrame:
    return df.agg(violations.cast("long").alias("violations")).select(
        F.lit(rule).alias("rule"), F.lit(table).alias("table"), F.lit(column).alias("column"), "violations"
    )


def null_rule(df: DataFrame, table: str, column: str) -> DataFrame:
    """Rows where ``column`` is null (Q1, Q2)."""
    return _row(df, "not_null", table, column, F.count_if(F.col(column).isNull()))


def some_positive_rule(df: DataFrame, table: str, column: str) -> DataFrame:
    """Violated (1) when no row has ``column`` > 0 (Q3)."""
    return _row(df, "some_positive", table, column, F.when(F.count_if(F.col(column) > 0) == 0, 1).otherwise(0))


def pk_rules(df: DataFrame, table: str, key: list[str]) -> DataFrame:
    """Null keys and duplicated key values, from one grouping (Q4).

    Rows with a null key form groups too; their sizes add up to the null
    count, so both rules cost one shuffle.
    """
    label = ",".join(key)
    any_null = F.lit(False)
    for k in key:
        any_null = any_null | F.col(k).isNull()
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    both = per_key.agg(
        F.coalesce(F.sum(F.when(any_null, F.col("n"))), F.lit(0)).cast("long").alias("nulls"),
        F.count_if(~any_null & (F.col("n") > 1)).cast("long").alias("dups"),
    )
    return both.select(
        F.lit(table).alias("table"),
        F.lit(label).alias("column"),
        F.expr("stack(2, 'pk_not_null', nulls, 'pk_unique', dups) AS (rule, violations)"),
    ).select("rule", "table", "column", "violations")


def orphan_rule(child: DataFrame, table: str, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-null ``column`` has no parent row (Q5)."""
    return orphan_rules([(child, table, column)], parent, parent_column)


def orphan_rules(children, parent: DataFrame, parent_column: str) -> DataFrame:
    """Orphan counts of several child tables against one parent, in one pass.

    The children's key columns are unioned and counted per (table, key) with
    map-side combine, the distinct parent keys are anti-joined once, and a
    zero row per child keeps rules without orphans in the report.
    """
    spark = parent.sparkSession
    key_type = parent.schema[parent_column].dataType
    keys = None
    for child, table, column in children:
        part = child.filter(F.col(column).isNotNull()).select(
            F.lit(table).alias("table"), F.lit(column).alias("column"), F.col(column).cast(key_type).alias("__nm_k")
        )
        keys = part if keys is None else keys.unionByName(part)
    per_key = keys.groupBy("table", "column", "__nm_k").agg(F.count(F.lit(1)).alias("n"))
    parent_keys = parent.select(F.col(parent_column).cast(key_type).alias("__nm_k")).distinct()
    orphans = per_key.join(parent_keys, "__nm_k", "left_anti").groupBy("table", "column").agg(F.sum("n").alias("violations"))
    zeros = values_frame(spark, [(t, c, 0) for _, t, c in children], ["table", "column", "violations"])
    totals = orphans.unionByName(zeros).groupBy("table", "column").agg(F.sum("violations").cast("long").alias("violations"))
    return totals.select(F.lit("fk_orphans").alias("rule"), "table", "column", "violations")


def _labels(spark, labels) -> DataFrame:
    """``(tag, table, column)`` for the small integer tags used while grouping."""
    return values_frame(spark, [(i, t, c) for i, (t, c) in enumerate(labels)], ["tag", "table", "column"])


def pk_rules_many(items, spark) -> DataFrame:
    """``pk_rules`` for many single-column keys, one shuffle per key type.

    Keys of the same type from all tables are unioned, tagged with a small
    integer standing for their table, and grouped once (map-side combine);
    per table we get null keys and duplicated keys.  Names are attached to
    the per-table result only, so the grouped rows stay narrow.
    """
    by_type: dict[str, list] = {}
    for df, table, column in items:
        by_type.setdefault(df.schema[column].dataType.simpleString(), []).append((df, table, column))
    out = None
    for group in by_type.values():
        keys = None
        for tag, (df, _, column) in enumerate(group):
            part = df.select(F.lit(tag).alias("tag"), F.col(column).alias("__nm_k"))
            keys = part if keys is None else keys.unionByName(part)
        per_key = keys.groupBy("tag", "__nm_k").agg(F.count(F.lit(1)).alias("n"))
        stats = per_key.groupBy("tag").agg(
            F.sum(F.when(F.col("__nm_k").isNull(), F.col("n"))).alias("nulls"),
            F.count_if(F.col("__nm_k").isNotNull() & (F.col("n") > 1)).alias("dups"),
        )
        labels = _labels(spark, [(t, c) for _, t, c in group])
        rows = labels.join(stats, "tag", "left").select(
            "table",
            "column",
            F.coalesce(F.col("nulls"), F.lit(0)).cast("long").alias("nulls"),
            F.coalesce(F.col("dups"), F.lit(0)).cast("long").alias("dups"),
        )
        rows = rows.select("table", "column", F.expr("stack(2, 'pk_not_null', nulls, 'pk_unique', dups) AS (rule, violations)"))
        out = rows if out is None else out.unionByName(rows)
    return out.select("rule", "table", "column", F.col("violations").cast("long"))


def orphan_rules_many(links, spark) -> DataFrame:
    """Orphan counts for many (child, parent) links, one pass per key type.

    ``links`` holds ``(child_df, table, column, parent_df, parent_name,
    parent_column)``.  Child keys are tagged with a small integer per link
    and a small integer per parent, counted per (link, key) with map-side
    combine, and anti-joined once against the distinct keys of all parents.
    """
    by_type: dict[str, list] = {}
    for link in links:
        parent_df, parent_column = link[3], link[5]
        by_type.setdefault(parent_df.schema[parent_column].dataType.simpleString(), []).append(link)
    out = None
    for group in by_type.values():
        children = parents = None
        parent_tags: dict[str, int] = {}
        for tag, (child, _, column, parent, parent_name, parent_column) in enumerate(group):
            key_type = parent.schema[parent_column].dataType
            if parent_name not in parent_tags:
                parent_tags[parent_name] = len(parent_tags)
                pk = parent.select(F.lit(parent_tags[parent_name]).alias("ptag"), F.col(parent_column).alias("__nm_k"))
                parents = pk if parents is None else parents.unionByName(pk)
            part = child.filter(F.col(column).isNotNull()).select(
                F.lit(tag).alias("tag"), F.lit(parent_tags[parent_name]).alias("ptag"), F.col(column).cast(key_type).alias("__nm_k")
            )
            children = part if children is None else children.unionByName(part)
        per_key = children.groupBy("tag", "ptag", "__nm_k").agg(F.count(F.lit(1)).alias("n"))
        orphans = per_key.join(parents.distinct(), ["ptag", "__nm_k"], "left_anti")
        counts = orphans.groupBy("tag").agg(F.sum("n").alias("violations"))
        labels = _labels(spark, [(l[1], l[2]) for l in group])
        rows = labels.join(counts, "tag", "left").select(
            F.lit("fk_orphans").alias("rule"), "table", "column", F.coalesce(F.col("violations"), F.lit(0)).cast("long").alias("violations")
        )
        out = rows if out is None else out.unionByName(rows)
    return out


def length_rule(df: DataFrame, table: str) -> DataFrame:
    """Rows with a value longer (in bytes) than its declared varchar/char
    limit (K4): the warehouse would reject them."""
    from ..sinks.warehouse import length_violations

    return _row(df, "max_length", table, "*", F.count_if(length_violations(df, TABLES[table])))


def gate(tables: Mapping[str, DataFrame], keys: bool = True, lengths: bool = False) -> DataFrame:
    """All rules over the warehouse frames present in ``tables``.

    ``lengths`` adds one declared-length rule per table (K4).
    """
    spark = next(iter(tables.values())).sparkSession
    parts: list[DataFrame] = []
    if "dim_movies" in tables:
        parts.append(null_rule(tables["dim_movies"], "dim_movies", "id"))
    if "dim_languages" in tables:
        parts.append(null_rule(tables["dim_languages"], "dim_languages", "name"))
    if "fact_movie_sales" in tables:
        parts.append(some_positive_rule(tables["fact_movie_sales"], "fact_movie_sales", "revenue"))
    if keys:
        singles = [(df, n, TABLES[n].primary_key[0]) for n, df in tables.items() if n in TABLES and len(TABLES[n].primary_key) == 1]
        if singles:
            parts.append(pk_rules_many(singles, spark))
        for n, df in tables.items():
            if n in TABLES and len(TABLES[n].primary_key) > 1:
                parts.append(pk_rules(df, n, list(TABLES[n].primary_key)))
        links = [
            (tables[n], n, fk.column, tables[fk.parent], fk.parent, fk.parent_column)
            for n, fk in foreign_keys()
            if n in tables and fk.parent in tables
        ]
        if links:
            parts.append(orphan_rules_many(links, spark))
    if lengths:
        for name, df in tables.items():
            if name in TABLES and any(c.max_len for c in TABLES[name].columns):
                parts.append(length_rule(df, name))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


class QualityError(ValueError):
    pass


#: Rules that tell what a load left out; they fail only if asked to.
TOLD_ONLY = ("parse_loss", "rejected_rows")


def enforce(report: DataFrame, told_only: Sequence[str] = TOLD_ONLY) -> list[tuple]:
    """Collect the (small) report; raise if any rule but ``told_only`` has violations."""
    rows = [tuple(r) for r in report.collect()]
    failed = [r for r in rows if r[3] and r[0] not in told_only]
    if failed:
        raise QualityError("quality rules failed: " + "; ".join(f"{r[0]} {r[1]}.{r[2]}={r[3]}" for r in failed))
    return rows


def profile(df: DataFrame, table: str) -> DataFrame:
    """Schema, rows and nulls per column in one pass (Q6):
    ``(table, column, type, rows, nulls)``."""
    aggs = [F.count(F.lit(1)).alias("__nm_rows")] + [F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)]
    wide = df.agg(*aggs)
    triples = ", ".join(f"'{f.name}', '{f.dataType.simpleString()}', n{i}" for i, f in enumerate(df.schema.fields))
    return wide.selectExpr(
        f"'{table}' AS table", "__nm_rows AS rows", f"stack({len(df.columns)}, {triples}) AS (column, type, nulls)"
    ).select("table", "column", "type", "rows", "nulls")
