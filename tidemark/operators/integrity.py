"""Keys, references and value rules of the raw tables, as check rows.

Parquet enforces no constraints, so a load is checked afterwards. Every check counts the rows that
break its rule; more than none is an alert.

Value rules are one aggregation per table without a shuffle of its rows. A key and all references
to it are one grouping: the parent's rows and the references of its children are stacked, each
counted for its own table, so a single shuffle of counted keys tells repeated keys and references
to missing ones apart, without a join and without anything written. Grouping combines on the map
side, so a reference that fills a large part of a table arrives as one row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import ALERT, OK, thousands


@dataclass(frozen=True)
class Table:
    """A table with its key, the tables its columns refer to, and what must hold in every row.

    As in SQL, a rule passes when it is null; write not-null rules with `isNotNull()`. `sums` names
    checks that a column of each key's row is a total over the rows that refer to it: the column,
    the other table, and what is added up there.
    """

    name: str
    frame: DataFrame
    keys: Sequence[str]
    references: Mapping[str, str] = field(default_factory=dict)
    rules: Mapping[str, Column] = field(default_factory=dict)
    sums: Mapping[str, tuple[Column, str, Column]] = field(default_factory=dict)


def not_null(frame: DataFrame, columns: Sequence[str]) -> dict[str, Column]:
    return {f"not_null_{column}": frame[column].isNotNull() for column in columns}


def _check_rows(counted: DataFrame, found: Sequence[tuple[str, str, str]]) -> DataFrame:
    """One row of counts `n0, n1, ...` as check rows (table, metric, what is wrong)."""
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("name"),
                F.lit(metric).alias("metric"),
                F.coalesce(F.col(f"n{i}"), F.lit(0)).cast("bigint").alias("n"),
                F.lit(what).alias("what"),
            )
            for i, (name, metric, what) in enumerate(found)
        ]
    )
    return counted.select(F.inline(rows)).select(
        "name",
        "metric",
        F.col("n").cast("double").alias("value"),
        F.when(F.col("n") > 0, ALERT).otherwise(OK).alias("status"),
        F.concat(thousands(F.col("n")), F.lit(" "), F.col("what")).alias("message"),
    )


def rule_checks(table: Table) -> DataFrame:
    """Rows that break each rule, in one pass over the rules' columns."""
    counts = [F.count_if(~rule).alias(f"n{i}") for i, rule in enumerate(table.rules.values())]
    found = [(table.name, metric, "rows break the rule") for metric in table.rules]
    return _check_rows(table.frame.agg(*counts), found)


def key_checks(table: Table, tables: Sequence[Table]) -> DataFrame:
    """Repeated keys of a table, references to keys it lacks, and totals that differ.

    Null references pass.
    """
    children = [
        (child, column)
        for child in tables
        for column, parent in child.references.items()
        if parent == table.name
    ]
    if children and len(table.keys) != 1:
        raise ValueError(f"references to {table.name} need a key of one column")
    keys = [f"k{i}" for i in range(len(table.keys))]
    parts = [
        table.frame.select(
            *[F.col(key).alias(name) for key, name in zip(table.keys, keys, strict=True)],
            F.lit(1).alias("own"),
            *[value.alias(f"is_{name}") for name, (value, _, _) in table.sums.items()],
        )
    ]
    found = [(table.name, "primary_key", f"rows repeat a key ({', '.join(table.keys)})")]
    counts = [F.sum(F.greatest(F.col("own") - 1, F.lit(0))).alias("n0")]
    grouped = [F.coalesce(F.sum("own"), F.lit(0)).alias("own")]
    for i, (child, column) in enumerate(children):
        sums = [
            value.alias(f"of_{name}")
            for name, (_, other, value) in table.sums.items()
            if other == child.name
        ]
        rows = child.frame.where(F.col(column).isNotNull())
        parts.append(rows.select(F.col(column).alias("k0"), F.lit(1).alias(f"c{i}"), *sums))
        grouped.append(F.sum(f"c{i}").alias(f"c{i}"))
        found.append((child.name, f"foreign_key_{column}", f"rows refer to a missing {column}"))
        counts.append(F.sum(F.when(F.col("own") == 0, F.col(f"c{i}"))).alias(f"n{len(counts)}"))
    for name, (_, other, _) in table.sums.items():
        grouped += [F.max(f"is_{name}").alias(f"is_{name}"), F.sum(f"of_{name}").alias(f"of_{name}")]
        differs = F.col(f"is_{name}").isNotNull() & ~F.col(f"is_{name}").eqNullSafe(F.col(f"of_{name}"))
        counts.append(F.count_if(differs).alias(f"n{len(counts)}"))
        found.append((table.name, name, f"{table.name} differ from the sum of their {other}"))
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return _check_rows(stacked.groupBy(*keys).agg(*grouped).agg(*counts), found)


def integrity_checks(tables: Sequence[Table]) -> DataFrame:
    """Every key, reference, rule and total of the tables."""
    checks = [key_checks(table, tables) for table in tables]
    checks += [rule_checks(table) for table in tables if table.rules]
    return reduce(DataFrame.unionByName, checks)


def commerce_checks(commerce) -> DataFrame:
    """Every key, reference, not-null and value rule of the raw tables that are present."""
    users, orders, views = commerce.users, commerce.orders, commerce.product_views
    products, items = commerce.products, commerce.order_items
    to_product = {} if products is None else {"product_id": "products"}
    totals = {}
    if items is not None:
        lines = F.col("unit_price") * F.col("quantity")
        totals = {"item_totals": (F.col("total_amount"), "order_items", lines)}
    tables = [
        Table("users", users, ["user_id"], rules=not_null(users, ["user_id", "signup_ts"])),
        Table(
            "orders",
            orders,
            ["order_id"],
            {"user_id": "users"},
            not_null(orders, orders.columns),
            totals,
        ),
        Table(
            "product_views",
            views,
            ["view_id"],
            {"user_id": "users", **to_product},
            not_null(views, views.columns),
        ),
    ]
    if products is not None:
        rules = not_null(products, products.columns)
        tables.append(Table("products", products, ["product_id"], rules=rules))
    if items is not None:
        rules = not_null(items, items.columns) | {"check_quantity": F.col("quantity") > 0}
        references = {"order_id": "orders", **to_product}
        tables.append(Table("order_items", items, ["order_id", "product_id"], references, rules))
    return integrity_checks(tables)
