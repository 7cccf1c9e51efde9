"""Integrity audit of the base tables: duplicate keys, orphans, missing values."""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import flag
from ..schemas import FOREIGN_KEYS, PRIMARY_KEYS, TABLE_SCHEMAS
from ..tables import Tables


def _total(value: Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0)).cast("long")


def _required(table: str) -> list[str]:
    return [f.name for f in TABLE_SCHEMAS[table].fields if not f.nullable]


@dataclass(frozen=True)
class Family:
    """A key: its table, the tables that refer to it, and the required columns checked along with it."""

    parent: str
    column: str
    children: tuple[tuple[str, str], ...]
    required: dict[str, tuple[str, ...]]

    def counts(self) -> list[str]:
        missing = [f"missing_{table}_{c}" for table, columns in self.required.items() for c in columns]
        return [*[f"rows_{table}" for table in self.required], *missing]

    def rules(self) -> dict[tuple[str, str], Column]:
        """Per table and rule the rows of one key that break it, from the counts of the key."""
        known = F.col(f"rows_{self.parent}") > 0
        rules = {(self.parent, f"unique {self.column}"): F.when(known, F.col(f"rows_{self.parent}") - 1)}
        for table, own in self.children:
            orphan = F.col("key").isNotNull() & ~known
            rules[table, f"{own} refers to a known row"] = F.when(orphan, F.col(f"rows_{table}"))
        for table, columns in self.required.items():
            rules |= {(table, f"{c} is required"): F.col(f"missing_{table}_{c}") for c in columns}
        return rules


def families() -> list[Family]:
    """One family per key; missing values of a table that is both parent and child are counted once."""
    found, counted = [], set()
    for parent, (column,) in PRIMARY_KEYS.items():
        children = tuple((child, own) for child, own, of, _ in FOREIGN_KEYS if of == parent)
        here = {parent, *[child for child, _ in children if child not in PRIMARY_KEYS]} - counted
        counted |= here
        members = [parent, *[child for child, _ in children]]
        found.append(Family(parent, column, children, {t: tuple(_required(t)) if t in here else () for t in members}))
    return found


def key_counts(frames: dict, family: Family) -> DataFrame:
    """Per key the rows of each table that hold it, and their missing values.

    The parent's and the children's rows are stacked and counted per key, combined before
    the shuffle, so a key that fills much of a table is a single row from there on.
    """
    stacked = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [
            frames[table].select(
                F.col(own).alias("key"),
                F.lit(1).cast("long").alias(f"rows_{table}"),
                *[flag(F.col(c).isNull()).alias(f"missing_{table}_{c}") for c in family.required[table]],
            )
            for table, own in ((family.parent, family.column), *family.children)
        ],
    )
    return stacked.groupBy("key").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in family.counts()])


def _audit_family(frames: dict, family: Family) -> DataFrame:
    rules = family.rules()
    totals = key_counts(frames, family).agg(*[_total(value).alias(f"r{i}") for i, value in enumerate(rules.values())])
    found = [
        F.struct(F.lit(table).alias("table"), F.lit(rule).alias("rule"), F.col(f"r{i}").alias("violations"))
        for i, (table, rule) in enumerate(rules)
    ]
    return totals.select(F.explode(F.array(*found)).alias("r")).select("r.*")


def integrity_audit(t: Tables) -> DataFrame:
    """One row per table and rule with the number of rows that break it, by one grouping per key.

    For a stored portfolio that grows, `plans.audit_upkeep` keeps the answer batch by batch.
    """
    frames = t.by_name()
    return reduce(DataFrame.unionByName, [_audit_family(frames, family) for family in families()])
