"""The integrity audit of a stored portfolio, kept batch by batch.

Per key family (see `operators.audit`) the counts of each key are stored in buckets of the key,
and each bucket's violations stand in the version file. A batch is counted per key, and the
buckets its keys lie in are added up and judged anew: a key's rows may become orphans or
find their parent in a later batch. Base tables of earlier batches are never read again, and the
audit itself reads one small file.
"""

import posixpath
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.audit import Family, families, key_counts
from ..session import Scratch
from ..sources.versions import Versions
from ..tables import Tables
from .upkeep import follow

BUCKETS = 16
RESULT = "table string, rule string, violations long"


def _folder(folder: str, family: Family) -> str:
    return posixpath.join(folder, f"keys_{family.parent}")


def _stored(spark: SparkSession, folder: str, family: Family, parts: dict[str, str]) -> DataFrame:
    """Stored counts of the given buckets (bucket -> name of the run that wrote it)."""
    columns = {"key": "string", **dict.fromkeys(family.counts(), "long"), "bucket": "int"}
    schema = ", ".join(f"{c} {k}" for c, k in columns.items())
    if not parts:
        return spark.createDataFrame([], schema)
    root = _folder(folder, family)
    paths = [posixpath.join(root, f"run={run}", f"bucket={bucket}") for bucket, run in parts.items()]
    return spark.read.schema(schema).option("basePath", root).parquet(*paths).select(*columns)


def apply_audit_batch(
    spark: SparkSession, folder: str, batch: Tables, batch_id: str, buckets: int = BUCKETS, content: dict | None = None
) -> bool:
    """Add a batch to the counts; False if they have it already. `buckets` is fixed by the first batch."""
    versions = Versions(spark, folder)
    number, current = versions.latest()
    content = current if content is None else content
    if batch_id in content.get("batches", []):
        return False
    buckets = content.get("buckets", buckets)
    run, frames = uuid.uuid4().hex, batch.by_name()
    kept = content.get("families", {})
    grown = {}
    for family in families():
        before = kept.get(family.parent, {"runs": {}, "violations": {}})
        violations = _judged_anew(spark, folder, family, frames, before["runs"], buckets, run)
        grown[family.parent] = {
            "runs": {**before["runs"], **dict.fromkeys(violations, run)},
            "violations": {**before["violations"], **violations},
        }
    done = [*content.get("batches", []), batch_id]
    versions.commit(number + 1, {**content, "batches": done, "buckets": buckets, "families": grown})
    return True


def _judged_anew(
    spark: SparkSession, folder: str, family: Family, frames: dict, runs: dict[str, str], buckets: int, run: str
) -> dict[str, list[int]]:
    """Write the buckets a batch touches and return their violations, in the order of the rules."""
    counts, rules = family.counts(), family.rules().values()
    key = F.col("key").cast("string")
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    with Scratch(spark) as scratch:
        delta = scratch.store(key_counts(frames, family).select(key.alias("key"), *counts, bucket.alias("bucket")))
        touched = {str(r.bucket) for r in delta.select("bucket").distinct().collect()}
        if not touched:
            return {}
        old = _stored(spark, folder, family, {b: r for b, r in runs.items() if b in touched})
        added = old.unionByName(delta).groupBy("bucket", "key").agg(*[F.sum(c).alias(c) for c in counts])
        path = posixpath.join(_folder(folder, family), f"run={run}")
        added.repartition("bucket").write.partitionBy("bucket").parquet(path)
    judged = _stored(spark, folder, family, dict.fromkeys(touched, run)).groupBy("bucket").agg(
        *[F.coalesce(F.sum(rule), F.lit(0)).cast("long").alias(f"r{i}") for i, rule in enumerate(rules)]
    )
    return {str(row[0]): list(row[1:]) for row in judged.collect()}


def maintain_audit(spark: SparkSession, portfolio: str, folder: str, buckets: int = BUCKETS) -> list[str]:
    """Bring the counts up to date with a stored portfolio; returns the batches applied."""
    return follow(
        spark, portfolio, folder, lambda batch, name, content: apply_audit_batch(spark, folder, batch, name, buckets, content)
    )


def maintained_audit(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of `integrity_audit` for all batches applied so far."""
    _, content = Versions(spark, folder).latest()
    rows = []
    for family in families():
        held = content.get("families", {}).get(family.parent, {"violations": {}})["violations"]
        for i, (table, rule) in enumerate(family.rules()):
            rows.append((table, rule, sum(found[i] for found in held.values())))
    return spark.createDataFrame(rows, RESULT)
