"""CSV and Parquet sources and sinks for the portfolio tables.

A stored portfolio and a stored scores table are folders of generations. A reload writes a
new generation next to the current one and then switches a small pointer file, so what is
stored stays whole if the reload fails, and a reload may read the folder it replaces.

An append adds a batch: one folder with its rows of every table, named by the next version of
the generation (see `versions`). A batch is seen in all tables or in none, and one id counts once.
Reloads and compactions need the folder to themselves; appends may run side by side.
"""

import posixpath
import uuid
from contextlib import suppress
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..schemas import MACRO_MONTHLY, TABLE_SCHEMAS
from ..session import dropping_shuffles
from ..tables import Tables
from . import dims
from .versions import Conflict, Versions, children, delete, file_system


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Typed CSV with a header. A cell that does not fit its type fails the read."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .csv(path)
    )


def read_portfolio(spark: SparkSession, folder: str, suffix: str = ".csv", macro: bool = False) -> Tables:
    """The seven loaded tables, one CSV file or folder each."""
    frames = {
        name: read_csv(spark, posixpath.join(folder, name + suffix), schema)
        for name, schema in TABLE_SCHEMAS.items()
    }
    macro_frame = (
        read_csv(spark, posixpath.join(folder, "dim_macro_monthly" + suffix), MACRO_MONTHLY)
        if macro
        else dims.macro_monthly(spark)
    )
    return _tables(frames, macro_frame)


MACRO = "dim_macro_monthly"


def read_parquet_portfolio(spark: SparkSession, folder: str) -> Tables:
    """The portfolio that `reload_portfolio` stored with the batches since, or plain table folders."""
    at = _current(spark, folder)
    _, content = Versions(spark, at).latest()
    return _stored_tables(spark, [at, *[posixpath.join(at, b["folder"]) for b in content.get("batches", [])]])


def _stored_tables(spark: SparkSession, folders: list[str]) -> Tables:
    held = [(folder, set(children(spark, folder))) for folder in folders]

    def read(name: str, schema: T.StructType) -> DataFrame | None:
        paths = [posixpath.join(folder, name) for folder, names in held if name in names]
        return spark.read.schema(schema).parquet(*paths) if paths else None

    frames = {}
    for name, schema in TABLE_SCHEMAS.items():
        frame = read(name, schema)
        if frame is None:
            raise FileNotFoundError(f"no {name} in {folders[0]}")
        frames[name] = frame
    macro = read(MACRO, MACRO_MONTHLY)
    return _tables(frames, dims.macro_monthly(spark) if macro is None else macro)


@dataclass(frozen=True)
class StoredBatches:
    """What a stored portfolio is made of: its first load, batches that a compaction has merged
    into the stored tables, and later batches (id -> folder) in order."""

    origin: str
    base: str
    merged: tuple[str, ...]
    later: dict[str, str]


def stored_batches(spark: SparkSession, folder: str) -> StoredBatches:
    at = _current(spark, folder)
    _, content = Versions(spark, at).latest()
    later = {b["id"]: posixpath.join(at, b["folder"]) for b in content.get("batches", [])}
    origin = content.get("origin", posixpath.basename(at.rstrip("/")))
    return StoredBatches(origin, at, tuple(content.get("merged", ())), later)


def read_batch(spark: SparkSession, path: str) -> Tables:
    """The rows of one batch, or of the stored tables without later batches."""
    return _stored_tables(spark, [path])


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def reload_portfolio(tables: Tables, folder: str) -> None:
    """Full reload: every table is replaced at once, when all of them are written.

    The generation before is kept until the next reload, for readers that still use it.
    """
    spark = tables.loans.sparkSession
    with _new_generation(spark, folder) as at:
        _store(tables, at)


def _store(tables: Tables, folder: str) -> None:
    """Every table as a folder; what one was computed from leaves no shuffle files beside the next."""
    for name, frame in tables.by_name().items():
        with dropping_shuffles(frame.sparkSession):
            frame.write.option("compression", "zstd").parquet(posixpath.join(folder, name))


def append_portfolio(tables: Tables, folder: str, batch_id: str | None = None) -> bool:
    """Add the rows of a batch to all tables at once; False if a batch of this id is stored already.

    A failure before the last step leaves the portfolio as it was, so the same call can be
    repeated. Without an id every call adds its rows.
    """
    spark = tables.loans.sparkSession
    batch_id = batch_id or uuid.uuid4().hex
    at = _current(spark, folder)
    versions = Versions(spark, at)
    number, content = versions.latest()
    if _holds(content, batch_id):
        return False
    name = f"batch-{uuid.uuid4().hex}"
    path = posixpath.join(at, name)
    try:
        _store(tables, path)
        while True:
            grown = {**content, "batches": [*content.get("batches", []), {"id": batch_id, "folder": name}]}
            try:
                versions.commit(number + 1, grown)
                return True
            except Conflict:
                number, content = versions.latest()
                if _holds(content, batch_id):
                    delete(spark, path)
                    return False
    except Exception:
        with suppress(Exception):  # the error that stopped the append is the one to report
            delete(spark, path)
        raise


def _holds(content: dict, batch_id: str) -> bool:
    return batch_id in content.get("merged", ()) or any(b["id"] == batch_id for b in content.get("batches", []))


def compact_portfolio(spark: SparkSession, folder: str) -> None:
    """Store the portfolio anew without separate batches; their ids still count once."""
    known = stored_batches(spark, folder)
    with _new_generation(spark, folder) as at:
        _store(read_parquet_portfolio(spark, folder), at)
        Versions(spark, at).commit(1, {"origin": known.origin, "merged": [*known.merged, *known.later]})


def save_scores(scores: DataFrame, target: str, as_table: bool = False) -> None:
    """Replace the scored table: a folder read by `read_scores`, or a catalog table."""
    if as_table:
        scores.write.mode("overwrite").format("parquet").saveAsTable(target)
        return
    with _new_generation(scores.sparkSession, target) as at:
        scores.write.parquet(posixpath.join(at, "scores"))


def read_scores(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(posixpath.join(_current(spark, target), "scores"))


POINTER = "_current"


def _pointed(spark: SparkSession, folder: str) -> str | None:
    """Name of the current generation, if the folder has any."""
    system, path = file_system(spark, posixpath.join(folder, POINTER))
    if not system.exists(path):
        return None
    stream = system.open(path)
    try:
        return stream.readUTF()
    finally:
        stream.close()


def _current(spark: SparkSession, folder: str) -> str:
    name = _pointed(spark, folder)
    return posixpath.join(folder, name) if name else folder


class _new_generation:
    """A folder to write to, which becomes the current one if the block ends without an error."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder
        self.name = f"generation-{uuid.uuid4().hex}"

    def __enter__(self) -> str:
        return posixpath.join(self.folder, self.name)

    def __exit__(self, kind, *_) -> None:
        system, _ = file_system(self.spark, self.folder)
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        if kind is not None:
            with suppress(Exception):  # the error that ended the block is the one to report
                system.delete(path(posixpath.join(self.folder, self.name)), True)
            return
        before = _pointed(self.spark, self.folder)
        stream = system.create(path(posixpath.join(self.folder, POINTER)), True)
        stream.writeUTF(self.name)
        stream.close()
        for entry in system.listStatus(path(self.folder)):
            name = entry.getPath().getName()
            if name.startswith("generation-") and name not in (self.name, before):
                system.delete(entry.getPath(), True)


def _tables(frames: dict, macro: DataFrame) -> Tables:
    return Tables(
        customers=frames["dim_customers"],
        products=frames["dim_products"],
        channels=frames["dim_channels"],
        loans=frames["fct_loans"],
        schedule=frames["fct_schedule"],
        payments=frames["fct_payments"],
        collections=frames["fct_collections"],
        macro=macro,
    )
