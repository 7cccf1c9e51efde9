import sys
from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from lendspan import Tables, schemas  # noqa: E402
from lendspan.session import build_session  # noqa: E402
from lendspan.sources import dims  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "lendspan-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    yield session
    session.stop()


def day(text: str) -> date:
    return date.fromisoformat(text)


def loan(
    loan_id,
    customer_id=1,
    product="Personal",
    opened="2024-01-15",
    principal="1000.00",
    apr="0.1200",
    term=12,
    channel="Online",
):
    return (
        loan_id,
        customer_id,
        product,
        day(opened),
        Decimal(principal),
        Decimal(apr),
        term,
        channel,
        "Active",
    )


def due(loan_id, on, amount, principal=None, number=1):
    whole = Decimal(amount)
    part = whole if principal is None else Decimal(principal)
    return (loan_id, number, day(on), whole, part, whole - part)


def paid(loan_id, on, amount):
    return (loan_id, day(on), Decimal(amount))


def customer(customer_id=1, income="65000.00", employment="Salaried", region="Otago", score=650):
    return (customer_id, 40, income and Decimal(income), employment, region, score, 12)


def relaxed(schema):
    """The schema without required columns, for deliberately broken rows."""
    from pyspark.sql import types as T

    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


@pytest.fixture(scope="session")
def make_tables(spark):
    def make(loans=(), schedule=(), payments=(), customers=None, collections=()):
        people = [customer()] if customers is None else customers
        frame = lambda rows, schema: spark.createDataFrame(list(rows), relaxed(schema))
        return Tables(
            customers=frame(people, schemas.CUSTOMERS),
            products=dims.products(spark),
            channels=dims.channels(spark),
            loans=frame(loans, schemas.LOANS),
            schedule=frame(schedule, schemas.SCHEDULE),
            payments=frame(payments, schemas.PAYMENTS),
            collections=frame(collections, schemas.COLLECTIONS),
            macro=dims.macro_monthly(spark),
        )

    return make


def rows(df, *columns):
    """Sorted tuples of a frame, NULL first."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is not None, v) for v in r])
