"""Named queries and the SQL that checks them."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hearthside.plans.fixture import LISTINGS_SQL

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# total order of the listings; row_key alone repeats once in the smallest data set
KEY = ["row_key", "price_numeric", "description"]


def query(name: str, sql: str | None = None, listings: bool = True):
    """Register a query; ``sql`` may start with further common table expressions (", x AS (…) SELECT …")."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = (f"WITH listings_fx AS ({LISTINGS_SQL}) {sql}" if listings else sql).strip()
        return fn

    return add
