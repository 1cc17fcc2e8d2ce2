"""The registered queries: a Spark function, the SQL it is checked against and what it covers."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from martlens.plans import oracle
from martlens.plans.sample_model import SampleModel
from martlens.session import configure


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SampleModel], DataFrame]
    sql: str | None
    covers: tuple[str, ...]


REGISTRY: dict[str, Query] = {}


def query(covers: str, sql: str | None = None):
    """Register a function under its own name; `covers` lists inventory ids."""

    def register(fn: Callable[[SampleModel], DataFrame]):
        name = fn.__name__
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        text = oracle.with_model(sql) if sql else None
        REGISTRY[name] = Query(name, fn, text, tuple(covers.split()))
        return fn

    return register


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles, times and days as text: types two engines agree on."""
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.to_json(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def runner(q: Query) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return comparable(q.run(SampleModel(configure(spark), folder)))

    run.__name__ = q.name
    return run
