"""Where queries over the given tables are registered with their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from evgraph.catalog.sql import with_tables
from evgraph.session import tune
from evgraph.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, *tables: str, sql: str | None = None, recursive: bool = False):
    """Register ``fn(tables) -> DataFrame``; ``sql`` may use the derived ``tables``."""

    def keep(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plain(fn(Tables(tune(spark), folder)))

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_tables(*tables, body=sql, recursive=recursive) if tables else sql.strip()
        return fn

    return keep


# Positions and lengths that are INT in Spark and BIGINT in the checking engine.
WIDE = set(
    "rank need_rank seq page_no line_no first_line last_line start_line end_line start_char end_char token_count fiscal_year year score"
    " timing_error_days size_bytes distance n_terms n_hits notice_to_award_days oldest_days".split()
)


def plain(df: DataFrame) -> DataFrame:
    """Dates as text, decimals as doubles, arrays of text joined: values both engines
    print alike."""
    columns = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            col = F.date_format(col, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.TimestampNTZType, T.TimestampType)):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, T.DecimalType):
            col = col.cast("double")
        elif isinstance(field.dataType, T.IntegerType) and field.name in WIDE:
            col = col.cast("long")
        elif isinstance(field.dataType, T.ArrayType):
            col = F.array_join(col.cast("array<string>"), ",")
        columns.append(col.alias(field.name))
    return df.select(*columns)
