"""Checks of a table against its warehouse contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clinflow.schemas import TableContract
from clinflow.sources.feeds import require_columns


def conform(df: DataFrame, contract: TableContract) -> DataFrame:
    """Columns in warehouse order and type."""
    require_columns(df, contract.columns.names)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in contract.columns])


def contract_violations(df: DataFrame, contract: TableContract) -> DataFrame:
    """(table_name, check_name, column_name, violations), one row per check, zero where it holds.

    NULLs and over-long text are counted in one aggregate. Repeated primary keys are counted as the
    rows beyond the first of each key.
    """
    require_columns(df, contract.columns.names)
    filled = tuple(dict.fromkeys([*([contract.primary_key] if contract.primary_key else []), *contract.not_null]))
    checks = [("not_null", name, F.col(name).isNull()) for name in filled]
    checks += [("max_length", name, F.length(name) > size) for name, size in contract.max_length.items()]
    counts = df.agg(*[F.count_if(broken).alias(f"c{i}") for i, (_, _, broken) in enumerate(checks)])
    rows = [
        F.struct(
            F.lit(contract.name).alias("table_name"),
            F.lit(check).alias("check_name"),
            F.lit(column).alias("column_name"),
            F.col(f"c{i}").alias("violations"),
        )
        for i, (check, column, _) in enumerate(checks)
    ]
    report = counts.select(F.inline(F.array(*rows)))
    if not contract.primary_key:
        return report
    key = contract.primary_key
    repeated = (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("rows"))
        .agg(F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("violations"))
        .select(
            F.lit(contract.name).alias("table_name"),
            F.lit("primary_key").alias("check_name"),
            F.lit(key).alias("column_name"),
            "violations",
        )
    )
    return report.unionByName(repeated)


def failed_checks(df: DataFrame, contract: TableContract) -> list[tuple[str, str, int]]:
    """The broken checks as (check, column, rows); at most one entry per check of the contract."""
    broken = contract_violations(df, contract).filter(F.col("violations") > 0).collect()
    return [(row.check_name, row.column_name, row.violations) for row in broken]
