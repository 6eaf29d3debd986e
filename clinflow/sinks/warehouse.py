"""JDBC sink for contract-checked tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from clinflow.operators.contract import conform, failed_checks
from clinflow.schemas import TableContract


class ContractError(ValueError):
    """A table breaks the warehouse contract and was not loaded."""


@dataclass(frozen=True)
class JdbcTarget:
    """Connection and write options. The password is left out of ``repr`` and is never logged."""

    url: str
    table: str
    user: str
    password: str = field(repr=False)
    driver: str = "org.postgresql.Driver"
    mode: str = "append"
    connections: int = 32
    batch_rows: int = 10_000

    def options(self) -> dict[str, str]:
        return {
            "url": self.url,
            "dbtable": self.table,
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
            # Upper bound on open connections: Spark coalesces to it before writing.
            "numPartitions": str(self.connections),
            "batchsize": str(self.batch_rows),
            # With mode "overwrite": empty the table and keep its definition and constraints.
            "truncate": "true",
        }


def write_jdbc(df: DataFrame, target: JdbcTarget) -> None:
    """Each partition commits on its own, so a load that fails midway must be cleared before a re-run."""
    df.write.format("jdbc").options(**target.options()).mode(target.mode).save()


def load_table(df: DataFrame, contract: TableContract, target: JdbcTarget) -> None:
    """Check the contract, put columns in warehouse order and type, then load."""
    broken = failed_checks(df, contract)
    if broken:
        listed = "; ".join(f"{check} on {column}: {rows}" for check, column, rows in broken)
        raise ContractError(f"{contract.name} not loaded: {listed}")
    write_jdbc(conform(df, contract), target)
