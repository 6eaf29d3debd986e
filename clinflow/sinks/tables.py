"""Parquet sink and the folder layout of the zones."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str) -> None:
    """Replace the table at ``path``. An empty frame is written too, so no earlier rows linger."""
    df.write.mode("overwrite").parquet(path)


@dataclass(frozen=True)
class Zones:
    """The base folder of each zone, and where its tables lie."""

    staging_base: str
    curated_base: str
    quarantine_base: str
    safe_base: str
    model_base: str

    @classmethod
    def under(cls, root: str) -> Zones:
        """All zones below one root."""
        root = root.rstrip("/")
        safe = f"{root}/curated_safe"
        return cls(f"{root}/staging", f"{root}/curated", f"{root}/quarantine", safe, f"{safe}/model")

    def staging(self, table: str) -> str:
        return f"{self.staging_base}/claims" if table == "claims" else f"{self.staging_base}/ehr/{table}"

    def curated(self, table: str) -> str:
        return f"{self.curated_base}/{table}_clean"

    def quarantine(self, table: str) -> str:
        return f"{self.quarantine_base}/{table}"

    def safe(self, table: str) -> str:
        return f"{self.safe_base}/{table}_clean"

    def model(self, table: str) -> str:
        return f"{self.model_base}/{table}"
