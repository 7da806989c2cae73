"""One path object for every layer of one environment.

The reference scatters paths over notebooks (and they disagree between
stages); here one object names landing, bronze, silver, gold, schema memory
and one checkpoint folder per stream.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Paths:
    root: str
    environment: str = "test"

    def _p(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), self.environment, *parts])

    @property
    def landing(self) -> str:
        return self._p("raw-landing")

    @property
    def bronze(self) -> str:
        return self._p("bronze", "data")

    @property
    def schema_memory(self) -> str:
        return self._p("_schemas", "bronze")

    @property
    def silver_good(self) -> str:
        return self._p("silver", "silver_data")

    @property
    def silver_quarantine(self) -> str:
        return self._p("silver", "silver_quarantine")

    def gold(self, name: str) -> str:
        return self._p("gold", name)

    def checkpoint(self, stream: str) -> str:
        """Every stream gets its own checkpoint folder."""
        return self._p("_checkpoints", stream)

    @property
    def database(self) -> str:
        return f"fraud_{self.environment}"


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        raise RuntimeError("spark.checkpoint.dir is not set; call fjord.session.ensure_checkpoint_dir")
    return d
