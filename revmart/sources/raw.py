"""The five raw inputs of the warehouse, from any origin: landed raw
tables, the driver's test tables, or hand-made frames in tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from revmart.sources.schema import RAW_TABLES


class Sources:
    """The five raw inputs of the warehouse. Each is either a DataFrame or a
    zero-argument callable producing one; callables are resolved on first
    use, so a relation only plans the sources it reads."""

    NAMES = ("sales", "customers", "targets", "cash_flow", "employees")

    def __init__(self, **frames):
        unknown = set(frames) - set(self.NAMES)
        if unknown:
            raise TypeError(f"unknown sources: {sorted(unknown)}")
        self._frames = dict(frames)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self.NAMES:
            raise AttributeError(name)
        v = self._frames.get(name)
        if v is None:
            raise AttributeError(f"source {name!r} was not provided")
        if callable(v) and not isinstance(v, DataFrame):
            v = v()
            self._frames[name] = v
        return v

    @classmethod
    def from_tables(cls, spark: SparkSession, database: str = "raw",
                    tables: dict[str, str] | None = None) -> "Sources":
        """Sources read from landed raw tables (``<database>.<table>``)."""
        names = dict(RAW_TABLES, **(tables or {}))
        return cls(**{k: (lambda t=t: spark.table(f"{database}.{t}")) for k, t in names.items()})
