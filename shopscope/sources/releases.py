"""All tables of a refresh as one new version: written apart, then put in place of the old ones.

A release writes its tables below a folder of its own, where nothing reads them but the refresh. Once everything is
written and checked, ``publish`` points the catalog's tables to the new folders, one after the other, by changing their
location; so a reader finds the old or the new content, never half of it and never no table. If a table can't be
switched, those already switched go back. The version before stays on disk until the next one is published, for
queries that began on it; older ones that no table is in, and what failed refreshes left, are deleted then.
"""

from __future__ import annotations

import uuid
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession

VERSIONS = "versions"


class Release:
    def __init__(self, spark: SparkSession, target: str):
        self.spark = spark
        self.root = f"{target.rstrip('/')}/{VERSIONS}"
        self.name = f"{datetime.now(UTC):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
        self.tables: dict[tuple[str, str], DataFrame] = {}

    def location(self, layer: str, name: str = "") -> str:
        return "/".join(part for part in (self.root, self.name, layer, name) if part)

    def store(self, layer: str, name: str, df: DataFrame) -> DataFrame:
        """Write a table of this version and read it back."""
        df.write.parquet(self.location(layer, name))
        return self.add(layer, name, self.spark.read.schema(df.schema).parquet(self.location(layer, name)))

    def add(self, layer: str, name: str, stored: DataFrame) -> DataFrame:
        """Take up a table that has been written to its location already."""
        self.tables[layer, name] = stored
        return stored

    def publish(self, prefix: str = "") -> None:
        """Point ``<prefix><layer>.<name>`` to the tables of this version."""
        undo: list[str] = []
        kept = set()
        try:
            for (layer, name), df in self.tables.items():
                table, new = f"{prefix}{layer}.{name}", self.location(layer, name)
                old = self._switch(table, df, new)
                undo.append(f"DROP TABLE {table}" if old is None else f"ALTER TABLE {table} SET LOCATION '{old}'")
                kept.add(self._version_of(old))
                self.spark.catalog.refreshTable(table)
        except Exception:
            for statement in reversed(undo):
                self.spark.sql(statement)
            raise
        self._forget_versions({self.name, *kept}, prefix)

    def _switch(self, table: str, df: DataFrame, location: str) -> str | None:
        """Returns the old location, or None where there was no table."""
        if not self.spark.catalog.tableExists(table):
            self.spark.sql(f"CREATE TABLE {table} ({_columns(df)}) USING parquet LOCATION '{location}'")
            return None
        old = self._location_of(table)
        if _columns(self.spark.table(table)) == _columns(df):
            self.spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
        else:  # other columns than in the version before: the catalog can't exchange both in one step
            self.spark.sql(f"DROP TABLE {table}")
            self.spark.sql(f"CREATE TABLE {table} ({_columns(df)}) USING parquet LOCATION '{location}'")
        return old

    def _location_of(self, table: str) -> str:
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
        return rows[0]["data_type"]

    def _version_of(self, location: str | None) -> str:
        """The version a location belongs to; empty for none."""
        _, found, rest = (location or "").partition(f"/{VERSIONS}/")
        return rest.split("/")[0] if found else ""

    def _forget_versions(self, kept: set[str], prefix: str) -> None:
        """Delete versions that aren't kept and that no table of the catalog is in."""
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        system = root.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        for version in system.listStatus(root):
            name = version.getPath().getName()
            if name not in kept and not any(
                self._is_read(f"{prefix}{layer.getPath().getName()}.{table.getPath().getName()}", name)
                for layer in system.listStatus(version.getPath())
                for table in system.listStatus(layer.getPath())
            ):
                system.delete(version.getPath(), True)

    def _is_read(self, table: str, version: str) -> bool:
        return self.spark.catalog.tableExists(table) and self._version_of(self._location_of(table)) == version


def _columns(df: DataFrame) -> str:
    return ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in df.schema)
