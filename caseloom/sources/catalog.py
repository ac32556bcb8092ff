"""SQL names for the stored tables (SNK-5..8, SRC-5).

``register_tables`` is idempotent and follows the config: the tables always
lie over the folders of its root, whatever root was registered before, and
cached file listings are refreshed. Reports then run as plain ``spark.sql`` against those names.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from caseloom.config import PipelineConfig

# table name -> (layer, folder)
SQL_TABLES = {
    "ticket_similarity": ("model", "ticket_similarity"),
    "order_support_360": ("gold", "order_support_360"),
    "issue_kpis": ("gold", "issue_kpis"),
    "city_issue_hotspots": ("gold", "city_issue_hotspots"),
}


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _external_table(spark: SparkSession, name: str, columns: str, using: str, location: str) -> None:
    """Create the table over ``location``; one that lies elsewhere is registered anew (its files stay)."""
    if spark.catalog.tableExists(name):
        about = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
        if about.get("Type") != "EXTERNAL":
            raise ValueError(f"{name} exists and is not an external table")
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE TABLE {name} {columns} USING {using} LOCATION {_quoted(location)}")
    spark.catalog.refreshTable(name)


def create_database(spark: SparkSession, cfg: PipelineConfig) -> None:
    """The database, with its own folder under the pipeline's root."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{cfg.database}` LOCATION {_quoted(cfg.root.rstrip('/') + '/_database')}")


def register_csv_table(spark: SparkSession, database: str, name: str, path: str, schema) -> str:
    """SNK-7 import form: a table over headered CSV (quotes escaped by doubling,
    quoted line breaks allowed), typed by ``schema``."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    _external_table(spark, f"`{database}`.`{name}`", f"({cols})",
                    "csv OPTIONS (header 'true', escape '\"', multiLine 'true')", path)
    return f"{database}.{name}"


def register_tables(spark: SparkSession, cfg: PipelineConfig, use: bool = True) -> list[str]:
    create_database(spark, cfg)
    created = []
    for name, (layer, folder) in SQL_TABLES.items():
        _external_table(spark, f"`{cfg.database}`.`{name}`", "", "parquet", cfg.path(layer, folder))
        created.append(f"{cfg.database}.{name}")
    if use:
        spark.catalog.setCurrentDatabase(cfg.database)
    return created
