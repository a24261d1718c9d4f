"""What the engine knows of tables: relations, schema lists, provisioning, registries on disk, secrets in settings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.identity import checked_identifier, quoted, schema_or_default
from tidemark.operators.schema import REGISTRY, evolve
from tidemark.streaming.tables import VersionedTable


#: Schemas that are never replicated.
SYSTEM = ("information_schema", "pg_catalog", "sys")


def resolve_relations(events: DataFrame, relations: DataFrame) -> DataFrame:
    """Events with the names that their relation number (oid) stands for where they have none."""
    names = relations.select("oid", F.col("table_schema").alias("_s"), F.col("table_name").alias("_t"))
    joined = events.join(names, "oid", "left")
    return joined.withColumn("table_schema", schema_or_default(F.coalesce("table_schema", "_s"))).withColumn("table_name", F.coalesce(F.nullif("table_name", F.lit("")), "_t")).drop("_s", "_t")


def schemas(spark: SparkSession) -> list[str]:
    """Databases in order, without system ones."""
    return sorted(d.name for d in spark.catalog.listDatabases() if d.name not in SYSTEM)


def schemas_of(tables: DataFrame) -> DataFrame:
    """Schemas that hold tables, in order, without system ones."""
    return tables.select("table_schema").distinct().filter(~F.col("table_schema").isin(*SYSTEM)).orderBy("table_schema")


def declared_keys(constraints: DataFrame, key_columns: DataFrame) -> DataFrame:
    """Primary keys as declared: table_schema, table_name and pk_columns in their ordinal order.

    constraints: table_schema, table_name, constraint_name, constraint_type; key_columns: table_schema, constraint_name, column_name,
    ordinal_position. A key's columns, a handful, are ordered inside the aggregation.
    """
    by = ["table_schema", "constraint_name"]
    joined = constraints.filter(F.col("constraint_type") == "PRIMARY KEY").select(*by, "table_name").join(key_columns, by)
    ordered = F.array_sort(F.collect_list(F.struct("ordinal_position", "column_name")))
    return joined.groupBy("table_schema", "table_name").agg(F.transform(ordered, lambda x: x["column_name"]).alias("pk_columns"))


def indexed_keys(attributes: DataFrame, indexes: DataFrame) -> DataFrame:
    """Primary keys from index entries: relid and pk_columns in the order of the index.

    attributes: relid, attnum, name; indexes: relid, is_primary, indkey (attribute numbers).
    """
    keys = indexes.filter("is_primary").select("relid", "indkey")
    found = attributes.join(keys, "relid").filter(F.array_contains(F.col("indkey"), F.col("attnum")))
    ordered = F.array_sort(F.collect_list(F.struct(F.array_position(F.col("indkey"), F.col("attnum")).alias("i"), "name")))
    return found.groupBy("relid").agg(F.transform(ordered, lambda x: x["name"]).alias("pk_columns"))


def column_metadata(columns: DataFrame, keys: DataFrame) -> DataFrame:
    """Registry rows of scanned tables: table_schema, table_name, version, columns, pk_columns (none: null).

    columns: table_schema, table_name, column_name, data_type; keys: what declared_keys gives.
    """
    entries = F.map_from_entries(F.array_sort(F.collect_list(F.struct("column_name", "data_type"))))
    by = ["table_schema", "table_name"]
    return columns.groupBy(*by).agg(entries.alias("columns")).join(keys.select(*by, "pk_columns"), by, "left").select(*by, F.lit(1).cast("bigint").alias("version"), "columns", "pk_columns")


def scan_tables(spark: SparkSession, names: list[tuple[str, str]]) -> DataFrame:
    """columns for column_metadata of tables of the catalog."""
    found = [(s, t, f.name, f.dataType.simpleString()) for s, t in names for f in spark.table(f"{quoted(s)}.{quoted(t)}").schema]
    return spark.createDataFrame(found, "table_schema string, table_name string, column_name string, data_type string")


def listed_tables(registry: DataFrame, discovered: DataFrame) -> DataFrame:
    """Tables of the registry; schemas of which it knows none are listed from the discovery."""
    known = registry.select("table_schema", "table_name").distinct()
    rest = discovered.select("table_schema", "table_name").join(known.select("table_schema").distinct(), "table_schema", "left_anti")
    return known.unionByName(rest.distinct())


def provision(spark: SparkSession, wanted: list[str], create: bool = True) -> list[str]:
    """Creates the databases that don't exist, or raises with the sorted list of them."""
    missing = sorted(s for s in set(wanted) if not spark.catalog.databaseExists(checked_identifier(s)))
    if missing and not create:
        raise ValueError(f"missing databases: {', '.join(missing)}")
    for s in missing:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(s)}")
    return missing


class Registry:
    """The schema registry as a versioned table; each change is one version."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.table = spark, VersionedTable(spark, path)

    def read(self) -> DataFrame:
        found = self.table.read()
        return self.spark.createDataFrame([], REGISTRY) if found is None else found

    def prime(self, rows: DataFrame) -> None:
        """Enters tables that aren't known yet, before any of their data."""
        new = rows.join(self.read().select("table_schema", "table_name"), ["table_schema", "table_name"], "left_anti")
        self.table.replace(self.read().unionByName(new.select(*self.read().columns)), self.table.state()["batch_id"] + 1)

    def add(self, added: DataFrame) -> None:
        """Adds columns (table_schema, table_name, added map)."""
        self.table.replace(evolve(self.read(), added), self.table.state()["batch_id"] + 1)


def masked_dsn(dsn: Column) -> Column:
    """A connection string without its password."""
    return F.regexp_replace(F.regexp_replace(dsn, r"(://[^:/@]*):[^@]*@", "$1:***@"), r"(?i)(password=)\S+", "$1***")


def unmasked_dsn(given: Column, stored: Column) -> Column:
    """The stored string where the given one is its masked form, else the given one."""
    return F.when(given == masked_dsn(stored), stored).otherwise(given)


def sealed(text: Column, key: bytes) -> Column:
    """AES-GCM in base64."""
    return F.base64(F.aes_encrypt(text, F.lit(key), F.lit("GCM")))


def opened(text: Column, key: bytes) -> Column:
    return F.aes_decrypt(F.unbase64(text), F.lit(key), F.lit("GCM")).cast("string")


def schema_of_change(changes: DataFrame) -> DataFrame:
    """Schema changes with a schema: their own, or one made of the added columns."""
    own = F.col("columns").isNotNull() & (F.size("columns") > 0)
    return changes.withColumn("columns", F.when(own, F.col("columns")).otherwise(F.col("added")))


def renamed(registry: DataFrame, names: dict[str, str]) -> DataFrame:
    """The registry with columns and keys renamed, as a transformer of schema changes may ask."""
    table = F.create_map(*[x for k, v in names.items() for x in (F.lit(k), F.lit(v))])
    new = lambda c: F.coalesce(F.element_at(table, c), c)
    return registry.withColumn("columns", F.transform_keys("columns", lambda k, _: new(k))).withColumn("pk_columns", F.transform("pk_columns", new))
