"""Catalog tables and versioned migrations."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from forkline import schemas
from forkline.session import shuffles_removed

#: Heights of one bucket's rows that one task of a publication takes.
HEIGHTS = 20_000


def _columns(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def create_statement(database: str, name: str, buckets: int | None = None) -> str:
    """DDL of a signed table.  With ``buckets`` rows are also hashed and sorted by height,
    so that joins and collapses on it need no shuffle."""
    clustered = (f" CLUSTERED BY (block_number) SORTED BY (block_number) INTO {buckets} BUCKETS" if buckets else "")
    folders = schemas.PARTITIONS[name]
    extra = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in folders)
    return (f"CREATE TABLE IF NOT EXISTS {database}.{name} ({_columns(schemas.TABLES[name])}, {extra}) "
            f"USING parquet OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY ({', '.join(f.name for f in folders)}){clustered}")


def create_all(spark: SparkSession, database: str, buckets: int | None = None) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in schemas.TABLES:
        spark.sql(create_statement(database, name, buckets))


def publish(store, database: str, name: str, buckets: int | None = None, heights: tuple | None = None) -> None:
    """Fill a catalog table from the store's committed batches: all of it, or the height buckets
    ``heights[0]`` to ``heights[1]`` that new batches touched.

    Whole partitions are overwritten, so a repeated or retried publication changes nothing.  With
    ``buckets`` (those the table was created with) rows are dealt the way the table is, one task per
    bucket and ``HEIGHTS`` heights, so that no task writes a file of every bucket and none grows with
    the chain."""
    rows = store.table(name)
    if heights is not None:
        rows = rows.where(F.col("block_bucket").between(*heights))
    if buckets:
        lo, hi = store.progress().agg(F.min("lo"), F.max("hi")).first()
        ranges = 1 if lo is None else (hi - lo) // HEIGHTS + 1
        place = F.call_function("div", F.col("block_number") - F.lit(lo or 0).cast("bigint"), F.lit(HEIGHTS).cast("bigint"))
        rows = rows.repartitionById(ranges * buckets, (F.pmod(place, F.lit(ranges)) * buckets + F.pmod(F.hash("block_number"), F.lit(buckets))).cast("int"))
    else:
        rows = rows.hint("rebalance", "block_bucket")
    folders = [f.name for f in schemas.PARTITIONS[name]]
    columns = [f.name for f in schemas.TABLES[name].fields] + folders
    # the table's own options say that only the partitions written are overwritten
    with shuffles_removed(rows.sparkSession):
        rows.select(*columns).sortWithinPartitions(*folders, "block_number").write.insertInto(f"{database}.{name}", overwrite=True)


def verify(spark: SparkSession, database: str) -> list:
    """Problems found: missing tables and columns of the wrong type.  Empty when sound."""
    problems = []
    for name, schema in schemas.TABLES.items():
        full = f"{database}.{name}"
        if not spark.catalog.tableExists(full):
            problems.append(f"{full} does not exist")
            continue
        have = dict(spark.table(full).dtypes)
        problems += [f"{full}.{f.name} should be {f.dataType.simpleString()}, not {have.get(f.name)}"
                     for f in schema.fields if have.get(f.name) != f.dataType.simpleString()]
    return problems


def drop_all(spark: SparkSession, database: str) -> None:
    for name in [*schemas.TABLES, "schema_migrations"]:
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")


def describe(spark: SparkSession, database: str, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE EXTENDED {database}.{name}")


def show_create(spark: SparkSession, database: str, name: str) -> str:
    return spark.sql(f"SHOW CREATE TABLE {database}.{name}").first()[0]


def default_migrations(database: str) -> list:
    return [(1, "initial_schema", [create_statement(database, name) for name in schemas.TABLES])]


def current_version(spark: SparkSession, database: str) -> int:
    return spark.table(f"{database}.schema_migrations").agg(
        F.coalesce(F.max("version"), F.lit(0))).first()[0]


def pending(spark: SparkSession, database: str, migrations: list) -> list:
    current = current_version(spark, database)
    return sorted(m for m in migrations if m[0] > current)


def migrate(spark: SparkSession, database: str, migrations: list | None = None) -> int:
    """Apply pending migrations in order and record each; returns how many ran."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.schema_migrations "
              f"({_columns(schemas.SCHEMA_MIGRATIONS)}) USING parquet")
    todo = pending(spark, database, default_migrations(database) if migrations is None else migrations)
    for version, name, statements in todo:
        for statement in statements:
            spark.sql(statement)
        spark.sql(f"INSERT INTO {database}.schema_migrations VALUES ({int(version)}, :name, current_timestamp())",
                  args={"name": name})
    return len(todo)
