"""The warehouse: raw table, star schema and vector collection as Parquet tables of one database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from newsflow.functions.encoders import COLLECTION_DIM
from newsflow.schemas import BUCKET_KEYS, PARTITIONS, TABLE_COLUMNS, WAREHOUSE_TABLES
from newsflow.session import stage, staging

METADATA = "article_metadata"
OUTCOMES = "load_outcomes"
# The collection is a view over the points of all writes and the ids that later writes replace.
POINTS, LOG, REPLACED = "points", "points_log", "points_replaced"


def _columns(table: str) -> list[str]:
    return StructType.fromDDL(TABLE_COLUMNS[table]).fieldNames()


class Warehouse:
    """Tables of ``database``; with ``buckets``, large tables are bucketed on the key they are joined by.

    Every load of the star schema fills one ``load_id`` partition per table. Writing it again replaces
    it, so a load that died half way is simply repeated.
    """

    def __init__(self, spark: SparkSession, database: str, location: str | None = None, buckets: int = 0) -> None:
        self.spark = spark
        self.database = database
        self.location = location
        self.buckets = buckets

    def name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def table(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def refresh(self, table: str) -> None:
        """Notice files that another session has written."""
        self.spark.catalog.refreshTable(self.name(table))

    def _create(self, table: str) -> None:
        by = PARTITIONS.get(table, "load_id BIGINT")
        columns, partition = f"{TABLE_COLUMNS[table]}, {by}", f" PARTITIONED BY ({by.split()[0]})"
        key = BUCKET_KEYS.get(table)
        bucketed = f" CLUSTERED BY ({key}) INTO {self.buckets} BUCKETS" if self.buckets and key else ""
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({columns}) USING parquet "
                       f"OPTIONS (compression 'zstd'){partition}{bucketed}")

    def _placed(self, table: str, df: DataFrame) -> DataFrame:
        """Rows laid out for a bucketed write: one file per bucket instead of one per bucket and task."""
        key = BUCKET_KEYS.get(table)
        return df.repartition(self.buckets, key) if self.buckets and key else df

    def init_database(self) -> None:
        place = f" LOCATION '{self.location}'" if self.location else ""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}`{place}")

    def init_warehouse(self) -> None:
        """Create the seven tables that do not exist, and that of outcomes; ``dim_time`` gets its unknown member with key 0."""
        self.init_database()
        for table in (*WAREHOUSE_TABLES, OUTCOMES):
            self._create(table)
        self.spark.sql(
            f"INSERT OVERWRITE {self.name('dim_time')} PARTITION (load_id = 0) "
            "SELECT 0L, CAST(NULL AS DATE), CAST(NULL AS INT), CAST(NULL AS INT), CAST(NULL AS INT)")

    def init_metadata(self) -> None:
        self.init_database()
        self._create(METADATA)

    def reset_metadata(self) -> None:
        """Drop and recreate the raw table. A stream that filled it needs a new checkpoint to fill it again."""
        self.init_database()
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(METADATA)}")
        self._create(METADATA)

    def init_points(self, dim: int = COLLECTION_DIM) -> None:
        """Create the vector collection if absent; its vector size is a table property."""
        self.init_database()
        for table in (LOG, REPLACED):
            self._create(table)
        if "dense.dim" not in self._points_state():
            self._commit_points(**{"dense.dim": dim, "points.base": 1, "points.last": 0, "points.replaced": 0, "points.loads": 0})

    def _points_state(self) -> dict[str, str]:
        return {row["key"]: row["value"] for row in self.spark.sql(f"SHOW TBLPROPERTIES {self.name(LOG)}").collect()}

    def _commit_points(self, **changes) -> None:
        """Record the state of the collection and show it: readers see whole writes only, as the view names the last one.

        A point is shown unless a later write replaced its id.
        """
        listed = ", ".join(f"'{key}' = '{value}'" for key, value in changes.items())
        self.spark.sql(f"ALTER TABLE {self.name(LOG)} SET TBLPROPERTIES ({listed})")
        state = self._points_state()
        written = f"version BETWEEN {state['points.base']} AND {state['points.last']}"
        live = ""
        if int(state["points.replaced"]):
            live = (f" LEFT ANTI JOIN (SELECT id, max(version) AS version FROM {self.name(REPLACED)} WHERE {written} GROUP BY id) r"
                    " ON p.id = r.id AND p.version < r.version")
        columns = ", ".join(f"p.{name}" for name in _columns(POINTS))
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(POINTS)} AS SELECT {columns} FROM "
                       f"(SELECT * FROM {self.name(LOG)} WHERE {written}) p{live}")

    def points_dim(self) -> int:
        return int(self._points_state()["dense.dim"])

    def drop_points(self) -> None:
        self.spark.sql(f"DROP VIEW IF EXISTS {self.name(POINTS)}")
        for table in (LOG, REPLACED):
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}")

    def read_metadata(self) -> DataFrame:
        """The four columns the ETL needs, and the day of ingest they are stored by."""
        return self.table(METADATA).select("url_hash", "title", "content", "url", "ingest_day")

    def append_metadata(self, rows: DataFrame) -> None:
        now = F.current_timestamp()
        stamped = rows.withColumns({"crawled_at": now, "ingest_day": F.to_date(now)})
        self._insert(METADATA, stamped)

    def _insert(self, table: str, df: DataFrame) -> None:
        columns = [*_columns(table), PARTITIONS[table].split()[0]]
        self._placed(table, df.select(*columns)).write.insertInto(self.name(table))

    def next_load(self) -> int:
        """One more than the last complete load.

        ``fact_articles`` is written last and marks completion; a load that found nothing to keep has outcomes alone.
        """
        last = self.table("fact_articles").select("load_id").unionByName(self.table(OUTCOMES).select("load_id"))
        return (last.agg(F.max("load_id")).first()[0] or 0) + 1

    def loaded(self, table: str, before: int) -> DataFrame:
        """Rows of complete loads."""
        return self.table(table).filter(F.col("load_id") < before)

    def write_load(self, table: str, df: DataFrame, load_id: int) -> None:
        """Fill, or replace, the partition of one load, and record the table's size for join planning."""
        self._write_partition(table, df, load_id)
        self.spark.sql(f"ANALYZE TABLE {self.name(table)} COMPUTE STATISTICS NOSCAN")

    def _write_partition(self, table: str, df: DataFrame, number: int) -> None:
        columns, by = ", ".join(_columns(table)), PARTITIONS.get(table, "load_id").split()[0]
        self.spark.sql(f"INSERT OVERWRITE {self.name(table)} PARTITION ({by} = {int(number)}) SELECT {columns} FROM {{rows}}",
                       rows=self._placed(table, df))

    def truncate_all(self) -> None:
        """Empty the raw table and the star schema. Keys and loads restart, as the next key is the highest plus one."""
        for table in (METADATA, *WAREHOUSE_TABLES, OUTCOMES):
            self._create(table)
            self.spark.sql(f"TRUNCATE TABLE {self.name(table)}")
        if self.spark.catalog.tableExists(self.name(LOG)):
            self._commit_points(**{"points.loads": 0})

    def _wide(self, points: DataFrame) -> DataFrame:
        """Points whose dense vectors have the collection's width; another one fails the write."""
        dim = self.points_dim()
        wrong = F.raise_error(F.lit(f"points must have {dim} dense values"))
        return points.withColumn("dense", F.when(F.size("dense") == dim, F.col("dense")).otherwise(wrong.cast("array<float>")))

    def _write_points(self, points: DataFrame, replace: bool, dealt: bool = False, **changes) -> None:
        """Write one more version, in as many files as its size asks for, and show it. One that died is written again."""
        version = int(self._points_state()["points.last"]) + 1
        self._write_partition(LOG, self._wide(points) if dealt else self._wide(points).hint("rebalance"), version)
        if replace:
            written = self.table(LOG).filter(F.col("version") == version)
            self._write_partition(REPLACED, written.select("id").hint("rebalance"), version)
            changes["points.replaced"] = version
        self._commit_points(**{"points.last": version, **changes})

    def append_points(self, points: DataFrame, loads: int | None = None, dealt: bool = False) -> None:
        """Insert points whose ids are not in the collection; they are written once. ``loads``: the last load that is whole in it.

        Points that are ``dealt`` come out of a shuffle that adaptive execution sized, and are written from there.
        """
        self._write_points(points, False, dealt, **({} if loads is None else {"points.loads": loads}))

    def points_loads(self) -> int:
        """The chunks of all loads up to this one are in the collection."""
        return int(self._points_state()["points.loads"])

    def mark_loads(self, last: int) -> None:
        """Record that the chunks of all loads up to ``last`` are in the collection."""
        self._commit_points(**{"points.loads": last})

    def upsert_points(self, points: DataFrame) -> None:
        """Insert points, unique by id, in place of those with the same id.

        Only the points given are written, with their ids; the points they replace are left out when reading, until
        ``compact_points`` removes them.
        """
        with staging(self.spark):
            new = stage(points.select(*_columns(POINTS)), "points")
            if not new.filter(F.size("dense") != self.points_dim()).isEmpty():
                raise ValueError(f"points must have {self.points_dim()} dense values")
            self._write_points(new, True)

    def compact_points(self) -> None:
        """Write the points that are shown as one version and drop what came before. Readers see the same points throughout.

        The new version is shown in one step; a compaction that died before leaves the old ones as they are.
        """
        state = self._points_state()
        version = int(state["points.last"]) + 1
        with staging(self.spark):
            live = stage(self.table(POINTS), "points")
            self._write_partition(LOG, live.hint("rebalance"), version)
            self._commit_points(**{"points.base": version, "points.last": version, "points.replaced": 0})
        for table in (LOG, REPLACED):
            old = [row[0] for row in self.spark.sql(f"SHOW PARTITIONS {self.name(table)}").collect()]
            gone = [name.split("=")[1] for name in old if int(name.split("=")[1]) < version]
            if gone:
                self.spark.sql(f"ALTER TABLE {self.name(table)} DROP IF EXISTS " + ", ".join(
                    f"PARTITION (version = {number})" for number in gone))

    def report(self, sql: str) -> DataFrame:
        """Ad-hoc SQL; ``{table}`` names a table of this database."""
        names = {table: self.name(table) for table in TABLE_COLUMNS}
        return self.spark.sql(sql.format(**names))

