"""Layer runner: writes raw, cleansed and metric tables, then the views.

Each layer is written as a managed table (full overwrite) and the next
layer reads the *written* table, not the plan that produced it: lineage is
cut at every layer boundary, so a lost executor costs at most the current
layer, and every plan runs once.

* An overwrite first writes a staging table and then swaps names, so a write
  that fails half-way leaves the table as it was.
* Rows, quality lines and nulls against the contract are observed while a table
  is written (``DataFrame.observe``), so that the audit scans no stored table.
* Rows of CSV files that do not fit go to a quarantine table, with their file
  and text, and the audit has a line for each file.

Physical layout (large tables only):
* ``events_processed`` is partitioned by ``event_date`` -- date filters
  prune whole folders -- and sorted by (event_type, customer_id) inside each
  file, so ``event_type = 'transaction'`` skips the row groups of other
  events through parquet statistics;
* ``customers_cleansed`` and ``offer_interactions`` are bucketed by
  ``customer_id`` with the same bucket count, so the member rollup and the
  member join of the age analysis read co-located buckets without a shuffle.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from perkspark import schemas
from perkspark.constants import LAYER_CLEANSED, LAYER_METRICS, LAYER_RAW
from perkspark.operators import views
from perkspark.operators.reports import QUALITY
from perkspark.plans.pipeline import LoyaltyPipeline
from perkspark.sources.csv import CsvFiles

REJECTS = "rejects"
_TRACKED = "spark.sql.hive.manageFilesourcePartitions"


@dataclass
class LayerRunner:
    spark: SparkSession
    pipeline: LoyaltyPipeline
    databases: dict[str, str] = field(
        default_factory=lambda: {LAYER_RAW: LAYER_RAW, LAYER_CLEANSED: LAYER_CLEANSED, LAYER_METRICS: LAYER_METRICS}
    )
    table_format: str = "parquet"
    buckets: int | None = None
    csv_files: dict[str, CsvFiles] = field(default_factory=dict)
    written: dict[tuple[str, str], str] = field(default_factory=dict)
    observed: dict[tuple[str, str], dict[str, int]] = field(default_factory=dict)
    rejected: dict[str, int] = field(default_factory=dict)

    def table_name(self, layer: str, name: str) -> str:
        return f"{self.databases[layer]}.{name}"

    def create_databases(self) -> None:
        for db in self.databases.values():
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")

    def write(
        self,
        df: DataFrame,
        layer: str,
        name: str,
        partition_by: str | None = None,
        bucket_by: str | None = None,
        sort_by: tuple[str, ...] = (),
    ) -> DataFrame:
        """Replace ``layer.name`` by ``df`` and return the stored table.

        Readers see the old table until the new one is complete.

        Every write task would open one file per bucket or per partition
        value it holds (tasks x buckets files), so rows are first arranged
        by the layout: a bucketed table is hash-partitioned by its bucket
        column into one task per bucket (one file per bucket); a partitioned
        table gets a ``REBALANCE`` on its partition column, so AQE gives each
        task one value's rows, splitting a big value over several tasks and
        merging small ones.  ``sort_by`` then orders rows inside each task,
        so parquet min/max statistics let filters on those columns skip row
        groups.
        """
        full = self.table_name(layer, name)
        n = self.buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        if bucket_by:
            df = df.repartition(n, bucket_by)
        elif partition_by:
            df = df.hint("rebalance", partition_by)
        if sort_by:
            lead = (partition_by,) if partition_by and partition_by not in sort_by else ()
            df = df.sortWithinPartitions(*lead, *sort_by)
        # observed on top of the plan: counted once by the tasks that write
        observation = Observation(f"{full}-{uuid.uuid4().hex}")
        measures = {"rows": F.count(F.lit(1)), **{f"null {c}": v for c, v in schemas.violations(schemas.CONTRACTS.get(name, schemas.NO_CONTRACT)).items()}}
        if name in QUALITY:
            line, condition = QUALITY[name]
            measures[line] = F.count_if(F.expr(condition))
        df = df.observe(observation, *(m.alias(n) for n, m in measures.items()))
        staging = f"{full}__staging"
        writer = df.write.mode("overwrite").format(self.table_format)
        if partition_by:
            writer = writer.partitionBy(partition_by)
        if bucket_by:
            writer = writer.bucketBy(n, bucket_by).sortBy(bucket_by)
        self._recover(full)
        # partitions are found in the table's folder, so that they follow its name
        tracked = self.spark.conf.get(_TRACKED)
        self.spark.conf.set(_TRACKED, "false")
        try:
            writer.saveAsTable(staging)
        except Exception:
            self.spark.sql(f"DROP TABLE IF EXISTS {staging}")
            raise
        finally:
            self.spark.conf.set(_TRACKED, tracked)
        self._replace(full, staging)
        self.written[(layer, name)] = full
        self.observed[(layer, name)] = observation.get
        return self.spark.table(full)

    def _recover(self, full: str) -> None:
        """Put back the old table of a swap that was broken off between its two renames."""
        exists = self.spark.catalog.tableExists
        if exists(f"{full}__previous"):
            if exists(full):
                self.spark.sql(f"DROP TABLE {full}__previous")
            else:
                self.spark.sql(f"ALTER TABLE {full}__previous RENAME TO {full}")

    def _replace(self, full: str, staging: str) -> None:
        old = self.spark.catalog.tableExists(full)
        if old:
            self.spark.sql(f"ALTER TABLE {full} RENAME TO {full}__previous")
        try:
            self.spark.sql(f"ALTER TABLE {staging} RENAME TO {full}")
        except Exception:
            self._recover(full)
            raise
        if old:
            self.spark.sql(f"DROP TABLE {full}__previous")

    def write_rejects(self) -> None:
        """The rows of the CSV files that do not fit, as a table of the raw layer, and their number by file."""
        rejects = [files.rejects().select(F.lit(source).alias("source"), "*") for source, files in self.csv_files.items()]
        if not rejects:
            return
        table = self.write(reduce(DataFrame.unionByName, rejects), LAYER_RAW, REJECTS)
        found = {r["file"]: r["n"] for r in table.groupBy("file").agg(F.count(F.lit(1)).alias("n")).collect()}
        files = [f for source in self.csv_files.values() for f in source.files()]
        self.rejected = {f: found.get(f, 0) for f in files}

    def _swap(self, attr: str, stored: DataFrame) -> None:
        """Later layers read the stored table instead of re-running the plan."""
        self.pipeline.__dict__[attr] = stored

    def run(self) -> DataFrame:
        """Run every layer; returns the audit of the written tables and views."""
        p = self.pipeline
        self.create_databases()
        self.write_rejects()
        p.customers = self.write(p.customers, LAYER_RAW, "customers")
        p.offers = self.write(p.offers, LAYER_RAW, "offers")
        p.events = self.write(p.events, LAYER_RAW, "events")

        self._swap("customers_cleansed", self.write(p.customers_cleansed, LAYER_CLEANSED, "customers_cleansed", bucket_by="customer_id"))
        self._swap("offers_enriched", self.write(p.offers_enriched, LAYER_CLEANSED, "offers_enriched"))
        self._swap(
            "events_processed",
            self.write(
                p.events_processed,
                LAYER_CLEANSED,
                "events_processed",
                partition_by="event_date",
                sort_by=("event_type", "customer_id"),
            ),
        )
        p.journeys_are_stored(self.write(p.offer_interactions, LAYER_CLEANSED, "offer_interactions", bucket_by="customer_id"))

        self._swap("channel_effectiveness", self.write(p.channel_effectiveness, LAYER_METRICS, "channel_effectiveness"))
        self._swap("age_distribution", self.write(p.age_distribution, LAYER_METRICS, "age_distribution_analysis"))
        self._swap(
            "offer_completion_metrics", self.write(p.offer_completion_metrics, LAYER_METRICS, "offer_completion_metrics")
        )
        self.create_views()
        return self.audit()

    def create_views(self) -> None:
        gold = self.databases[LAYER_METRICS]
        sources = {
            "channel_effectiveness": self.table_name(LAYER_METRICS, "channel_effectiveness"),
            "age_distribution_analysis": self.table_name(LAYER_METRICS, "age_distribution_analysis"),
            "offer_completion_metrics": self.table_name(LAYER_METRICS, "offer_completion_metrics"),
        }
        for name in views.VIEWS:
            self.spark.sql(f"DROP VIEW IF EXISTS {gold}.{name}")
            self.spark.sql(views.view_ddl(name, gold, sources))
            self.written[(LAYER_METRICS, name)] = f"{gold}.{name}"

    def audit(self) -> DataFrame:
        """(layer, table_name, row_count, error) over the stored tables and views.

        Counts of tables are those observed when they were written; only the
        views, a few rows each, are counted now.  Further lines: the quality
        counts, nulls in contract columns (a line for each table, and one for each
        column that has any), and rejected rows of each CSV file.  A table or view
        that cannot be resolved or read gets a null count and the error text.
        """
        rows: list[tuple[str, str, int | None, str | None]] = []
        lost: dict[str, str] = {}
        for (layer, name), full in self.written.items():
            count, error = None, None
            try:
                stored = self.spark.table(full)
                count = self.observed[layer, name]["rows"] if (layer, name) in self.observed else stored.count()
            except Exception as exc:  # reported, not raised
                error = lost[name] = _first_line(exc)
            rows.append((layer, name, count, error))
        for name, (line, _) in QUALITY.items():
            observed = self.observed.get((LAYER_CLEANSED, name), {})
            rows.append(("quality", line, None if name in lost else observed.get(line), lost.get(name)))
        for (_, name), observed in self.observed.items():
            nulls = {f"{name}.{key.removeprefix('null ')}": n for key, n in observed.items() if key.startswith("null ")}
            if nulls:
                rows.append(("contract", name, sum(nulls.values()), None))
                rows.extend(("contract", column, n, None) for column, n in nulls.items() if n)
        rows.extend((REJECTS, file, n, None) for file, n in self.rejected.items())
        return self.spark.createDataFrame(rows, "layer string, table_name string, row_count long, error string")


def _first_line(exc: Exception) -> str:
    return (str(exc).splitlines() or [type(exc).__name__])[0]


def main(argv: list[str] | None = None) -> None:
    """``python -m perkspark.plans.runner (--csv FOLDER | --warehouse SF_DIR)``"""
    import argparse

    from perkspark.session import build_session

    ap = argparse.ArgumentParser(description="write the raw, cleansed and metric layers")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--csv", help="folder with customers.csv, offers.csv, events.csv")
    src.add_argument("--warehouse", help="folder with the warehouse parquet tables")
    ap.add_argument("--as-of", default=None, help="day membership durations are measured on")
    ap.add_argument("--period-start", default=None, help="timestamp of event hour 0")
    ap.add_argument("--strict-quotes", action="store_true", help="read amounts only from double-quoted keys")
    ap.add_argument("--buckets", type=int, default=None, help="buckets of the member tables (default: shuffle partitions)")
    ap.add_argument("--format", default="parquet", help="table format")
    ap.add_argument("--database-prefix", default="", help="put before the three database names")
    args = ap.parse_args(argv)

    spark = build_session()
    files = {}
    if args.csv:
        from perkspark.constants import DEFAULT_AS_OF, DEFAULT_PERIOD_START
        from perkspark.sources.csv import raw_csv_files

        files = raw_csv_files(spark, args.csv)
        customers, offers, events = (files[name].rows() for name in ("customers", "offers", "events"))
        pipeline = LoyaltyPipeline(
            customers,
            offers,
            events,
            as_of=args.as_of or DEFAULT_AS_OF,
            period_start=args.period_start or DEFAULT_PERIOD_START,
            strict_quotes=args.strict_quotes,
        )
    else:
        pipeline = LoyaltyPipeline.from_warehouse(spark, args.warehouse)
    databases = {layer: args.database_prefix + layer for layer in (LAYER_RAW, LAYER_CLEANSED, LAYER_METRICS)}
    LayerRunner(spark, pipeline, databases, args.format, args.buckets, files).run().show(truncate=False)


if __name__ == "__main__":
    main()
