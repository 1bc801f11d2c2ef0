"""An archive in a shared folder: files in, typed raw tables, keyed core tables, and the pairs and networks made of them."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import assembly, build, core, match, measures
from .operators.core import S
from .operators.relational import latest, net_by_kind
from .sources import archive, files, layouts, packages
from .workers import ship

#: What stands for a table where all of a package were built at once.
EVERY = "*"
ARTIFACT = "artifact_key string, emil_id string, blob_sha256 string, table string, version string"


class Session:
    """``root`` is a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, root: str):
        ship(spark)
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, *parts: str) -> str:
        return "/".join((self.root, *parts))

    def _scan(self, *parts: str) -> DataFrame | None:
        try:
            return archive.scan(self.spark, self._path(*parts))
        except AnalysisException as e:
            if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    # Files and raw tables

    def ingest(self, path: str, emil_id: str) -> None:
        """Archives the files below a folder as members, one partition a package; the same bytes are written once, however often they come."""
        found = files.members(files.documents(self.spark, path).dropDuplicates(["blob_sha256"])).withColumn("emil_id", F.lit(emil_id))
        archive.write(found, self._path("members"), ["emil_id", "blob_sha256"])

    def packages(self) -> DataFrame:
        """emil_id, blob_sha256 and the sorted member paths."""
        return archive.scan(self.spark, self._path("members")).groupBy("emil_id", "blob_sha256").agg(F.array_sort(F.collect_set("member_path")).alias("members"))

    def artifacts(self) -> DataFrame:
        found = self._scan("artifacts")
        return self.spark.createDataFrame([], ARTIFACT) if found is None else found

    def build_raw(self, table: str, pattern: str, parse: Callable[[DataFrame], DataFrame], version: str) -> None:
        """Parses the members that fit ``pattern`` in packages that this version hasn't done yet; packages without one count as done. If the job fails, nothing is recorded and the next build does them again."""
        members = archive.scan(self.spark, self._path("members"))
        todo = archive.pending(members.select("emil_id", "blob_sha256").distinct(), self.artifacts(), version, table)
        some = members.join(todo, ["emil_id", "blob_sha256"], "left_semi").where(F.col("member_path").rlike(pattern))
        done = todo.select("artifact_key", "emil_id", "blob_sha256", F.lit(table).alias("table"), F.lit(version).alias("version"))
        planned = self._path("_planned", table)
        done.write.mode("overwrite").parquet(planned)
        archive.write(parse(some), self._path("raw", table), ["emil_id", "blob_sha256"])
        self.spark.read.schema(ARTIFACT).parquet(planned).write.mode("append").parquet(self._path("artifacts"))

    def build_packages(self, emil_id: str, version: str) -> int:
        """Parses all members of a product's packages that this version hasn't done yet, all tables in one job; returns how many. If the job fails, nothing is recorded."""
        members = archive.scan(self.spark, self._path("members")).where(F.col("emil_id") == emil_id)
        todo = archive.pending(members.select("emil_id", "blob_sha256").distinct(), self.artifacts(), version, EVERY)
        done = todo.select("artifact_key", "emil_id", "blob_sha256", F.lit(EVERY).alias("table"), F.lit(version).alias("version"))
        planned = self._path("_planned", emil_id)
        done.write.mode("overwrite").parquet(planned)
        done = self.spark.read.schema(ARTIFACT).parquet(planned)
        n = done.count()
        if n:
            some = members.join(done, ["emil_id", "blob_sha256"], "left_semi")
            archive.write(packages.parsed(some, layouts.PRODUCTS[emil_id]), self._path("rows"), ["emil_id", "table", "blob_sha256"])
            done.write.mode("append").parquet(self._path("artifacts"))
        return n

    def raw(self, table: str, family: str | None = None) -> DataFrame:
        """A table of all packages: one that was built by itself, or what ``build_packages`` has of it, of all products of its families (or of one)."""
        if (own := self._scan("raw", table)) is not None:
            return own
        rows = self._scan("rows")
        families = {f: [e for e, x in layouts.PRODUCTS.items() if x == f] for f in layouts.families_of(table) if family in (None, f)}
        if rows is None or not families:
            raise KeyError(f"{table!r} isn't built")
        found = [packages.typed(rows.where(F.col("emil_id").isin(products)), table, f) for f, products in families.items()]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)

    # Core tables

    def write_core(self, table: str, df: DataFrame, run_id: str | None = None) -> None:
        """Writes a core table; with a run's id, what the register measures of it is kept as rows of that run."""
        seen = measures.Observed(df, measures.MEASURES.get(table, {}) if run_id else {})
        archive.write(seen.frame, self._path("core", table), [S], [c for c in df.columns if c != S and df.schema[c].dataType.typeName() not in ("map", "variant")])
        if found := seen.rows():
            rows = self.spark.createDataFrame([(run_id, table, name, value) for name, value in found], "run_id string, table string, measure string, value double")
            rows.write.mode("append").parquet(self._path("measures"))

    def measures(self, run_id: str | None = None) -> DataFrame:
        """run_id, table, measure, value of all runs, or of one."""
        rows = self.spark.read.parquet(self._path("measures"))
        return rows if run_id is None else rows.where(F.col("run_id") == run_id)

    def core(self, table: str) -> DataFrame:
        df = archive.scan(self.spark, self._path("core", table))
        return df.withColumn(S, F.col(S).cast("string")) if S in df.columns else df

    def core_rows(self, table: str, snapshot_id: str) -> DataFrame:
        """One snapshot's rows: only its partition is read."""
        return self.core(table).where(F.col(S) == snapshot_id)

    def snapshot(self, snapshot_id: str) -> dict:
        """One model's row of the snapshots."""
        row = self.core("snapshot").where(F.col(S) == snapshot_id).first()
        if row is None:
            raise KeyError(f"{snapshot_id!r} is no snapshot of this archive")
        return row.asDict()

    def newest(self) -> tuple[str, str]:
        """The newest monthly auction model and hour 12 of the newest day, of their latest revisions."""
        rows = self.core("snapshot")
        crr = rows.where("model_kind = 'monthly'").agg(F.max_by(S, F.struct("month", "revision"))).first()[0]
        dam = rows.where("model_kind = 'dam' and hour = 12").agg(F.max_by(S, F.struct("operating_date", "revision"))).first()[0]
        if crr is None or dam is None:
            raise ValueError("the archive lacks a monthly model or a day's hour 12")
        return crr, dam

    def hour_ids(self, day: str) -> list[str]:
        """The latest revision of each hour of a day (25 at most)."""
        rows = self.core("snapshot").where((F.col("model_kind") == "dam") & (F.col("operating_date") == F.lit(day).cast("date")))
        return [r[1] for r in rows.groupBy("hour").agg(F.max_by(S, "revision")).orderBy("hour").collect()]

    def raw_rows(self, table: str, snapshot_id: str) -> DataFrame:
        """A model's rows of a raw table: those of its package, of its hour or month where the table has one."""
        snap = self.snapshot(snapshot_id)
        rows = self.raw(table).where((F.col("blob_sha256") == snap["blob_sha256"]) & (F.col("emil_id") == snap["emil_id"]))
        for by in ("hour", "month"):
            if snap[by] is not None and by in rows.columns:
                rows = rows.where(F.col(by) == F.lit(snap[by]))
        return rows

    def latest_doc(self, documents: DataFrame) -> DataFrame:
        """emil_id, doc_id: of each product's documents (emil_id, doc_id, posted_at) the one posted last."""
        return latest(documents.select("emil_id", "doc_id", "posted_at"), ["emil_id"], "posted_at", "doc_id").select("emil_id", "doc_id")

    def build_snapshots(self, documents: DataFrame | None = None) -> None:
        """The table of snapshots: a model for each hour or month that a network-model package has a network of. ``documents`` (blob_sha256, doc_id, posted_at) say when
        packages were posted; without them, postings of one model are numbered in the order of their digests."""
        found = []
        for family in ("dam_model", "crr_model"):
            names = [(n, k) for n, k, _ in layouts.FAMILIES[family][2]]
            try:
                bus = self.raw("psse_bus", family).select("emil_id", "blob_sha256", *[n for n, _ in names]).distinct()
            except KeyError:
                continue
            own = {n: F.col(n) for n, _ in names}
            kind = F.lit("dam") if family == "dam_model" else F.col("auction")
            found.append(bus.select("emil_id", "blob_sha256", kind.alias("kind"), *[own.get(n, F.lit(None).cast(k)).alias(n) for n, k in (("operating_date", "date"), ("hour", "bigint"), ("month", "date"), ("term", "string"), ("sequence", "bigint"))]))
        if not found:
            raise KeyError("no package with a network model is built")
        by = ["emil_id", "blob_sha256", "kind", "operating_date", "term", "sequence"]
        some = reduce(DataFrame.unionByName, found).groupBy(*by).agg(F.collect_set("hour").alias("hours"), F.collect_set("month").alias("months"))
        if documents is None:
            some = some.withColumns({"doc_id": F.lit(None).cast("string"), "posted_at": F.lit(None).cast("timestamp")})
        else:
            some = some.join(documents.select("blob_sha256", "doc_id", "posted_at").dropDuplicates(["blob_sha256"]), "blob_sha256", "left")
        self.write_core("snapshot", core.snapshots(some))

    def _limits(self, snaps: DataFrame) -> DataFrame:
        """Limits of each hourly snapshot's hour, from the latest workbook of its day."""
        rows = self._scan("raw", "gtl_hourly")
        if rows is None:
            return self.spark.createDataFrame([], f"{S} string, market string, gtc_name string, limit_mw double, interval_start_utc timestamp")
        return build.latest_by_day(rows).join(snaps.select(S, "interval_start_utc"), "interval_start_utc")

    def build_core(self, kind: str, limits: DataFrame | None = None, crosswalk: DataFrame | None = None, order: str = "row_number", run_id: str | None = None) -> list[str]:
        """Builds the core tables of all ``dam`` or auction (``crr``) snapshots from the raw ones, and returns their names.

        ``limits``: snapshot_id, market, gtc_name, limit_mw, interval_start_utc, by default those of the archive's workbooks; ``crosswalk``: gtl_name, crr_gtc_id,
        by default none. Raw tables that aren't built are an error.
        """
        snaps = self.core("snapshot").where(F.col("model_kind") == "dam" if kind == "dam" else F.col("model_kind") != "dam")
        names, by, family = (build.DAM_RAW, "hour", "dam_model") if kind == "dam" else (build.CRR_RAW, "month", "crr_model")
        raw = {}
        for n in names:
            try:
                raw[n] = build.of_snapshots(self.raw(n, family), snaps, by)
            except KeyError:
                continue
        if kind == "dam":
            none = self.spark.createDataFrame([], "gtl_name string, crr_gtc_id string")
            tables = build.dam_tables(raw, self._limits(snaps) if limits is None else limits, none if crosswalk is None else crosswalk)
        else:
            tables = build.crr_tables(raw, order)
        for name, df in tables.items():
            self.write_core(name, df, run_id)
        return list(tables)

    def build_awards(self, disclosure: str = "NP3-966-ER") -> None:
        """Hourly signed awards of all disclosure packages, a partition for each."""
        found = [self.raw(t).withColumn("doc_id", F.col("blob_sha256")) for t in build.AWARD_RAW]
        rows = core.hourly_awards(*found).withColumn("emil_id", F.lit(disclosure)).withColumnRenamed("doc_id", "blob_sha256")
        archive.write(rows, self._path("core", "hourly_award"), ["blob_sha256"])

    # Runs and reports

    def record_run(self, run_id: str, command: str, state: str, failed: int = 0) -> None:
        """Appends a run's state; its latest one counts."""
        row = self.spark.range(1).select(F.lit(run_id).alias("run_id"), F.lit(command).alias("command"), F.lit(state).alias("state"), F.lit(failed).alias("failed"), F.current_timestamp().alias("at"))
        row.write.mode("append").parquet(self._path("runs"))

    def runs(self) -> DataFrame:
        rows = self.spark.read.parquet(self._path("runs"))
        return rows.groupBy("run_id").agg(F.max_by(F.struct("command", "state", "failed", "at"), "at").alias("x")).select("run_id", "x.*")

    def write_report(self, name: str, report: DataFrame, by: str = S) -> None:
        """A report as JSON lines, a folder for each snapshot or day."""
        report.repartition(by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).json(self._path("reports", name))

    def query(self, sql: str, **tables: DataFrame) -> DataFrame:
        """SQL over frames under the names they are given."""
        return self.spark.sql(sql, **tables)

    # Pairs

    def _pair(self, crr: str, dam: str) -> tuple[Callable[[str], DataFrame], Callable[[str], DataFrame]]:
        def side(ident: str) -> Callable[[str], DataFrame]:
            return lambda table: self.core_rows(table, ident).drop(S).withColumn(match.P, F.lit(f"{crr}|{dam}"))

        return side(crr), side(dam)

    def match_branches(self, crr: str, dam: str, lines: DataFrame, autos: DataFrame) -> DataFrame:
        """``lines`` and ``autos`` are the mapping rows of the auction model."""
        a, b = self._pair(crr, dam)
        pair = F.lit(f"{crr}|{dam}")
        return match.match_branches(a("branch"), lines.withColumn(match.P, pair), autos.withColumn(match.P, pair), b("branch"))

    def match_buses(self, crr: str, dam: str, branches: DataFrame) -> DataFrame:
        a, b = self._pair(crr, dam)
        return match.match_buses(a("bus"), b("bus"), a("branch"), b("branch"), branches)

    def match_contingencies(self, crr: str, dam: str, branches: DataFrame) -> DataFrame:
        a, b = self._pair(crr, dam)
        return match.match_contingencies(a("contingency_outage"), b("contingency_outage"), branches)

    def diff_branches(self, crr: str, dam: str, branches: DataFrame, time_of_use: str = "PeakWD") -> DataFrame:
        a, b = self._pair(crr, dam)
        return match.diff_branches(branches, a("branch"), a("bus"), a("branch_rating"), b("branch"), b("bus"), b("branch_rating"), time_of_use)

    def diff_settlement_points(self, crr: str, dam: str, buses: DataFrame) -> DataFrame:
        a, b = self._pair(crr, dam)
        return match.diff_settlement_points(a("settlement_point"), a("settlement_point_bus"), b("settlement_point"), b("settlement_point_bus"), buses)

    def diff_loads(self, crr: str, dam: str, buses: DataFrame) -> DataFrame:
        a, b = self._pair(crr, dam)
        return match.diff_loads(a("load"), b("load"), buses)

    # Networks and injections

    def network(self, snapshot_ids: list[str] | None = None, options: assembly.Options = assembly.Options()) -> assembly.Network:
        """Networks of the named snapshots, or of all."""

        def rows(table: str) -> DataFrame:
            df = self.core(table) if self._scan("core", table) is not None else core.empty(self.spark, table)
            return df if snapshot_ids is None else df.where(F.col(S).isin(snapshot_ids))

        return assembly.build_network(*[rows(t) for t in ("bus", "node", "branch", "branch_rating", "contingency_outage", "gtc_member", "settlement_point_bus")], options)

    def injections(self, awards: DataFrame, kinds: list[str]) -> DataFrame:
        """Net megawatts by hour and point, from the latest posting of each delivery day (awards have posted_at and doc_id)."""
        newest = latest(awards.select("delivery_date", "posted_at", "doc_id").distinct(), ["delivery_date"], "posted_at", "doc_id").select("delivery_date", "doc_id")
        return net_by_kind(awards.join(newest, ["delivery_date", "doc_id"], "left_semi"), ["interval_start_utc", "delivery_date", "hour_ending", "settlement_point"], kinds)
