"""Core tables of all snapshots at once, from raw tables that carry snapshot_id; and what of raw reports counts for them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import name_key
from . import core
from .core import S

# The raw tables that a model's core tables are made of.
DAM_RAW = ("psse_bus", "psse_branch", "psse_transformer", "psse_load", "dam_lines", "dam_transformers", "dam_generators", "dam_loads", "dam_settlement_points", "dam_hub_buses", "dam_contingencies")
CRR_RAW = ("psse_bus", "psse_branch", "psse_transformer", "psse_load", "crr_mapping_autos", "crr_mapping_lines", "crr_sources_and_sinks", "crr_monitored_lines_and_transformers", "crr_contingencies", "crr_non_thermal_constraints")
#: In the order that awards take them.
AWARD_RAW = ("dam_60d_gen_resource_data", "dam_60d_esr_data", "dam_60d_energy_only_offer_awards", "dam_60d_energy_bid_awards", "dam_60d_ptp_obligation_bid_awards", "dam_60d_ptp_obligation_option_awards")


class MissingTables(ValueError):
    """Raw tables that haven't been built yet."""


def of_snapshots(raw: DataFrame, snapshots: DataFrame, by: str) -> DataFrame:
    """Rows of a package's raw table with the snapshot that each belongs to, by its ``hour`` or ``month``."""
    return raw.drop(S).join(snapshots.where(F.col(by).isNotNull()).select("blob_sha256", by, S), ["blob_sha256", by])


def _all(raw: dict[str, DataFrame], names: tuple[str, ...]) -> list[DataFrame]:
    if lost := [n for n in names if n not in raw]:
        raise MissingTables(f"not built: {', '.join(lost)}")
    return [raw[n] for n in names]


def dam_tables(raw: dict[str, DataFrame], limits: DataFrame, crosswalk: DataFrame) -> dict[str, DataFrame]:
    """Core tables of day-ahead models; ``limits`` are the hours' transfer limits."""
    bus, branch, transformer, load, lines, transformers, generators, loads, points, hubs, outages = _all(raw, DAM_RAW)
    buses = core.dam_buses(bus, lines, transformers, generators, loads, points)
    branches, ratings = core.dam_branches(buses, branch, transformer, lines, transformers)
    contingencies, gone = core.dam_contingencies(branches, buses, outages)
    some, weights = core.dam_settlement_points(buses, points, hubs, loads, generators)
    return {"bus": buses, "branch": branches, "branch_rating": ratings, "contingency": contingencies, "contingency_outage": gone, "gtc": core.dam_gtcs(limits, crosswalk), "settlement_point": some, "settlement_point_bus": weights, "load": core.dam_loads(buses, load, loads)}


def crr_tables(raw: dict[str, DataFrame], order: str) -> dict[str, DataFrame]:
    """Core tables of auction models; ``order`` is the column that numbers a constraint table's rows."""
    bus, branch, transformer, load, autos, lines, sources, monitored, outages, constraints = _all(raw, CRR_RAW)
    nodes, buses = core.crr_buses(bus, branch, transformer, autos, sources)
    branches, ratings = core.crr_branches(nodes, branch, transformer, autos, monitored, lines)
    contingencies, gone = core.crr_contingencies(branches, outages)
    gtcs, members = core.crr_gtcs(branches, constraints, order)
    points, weights = core.crr_settlement_points(nodes, sources)
    return {"bus": buses, "node": nodes, "branch": branches, "branch_rating": ratings, "contingency": contingencies, "contingency_outage": gone, "gtc": gtcs, "gtc_member": members, "settlement_point": points, "settlement_point_bus": weights, "load": core.crr_loads(nodes, load)}


def latest_by_day(rows: DataFrame, day: str = "delivery_date") -> DataFrame:
    """Rows of each day's latest posting alone (doc_id, posted_at; no time is earliest, of equal times the longer and larger id)."""
    order = F.struct(F.col("posted_at").isNotNull(), "posted_at", F.length(F.col("doc_id").cast("string")), "doc_id")
    newest = rows.groupBy(day).agg(F.max_by("doc_id", order).alias("doc_id"))
    return rows.join(newest, [day, "doc_id"], "left_semi")


def overrides(spark, path: str, columns: list[str]) -> DataFrame:
    """A small hand-kept table: delimited text with a header, lines that begin with # left out."""
    return spark.read.option("header", "true").option("comment", "#").schema(", ".join(f"`{c}` string" for c in columns)).csv(path)


class UnknownLabels(ValueError):
    """Labels that no register has."""


def registered(rows: DataFrame, column: str, known: list[str]) -> DataFrame:
    """``rows``, if every label of a column is one of ``known``; a handful of the others is named in the error."""
    other = [r[0] for r in rows.where(F.col(column).isNotNull() & ~F.col(column).isin(known)).select(column).distinct().limit(5).collect()]
    if other:
        raise UnknownLabels(f"{column}: {', '.join(map(str, sorted(other)))}")
    return rows


def in_order(df: DataFrame, *by: str) -> DataFrame:
    """Rows in one order, nulls last, for what is written out or shown."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in by])


def sample(df: DataFrame, ident: str, n: int, seed: int = 1) -> DataFrame:
    """``n`` rows that any engine draws alike: those whose digests of seed and id are the smallest."""
    return df.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(ident).cast("string"))), ident).limit(n)


def stable_keys(before: DataFrame, after: DataFrame, key: str, by: str = "model") -> DataFrame:
    """by, kept, gone, new: keys of one model's revision against the one before."""
    a, b = (df.select(by, key).distinct().withColumn(f"__{i}", F.lit(1)) for i, df in enumerate((before, after)))
    one, two = F.col("__0").isNotNull(), F.col("__1").isNotNull()
    return a.join(b, [by, key], "full").groupBy(by).agg(F.count_if(one & two).alias("kept"), F.count_if(one & ~two).alias("gone"), F.count_if(~one & two).alias("new"))


def same_names(a: DataFrame, b: DataFrame, left: str, right: str) -> DataFrame:
    """how, n: names of one table that another has as they are, by letters and digits only, or not at all."""
    mine = a.select(F.col(left).alias("__x"), name_key(F.col(left)).alias("__k")).where("__x is not null").distinct()
    theirs = b.select(F.col(right).alias("__y")).where("__y is not null").distinct()
    plain = theirs.select(name_key(F.col("__y")).alias("__k")).distinct().withColumn("__alike", F.lit(True))
    df = mine.join(theirs, F.col("__x") == F.col("__y"), "left").join(plain, "__k", "left")
    return df.groupBy(F.when(F.col("__y").isNotNull(), "exact").when(F.col("__alike"), "normalized").otherwise("none").alias("how")).agg(F.count("*").alias("n"))


def revisions(rows: DataFrame, model: str, revision: str, entity: str, *attributes: str) -> DataFrame:
    """model, revision, kept, changed, new, gone: entities of each revision of a model against those of the one before it.

    An entity is kept if the set of its attributes' rows is the same, in whatever order and however often they are written. ``gone`` are those
    that the revision before had. The first revision of a model isn't listed. All consecutive revisions are compared in one window by entity.
    """
    order = Window.partitionBy(model).orderBy(revision)
    index = rows.select(model, revision).where(F.col(revision).isNotNull()).distinct().withColumns({"__i": F.row_number().over(order), "__next": F.lead(revision).over(order)})
    each = rows.select(model, revision, entity, *attributes).where(F.col(entity).isNotNull()).distinct()
    digest = F.xxhash64(*attributes) if attributes else F.lit(0).cast("bigint")
    sets = each.groupBy(model, revision, entity).agg(F.count("*").alias("__n"), F.bit_xor(digest).alias("__x"), F.sum(F.pmod(F.xxhash64(digest, F.lit(7)), F.lit(1 << 40))).alias("__s"))
    w = Window.partitionBy(model, entity).orderBy("__i")
    state = F.struct("__n", "__x", "__s")
    df = sets.join(index, [model, revision]).withColumns({"__before": F.lag("__i").over(w), "__was": F.lag(state).over(w), "__after": F.lead("__i").over(w)})
    met = F.coalesce(F.col("__before") == F.col("__i") - 1, F.lit(False))
    here = df.where("__i > 1").select(model, revision, F.when(~met, "new").when(F.col("__was") == state, "kept").otherwise("changed").alias("what"))
    lost = df.where(F.col("__next").isNotNull() & (F.col("__after").isNull() | (F.col("__after") > F.col("__i") + 1))).select(model, F.col("__next").alias(revision), F.lit("gone").alias("what"))
    count = here.unionByName(lost).groupBy(model, revision).agg(*[F.count_if(F.col("what") == k).alias(k) for k in ("kept", "changed", "new", "gone")])
    every = index.where("__i > 1").select(model, revision)
    return every.join(count, [model, revision], "left").fillna(0, ["kept", "changed", "new", "gone"])


def unique_names(rows: DataFrame, model: str, revision: str, name: str) -> DataFrame:
    """Rows whose name no other row of their revision has: names that can tell one thing from another."""
    w = Window.partitionBy(model, revision, name)
    return rows.where(F.col(name).isNotNull()).withColumn("__same", F.count("*").over(w)).where("__same = 1").drop("__same")
