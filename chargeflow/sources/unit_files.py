"""Monthly unit files (CSV of many dialects), written tables, scoring requests."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import to_double
from ..functions.timeparse import parse_local
from ..settings import DEFAULTS, FEATURES, LABEL, MASTER_FIELDS, SLAVE_FIELDS
from ..storage import delete, exists
from ..storage import names as held_files
from .headers import headers

# Accepted headers of each field, in order of preference; other names for a
# field and the candidates among columns, which are two tables elsewhere, in one.
TIME_HEADERS = ["timestamp", "time", "date", "datetime", "dt"]
HEADERS = {
    "soc": ["soc", "avg_soc", "battery_soc", "M_battery_soc"],
    "voltage": ["voltage", "avg_voltage", "M_battery_voltage", "pack_voltage"],
    "current": ["current", "avg_current", "avg_curren", "M_battery_current", "pack_current"],
    "speed": ["speed", "veh_speed", "vehicle_speed", "M_vehicle_speed"],
    "km": ["km", "km_driven", "odometer", "odo_km", "odo", "distance_km", "total_km"],
    "cell_temp": ["cell_temp", "cell_tem"],
    "bms_temp": ["bms_temp"],
    "pack_delta": ["pack_delta", "pack_dlt"],
    "charge_limit": ["charge_limit", "charge_lim"],
    "discharge_limit": ["discharge_limit", "discharge_lim"],
    "soc_slave": ["soc_slave", "slave_soc"],
    "voltage_slave": ["voltage_slave", "slave_voltage"],
    "current_slave": ["current_slave", "slave_current"],
}
SEPARATORS = [",", ";", "\t", "|"]
MONTH_FILE = r"(?i)(\d{4}-\d{2})\.csv$"


def with_month(rows: DataFrame, path: str = "file") -> DataFrame:
    """Adds ``yyyymm`` from the end of a file's name; null without one."""
    return rows.withColumn("yyyymm", F.nullif(F.regexp_extract(path, MONTH_FILE, 1), F.lit("")))


def filter_months(rows: DataFrame, months: Sequence[str] | None) -> DataFrame:
    return rows if not months else rows.filter(F.col("yyyymm").isin(list(months)))


def _dialects(spark: SparkSession, paths: list[str]) -> list[tuple[list[str], str, str, list[str]]]:
    """(files, separator, encoding, names) of each kind of header. One row a file
    comes to the driver: its first line that is neither blank nor a comment."""
    kinds: dict[tuple[str, str], list[str]] = {}
    for r in headers(spark, paths).filter("rows").collect():
        kinds.setdefault((r.head, r.encoding), []).append(r.file)
    out = []
    for (head, encoding), files in sorted(kinds.items()):
        sep = max(SEPARATORS, key=head.count)
        names = [n.strip().strip('"') for n in head.split(sep)]
        out.append((sorted(files), sep, encoding, names))
    return out


def canonical_columns(df: DataFrame, fields: Sequence[str], time_field: str = "ts_raw") -> list[Column]:
    """A column for each field: of the headers present (else, without regard to
    case) those that the field accepts, the first known value; null without."""
    lower = {}
    for c in df.columns:
        lower.setdefault(c.lower(), c)

    def pick(names: list[str]) -> Column:
        found = [n for n in names if n in df.columns] or list(dict.fromkeys(lower[n.lower()] for n in names if n.lower() in lower))
        return F.coalesce(*[F.col(f"`{n}`") for n in found]) if found else F.lit(None).cast("string")

    return [pick(TIME_HEADERS).alias(time_field), *[to_double(pick(HEADERS[f])).alias(f) for f in fields]]


def read_month_csv(spark: SparkSession, paths: list[str], unit: str, vehicle_id: int | None = None, months: Sequence[str] | None = None) -> DataFrame:
    """The samples of one unit's files: ``vehicle_id`` (given, or from a folder
    ``vehicle_id=...``), ``yyyymm``, ``unit``, ``seq`` (file order), ``ts_raw`` and fields.

    Separator, encoding and names go by each file's header line; comment lines,
    blank lines, rows that don't parse, byte-order marks and repeated headers
    are left out; absent fields are null. Numbers that aren't are null.
    """
    fields = MASTER_FIELDS if unit == "master" else [f"{f}_slave" for f in SLAVE_FIELDS]
    parts = []
    for files, sep, encoding, names in _dialects(spark, paths):
        schema = ", ".join(f"`c{i}` string" for i in range(len(names))) + ", _over string"
        reader = spark.read.schema(schema).options(sep=sep, encoding=encoding, comment="#", mode="PERMISSIVE", ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
        if encoding.startswith("UTF-16"):  # whose line ends Spark doesn't guess
            reader = reader.options(lineSep="\n")
        raw = reader.csv(files).select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))
        raw = raw.withColumn("_line", F.monotonically_increasing_id())
        # Rows with more cells than the header are bad; shorter ones are filled with nulls.
        head = F.regexp_replace(F.col("c0"), "﻿", "") == names[0]
        raw = raw.filter(F.col("_over").isNull() & ~F.coalesce(head, F.lit(False)))
        # Names that repeat are told apart, so that each is an alternative.
        own: dict[str, list[str]] = {}
        for i, n in enumerate(names):
            own.setdefault(n, []).append(f"c{i}")
        named = raw.select("_file", "_block", "_line", *[F.coalesce(*[F.col(c) for c in cs]).alias(n) for n, cs in own.items() if n])
        vehicle = F.lit(vehicle_id).cast("long") if vehicle_id is not None else F.regexp_extract("_file", r"vehicle_id=(\d+)", 1).try_cast("long")
        picked = canonical_columns(named, fields)
        rows = with_month(named, "_file").select(vehicle.alias("vehicle_id"), "yyyymm", F.lit(unit).alias("unit"), F.struct(F.col("_file").alias("file"), F.col("_block").alias("block"), F.col("_line").alias("line")).alias("seq"), *picked)
        parts.append(filter_months(rows, months))
    if not parts:
        kinds = ", ".join(f"{f} double" for f in fields)
        return spark.createDataFrame([], f"vehicle_id long, yyyymm string, unit string, seq struct<file:string,block:long,line:long>, ts_raw string, {kinds}")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def unit_samples(master: DataFrame, slave: DataFrame, time_zone: str = DEFAULTS.time_zone) -> DataFrame:
    """Both units' rows with ``ts_local``, in the shape that alignment reads."""
    slave = slave.withColumnsRenamed({f"{f}_slave": f for f in SLAVE_FIELDS})
    rows = master.unionByName(slave, allowMissingColumns=True)
    parsed = parse_local(rows, "ts_raw", "yyyymm", ["vehicle_id", "yyyymm", "unit"], ["seq"], time_zone)
    return parsed.filter("ts_local is not null").drop("ts_raw")


def read_any(spark: SparkSession, path: str) -> DataFrame:
    """A table of features from Parquet, or from CSV by the name's ending."""
    return spark.read.options(header=True, inferSchema=True).csv(path) if path.lower().endswith(".csv") else spark.read.parquet(path)


#: Where the three monthly tables go.
MONTHLY_TABLES = {"curated": "curated/rows", "rct": "features/rct", "soc_intervals": "analytics/soc_intervals"}


def write_monthly(df: DataFrame, path: str, csv: bool = False, months: Sequence[str] | None = None, max_rows: int = 5_000_000) -> None:
    """One folder a month; together they are the whole table. The months of ``df`` are
    replaced, all others stay: a month can be run again, and a rerun leaves what the
    first run left. ``months``: the months that ``df`` stands for; those without rows
    lose their folder, and rows of others are not written. A month's rows are dealt
    over as many tasks as they need, and no file has more than ``max_rows``.
    """
    spark = df.sparkSession
    rows = filter_months(df, months)
    before = {m: held_files(spark, f"{path}/yyyymm={m}") for m in months or ()}
    # New files are staged and take the place of a month's old ones when all are written.
    writer = rows.hint("rebalance", F.col("yyyymm")).write.mode("overwrite").partitionBy("yyyymm").options(partitionOverwriteMode="dynamic", maxRecordsPerFile=max_rows)
    writer.option("header", True).csv(path) if csv else writer.parquet(path)
    for month, old in before.items():
        if old & held_files(spark, f"{path}/yyyymm={month}"):  # nothing took its place
            delete(spark, f"{path}/yyyymm={month}")


def write_months(tables: dict[str, DataFrame], path: str, months: Sequence[str] | None = None) -> None:
    """The monthly tables (MONTHLY_TABLES) of a run, labelled minutes as CSV too."""
    for name, df in tables.items():
        write_monthly(df, f"{path}/{MONTHLY_TABLES[name]}", months=months)
        if name == "rct":
            write_monthly(df, f"{path}/{MONTHLY_TABLES[name]}_csv", csv=True, months=months)


def read_months(spark: SparkSession, path: str, months: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """The consolidated tables that ``write_months`` has written."""
    return {name: consolidate_curated(spark, f"{path}/{place}", months) for name, place in MONTHLY_TABLES.items() if exists(spark, f"{path}/{place}")}


def consolidate_curated(spark: SparkSession, path: str, months: Sequence[str] | None = None) -> DataFrame:
    """All months of a written table, or some of them by their folders alone."""
    rows = spark.read.parquet(path)
    return filter_months(rows.withColumn("yyyymm", F.col("yyyymm").cast("string")), months)


def union_months(tables: list[DataFrame]) -> DataFrame:
    """Months' tables as one; a column that some lack is null there."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def write_training_set(rows: DataFrame, path: str, features: Sequence[str] = FEATURES, label: str = LABEL) -> dict:
    """Writes ``train``, ``val`` and ``test`` as CSV in the order of ``features``,
    the list of features, and a schema with row counts, which it returns."""
    spark = rows.sparkSession
    table = rows.select("split", *features, label)
    table.write.mode("overwrite").partitionBy("split").option("header", True).csv(f"{path}/data")
    counts = {r["split"]: r["count"] for r in rows.groupBy("split").count().collect()}
    schema = {"label": label, "features": list(features), "rows": {s: counts.get(s, 0) for s in ("train", "val", "test")}}
    for name, text in (("feature_list", "\n".join(features)), ("schema", json.dumps(schema))):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/{name}")
    return schema


def parse_scoring_requests(bodies: DataFrame, body: str = "body", features: Sequence[str] = FEATURES) -> DataFrame:
    """A row of features for each instance of each request: JSON with
    ``instances`` or ``inputs``, one JSON object, a JSON list, or lines of CSV
    without header in the order of ``features``. Keeps the requests' columns and
    adds ``instance`` (0, 1, ...). A body that is none of these has no instance."""
    fields = ", ".join(f"`{f}` double" for f in features)
    text = F.trim(body)
    packed = F.from_json(text, f"instances array<struct<{fields}>>, inputs array<struct<{fields}>>")
    listed = F.from_json(text, f"array<struct<{fields}>>")
    single = F.array(F.from_json(text, f"struct<{fields}>"))
    known = F.size(F.array_intersect(F.json_object_keys(text), F.array(*[F.lit(f) for f in features]))) > 0
    lines = F.filter(F.split(text, r"\r?\n"), lambda x: F.trim(x) != "")
    # Cells may be quoted, and hold commas then; what is no number is unknown.
    texts = ", ".join(f"c{i} string" for i in range(len(features)))
    cells = F.transform(lines, lambda x: F.from_csv(x, F.lit(texts), {"ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}))
    from_csv = F.transform(cells, lambda c: F.struct(*[to_double(c[f"c{i}"]).alias(f) for i, f in enumerate(features)]))
    found = F.when(text.startswith("["), listed).when(text.startswith("{"), F.coalesce(packed["instances"], packed["inputs"], F.when(known, single))).otherwise(from_csv)
    rows = bodies.select("*", F.posexplode(found).alias("instance", "_x"))
    return rows.select(*[c for c in rows.columns if c != "_x"], "_x.*")
