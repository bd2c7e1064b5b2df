"""Reference (dimension) loads: read, stamp, insert-only merge, report.

Targets are either catalog tables (``name``) or storage paths
(``path:<uri>``).  Loads are append-only: existing keys are never updated.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fleetpulse.config import ReferenceSpec
from fleetpulse.sources.tables import path_exists

PATH_PREFIX = "path:"


def read_reference(spark: SparkSession, location: str, spec: ReferenceSpec) -> DataFrame:
    """Read one reference file.

    CSV columns go by their names in the header, in any order: those that
    ``spec.schema`` names get its types (NULL where a file lacks them or a
    value does not fit), all others stay as text, so ids and colours keep
    their leading zeros.  Only a spec without any schema, which none of the
    shipped ones is, has its types inferred.
    """
    reader = spark.read.options(**spec.options)
    if spec.fmt == "csv":
        raw = reader.option("header", "true").option("inferSchema", not spec.schema).csv(location)
        known = {f.name: f.dataType for f in StructType.fromDDL(spec.schema)} if spec.schema else {}
        typed = [F.col(f"`{c}`").try_cast(known[c]).alias(c) if c in known else F.col(f"`{c}`")
                 for c in raw.columns]
        lacking = [F.lit(None).cast(t).alias(c) for c, t in known.items() if c not in raw.columns]
        return raw.select(*typed, *lacking)
    if spec.schema:
        reader = reader.schema(spec.schema)
    if spec.fmt == "json":
        return reader.json(location)
    return reader.format(spec.fmt).load(location)


def add_load_metadata(df: DataFrame, source_file: str) -> DataFrame:
    """Stamp the file name, the load instant and the load date."""
    return df.withColumns({
        "source_file": F.lit(source_file),
        "ingestion_timestamp": F.current_timestamp(),
        "load_date": F.current_date(),
    })


def _is_path(target: str) -> bool:
    return target.startswith(PATH_PREFIX)


def _path(target: str) -> str:
    return target[len(PATH_PREFIX):]


def target_exists(spark: SparkSession, target: str) -> bool:
    if not _is_path(target):
        return spark.catalog.tableExists(target)
    return path_exists(spark, _path(target))


# A target laid out by key has a partition column of this name and its number
# of parts, a hash of the merge key modulo that number.
KEY_PART = "_key_part_"


def part_column(target: DataFrame) -> str | None:
    return next((c for c in target.columns if c.startswith(KEY_PART)), None)


def key_part(keys: Sequence[str], column: str) -> Column:
    """The part of a key (NULLs included)."""
    return F.pmod(F.xxhash64(*keys), F.lit(int(column[len(KEY_PART):]))).cast("int")


def _read(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(_path(target)) if _is_path(target) else spark.read.table(target)


def read_target(spark: SparkSession, target: str) -> DataFrame:
    out = _read(spark, target)
    part = part_column(out)
    return out.drop(part) if part else out


def _write(df: DataFrame, target: str, mode: str) -> None:
    part = part_column(df)
    # one task a part, so that a load adds one file to each part it touches
    writer = (df.repartition(part).write.partitionBy(part) if part else df.write).mode(mode)
    if _is_path(target):
        writer.parquet(_path(target))
    else:
        writer.saveAsTable(target)


def new_rows(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key has no equal in the target.

    Equality is SQL ``=``: a NULL key never matches, so such rows are new
    on every load - the behaviour of a ``t.k = s.k`` merge condition.
    Duplicates inside the source are all kept, as that merge keeps them.
    """
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    # rows with a NULL key are new by definition: keep them out of the
    # shuffle, where they would all land on one reducer
    keyed = source.filter(~any_null)
    cond = [keyed[k] == target[k] for k in keys]
    # files of repeated keys are small, their rows are not: by the size of its
    # files, the target would be gathered in the driver to be broadcast
    held = target.select(*keys).hint("shuffle_merge")
    return keyed.join(held, cond, "left_anti").unionByName(
        source.filter(any_null))


def touched_parts(existing: DataFrame, source: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """A target laid out by key, cut to the parts that the source's keys fall
    into (the scan leaves the others out), and the source with its parts."""
    part = part_column(existing)
    kinds = {f.name: f.dataType for f in existing.schema}
    source = source.select(*[F.col(c).cast(kinds[c]).alias(c) for c in source.columns if c in kinds],
                           *[c for c in source.columns if c not in kinds])
    source = source.withColumn(part, key_part(keys, part))
    parts = [r[0] for r in source.select(part).distinct().collect()]        # at most the number of parts
    return existing.filter(F.col(part).isin(parts)), source


def insert_only_merge(spark: SparkSession, source: DataFrame, target: str,
                      keys: Sequence[str], parts: int | None = None) -> str:
    """Create the target on first load, else append only unseen keys.

    Returns the action taken (``created`` / ``merged``).  The anti join is
    a shuffle join, so it scales with both sides and no table passes through
    the driver; appends never rewrite existing files.  With
    ``parts``, a new target is laid out by a hash of the key, and later merges
    read only the parts that their keys fall into.
    """
    if not target_exists(spark, target):
        if parts:
            source = source.withColumn(f"{KEY_PART}{parts}", key_part(keys, f"{KEY_PART}{parts}"))
        _write(source, target, "errorifexists")
        return "created"
    existing = _read(spark, target)
    held = existing
    if part_column(existing):
        held, source = touched_parts(existing, source, keys)
    fresh = new_rows(source, held, keys)
    # files of one table hold one type for each column, whatever the load has
    _write(fresh.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in existing.schema]), target, "append")
    return "merged"


def load_reference(spark: SparkSession, base: str, specs: Iterable[ReferenceSpec],
                   target_of=lambda spec: spec.table) -> DataFrame:
    """Table-driven load of several reference files; returns the report."""
    report = []
    for spec in specs:
        src = add_load_metadata(read_reference(spark, f"{base.rstrip('/')}/{spec.file_name}", spec),
                                spec.file_name)
        target = target_of(spec)
        action = insert_only_merge(spark, src, target, spec.keys, spec.parts)
        report.append((spec.table, target, action, spec.keys))
    return load_report(spark, {t: read_target(spark, tgt) for t, tgt, _, _ in report},
                       actions={t: a for t, _, a, _ in report},
                       keys={t: ", ".join(k) for t, _, _, k in report})


# The columns of the roster preview.
PREVIEW_COLUMNS = ("vehicleCode", "transportationType", "brand", "model",
                   "productionYear", "seats", "standingPlaces", "floorHeight",
                   "source_file", "ingestion_timestamp")


def preview(spark: SparkSession, table: str, n: int = 20,
            columns: Sequence[str] = PREVIEW_COLUMNS, order_by: str = "vehicleCode") -> DataFrame:
    """First ``n`` rows of a loaded table, in key order (SQL).

    ``ORDER BY .. LIMIT`` plans a per-task top-n before one small merge, so
    the preview never moves the table.
    """
    return spark.sql(f"SELECT {', '.join(columns)} FROM {table} "
                     f"ORDER BY {order_by} LIMIT {int(n)}")


def load_report(spark: SparkSession, tables: dict[str, DataFrame],
                actions: dict[str, str] | None = None,
                keys: dict[str, str] | None = None) -> DataFrame:
    """One row per table: name, row count (and action / key when given).

    Each count is a global aggregate combined map-side; the per-table rows
    are stacked with ``unionByName`` into one result.
    """
    parts = []
    for name, df in tables.items():
        row = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count")
        if actions is not None:
            row = row.withColumn("action", F.lit(actions.get(name)))
        if keys is not None:
            row = row.withColumn("merge_key", F.lit(keys.get(name)))
        parts.append(row)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
