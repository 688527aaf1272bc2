"""Bronze to silver: rename by layout, clean, judge by contract, write valid rows and quarantine."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.cleaning import clean_key, parse_month, parse_number, zero_to_null
from tidemark.operators.contract import audit, judge, observed, snapshot_rules, split
from tidemark.operators.panel import pick_first
from tidemark.operators.sizes import broadcast_if_small
from tidemark.sources.files import names_in, read_dialects, scan_csv, union_by_name
from tidemark.sources.registry import Registry

# Canonical columns by type; all others are text.
NUMBERS = (
    "anio", "anios_he", "aprobado", "aprobado_pef_2017", "avance_fisico", "costo_total_inversion", "ejercido", "estatal", "fideicomiso",
    "fiscal", "id_entidad_federativa", "id_ppi", "id_ur", "latitud", "longitud", "modificado", "monto_asignacion_actual",
    "monto_operacion_mantenimiento", "monto_total_inversion", "municipal", "otros", "otros_costos", "pef", "ppef", "privada", "propio",
    "total_gasto_no_considerado", "total_gasto_operacion_he",
)
WHOLE = ("id_ramo",)
MONTHLY = ("fecha_inicio_cal_ff", "fecha_fin_cal_ff", "fecha_inicio_cal_fiscal", "fecha_fin_cal_fiscal")
#: Folders of the rows that keep the contract and of those that don't.
STATES = ("valid", "quarantine")
AUDIT = T.StructType(
    [
        T.StructField("snapshot_id", T.StringType()), T.StructField("sha256", T.StringType()), T.StructField("n_rows", T.LongType()), T.StructField("n_valid", T.LongType()),
        T.StructField("n_quarantined", T.LongType()), T.StructField("pct_valid", T.DoubleType()), T.StructField("fechas_no_parseadas", T.LongType()),
        T.StructField("motivos", T.MapType(T.StringType(), T.LongType())),
    ]
)
REQUIRED = ("cve_cartera", "anio", "avance_fisico", "latitud", "longitud", "monto_total_inversion")


def column_type(name: str) -> T.DataType:
    if name in NUMBERS:
        return T.DoubleType()
    if name in WHOLE:
        return T.LongType()
    return T.DateType() if name in MONTHLY else T.StringType()


def silver_schema(columns: Sequence[str]) -> T.StructType:
    """One fixed type per canonical column, so files of all layouts unite without conflicts."""
    return T.StructType([T.StructField(c, column_type(c)) for c in dict.fromkeys([*REQUIRED, *columns, "snapshot_id"])])


def clean_rows(raw: DataFrame, rename: dict[str, str], snapshot: Column) -> DataFrame:
    """Canonical names and types from text columns; unmapped columns pass, required ones are added as null.

    ``_unparsed`` counts a row's dates that no dialect explains.
    """
    df = raw.withColumnsRenamed({a: b for a, b in rename.items() if a in raw.columns})
    for c in REQUIRED:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    cleaned: dict[str, Column] = {"cve_cartera": clean_key(F.col("cve_cartera")), "snapshot_id": snapshot}
    unparsed = F.lit(0)
    for c in df.columns:
        if c in MONTHLY:
            cleaned[c] = parse_month(F.col(c))
            unparsed = unparsed + (F.col(c).isNotNull() & parse_month(F.col(c)).isNull()).cast("int")
        elif c in WHOLE:
            cleaned[c] = parse_number(F.col(c)).try_cast("long")
        elif c in NUMBERS:
            number = parse_number(F.col(c))
            cleaned[c] = zero_to_null(number) if c in ("latitud", "longitud") else number
    return df.withColumns({"_unparsed": unparsed}).withColumns(cleaned)


def pending_snapshots(manifest: DataFrame) -> DataFrame:
    """The first record of each snapshot that declares a year, in the manifest's order."""
    rows = manifest.withColumn("_at", F.monotonically_increasing_id()).where(F.col("corte_declarado.anio").isNotNull())
    return pick_first(rows, ["snapshot_id"], [F.col("_at")]).drop("_at")


@dataclass
class SilverRun:
    """The judged rows of a run's files, what could not be read, and the (snapshot_id, sha256) that it covers."""

    judged: DataFrame
    failed: list[tuple[str, str, str]]
    snapshots: list[tuple[str, str | None]] = field(default_factory=list)

    @property
    def valid(self) -> DataFrame:
        return split(self.judged)[0].drop("_unparsed")

    @property
    def quarantine(self) -> DataFrame:
        return split(self.judged)[1].drop("_unparsed")


class LostRows(RuntimeError):
    """What was written is not what was judged."""


def normalise(spark: SparkSession, registry: Registry, manifest: DataFrame, bronze: str, done: DataFrame | None = None) -> SilverRun:
    """One scan per layout, encoding and separator, however many files; executors read the files' heads.

    A row's snapshot comes from the name of its file, by a broadcast of the manifest's file names. Snapshots
    known to be corrupt, of an unknown layout or without a file are reported and left out; the caller decides
    whether that is an error. Snapshots in ``done`` (snapshot_id, sha256) are left alone, unless their content
    is another one. The manifest is a catalogue of files, so its rows are listed.
    """
    pending = pending_snapshots(manifest)
    if done is not None:
        same = (F.col("snapshot_id") == F.col("_id")) & F.col("sha256").eqNullSafe(F.col("_sha"))
        pending = pending.join(done.select(F.col("snapshot_id").alias("_id"), F.col("sha256").alias("_sha")), same, "left_anti")
    covered: list[tuple[str, str | None]] = []
    groups: dict[tuple, list[tuple[str, str]]] = {}
    failed: list[tuple[str, str, str]] = []
    there = names_in(spark, bronze)
    chosen = []
    for r in pending.select("snapshot_id", "sha256", "archivo_bronze", "header_hash", "encoding_detectado").toLocalIterator():
        name = r["archivo_bronze"]
        if name in registry.corrupt:
            failed.append((r["snapshot_id"], name, "corrupto_conocido"))
        elif r["header_hash"] not in registry.layouts:
            failed.append((r["snapshot_id"], name, "esquema_desconocido"))
        elif name not in there:
            failed.append((r["snapshot_id"], name, "error"))
        else:
            chosen.append(r)
    texts = {r["archivo_bronze"]: r["encoding_detectado"] or "utf-8" for r in chosen if not r["archivo_bronze"].lower().endswith(".xlsx")}
    heads = {r["name"]: r for r in read_dialects(spark, [f"{bronze}/{name}" for name in texts], texts).toLocalIterator()} if texts else {}
    for r in chosen:
        name = r["archivo_bronze"]
        if name not in texts:
            key = (r["header_hash"], "xlsx", None, tuple(registry.layouts[r["header_hash"]]))
        elif name in heads:
            key = (r["header_hash"], texts[name], heads[name]["separator"], tuple(heads[name]["columns"] or ()))
        else:
            failed.append((r["snapshot_id"], name, "error"))
            continue
        covered.append((r["snapshot_id"], r["sha256"]))
        groups.setdefault(key, []).append((name, r["snapshot_id"]))
    frames = []
    for (hash_, encoding, separator, header), files in groups.items():
        paths = [f"{bronze}/{name}" for name in dict.fromkeys(name for name, _ in files)]
        if encoding == "xlsx":
            from tidemark.sources.xlsx import scan_xlsx

            raw = scan_xlsx(spark, paths, list(header), file="_file")
        else:
            raw = scan_csv(spark, paths, list(header), separator, encoding, file="_file")
        owners = broadcast_if_small(spark.createDataFrame(files, "_name string, _snapshot string"))
        rows = raw.join(owners, F.col("_file") == F.col("_name")).drop("_file", "_name")
        frames.append(clean_rows(rows, registry.layouts[hash_], F.col("_snapshot")).drop("_snapshot"))
    if not frames:
        frames = [spark.createDataFrame([], T.StructType([*silver_schema([]).fields, T.StructField("_unparsed", T.IntegerType())]))]
    return SilverRun(judge(union_by_name(frames), snapshot_rules()), failed, covered)


def written_snapshots(spark: SparkSession, path: str) -> DataFrame | None:
    """(snapshot_id, sha256) that earlier runs have finished; None before the first."""
    if not names_in(spark, f"{path}/audit"):
        return None
    return spark.read.schema(AUDIT).parquet(f"{path}/audit").select("snapshot_id", "sha256")


def _forget(spark: SparkSession, folders: Sequence[str]) -> None:
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def write_silver(run: SilverRun, path: str) -> SilverRun:
    """Replaces the run's snapshots below ``path``, and no others: rows by state and snapshot, and an audit record of each.

    One job writes valid rows and quarantine; Spark splits the rows of a large snapshot over several tasks and
    gathers those of small ones. The same job counts rows, breaches and unparsed dates; the audit, one
    aggregate over what was written, must agree with it. A snapshot's audit record is dropped first and written last,
    so a run that breaks off is done again for the snapshots it had not finished.
    """
    spark, rules = run.judged.sparkSession, snapshot_rules()
    _forget(spark, [f"{path}/audit/snapshot_id={i}" for i, _ in run.snapshots])
    _forget(spark, [f"{path}/rows/estado={state}/snapshot_id={i}" for i, _ in run.snapshots for state in STATES])
    if not run.snapshots:
        return run
    state = F.when(F.size("reasons") == 0, STATES[0]).otherwise(STATES[1])
    dealt = run.judged.withColumn("estado", state).hint("rebalance", "estado", "snapshot_id")
    rows, seen = observed(dealt, rules, ["_unparsed"])
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("estado", "snapshot_id").parquet(f"{path}/rows")
    own = broadcast_if_small(spark.createDataFrame(run.snapshots, "snapshot_id string, sha256 string"))
    ids = [i for i, _ in run.snapshots]
    written = spark.read.schema(T.StructType([*run.judged.schema.fields, T.StructField("estado", T.StringType())])).parquet(f"{path}/rows").where(F.col("snapshot_id").isin(ids))
    counts = audit(written, ["snapshot_id"], rules, ["_unparsed"]).withColumnRenamed("_unparsed", "fechas_no_parseadas")
    # a file without rows has a record too, so that it counts as done
    records = own.join(counts, "snapshot_id", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_rows", "n_valid", "n_quarantined", "fechas_no_parseadas")})
    records = records.select([F.col(f.name).cast(f.dataType) for f in AUDIT]).collect()
    got, want = seen.get, {c: sum(r[c] for r in records) for c in ("n_rows", "n_valid")}
    if any(got[c] != n for c, n in want.items()):
        raise LostRows(f"judged {got['n_rows']} rows, {got['n_valid']} of them valid, but wrote {want['n_rows']} and {want['n_valid']}")
    spark.createDataFrame(records, AUDIT).coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("snapshot_id").parquet(f"{path}/audit")
    return run
