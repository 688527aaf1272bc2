"""Silver to gold: staged snapshots, canonical observations, and the eight published tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.urls import product
from tidemark.operators.checks import Check, accepted_values, not_null, relationship, unflagged_fall, unique, unstable_counts
from tidemark.operators.sizes import broadcast_if_small
from tidemark.operators.panel import ascending, canonical_snapshots, catalogue, collapse_grain, deflate, deltas, descending, life_cycle, pick_first, rank_of, snapshot_dimension, versions

SUMS = ("aprobado", "modificado", "ejercido", "monto_total_inversion", "monto_operacion_mantenimiento", "costo_total_inversion", "ppef", "pef")
ATTRIBUTES = (
    "nombre_ppi", "id_ramo", "descripcion_ramo", "descripcion_tipo_ppi", "id_ur", "descripcion_ur", "localizacion", "id_entidad_federativa",
    "entidad_federativa", "latitud", "longitud", "anios_he", "estatus_operacion", "fase",
)
TRACKED = ("nombre_ppi", "id_ramo", "descripcion_tipo_ppi", "id_ur", "localizacion", "id_entidad_federativa", "latitud", "longitud")
CARRIED = ("descripcion_ramo", "descripcion_ur", "entidad_federativa")
REAL = ("modificado", "ejercido", "monto_total_inversion")
# The statuses and types that the source is known to use, spelled as it spells them.
TERMINAL = ("terminado_probable", "salida_no_explicada", "vigente_ultimo_corte_disponible")
STATUSES = (
    "Vigente", "Calendario Fiscal Concluido / Operación", "Calendario Fiscal Concluido/Operación", "En Proceso de Modificación", "Registrado", "Suspendido",
    "En Proceso de Cancelación", "En proceso de cancelación", "Ex Post", "Cancelado", "En Proceso de Registro APP",
)
TYPES = (
    "Proyecto de Inversión de Infraestructura Económica",
    "Proyecto de Inversión de Infraestructura Social",
    "Proyecto de Inversión de Infraestructura Gubernamental",
    "Proyecto de Inversión de Inmuebles",
    "Proyectos de infraestructura",
    "Otros proyectos de Inversión",
    "Otros Programas de Inversión",
    "Otros programas de inversión",
    "Programa de Inversión de Adquisiciones",
    "Programas de adquisiciones",
    "Programa de Inversión de Mantenimiento",
    "Programas de mantenimiento y/o rehabilitación",
    "Programa de mantenimiento de protección civil",
    "Programas de mantenimiento relacionados con protección civil",
    "Programa de adquisición de protección civil",
    "Programa de Estudios de Preinversión",
    "Programa Ambiental",
    "Programa ambiental",
    "Infraestructura económica (PIDIREGAS)",
    "Electricidad, hidrocarburos, comunicaciones y transportes, y agua.",
    "Funciones de desarrollo social, tales como educación, salud, seguridad social, urbanización, vivienda y asistencia social.",
    "Funciones de gobierno, tales como procuración de justicia, seguridad pública, seguridad nacional, y medio ambiente y recursos naturales.",
    "Compra de bienes como extintores, detectores de humo, etc. que no estén asociados a un proyecto de inversión",
    "Compra de bienes muebles no asociados a proyectos de inversión.",
    "Oficinas administrativas.",
    "No Identificados.",
    "No identificados en los rubros anteriores.",
    "Que no impliquen un incremento en la vida útil o en la capacidad de producción de los activos.",
    "Según los lineamientos para el análisis costo y beneficio que entraron en vigor el 01.01.2006",
)
#: The catalogues that come as seeds: key and attributes.
CATALOGUES = {
    "dim_ramo": ("id_ramo", ("descripcion_ramo", "en_catalogo_oficial")),
    "dim_entidad": ("id_entidad_federativa", ("entidad_federativa", "en_catalogo_oficial")),
    "dim_tipo_ppi": ("id_tipo_ppi", ("descripcion_tipo_ppi",)),
}
#: Sort keys under which each table is published.
PUBLISHED = {
    "dim_snapshot": ("snapshot_id",),
    "dim_ramo": ("id_ramo",),
    "dim_entidad": ("id_entidad_federativa",),
    "dim_tipo_ppi": ("id_tipo_ppi",),
    "dim_ppi": ("cve_cartera", "version_ppi"),
    "fct_ppi_observacion": ("cve_cartera", "snapshot_id"),
    "fct_ppi_delta": ("cve_cartera", "snapshot_id"),
    "fct_ppi_ciclo_vida": ("cve_cartera",),
}


def stage_snapshots(manifest: DataFrame) -> DataFrame:
    """One record per snapshot that declares a year, by origin; ties by URL, so the pick is total."""
    cut = manifest.where(F.col("corte_declarado.anio").isNotNull()).select(
        "snapshot_id", "url", "origen", F.col("fecha_descarga").try_cast("date").alias("fecha_descarga"),
        F.col("corte_declarado.anio").try_cast("int").alias("anio"), F.col("corte_declarado.trimestre").try_cast("int").alias("trimestre"),
        "header_hash", "sha256", "bytes",
    )
    named = cut.withColumn("producto", product(F.col("url"), F.col("trimestre")))
    return pick_first(named, ["snapshot_id"], [rank_of(F.col("origen"), ("vivo", "espejo", "wayback")), F.col("url").asc_nulls_last()])


@dataclass
class Gold:
    stg_snapshots: DataFrame
    int_snapshot_canonico: DataFrame
    int_ppi_observaciones_dedup: DataFrame
    int_ppi_observaciones_canonicas: DataFrame
    dim_snapshot: DataFrame
    dim_ppi: DataFrame
    fct_ppi_observacion: DataFrame
    fct_ppi_delta: DataFrame
    fct_ppi_ciclo_vida: DataFrame


def with_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Columns that a source lacks, as typed nulls."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in types.items() if c not in df.columns})


Keep = Callable[[DataFrame, str], DataFrame]


def build_gold(silver: DataFrame, manifest: DataFrame, deflator: DataFrame, keep: Keep = lambda df, name: df, partitions: int | None = None) -> Gold:
    """All relations, lazily; the snapshots are a file catalogue and small, so Spark broadcasts them by size.

    ``keep`` gets every relation with its name before others are built on it and may write it and give back
    what it reads; by default nothing is written. ``partitions`` says into how many the key's rows are dealt
    out, else Spark does. ``anio_corte`` of an observation is the row's own year, as published; ``anio_snapshot`` is the file's.
    """
    text = ("cve_cartera", "nombre_ppi", "descripcion_ramo", "descripcion_tipo_ppi", "descripcion_ur", "localizacion", "entidad_federativa", "estatus_operacion", "fase")
    types = {c: "string" for c in text} | {c: "double" for c in (*SUMS, "anio", "avance_fisico", "latitud", "longitud", "id_ur", "id_entidad_federativa", "anios_he")} | {"id_ramo": "long"}
    silver = with_columns(silver, types)
    snapshots = keep(stage_snapshots(manifest), "stg_snapshots")
    canonical = keep(canonical_snapshots(snapshots), "int_snapshot_canonico")
    own = snapshots.select("snapshot_id", F.col("anio").alias("anio_snapshot"), "trimestre", "producto")
    # the snapshots are a catalogue of files; one exchange by the key serves all that follows
    base = silver.join(broadcast_if_small(own), "snapshot_id")
    base = base.repartition(partitions, "cve_cartera") if partitions else base.repartition("cve_cartera")
    order = [descending("modificado"), *[ascending(c) for c in ("monto_total_inversion", "nombre_ppi", "localizacion", "entidad_federativa")]]
    dedup = collapse_grain(base, ["cve_cartera", "snapshot_id"], order, SUMS, ("avance_fisico",), ("anio", "anio_snapshot", "trimestre", "producto"), ATTRIBUTES)
    dedup = keep(dedup, "int_ppi_observaciones_dedup")
    cuts = canonical.select("snapshot_id", F.col("anio").alias("_anio"), F.col("trimestre").alias("_trimestre"), "orden_corte", "indice_trimestre", "cobertura_parcial_del_universo")
    panel = dedup.drop("anio_snapshot").join(broadcast_if_small(cuts), "snapshot_id").withColumns({"anio": F.col("_anio"), "trimestre": F.col("_trimestre")}).drop("_anio", "_trimestre")
    panel = keep(panel, "int_ppi_observaciones_canonicas")
    dim_snapshot = snapshot_dimension(snapshots, silver, "cve_cartera", ("snapshot_id", "anio", "trimestre", "origen", "fecha_descarga", "url", "sha256", "bytes"))
    observed = dedup.withColumnsRenamed({"anio": "anio_corte", "trimestre": "trimestre_corte"}).select(
        "cve_cartera", "snapshot_id", "anio_corte", "trimestre_corte", "anio_snapshot", "n_registros_agregados", *SUMS, "avance_fisico", "estatus_operacion", "fase",
        "id_ramo", "descripcion_ramo", "descripcion_tipo_ppi", "id_entidad_federativa", "entidad_federativa", "latitud", "longitud",
    )
    changes = deltas(
        panel, "cve_cartera", "orden_corte", "indice_trimestre", ("modificado", "ejercido", "monto_total_inversion"), "avance_fisico",
        "estatus_operacion", "nombre_ppi", ("anio", "trimestre", "cobertura_parcial_del_universo"),
    )
    life = life_cycle(
        panel, canonical, "cve_cartera", "orden_corte", "indice_trimestre", "modificado", "avance_fisico", "estatus_operacion", "nombre_ppi",
        "anios_he", "anio", "cobertura_parcial_del_universo",
    )
    return Gold(
        snapshots, canonical, dedup, panel, keep(dim_snapshot, "dim_snapshot"), keep(versions(panel, "cve_cartera", "orden_corte", TRACKED, CARRIED), "dim_ppi"),
        keep(deflate(observed, deflator, REAL, "anio_corte", "trimestre_corte"), "fct_ppi_observacion"), keep(changes, "fct_ppi_delta"), keep(life, "fct_ppi_ciclo_vida"),
    )


def write_gold(spark: SparkSession, silver: DataFrame, manifest: DataFrame, deflator: DataFrame, path: str) -> Gold:
    """Every relation as Parquet below ``path``, each computed once and read again by those that need it.

    Facts and versions are written as dealt out by their key, so a reader that groups by it sees sorted files.
    """

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{path}/{name}")
        return spark.read.parquet(f"{path}/{name}")

    return build_gold(silver, manifest, deflator, written)


def read_gold(spark: SparkSession, path: str) -> Gold:
    """The relations that ``write_gold`` wrote."""
    return Gold(*[spark.read.parquet(f"{path}/{f.name}") for f in fields(Gold)])


def catalogues(seeds: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The published catalogues from their seeds, by name."""
    return {name: catalogue(seeds[name], key, attributes) for name, (key, attributes) in CATALOGUES.items() if name in seeds}


def gold_checks(gold: Gold, dimensions: Mapping[str, DataFrame] | None = None) -> list[Check]:
    """The checks that a build must pass, and the one that only warns.

    ``dimensions``: the published catalogues by name; those given are checked, and the facts against them.
    """
    found = [
        Check("snapshot_unique", unique(gold.stg_snapshots, ["snapshot_id"])),
        Check("dim_snapshot_unique", unique(gold.dim_snapshot, ["snapshot_id"])),
        Check("dim_snapshot_id_not_null", not_null(gold.dim_snapshot, "snapshot_id")),
        Check("observation_unique", unique(gold.fct_ppi_observacion, ["cve_cartera", "snapshot_id"])),
        Check("observation_key_not_null", not_null(gold.fct_ppi_observacion, "cve_cartera")),
        Check("observation_snapshot_not_null", not_null(gold.fct_ppi_observacion, "snapshot_id")),
        Check("observation_snapshot_exists", relationship(gold.fct_ppi_observacion, "snapshot_id", gold.dim_snapshot, "snapshot_id")),
        Check("observation_status_accepted", accepted_values(gold.fct_ppi_observacion, "estatus_operacion", STATUSES)),
        Check("observation_type_accepted", accepted_values(gold.fct_ppi_observacion, "descripcion_tipo_ppi", TYPES)),
        Check("version_key_not_null", not_null(gold.dim_ppi, "cve_cartera")),
        Check("delta_key_not_null", not_null(gold.fct_ppi_delta, "cve_cartera")),
        Check("life_unique", unique(gold.fct_ppi_ciclo_vida, ["cve_cartera"])),
        Check("life_key_not_null", not_null(gold.fct_ppi_ciclo_vida, "cve_cartera")),
        Check("terminal_status_accepted", accepted_values(gold.fct_ppi_ciclo_vida, "estatus_terminal_inferido", TERMINAL)),
        Check("falling_progress_flagged", unflagged_fall(gold.fct_ppi_delta, "avance_fisico", "avance_fisico_anterior", "avance_fisico_decrecio")),
    ]
    for name, rows in (dimensions or {}).items():
        key = CATALOGUES[name][0]
        found += [Check(f"{name}_unique", unique(rows, [key])), Check(f"{name}_not_null", not_null(rows, key))]
        if key in gold.fct_ppi_observacion.columns:
            found.append(Check(f"observation_{key}_exists", relationship(gold.fct_ppi_observacion, key, rows, key)))
    counts = gold.int_ppi_observaciones_canonicas.where(F.col("id_ramo").isNotNull()).groupBy("id_ramo", "orden_corte", "trimestre", "cobertura_parcial_del_universo").agg(F.countDistinct("cve_cartera").alias("n_ppi"))
    found.append(Check("branch_counts_stable", unstable_counts(counts, "id_ramo", "orden_corte", "trimestre", "n_ppi", "cobertura_parcial_del_universo"), "warn"))
    return found
