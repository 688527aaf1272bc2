"""Classification of file URLs and the grid of URLs to probe."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Ordinals of quarters as file names spell them.
ORDINALS = {"1er": 1, "2do": 2, "3er": 3, "4to": 4}

# Layouts of file URLs, tried in this order; group 1 is the year, then the quarter if any.
LAYOUTS: tuple[tuple[str, str, int | None], ...] = (
    (r"/OPA/(\d{4})/proyectos_opa_0([1-4])t\d{4}\.(?:csv|xlsx)", "trimestral_numerico", 2),
    (r"/OPA/(\d{4})/Proyectos_OPA_([1-4])t\.(?:csv|xlsx)", "trimestral_numerico", 2),
    (r"/OPA/(\d{4})/reporteOPA(1er|2do|3er|4to)Trimestre(?:_V\d)?\.xlsx", "trimestral_ordinal", 2),
    (r"/OPA/(\d{4})/(?:Consolidado|Concluidos?|Seguimiento)OPA(1er|2do|3er|4to)Trimestre\d{4}\.csv", "trimestral_nuevo", 2),
    (r"/DatosAbiertos/OPA/(\d{4})/proyectos_opa\.(?:csv|xlsx)", "anual_generico", None),
    (r"/PTP/OPA/(\d{4})/Proyectos_OPA\.csv", "anual_generico_antiguo", None),
)
#: Layouts that name a year without a quarter.
YEARLY = ("anual_generico", "anual_generico_antiguo")
#: Extensions of files that hold data.
EXTENSIONS = ("csv", "xlsx")


def classify_url(url: Column, layouts: Iterable[tuple[str, str, int | None]] = LAYOUTS, unknown: str = "no_reconocido") -> Column:
    """struct(anio, trimestre, patron) of the first layout that a URL fits; nulls and ``unknown`` if none."""
    ordinal = F.create_map(*[F.lit(v) for pair in ORDINALS.items() for v in pair])
    out = F.struct(F.lit(None).cast("int").alias("anio"), F.lit(None).cast("int").alias("trimestre"), F.lit(unknown).alias("patron"))
    for pattern, name, quarter in reversed(list(layouts)):
        own = f"(?i){pattern}"
        spelled = F.lower(F.regexp_extract(url, own, quarter)) if quarter else F.lit(None).cast("string")
        number = F.coalesce(spelled.try_cast("int"), F.try_element_at(ordinal, spelled))
        hit = F.struct(F.regexp_extract(url, own, 1).try_cast("int").alias("anio"), number.cast("int").alias("trimestre"), F.lit(name).alias("patron"))
        out = F.when(url.rlike(own), hit).otherwise(out)
    return out


def classify_text(url: str) -> tuple[int | None, int | None, str]:
    """Year, quarter and layout of one URL, on the driver, by the same layouts."""
    for pattern, name, quarter in LAYOUTS:
        if found := re.search(f"(?i){pattern}", url):
            spelled = found[quarter].lower() if quarter else None
            return int(found[1]), int(spelled) if spelled and spelled.isdigit() else ORDINALS.get(spelled or ""), name
    return None, None, "no_reconocido"


def product(url: Column, quarter: Column) -> Column:
    """Which of a quarter's complementary files a URL names; the first that fits."""
    return (
        F.when(url.ilike("%Consolidado%"), "consolidado")
        .when(url.ilike("%Seguimiento%"), "seguimiento")
        .when(url.ilike("%Concluido%"), "concluido")
        .when(quarter.isNull(), "anual_generico")
        .otherwise("otro")
    )


def extension(url: Column) -> Column:
    """A URL's file extension if it is one that holds data, else null."""
    found = F.lower(F.regexp_extract(F.regexp_replace(url, r"[?#].*$", ""), r"\.([A-Za-z0-9]+)$", 1))
    return F.when(found.isin(*EXTENSIONS), found)


def archived_url(timestamp: Column, url: Column) -> Column:
    """Where the web archive serves a capture's bytes unchanged."""
    return F.concat(F.lit("https://web.archive.org/web/"), timestamp, F.lit("id_/"), url)


@dataclass(frozen=True)
class UrlGrid:
    """What the candidate URLs are made of; patterns hold {anio}, {n}, {ord} and {v}."""

    base: str
    years: tuple[int, int]
    patterns: tuple[str, ...]
    quarters: tuple[int, ...] = (1, 2, 3, 4)
    ordinals: tuple[str, ...] = tuple(ORDINALS)
    versions: tuple[int, ...] = ()
    special: tuple[tuple[str, int, int | None], ...] = ()
    auxiliary: tuple[str, ...] = field(default=())


def candidate_urls(spark: SparkSession, grid: UrlGrid) -> DataFrame:
    """(url, anio, trimestre, patron): every pattern for every year, quarter and version it speaks of.

    Patterns are few, so the products stay small whatever the data.
    """
    years = spark.range(grid.years[0], grid.years[1] + 1).select(F.col("id").cast("int").alias("anio"))
    frames = []
    for p in grid.patterns:
        frame = years.select("anio", F.lit(None).cast("int").alias("trimestre"), F.replace(F.lit(p), F.lit("{anio}"), F.col("anio").cast("string")).alias("url"))
        name = "anual_generico" if "DatosAbiertos" in p else "anual_generico_antiguo"
        if "{n}" in p:
            name = "trimestral_numerico"
            frame = frame.withColumn("trimestre", F.explode(F.array(*[F.lit(q) for q in grid.quarters]))).withColumn("url", F.replace("url", F.lit("{n}"), F.col("trimestre").cast("string")))
        elif "{ord}" in p:
            name = "trimestral_ordinal"
            spelled = F.explode(F.array(*[F.struct(F.lit(o).alias("o"), F.lit(ORDINALS[o]).alias("q")) for o in grid.ordinals]))
            frame = frame.withColumn("_o", spelled).withColumn("trimestre", F.col("_o.q")).withColumn("url", F.replace("url", F.lit("{ord}"), F.col("_o.o"))).drop("_o")
            if "{v}" in p:
                frame = frame.withColumn("_v", F.explode(F.array(*[F.lit(str(v)) for v in grid.versions]))).withColumn("url", F.replace("url", F.lit("{v}"), F.col("_v"))).drop("_v")
        frames.append(frame.select("url", "anio", "trimestre", F.lit(name).alias("patron")))
    fixed = [(u, y, q, "caso_especial") for u, y, q in grid.special] + [(u, None, None, "auxiliar") for u in grid.auxiliary]
    if fixed:
        frames.append(spark.createDataFrame(fixed, "url string, anio int, trimestre int, patron string"))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.withColumn("url", F.concat(F.lit(grid.base), "url"))


def candidates_on(bases: DataFrame, grid: UrlGrid) -> DataFrame:
    """The grid's URLs on every base in the first column of ``bases``; the grid, a configured list, comes along as an array."""
    own = candidate_urls(bases.sparkSession, replace(grid, base="")).collect()
    cells = F.array(*[F.struct(*[F.lit(r[c]).cast(kind).alias(c) for c, kind in (("url", "string"), ("anio", "int"), ("trimestre", "int"), ("patron", "string"))]) for r in own])
    rows = bases.select(F.col(bases.columns[0]).alias("_base")).distinct().select("_base", F.explode(cells).alias("_c"))
    return rows.select(F.concat("_base", "_c.url").alias("url"), "_c.anio", "_c.trimestre", "_c.patron")
