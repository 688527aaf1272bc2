"""What files look like: header, dialect, rows and keys of sample files, and which columns they share."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.feeds import key_profile, nearest_to
from tidemark.sources.files import csv_header, detect_encoding, detect_separator, distinct_names, find_column, read_head, scan_csv

# Header spellings of the key, by preference, and the shape that the report asks of one.
KEYS, PROJECTS, SHAPE = ("cve_cartera", "clave_cartera"), ("id_ppi", "cve_cartera", "clave_cartera"), r"^\d{10,11}$"
# The lines of a quality report's summary that carry a number, by field and in their order.
SUMMARY = {
    "snapshots_normalizados": "Normalizados a parquet",
    "snapshots_omitidos_corruptos": "Omitidos por corrupción conocida en la fuente",
    "snapshots_esquema_desconocido": "Con esquema desconocido",
    "snapshots_error_lectura": "Con error de lectura",
    "filas_totales": "Filas totales procesadas",
    "filas_validas": "Filas válidas escritas a parquet",
    "filas_en_cuarentena": "Filas en cuarentena",
}
#: The middle sample is the one nearest to this year.
MIDDLE = 2019.5


@dataclass
class Inspection:
    name: str
    encoding: str | None
    separator: str | None
    columns: Sequence[str]
    rows: int
    key: str | None
    projects: int | None
    profile: Mapping[str, object]


def samples(files: DataFrame) -> dict[str, object]:
    """The oldest, the newest and a middle one of the files (archivo_bronze, anio, trimestre), by name."""
    position = F.col("anio") + F.coalesce("trimestre", F.lit(0)) / F.lit(10.0)
    r = nearest_to(files.where(F.col("anio").isNotNull()), position, MIDDLE, ["archivo_bronze", "anio", "trimestre"]).first()
    return {label: r[c] for label, c in (("antigua", "oldest"), ("intermedia", "middle"), ("reciente", "newest")) if r[c] is not None}


def inspect_file(spark: SparkSession, path: str) -> Inspection:
    """One file's header, dialect, rows, projects and keys; its rows are read by Spark."""
    name = path.rsplit("/", 1)[-1]
    if name.lower().endswith(".xlsx"):
        from tidemark.sources.xlsx import header_of, scan_xlsx

        content = spark.read.format("binaryFile").load(path).select("content").first()[0]
        encoding = separator = None
        columns = header_of(bytes(content)) or []
        rows = scan_xlsx(spark, [path], columns) if columns else None
    else:
        head = read_head(spark, path)
        encoding = detect_encoding(head, whole=False)
        separator = detect_separator(head.decode(encoding, "ignore"))
        columns = distinct_names(csv_header(head, encoding, separator))
        rows = scan_csv(spark, path, columns, separator, encoding) if columns else None
    if rows is None:
        return Inspection(name, encoding, separator, (), 0, None, None, {})
    key, project = find_column(columns, KEYS), find_column(columns, PROJECTS)
    n = rows.agg(F.count(F.lit(1)).alias("n"), *([F.countDistinct(f"`{project}`").alias("m")] if project else [])).first()
    own = rows.select(F.trim(F.col(f"`{key}`")).alias("clave")).where("clave != ''") if key else None
    profile = key_profile(own, "clave", SHAPE).first().asDict() if own is not None else {}
    return Inspection(name, encoding, separator, columns, n["n"], key, n["m"] if project else None, profile)


def schema_report(found: Mapping[str, Inspection]) -> str:
    """The inspections in Markdown, and a table of which columns each sample has."""
    lines = ["# Comparación de esquemas", ""]
    for label, i in found.items():
        lines += [f"## {label}: `{i.name}`", "", f"- Codificación: {i.encoding or 'binaria'}; separador: {i.separator or 'ninguno'}", f"- Filas: {i.rows}", f"- Columna de cartera: {i.key or 'no detectada'}"]
        if i.projects is not None:
            lines.append(f"- Proyectos distintos: {i.projects}")
        if i.profile.get("n"):
            lines.append(f"- Claves de {i.profile['menor']} a {i.profile['mayor']}; {round(100 * i.profile['cumple'], 1)} % con la forma esperada")
        lines += [f"- Columnas ({len(i.columns)}): " + ", ".join(f"`{c}`" for c in i.columns), ""]
    spelled = {label: {c.strip().lower() for c in i.columns} for label, i in found.items()}
    every = {c.strip().lower(): c for i in reversed(list(found.values())) for c in reversed(list(i.columns))}
    order = dict.fromkeys(c.strip().lower() for i in found.values() for c in i.columns)
    lines += ["| Columna | " + " | ".join(found) + " |", "|---|" + "---|" * len(found)]
    lines += [f"| `{every[c]}` | " + " | ".join("✓" if c in spelled[label] else "—" for label in found) + " |" for c in order]
    return "\n".join(lines) + "\n"


class ReportError(RuntimeError):
    """Numbers that a report should have and has not, all named together."""


def quality_summary(audit: DataFrame, failed: Sequence[tuple[str, str, str]]) -> str:
    """The summary section of a quality report: snapshots by outcome, rows by verdict."""
    r = audit.agg(F.count(F.lit(1)).alias("k"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_rows", "n_valid", "n_quarantined")]).first()
    of = lambda state: sum(s == state for *_, s in failed)
    share = round(100 * r["n_valid"] / r["n_rows"], 1) if r["n_rows"] else 0.0
    values = [f"**{r['k']}**", *[f"**{of(s)}**" for s in ("corrupto_conocido", "esquema_desconocido", "error")], f"{r['n_rows']:,}", f"{r['n_valid']:,} ({share}%)", f"{r['n_quarantined']:,}"]
    return "\n".join(["## Resumen", "", *[f"- {label}: {value}" for label, value in zip(SUMMARY.values(), values, strict=True)], ""])


def parse_summaries(reports: DataFrame, text: str = "value") -> DataFrame:
    """The numbers of each report's summary as columns, and the share of valid rows; null where a report lacks one.

    A label may have a remark in brackets behind it, a number commas and bold type.
    """
    body = F.col(text)
    label = lambda name: r"\Q" + name + r"\E(?: \([^)]*\))?:\s*"
    number = lambda name: F.regexp_replace(F.regexp_extract(body, label(name) + r"\**([\d,]+)", 1), ",", "").try_cast("long")
    share = F.regexp_extract(body, label(SUMMARY["filas_validas"]) + r"[\d,]+ \(([\d.]+)%\)", 1).try_cast("double")
    return reports.select(*[c for c in reports.columns if c != text], *[number(name).alias(f) for f, name in SUMMARY.items()], share.alias("pct_filas_validas"))


def read_summary(spark: SparkSession, path: str) -> dict[str, int | float]:
    """The numbers of one report's summary, or an error that names all that are missing."""
    found = parse_summaries(spark.read.text(path, wholetext=True)).first()
    if missing := sorted(f for f in found.__fields__ if found[f] is None):
        raise ReportError(f"{path} lacks: {', '.join(missing)}")
    return found.asDict()
