"""Command line: discover, bronze, normalize, inspect, gold, diccionario, publish, figuras."""

from __future__ import annotations

import argparse
import json
import subprocess
import sys
import urllib.error
import urllib.request
from collections.abc import Mapping, Sequence
from datetime import date
from pathlib import Path

import yaml
from pyspark.sql import functions as F

from tidemark.operators import coverage, feeds
from tidemark.operators.checks import run_checks
from tidemark.plans.gold import PUBLISHED, catalogues, gold_checks, read_gold, write_gold
from tidemark.plans.marts import MissingTables, comment_drift, read_marts, save_gold
from tidemark.plans.silver import AUDIT, LostRows, normalise, silver_schema, write_silver, written_snapshots
from tidemark.publish import package
from tidemark.session import build_session
from tidemark.functions.cleaning import wrap
from tidemark.functions.urls import UrlGrid, candidate_urls, classify_text
from tidemark.sources import discovery, files, report
from tidemark.sources.registry import UnknownSchema, load_registry


def http_fetch(method: str, url: str, timeout: float = 20.0) -> tuple[int | None, Mapping[str, str], bytes]:
    """GET_RANGE asks for the first bytes and reads no more of the answer, even of a server that sends all."""
    ranged = {"Range": f"bytes=0-{discovery.RANGE - 1}"} if method == "GET_RANGE" else {}
    request = urllib.request.Request(url, method=method.partition("_")[0], headers=ranged)
    try:
        with urllib.request.urlopen(request, timeout=timeout) as answer:
            body = b"" if method == "HEAD" else answer.read(discovery.RANGE) if ranged else answer.read()
            return answer.status, dict(answer.headers), body
    except urllib.error.HTTPError as e:
        return e.code, dict(e.headers or {}), b""


#: What the system's client tells about an answer, on its error stream; the body has the other to itself.
TOLD = '%{stderr}{"status": %{response_code}, "headers": %{header_json}}'


def curl_fetch(method: str, url: str, timeout: float = 20.0) -> tuple[int | None, Mapping[str, str], bytes]:
    """The system's own client, which completes certificate chains and verifies them; None if it gets no answer."""
    how = {"HEAD": ["--head"], "GET_RANGE": ["--range", f"0-{discovery.RANGE - 1}"]}.get(method, [])
    try:
        done = subprocess.run(["curl", "--silent", "--location", "--max-time", f"{timeout:g}", *how, "--write-out", TOLD, "--url", url], capture_output=True, timeout=timeout + 5, check=False)
        told = json.loads(done.stderr)
    except (OSError, subprocess.TimeoutExpired, ValueError):
        return None, {}, b""
    body = b"" if method == "HEAD" else done.stdout[: discovery.RANGE] if method == "GET_RANGE" else done.stdout
    return told["status"] or None, {name: values[-1] for name, values in told["headers"].items()}, body


def _grid(raw: Mapping) -> UrlGrid:
    live = raw["fuente_viva"]
    return UrlGrid(
        live["base_url"], (raw["anios"]["desde"], raw["anios"]["hasta"]), tuple(live["patrones"]), tuple(live.get("trimestre_n", (1, 2, 3, 4))),
        tuple(live.get("trimestre_ord", ())), tuple(live.get("version_v", ())),
        tuple((c["url"], c["anio"], c["trimestre"]) for c in live.get("casos_especiales", [])), tuple(live.get("auxiliares", ())),
    )


def _inputs(spark, args):
    registry = load_registry(args.registry)
    silver = files.read_silver(spark, f"{args.data}/silver", silver_schema(registry.canonical_columns()), "valid")
    return silver, files.read_manifest(spark, f"{args.data}/manifest.jsonl"), files.read_deflator(spark, args.deflator)


SEEDS = {
    "dim_ramo": ("dim_ramo_seed.csv", "id_ramo LONG, descripcion_ramo STRING, en_catalogo_oficial BOOLEAN"),
    "dim_entidad": ("dim_entidad_seed.csv", "id_entidad_federativa LONG, entidad_federativa STRING, en_catalogo_oficial BOOLEAN"),
    "dim_tipo_ppi": ("dim_tipo_ppi_seed.csv", "id_tipo_ppi LONG, descripcion_tipo_ppi STRING"),
}


def _dimensions(spark, args) -> dict:
    return catalogues({k: files.read_seed(spark, f"{args.seeds}/{f}", schema) for k, (f, schema) in SEEDS.items()})


def _gold(spark, args):
    """The written marts; ``gold`` writes them."""
    if args.database:
        return read_marts(spark, args.database)
    if not (Path(args.data) / "gold" / "fct_ppi_observacion").exists():
        raise package.PublishError(f"no marts below {args.data}/gold: run gold first")
    return read_gold(spark, f"{args.data}/gold")


def _published(spark, args) -> dict:
    gold = _gold(spark, args)
    return {k: getattr(gold, k) for k in PUBLISHED if hasattr(gold, k)} | _dimensions(spark, args)


def discover(spark, args, fetch=http_fetch, fallback=curl_fetch) -> int:
    """Live files, the mirror and the archive, each if the sources name it; then the coverage report."""
    data, raw = Path(args.data), yaml.safe_load(Path(args.sources).read_text(encoding="utf-8"))
    out, pace = data / "discovery.jsonl", raw.get("red", {})
    limiter = discovery.RateLimiter(pace.get("rate_limit_segundos_shcp", 2.0))
    n = discovery.probe_all(fetch, candidate_urls(spark, _grid(raw)), "vivo", out, limiter, fallback)
    if mirror := raw.get("fuente_espejo"):
        words = mirror.get("datamx_io_palabras") or discovery.PAGE_WORDS
        asked = discovery.mirror_questions(classify_text, mirror["ckan_base"], mirror["ckan_package_id"], mirror["ckan_busqueda_respaldo"], mirror.get("datamx_io"), words)
        n += discovery.append(discovery.ask(fetch, asked, limiter, fallback=fallback), out)
    if archive := raw.get("fuente_wayback"):
        options = {"matchType": archive["match_type"], "collapse": archive["collapse"], "fl": ",".join(archive["campos"]), "filter": [archive["filtro_status"], archive["filtro_mimetype_excluir"]]}
        slow = discovery.RateLimiter(pace.get("rate_limit_segundos_wayback", 2.0))
        n += discovery.append(discovery.ask(fetch, discovery.archive_questions(classify_text, archive["cdx_base"], archive["prefijos"], options), slow), out)
    probes = files.read_probes(spark, str(out))
    first, last = raw["anios"]["desde"], raw["anios"]["hasta"]
    matrix = coverage.coverage_matrix(probes, first, last)
    report = package.markdown_table(matrix.groupBy("anio").pivot("trimestre", [1, 2, 3, 4]).agg(F.min("categoria")).orderBy("anio"))
    yearly = coverage.yearly_coverage(probes, first, last)
    parts = [report, package.markdown_table(coverage.recoverable(matrix, first, last)), package.markdown_table(yearly.orderBy("anio")), package.markdown_table(coverage.trailing_gap(yearly))]
    (data / "cobertura.md").write_text("# Cobertura\n\n" + "\n\n".join(parts) + "\n", encoding="utf-8")
    return n


def bronze(spark, args, fetch=http_fetch, fallback=curl_fetch, pace: float = 2.0) -> int:
    """Fetches what is pending; 1 if anything could not be had, which ``fallidos.jsonl`` keeps for the next run."""
    data = Path(args.data)
    manifest, failures = data / "manifest.jsonl", data / "fallidos.jsonl"
    manifest.touch()
    failures.touch()
    earlier = None if args.all else files.read_failures(spark, str(failures))
    pending = discovery.to_ingest(files.read_probes(spark, str(data / "discovery.jsonl")), files.read_manifest(spark, str(manifest)), earlier)
    done = discovery.ingest(fetch, pending, data / "bronze", manifest, date.today().isoformat(), discovery.RateLimiter(pace), failures, fallback)
    print(done.added, "files added,", len(done.failed), "failed")
    for url, error in done.failed:
        print(f"{error}: {url}", file=sys.stderr)
    return int(bool(done.failed))


#: Figures: name, title, and what to bear in mind.
FIGURES = {
    "cobertura_cortes": ("Cobertura por corte", "Un corte futuro no es un hueco."),
    "universo_por_corte": ("Universo por corte", "Los huecos del panel quedan nulos."),
    "caida_estacional": ("Cambio de T4 a T1", "Solo años con ambos cortes."),
    "inversion_por_ramo": ("Monto modificado por ramo", "Pesos corrientes; siete ramos y los demás juntos."),
    "mapa_ppi": ("Última posición conocida", "Solo proyectos con coordenadas."),
    "estatus_terminal": ("Estatus terminal inferido", "Es una inferencia, no un dato de la fuente."),
    "sobrecosto_distribucion": ("Distribución del sobrecosto", "Fuera de -100 % a 300 % todo va a una clase."),
}


def figures(spark, gold, out: Path) -> list[str]:
    """The data behind every figure as Parquet, and a gallery; returns the names of those without rows."""
    panel = gold.int_ppi_observaciones_canonicas
    cells = coverage.coverage_feed(gold.stg_snapshots, gold.dim_snapshot, gold.int_snapshot_canonico, panel)
    counts = feeds.universe(panel, cells, "cve_cartera")
    frames = {
        "cobertura_cortes": cells.orderBy("anio", "trimestre"),
        "universo_por_corte": counts.orderBy("anio", "trimestre"),
        "caida_estacional": feeds.seasonal_drops(counts).orderBy("anio"),
        "inversion_por_ramo": feeds.top_with_rest(panel, "descripcion_ramo", "modificado", 7, ("anio", "trimestre")).withColumn("etiqueta", wrap(F.col("descripcion_ramo"), 40)).orderBy("anio", "trimestre", F.col("descripcion_ramo").asc_nulls_last()),
        "mapa_ppi": feeds.latest_points(gold.fct_ppi_observacion, "cve_cartera", "monto_total_inversion").orderBy("cve_cartera"),
        "estatus_terminal": feeds.status_counts(gold.fct_ppi_ciclo_vida, "estatus_terminal_inferido").orderBy("estatus_terminal_inferido"),
        "sobrecosto_distribucion": feeds.histogram(gold.fct_ppi_ciclo_vida, "sobrecosto_pct", -100, 300, 20).orderBy("bin"),
    }
    lines, empty = ["# Galería", "", f"Corte más reciente: {feeds.version_label(gold.dim_snapshot)}", ""], []
    for name, df in frames.items():
        df.coalesce(1).write.mode("overwrite").parquet(str(out / name))
        n = spark.read.parquet(str(out / name)).count()
        empty += [name] if not n and name != "caida_estacional" else []
        title, note = FIGURES[name]
        lines += [f"## {title}", "", f"`{name}`, {n} filas. {note}", ""]
    (out / "GALERIA.md").write_text("\n".join(lines), encoding="utf-8")
    return empty


def publish(spark, args) -> Path:
    """The package of one version; checksums come last, so they cover all of it."""
    data, tables = Path(args.data), _published(spark, args)
    config = package.load_catalogue_config(Path(args.catalogue))
    folder = data / "publish" / (args.version or feeds.version_label(tables["dim_snapshot"]))
    package.write_tables(tables, PUBLISHED, folder / "tabular")
    package.write_geojson(package.features(tables["fct_ppi_observacion"], tables["dim_snapshot"], tables["dim_ppi"]), folder / "geojson")
    manifest = files.read_manifest(spark, str(data / "manifest.jsonl"))
    found = feeds.provenance(manifest, F.col("corte_declarado.anio"), "origen", "fecha_descarga", "bytes").first().asDict()
    quality = report.read_summary(spark, str(data / "calidad_silver.md"))
    audit = spark.read.schema(AUDIT).parquet(str(data / "silver/audit")).agg(F.sum("n_rows").alias("filas"), F.sum("n_valid").alias("validas")).first().asDict()
    about = package.load_descriptions(Path(args.descriptions))[0] if Path(args.descriptions).exists() else {}
    package.write_catalogue(folder, config, about, found, quality)
    gold = _gold(spark, args)
    left_out = [r["snapshot_id"] for r in gold.dim_snapshot.where("estado = 'excluido_de_silver'").orderBy("snapshot_id").collect()]
    footer = f"Descarga más reciente: {found['ultima_descarga']}. Años: {found['anio_min']} a {found['anio_max']}. Licencia: {config['licencia']['nombre']}."
    package.write_note(folder / "NOTA-TECNICA.md", config["titulo"], package.note_sections(gold, audit, left_out, config.get("nota") or {}), footer)
    package.write_checksums(folder)
    return folder


def main(argv: Sequence[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tidemark", description=__doc__)
    parser.add_argument("command", choices=("discover", "bronze", "normalize", "inspect", "gold", "diccionario", "publish", "figuras"))
    parser.add_argument("--data", default="data")
    parser.add_argument("--sources", default="conf/sources.yml")
    parser.add_argument("--registry", default="conf/schema_map.yml")
    parser.add_argument("--deflator", default="conf/deflactor_inpc.csv")
    parser.add_argument("--catalogue", default="conf/dcat.yml")
    parser.add_argument("--descriptions", default="conf/schema.yml")
    parser.add_argument("--seeds", default="seeds")
    parser.add_argument("--version")
    parser.add_argument("--all", action="store_true", help="normalize: snapshots that are written already too; bronze: files that were gone too")
    parser.add_argument("--database", help="gold: write the marts as tables of this database; the others: read them from it")
    args = parser.parse_args(argv)
    spark = build_session("tidemark-cli")
    data = Path(args.data)
    data.mkdir(parents=True, exist_ok=True)
    try:
        return run(spark, args, data)
    except (package.PublishError, UnknownSchema, MissingTables, LostRows, report.ReportError, AssertionError) as e:
        print(e, file=sys.stderr)
        return 1


def run(spark, args, data: Path) -> int:
    """The command's exit code: 1 if something that it needs is missing or a check fails."""
    if args.command == "discover":
        print(discover(spark, args), "files exist")
    elif args.command == "bronze":
        return bronze(spark, args)
    elif args.command == "normalize":
        written = None if args.all else written_snapshots(spark, str(data / "silver"))
        done = write_silver(normalise(spark, load_registry(args.registry), files.read_manifest(spark, str(data / "manifest.jsonl")), str(data / "bronze"), written), str(data / "silver"))
        audit = spark.read.schema(AUDIT).parquet(str(data / "silver/audit")).orderBy("snapshot_id")
        lines = ["# Calidad", "", report.quality_summary(audit, done.failed), "## Detalle", "", package.markdown_table(audit.withColumn("motivos", F.to_json("motivos"))), "", *[f"- {state}: {snapshot} ({file})" for snapshot, file, state in done.failed], ""]
        (data / "calidad_silver.md").write_text("\n".join(lines), encoding="utf-8")
        for snapshot, file, state in done.failed:
            print(f"{state}: {snapshot} ({file})", file=sys.stderr)
        return int(any(state != "corrupto_conocido" for *_, state in done.failed))
    elif args.command == "inspect":
        manifest = files.read_manifest(spark, str(data / "manifest.jsonl"))
        chosen = report.samples(manifest.select("archivo_bronze", "corte_declarado.anio", "corte_declarado.trimestre"))
        if not chosen:
            print("no file of a known year", file=sys.stderr)
            return 1
        found = {label: report.inspect_file(spark, str(data / "bronze" / r["archivo_bronze"])) for label, r in chosen.items()}
        (data / "esquemas.md").write_text(report.schema_report(found), encoding="utf-8")
        for r in manifest.select("archivo_bronze", "header_hash", "n_columnas", "encoding_detectado").orderBy("archivo_bronze").toLocalIterator():
            print(*r)
    elif args.command == "gold":
        if args.database:
            about, columns = package.load_descriptions(Path(args.descriptions)) if Path(args.descriptions).exists() else ({}, {})
            gold = save_gold(spark, *_inputs(spark, args), args.database, f"{args.data}/marts", described=columns, about=about)
        else:
            gold = write_gold(spark, *_inputs(spark, args), f"{args.data}/gold")
        dimensions = _dimensions(spark, args) if Path(args.seeds).is_dir() else {}
        for name, severity, n in run_checks(gold_checks(gold, dimensions)):
            print(f"{severity} {name}: {n}")
    elif args.command == "diccionario":
        tables, described = _published(spark, args), package.load_descriptions(Path(args.descriptions))[1]
        if args.database and (drift := comment_drift(spark, args.database, {k: v for k, v in described.items() if spark.catalog.tableExists(f"{args.database}.{k}")})):
            raise package.PublishError("; ".join(drift))
        package.write_dictionary(tables, described, data / "diccionario")
    elif args.command == "publish":
        print(publish(spark, args))
    else:
        if empty := figures(spark, _gold(spark, args), data / "figuras"):
            print("without rows:", ", ".join(empty), file=sys.stderr)
            return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
