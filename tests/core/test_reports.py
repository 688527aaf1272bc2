"""Labels, quality reports and records that come more than once."""

from __future__ import annotations

import json
import random
import textwrap

import pytest
from pyspark.sql import functions as F

from tidemark.functions.cleaning import wrap
from tidemark.plans.silver import AUDIT
from tidemark.sources import report
from tidemark.streaming import bronze as stream


@pytest.mark.parametrize("width", [1, 8, 20, 95])
def test_wrap_fills_lines_like_the_standard_library(spark, width):
    rng = random.Random(width)
    texts = ["", " ", "uno", "Construcción de la carretera México-Toluca, tramo  dos-tres y cuatro", "a-b c-d ab-cd ef--gh", "x" * 50 + " corto", "línea\nnueva\ttab"]
    texts += [" ".join("".join(rng.choice("abcñ") for _ in range(rng.randint(1, 12))) for _ in range(rng.randint(1, 30))) for _ in range(40)]
    got = [r["r"] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, t STRING").select("i", wrap(F.col("t"), width).alias("r")).orderBy("i").collect()]
    for text, found in zip(texts, got, strict=True):
        if "--" not in text:
            assert found == "<br>".join(textwrap.wrap(" ".join(text.split()), width=width, break_long_words=False))
    assert spark.createDataFrame([(None,)], "t STRING").select(wrap(F.col("t"), width).alias("r")).first()["r"] is None


def test_a_report_is_read_as_it_was_written(spark, tmp_path):
    audit = spark.createDataFrame([("a", "s", 179_000, 177_000, 2_000, 98.9, 3, {}), ("b", "s", 1_000, 0, 1_000, 0.0, 0, {})], AUDIT)
    failed = [("x", "x.csv", "corrupto_conocido")] * 3 + [("y", "y.csv", "error")]
    text = report.quality_summary(audit, failed)
    (tmp_path / "r.md").write_text("# Calidad\n\n" + text + "\n## Detalle\n| a |\n")
    assert report.read_summary(spark, str(tmp_path / "r.md")) == {
        "snapshots_normalizados": 2, "snapshots_omitidos_corruptos": 3, "snapshots_esquema_desconocido": 0, "snapshots_error_lectura": 1,
        "filas_totales": 180_000, "filas_validas": 177_000, "filas_en_cuarentena": 3_000, "pct_filas_validas": 98.3,
    }
    lines = [x for x in text.splitlines() if "corrupción" not in x and "Filas totales" not in x]
    (tmp_path / "r.md").write_text("\n".join(lines))
    with pytest.raises(report.ReportError, match="lacks: filas_totales, snapshots_omitidos_corruptos"):
        report.read_summary(spark, str(tmp_path / "r.md"))


def test_summary_of_no_snapshot(spark):
    assert "(0.0%)" in report.quality_summary(spark.createDataFrame([], AUDIT), [])


def test_records_count_once_across_restarts(spark, tmp_path):
    def drop(name, *rows):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / name).write_text("".join(json.dumps({"url": u, "corte_declarado": {"anio": a, "trimestre": q}, "sha256": s}) + "\n" for u, a, q, s in rows))
        stream.start_records(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
        return sorted((r["url"], r["corte_declarado"]["anio"], r["corte_declarado"]["trimestre"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())

    first = drop("a.jsonl", ("u", 2020, 1, "s"), ("u", 2020, 1, "s"), ("u", 2020, 2, "s"))
    assert first == [("u", 2020, 1), ("u", 2020, 2)]
    # the same file under another name, and one new snapshot; each call is a restart from the checkpoint
    assert drop("b.jsonl", ("u", 2020, 1, "s"), ("u", 2020, 2, "s"), ("v", 2020, 1, "s")) == [*first, ("v", 2020, 1)]
    assert len(drop("c.jsonl", ("v", 2020, 1, "other"))) == 3
