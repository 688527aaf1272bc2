"""Panel operators: pick, collapse, compare, version and summarise repeated observations of a key.

All are DataFrame -> DataFrame and take their columns as parameters. Orders are total and spell their null
placement, so results do not depend on partitioning. Each needs one shuffle, by the panel key; operators
that share a key reuse it if the input is already partitioned by it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.operators.sizes import broadcast_if_small

#: Amounts are summed as decimals, so that no order of summing changes a total.
MONEY = "decimal(28,6)"


def exact_sum(c: Column | str, kind: str = MONEY) -> Column:
    """Sum of doubles without rounding noise, as a double; null if all are null."""
    return F.sum((F.col(c) if isinstance(c, str) else c).cast(kind)).cast("double")


def first_known(c: Column | str, order: Column | str) -> Column:
    """``c`` where ``order`` is least among the rows in which ``c`` is not null."""
    c, order = (F.col(x) if isinstance(x, str) else x for x in (c, order))
    return F.min_by(c, F.when(c.isNotNull(), order))


def last_known(c: Column | str, order: Column | str) -> Column:
    """``c`` where ``order`` is greatest among the rows in which ``c`` is not null."""
    c, order = (F.col(x) if isinstance(x, str) else x for x in (c, order))
    return F.max_by(c, F.when(c.isNotNull(), order))


def rank_of(c: Column, ranking: Sequence[str]) -> Column:
    """Position of a value in a ranking, from 1; values outside it, null included, come last."""
    out = F.when(F.lit(False), 0)
    for i, value in enumerate(ranking, 1):
        out = out.when(c == value, i)
    return out.otherwise(len(ranking) + 1)


def pick_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in a total order; Spark prunes to one row per key before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def ascending(column: str) -> Column:
    """A part of a struct that sorts a column upwards, nulls last."""
    return F.struct(F.col(column).isNull().alias("unknown"), F.col(column).alias("value"))


def descending(column: str) -> Column:
    """A part of a struct that sorts a number downwards, nulls last."""
    return F.struct(F.col(column).isNull().alias("unknown"), (-F.col(column)).alias("value"))


def collapse_grain(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    sums: Sequence[str] = (),
    maxima: Sequence[str] = (),
    shared: Sequence[str] = (),
    representative: Sequence[str] = (),
    kind: str = MONEY,
) -> DataFrame:
    """One row per key: amounts summed, levels at their maximum, attributes of the representative row.

    The representative is least in ``order``, made of ``ascending`` and ``descending``; rows that tie in it
    are settled by the attributes themselves. ``shared`` columns are the same in all rows of a key, and the
    least non-null value stands for them. ``n_registros_agregados`` counts the rows. Rows with a null key
    column do not belong to the panel and are left out. All of it is one aggregate, so tasks combine their
    rows of a key before any exchange; a frame that is dealt out by a key column already needs none.
    """
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    row = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], *[F.col(c).alias(f"v{i}") for i, c in enumerate(representative)])
    first = [F.min(row).alias("_first")] if representative else []
    found = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_registros_agregados"),
        *[exact_sum(c, kind).alias(c) for c in sums],
        *[F.max(c).alias(c) for c in maxima],
        *[F.min(c).alias(c) for c in shared],
        *first,
    )
    return found.select(*[c for c in found.columns if c != "_first"], *[F.col(f"_first.v{i}").alias(c) for i, c in enumerate(representative)])


def snapshot_dimension(snapshots: DataFrame, rows: DataFrame, key: str, keep: Sequence[str]) -> DataFrame:
    """``keep`` columns of every snapshot with the rows and distinct keys it has in the panel, and its state.

    A snapshot without a row was excluded on the way; its counts are 0.
    """
    counts = rows.groupBy("snapshot_id").agg(F.count(F.lit(1)).alias("n_observaciones"), F.countDistinct(key).alias("n_ppi"))
    return snapshots.join(counts, "snapshot_id", "left").select(
        *keep, F.coalesce("n_observaciones", F.lit(0)).alias("n_observaciones"), F.coalesce("n_ppi", F.lit(0)).alias("n_ppi"),
        F.when(F.col("n_observaciones").isNull(), "excluido_de_silver").otherwise("normalizado").alias("estado"),
    )


def catalogue(rows: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """A catalogue's rows with an id: the key as a whole number, then its attributes as they are."""
    return rows.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias(key), *attributes)


def canonical_snapshots(snapshots: DataFrame) -> DataFrame:
    """One snapshot per (anio, trimestre): by product, then origin, then id.

    ``snapshots``: snapshot_id, anio, trimestre, producto, origen. Yearly files have no quarter and take no
    part. Any product but the consolidated one covers only part of the universe.
    """
    order = [rank_of(F.col("producto"), ("consolidado", "seguimiento", "concluido")), rank_of(F.col("origen"), ("vivo",)), F.col("snapshot_id").asc_nulls_last()]
    chosen = pick_first(snapshots.where(F.col("trimestre").isNotNull()), ["anio", "trimestre"], order)
    return chosen.select(
        "snapshot_id", "anio", "trimestre", "producto",
        (F.col("anio") * 10 + F.col("trimestre")).alias("orden_corte"),
        (F.col("anio") * 4 + F.col("trimestre")).alias("indice_trimestre"),
        ((F.col("producto") != "consolidado") & (F.col("producto") != "anual_generico")).alias("cobertura_parcial_del_universo"),
    )


def deltas(panel: DataFrame, key: str, order: str, line: str, amounts: Sequence[str], level: str, status: str, name: str, keep: Sequence[str]) -> DataFrame:
    """Each observation beside the one before it of the same key; the first of a key is left out.

    Returned: key, ``keep`` columns, snapshot_id_anterior, brecha_trimestres, and for each amount and the
    level the earlier value, the present one and their difference; whether the level fell (null if either
    is unknown), whether the status changed (null-safe), whether a known name changed.
    """
    w = Window.partitionBy(key).orderBy(F.col(order).asc_nulls_last())
    before = {c: F.lag(c).over(w) for c in ("snapshot_id", line, *amounts, level, status, name)}
    rows = panel.select("*", *[v.alias(f"{c}_anterior") for c, v in before.items()]).where(F.col(f"{line}_anterior").isNotNull())
    measured = [x for c in (*amounts, level) for x in (F.col(f"{c}_anterior"), F.col(c), (F.col(c) - F.col(f"{c}_anterior")).alias(f"delta_{c}"))]
    return rows.select(
        key, "snapshot_id", "snapshot_id_anterior", *keep, order,
        (F.col(line) - F.col(f"{line}_anterior")).alias("brecha_trimestres"),
        *measured,
        (F.col(level) < F.col(f"{level}_anterior")).alias(f"{level}_decrecio"),
        F.col(f"{status}_anterior"), F.col(status),
        (~F.col(status).eqNullSafe(F.col(f"{status}_anterior"))).alias("cambio_estatus"),
        (F.col(f"{name}_anterior").isNotNull() & ~F.col(name).eqNullSafe(F.col(f"{name}_anterior"))).alias("bandera_renombramiento"),
    )


def versions(panel: DataFrame, key: str, order: str, tracked: Sequence[str], carried: Sequence[str] = ()) -> DataFrame:
    """Slowly changing dimension: one row per run of observations without a change in ``tracked``.

    A version is a gapless run; validity ends at the last observation of the run, so ranges leave gaps. The
    number counts changes so far: a key whose first observation has no tracked value at all starts at 0.
    ``carried`` columns come along without opening versions. Attributes are a run's first known values.
    """
    w = Window.partitionBy(key).orderBy(F.col(order).asc_nulls_last())
    changed = F.lit(False)
    for c in tracked:
        changed = changed | ~F.col(c).eqNullSafe(F.lag(c).over(w))
    marked = panel.withColumn("_change", changed.cast("int"))
    numbered = marked.withColumn("version_ppi", F.sum("_change").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    runs = numbered.groupBy(key, "version_ppi").agg(
        F.min(order).alias("vigente_desde_corte"),
        F.max(order).alias("vigente_hasta_corte"),
        first_known("snapshot_id", order).alias("snapshot_id_inicio"),
        last_known("snapshot_id", order).alias("snapshot_id_fin"),
        *[first_known(c, order).alias(c) for c in (*tracked, *carried)],
    )
    latest = Window.partitionBy(key).orderBy(F.col("version_ppi").desc())
    return runs.withColumn("es_version_vigente", F.row_number().over(latest) == 1)


def life_cycle(panel: DataFrame, cuts: DataFrame, key: str, order: str, line: str, amount: str, level: str, status: str, name: str, planned: str, year: str, partial: str, done_at: float = 95.0) -> DataFrame:
    """One row per key: first and last cut, first and last known values, and an inferred final status.

    ``cuts`` holds all canonical cuts in column ``order``; its maximum, one row, is broadcast. Near
    completion means finished; a key last seen before the panel's end left unexplained; else it is current.
    """
    life = panel.groupBy(key).agg(
        F.min(order).alias("primer_corte"),
        F.max(order).alias("ultimo_corte"),
        (F.max(line) - F.min(line)).alias("trimestres_entre_primera_y_ultima_observacion"),
        first_known("snapshot_id", order).alias("snapshot_id_inicio"),
        last_known("snapshot_id", order).alias("snapshot_id_fin"),
        first_known(name, order).alias("nombre_ppi"),
        first_known(amount, order).alias("monto_inicial"),
        last_known(amount, order).alias("monto_final"),
        last_known(level, order).alias("avance_fisico_final"),
        last_known(status, order).alias("estatus_operacion_final"),
        first_known(planned, order).alias("duracion_planeada_anios"),
        F.count(F.lit(1)).alias("n_observaciones"),
        F.countDistinct(year).alias("n_anios_observado"),
        F.bool_or(partial).alias("alguna_observacion_con_cobertura_parcial"),
    )
    end = cuts.agg(F.max(order).alias("_fin"))
    both = life.crossJoin(F.broadcast(end))
    growth = F.round((F.col("monto_final") - F.col("monto_inicial")) / F.col("monto_inicial") * 100, 2)
    return both.select(
        *life.columns,
        F.when(F.col("monto_inicial") > 0, growth).alias("sobrecosto_pct"),
        F.round(F.col("trimestres_entre_primera_y_ultima_observacion") / F.lit(4.0), 2).alias("duracion_observada_anios"),
        F.when(F.col("avance_fisico_final") >= done_at, "terminado_probable")
        .when(F.col("ultimo_corte") < F.col("_fin"), "salida_no_explicada")
        .otherwise("vigente_ultimo_corte_disponible").alias("estatus_terminal_inferido"),
    )


def deflate(observations: DataFrame, deflator: DataFrame, amounts: Sequence[str], year: str, quarter: str) -> DataFrame:
    """Amounts at base-year prices beside the nominal ones: ``amount * (100 / inpc)``.

    ``deflator``: anio, trimestre (null for a whole year), inpc, anio_base. Quarters match null-safely,
    which Catalyst turns into a hash key; a null year never matches, and unmatched amounts stay null. The
    series is broadcast if small, for its few keys would make a very uneven shuffle of the observations.
    """
    d = deflator.select(F.col("anio").alias("_y"), F.col("trimestre").alias("_q"), "inpc", F.col("anio_base").alias("anio_base_deflactor"))
    joined = observations.join(broadcast_if_small(d), (F.col(year) == F.col("_y")) & F.col(quarter).eqNullSafe(F.col("_q")), "left")
    real = [(F.col(c) * F.try_divide(F.lit(100.0), F.col("inpc"))).alias(f"{c}_real") for c in amounts]
    return joined.select(*observations.columns, *real, "anio_base_deflactor")


def as_of(observations: DataFrame, versions_: DataFrame, key: str, order: str, attributes: Sequence[str]) -> DataFrame:
    """Observations with the attributes of the version valid at their cut, by a merge of both along each key.

    Versions of a key must not overlap; gaps between them, and observations outside all of them or without a
    key or a cut, give nulls. Both are dealt out by the key once and sorted once, and each observation takes
    the last version that began at or before it, so a key's cost is linear in its rows; frames that are dealt
    out by the key already are not shuffled again. Observations without a key are spread.
    """
    kept = [c for c in observations.columns if c not in attributes]
    rest = [c for c in kept if c != key]
    types = {f.name: f.dataType for f in observations.schema}
    version = F.struct(F.col("vigente_hasta_corte").cast(types[order]).alias("until"), *[F.col(c).alias(f"v{i}") for i, c in enumerate(attributes)])
    version_type = versions_.select(version.alias("v")).schema["v"].dataType
    spread = F.when(F.col(key).isNull(), F.monotonically_increasing_id()).otherwise(0)
    seen = observations.select(*rest, F.col(key).alias("_k"), spread.alias("_s"), F.col(order).alias("_at"), F.lit(1).alias("_seen"), F.lit(None).cast(version_type).alias("_v"))
    begun = versions_.where(F.col(key).isNotNull() & F.col("vigente_desde_corte").isNotNull()).select(
        *[F.lit(None).cast(types[c]).alias(c) for c in rest],
        F.col(key).cast(types[key]).alias("_k"), F.lit(0).cast("long").alias("_s"), F.col("vigente_desde_corte").cast(types[order]).alias("_at"), F.lit(0).alias("_seen"), version.alias("_v"),
    )
    along = Window.partitionBy("_k", "_s").orderBy(F.col("_at").asc_nulls_first(), "_seen").rowsBetween(Window.unboundedPreceding, 0)
    merged = seen.unionByName(begun).withColumn("_v", F.last("_v", ignorenulls=True).over(along)).where("_seen = 1")
    valid = F.col("_at") <= F.col("_v.until")
    return merged.select(*[F.col("_k").alias(key) if c == key else F.col(c) for c in kept], *[F.when(valid, F.col(f"_v.v{i}")).alias(c) for i, c in enumerate(attributes)])
