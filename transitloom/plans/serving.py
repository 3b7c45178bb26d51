"""Dashboard and prompt answers over the gold tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from transitloom.functions import text
from transitloom.operators import matching
from transitloom.session import SPARK_ERRORS

# fixed value: route length in km when there is no static profile at all
DEFAULT_LENGTH_KM = 15.0
FULL, PARTIAL, NONE = "full", "partial", "none"


def date_choices(measure: DataFrame) -> DataFrame:
    """Days on offer, newest first; the first is the default."""
    return measure.select("data_referencia").distinct().orderBy(F.col("data_referencia").desc())


def _on_day(df: DataFrame, day, latest_of: DataFrame) -> DataFrame:
    chosen = F.lit(day).cast("date") if day is not None else latest_of.agg(F.max("data_referencia")).scalar()
    return df.filter(F.col("data_referencia") == chosen)


def fleet_counts(snapshot: DataFrame) -> DataFrame:
    """Vehicles and accessible vehicles by line, the line as text."""
    return _fleet(snapshot).select(text.key_text(F.col("cod_linha")).alias("linha"), "Qtd_Veiculos", "Acessiveis")


def _fleet(snapshot: DataFrame) -> DataFrame:
    return snapshot.groupBy("cod_linha").agg(
        F.count("prefixo_veiculo").alias("Qtd_Veiculos"),
        F.count_if(text.is_truthy(F.col("is_acessivel"))).alias("Acessiveis"),
    )


def access_status(accessible: Column, fleet: Column) -> Column:
    """Three levels, from the integer counts so that no rounding can reach 100 %."""
    return (
        F.when((accessible >= fleet) & (fleet > 0), F.lit(FULL))
        .when((accessible > 0) & (fleet > 0), F.lit(PARTIAL))
        .otherwise(F.lit(NONE))
    )


def dashboard_day(speed: DataFrame, snapshot: DataFrame, profile: DataFrame, day=None,
                  accessible_only: bool = False, hide_ghosts: bool = True) -> DataFrame:
    """Everything the dashboard shows for one day (default: the newest with a speed).

    Speed rows of the day, with fleet counts by line and the static route length; a route without a
    profile gets the mean length of all profiles. Ghost lines (no sign, no route name or no vehicle)
    are hidden unless asked for. The day is filtered first, so partitioned tables read one day.
    """
    today = _on_day(
        speed.select("cod_linha", "letreiro_completo", "nome_rota_oficial", "velocidade_media",
                     "sentido_desc", "data_referencia"),
        day, speed,
    )
    seen = _on_day(
        snapshot.select("cod_linha", "prefixo_veiculo", "is_acessivel", "data_referencia"), day, speed
    )
    lengths = profile.select(
        F.col("letreiro_gtfs"), F.col("extensao_km").cast("double").alias("km"), "qtd_paradas_estimada"
    )
    mean_length = lengths.agg(F.avg("km")).scalar()

    named = today.select(
        "cod_linha",
        F.coalesce("letreiro_completo", F.lit(text.UNKNOWN_SIGN)).alias("letreiro_completo"),
        F.coalesce("nome_rota_oficial", F.lit(text.UNKNOWN_ROUTE)).alias("nome_rota_oficial"),
        text.route_label(F.col("letreiro_completo"), F.col("nome_rota_oficial")).alias("Rota"),
        text.number_or_null(F.col("velocidade_media")).alias("velocidade_media"),
        "sentido_desc",
        "data_referencia",
    )
    joined = named.join(_fleet(seen), "cod_linha", "left").join(
        lengths, F.col("letreiro_completo") == F.col("letreiro_gtfs"), "left"
    )
    fleet = F.coalesce("Qtd_Veiculos", F.lit(0).cast("bigint"))
    accessible = F.coalesce("Acessiveis", F.lit(0).cast("bigint"))
    measured = joined.withColumns({
        "Qtd_Veiculos": fleet,
        "Acessiveis": accessible,
        "extensao_km": F.coalesce("km", mean_length, F.lit(DEFAULT_LENGTH_KM)),
    }).withColumns({
        "tempo_estimado_h": F.try_divide("extensao_km", "velocidade_media"),
        "Perc_Acessivel": F.coalesce(
            F.try_divide("Acessiveis", "Qtd_Veiculos"), F.lit(0.0)
        ) * 100,
        "Status_Acessibilidade": access_status(F.col("Acessiveis"), F.col("Qtd_Veiculos")),
    }).drop("km", "letreiro_gtfs")
    if accessible_only:
        measured = measured.filter(F.col("Perc_Acessivel") > 0)
    return without_ghosts(measured) if hide_ghosts else measured


def without_ghosts(rows: DataFrame) -> DataFrame:
    """Keep lines with a known sign, a known route name and at least one vehicle."""
    return rows.filter(
        (F.col("letreiro_completo") != text.UNKNOWN_SIGN)
        & (F.col("nome_rota_oficial") != text.UNKNOWN_ROUTE)
        & (F.col("Qtd_Veiculos") > 0)
    )


def network_kpis(day: DataFrame) -> DataFrame:
    """Lines, vehicles, mean speed and network length in one row, as numbers and as display text."""
    totals = day.agg(
        F.count(F.lit(1)).alias("linhas"),
        F.coalesce(F.sum("Qtd_Veiculos"), F.lit(0)).alias("frota"),
        F.avg("velocidade_media").alias("velocidade"),
        F.coalesce(F.sum("extensao_km"), F.lit(0.0)).alias("extensao"),
    )
    return totals.withColumns({
        "velocidade_txt": F.concat(text.fixed_point(F.col("velocidade"), 1), F.lit(" km/h")),
        "extensao_txt": F.concat(text.grouped(F.col("extensao")), F.lit(" km")),
    })


def route_speeds(day: DataFrame) -> DataFrame:
    """Mean speed by route label."""
    return day.dropna(subset=["velocidade_media"]).groupBy("Rota").agg(
        F.avg("velocidade_media").alias("velocidade_media")
    )


def slowest(day: DataFrame, rows: int = 10) -> DataFrame:
    return route_speeds(day).orderBy(F.col("velocidade_media").asc(), "Rota").limit(rows)


def fastest(day: DataFrame, rows: int = 10) -> DataFrame:
    return route_speeds(day).orderBy(F.col("velocidade_media").desc(), "Rota").limit(rows)


def operations_table(day: DataFrame) -> DataFrame:
    """Operating figures by route, slowest first, routes without a speed last."""
    return day.select(
        "Rota", "velocidade_media", "extensao_km", "tempo_estimado_h", "Qtd_Veiculos",
        "Status_Acessibilidade",
    ).orderBy(F.col("velocidade_media").asc_nulls_last(), "Rota")


def arrival_answers(day: DataFrame, prompts: DataFrame | Sequence[str], literal: bool = False) -> DataFrame:
    """For each prompt the first matching route and the minutes to cover 1 and 5 km.

    ``prompts`` has a column ``prompt``, or is a list, whose patterns are checked at once. A prompt is a case-insensitive
    regular expression looked for anywhere in the label (plain text with ``literal``). Matches are ranked by label, line
    and direction. Outcomes: ``ok``, ``no line``, ``no speed``, ``bad prompt`` for a pattern that does not compile. Prompts
    meet labels by what they must hold, not one by one; the plan is the same for any number of them.
    """
    if not isinstance(prompts, DataFrame):
        if not literal:
            _check_patterns(day.sparkSession, prompts)
        prompts = day.sparkSession.createDataFrame([(p,) for p in prompts], "prompt string")
    asked = prompts.select("prompt").filter(F.col("prompt").isNotNull()).distinct()
    asked = asked.withColumn("valid", F.lit(True) if literal else matching.valid(F.col("prompt")))
    answer = F.struct("Rota", "Qtd_Veiculos", "velocidade_media")
    by_label = day.filter(F.col("Rota").isNotNull()).groupBy(F.col("Rota").alias("label")).agg(
        F.min_by(answer, F.struct("cod_linha", "sentido_desc")).alias("found"))
    first = matching.first_by_text if literal else matching.first_by_pattern
    best = first(by_label, asked.filter("valid")).join(by_label, "label").select("prompt", "found")
    speed = F.col("velocidade_media")

    def minutes(km: int) -> Column:
        return F.when(speed > 0, F.try_divide(F.lit(km), speed) * 60).cast("int")

    return asked.join(best, "prompt", "left").select("prompt", "valid", "found.*").select(
        "prompt",
        "Rota",
        F.col("Qtd_Veiculos").alias("frota"),
        "velocidade_media",
        minutes(1).alias("min_1km"),
        minutes(5).alias("min_5km"),
        F.when(~F.col("valid"), F.lit("bad prompt")).when(F.col("Rota").isNull(), F.lit("no line"))
        .when(speed > 0, F.lit("ok")).otherwise(F.lit("no speed")).alias("outcome"),
    )


def _check_patterns(spark: SparkSession, prompts: Sequence[str]) -> None:
    """Compile the patterns where they will run."""
    for prompt in prompts:
        try:
            spark._jvm.java.util.regex.Pattern.compile(matching.IGNORE_CASE + prompt)
        except SPARK_ERRORS as error:
            raise ValueError(f"prompt {prompt!r} is not a regular expression: {error}") from error
