"""Queries of the map over the final layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rooftop import config
from rooftop.functions.geometry import tile
from rooftop.functions.values import mapped

# Labels and messages that the map shows, and the colours of its classes.
MATCH_LABELS = {
    "N:1": "Несколько → одно",
    "1:1": "Точное совпадение",
    "A_only": "Только источник А",
    "B_only": "Только источник Б",
    "1:N": "Одно → несколько",
    "N:N": "Сложное совпадение",
}
INSIGHTS = {
    "dense": ("danger", "Критическая плотность", "Высокий риск интерференции и затухания 5G. Рекомендуется архитектура Small Cells для компенсации потерь в каньонах"),
    "unsure": ("warning", "Низкая уверенность в данных", "Геометрия объекта интерполирована. Требуется верификация перед планированием БС."),
    "risk": ("danger", "Риск покрытия высокий", "Зона теплового острова. Рекомендация: сократить интервал чистки систем охлаждения БС из-за застоя воздуха и пыли."),
    "middle": ("warning", "Умеренная зона", "Возможно перекрытие сигнала. Рекомендация: оптимизация механического наклона (tilt) антенн для минимизации зон тени."),
    "good": ("good", "Зона с хорошим покрытием", "Разреженная застройка. Идеально для размещения Macro-позиций с широким радиусом обслуживания."),
}
COLOURS = {
    "confidence": {"high": "#00c864", "medium": "#ffc800", "low": "#969696"},
    "density": {"high": "#dc3232", "medium": "#ffa500", "low": "#508cdc"},
    "eco_risk": {"high": "#dc3232", "medium": "#ffa500", "low": "#00c864"},
}
LAYERS = {"confidence": "Уверенность", "density": "Плотность", "eco_risk": "Эко риск"}
LEGENDS = {
    "confidence": {"high": "Высокая ≥ 0.8", "medium": "Средняя ≥ 0.5", "low": "Низкая / ML"},
    "density": {"high": "Очень плотно ≥ 0.7", "medium": "Средняя ≥ 0.4", "low": "Разреженно"},
    "eco_risk": {"high": "Высокий риск", "medium": "Средний риск", "low": "Низкий риск"},
}
#: Letters that a search needs, and rows that it gives.
SEARCH_LETTERS, SEARCH_ROWS = 3, 5


def height_filter(layer: DataFrame, low: float = 0.0, high: float = 462.0) -> DataFrame:
    """Rows whose height, 0 where unknown, is in the range, both ends included."""
    return layer.where(F.coalesce("height_final_full", F.lit(0.0)).between(low, high))


def confidence_class(score: Column) -> Column:
    score = F.coalesce(score, F.lit(0.0))
    return F.when(score >= 0.8, "high").when(score >= 0.5, "medium").otherwise("low")


def density_class(score: Column) -> Column:
    score = F.coalesce(score, F.lit(0.0))
    return F.when(score >= 0.7, "high").when(score >= 0.4, "medium").otherwise("low")


def eco_class(level: Column) -> Column:
    return F.when(level.isin("high", "medium"), level).otherwise("low")


def paint(layer: DataFrame, by: str = "density") -> DataFrame:
    """Adds paint_class, paint_colour and paint_label (of the legend) of the chosen layer, and elevation."""
    chosen = {
        "confidence": confidence_class(F.col("confidence_score")),
        "density": density_class(F.col("dense_score")),
        "eco_risk": eco_class(F.col("eco_risk_level")),
    }[by]
    layer = layer.withColumn("paint_class", chosen)
    return layer.withColumns(
        {
            "paint_colour": mapped(F.col("paint_class"), COLOURS[by], None),
            "paint_label": mapped(F.col("paint_class"), LEGENDS[by], None),
            "elevation": F.coalesce("height_final_full", F.lit(0.0)),
        }
    )


def insight(layer: DataFrame) -> DataFrame:
    """Adds insight_level, insight_title, insight_text; the first condition that holds decides."""
    dense, sure, level = F.coalesce("dense_score", F.lit(0.0)), F.coalesce("confidence_score", F.lit(0.0)), F.coalesce("eco_risk_level", F.lit("medium"))
    which = F.when(dense >= 0.7, "dense").when(sure < 0.3, "unsure").when(level == "high", "risk").when(
        (level == "medium") | (dense >= 0.4),
        "middle",
    ).otherwise("good")
    return layer.withColumns(
        {f"insight_{n}": mapped(which, {k: v[i] for k, v in INSIGHTS.items()}, None) for i, n in enumerate(("level", "title", "text"))}
    )


def match_label(kind: Column) -> Column:
    return F.coalesce(mapped(kind, MATCH_LABELS, None), kind, F.lit("—"))


def tooltip(layer: DataFrame) -> DataFrame:
    """Adds the tooltip's texts: height with one decimal, scores in whole per cent, a dash for nulls.

    A height is rounded as ten times its value: sums leave the last bit of a half open, and the product closes it.
    """
    percent = lambda c: F.coalesce(F.concat(F.round(F.col(c) * 100, 0).cast("int").cast("string"), F.lit("%")), F.lit("—"))
    height = F.concat((F.round(F.col("height_final_full") * 10, 0) / 10).cast("decimal(12,1)").cast("string"), F.lit(" м"))
    return layer.withColumns(
        {
            "tip_height": F.coalesce(height, F.lit("—")),
            "tip_confidence": percent("confidence_score"),
            "tip_density": percent("dense_score"),
            "tip_match": match_label(F.col("match_type")),
            "tip_risk": F.coalesce("eco_risk_level", F.lit("—")),
        }
    )


def search(rows: DataFrame, text: str, column: str = "address", order: str = "row_idx", limit: int = SEARCH_ROWS) -> DataFrame:
    """The first rows, by text and then order, whose text holds the words asked for, letter case aside; none for fewer
    than three letters. It stands for the map's address search, over the layer's own addresses."""
    found = rows.where(F.col(column).isNotNull() & F.contains(F.lower(column), F.lit(text.lower())))
    return (found if len(text) >= SEARCH_LETTERS else found.limit(0)).orderBy(column, order).limit(limit)


def tiles(layer: DataFrame, zooms: range = range(10, 17)) -> DataFrame:
    """A row for each zoom with the tile z, x, y that holds the point lon, lat."""
    each = [F.struct(F.lit(z).alias("z"), *[c.alias(n) for n, c in zip("xy", tile(F.col("lon"), F.col("lat"), z), strict=True)]) for z in zooms]
    return layer.where("lon is not null and lat is not null").select("*", F.inline(F.array(*each)))


def frontend(layer: DataFrame) -> DataFrame:
    """The map's columns that are there."""
    return layer.select(*[c for c in config.FRONTEND_COLUMNS if c in layer.columns])
