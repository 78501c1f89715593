"""Log layer: parse lines, repair the new-visitor flag, split into branches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart import schemas
from tidemart.functions.json_rows import is_json_object, json_variant, parse_topic

ORDER = ("ts", "seq")


def good_lines(lines: DataFrame) -> DataFrame:
    return lines.where(is_json_object())


def dirty_lines(lines: DataFrame) -> DataFrame:
    """Lines that are not one JSON object, with their text."""
    return lines.where(~is_json_object())


def parse_logs(lines: DataFrame) -> DataFrame:
    """Typed log rows of the good lines."""
    return parse_topic(good_lines(lines), schemas.LOG)


def checked_lines(lines: DataFrame) -> DataFrame:
    """Lines with `good`, whether each is one JSON object: for jobs that use both kinds."""
    return lines.withColumn("good", is_json_object())


def parse_checked(checked: DataFrame) -> DataFrame:
    """Typed log rows of the lines found good."""
    return parse_topic(checked.where("good").drop("good"), schemas.LOG)


def first_new_rows(logs: DataFrame, order=ORDER) -> DataFrame:
    """Place (mid and order columns) of the first row flagged new, per mid.

    Rank one per key is pruned before the shuffle, so a mid with very many rows sends
    one row per task.
    """
    ranked = (logs.where((F.col("common.is_new") == "1") & F.col("common.mid").isNotNull())
              .select(F.col("common.mid").alias("mid"), *order)
              .withColumn("rank", F.row_number().over(Window.partitionBy("mid").orderBy(*order))))
    return ranked.where("rank = 1").drop("rank")


def repair_new_flags(logs: DataFrame, order=ORDER, firsts: DataFrame | None = None) -> DataFrame:
    """Keep is_new = '1' only on the first such row of a mid; later ones become '0'.

    `order` must tell the rows of one mid apart (event time, then the offset in the topic).
    The rows are matched on mid *and* order columns: that key is as good as unique, so one
    mid with a third of all rows still spreads over all tasks.
    """
    if firsts is None:
        firsts = first_new_rows(logs, order)
    marks = firsts.select(F.col("mid").alias("_mid"),
                          *[F.col(c).alias(f"_{c}") for c in order])
    same = F.col("common.mid") == F.col("_mid")
    for c in order:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    later = ((F.col("common.is_new") == "1") & F.col("common.mid").isNotNull()
             & F.col("_mid").isNull())
    flag = F.when(later, F.lit("0")).otherwise(F.col("common.is_new"))
    return (logs.join(marks, same, "left")
            .withColumn("common", F.col("common").withField("is_new", flag))
            .select(*logs.columns))


def payload(logs: DataFrame, line: str = "line") -> DataFrame:
    """The lines of the rows as they came, every key of them, with the repaired flag.

    `line` is the text that a row was parsed from. Only lines whose flag has changed are written
    anew, with names in order and of a repeated name the last.
    """
    whole = json_variant(line)
    top = F.try_variant_get(whole, "$", "map<string,variant>")
    common = F.try_variant_get(whole, "$.common", "map<string,variant>")

    def put(pairs: Column, name: str, value: Column) -> Column:
        return F.to_json(F.map_concat(F.map_filter(pairs, lambda k, _: k != name),
                                      F.create_map(F.lit(name), value)))
    repaired = F.parse_json(put(common, "is_new", F.parse_json(F.lit('"0"'))))
    changed = (F.try_variant_get(whole, "$.common.is_new", "string") == "1") & (
        F.col("common.is_new") == "0")
    return logs.select(F.when(changed, put(top, "common", repaired)).otherwise(F.col(line))
                       .alias("value"))


def _is_start() -> Column:
    return F.coalesce(F.length("start") > 0, F.lit(False))


def start_logs(logs: DataFrame) -> DataFrame:
    return logs.where(_is_start())


def page_logs(logs: DataFrame) -> DataFrame:
    return logs.where(~_is_start()).drop("start")


def display_logs(pages: DataFrame) -> DataFrame:
    """One row per display of a page: all keys of the display, and the page it was shown on."""
    shown = pages.select(F.explode("displays").alias("display"),
                         F.col("page.page_id").alias("page_id"))
    # map_filter first: a display that brings its own page_id is overruled by the page.
    own = F.map_filter("display", lambda key, _: key != "page_id")
    return shown.select(F.map_concat(own, F.create_map(F.lit("page_id"), F.col("page_id")))
                        .alias("display"))
