"""Keyword statistics, as SQL over the page-log table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart import codes
from tidemart.functions.times import whole_seconds, with_event_time
from tidemart.functions.words import SEPARATORS, dictionary_matches


def page_log_table(pages: DataFrame, delay: str = "0 seconds", view: str = "page_log") -> str:
    """The topic as an SQL table: common and page as maps, rowtime in whole seconds."""
    with_event_time(pages, whole_seconds("ts"), delay, "rowtime").createOrReplaceTempView(view)
    return view


def search_rows(pages: DataFrame, delay: str = "0 seconds", view: str = "page_log") -> DataFrame:
    """Texts that were searched for.

    The filter mentions rowtime, which keeps it above the watermark on a stream: every page
    moves the time on, also one that is no search.
    """
    table = page_log_table(pages, delay, view)
    return pages.sparkSession.sql(f"""
        SELECT page['item'] AS fullWords, rowtime
        FROM {table}
        WHERE CASE WHEN rowtime IS NOT NULL
              THEN page['last_page_id'] = 'search' AND page['item'] IS NOT NULL END""")


def search_words(search: DataFrame, splitter: str | None = None,
                 view: str = "search_rows") -> DataFrame:
    """One row per word. Built-in functions by default; `splitter` names a table function."""
    search.createOrReplaceTempView(view)
    if splitter:
        return search.sparkSession.sql(
            f"SELECT word, rowtime FROM {view}, LATERAL {splitter}(fullWords)")
    return search.sparkSession.sql(f"""
        SELECT word, rowtime
        FROM {view} LATERAL VIEW explode(split(lower(fullWords), r'{SEPARATORS}')) w AS word
        WHERE word <> ''""")


def keyword_stats(search: DataFrame, width: str = "10 seconds", splitter: str | None = None,
                  dictionary: DataFrame | None = None, source: str = codes.KEYWORD_SOURCE["search"],
                  view: str = "search_words") -> DataFrame:
    """Number of searches per tumbling window and word."""
    if dictionary is not None:
        words = dictionary_matches(search, "fullWords", dictionary)
    else:
        words = search_words(search, splitter)
    words.createOrReplaceTempView(view)
    return search.sparkSession.sql(f"""
        WITH windowed AS (SELECT window(rowtime, '{width}') AS window, word FROM {view})
        SELECT word AS keyword, count(*) AS ct, '{source}' AS source,
               date_format(window.start, 'yyyy-MM-dd HH:mm:ss') AS stt,
               date_format(window.end, 'yyyy-MM-dd HH:mm:ss') AS edt
        FROM windowed
        GROUP BY window, word""")
