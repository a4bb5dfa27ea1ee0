"""Target generation: `(site_id, ordinal, url, max_scroll_rounds)`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill import fixed_values as V
from gristmill.functions import percent_encode
from gristmill.session import small_table

PAGED = "site_id string, template string, first_page int, last_page int, max_scroll_rounds int"


def paged_targets(templates: DataFrame) -> DataFrame:
    """One target per page number of each template; `{page}` in the template is replaced.

    A template without `{page}` and with one page is a single target, e.g. a page to scroll.
    """
    # sequence() would count down over an empty range
    some = templates.where(F.col("first_page") <= F.col("last_page"))
    pages = some.withColumn("page", F.explode(F.sequence("first_page", "last_page")))
    return pages.select(
        "site_id",
        (F.col("page") - F.col("first_page")).alias("ordinal"),
        F.replace("template", F.lit("{page}"), F.col("page").cast("string")).alias("url"),
        "max_scroll_rounds",
    )


def title_targets(titles: DataFrame) -> DataFrame:
    """One target per row of `titles(site_id, ordinal, base_url, title)`, percent-encoded."""
    return titles.select(
        "site_id",
        "ordinal",
        F.concat("base_url", percent_encode(F.col("title"))).alias("url"),
        F.lit(0).alias("max_scroll_rounds"),
    )


def registered_targets(spark: SparkSession) -> DataFrame:
    """The frontier of the four registered sites."""
    paged = small_table(spark, V.PAGED_FRONTIERS, PAGED)
    titles = small_table(
        spark,
        [
            (V.ARTICLE_SITE, ordinal, V.ARTICLE_BASE_URL, title)
            for ordinal, title in enumerate(V.ARTICLE_TITLES)
        ],
        "site_id string, ordinal int, base_url string, title string",
    )
    return paged_targets(paged).unionByName(title_targets(titles))
