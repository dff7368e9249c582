"""Course completion score (C1; A13, E17, J1, F10, T3).

Per course: chapters per course; each user's distinct chapters viewed; the
viewed share of the course's chapters turned into points by band; the mean
points per course, titled, highest first. Users who viewed nothing in a course
do not count for it.

Stand-ins (TESTDATA): course = region, chapter = nation (``n_regionkey`` is
the course), title = ``r_name``, a view = (customer, supplier nation) for
every line item a customer ordered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.scoring import band_score
from tidewater.operators import aggregates as agg
from tidewater.plans.registry import register
from tidewater.sources.tables import read_table


def course_scores(chapters: DataFrame, views: DataFrame, titles: DataFrame) -> DataFrame:
    """chapters(course_id, chapter_id), views(user_id, chapter_id), titles(course_id, title)
    -> (title, score) ordered by score desc.

    Every aggregate is partial + final; the small sides (chapters, per-course
    totals, titles) are broadcast by Spark's size statistics.
    """
    per_course = agg.count_by(chapters, ["course_id"], "chapter_count")
    seen = views.select("user_id", "chapter_id").distinct()
    # chapters, per-course counts and titles are small tables of known size:
    # Spark broadcasts them by its own statistics (and AQE by measured sizes)
    course_of = seen.join(chapters, "chapter_id")
    viewed = agg.count_by(course_of, ["user_id", "course_id"], "viewed")
    ratio = viewed.join(per_course, "course_id").select(
        "course_id", band_score(F.col("viewed") / F.col("chapter_count")).alias("points")
    )
    mean = ratio.groupBy("course_id").agg(F.avg("points").alias("score"))
    titled = mean.join(titles, "course_id")
    return titled.select("title", "score").orderBy(F.col("score").desc(), F.col("title"))


def customer_views(spark: SparkSession, d: str) -> DataFrame:
    """(user_id, chapter_id) = (o_custkey, s_nationkey) per line item; the later
    distinct on both combines its rows in the tasks that join the orders."""
    li = read_table(spark, d, "lineitem", "l_orderkey", "l_suppkey")
    sup = read_table(spark, d, "supplier", "s_suppkey", "s_nationkey")
    order_nations = li.join(sup, li["l_suppkey"] == sup["s_suppkey"]).select("l_orderkey", "s_nationkey")
    orders = read_table(spark, d, "orders", "o_orderkey", "o_custkey")
    return order_nations.join(orders, order_nations["l_orderkey"] == orders["o_orderkey"]).select(
        F.col("o_custkey").alias("user_id"), F.col("s_nationkey").alias("chapter_id")
    )


_SQL = """
WITH chapters AS (SELECT n_nationkey AS chapter_id, n_regionkey AS course_id FROM nation),
     chapter_counts AS (SELECT course_id, count(*) AS chapter_count FROM chapters GROUP BY course_id),
     views AS (SELECT DISTINCT o_custkey AS user_id, s_nationkey AS chapter_id
               FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey),
     viewed AS (SELECT user_id, course_id, count(*) AS viewed
                FROM views JOIN chapters USING (chapter_id) GROUP BY user_id, course_id),
     points AS (SELECT course_id, CASE WHEN viewed * 100 >= 90 * chapter_count THEN 10 WHEN viewed * 100 >= 50 * chapter_count THEN 4
                             WHEN viewed * 100 >= 25 * chapter_count THEN 2 ELSE 0 END AS points
                FROM viewed JOIN chapter_counts USING (course_id))
SELECT r_name AS title, avg(points) AS score
FROM points JOIN region ON course_id = r_regionkey
GROUP BY r_name ORDER BY score DESC, title
"""


@register("course_scores", _SQL, ("C1", "A13", "E17", "F10", "J1", "T3", "P6"))
def course_scores_q(spark: SparkSession, d: str) -> DataFrame:
    chapters = read_table(spark, d, "nation", "n_nationkey", "n_regionkey").select(
        F.col("n_regionkey").alias("course_id"), F.col("n_nationkey").alias("chapter_id")
    )
    titles = read_table(spark, d, "region", "r_regionkey", "r_name").select(
        F.col("r_regionkey").alias("course_id"), F.col("r_name").alias("title")
    )
    return course_scores(chapters, customer_views(spark, d), titles)
