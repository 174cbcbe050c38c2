"""The served tables and the five summary reports as named relations.

``register`` makes ``SELECT * FROM top_repositories`` and the like work over a
lake: every table under its own name (declared schema, 0 rows before its first
write), every report as a view on them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schema import TABLE_SCHEMAS
from ..sources.events import metric_table
from . import reports

VIEWS = ("aggregated_metrics", "top_repositories", "top_users", "top_languages",
         "event_type_summary")


def register(spark: SparkSession, root: str, as_of=None,
             prefix: str = "") -> dict[str, DataFrame]:
    """Temporary views of the tables and reports of a lake; returns them."""
    made = {name: metric_table(spark, root, name) for name in TABLE_SCHEMAS}
    made |= {
        "aggregated_metrics": reports.aggregated_metrics(made["repository_metrics"]),
        "top_repositories": reports.top_repositories(made["repository_metrics"], as_of),
        "top_users": reports.top_users(made["user_activity"], as_of),
        "top_languages": reports.top_languages(made["language_trends"], as_of),
        "event_type_summary": reports.event_type_summary(made["event_type_distribution"], as_of),
    }
    for name, df in made.items():
        df.createOrReplaceTempView(prefix + name)
    return made
