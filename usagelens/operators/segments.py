"""AN9 / AN10: country and plan segments."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.functions import round_half_even


def _churn(col="churn_flag"):
    return round_half_even(F.avg(F.col(col).cast("int")), 3).alias("churn_rate")


def segment_by_country(metrics: DataFrame) -> DataFrame:
    """Users, mean sessions, mean revenue, churn rate per country; largest first."""
    return (metrics.where(F.col("country").isNotNull())
            .groupBy("country")
            .agg(F.count("user_id").alias("total_users"),
                 F.avg("sessions_total").alias("avg_sessions"),
                 F.avg("payments_total").alias("avg_revenue"),
                 _churn())
            .orderBy(F.desc("total_users"), F.asc("country")))


def segment_by_plan(metrics: DataFrame) -> DataFrame:
    """Users, mean payment, mean sessions, churn rate per modal plan; largest first."""
    return (metrics.where(F.col("plans").isNotNull())
            .groupBy("plans")
            .agg(F.count("user_id").alias("total_users"),
                 F.avg("payments_total").alias("avg_payment"),
                 F.avg("sessions_total").alias("avg_sessions"),
                 _churn())
            .orderBy(F.desc("total_users"), F.asc("plans")))
