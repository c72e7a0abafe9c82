"""Park revenue: one row of visitor counts, weather and revenue per day, made from the events."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions.values import days_since, event_code
from tidemill.operators import models
from tidemill.operators.joins import left_lookup
from tidemill.sources.tables import sql_scan, table


def park_days(spark, folder):
    """Event types stand for visitor types; the weekend stands for a named event."""
    def visitors(kind):
        return F.count(F.when(F.col("event_type") == kind, 1))

    revenue = F.sum(F.col("value").cast("decimal(18,2)")).cast("double")
    days = table(spark, folder, "events").groupBy(F.to_date("ts").alias("date")).agg(
        F.count("*").alias("total_attendance"),
        visitors("click").alias("ap_attendance"),
        visitors("view").alias("ticket_attendance"),
        visitors("purchase").alias("promotional_ticket_attendance"),
        (visitors("error") * 100 / F.count("*")).alias("beijing_guest_ratio"),
        F.max("value").alias("max_temperature"),
        F.count_distinct(F.hour("ts")).cast("double").alias("operating_hours"),
        revenue.alias("total_fb_revenue"),
        (revenue / F.count("*")).alias("rev_per_cap"),
    )
    name = F.when(F.dayofweek("date").isin(1, 7), "Honor Of King").otherwise("无活动")
    return days.withColumn("week_days", F.date_format("date", "EEEE")).withColumn("marquee_event", event_code(name))


def park_days_of_event(spark, folder):
    """The days of one event, the event number bound as a parameter."""
    park_days(spark, folder).createOrReplaceTempView("park_revenue")
    return sql_scan(
        spark,
        """SELECT date, ap_attendance, ticket_attendance, promotional_ticket_attendance, total_fb_revenue
           FROM park_revenue WHERE marquee_event = :event""",
        event=2,
    )


def tree_features(spark, folder):
    features = models.tree_features(park_days(spark, folder), "rev_per_cap")
    return features.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in features.dtypes])


def ols_slope(spark, folder):
    """Revenue against visitors per event, one feature."""
    slopes = models.single_slope(park_days(spark, folder), ["marquee_event"], "total_attendance", "total_fb_revenue")
    return slopes.withColumns({c: F.round(c, 4) for c in ("slope", "intercept")})


def ols_drivers(spark, folder):
    fitted = models.spend_drivers(park_days(spark, folder), 0)
    return models.relative_importance(fitted).withColumns({c: F.round(c, 3) for c in ("value", "relative")})


WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def ols_weekdays(spark, folder):
    """Revenue against visitors, the day number and the weekday by its name; Monday is the base."""
    days = park_days(spark, folder).withColumn("date_diff", days_since(F.col("date")))
    fitted = models.ols_with_strings(days, ["total_attendance", "date_diff"], {"week_days": WEEKDAYS}, "total_fb_revenue")
    return fitted.withColumn("value", F.round("value", 3))


def ols_drivers_of_type(spark, folder):
    return models.spend_drivers(park_days(spark, folder), 0, ["ap_attendance"]).withColumn(
        "value", F.round("value", 3)
    )


def ols_important(spark, folder):
    return models.important_features(ols_drivers(spark, folder))


def ols_conclusion(spark, folder):
    return models.conclusion(models.spend_drivers(park_days(spark, folder), 0))


def rounded_factors(spark, folder, question):
    found = models.influence_factors(park_days(spark, folder), question)
    return found.select("feature", F.round("importance", 6).alias("importance"), F.round("mse", 3).alias("mse"))


def cart_drivers(spark, folder):
    return rounded_factors(spark, folder, "总消费")


def cart_drivers_per_head(spark, folder):
    return rounded_factors(spark, folder, "人均消费")


def cart_rules(spark, folder):
    """The nodes of the tree for total revenue, with the split and the prediction of each."""
    target = "total_fb_revenue"
    model, _ = models.fit_tree(models.tree_features(park_days(spark, folder), target), target)
    return models.tree_rules(model, spark).withColumns({c: F.round(c, 6) for c in ("threshold", "prediction")})


def geo_lookup(spark, folder):
    """Customers per nation with the region feature; nation numbers are moved up so that the map lacks the last ones."""
    features = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select(F.col("n_nationkey").alias("c_nationkey"), F.col("r_name").alias("feature"))
    moved = (F.col("c_nationkey") + 5).alias("c_nationkey")
    counts = table(spark, folder, "customer").groupBy(moved).agg(F.count("*").alias("value"))
    found = left_lookup(counts, features, "c_nationkey", ["feature"])
    return found.withColumn("matched", F.col("feature").isNotNull())


QUERIES = {
    "park_days_of_event": park_days_of_event,
    "tree_features": tree_features,
    "ols_slope": ols_slope,
    "ols_drivers": ols_drivers,
    "ols_weekdays": ols_weekdays,
    "ols_drivers_of_type": ols_drivers_of_type,
    "ols_important": ols_important,
    "ols_conclusion": ols_conclusion,
    "cart_drivers": cart_drivers,
    "cart_drivers_per_head": cart_drivers_per_head,
    "cart_rules": cart_rules,
    "geo_lookup": geo_lookup,
}
