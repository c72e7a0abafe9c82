"""Twenty insurance questions: orders as policies, line items as claims, parts as products, suppliers as agents."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.operators import aggregates as agg
from tidemill.sources.schemas import INSURANCE
from tidemill.sources.tables import conformed, table

AS_OF = "2001-08-01"


def customers(spark, folder):
    return table(spark, folder, "customer")


def policies(spark, folder):
    return table(spark, folder, "orders")


def claims(spark, folder):
    return table(spark, folder, "lineitem")


def products(spark, folder):
    return table(spark, folder, "part")


def agents(spark, folder):
    return table(spark, folder, "supplier")


def ins_premium_by_type(spark, folder):
    return products(spark, folder).groupBy("p_type").agg(
        agg.money_mean("p_retailprice").alias("avg_premium"), F.max("p_retailprice").alias("max_premium"),
        F.min("p_retailprice").alias("min_premium"),
    )


def ins_policies_per_customer(spark, folder):
    # Policies are added up per customer before names are attached.
    sums = policies(spark, folder).groupBy("o_custkey").agg(
        F.count("*").alias("n_policies"), agg.money_sum("o_totalprice").alias("total_premium")
    )
    return sums.join(customers(spark, folder), F.col("o_custkey") == F.col("c_custkey")).select(
        "c_custkey", "c_name", "n_policies", "total_premium"
    )


def ins_beneficiary_extremes(spark, folder):
    means = claims(spark, folder).groupBy("l_suppkey").agg(
        agg.money_mean("l_extendedprice").alias("avg_amount"), F.count("*").alias("n_claims")
    )
    return agg.with_extremes(means, "avg_amount")


def ins_new_policies_by_month(spark, folder):
    monthly = agg.month_totals(policies(spark, folder), "o_orderdate", [], F.count("*"), "n_policies")
    return agg.with_extremes(monthly, "n_policies").select("month", "n_policies", F.col("is_highest").alias("is_peak"))


def ins_payment_status_mix(spark, folder):
    return policies(spark, folder).groupBy("o_custkey").agg(
        *[F.count_if(F.col("o_orderstatus") == status).alias(status) for status in ("F", "O", "P")],
        F.count("*").alias("n_policies"),
    )


def ins_short_term(spark, folder):
    """Claims settled within 60 days of the start of their policy."""
    starts = policies(spark, folder).select("o_orderkey", "o_orderdate")
    both = claims(spark, folder).select("l_orderkey", "l_shipdate", "l_extendedprice").join(
        starts, F.col("l_orderkey") == F.col("o_orderkey")
    )
    return both.filter(F.datediff("l_shipdate", "o_orderdate") <= 60).agg(
        F.count("*").alias("n_short"), agg.money_mean("l_extendedprice").alias("avg_premium")
    )


def ins_average_per_holder(spark, folder):
    means = policies(spark, folder).groupBy("o_custkey").agg(agg.money_mean("o_totalprice").alias("avg_premium"))
    return agg.with_extremes(means, "avg_premium")


def ins_rider_sales(spark, folder):
    return policies(spark, folder).groupBy("o_orderpriority").agg(
        F.count("*").alias("n_policies"), agg.money_sum("o_totalprice").alias("total_premium")
    )


def ins_agent_sales(spark, folder):
    sums = claims(spark, folder).groupBy("l_suppkey").agg(
        F.count("*").alias("n_policies"), agg.money_sum("l_extendedprice").alias("total_premium")
    )
    return agents(spark, folder).join(sums, F.col("s_suppkey") == F.col("l_suppkey")).select(
        "s_suppkey", "s_name", "n_policies", "total_premium"
    )


def ins_status_over_time(spark, folder):
    return agg.month_totals(policies(spark, folder), "o_orderdate", ["o_orderstatus"], F.count("*"), "n_policies")


def ins_customer_contacts(spark, folder):
    return customers(spark, folder).select("c_name", "c_mktsegment")


def ins_spouses(spark, folder):
    """Customers of one segment with the related party, here the nation."""
    nations = table(spark, folder, "nation")
    return customers(spark, folder).filter(F.col("c_mktsegment") == "BUILDING").join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    ).select("c_custkey", "c_name", "n_name")


def ins_unpaid_policies(spark, folder):
    unpaid = policies(spark, folder).filter(F.col("o_orderstatus") == "P").select("o_orderkey", "o_custkey")
    return unpaid.join(customers(spark, folder), F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "c_name"
    )


def ins_large_claims(spark, folder):
    large = claims(spark, folder).filter(F.col("l_extendedprice") > 10000).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"
    )
    holders = policies(spark, folder).select("o_orderkey", "o_custkey").join(
        customers(spark, folder).select("c_custkey", "c_name", "c_mktsegment"),
        F.col("o_custkey") == F.col("c_custkey"),
    )
    return large.join(holders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "o_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "c_name", "c_mktsegment"
    )


def ins_agents_by_expiry(spark, folder):
    last = claims(spark, folder).groupBy("l_suppkey").agg(F.max("l_shipdate").alias("licence_expiry"))
    return agents(spark, folder).join(last, F.col("s_suppkey") == F.col("l_suppkey")).select(
        "s_suppkey", "s_name", "licence_expiry"
    ).orderBy("licence_expiry", "s_suppkey")


def ins_products_by_premium(spark, folder):
    return products(spark, folder).select("p_partkey", "p_name", "p_retailprice").orderBy(
        F.desc("p_retailprice"), "p_partkey"
    )


def ins_region_staff(spark, folder):
    nations = table(spark, folder, "nation").join(
        table(spark, folder, "region").filter(F.col("r_name") == "ASIA"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return agents(spark, folder).join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_name", "n_name", "r_name"
    )


def ins_young_customers(spark, folder):
    """Policies younger than 30 months on a stated day."""
    born = F.to_date("o_orderdate")
    as_of = F.lit(AS_OF).cast("date")
    return policies(spark, folder).select("o_orderkey", "o_custkey", born.alias("born")).filter(
        F.col("born") > F.add_months(as_of, -30)
    )


def ins_reviewed_unpaid(spark, folder):
    """Policies under way without any returned claim."""
    returned = claims(spark, folder).filter(F.col("l_returnflag") == "R").select("l_orderkey")
    reviewed = policies(spark, folder).filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_totalprice")
    return reviewed.join(returned, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti")


def ins_products_per_type(spark, folder):
    return products(spark, folder).groupBy("p_type").agg(
        agg.money_mean("p_retailprice").alias("avg_premium"), F.count("*").alias("n_products")
    )


def ins_policy_table(spark, folder):
    """Orders as rows of the policy table; what orders do not know stays empty."""
    rows = policies(spark, folder).selectExpr(
        "o_orderkey AS PolicyNumber", "o_custkey AS CustomerID", "o_orderstatus AS PolicyStatus",
        "o_orderdate AS PolicyStartDate", "o_orderpriority AS PaymentMethod", "o_totalprice",
    )
    return conformed(rows, INSURANCE["PolicyInfo"])


def ins_claim_table(spark, folder):
    """Line items as rows of the claim table."""
    rows = claims(spark, folder).selectExpr(
        "l_orderkey * 10 + l_linenumber AS ClaimNumber", "l_orderkey AS PolicyNumber", "l_shipdate AS ClaimDate",
        "l_returnflag AS ClaimType", "l_extendedprice AS ClaimAmount", "l_linestatus AS ClaimStatus",
    )
    return conformed(rows, INSURANCE["ClaimInfo"])


def ins_customer_table(spark, folder):
    """Customers as rows of the customer table, registered with their first order."""
    since = policies(spark, folder).groupBy("o_custkey").agg(F.min("o_orderdate").alias("since"))
    rows = customers(spark, folder).join(since, F.col("c_custkey") == F.col("o_custkey"), "left").selectExpr(
        "c_custkey AS CustomerID", "c_name AS Name", "since AS RegistrationDate", "c_mktsegment AS CustomerType",
        "if(c_acctbal < 0, 'owing', 'active') AS CustomerStatus")
    return conformed(rows, INSURANCE["CustomerInfo"])


def ins_beneficiary_table(spark, folder):
    """Suppliers as rows of the beneficiary table."""
    rows = agents(spark, folder).join(table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).selectExpr(
        "s_suppkey AS BeneficiaryID", "s_name AS Name", "n_name AS Nationality")
    return conformed(rows, INSURANCE["BeneficiaryInfo"])


def ins_agent_table(spark, folder):
    """Suppliers as rows of the agent table; a licence runs from the first to the last shipment."""
    terms = claims(spark, folder).groupBy("l_suppkey").agg(F.min("l_shipdate").alias("first"), F.max("l_shipdate").alias("last"))
    rows = agents(spark, folder).join(terms, F.col("s_suppkey") == F.col("l_suppkey")).selectExpr(
        "s_suppkey AS AgentID", "s_name AS Name", "first AS LicenseIssueDate", "last AS LicenseExpirationDate")
    return conformed(rows, INSURANCE["AgentInfo"])


def ins_product_table(spark, folder):
    """Parts as rows of the product table."""
    rows = products(spark, folder).selectExpr(
        "p_partkey AS ProductID", "p_name AS ProductName", "p_type AS ProductType", "p_brand AS ProductFeatures",
        "p_size AS CoverageTerm", "p_retailprice AS Premium")
    return conformed(rows, INSURANCE["ProductInfo"])


def ins_employee_table(spark, folder):
    """Suppliers as rows of the employee table: their nation the department, their region the place of work."""
    rows = agents(spark, folder).join(table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")).selectExpr(
        "s_suppkey AS EmployeeID", "s_name AS Name", "n_name AS Department", "s_acctbal AS Salary", "r_name AS Location")
    return conformed(rows, INSURANCE["EmployeeInfo"])


QUERIES = {name: fn for name, fn in globals().items() if name.startswith("ins_")}
