"""SQL for the insurance questions."""


def blank(names: str, kind: str = "VARCHAR") -> str:
    return ", ".join(f"NULL::{kind} AS {n}" for n in names.split())


ORACLES = {
    "ins_customer_table": f"""SELECT c_custkey::INT AS CustomerID, c_name AS Name, min(o_orderdate)::DATE AS RegistrationDate,
        c_mktsegment AS CustomerType, CASE WHEN c_acctbal < 0 THEN 'owing' ELSE 'active' END AS CustomerStatus,
        {blank("Gender IDNumber Address PhoneNumber EmailAddress MaritalStatus Occupation HealthStatus SourceOfCustomer")},
        {blank("DateOfBirth", "DATE")} FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_name,
        c_mktsegment, c_acctbal""",
    "ins_beneficiary_table": f"""SELECT s_suppkey::INT AS BeneficiaryID, s_name AS Name, n_name AS Nationality,
        {blank("Gender Address PhoneNumber EmailAddress")}, {blank("DateOfBirth", "DATE")}
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "ins_agent_table": f"""SELECT s_suppkey::INT AS AgentID, s_name AS Name, min(l_shipdate)::DATE AS LicenseIssueDate,
        max(l_shipdate)::DATE AS LicenseExpirationDate,
        {blank("Gender Address PhoneNumber EmailAddress CertificateNumber CommissionStructure")}, {blank("DateOfBirth", "DATE")}
        FROM supplier JOIN lineitem ON s_suppkey = l_suppkey GROUP BY 1, 2""",
    "ins_product_table": f"""SELECT p_partkey::INT AS ProductID, p_name AS ProductName, p_type AS ProductType,
        p_brand AS ProductFeatures, p_size::INT AS CoverageTerm, p_retailprice::DECIMAL(10,2) AS Premium,
        {blank("CoverageRange PaymentFrequency AgeLimit PremiumCalculation ClaimsProcess UnderwritingRequirements")},
        {blank("SalesRegion ProductStatus")} FROM part""",
    "ins_employee_table": f"""SELECT s_suppkey::INT AS EmployeeID, s_name AS Name, n_name AS Department,
        s_acctbal::DECIMAL(10,2) AS Salary, r_name AS Location,
        {blank("Gender Address PhoneNumber EmailAddress Position Supervisor EmployeeType EmployeeStatus")},
        {blank("DateOfBirth HireDate", "DATE")} FROM supplier JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "ins_policy_table": """SELECT o_orderkey::INT AS PolicyNumber, o_custkey::INT AS CustomerID, NULL::INT AS ProductID,
        o_orderstatus AS PolicyStatus, NULL::VARCHAR AS Beneficiary, NULL::VARCHAR AS Relationship,
        o_orderdate::DATE AS PolicyStartDate, NULL::DATE AS PolicyEndDate, NULL::VARCHAR AS PremiumPaymentStatus,
        NULL::DATE AS PaymentDate, o_orderpriority AS PaymentMethod, NULL::INT AS AgentID FROM orders""",
    "ins_claim_table": """SELECT (l_orderkey * 10 + l_linenumber)::INT AS ClaimNumber, l_orderkey::INT AS PolicyNumber,
        l_shipdate::DATE AS ClaimDate, l_returnflag AS ClaimType, l_extendedprice::DECIMAL(10,2) AS ClaimAmount,
        l_linestatus AS ClaimStatus, NULL::VARCHAR AS ClaimDescription, NULL::INT AS BeneficiaryID,
        NULL::VARCHAR AS MedicalRecords, NULL::VARCHAR AS AccidentReport, NULL::VARCHAR AS ClaimHandler,
        NULL::DATE AS ReviewDate, NULL::VARCHAR AS PaymentMethod, NULL::DATE AS PaymentDate,
        NULL::VARCHAR AS DenialReason FROM lineitem""",
    "ins_premium_by_type": """SELECT p_type, sum(p_retailprice::DECIMAL(18,2))::DOUBLE / count(p_retailprice) AS avg_premium,
        max(p_retailprice) AS max_premium, min(p_retailprice) AS min_premium FROM part GROUP BY 1""",
    "ins_policies_per_customer": """SELECT c_custkey, c_name, count(*) AS n_policies,
        sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS total_premium
        FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2""",
    "ins_beneficiary_extremes": """WITH m AS (SELECT l_suppkey, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE / count(l_extendedprice) AS avg_amount,
        count(*) AS n_claims FROM lineitem GROUP BY 1)
        SELECT *, avg_amount = (SELECT max(avg_amount) FROM m) AS is_highest,
          avg_amount = (SELECT min(avg_amount) FROM m) AS is_lowest FROM m""",
    "ins_new_policies_by_month": """WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n_policies
        FROM orders GROUP BY 1) SELECT *, rank() OVER (ORDER BY n_policies DESC) = 1 AS is_peak FROM m""",
    "ins_payment_status_mix": """SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F') AS "F",
        count(*) FILTER (o_orderstatus = 'O') AS "O", count(*) FILTER (o_orderstatus = 'P') AS "P",
        count(*) AS n_policies FROM orders GROUP BY 1""",
    "ins_short_term": """SELECT count(*) AS n_short, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE / count(l_extendedprice) AS avg_premium
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE datediff('day', o_orderdate, l_shipdate) <= 60""",
    "ins_average_per_holder": """WITH m AS (SELECT o_custkey, sum(o_totalprice::DECIMAL(18,2))::DOUBLE / count(o_totalprice) AS avg_premium
        FROM orders GROUP BY 1)
        SELECT *, avg_premium = (SELECT max(avg_premium) FROM m) AS is_highest,
          avg_premium = (SELECT min(avg_premium) FROM m) AS is_lowest FROM m""",
    "ins_rider_sales": """SELECT o_orderpriority, count(*) AS n_policies,
        sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS total_premium FROM orders GROUP BY 1""",
    "ins_agent_sales": """SELECT s_suppkey, s_name, count(*) AS n_policies,
        sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS total_premium
        FROM supplier JOIN lineitem ON s_suppkey = l_suppkey GROUP BY 1, 2""",
    "ins_status_over_time": """SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderstatus, count(*) AS n_policies
        FROM orders GROUP BY 1, 2""",
    "ins_customer_contacts": "SELECT c_name, c_mktsegment FROM customer",
    "ins_spouses": """SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey
        WHERE c_mktsegment = 'BUILDING'""",
    "ins_unpaid_policies": """SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey
        WHERE o_orderstatus = 'P'""",
    "ins_large_claims": """SELECT o_orderkey, l_linenumber, l_partkey, l_extendedprice, c_name, c_mktsegment
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        WHERE l_extendedprice > 10000""",
    "ins_agents_by_expiry": """SELECT s_suppkey, s_name, max(l_shipdate) AS licence_expiry
        FROM supplier JOIN lineitem ON s_suppkey = l_suppkey GROUP BY 1, 2""",
    "ins_products_by_premium": "SELECT p_partkey, p_name, p_retailprice FROM part",
    "ins_region_staff": """SELECT s_name, n_name, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'""",
    "ins_young_customers": """SELECT o_orderkey, o_custkey, o_orderdate::DATE AS born FROM orders
        WHERE o_orderdate::DATE > DATE '2001-08-01' - INTERVAL 30 MONTH""",
    "ins_reviewed_unpaid": """SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'
        AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""",
    "ins_products_per_type": """SELECT p_type, sum(p_retailprice::DECIMAL(18,2))::DOUBLE / count(p_retailprice) AS avg_premium, count(*) AS n_products
        FROM part GROUP BY 1""",
}
