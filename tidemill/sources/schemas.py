"""Declared schemas. Nothing in the library infers a schema from data."""

from __future__ import annotations

# The benchmark tables.
TABLES: dict[str, str] = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}

# Insurance business tables.
INSURANCE: dict[str, str] = {
    "CustomerInfo": "CustomerID int, Name string, Gender string, DateOfBirth date, IDNumber string, Address string, "
                    "PhoneNumber string, EmailAddress string, MaritalStatus string, Occupation string, "
                    "HealthStatus string, RegistrationDate date, CustomerType string, SourceOfCustomer string, "
                    "CustomerStatus string",
    "PolicyInfo": "PolicyNumber int, CustomerID int, ProductID int, PolicyStatus string, Beneficiary string, "
                  "Relationship string, PolicyStartDate date, PolicyEndDate date, PremiumPaymentStatus string, "
                  "PaymentDate date, PaymentMethod string, AgentID int",
    "ClaimInfo": "ClaimNumber int, PolicyNumber int, ClaimDate date, ClaimType string, ClaimAmount decimal(10,2), "
                 "ClaimStatus string, ClaimDescription string, BeneficiaryID int, MedicalRecords string, "
                 "AccidentReport string, ClaimHandler string, ReviewDate date, PaymentMethod string, "
                 "PaymentDate date, DenialReason string",
    "BeneficiaryInfo": "BeneficiaryID int, Name string, Gender string, DateOfBirth date, Nationality string, "
                       "Address string, PhoneNumber string, EmailAddress string",
    "AgentInfo": "AgentID int, Name string, Gender string, DateOfBirth date, Address string, PhoneNumber string, "
                 "EmailAddress string, CertificateNumber string, LicenseIssueDate date, "
                 "LicenseExpirationDate date, CommissionStructure string",
    "ProductInfo": "ProductID int, ProductName string, ProductType string, CoverageRange string, CoverageTerm int, "
                   "Premium decimal(10,2), PaymentFrequency string, ProductFeatures string, AgeLimit string, "
                   "PremiumCalculation string, ClaimsProcess string, UnderwritingRequirements string, "
                   "SalesRegion string, ProductStatus string",
    "EmployeeInfo": "EmployeeID int, Name string, Gender string, DateOfBirth date, Address string, "
                    "PhoneNumber string, EmailAddress string, HireDate date, Position string, Department string, "
                    "Salary decimal(10,2), Location string, Supervisor string, EmployeeType string, "
                    "EmployeeStatus string",
}

INVENTORY_PHYSICAL = (
    "skuCode string, skuName string, quality string, binCode string, areaCode string, areaName string, "
    "produceDate string, productionNo string, qty bigint, occupied bigint"
)
HOTEL = "name string, desc string"
PARSED_DOCUMENT = (
    "array<struct<page_num:int, content:array<struct<text:string, `font-size`:int, token:int, table:string>>>>"
)
CHUNKED_DOCUMENT = (
    "struct<url:string, title:string, raw:array<struct<content:string, "
    "metadata:struct<source:string, title:string, chunk_id:int>, token:int>>>"
)
