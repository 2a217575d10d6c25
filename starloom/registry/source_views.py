"""The benchmark tables seen as the transactional source of the warehouse.

Every source table the extracts read is derived from whole benchmark tables, so
the work of each extract grows with them.  The tables hold no nulls, so columns
that are optional in a real source are nulled by an attribute of the row.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.dimensions import calendar_covering
from ..sources.tables import FrameSource

AS_OF = datetime.date(2024, 1, 29)

_REGION_CODE = "substr(r_name, 1, 3)"
_CATEGORY_ID = "ascii(p_type) + length(p_type)"
_SUBCATEGORY_ID = f"cast(substr(p_brand, 7) as int) * 100 + {_CATEGORY_ID}"
_STORE_OF_CUSTOMER = "2 * (c_custkey div 15) + 1"


def _element(name: str, value: str, present: str | None = None) -> str:
    tag = f"concat('<{name}>', {value}, '</{name}>')"
    return f"case when {present} then {tag} else '' end" if present else tag


_PERSON_XML = "concat('<IndividualSurvey xmlns=\"urn:survey:person\">', " + ", ".join(
    [
        _element("BirthDate", "date_add(date'1950-01-01', c_nationkey * 300), case when c_acctbal > 5000 then 'Z' else '' end"),
        _element("MaritalStatus", "case when c_nationkey < 10 then 'Married' else 'S' end"),
        _element("Gender", "case when c_nationkey % 2 = 0 then 'F' else 'M' end"),
        _element("YearlyIncome", "c_nationkey * 1000, '-', c_nationkey * 1000 + 25000, ' per year'"),
        _element("TotalChildren", "case when c_mktsegment = 'BUILDING' then 'many' else cast(c_nationkey % 6 as string) end"),
        _element("NumberChildrenAtHome", "c_nationkey % 4", "c_nationkey <= 20"),
        _element("Education", "c_mktsegment, ' school'"),
        _element("HomeOwnerFlag", "case when c_acctbal > 3000 then 1 else 0 end"),
        _element("NumberCarsOwned", "c_nationkey % 5"),
        _element("NumberCarsOwned", "9", "c_nationkey = 4"),
        _element("DateFirstPurchase", "date_add(date'1994-01-01', c_nationkey)"),
        _element("CommuteDistance", "c_nationkey, ' miles and some more'"),
    ]
) + ", '</IndividualSurvey>')"

_STORE_XML = "concat('<StoreSurvey xmlns=\"urn:survey:store\">', " + ", ".join(
    [
        _element(
            "BusinessType",
            "case s_nationkey % 6 when 0 then 'BM' when 1 then 'BS' when 2 then 'OS' when 3 then 'WS' "
            "when 4 then 'VARS' else 'Kiosk and market stall' end",
            "s_nationkey <> 7",
        ),
        _element("NumberEmployees", "s_nationkey * 3 + 1"),
        _element("AnnualSales", "cast(s_acctbal as decimal(12,2))"),
        _element("BankName", "'Bank of ', s_nationkey"),
        _element("AnnualRevenue", "cast(s_acctbal as decimal(12,2))", "s_nationkey <> 9"),
        _element("YearOpened", "case when s_nationkey = 5 then 'long ago' else cast(1950 + s_nationkey as string) end"),
    ]
) + ", '</StoreSurvey>')"


# The columns of the benchmark files, so that no file is opened to infer them.
_COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


class BenchmarkTables:
    """The benchmark Parquet files of one scale."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in _COLUMNS:
            raise AttributeError(name)
        return self.spark.read.schema(_COLUMNS[name]).parquet(f"{self.folder}/{name}.parquet")


def sales_source(spark: SparkSession, folder: str) -> FrameSource:
    t = BenchmarkTables(spark, folder)

    def places() -> DataFrame:
        return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))

    return FrameSource(
        spark,
        {
            "Person.CountryRegion": lambda: t.region.selectExpr(
                f"{_REGION_CODE} as CountryRegionCode", "r_name as Name"
            ),
            "Person.StateProvince": lambda: places().selectExpr(
                "n_nationkey as StateProvinceID",
                "lpad(cast(n_nationkey as string), 3, '0') as StateProvinceCode",
                "n_name as Name",
                f"{_REGION_CODE} as CountryRegionCode",
            ),
            "Sales.SalesTerritory": lambda: places().selectExpr(
                "n_nationkey + 1 as TerritoryID", f"{_REGION_CODE} as CountryRegionCode"
            ),
            "Sales.Currency": lambda: t.region.selectExpr(
                f"case when r_name = 'AMERICA' then 'USD' else {_REGION_CODE} end as CurrencyCode",
                "concat(r_name, ' money') as Name",
            ),
            "Sales.CurrencyRate": lambda: places().selectExpr(
                "n_nationkey as CurrencyRateID",
                f"case when r_name = 'AMERICA' then 'USD' else {_REGION_CODE} end as ToCurrencyCode",
            ),
            "Sales.Customer": lambda: t.customer.selectExpr(
                "c_custkey as CustomerID",
                "case when c_mktsegment <> 'MACHINERY' then 2 * c_custkey end as PersonID",
                f"case when c_mktsegment <> 'HOUSEHOLD' then {_STORE_OF_CUSTOMER} end as StoreID",
            ),
            "Person.Person": lambda: t.customer.selectExpr(
                "2 * c_custkey as BusinessEntityID",
                "case when c_nationkey < 12 then 'Mr.' end as Title",
                "substr(c_name, 1, 8) as FirstName",
                "case when c_acctbal > 5000 then substr(c_mktsegment, 1, 1) end as MiddleName",
                "substr(c_name, 10) as LastName",
                "c_acctbal < 0 as NameStyle",
                "case when c_mktsegment = 'BUILDING' then 'Jr.' end as Suffix",
                f"case when c_mktsegment <> 'FURNITURE' or c_acctbal >= 1000 then {_PERSON_XML} end as Demographics",
            ),
            "Person.EmailAddress": lambda: t.customer.selectExpr(
                "2 * c_custkey as BusinessEntityID", "concat('c', c_custkey, '@mail.example') as EmailAddress"
            ).unionByName(
                t.customer.selectExpr(
                    "2 * c_custkey as BusinessEntityID",
                    "case when c_mktsegment = 'BUILDING' then concat('b', c_custkey, '@site.example') "
                    "else concat('a', c_custkey, '@mail.example') end as EmailAddress",
                )
            ),
            "Person.PersonPhone": lambda: t.customer.selectExpr(
                "2 * c_custkey as BusinessEntityID", "concat(c_nationkey, '-', c_custkey) as PhoneNumber"
            ).unionByName(
                t.customer.selectExpr(
                    "2 * c_custkey as BusinessEntityID",
                    "concat(case when c_acctbal > 5000 then '800-' else '0-' end, c_custkey) as PhoneNumber",
                )
            ),
            "Person.Address": lambda: t.customer.selectExpr(
                "2 * c_custkey as AddressID",
                "concat(c_custkey, ' Main St') as AddressLine1",
                "case when c_mktsegment = 'AUTOMOBILE' then concat('Apt ', c_nationkey) end as AddressLine2",
                "case when c_acctbal >= 0 then concat('City ', c_nationkey, substr(c_mktsegment, 1, 1)) end as City",
                "c_nationkey as StateProvinceID",
                "case when c_mktsegment <> 'FURNITURE' or c_nationkey <> 3 "
                "then concat('P', c_nationkey, '-', substr(c_mktsegment, 1, 2)) end as PostalCode",
            ).unionByName(
                t.supplier.selectExpr(
                    "2 * s_suppkey + 1 as AddressID",
                    "concat('Dock ', s_suppkey) as AddressLine1",
                    "cast(null as string) as AddressLine2",
                    "case when s_acctbal >= 500 then concat('City ', s_nationkey, 'B') end as City",
                    "s_nationkey as StateProvinceID",
                    "concat('P', s_nationkey, '-BU') as PostalCode",
                )
            ),
            "Person.BusinessEntityAddress": lambda: t.customer.selectExpr(
                "2 * c_custkey as BusinessEntityID", "2 * c_custkey as AddressID"
            )
            .unionByName(
                t.customer.selectExpr(
                    "2 * c_custkey as BusinessEntityID",
                    f"case when c_mktsegment = 'BUILDING' then {_STORE_OF_CUSTOMER} else 2 * c_custkey end as AddressID",
                )
            )
            .unionByName(  # the address of a rich store is not there
                t.supplier.selectExpr(
                    "2 * s_suppkey + 1 as BusinessEntityID",
                    "case when s_acctbal <= 9000 then 2 * s_suppkey + 1 else -s_suppkey end as AddressID",
                )
            ),
            "Sales.Store": lambda: t.supplier.selectExpr(
                "2 * s_suppkey + 1 as BusinessEntityID", "s_name as Name", f"{_STORE_XML} as Demographics"
            ),
            "Sales.vStoreWithContacts": lambda: t.customer.selectExpr(
                f"{_STORE_OF_CUSTOMER} as BusinessEntityID",
                "case when c_acctbal >= -900 then concat('+', c_custkey) end as PhoneNumber",
            ),
            "HumanResources.Department": lambda: t.events.select("event_type")
            .distinct()
            .selectExpr("ascii(event_type) as DepartmentID", "event_type as Name"),
            "HumanResources.Employee": lambda: t.events.groupBy("user_id")
            .agg(
                F.to_date(F.min("ts")).alias("first_day"),
                F.count(F.lit(1)).alias("n"),
                F.count_if(F.col("event_type") == "error").alias("errors"),
                F.max("value").alias("top"),
            )
            .selectExpr(
                "2 * user_id as BusinessEntityID",
                "first_day as HireDate",
                "date_sub(first_day, 10000) as BirthDate",
                "concat('login-', user_id) as LoginID",
                "case when top > 100 then 'M' else 'S' end as MaritalStatus",
                "n > 60 as SalariedFlag",
                "case when errors > 10 then 'F' else 'M' end as Gender",
                "cast(n as smallint) as VacationHours",
                "cast(errors as smallint) as SickLeaveHours",
                "errors < 20 as CurrentFlag",
            ),
            "HumanResources.EmployeeDepartmentHistory": lambda: t.events.groupBy("user_id", "event_type")
            .agg(F.to_date(F.min("ts")).alias("a"), F.to_date(F.max("ts")).alias("b"))
            .selectExpr(
                "2 * user_id as BusinessEntityID",
                "ascii(event_type) as DepartmentID",
                "a as StartDate",
                "case when event_type <> 'signup' then b end as EndDate",
            ),
            "HumanResources.EmployeePayHistory": lambda: t.events.selectExpr(
                "2 * user_id as BusinessEntityID",
                "date_trunc('day', ts) as RateChangeDate",
                "cast(value as decimal(19,4)) as Rate",
                "cast(case when value < 20 then 1 else 2 end as smallint) as PayFrequency",
            ),
            "Production.ProductCategory": lambda: t.part.select("p_type")
            .distinct()
            .selectExpr(f"{_CATEGORY_ID} as ProductCategoryID", "p_type as Name"),
            "Production.ProductSubcategory": lambda: t.part.select("p_brand", "p_type")
            .distinct()
            .selectExpr(
                f"{_SUBCATEGORY_ID} as ProductSubcategoryID",
                "concat(p_brand, ' ', p_type) as Name",
                f"case when p_type <> 'SMALL' then {_CATEGORY_ID} end as ProductCategoryID",
            ),
            "Production.Product": lambda: t.part.selectExpr(
                "p_partkey as ProductID",
                "p_name as Name",
                "cast(p_retailprice * 0.5D as decimal(19,4)) as StandardCost",
                "cast(p_retailprice as decimal(19,4)) as ListPrice",
                "substring_index(p_name, ' ', 1) as Color",
                "cast(p_size as string) as Size",
                "case when p_size <> 50 then p_size * 0.25D end as Weight",
                "p_size as DaysToManufacture",
                "case when p_type <> 'PROMO' then substr(p_type, 1, 1) end as ProductLine",
                "case when p_size > 10 then 'H' end as Class",
                "case when p_size > 20 then 'U' end as Style",
                "cast(p_size * 10 as smallint) as SafetyStockLevel",
                "cast(p_size * 5 as smallint) as ReorderPoint",
                "p_type <> 'PROMO' as FinishedGoodsFlag",
                "case when p_size <> 13 then p_partkey div 3 end as ProductModelID",
                "timestamp_ntz'1995-01-01 00:00:00' + make_dt_interval(p_size) as SellStartDate",
                "case when p_size > 40 then timestamp_ntz'2001-01-01 00:00:00' end as SellEndDate",
                f"case when p_size <> 7 then {_SUBCATEGORY_ID} end as ProductSubcategoryID",
                "case when p_size <> 50 then 'KG' end as WeightUnitMeasureCode",
                "case when p_size < 25 then 'CM' end as SizeUnitMeasureCode",
            ),
            "Production.ProductModel": lambda: t.part.selectExpr("p_partkey div 3 as ProductModelID")
            .distinct()
            .selectExpr("ProductModelID", "concat('Model ', ProductModelID) as Name"),
            "Production.ProductModelProductDescriptionCulture": lambda: t.documents.selectExpr(
                "doc_id div 3 as ProductModelID", "doc_id as ProductDescriptionID", "lang as CultureID"
            ),
            "Production.ProductDescription": lambda: t.documents.selectExpr(
                "doc_id as ProductDescriptionID", "text as Description"
            ),
            "Sales.SpecialOffer": lambda: t.orders.select("o_orderpriority")
            .distinct()
            .selectExpr("o_orderpriority", "cast(substr(o_orderpriority, 1, 1) as int) as id")
            .selectExpr(
                "id as SpecialOfferID",
                "substr(o_orderpriority, 3) as Description",
                "id * 0.02D as DiscountPct",
                "case when id < 3 then 'Rush' else 'Normal' end as Type",
                "case when id < 4 then 'Customer' end as Category",
                "timestamp_ntz'1995-01-01 00:00:00' as StartDate",
                "case when id <> 5 then timestamp_ntz'2002-01-01 00:00:00' end as EndDate",
                "id as MinQty",
                "case when id > 2 then id * 10 end as MaxQty",
            ),
            "Sales.SalesReason": lambda: t.lineitem.select("l_returnflag", "l_linestatus")
            .distinct()
            .selectExpr(
                "ascii(l_returnflag) * 1000 + ascii(l_linestatus) as SalesReasonID",
                "concat('Reason ', l_returnflag) as Name",
                "concat('Type ', l_linestatus) as ReasonType",
            ),
            "Sales.SalesOrderHeader": lambda: t.orders.selectExpr(
                "o_orderkey as SalesOrderID",
                "o_orderdate as OrderDate",
                "o_orderdate + interval 12 days as DueDate",
                "case when o_orderpriority <> '5-LOW' then o_orderdate + interval 7 days end as ShipDate",
                "o_custkey as CustomerID",
                "case when o_custkey % 25 <> 12 then cast(o_custkey % 25 + 1 as int) end as TerritoryID",
                "concat('SO', o_orderkey) as SalesOrderNumber",
                "cast(substr(o_orderpriority, 1, 1) as smallint) as RevisionNumber",
                "o_totalprice * 0.08D as TaxAmt",
                "o_totalprice * 0.025D as Freight",
                "case when o_custkey % 25 <> 7 then cast(o_custkey % 25 as int) end as CurrencyRateID",
                "case when o_orderstatus = 'F' then true "
                "when o_orderstatus = 'O' or o_orderpriority <> '5-LOW' then false end as OnlineOrderFlag",
                "2 * (o_custkey div 10) as SalesPersonID",
            ),
            "Sales.SalesOrderDetail": lambda: t.lineitem.selectExpr(
                "l_orderkey as SalesOrderID",
                "l_linenumber as SalesOrderDetailID",
                "l_partkey as ProductID",
                "l_linenumber as SpecialOfferID",
                "cast(l_quantity as smallint) as OrderQty",
                "l_extendedprice / l_quantity as UnitPrice",
                "l_extendedprice as LineTotal",
                "l_discount as UnitPriceDiscount",
                "case when l_returnflag <> 'N' then concat(l_returnflag, '-', l_linestatus, '-', l_orderkey) end "
                "as CarrierTrackingNumber",
            ),
        },
    )


def territory_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Territories as the flat file holds them, without its first column."""
    t = BenchmarkTables(spark, folder)
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).selectExpr(
        "n_nationkey + 1 as sales_territory_alternate_key",
        "n_name as sales_territory_region",
        "r_name as sales_territory_country",
        "case when r_name <> 'ASIA' then concat('Group ', substr(r_name, 1, 1)) end as sales_territory_group",
        "concat('img', n_nationkey) as X",
    )


def calendar_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Calendar from the first to the last order day."""
    return calendar_covering(BenchmarkTables(spark, folder).orders, F.to_date("o_orderdate"))
