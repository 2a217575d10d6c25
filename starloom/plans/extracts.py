"""Source tables to the raw rows of each target table."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import business_type
from ..functions.xml_fields import PERSON_SURVEY, STORE_SURVEY, lost_values, xml_fields
from ..operators.dedupe import keep_first
from ..operators.history import current_rows, latest_rows, preferred_text
from ..operators.lookup import join_every, join_unique
from ..sources.tables import Source

# Source column -> target column.
CURRENCY = {"CurrencyCode": "currency_alternate_key", "Name": "currency_name"}
PRODUCT_CATEGORY = {"ProductCategoryID": "product_category_alternate_key", "Name": "product_category_name"}
PRODUCT_SUBCATEGORY = {
    "ProductSubcategoryID": "product_subcategory_alternate_key",
    "Name": "product_subcategory_name",
    "ProductCategoryID": "product_category_alternate_key",
}
PROMOTION = {
    "SpecialOfferID": "promotion_alternate_key",
    "Description": "promotion_name",
    "DiscountPct": "discount_pct",
    "Type": "promotion_type",
    "Category": "promotion_category",
    "StartDate": "start_date",
    "EndDate": "end_date",
    "MinQty": "min_qty",
    "MaxQty": "max_qty",
}
SALES_REASON = {
    "SalesReasonID": "sales_reason_alternate_key",
    "Name": "sales_reason_name",
    "ReasonType": "sales_reason_reason_type",
}
PRODUCT = {
    "ProductID": "product_alternate_key",
    "Name": "product_name",
    "StandardCost": "standard_cost",
    "ListPrice": "list_price",
    "Color": "color",
    "Size": "size",
    "Weight": "weight",
    "DaysToManufacture": "days_to_manufacture",
    "ProductLine": "product_line",
    "Class": "class",
    "Style": "style",
    "SafetyStockLevel": "safety_stock_level",
    "ReorderPoint": "reorder_point",
    "FinishedGoodsFlag": "finished_goods_flag",
    "SellStartDate": "sell_start_date",
    "SellEndDate": "sell_end_date",
    "ProductSubcategoryID": "product_subcategory_key",
    "WeightUnitMeasureCode": "weight_unit_measure_code",
    "SizeUnitMeasureCode": "size_unit_measure_code",
}
PERSON_NAME = {
    "Title": "title",
    "FirstName": "first_name",
    "MiddleName": "middle_name",
    "LastName": "last_name",
    "NameStyle": "name_style",
    "Suffix": "suffix",
}
ADDRESS = {
    "AddressLine1": "address_line1",
    "AddressLine2": "address_line2",
    "City": "city",
    "StateProvinceCode": "state_province_code",
    "PostalCode": "postal_code",
}
EMPLOYEE = {
    "BusinessEntityID": "employee_alternate_key",
    "HireDate": "hire_date",
    "BirthDate": "birth_date",
    "LoginID": "login_id",
    "MaritalStatus": "marital_status",
    "SalariedFlag": "salaried_flag",
    "Gender": "gender",
    "VacationHours": "vacation_hours",
    "SickLeaveHours": "sick_leave_hours",
    "CurrentFlag": "current_flag",
}
ORDER_HEADER = {
    "CustomerID": "customer_alternate_key",
    "TerritoryID": "sales_territory_alternate_key",
    "RevisionNumber": "revision_number",
    "TaxAmt": "tax_amt",
    "Freight": "freight",
}
ORDER_HEADER_KEPT = ["SalesOrderID", "OrderDate", "DueDate", "ShipDate", "SalesOrderNumber"]
ORDER_DETAIL = {
    "SalesOrderDetailID": "sales_order_detail_id",
    "ProductID": "product_alternate_key",
    "SpecialOfferID": "promotion_alternate_key",
    "OrderQty": "order_quantity",
    "UnitPrice": "unit_price",
    "LineTotal": "extended_amount",
    "UnitPriceDiscount": "unit_price_discount_pct",
    "CarrierTrackingNumber": "carrier_tracking_number",
}
# "First" row of a reseller: columns in this order, nulls first.
RESELLER_ORDER = ["phone", *ADDRESS.values()]
NO_DESCRIPTION = "No description available"
DEFAULT_CURRENCY = "USD"


def _renamed(names: Mapping[str, str]) -> list[Column]:
    return [F.col(old).alias(new) for old, new in names.items()]


def extract_dim_currency(source: Source) -> DataFrame:
    return source.table("Sales.Currency").select(*_renamed(CURRENCY))


def extract_dim_product_category(source: Source) -> DataFrame:
    return source.table("Production.ProductCategory").select(*_renamed(PRODUCT_CATEGORY))


def extract_dim_product_subcategory(source: Source) -> DataFrame:
    return source.table("Production.ProductSubcategory").select(*_renamed(PRODUCT_SUBCATEGORY))


def extract_dim_promotion(source: Source) -> DataFrame:
    return source.table("Sales.SpecialOffer").select(*_renamed(PROMOTION))


def extract_dim_sales_reason(source: Source) -> DataFrame:
    return source.table("Sales.SalesReason").select(*_renamed(SALES_REASON))


def extract_dim_geography(source: Source) -> DataFrame:
    """Distinct places with every territory of their country.

    A country with several territories repeats each of its places.  Places are
    made distinct before the joins, so the addresses themselves never multiply.
    """
    places = (
        source.table("Person.Address")
        .where(F.col("City").isNotNull() & F.col("PostalCode").isNotNull())
        .select("City", "StateProvinceID", "PostalCode")
        .distinct()
    )
    provinces = source.table("Person.StateProvince").select(
        "StateProvinceID", "StateProvinceCode", F.col("Name").alias("province"), "CountryRegionCode"
    )
    countries = source.table("Person.CountryRegion").select("CountryRegionCode", F.col("Name").alias("country"))
    territories = source.table("Sales.SalesTerritory").select("CountryRegionCode", "TerritoryID")
    return (
        places.join(provinces, "StateProvinceID")
        .join(countries, "CountryRegionCode")
        .join(territories, "CountryRegionCode", "left")
        .select(
            F.col("City").alias("city"),
            F.col("StateProvinceCode").alias("state_province_code"),
            F.col("province").alias("state_province_name"),
            F.col("CountryRegionCode").alias("country_region_code"),
            F.col("country").alias("country_region_name"),
            F.col("PostalCode").alias("postal_code"),
            F.col("TerritoryID").alias("sales_territory_key"),
        )
        .distinct()
    )


def _emails(source: Source) -> DataFrame:
    rows = source.table("Person.EmailAddress").groupBy("BusinessEntityID")
    return rows.agg(F.max("EmailAddress").alias("email_address"))


def _phones(source: Source) -> DataFrame:
    rows = source.table("Person.PersonPhone").groupBy("BusinessEntityID")
    return rows.agg(F.max("PhoneNumber").alias("phone"))


def person_contacts(source: Source) -> DataFrame:
    """Greatest e-mail and phone per person.

    Each table collapses to one row per person before the join, so several
    e-mails and several phones never multiply each other.
    """
    people = source.table("Person.Person").select("BusinessEntityID")
    return people.join(_emails(source), "BusinessEntityID", "left").join(_phones(source), "BusinessEntityID", "left")


def entity_addresses(source: Source, whole_address: bool = False) -> DataFrame:
    """One address per entity.

    By default each column takes its own greatest value, so a row can mix
    several addresses; ``whole_address`` keeps the columns of the address with
    the greatest id together instead.
    """
    rows = (
        source.table("Person.BusinessEntityAddress")
        .select("BusinessEntityID", "AddressID")
        .join(addresses(source), "AddressID", "left")
    )
    if whole_address:
        pick = F.max_by(F.struct(*ADDRESS.values()), "AddressID").alias("a")
        return rows.groupBy("BusinessEntityID").agg(pick).select("BusinessEntityID", "a.*")
    return rows.groupBy("BusinessEntityID").agg(*[F.max(c).alias(c) for c in ADDRESS.values()])


def addresses(source: Source) -> DataFrame:
    provinces = source.table("Person.StateProvince").select("StateProvinceID", "StateProvinceCode")
    return (
        source.table("Person.Address")
        .join(provinces, "StateProvinceID", "left")
        .select("AddressID", *_renamed(ADDRESS))
    )


def extract_dim_customer(source: Source) -> DataFrame:
    """People who are customers, with contact, address and survey fields.

    Survey documents are parsed where they are read, so the joins move the few
    fields instead of the documents.  Everything about a person is put together
    first, by joins on one key, and then meets the customers.
    """
    customers = (
        source.table("Sales.Customer")
        .where(F.col("PersonID").isNotNull())
        .select(F.col("CustomerID").alias("customer_alternate_key"), F.col("PersonID").alias("BusinessEntityID"))
    )
    people = source.table("Person.Person").select("BusinessEntityID", *_renamed(PERSON_NAME), "Demographics")
    profiles = (
        xml_fields(people, "Demographics", PERSON_SURVEY)
        .join(_emails(source), "BusinessEntityID", "left")
        .join(_phones(source), "BusinessEntityID", "left")
        .join(entity_addresses(source), "BusinessEntityID", "left")
    )
    return join_unique(customers, profiles, ["BusinessEntityID"], "inner").drop("BusinessEntityID")


def model_descriptions(source: Source) -> DataFrame:
    """English text per product model, any other language where English is absent."""
    return preferred_text(
        source.table("Production.ProductModelProductDescriptionCulture"),
        source.table("Production.ProductDescription"),
        group="ProductModelID",
        text_id="ProductDescriptionID",
        language="CultureID",
        body="Description",
    )


def extract_dim_product(source: Source) -> DataFrame:
    models = source.table("Production.ProductModel").select("ProductModelID", F.col("Name").alias("model_name"))
    # A description hangs on a model, so it is looked up through the model table.
    described = models.join(model_descriptions(source), "ProductModelID", "left")
    products = (
        source.table("Production.Product")
        .where(F.col("ProductID").isNotNull())
        .select("ProductModelID", *_renamed(PRODUCT))
    )
    return (
        join_unique(products, described, ["ProductModelID"], "left")
        .withColumn("description", F.coalesce("Description", F.lit(NO_DESCRIPTION)))
        .select(*PRODUCT.values(), "model_name", "description")
    )


def _stores(source: Source) -> DataFrame:
    stores = (
        source.table("Sales.Store")
        .where(F.col("BusinessEntityID").isNotNull())
        .select("BusinessEntityID", F.col("Name").alias("reseller_name"), "Demographics")
    )
    surveyed = xml_fields(stores, "Demographics", STORE_SURVEY)
    return surveyed.withColumn("business_type", business_type(F.col("business_code"))).drop("business_code")


def lost_survey_values(source: Source) -> DataFrame:
    """Survey values that a dimension cannot keep: ``table_name, column_name, filled, cut, unreadable``."""
    surveys = {
        "dim_customer": ("Person.Person", PERSON_SURVEY),
        "dim_reseller": ("Sales.Store", STORE_SURVEY),
    }
    counts = [
        lost_values(source.table(table).select("Demographics"), "Demographics", fields).select(F.lit(name).alias("table_name"), "*")
        for name, (table, fields) in surveys.items()
    ]
    return counts[0].unionByName(counts[1])


def _store_addresses(source: Source) -> DataFrame:
    links = source.table("Person.BusinessEntityAddress").select("BusinessEntityID", "AddressID")
    return links.join(addresses(source), "AddressID", "left").drop("AddressID")


def _store_phones(source: Source) -> DataFrame:
    return source.table("Sales.vStoreWithContacts").select("BusinessEntityID", F.col("PhoneNumber").alias("phone"))


def _first_phones(source: Source) -> DataFrame:
    """The first phone of each store, nulls first."""
    return (
        _store_phones(source)
        .groupBy("BusinessEntityID")
        .agg(F.min("phone").alias("least"), F.count_if(F.col("phone").isNull()).alias("unnamed"))
        .select("BusinessEntityID", F.when(F.col("unnamed") == 0, F.col("least")).alias("phone"))
    )


def extract_dim_reseller(source: Source) -> DataFrame:
    """Stores with address, contact phones and survey fields.

    A store with several addresses or contacts appears once per pair of them;
    the dimension keeps the first.  :func:`first_resellers` gives that first row
    without making the pairs.
    """
    stores = _stores(source)
    joined = stores
    for side in (_store_addresses(source), _store_phones(source)):
        joined = join_every(joined, side, ["BusinessEntityID"], stores)
    return joined.withColumnRenamed("BusinessEntityID", "reseller_alternate_key")


def first_resellers(source: Source) -> DataFrame:
    """The first row per store of :func:`extract_dim_reseller` in ``RESELLER_ORDER``.

    The first pair of phone and address is the first phone with the first
    address, so each side is reduced to one row per store before the join.
    """
    places = keep_first(_store_addresses(source), ["BusinessEntityID"], [c for c in RESELLER_ORDER if c != "phone"])
    return (
        _stores(source)
        .join(places, "BusinessEntityID", "left")
        .join(_first_phones(source), "BusinessEntityID", "left")
        .withColumnRenamed("BusinessEntityID", "reseller_alternate_key")
    )


def resellers_by_address(source: Source) -> DataFrame:
    """The rows of :func:`extract_dim_reseller` that hold their store's first phone, one per address."""
    stores = _stores(source)
    placed = join_every(stores, _store_addresses(source), ["BusinessEntityID"], stores)
    return placed.join(_first_phones(source), "BusinessEntityID", "left").withColumnRenamed(
        "BusinessEntityID", "reseller_alternate_key"
    )


def reseller_row_counts(source: Source) -> DataFrame:
    """How many rows :func:`extract_dim_reseller` has per store, from counts of each side."""

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("BusinessEntityID").agg(F.count(F.lit(1)).alias(name))

    stores = counted(source.table("Sales.Store").where(F.col("BusinessEntityID").isNotNull()), "stores")
    sides = counted(_store_addresses(source), "places"), counted(_store_phones(source), "phones")
    for side in sides:
        stores = stores.join(side, "BusinessEntityID", "left")
    rows = F.col("stores") * F.coalesce("places", F.lit(1)) * F.coalesce("phones", F.lit(1))
    return stores.select(F.col("BusinessEntityID").alias("reseller_alternate_key"), rows.alias("row_count"))


def current_departments(source: Source, as_of: datetime.date | None = None) -> DataFrame:
    return current_rows(source.table("HumanResources.EmployeeDepartmentHistory"), "EndDate", as_of).select(
        "BusinessEntityID", "DepartmentID", "StartDate", "EndDate"
    )


def latest_pay(source: Source) -> DataFrame:
    return latest_rows(
        source.table("HumanResources.EmployeePayHistory"), ["BusinessEntityID"], "RateChangeDate"
    ).select("BusinessEntityID", "Rate", "PayFrequency")


def extract_dim_employee(source: Source, as_of: datetime.date | None = None) -> DataFrame:
    """Employees with current department and latest pay; ``as_of`` defaults to today."""
    names = {k: v for k, v in PERSON_NAME.items() if k != "Suffix"}
    people = source.table("Person.Person").select(F.col("BusinessEntityID").alias("person"), *_renamed(names))
    emails = source.table("Person.EmailAddress").select(
        F.col("BusinessEntityID").alias("person"), F.col("EmailAddress").alias("email_address")
    )
    phones = source.table("Person.PersonPhone").select(
        F.col("BusinessEntityID").alias("person"), F.col("PhoneNumber").alias("phone")
    )
    departments = source.table("HumanResources.Department").select(
        "DepartmentID", F.col("Name").alias("department_name")
    )
    assigned = (
        current_departments(source, as_of)
        .join(departments, "DepartmentID", "left")
        .select(
            F.col("BusinessEntityID").alias("person"),
            "department_name",
            F.col("StartDate").alias("start_date"),
            F.col("EndDate").alias("end_date"),
        )
    )
    paid = latest_pay(source).select(
        F.col("BusinessEntityID").alias("person"),
        F.col("PayFrequency").alias("pay_frequency"),
        F.col("Rate").alias("base_rate"),
    )
    employees = (
        source.table("HumanResources.Employee")
        .where(F.col("BusinessEntityID").isNotNull())
        .select(F.col("BusinessEntityID").alias("person"), *_renamed(EMPLOYEE))
    )
    joined = employees.join(people, "person")
    for side in (emails, phones, assigned, paid):
        joined = join_every(joined, side, ["person"], employees)
    return joined.drop("person")


def order_headers_of(source: Source, online: bool) -> DataFrame:
    """Orders of one channel; an order with a null channel flag is in neither."""
    return source.table("Sales.SalesOrderHeader").where(F.col("OnlineOrderFlag") == F.lit(online))


def order_line_count(source: Source, since: str) -> DataFrame:
    """Lines of the orders placed on or after a date."""
    orders = source.table("Sales.SalesOrderHeader").where(F.col("OrderDate") >= F.lit(since).cast("timestamp_ntz"))
    lines = source.table("Sales.SalesOrderDetail").select("SalesOrderID")
    return orders.select("SalesOrderID").join(lines, "SalesOrderID").agg(F.count(F.lit(1)).alias("line_count"))


def channel_headers(source: Source, online: bool) -> DataFrame:
    """Orders of one channel with their currency code; store orders keep ``CustomerID``."""
    rates = source.table("Sales.CurrencyRate").select("CurrencyRateID", "ToCurrencyCode")
    extra = [] if online else [F.col("SalesPersonID").alias("employee_alternate_key"), F.col("CustomerID")]
    header = {k: v for k, v in ORDER_HEADER.items() if online or k != "CustomerID"}
    return (
        order_headers_of(source, online)
        .select(*ORDER_HEADER_KEPT, *_renamed(header), *extra, "CurrencyRateID")
        .join(rates, "CurrencyRateID", "left")
        .withColumn("currency_alternate_key", F.coalesce("ToCurrencyCode", F.lit(DEFAULT_CURRENCY)))
        .drop("CurrencyRateID", "ToCurrencyCode")
    )


def store_customers(source: Source) -> DataFrame:
    """Customers that buy for a known store: ``CustomerID, reseller_alternate_key``."""
    customers = source.table("Sales.Customer").select("CustomerID", F.col("StoreID").alias("reseller_alternate_key"))
    stores = source.table("Sales.Store").select(F.col("BusinessEntityID").alias("reseller_alternate_key"))
    return customers.join(stores, "reseller_alternate_key")


def order_headers(source: Source, online: bool) -> DataFrame:
    """Orders of one channel; store orders carry the store of their customer."""
    headers = channel_headers(source, online)
    return headers if online else headers.join(store_customers(source), "CustomerID").drop("CustomerID")


def order_lines(source: Source) -> DataFrame:
    return source.table("Sales.SalesOrderDetail").select("SalesOrderID", *_renamed(ORDER_DETAIL))


def order_details(source: Source) -> DataFrame:
    """Order lines with the standard cost of their product."""
    costs = source.table("Production.Product").select(
        F.col("ProductID").alias("product_alternate_key"), F.col("StandardCost").alias("product_standard_cost")
    )
    return order_lines(source).join(costs, "product_alternate_key")


def extract_fact_internet_sales(source: Source) -> DataFrame:
    return order_headers(source, online=True).join(order_details(source), "SalesOrderID").drop("SalesOrderID")


def extract_fact_reseller_sales(source: Source) -> DataFrame:
    return order_headers(source, online=False).join(order_details(source), "SalesOrderID").drop("SalesOrderID")


EXTRACTS: dict[str, Callable[[Source], DataFrame]] = {
    "dim_currency": extract_dim_currency,
    "dim_geography": extract_dim_geography,
    "dim_customer": extract_dim_customer,
    "dim_product_category": extract_dim_product_category,
    "dim_product_subcategory": extract_dim_product_subcategory,
    "dim_product": extract_dim_product,
    "dim_promotion": extract_dim_promotion,
    "dim_sales_reason": extract_dim_sales_reason,
    "dim_reseller": extract_dim_reseller,
    "dim_employee": extract_dim_employee,
    "fact_internet_sales": extract_fact_internet_sales,
    "fact_reseller_sales": extract_fact_reseller_sales,
}


@dataclass(frozen=True)
class Extraction:
    """Frames that could be planned, and the reason for each that could not."""

    frames: dict[str, DataFrame]
    failures: dict[str, str]

    def status(self, table: str) -> str:
        return "failed" if table in self.failures else "extracted"


# The same tables when they are built to be loaded.
LOAD_EXTRACTS = {**EXTRACTS, "dim_reseller": first_resellers}


def extract_all(
    source: Source,
    as_of: datetime.date | None = None,
    extracts: Mapping[str, Callable[[Source], DataFrame]] = EXTRACTS,
) -> Extraction:
    """Plan every extract; one that fails is recorded and does not stop the rest.

    Extracts are lazy, so this catches what planning can tell (missing tables or
    columns).  The cause is kept for the load to report.
    """
    frames: dict[str, DataFrame] = {}
    failures: dict[str, str] = {}
    for name, build in extracts.items():
        try:
            frames[name] = build(source, as_of) if name == "dim_employee" else build(source)
        except Exception as error:  # any planning error of one table must not stop the others
            failures[name] = f"{type(error).__name__}: {error}"
    return Extraction(frames, failures)


def extraction_report(spark, extraction: Extraction) -> DataFrame:
    """``table_name, status, row_count`` per extract, counted in one job."""
    counts = None
    for name, frame in extraction.frames.items():
        one = frame.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), F.lit("extracted").alias("status"), "row_count"
        )
        counts = one if counts is None else counts.unionByName(one)
    failed = spark.createDataFrame(
        [(name, "failed", 0) for name in extraction.failures], "table_name string, status string, row_count bigint"
    )
    return failed if counts is None else counts.unionByName(failed)
