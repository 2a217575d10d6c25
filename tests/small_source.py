"""A tiny transactional source with the awkward rows a warehouse build must survive."""

import datetime
from decimal import Decimal

from starloom.sources.tables import FrameSource

TODAY = datetime.date(2024, 6, 1)
MORNING = datetime.datetime(2024, 1, 1, 8)


def _survey(**fields):
    body = "".join(f"<{k}>{v}</{k}>" for k, v in fields.items())
    return f'<IndividualSurvey xmlns="urn:p">{body}</IndividualSurvey>'


def source(spark) -> FrameSource:
    def frame(rows, schema):
        return lambda: spark.createDataFrame(rows, schema)

    jan = datetime.datetime(2024, 1, 10)
    return FrameSource(
        spark,
        {
            "Sales.Currency": frame([("USD", "Dollar"), ("EUR", "Euro")], "CurrencyCode string, Name string"),
            "Sales.CurrencyRate": frame([(1, "EUR"), (2, "XXX")], "CurrencyRateID int, ToCurrencyCode string"),
            "Person.CountryRegion": frame([("US", "United States"), ("DE", "Germany"), ("JP", "Japan")], "CountryRegionCode string, Name string"),
            "Person.StateProvince": frame(
                [(1, "WA", "Washington", "US"), (2, "BY", "Bavaria", "DE"), (3, "13", "Tokyo", "JP")],
                "StateProvinceID int, StateProvinceCode string, Name string, CountryRegionCode string",
            ),
            # two territories for one country, none for another
            "Sales.SalesTerritory": frame([(1, "US"), (2, "US"), (3, "DE")], "TerritoryID int, CountryRegionCode string"),
            "Person.Address": frame(
                [
                    (1, "1 A St", None, "Seattle", 1, "98101"),
                    (2, "2 B St", "Apt 2", "Seattle", 1, "98101"),
                    (3, "3 C St", None, "Munich", 2, "80331"),
                    (4, "4 D St", None, "Tokyo", 3, "100"),
                    (5, "5 E St", None, None, 1, "98102"),
                    (6, "6 F St", None, "Spokane", 1, None),
                ],
                "AddressID int, AddressLine1 string, AddressLine2 string, City string, StateProvinceID int, PostalCode string",
            ),
            "Person.Person": frame(
                [
                    (10, "Ms.", "Ada", None, "L", False, None, _survey(Gender="F", TotalChildren="2", BirthDate="1970-01-02Z")),
                    (11, None, "Bob", "Q", "M", False, "Jr.", None),
                    (12, None, "Cy", None, "N", True, None, _survey(TotalChildren="x")),
                    (20, None, "Eve", None, "W", False, None, None),
                ],
                "BusinessEntityID int, Title string, FirstName string, MiddleName string, LastName string, NameStyle boolean, "
                "Suffix string, Demographics string",
            ),
            "Person.EmailAddress": frame([(10, "a@x"), (10, "z@x"), (11, "b@x")], "BusinessEntityID int, EmailAddress string"),
            "Person.PersonPhone": frame([(10, "1"), (10, "2"), (20, "3")], "BusinessEntityID int, PhoneNumber string"),
            # person 10 has two addresses, person 12 none
            "Person.BusinessEntityAddress": frame(
                [(10, 2), (10, 3), (11, 6), (100, 1), (102, 3), (102, 1)], "BusinessEntityID int, AddressID int"
            ),
            "Sales.Customer": frame(
                [(1, 10, None), (2, 11, None), (3, 12, None), (4, None, 100), (5, None, 101), (6, 10, 102), (7, None, 999)],
                "CustomerID int, PersonID int, StoreID int",
            ),
            "Sales.Store": frame(
                [
                    (100, "Bikes", '<StoreSurvey xmlns="urn:s"><BusinessType>BM</BusinessType><YearOpened>1990</YearOpened></StoreSurvey>'),
                    (101, "Nowhere", None),
                    (102, "Twice", '<StoreSurvey xmlns="urn:s"><BusinessType>Other</BusinessType></StoreSurvey>'),
                ],
                "BusinessEntityID int, Name string, Demographics string",
            ),
            "Sales.vStoreWithContacts": frame(
                [(100, "555"), (100, "444"), (102, None), (102, "777")], "BusinessEntityID int, PhoneNumber string"
            ),
            "Production.ProductCategory": frame([(1, "Bikes"), (2, "Parts")], "ProductCategoryID int, Name string"),
            "Production.ProductSubcategory": frame(
                [(1, "Road", 1), (2, "Wheels", 2), (3, "Lost", 9)], "ProductSubcategoryID int, Name string, ProductCategoryID int"
            ),
            "Production.Product": frame(
                [
                    (900 + i, f"P{i}", Decimal("5.5000"), Decimal("9.0000"), None, None, None, 1, None, None, None, 10, 5, True, model,
                     MORNING, None, sub, None, None)
                    for i, (model, sub) in enumerate([(1, 1), (2, 2), (3, None), (None, 3)])
                ],
                "ProductID int, Name string, StandardCost decimal(19,4), ListPrice decimal(19,4), Color string, Size string, "
                "Weight double, DaysToManufacture int, ProductLine string, Class string, Style string, SafetyStockLevel smallint, "
                "ReorderPoint smallint, FinishedGoodsFlag boolean, ProductModelID int, SellStartDate timestamp_ntz, "
                "SellEndDate timestamp_ntz, ProductSubcategoryID int, WeightUnitMeasureCode string, SizeUnitMeasureCode string",
            ),
            "Production.ProductModel": frame([(1, "M1"), (2, "M2"), (3, "M3")], "ProductModelID int, Name string"),
            "Production.ProductModelProductDescriptionCulture": frame(
                [(1, 51, "fr"), (1, 52, "en"), (2, 53, "fr"), (2, 54, "ar")],
                "ProductModelID int, ProductDescriptionID int, CultureID string",
            ),
            "Production.ProductDescription": frame(
                [(51, "fr1"), (52, "en1"), (53, "fr2"), (54, "ar2")], "ProductDescriptionID int, Description string"
            ),
            "Sales.SpecialOffer": frame(
                [(1, "None", 0.0, "No", "No", MORNING, None, 0, None)],
                "SpecialOfferID int, Description string, DiscountPct double, Type string, Category string, "
                "StartDate timestamp_ntz, EndDate timestamp_ntz, MinQty int, MaxQty int",
            ),
            "Sales.SalesReason": frame([(1, "Price", "Other")], "SalesReasonID int, Name string, ReasonType string"),
            "HumanResources.Department": frame([(1, "Sales"), (2, "Tools")], "DepartmentID int, Name string"),
            "HumanResources.Employee": frame(
                [(20, TODAY, TODAY, "eve", "S", True, "F", 10, 20, True)],
                "BusinessEntityID int, HireDate date, BirthDate date, LoginID string, MaritalStatus string, SalariedFlag boolean, "
                "Gender string, VacationHours smallint, SickLeaveHours smallint, CurrentFlag boolean",
            ),
            # one department ends today, one is open
            "HumanResources.EmployeeDepartmentHistory": frame(
                [(20, 1, datetime.date(2020, 1, 1), TODAY), (20, 2, datetime.date(2021, 1, 1), None)],
                "BusinessEntityID int, DepartmentID int, StartDate date, EndDate date",
            ),
            # the latest rate is tied
            "HumanResources.EmployeePayHistory": frame(
                [(20, MORNING, Decimal("9.0000"), 1), (20, jan, Decimal("10.0000"), 1), (20, jan, Decimal("11.0000"), 2)],
                "BusinessEntityID int, RateChangeDate timestamp_ntz, Rate decimal(19,4), PayFrequency smallint",
            ),
            "Sales.SalesOrderHeader": frame(
                [
                    (1, jan, jan, None, 1, 1, "SO1", 1, 1.0, 2.0, None, True, None),
                    (2, jan, jan, jan, 2, None, "SO2", 1, 1.0, 2.0, 1, True, None),
                    (3, datetime.datetime(2030, 1, 1), jan, jan, 1, 1, "SO3", 1, 1.0, 2.0, 2, True, None),
                    (4, jan, jan, jan, 4, 3, "SO4", 1, 1.0, 2.0, None, False, 20),
                    (5, jan, jan, jan, 6, 3, "SO5", 1, 1.0, 2.0, None, False, None),
                    (6, jan, jan, jan, 7, 3, "SO6", 1, 1.0, 2.0, None, False, 20),
                    (7, jan, jan, jan, 1, 1, "SO7", 1, 1.0, 2.0, None, None, None),
                    (8, jan, jan, jan, 4, 3, "SO8", 1, 1.0, 2.0, None, True, None),
                ],
                "SalesOrderID int, OrderDate timestamp_ntz, DueDate timestamp_ntz, ShipDate timestamp_ntz, CustomerID int, "
                "TerritoryID int, SalesOrderNumber string, RevisionNumber smallint, TaxAmt double, Freight double, "
                "CurrencyRateID int, OnlineOrderFlag boolean, SalesPersonID int",
            ),
            "Sales.SalesOrderDetail": frame(
                [
                    (order, 10 * order + line, 900 + line, 1 if line else 2, 2, 10.0, 20.0, 0.1, None)
                    for order in range(1, 9)
                    for line in range(2)
                ]
                + [(1, 19, 12345, 1, 1, 1.0, 1.0, 0.0, None)],
                "SalesOrderID int, SalesOrderDetailID int, ProductID int, SpecialOfferID int, OrderQty smallint, UnitPrice double, "
                "LineTotal double, UnitPriceDiscount double, CarrierTrackingNumber string",
            ),
        },
    )


def territories(spark):
    return spark.createDataFrame(
        [(1, "Northwest", "US", "NA", "p"), (2, "Southwest", "US", "NA", "p"), (3, "Germany", "DE", None, "p")],
        "sales_territory_alternate_key int, sales_territory_region string, sales_territory_country string, "
        "sales_territory_group string, X string",
    )
