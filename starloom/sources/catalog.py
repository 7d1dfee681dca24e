"""Source tables by name."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

#: The operational tables the builders read.
SOURCE_TABLES = (
    "Sales.SalesOrderHeader",
    "Sales.SalesOrderDetail",
    "Sales.Customer",
    "Sales.Store",
    "Sales.SalesPerson",
    "Sales.SalesTerritory",
    "Sales.SpecialOffer",
    "Sales.SpecialOfferProduct",
    "Sales.vPersonDemographics",
    "Person.Person",
    "Person.EmailAddress",
    "Person.PersonPhone",
    "Person.Address",
    "Person.BusinessEntityAddress",
    "Person.BusinessEntityContact",
    "Person.StateProvince",
    "Person.CountryRegion",
    "Production.Product",
    "Production.ProductSubcategory",
    "Production.ProductCategory",
    "Production.ProductModel",
    "Production.ProductInventory",
    "Production.ProductReview",
    "Production.Location",
    "Production.WorkOrder",
    "Purchasing.Vendor",
    "Purchasing.PurchaseOrderHeader",
    "Purchasing.PurchaseOrderDetail",
    "HumanResources.Employee",
    "HumanResources.EmployeeDepartmentHistory",
    "HumanResources.Department",
)


class Sources(Mapping):
    """Lazy name -> DataFrame mapping; a table is planned on first use only."""

    def __init__(self, loaders: Mapping[str, Callable[[], DataFrame] | DataFrame]):
        self._loaders = dict(loaders)
        self._loaded: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._loaded:
            loader = self._loaders[name]
            self._loaded[name] = loader if isinstance(loader, DataFrame) else loader()
        return self._loaded[name]

    def __contains__(self, name: object) -> bool:
        return name in self._loaders

    def __iter__(self):
        return iter(self._loaders)

    def __len__(self):
        return len(self._loaders)

    def replaced(self, **tables: DataFrame) -> "Sources":
        """A copy with some tables replaced; dots in names are written as '__'."""
        changes = {name.replace("__", "."): df for name, df in tables.items()}
        return Sources({**self._loaders, **changes})

    def register_views(self, spark: SparkSession) -> None:
        for name in self:
            self[name].createOrReplaceTempView(name.replace(".", "_").lower())

    @classmethod
    def from_files(cls, spark: SparkSession, root: str, fmt: str = "parquet", **options) -> "Sources":
        """One folder or file per table: ``<root>/<schema>/<table>``."""

        def loader(name):
            return lambda: spark.read.format(fmt).options(**options).load(f"{root}/{name.replace('.', '/')}")

        return cls({name: loader(name) for name in SOURCE_TABLES})

    @classmethod
    def from_jdbc(
        cls,
        spark: SparkSession,
        url: str,
        properties: Mapping[str, str],
        partitioning: Mapping[str, tuple[str, int, int, int]] | None = None,
        fetch_size: int = 50_000,
    ) -> "Sources":
        """Read from the operational database, streaming ``fetch_size`` rows at a time.

        ``partitioning`` maps a table to (numeric column, lower, upper, partitions):
        such a table is read by that many parallel range queries.
        """

        def loader(name):
            def load():
                reader = (
                    spark.read.format("jdbc")
                    .options(**properties)
                    .option("url", url)
                    .option("dbtable", name)
                    .option("fetchsize", fetch_size)
                )
                if partitioning and name in partitioning:
                    column, lower, upper, count = partitioning[name]
                    reader = (
                        reader.option("partitionColumn", column)
                        .option("lowerBound", lower)
                        .option("upperBound", upper)
                        .option("numPartitions", count)
                    )
                return reader.load()

            return load

        return cls({name: loader(name) for name in SOURCE_TABLES})


def query_source(spark: SparkSession, url: str, query: str, properties: Mapping[str, str], fetch_size: int = 50_000):
    """Read the result of one query, executed by the source database."""
    return (
        spark.read.format("jdbc")
        .options(**properties)
        .option("url", url)
        .option("query", query)
        .option("fetchsize", fetch_size)
        .load()
    )
