"""Property sales made from the order tables, for tests, benchmarks and the registered queries.

The register itself is not part of the repository. One order stands for one sale, and some cells are
spoiled the way register cells are: unreadable dates, empty prices, runs of spaces, empty codes.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellmart.schemas import HEADERS
from dwellmart.sources.counties import COUNTY_COORDINATES

# A county per nation: 22 with coordinates and, for the last three nations, names that have none.
COUNTY_OF_NATION = [*list(COUNTY_COORDINATES)[:22], *(f"County  NATION_{n}" for n in range(22, 25))]


def raw_sales(
    spark: SparkSession, sf_dir: str, deliveries: int = 2, spoiled: bool = True, variants: int = 1
) -> DataFrame:
    """Raw rows under the register's headers; ``deliveries`` copies, as when the file is sent again.

    With ``spoiled=False`` every date and price can be read. ``variants`` makes so many different sales of
    an order. The address names the order, so different sales have different natural keys.
    """
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    county = F.element_at(F.array(*map(F.lit, COUNTY_OF_NATION)), F.col("n_nationkey") + 1)
    key = F.col("o_orderkey")
    if variants > 1:
        orders = orders.select("*", F.explode(F.sequence(F.lit(1), F.lit(variants))).alias("variant"))
    flat = F.concat_ws("-", key.cast("string"), F.col("variant").cast("string")) if variants > 1 else key.cast("string")
    date = F.date_format("o_orderdate", "dd/MM/yyyy")
    price = F.concat(F.lit("€"), F.format_number("o_totalprice", 2))
    cells = {
        "date_of_sale": F.when(key % 97 == 0, "n/a").otherwise(date) if spoiled else date,
        "address": F.concat(F.lit("  Flat "), flat, F.lit("   "), F.col("o_custkey").cast("string"), F.lit(" Main  St ")),
        "county": F.concat(F.lit("  "), county, F.lit(" ")),
        "eircode": F.when(key % 3 == 0, "").otherwise(F.concat(F.lit("E"), key.cast("string"))),
        "price_eur": F.when(key % 89 == 0, "").otherwise(price) if spoiled else price,
        "not_full_market_price": F.when(key % 20 == 0, "Yes").otherwise("No"),
        "vat_exclusive": F.when(F.col("o_orderstatus") == "P", "Yes").otherwise("No"),
        "description_of_property": F.concat("o_orderpriority", F.lit("  Dwelling ")),
        "property_size_description": F.lit(None).cast("string"),
    }
    sales = (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(*(cells[name].alias(header) for header, name in HEADERS.items()))
    )
    if deliveries == 1:
        return sales
    # A generator rather than a union, so that the tables are read and joined once.
    copies = F.explode(F.sequence(F.lit(1), F.lit(deliveries))).alias("delivery")
    return sales.select("*", copies).drop("delivery")
