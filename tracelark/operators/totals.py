"""Header totals against their lines, and distributions with shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .dedup import drop_copies

# Fixed values
TAX_RATE = "0.0825"
TAXABLE_DEPARTMENTS = [
    "Electronics",
    "Apparel",
    "Household",
    "Floral",
    "Health & Beauty",
    "Deli",
    "Bakery",
]


def with_product_department(lines: DataFrame, products: DataFrame, order_by: Sequence[str] = ("department",)) -> DataFrame:
    """Department of each line from the product table by ``sku``, first match only.

    Catalyst decides from its size whether the product table is broadcast.
    """
    lookup = drop_copies(products.select("sku", "department"), ["sku"], list(order_by))
    return lines.drop("department").join(lookup, "sku", "left")


def line_totals(
    lines: DataFrame,
    taxable: Sequence[str] = TAXABLE_DEPARTMENTS,
    tax_rate: str = TAX_RATE,
) -> DataFrame:
    """Totals per transaction from its lines; voids count for nothing, returns not as items."""
    sold = ~F.coalesce("is_void", F.lit(False))
    counted = sold & ~F.coalesce("is_return", F.lit(False))
    taxed = sold & F.coalesce(F.col("department").isin(list(taxable)), F.lit(False))
    zero = F.lit(0).cast("decimal(12,2)")

    def total(column: str, condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(column))), zero)

    rate = F.lit(tax_rate).cast("decimal(6,4)")
    sums = lines.groupBy("transaction_id").agg(
        total("extended_amount", sold).alias("subtotal"),
        total("line_discount_amount", sold).alias("discount"),
        F.round(total("extended_amount", taxed) * rate, 2).alias("tax"),
        F.count_if(counted).alias("items"),
    )
    return sums.withColumn("total", F.greatest(F.round(F.col("subtotal") + F.col("tax"), 2), zero))


def reconcile_totals(headers: DataFrame, lines: DataFrame, **options) -> DataFrame:
    """Header minus line totals for every header; a header without lines compares with zeros."""
    pairs = {
        "subtotal": "subtotal_amount",
        "discount": "discount_amount",
        "tax": "tax_amount",
        "total": "total_amount",
        "items": "item_count",
    }
    joined = headers.select("transaction_id", *pairs.values()).join(
        line_totals(lines, **options), "transaction_id", "left"
    )
    return joined.select(
        "transaction_id",
        *[(F.col(head) - F.coalesce(F.col(line), F.lit(0))).alias(f"{line}_difference") for line, head in pairs.items()],
    )


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows per value and their share of all rows, most frequent first."""
    counts = df.groupBy(F.col(column).cast("string").alias("value")).agg(F.count("*").alias("n"))
    total = counts.select(F.sum("n")).scalar()
    return counts.select(
        F.lit(column).alias("dimension"), "value", "n", (F.col("n") / total).alias("share")
    ).orderBy(F.desc("n"), "value")


def incident_rate(transactions: DataFrame, incidents: DataFrame) -> DataFrame:
    """Share of transactions with at least one incident."""
    hit = incidents.select("transaction_id").distinct().withColumn("hit", F.lit(1))
    joined = transactions.select("transaction_id").join(hit, "transaction_id", "left")
    return joined.agg(
        F.count("*").alias("transactions"),
        F.count("hit").alias("with_incident"),
        F.try_divide(F.count("hit"), F.count("*")).alias("incident_rate"),
    )
