"""Personal data: which declared columns carry it, and keeping it out of the analytical layer."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklake.operators.contracts import PII_CLASSES, ContractError


def require_classified(declared: DataFrame) -> None:
    """Fail unless every declared column has a valid class. Runs on the small contract frame."""
    problem = (
        F.when(F.col("pii").isNull(), "no class").when(~F.col("pii").isin(PII_CLASSES), F.concat(F.lit("invalid class "), "pii"))
    )
    bad = declared.select("table", "column", problem.alias("problem")).where(F.col("problem").isNotNull())
    rows = bad.orderBy("table", "column").collect()
    if rows:
        listed = "; ".join(f"{r['table']}.{r['column']}: {r['problem']}" for r in rows)
        raise ContractError(f"personal-data classes are incomplete: {listed}")


def pii_columns(declared: DataFrame) -> DataFrame:
    """Columns with personal data, in contract order."""
    require_classified(declared)
    return (
        declared.where(F.col("pii") != "none")
        .orderBy("table", "position")
        .select("table", "column", F.col("pii").alias("category"), "description")
    )


def filled_values(tables: dict[str, DataFrame]) -> DataFrame:
    """Number of non-NULL values of every column, one aggregate per table."""
    reports = []
    for table, df in tables.items():
        counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
        entries = F.array(
            *[
                F.struct(F.lit(table).alias("table"), F.lit(c).alias("column"), F.col(c).alias("filled_values"))
                for c in df.columns
            ]
        )
        reports.append(counts.select(F.inline(entries)))
    return reduce(DataFrame.unionByName, reports)


def without_direct_pii(df: DataFrame, contract: dict) -> DataFrame:
    """Drop the columns that identify a person by themselves."""
    direct = [c["name"] for c in contract["columns"] if c.get("pii") == "direct"]
    return df.drop(*direct)
