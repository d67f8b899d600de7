"""Named tables for free SQL, and the ready-made SQL questions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Three questions that can be asked of any table, in SQL with named parameters: the largest
# groups, a total per year, and the rows over a bound.
QUESTIONS = {
    "largest_groups": """
        SELECT IDENTIFIER(:name) AS name, count(*) AS n_rows, round(sum(IDENTIFIER(:amount))) AS total
        FROM IDENTIFIER(:table)
        WHERE IDENTIFIER(:known) IS NOT NULL
        GROUP BY ALL
        ORDER BY total DESC NULLS LAST, name
        LIMIT 20""",
    "yearly_totals": """
        SELECT IDENTIFIER(:year) AS year, count(*) AS n_rows, round(sum(IDENTIFIER(:amount))) AS total
        FROM IDENTIFIER(:table)
        GROUP BY ALL
        ORDER BY year NULLS LAST""",
    "rows_over": """
        SELECT IDENTIFIER(:key) AS key, IDENTIFIER(:measure) AS measure, IDENTIFIER(:shown) AS shown
        FROM IDENTIFIER(:table)
        WHERE IDENTIFIER(:state) = :wanted AND (:bound IS NULL OR IDENTIFIER(:measure) > :bound)
        ORDER BY measure DESC NULLS LAST, key, shown
        LIMIT 20""",
    "row_count": "SELECT count(*) AS n FROM IDENTIFIER(:table)",
}

# The ready-made questions: which one, its columns and bounds, and the names of the answer.
SQL_TEMPLATES = {
    "conta_righe": ("row_count", {}, {}),
    "top_sa_per_importo": (
        "largest_groups",
        {
            "name": "denominazione_amministrazione_appaltante",
            "amount": "importo_lotto",
            "known": "cf_amministrazione_appaltante",
        },
        {"name": "sa", "n_rows": "n_bandi", "total": "importo_totale"},
    ),
    "trend_annuale": (
        "yearly_totals",
        {"year": "anno_pubblicazione", "amount": "importo_lotto"},
        {"year": "anno", "n_rows": "n_bandi", "total": "importo_totale"},
    ),
    "un_solo_offerente": (
        "rows_over",
        {
            "key": "cig",
            "measure": "importo_aggiudicazione",
            "shown": "num_imprese_offerenti",
            "state": "num_imprese_offerenti",
            "wanted": 1,
            "bound": 1e6,
        },
        {"key": "cig", "measure": "importo_aggiudicazione", "shown": "num_imprese_offerenti"},
    ),
    "sal_in_ritardo": (
        "rows_over",
        {
            "key": "cig",
            "measure": "n_giorni_scostamento",
            "shown": "importo_sal",
            "state": "flag_ritardo",
            "wanted": "IN RITARDO",
            "bound": None,
        },
        {"key": "cig", "measure": "n_giorni_scostamento", "shown": "importo_sal"},
    ),
}


def preview(table: DataFrame, key: list[str], n: int = 10) -> DataFrame:
    """The first rows of a table in the order of its key, so that every look shows the same."""
    return table.orderBy(*[F.col(k).asc_nulls_last() for k in key]).limit(n)


def columns(table: DataFrame) -> DataFrame:
    """The columns of a table, each with the number of rows that are there."""
    rows = table.agg(F.count("*").alias("n"))
    return rows.select(F.explode(F.array(*map(F.lit, table.columns))).alias("colonna"), "n")


def register(tables: dict[str, DataFrame]) -> None:
    """Expose every table as a temporary view under its own name."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def query(spark: SparkSession, sql: str, table: DataFrame) -> DataFrame:
    """Run SQL on one table, visible as `clean_input`."""
    table.createOrReplaceTempView("clean_input")
    return spark.sql(sql)


def ask(spark: SparkSession, question: str, table: DataFrame, **values) -> DataFrame:
    """One of `QUESTIONS` of a table; the columns and bounds are bound as parameters."""
    table.createOrReplaceTempView("clean_input")
    return spark.sql(QUESTIONS[question], args={"table": "clean_input", **values})


def run_template(spark: SparkSession, name: str, table: DataFrame) -> DataFrame:
    question, values, names = SQL_TEMPLATES[name]
    return ask(spark, question, table, **values).withColumnsRenamed(names)
