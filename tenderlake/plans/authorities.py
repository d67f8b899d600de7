"""Marts over the registry of contracting authorities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import not_blank
from ..operators.reshape import share_of_total
from .tenders import n_rows, n_where


def mart_natura(authorities: DataFrame) -> DataFrame:
    """Authorities per legal nature; undeclared ones stay in the count."""
    active = F.col("stato") == "ATTIVO"
    groups = authorities.groupBy(
        F.coalesce("natura_giuridica", F.lit("NON DICHIARATA")).alias("natura_giuridica")
    ).agg(
        n_rows().alias("n_sa"), n_where(active).alias("n_attive"), n_where(~active).alias("n_cessate")
    )
    return share_of_total(groups, "n_sa", "quota_pct").orderBy(
        F.col("n_sa").desc(), "natura_giuridica"
    )


def mart_territorio(authorities: DataFrame) -> DataFrame:
    groups = (
        authorities.where(not_blank("provincia"))
        .groupBy("provincia")
        .agg(
            n_rows().alias("n_sa"),
            n_where(F.col("stato") == "ATTIVO").alias("n_attive"),
            F.count_distinct("citta").alias("n_comuni"),
        )
    )
    return share_of_total(groups, "n_sa", "quota_pct").orderBy(F.col("n_sa").desc(), "provincia")
