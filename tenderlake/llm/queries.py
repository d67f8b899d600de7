"""The registered queries of this package, each over its whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    centroids,
    conversations,
    fingerprints,
    jaccard,
    language,
    middles,
    mixing,
    neighbours,
    packing,
    repeats,
    toxicity,
    urls,
    warc,
)
from .common import prepare, table

VOCABULARY = "word_bpe_49k.json"


def vocabulary() -> str:
    """Path of the public vocabulary the packing query counts tokens with."""
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


@query("op1_language_id")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every document."""
    return language.languages(table(spark, sf_dir, "documents"))


@query("op8_toxicity")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.toxic_documents(docs, labels)


@query("op3_best_fit_packing")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary())


@query("op6_ngram_jaccard_join")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    return jaccard.duplicate_classes(table(spark, sf_dir, "documents"))


@query("op2_source_mixing", mixing.ORACLE)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return mixing.mix(docs, labels).select("doc_id", "size", "source_size", "target", "taken")


@query("op7_cross_polytope_neighbours")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors found for every hundredth one."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


@query("op9_prefix_fingerprints")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


@query("op4_warc_boundaries", warc.ORACLE)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back."""
    return warc.archived_pages(table(spark, sf_dir, "pages"))


@query("op5_url_list_as_of", urls.ORACLE)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The decision of the list entries active at each page's fetch."""
    return urls.judged_pages(table(spark, sf_dir, "pages"))


@query("op10_snapshot_collapse", conversations.ORACLE)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rendered turns of the maximal conversations."""
    return conversations.rendered(table(spark, sf_dir, "conversations"))


@query("op11_fill_in_middle", middles.ORACLE)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut at two places, its parts put in another order and back."""
    return middles.digests(table(spark, sf_dir, "documents"))


@query("op12_column_wise_repeats", repeats.ORACLE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its long repeated strings."""
    return repeats.digests(table(spark, sf_dir, "documents"))


@query("op13_orchard_clusters", centroids.ORACLE)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cluster of every vector after ten rounds over whole numbers."""
    return centroids.centroid_clusters(table(spark, sf_dir, "embeddings"))
