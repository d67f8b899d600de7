"""The registered queries: all documented, and a choice of them against their SQL."""

from __future__ import annotations

import importlib.util
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
SF = "/root/testdata/sf0.001"

sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))

from workload import QUERIES  # noqa: E402

pytestmark = pytest.mark.skipif(not Path(SF).is_dir(), reason="given tables not there")

SAMPLE = [
    "clean_bandi_gara",
    "clean_aggiudicazioni",
    "clean_stati_avanzamento",
    "clean_fonti_finanziamento",
    "mart_annuale_bandi",
    "mart_top_stazioni",
    "mart_annuale_aggiudicazioni",
    "mart_imprese",
    "mart_ritardi_per_sa",
    "mart_competitivita_fan_out",
    "mart_esecuzione",
    "mart_sforamento",
    "mart_chi_paga",
    "execution_funnel",
    "consortia",
    "market_concentration",
    "region_year_matrix",
    "lookup_lots",
    "audit_report",
    "csv_scan_with_provenance",
    "csv_scan_with_line_breaks",
]


@pytest.fixture(scope="module")
def driver():
    spec = importlib.util.spec_from_file_location("__spark_entry__", ROOT / "__spark_entry__.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


def test_entry_gives_rows(driver, spark):
    assert driver.entry(spark).count() > 0


def test_every_query_is_compared_and_documented(driver):
    own = {q for q in driver.queries() if q in QUERIES}
    assert own - set(driver.oracle_sql()) == set()
    readme = (ROOT / "README.md").read_text(encoding="utf-8")
    families = ("clean_", "mart_", "sql_", "lookup_lots_")
    missing = [q for q in own if q not in readme and not q.startswith(families)]
    assert missing == []


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_sql(driver, spark, name):
    import compare

    df = driver.queries()[name](spark, SF)
    result = compare.connect(SF).execute(driver.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    got = [tuple(r) for r in df.collect()]
    assert compare.difference(df.columns, got, columns, result.fetchall()) == ""
