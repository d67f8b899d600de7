"""Cross marts on the small fixtures."""

from __future__ import annotations

import pytest

from helpers import day
from tenderlake.plans import cross
from tenderlake.plans.tenders import tenders_per_cig

TENDERS = (
    "cig string, anno_pubblicazione int, sezione_regionale string, oggetto_principale_contratto string, "
    "cf_amministrazione_appaltante string, denominazione_amministrazione_appaltante string, "
    "importo_lotto double, flag_importo_sospetto boolean, stato string, esito string, flag_pnrr boolean"
)


def tender(cig, year=2025, cf="CFX", sa="Comune X", amount=1.0, suspect=False, esito="AGGIUDICATA"):
    return (cig, year, "Lazio", "Lavori", cf, sa, amount, suspect, "ATTIVO", esito, False)


@pytest.fixture
def per_cig(frame):
    def make(*rows):
        return tenders_per_cig(frame(list(rows), TENDERS))

    return make


START = ("cig string, id_aggiudicazione long, data_stipula_contratto date, "
         "data_inizio_effettiva date, data_termine_contrattuale date")


def test_execution_needs_a_signature_or_an_end(frame, per_cig):
    cigs = ["CIG_A", "CIG_B", "CIG_C", "CIG_SENZA_STIPULA"]
    starts = frame(
        [
            ("CIG_A", 1, day("2025-01-10"), day("2025-02-01"), day("2025-12-31")),
            ("CIG_B", 2, day("2025-03-10"), day("2025-04-01"), day("2025-12-31")),
            ("CIG_C", 3, day("2025-05-10"), day("2025-06-01"), day("2025-12-31")),
            ("CIG_SENZA_STIPULA", 4, None, None, None),
        ],
        START,
    )
    awards = frame(
        [("CIG_A", 1, 100.0, day("2024-11-01")), ("CIG_B", 2, 200.0, day("2025-01-01")),
         ("CIG_C", 3, 300.0, day("2025-03-01"))],
        "cig string, id_aggiudicazione long, importo_aggiudicazione double, data_aggiudicazione_definitiva date",
    )
    ends = frame([(None, None)], "cig string, data_effettiva_ultimazione date")
    pauses = frame([(None, None, None)], "cig string, data_sospensione date, data_ripresa date")
    changes = frame([(None,)], "cig string")
    got = cross.mart_esecuzione(per_cig(*map(tender, cigs)), awards, starts, ends, pauses, changes).collect()
    assert [(r.n_contratti, r.n_con_stipula, r.n_con_ultimazione) for r in got] == [(3, 3, 0)]
    assert got[0].giorni_medi_aggiudicazione_stipula == 69.0  # 70, 68, 70
    assert got[0].quota_in_ritardo_pct is None


def test_acceptance_has_three_states(frame, per_cig):
    cigs = ["SENZA_RECORD", "RECORD_NO_DATA", "CON_DATA"]
    ends = frame([(c, day("2026-01-10")) for c in cigs], "cig string, data_effettiva_ultimazione date")
    tests = frame([("RECORD_NO_DATA", None), ("CON_DATA", day("2026-03-01"))], "cig string, data_cert_collaudo date")
    (r,) = cross.mart_collaudo_ritardo(per_cig(*map(tender, cigs)), ends, tests).collect()
    assert (r.n_opere_ultimate, r.n_con_record, r.n_senza_record) == (3, 2, 1)
    assert (r.n_record_senza_data, r.n_con_data) == (1, 1)
    assert (r.quota_senza_record_pct, r.quota_senza_data_certificato_pct) == (33.3, 66.7)
    assert r.giorni_mediani_ultimazione_collaudo == 50


BREAKDOWN = ("cig string, id_aggiudicazione long, importo_base double, importo_finale double, "
             "ha_consuntivo boolean, flag_base_sospetta boolean")


def test_cost_growth(frame, per_cig):
    breakdown = frame(
        [("A", 1, 1000.0, 950.0, True, False), ("B", 2, 1000.0, 1000.0, True, False),
         ("C", 3, 12e9, 12e9, True, True)],
        BREAKDOWN,
    )
    awards = frame(
        [("A", 1, 900.0, 10.0), ("B", 2, 1000.0, None), ("C", 3, 12e9, 0.0)],
        "cig string, id_aggiudicazione long, importo_aggiudicazione double, ribasso_aggiudicazione double",
    )
    changes = frame([("A", "per maggiori oneri"), ("A", "altro"), ("A", "altro"), ("B", None)],
                    "cig string, motivo_variante string")
    rows = {
        r.cig: r
        for r in cross.mart_sforamento(
            per_cig(*[tender(c, 2019) for c in "ABC"]), breakdown, awards, changes
        ).collect()
    }
    a, b, c = rows["A"], rows["B"], rows["C"]
    assert (a.base_scontata, a.sforamento, a.sforamento_scontato, a.plausibile) == (900, -50, 50, True)
    assert (a.n_varianti, a.motivi) == (3, "altro | per maggiori oneri")
    assert b.base_scontata is None and b.sforamento_scontato is None and b.ribasso_pct is None
    assert (b.n_varianti, b.motivi) == (1, None)
    assert not c.plausibile and c.motivo_esclusione == "base oltre 10 mld"


def test_who_pays(frame, per_cig):
    breakdown = frame(
        [("A", 1, 4e9, 0.0, True, False), ("B", 2, 6e9, 0.0, True, False), ("S", 3, 12e9, 0.0, True, True)],
        BREAKDOWN,
    )
    funding = frame(
        [("A", 1, "fondi_bilancio_sa", 3e9), ("A", 1, "entrate_vincolate_ue", 1e9)],
        "cig string, id_aggiudicazione long, fonte string, importo double",
    )
    authorities = frame([("CF1", "ENTI PUBBLICI NON ECONOMICI")], "codice_fiscale string, natura_giuridica string")
    lots = per_cig(*[tender(c, 2024, cf="CF1") for c in "ABS"])
    (r,) = cross.mart_chi_paga(lots, breakdown, funding, authorities, min_contracts=1).collect()
    assert (r.n_contratti, r.n_con_fonte, r.n_esclusi_importo_sospetto) == (3, 1, 1)
    assert (r.quota_con_fonte_pct, r.importo_contrattuale_mld, r.importo_finanziato_mld) == (33.3, 10.0, 4.0)
    assert (r.fin_bilancio_sa_mld, r.fin_ue_mld, r.fin_mutuo_mld) == (3.0, 1.0, None)
    assert r.rapporto_finanziato_contratto == 0.4
    assert r.natura_sa == "ENTI PUBBLICI NON ECONOMICI"


def test_late_statements_per_authority(frame, per_cig):
    late = "IN RITARDO"
    progress = frame(
        [("CIG1", 1, late, 10, 100.0), ("CIG1", 1, late, None, 150.0), ("CIG2", 2, late, 20, 50.0),
         ("CIG3", 3, late, 5, 500.0)],
        "cig string, id_aggiudicazione long, flag_ritardo string, n_giorni_scostamento int, importo_quota double",
    )
    lots = per_cig(tender("CIG1"), tender("CIG2"), tender("CIG3", suspect=True))
    (r,) = cross.mart_ritardi_per_sa(progress, lots).collect()
    assert (r.n_ritardi, r.n_cig_ritardo, r.max_gg_ritardo, r.media_gg_ritardo, r.importo_ritardo_totale) == (
        3, 2, 20, 15.0, 300.0)


def test_competition_counts_lots_once_unless_fanned_out(frame):
    lots = frame([tender("A", amount=10.0), tender("B", amount=5.0, esito="DESERTA")], TENDERS)
    awards = frame(
        [("A", 2, 100.0, 10.0), ("A", 4, 50.0, None), ("A", 9, -1.0, 0.0)],
        "cig string, num_imprese_offerenti int, importo_aggiudicazione double, ribasso_aggiudicazione double",
    )
    (r,) = cross.mart_competitivita(lots, awards).collect()
    assert (r.n_bandi, r.n_cig, r.importo_totale, r.n_aggiudicati, r.importo_aggiudicati) == (2, 2, 15.0, 1, 10.0)
    assert (r.offerenti_medi, r.ribasso_medio, r.tasso_aggiudicazione_pct) == (3.0, 10.0, 50.0)
    (r,) = cross.mart_competitivita(lots, awards, fan_out=True).collect()
    assert (r.n_bandi, r.n_cig, r.importo_totale, r.n_aggiudicati, r.importo_aggiudicati) == (3, 2, 25.0, 2, 20.0)
    assert r.tasso_aggiudicazione_pct == 66.7


def test_contract_delays(frame, per_cig):
    starts = frame([(c, 1, day("2024-01-01"), None, day("2024-06-30")) for c in "ABC"]
                   + [("A", 2, day("2023-01-01"), None, day("2023-06-30"))], START)
    ends = frame(
        [("A", day("2024-07-10")), ("B", day("2024-06-20")), ("C", day("2024-07-30"))],
        "cig string, data_effettiva_ultimazione date",
    )
    lots = per_cig(*[tender(c, amount=10.0) for c in "ABC"])
    (r,) = cross.mart_ritardi_contratto(lots, starts, ends).collect()
    assert (r.n_contratti, r.n_in_ritardo, r.giorni_medi_scostamento, r.giorni_mediani_scostamento) == (3, 2, 10, 10)
    assert (r.giorni_max_scostamento, r.importo_lotto_totale, r.importo_in_ritardo) == (30, 30, 20)
    assert r.quota_in_ritardo_pct == 66.7


FIRM = "cig string, id_aggiudicazione long, codice_fiscale string, denominazione string, tipo_soggetto string, ruolo string"


def test_firm_profiles(frame):
    winners = frame([("A", 1, " 1 ", "Alfa", "t", "r"), ("B", 2, "1", "Alfa", "t", "r"), ("C", 3, "9", "MANDANTE", "t", "r"),
                     ("C", 3, "8", None, "t", "r")], FIRM)
    bidders = frame([("A", 1, "1", "Alfa", "t", "r"), ("A", 1, "2", "Beta", "t", "r"),
                     ("A", 1, "3", "Ente", "Stazione appaltante", "r")], FIRM)
    subs = frame([("A", 1, "2", "Beta", None, "r"), ("A", 1, "4", "Gamma", None, "r")], FIRM)
    rows = {r.cf: r for r in cross.mart_imprese(winners, bidders, subs).collect()}
    assert sorted(rows) == ["1", "2", "4"]
    assert (rows["1"].n_aggiudicazioni, rows["1"].n_gare_partecipate, rows["1"].ruolo_prevalente) == (2, 1, "aggiudicatario")
    assert rows["2"].ruolo_prevalente == "subappaltante" and rows["1"].totale_attivita == 2


def test_stored_lots_are_joined_without_an_exchange(spark, tmp_path):
    """Tables of one row per lot in equally many buckets; one lot has most of the rows of the
    clean tables, but not of these."""
    from datetime import date

    from pyspark.sql import functions as F

    from tenderlake.plans import cross
    from tenderlake.sources import layers

    lot = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 50).cast("string"))
    days = F.date_add(F.lit(date(2020, 1, 1)), (F.col("id") % 300).cast("int"))
    rows = spark.range(2000).select(
        lot.alias("cig"), F.col("id").alias("id_aggiudicazione"), F.lit(10.0).alias("importo_aggiudicazione"),
        *[days.alias(c) for c in ("data_aggiudicazione_definitiva", "data_stipula_contratto", "data_inizio_effettiva",
                                  "data_termine_contrattuale", "data_effettiva_ultimazione", "data_sospensione",
                                  "data_ripresa", "data_cert_collaudo")],
    )
    per_cig = rows.groupBy("cig").agg(
        F.lit(2020).alias("anno"), F.lit("R").alias("regione"), F.lit("S").alias("settore"), F.lit("CF").alias("cf_sa"),
        F.lit("SA").alias("sa"), F.lit(1.0).alias("importo_lotto"),
    )
    lots = cross.lots_of(per_cig, *[rows] * 6)
    stored = {n: layers.write_bucketed(df, str(tmp_path / n), "cig", 5) for n, df in lots.items()}
    for mart in (cross.execution_of_lots, cross.deviations_of_lots, cross.acceptance_of_lots):
        assert sorted(map(repr, mart(stored).collect())) == sorted(map(repr, mart(lots).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for mart in (cross.execution_of_lots, cross.deviations_of_lots, cross.acceptance_of_lots):
            plan = mart(stored)._jdf.queryExecution().executedPlan().toString()
            below = plan[plan.index("SortMergeJoin") :]
            assert "Exchange" not in below and "SortMergeJoin" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Another session finds the table by its path.
    schema = stored["ended"].schema
    spark.sql(f"DROP TABLE {layers.bucketed_name(str(tmp_path / 'ended'))}")
    again = layers.read_bucketed(spark, str(tmp_path / "ended"), schema, "cig", 5)
    assert sorted(map(repr, again.collect())) == sorted(map(repr, lots["ended"].collect()))
