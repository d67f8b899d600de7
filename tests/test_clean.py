"""Clean tables on the small fixtures: delta rules, dedup, flags, series."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from helpers import as_dicts, day, text_schema
from tenderlake.plans import clean as C
from tenderlake.plans import execution, finance, tenders
from tenderlake.plans.authorities import mart_natura, mart_territorio
from tenderlake.plans.fields import FONTI_FINANZIAMENTO


def test_awards_delta_replaces_full(frame):
    full, d1, d2 = "00-aggiudicazioni.csv", "01-20260401-aggiudicazioni.csv", "02-20260501-aggiudicazioni.csv"
    raw = frame(
        [
            ("CIG1", "2025-01-10", "1000", "2025-01-20", "1", full),
            ("CIG1", "2025-03-10", "500", "2025-03-20", "2", full),
            ("CIG2", "2025-02-10", "100", "2025-02-20", "5", full),
            ("CIG2", "2025-02-10", "100", "2025-02-20", "5", full),
            ("CIG1", "2025-01-10", "1200", "2025-06-20", "1", d1),
            ("CIG1", "2025-04-10", "300", "2025-06-21", "3", d1),
            ("CIG3", "7436-02-12", "9999", "2026-03-01", "9", d2),
        ],
        text_schema(
            "cig", "data_aggiudicazione_definitiva", "importo_aggiudicazione",
            "data_comunicazione_esito", "id_aggiudicazione", "__source_file",
        ),
    )
    clean = C.clean_aggiudicazioni(raw)
    got = sorted((r.cig, r.id_aggiudicazione, r.importo_aggiudicazione) for r in clean.collect())
    assert got == [("CIG1", 1, 1200.0), ("CIG1", 3, 300.0), ("CIG2", 5, 100.0)]
    assert "__source_file" not in clean.columns and len(clean.columns) == 28


def _tenders_raw(frame):
    columns = (
        "cig", "numero_gara", "oggetto_gara", "importo_complessivo_gara", "importo_lotto",
        "anno_pubblicazione", "data_pubblicazione", "data_ultimo_perfezionamento", "esito",
        "cf_amministrazione_appaltante", "oggetto_principale_contratto", "FLAG_PNRR_PNC",
    )
    tail = ("AGGIUDICATA", "CF1", "LAVORI", "0")
    rows = [
        ("CIG_A", "123456", "o", "1500000", "1500000", "2024", "2024-03-01", "2024-03-01", *tail),
        ("CIG_A", "123456", "o", "1500000", "1500000", "2024", "2024-03-01", "2024-03-01", *tail),
        ("CIG_B", "CONSIP_RDO_4955828", "o", "9400334903", "9400334903", "2024", "2024-09-16", "2024-09-12", *tail),
        ("CIG_C", "789", "o", "300000", "250000", "2024", "2024-05-10", "2024-05-01", *tail),
        ("CIG_C", "789", "o", "300000", "300000", "2024", "2024-06-10", "2024-06-01", *tail),
        ("CIG_D", "999", "o", "16236.51", "1623651", "2024", "2024-07-10", "2024-07-01", *tail),
        ("CIG_E", "888", "o", "500000", "500000", "2023", "2023-11-10", "2023-11-01", *tail),
    ]
    return frame(rows, text_schema(*columns))


def test_tenders(frame):
    clean = C.clean_bandi_gara(_tenders_raw(frame), [2024])
    rows = {r.cig: r for r in clean.collect()}
    assert sorted(rows) == ["CIG_A", "CIG_B", "CIG_C", "CIG_D"]
    assert len(clean.columns) == 58
    assert [c for c in sorted(rows) if rows[c].flag_importo_sospetto] == ["CIG_B", "CIG_D"]
    assert rows["CIG_B"].importo_lotto == 9400334903.0
    assert rows["CIG_C"].importo_lotto == 300000.0
    assert rows["CIG_B"].numero_gara == "CONSIP_RDO_4955828"
    yearly = tenders.mart_annuale(clean).collect()
    assert [(r.anno, r.importo_totale, r.n_importi_sospetti, r.importo_sospetti) for r in yearly] == [
        (2024, 1800000.0, 2, 9401958554.0)
    ]
    assert yearly[0].importo_mediano == 900000.0


def test_tenders_all_years_keep_each_year(frame):
    assert C.clean_bandi_gara(_tenders_raw(frame)).count() == 5


SAL = "cig string, denominazione_sal string, flag_ritardo string, data_emissione_sal string, " \
      "importo_sal string, n_giorni_scostamento string, progressivo_sal string, " \
      "id_aggiudicazione string, __source_file string"


def _sal(cig, award, days, amounts, late=None):
    late = late or {}
    return [
        (cig, f"SAL {i}", "IN RITARDO" if i in late else "IN LINEA", d, str(a),
         str(late.get(i, 0)), str(i), award, "00-test.csv")
        for i, (d, a) in enumerate(zip(days, amounts), start=1)
    ]


def _sal_fixture(frame):
    rows = [
        *_sal("CIG1", "1", ["2024-01-10", "2024-06-10", "2025-01-10"], [100, 250, 400], {2: 10}),
        *_sal("CIG2", "2", ["2024-02-10", "2024-08-10", "2025-02-10"], [50, 50, 50]),
        *_sal("CIG3", "3", ["2024-03-10", "2024-09-10", "2025-03-10"], [100, 200, 150]),
        *_sal("CIG4", "4", ["2024-04-10", "2024-10-10", "2025-04-10"], [300, 200, 100]),
        *_sal("CIG5", "5", ["2024-05-10"], [75], {1: 5}),
        *_sal("CIG6", None, ["2024-05-11", "2024-11-11"], [10, 30]),
        *_sal("CIG7", "7", ["2024-06-01"] * 3, [500, 500, 500]),
        *_sal("CIG8", "8", [f"2024-0{m}-01" for m in range(1, 7)], [10, 100] * 3),
    ]
    return frame(rows, SAL)


def test_progress_series(frame):
    clean = C.clean_stati_avanzamento(_sal_fixture(frame)).cache()
    totals = {
        r.cig: (r.tipo, r.quota)
        for r in clean.groupBy("cig")
        .agg(F.any_value("tipo_serie").alias("tipo"), F.sum("importo_quota").alias("quota"))
        .collect()
    }
    assert totals == {
        "CIG1": ("monotona", 400.0), "CIG2": ("monotona", 50.0), "CIG3": ("anomala", 200.0),
        "CIG4": ("anomala", 300.0), "CIG5": ("singola", 75.0), "CIG6": ("monotona", 30.0),
        "CIG7": ("singola", 500.0), "CIG8": ("anomala", 100.0),
    }
    assert clean.count() == 24

    def quotas(cig):
        rows = clean.where(F.col("cig") == cig).orderBy("data_emissione_sal", "progressivo_sal")
        return [r.importo_quota for r in rows.collect()]

    assert quotas("CIG1") == [0, 0, 400]
    assert quotas("CIG3") == [0, 200, 0]
    assert quotas("CIG7") == [500, 0, 0]
    yearly = (
        execution.mart_sal(clean)
        .groupBy("anno")
        .agg(F.sum("importo_totale").alias("t"), F.sum("n_serie_anomale").alias("n"))
        .orderBy("anno")
    )
    assert [tuple(r) for r in yearly.collect()] == [(2024, 1255.0, 3), (2025, 400.0, 2)]
    clean.unpersist()


def test_series_matches_row_by_row_rule(spark):
    """Random series, NULL days and amounts included, against a plain loop."""
    import random

    rnd = random.Random(5)
    rows = []
    for n in range(600):
        rows.append(
            (f"C{rnd.randrange(12)}", rnd.choice([None, *range(8)]), n,
             rnd.choice([None, date(2024, 1, rnd.randrange(1, 9))]),
             rnd.choice([None, float(rnd.randrange(6))]))
        )
    df = spark.createDataFrame(
        rows, "cig string, id_aggiudicazione long, progressivo_sal int, data_emissione_sal date, importo_sal double"
    )
    series: dict[str, list] = {}
    for r in rows:
        series.setdefault(f"agg:{r[1]}" if r[1] is not None else f"cig:{r[0]}", []).append(r)
    expected = {}
    for group in series.values():
        last = lambda v: (v is None, v if v is not None else 0)
        points: dict = {}
        for r in sorted(group, key=lambda r: r[2]):
            points.setdefault((r[3], r[4]), r)
        ordered = sorted(points.values(), key=lambda r: (
            (r[3] is None, r[3] or date.min), last(r[2]), last(r[4])))
        amounts = [r[4] for r in ordered]
        falls = any(a is not None and b is not None and b < a for a, b in zip(amounts, amounts[1:]))
        top = max((a for a in amounts if a is not None), default=None)
        peak = next((r[2] for r in ordered if top is not None and r[4] == top), None)
        kind = "singola" if len(ordered) == 1 else "anomala" if falls else "monotona"
        for r in group:
            expected[r[2]] = (kind, top if r[2] == peak else 0.0)
    got = {r.progressivo_sal: (r.tipo_serie, r.importo_quota) for r in C.classify_series(df).collect()}
    assert got == expected


QE = ("cig", "id_aggiudicazione", "data", "descrizione_evento", "dettaglio_evento", "importo_lavori",
      "importo_servizi", "importo_forniture", "somme_a_disposizione", "__source_file")


def _qe(frame, rows):
    return C.clean_quadro_economico(frame(rows, text_schema(*QE)))


def test_cost_breakdown(frame):
    full, delta = "000-full.csv", "001-delta.csv"
    clean = _qe(frame, [
        ("CIG_A", "1", None, "BASE_ASTA", "B1", "100", "0", "0", "10", full),
        ("CIG_A", "1", "2025-03-01", "VARIANTE", "V1", "120", "0", "0", "12", full),
        ("CIG_A", "1", None, "CONSUNTIVO", "C1", "130", "0", "0", "13", full),
        ("CIG_B", "2", None, "BASE_ASTA", "B2", "50", "0", "0", "5", full),
        ("CIG_B", "2", "2025-06-01", "VARIANTE", "V2", "60", "0", "0", "6", full),
        ("CIG_B", "2", "2025-06-01", "VARIANTE", "V2", "70", "0", "0", "7", delta),
        ("CIG_C", "3", None, "CONSUNTIVO", "C3", "0", "40", "0", "4", full),
    ])
    b = sorted((r.descrizione_evento, r.importo_lavori) for r in clean.where("cig = 'CIG_B'").collect())
    assert b == [("BASE_ASTA", 50.0), ("VARIANTE", 70.0)]
    rows = {r.cig: r for r in finance.mart_cig(clean).collect()}
    a = rows["CIG_A"]
    assert (a.importo_base, a.importo_finale, a.scostamento, a.scostamento_pct) == (100, 130, 30, 30)
    assert (a.n_varianti, a.ha_consuntivo, a.somme_base, a.somme_finali) == (1, True, 10, 13)
    assert (rows["CIG_B"].importo_base, rows["CIG_B"].importo_finale) == (50, 70)
    assert "CIG_C" not in rows
    dated = {r.descrizione_evento: r.n_con_data for r in finance.mart_eventi(clean).collect()}
    assert dated == {"BASE_ASTA": 0, "CONSUNTIVO": 0, "VARIANTE": 2}


def test_cost_breakdown_tail(frame):
    rows = [
        ("CIG_S", "1", None, "BASE_ASTA", "B", None, "250", None, None, "0"),
        ("CIG_N", "2", None, "BASE_ASTA", "B", None, None, None, None, "0"),
        ("CIG_X", "3", None, "BASE_ASTA", "B", "15000000000", None, None, None, "0"),
        ("CIG_G", "4", None, "BASE_ASTA", "B", "2000000000", None, None, None, "0"),
    ]
    got = {r.cig: r for r in finance.mart_cig(_qe(frame, rows)).collect()}
    assert got["CIG_S"].importo_base == 250 and "CIG_N" not in got
    assert got["CIG_X"].flag_base_sospetta and got["CIG_X"].flag_base_grande
    assert got["CIG_G"].flag_base_grande and not got["CIG_G"].flag_base_sospetta


def test_funding(frame):
    record = [f.source for f in FONTI_FINANZIAMENTO[2:]]
    budget, eu = record.index("fondi_di_bilancio_della_stazione_appaltante"), record.index(
        "entrate_con_dest_vincolata_pubblica_comunitaria")

    def row(cig, award, own, union, file):
        amounts = ["0"] * 13
        amounts[budget], amounts[eu] = own, union
        return (cig, award, *amounts, file)

    raw = frame(
        [
            row("CIG_A", "1", "100", "50", "000-full.csv"),
            row("CIG_B", "2", "0", "0", "000-full.csv"),
            row("CIG_C", "3", "2000000000", "0", "000-full.csv"),
            row("CIG_A", "1", "120", "50", "001-delta.csv"),
            row("CIG_Z", None, "5", "0", "000-full.csv"),
            row("CIG_Z", None, "5", "0", "001-delta.csv"),
            row("CIG_Z", None, "6", "0", "000-full.csv"),
        ],
        text_schema("cig", "id_aggiudicazione", *record, "__source_file"),
    )
    clean = C.clean_fonti_finanziamento(raw)
    rows = {r.cig: r for r in clean.where("cig <> 'CIG_Z'").collect()}
    assert len(rows) == 3
    a = rows["CIG_A"]
    assert (a.fondi_bilancio_sa, a.totale_fonti, a.n_fonti) == (120, 170, 2)
    assert a.fonte_prevalente == "bilancio stazione appaltante"
    b = rows["CIG_B"]
    assert (b.totale_fonti, b.fonte_prevalente, b.flag_fonti_sospette) == (0, None, False)
    assert rows["CIG_C"].flag_fonti_sospette
    assert sorted(r.totale_fonti for r in clean.where("cig = 'CIG_Z'").collect()) == [5, 6]
    long = finance.mart_fonti(clean.where("cig <> 'CIG_Z'")).collect()
    assert sorted((r.cig, r.fonte, r.importo) for r in long) == [
        ("CIG_A", "entrate_vincolate_ue", 50.0), ("CIG_A", "fondi_bilancio_sa", 120.0)]


def test_authorities(frame):
    columns = ("codice_fiscale", "partita_iva", "denominazione", "codice_ausa", "natura_giuridica_codice",
               "natura_giuridica_descrizione", "provincia_nome", "citta_nome", "flag_inHouse",
               "flag_partecipata", "stato", "data_inizio")
    raw = frame(
        [
            (" 80106870159 ", "01111111111", "A", "0000323919", "15", "ENTI PUBBLICI NON ECONOMICI", "MILANO", "MILANO", "false", "false", "ATTIVO", "2013-07-09"),
            ("04634700241", "04634700241", "B", "0000765156", None, None, "VICENZA", "VICENZA", "false", "false", "ATTIVO", "2013-07-09"),
            ("94134700213", "00000000000", "C", "0000560852", "10", "ALTRI ENTI", "BOLZANO", "BOLZANO", "true", "true", "CESSATO", "2013-07-09"),
            ("00613760677", None, None, "0000258556", "24", "SOCIETA IN NOME COLLETTIVO", "TERAMO", "TERAMO", "false", "false", "ATTIVO", "2013-07-09"),
        ],
        text_schema(*columns),
    )
    clean = C.clean_stazioni_appaltanti(raw)
    rows = {r.codice_fiscale: r for r in clean.collect()}
    assert len(rows) == 4 and rows["80106870159"].codice_ausa == "0000323919"
    third = rows["94134700213"]
    assert third.partita_iva is None and third.flag_inhouse and third.flag_partecipata
    assert rows["00613760677"].denominazione is None and "data_fine" not in clean.columns
    natures = {r.natura_giuridica: r.n_sa for r in mart_natura(clean).collect()}
    assert natures["NON DICHIARATA"] == 1 and sum(natures.values()) == 4
    assert {r.quota_pct for r in mart_territorio(clean).collect()} == {25.0}


def test_starts_and_ends(frame):
    raw = frame(
        [
            ("A", "1", "2020-01-10", "2019-01-01", "2019-12-31", "0001-01-01", "1", "f0"),
            ("A", "1", "2020-02-10", "2030-01-01", "2021-01-31", "2020-03-01", "0", "f0"),
            ("B", "1", "1999-12-31", "2041-01-01", "2060-12-31", None, None, "f0"),
            (None, "9", "2020-01-10", None, None, None, None, "f0"),
        ],
        text_schema("cig", "id_aggiudicazione", "data_stipula_contratto", "data_inizio_effettiva",
                    "data_termine_contrattuale", "data_esecutivita_contratto", "consegna_frazionata",
                    "__source_file"),
    )
    rows = {r.cig: r for r in C.clean_avvio_contratto(raw, as_of=date(2026, 1, 1)).collect()}
    assert sorted(rows) == ["A", "B"]
    a, b = rows["A"], rows["B"]
    assert a.data_stipula_contratto == day("2020-02-10")
    assert a.data_inizio_effettiva is None  # after as_of
    assert a.data_termine_contrattuale == day("2021-01-31")
    assert a.data_esecutivita_contratto == day("2020-03-01")
    assert b.data_stipula_contratto is None and b.data_termine_contrattuale == day("2060-12-31")

    ends = frame(
        [("A", "1", "2021-05-01", " x ", "f0"), ("A", "1", "2021-06-01", "", "f0"), ("A", "1", "2021-01-01", "y", "e9")],
        text_schema("cig", "id_aggiudicazione", "data_effettiva_ultimazione", "motivo_risoluzione", "__source_file"),
    )
    got = as_dicts(C.clean_fine_contratto(ends, as_of=date(2026, 1, 1)))
    assert len(got) == 1 and got[0]["data_effettiva_ultimazione"] == day("2021-06-01")
    assert got[0]["motivo_risoluzione"] is None


def test_suspensions_keep_unreadable_days_apart(frame):
    raw = frame(
        [("A", "1", "2020-01-10", "2020-02-10", "m", "f0"), ("A", "1", "2020-01-10", "2020-03-10", "m", "f0"),
         ("A", "1", "bad", None, "m", "f0"), ("A", "1", "worse", None, "m", "f0")],
        text_schema("cig", "id_aggiudicazione", "data_sospensione", "data_ripresa", "descrizione_motivo", "__source_file"),
    )
    got = C.clean_sospensioni(raw, as_of=date(2026, 1, 1)).collect()
    assert len(got) == 3
    assert [r.data_ripresa for r in got if r.data_sospensione] == [day("2020-03-10")]


def test_small_tables(frame):
    cup = frame([("A", "P1"), (" A ", "P1"), ("", "P2"), ("B", None)], text_schema("cig", "cup"))
    assert sorted(tuple(r) for r in C.clean_cup(cup).collect()) == [("A", "P1"), ("A", "P1")]
    bidders = frame(
        [("A", "MANDANTE", "1", "X", "t", "f0"), ("A", "MANDANTE", "1", "X", "t", "f0"), ("B", "r", "2", "Y", "t", "f0"),
         ("B", "r", "3", "Z", "t", "f1")],
        text_schema("cig", "ruolo", "codice_fiscale", "denominazione", "tipo_soggetto", "__source_file"),
    )
    got = sorted((r.cig, r.codice_fiscale) for r in C.clean_partecipanti(bidders).collect())
    assert got == [("A", "1"), ("B", "3")]
    winners = bidders.withColumn("id_aggiudicazione", F.when(F.col("cig") == "A", "7").otherwise("n/d"))
    assert [(r.cig, r.id_aggiudicazione) for r in C.clean_aggiudicatari(winners).collect()] == [("A", 7)]
    subs = frame(
        [("A", "s", "c", "1", "2020-01-01", "old", "f0"), ("A", "s", "c", "1", "2021-01-01", "new", "f0")],
        text_schema("cig", "id_subappalto", "cod_categoria", "codice_fiscale", "data_autorizzazione", "oggetto", "__source_file"),
    )
    assert [r.oggetto for r in C.clean_subappalti(subs).collect()] == ["new"]
    changes = frame([("A", "1", "f0"), ("A", "1", "f0")], text_schema("cig", "id_variante", "__source_file"))
    assert C.clean_varianti(changes).count() == 2
    tests = frame(
        [("A", "1", "2020-01-01", None, "f0"), ("A", "1", None, "2022-01-01", "f0"), ("", "1", None, None, "f0")],
        text_schema("cig", "id_aggiudicazione", "data_cert_collaudo", "data_delibera", "__source_file"),
    )
    assert [r.data_cert_collaudo for r in C.clean_collaudo(tests).collect()] == [day("2020-01-01")]


def test_files_compete_for_published_keys(frame):
    """Two spellings of a lot are two keys of the published files."""
    rows = [(" A", "1", "X", "00-full.csv"), ("A", "2", "Y", "01-delta.csv"), ("A", "3", "Z", "00-full.csv")]
    bidders = frame(rows, text_schema("cig", "codice_fiscale", "denominazione", "__source_file"))
    got = sorted((r.cig, r.denominazione) for r in C.clean_partecipanti(bidders).collect())
    assert got == [("A", "X"), ("A", "Y")]


def test_unreadable_ids_stay_apart(frame):
    rows = [("A", "n/d", "E", "D", "1", "00"), ("A", "x/y", "E", "D", "2", "00"), ("A", "x/y", "E", "D", "3", "01")]
    events = frame(
        rows,
        text_schema("cig", "id_aggiudicazione", "descrizione_evento", "dettaglio_evento", "importo_lavori", "__source_file"),
    )
    assert sorted(r.importo_lavori for r in C.clean_quadro_economico(events).collect()) == [1.0, 3.0]
