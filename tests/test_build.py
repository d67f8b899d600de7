"""All datasets from files to stored marts, then the cross marts over them."""

from __future__ import annotations

from tenderlake.plans import build, quality

LOTS = [f"L{i:02d}" for i in range(12)]

# One line per lot; {c} is the lot, {i} its number.
FEEDS = {
    "bandi_gara": ("cig;anno_pubblicazione;importo_lotto;stato;sezione_regionale;oggetto_principale_contratto;"
                   "cf_amministrazione_appaltante;denominazione_amministrazione_appaltante;esito;FLAG_PNRR_PNC;"
                   "tipo_scelta_contraente;importo_complessivo_gara",
                   "{c};2020;100;ATTIVO;LAZIO;LAVORI;CF1;Comune;AGGIUDICATA;1;APERTA;100"),
    "aggiudicazioni": ("cig;id_aggiudicazione;data_aggiudicazione_definitiva;importo_aggiudicazione;ribasso_aggiudicazione;"
                       "num_imprese_offerenti", "{c};{i};2020-01-01;90;10;3"),
    "aggiudicatari": ("cig;id_aggiudicazione;codice_fiscale;denominazione;ruolo;tipo_soggetto", "{c};{i};F1;Ditta;MANDATARIA;IMPRESA"),
    "partecipanti": ("cig;codice_fiscale;denominazione;ruolo;tipo_soggetto", '{c};F{i};"Ditta\n{i}";MANDANTE;IMPRESA'),
    "subappalti": ("cig;id_subappalto;cod_categoria;codice_fiscale;denominazione;cf_subappaltante", "{c};S{i};OG1;F9;Sub;F1"),
    "avvio_contratto": ("cig;id_aggiudicazione;data_stipula_contratto;data_inizio_effettiva;data_termine_contrattuale",
                        "{c};{i};2020-02-01;2020-03-01;2020-12-31"),
    "fine_contratto": ("cig;id_aggiudicazione;data_effettiva_ultimazione", "{c};{i};2021-01-10"),
    "sospensioni": ("cig;id_aggiudicazione;data_sospensione;data_ripresa;descrizione_motivo", "{c};{i};2020-05-01;2020-05-11;PIOGGIA"),
    "varianti": ("cig;id_aggiudicazione;id_variante;motivo_variante;data_approvazione_variante", "{c};{i};{i};M;2020-06-01"),
    "collaudo": ("cig;id_aggiudicazione;data_cert_collaudo;data_delibera", "{c};{i};2021-03-01;2021-04-01"),
    "stati_avanzamento": ("cig;id_aggiudicazione;progressivo_sal;data_emissione_sal;importo_sal;flag_ritardo;n_giorni_scostamento",
                          "{c};{i};1;2020-07-01;50;IN RITARDO;4"),
    "cup": ("cig;cup", "{c};P1"),
    "stazioni_appaltanti": ("codice_fiscale;natura_giuridica_descrizione;provincia_nome;citta_nome;stato", "CF{i};ENTE;ROMA;ROMA;ATTIVO"),
    "quadro_economico": ("cig;id_aggiudicazione;descrizione_evento;dettaglio_evento;importo_lavori",
                         "{c};{i};BASE_ASTA;B;1000\n{c};{i};CONSUNTIVO;C;950"),
    "fonti_finanziamento": ("cig;id_aggiudicazione;mutuo", "{c};{i};400"),
}


def test_files_to_marts(spark, tmp_path):
    root = str(tmp_path / "out")
    for dataset, (header, line) in FEEDS.items():
        lines = [line.format(c=c, i=i) for i, c in enumerate(LOTS)]
        file = tmp_path / f"00-{dataset}.csv"
        file.write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")
        tables = build.build_dataset(spark, dataset, [str(file)], root, check=False)
        assert set(tables) == {"clean", *build.MARTS[dataset]}
        assert tables["clean"].count() == len(lines) * (2 if dataset == "quadro_economico" else 1)
        rules = quality.CLEAN_RULES[dataset]
        if dataset != "stazioni_appaltanti":  # its optional columns are not in this feed
            quality.validate(quality.audit(tables["clean"], dataset, rules))
    marts = build.build_cross(spark, root, check=False)

    def only(name):
        (row,) = marts[name].collect()
        return row

    assert only("mart_panoramica").n_lotti == 12
    assert only("mart_competitivita").offerenti_medi == 3.0
    late = only("mart_ritardi_per_sa")
    assert (late.n_ritardi, late.importo_ritardo_totale) == (12, 600.0)
    times = only("mart_esecuzione")
    assert (times.n_contratti, times.giorni_medi_aggiudicazione_stipula, times.giorni_medi_sospensione) == (12, 31.0, 10.0)
    assert (times.n_in_ritardo, times.giorni_medi_scostamento_termine, times.varianti_medie) == (12, 10.0, 1.0)
    assert only("mart_ritardi_contratto").giorni_mediani_scostamento == 10.0
    assert only("mart_collaudo_ritardo").n_con_data == 12
    growth = marts["mart_sforamento"].collect()
    assert len(growth) == 12 and {r.sforamento_scontato for r in growth} == {50.0}
    paid = only("mart_chi_paga")
    assert (paid.n_contratti, paid.n_con_fonte, paid.natura_sa) == (12, 12, "ENTE")
    firms = {r.cf: r.ruolo_prevalente for r in marts["mart_imprese"].collect()}
    assert firms["F1"] == "aggiudicatario" and firms["F9"] == "subappaltante" and firms["F5"] == "partecipante"
