"""Column layouts of the published tables and the typed projection built from them.

A layout line is `<clean column> <kind> [<published column>]`; the published name
defaults to the clean one. Names, kinds and code values are fixed by the
published data.

kinds: text (as published), norm (trimmed, '' -> NULL), int, long, double,
zero (double, missing = 0), date, date90 (date, NULL before 1990),
event (date with the 0001-01-01 sentinel), flag:<yes value>
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S


class Field(NamedTuple):
    name: str
    kind: str
    source: str


def layout(text: str) -> list[Field]:
    fields = []
    for line in text.strip().splitlines():
        name, kind, *source = line.split()
        fields.append(Field(name, kind, source[0] if source else name))
    return fields


_KINDS = {
    "text": S.as_text,
    "norm": S.normalize_string,
    "int": S.cast_int,
    "long": S.cast_bigint,
    "double": S.cast_double,
    "zero": lambda c: F.coalesce(S.cast_double(c), F.lit(0.0)),
    "date": S.safe_date,
    "date90": lambda c: S.domain_date(S.safe_date(c)),
    "event": lambda c: S.safe_date(S.null_if(S.as_text(c), S.DATE_SENTINEL)),
}


def published(raw: DataFrame, name: str) -> Column:
    """A published column, NULL text where this export lacks it."""
    known = {c.lower() for c in raw.columns}
    return F.col(f"`{name}`") if name.lower() in known else F.lit(None).cast("string")


def typed(raw: DataFrame, fields: list[Field]) -> list[Column]:
    columns = []
    for field in fields:
        source = published(raw, field.source)
        if field.kind.startswith("flag:"):
            value = S.decode_flag(source, field.kind.removeprefix("flag:"))
        else:
            value = _KINDS[field.kind](source)
        columns.append(value.alias(field.name))
    return columns


def names(fields: list[Field]) -> list[str]:
    return [f.name for f in fields]


BANDI_GARA = layout(
    """
    cig text
    cig_accordo_quadro text
    cig_collegamento text
    cui_programma text
    numero_gara text
    oggetto_gara text
    importo_complessivo_gara double
    n_lotti_componenti int
    oggetto_lotto text
    importo_lotto double
    oggetto_principale_contratto text
    stato text
    settore text
    codice_istat_luogo text luogo_istat
    provincia text
    data_pubblicazione date90
    data_scadenza_offerta date90
    cod_tipo_scelta_contraente text
    tipo_scelta_contraente text
    cod_modalita_realizzazione text
    modalita_realizzazione text
    codice_ausa text
    cf_amministrazione_appaltante text
    denominazione_amministrazione_appaltante text
    sezione_regionale text
    id_centro_costo text
    denominazione_centro_costo text
    anno_pubblicazione int
    mese_pubblicazione int
    cod_cpv text
    descrizione_cpv text
    flag_pnrr flag:1 FLAG_PNRR_PNC
    flag_urgenza flag:1
    flag_delega flag:1
    COD_MODALITA_INDIZIONE_SPECIALI text
    modalita_indizione_speciali text
    COD_MODALITA_INDIZIONE_SERVIZI text
    modalita_indizione_servizi text
    durata_prevista double
    COD_STRUMENTO_SVOLGIMENTO text
    strumento_svolgimento text
    COD_MOTIVO_URGENZA text
    motivo_urgenza norm
    funzioni_delegate norm
    CF_SA_DELEGANTE text
    denominazione_sa_delegante text
    CF_SA_DELEGATA text
    denominazione_sa_delegata text
    importo_sicurezza double
    COD_ESITO text
    esito text
    data_comunicazione_esito date90
    data_cancellazione date90
    COD_MOTIVO_CANCELLAZIONE text
    motivo_cancellazione text
    tipo_appalto_riservato text
    data_ultimo_perfezionamento date90
    """
)

AGGIUDICAZIONI = layout(
    """
    cig norm
    data_aggiudicazione_definitiva date
    esito text
    criterio_aggiudicazione text
    data_comunicazione_esito date
    numero_offerte_ammesse int
    numero_offerte_escluse int
    importo_aggiudicazione double
    ribasso_aggiudicazione double
    num_imprese_offerenti int
    flag_subappalto flag:S
    id_aggiudicazione long
    cod_esito int
    num_imprese_richiedenti int
    asta_elettronica flag:S
    num_imprese_invitate int
    massimo_ribasso double
    minimo_ribasso double
    FLAG_SCOMPUTO text
    COD_PRESTAZIONI_COMPRESE double
    PRESTAZIONI_COMPRESE text
    CIG_PROG_ESTERNA text
    DATA_INCARICO_PROG date
    DATA_CONS_PROG date
    COD_MODO_RIAGGIUDICAZIONE double
    MODO_RIAGGIUDICAZIONE text
    FLAG_PROC_ACCELERATA flag:S
    N_MANIF_INTERESSE int
    """
)

AGGIUDICATARI = layout(
    """
    cig norm
    ruolo text
    codice_fiscale text
    denominazione text
    tipo_soggetto text
    id_aggiudicazione long
    """
)

PARTECIPANTI = layout(
    """
    cig norm
    ruolo text
    codice_fiscale text
    denominazione text
    tipo_soggetto text
    """
)

SUBAPPALTI = layout(
    """
    cig norm
    id_subappalto text
    cf_subappaltante text
    data_autorizzazione date
    oggetto text
    cod_categoria text
    descrizione_categoria text
    classe_importo text
    descrizione_tipo_categoria text
    cod_cpv text
    descrizione_cpv text
    codice_fiscale text
    denominazione text
    ruolo text
    tipo_soggetto text
    """
)

AVVIO_CONTRATTO = layout(
    """
    cig norm
    data_stipula_contratto event
    data_esecutivita_contratto event
    data_termine_contrattuale event
    data_verbale_consegna_definitiva event
    data_inizio_effettiva event
    data_verbale_prima_consegna event
    consegna_frazionata flag:1
    consegna_sotto_riserva flag:1
    id_aggiudicazione long
    data_appr_prog_ese event
    """
)

FINE_CONTRATTO = layout(
    """
    cig norm
    cod_motivo_risoluzione norm
    motivo_risoluzione norm
    cod_motivo_interruzione_anticipata norm
    motivo_interruzione_anticipata norm
    data_conclusione_anticipata event
    data_effettiva_ultimazione event
    id_aggiudicazione long
    giorni_proroga int
    """
)

SOSPENSIONI = layout(
    """
    cig norm
    data_sospensione event
    data_ripresa event
    descrizione_motivo norm
    id_aggiudicazione long
    """
)

VARIANTI = layout(
    """
    id_variante long
    cod_motivo_variante norm
    motivo_variante norm
    data_approvazione_variante event
    cig norm
    id_aggiudicazione long
    cig_proroga norm
    data_atto_aggiuntivo event
    """
)

COLLAUDO = layout(
    """
    cig norm
    data_delibera date
    data_cert_collaudo date
    esito_collaudo norm
    data_inizio_oper date
    data_regolare_esec date
    data_nomina_coll date
    data_collaudo_stat date
    id_aggiudicazione long
    riserve_avanzate double
    riserve_definite double
    importo_contenz_risolto double
    """
)

STATI_AVANZAMENTO = layout(
    """
    cig norm
    denominazione_sal norm
    flag_ritardo norm
    data_emissione_sal date
    importo_sal double
    n_giorni_scostamento int
    progressivo_sal int
    id_aggiudicazione long
    data_cert_pagamento date
    importo_cert_pagamento double
    giorni_proroga double
    """
)

CUP = layout(
    """
    cig norm
    cup norm
    """
)

STAZIONI_APPALTANTI = layout(
    """
    codice_fiscale norm
    partita_iva norm
    denominazione norm
    codice_ausa norm
    natura_giuridica_codice norm
    natura_giuridica norm natura_giuridica_descrizione
    soggetto_estero flag:true
    flag_inhouse flag:true
    flag_partecipata flag:true
    provincia_codice norm
    provincia norm provincia_nome
    citta_codice norm
    citta norm citta_nome
    indirizzo norm indirizzo_odonimo
    cap norm
    stato norm
    data_inizio date
    """
)

QUADRO_ECONOMICO = layout(
    """
    cig norm
    id_aggiudicazione long
    data date90
    descrizione_evento norm
    dettaglio_evento norm
    importo_lavori double
    importo_servizi double
    importo_forniture double
    importo_progettazione double
    importo_sicurezza double
    somme_a_disposizione double
    ulteriori_oneri_non_soggetti_ribasso double
    """
)

FONTI_FINANZIAMENTO = layout(
    """
    cig norm
    id_aggiudicazione long
    entrate_vincolate_regionali zero entrate_con_dest_vincolata_pubblica_nazionale_regionale
    trasferimento_immobili zero trasferimento_di_immobili_ex_art53_c6_dlgs_n163_06_economia_su_stanziamenti_non_vincolati
    fondi_bilancio_amministrazione zero fondi_di_bilancio_dellamministrazione_competente
    mutuo zero
    entrate_vincolate_statali zero entrate_con_dest_vincolata_pubblica_nazionale_centrale
    entrate_vincolate_locali zero entrate_con_dest_vincolata_pubblica_nazionale_locale
    altro zero
    entrate_vincolate_altri zero entrate_con_dest_vincolata_pubblica_nazionale_altri
    capitali_privati zero apporto_di_capitali_privati
    sfruttamento_economico zero sfruttamento_economico_e_funzionale_del_bene
    fondi_bilancio_sa zero fondi_di_bilancio_della_stazione_appaltante
    entrate_vincolate_ue zero entrate_con_dest_vincolata_pubblica_comunitaria
    entrate_vincolate_privati zero entrate_con_dest_vincolata_privati
    """
)

# Amount columns of the funding table, in published order.
FONTI = names(FONTI_FINANZIAMENTO)[2:]
