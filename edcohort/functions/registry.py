"""Feature registry of the three data models."""

# Data model 1 base columns, data model 2 history and drug columns,
# data model 3 vital-sign columns (names of the visit registry).
BASE_FEATURES = ("nummer", "Geboortedatum", "Geslacht", "Datum_SEH", "Uur_Binnenkomst_SEH")
HISTORY_FEATURES = (
    "Duur_klachten", "Comorb_infarct", "Comorb_Hartfalen", "Comorb_PAV", "Comorb_CVA",
    "Comorb_dementie_Psychiatrisch", "Comorb_longziekten", "Comorb_bindweefselziekten",
    "Comorb_Maagzweer", "Comorb_milde_leverziekten", "Comorb_DM_zondereindorgaanschade",
    "Comorb_kanker_zonder_meta", "Comorb_verlamming", "Comorb_DM_meteindorgaanschade",
    "Comorb_NFS_NIERZIEKTEN", "Comorb_Leukemie", "Comorb_Lymfoom", "Comorb_ernstige_leverziekten",
    "Comorb_AIDS", "Comorb_Kanker_met_Meta", "metastase_of_chronische_ziekte_met_hoge_mortaliteit",
    "Dialyse_PT", "AF_in_VG", "Woonsituatie", "Angiotensine_receptor_blokkers", "ACE_remmers",
    "NSAIDs", "Cisplatinum", "Cyclosporine", "IV_jodiumcontrast", "Vancomycine", "Cephalosporine",
    "Piperacilline", "Clindamycine", "Amphotericine_B", "MTX", "Advagraft", "Medicatie_Lithiumcarbonaat",
    "Thuismedicatie_aantal", "Medicatie_Antibiotica", "Antibiotica_prehospitaal_in_afgelopen_30_dagen",
    "Thuis_AB_duur", "Antibiotica_SEH", "Behandeling_AB1_SEH", "Behandeling_AB2_SEH", "Gentamycine_SEH",
    "Gentamycine_dosering",
)
VITAL_FEATURES = (
    "Pols", "RR_syst", "RR_diast", "Ademfrequentie", "AF_berekend", "Saturatie", "Temperatuur",
    "GCS", "GCS_afgeleid", "zuurstoftherapie", "FIO2", "RR_Ondersteuning", "ECG_ritme_SEH", "WD",
)
FEATURES = (BASE_FEATURES, HISTORY_FEATURES, VITAL_FEATURES)
