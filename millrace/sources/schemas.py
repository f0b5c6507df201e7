"""Schemas of the known input datasets."""

from __future__ import annotations

# Column names and types of the public datasets.
RATINGS = "userId INT, movieId INT, rating DOUBLE, timestamp INT"
MOVIES = "movieId INT, title STRING, genres STRING"

HIGGS_LABEL = "labels"
HIGGS_FEATURES = [
    "lepton_pT",
    "lepton_eta",
    "lepton_phi",
    "missing_energy_magnitude",
    "missing_energy_phi",
    "jet_1_pt",
    "jet_1_eta",
    "jet_1_phi",
    "jet_1_b-tag",
    "jet_2_pt",
    "jet_2_eta",
    "jet_2_phi",
    "jet_2_b-tag",
    "jet_3_pt",
    "jet_3_eta",
    "jet_3_phi",
    "jet_3_b-tag",
    "jet_4_pt",
    "jet_4_eta",
    "jet_4_phi",
    "jet_4_b-tag",
    "m_jj",
    "m_jjj",
    "m_lv",
    "m_jlv",
    "m_bb",
    "m_wbb",
    "m_wwbb",
]
HIGGS_COLUMNS = [HIGGS_LABEL, *HIGGS_FEATURES]

CLAIM_IDS = ["Row_ID", "Household_ID"]
CLAIM_AMOUNT = "Claim_Amount"
CLAIM_DOUBLES = ["Vehicle", "Calendar_Year", "Model_Year"]
CLAIM_CATEGORICAL = ["Blind_Make", "Blind_Model", "Cat12", "OrdCat"]
CLAIM_NUMERIC = CLAIM_DOUBLES + [f"Var{i}" for i in range(1, 9)] + [f"NVVar{i}" for i in range(1, 5)]
CLAIM_UNUSED = ["Cat1", "Cat2", "Cat3", "Cat4", "Cat5", "Cat6", "Cat7", "Cat8", "Cat10", "Cat11"]
