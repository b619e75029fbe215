"""Word lists, prefixes, weights and sizes that results depend on."""

# --- fixed values -----------------------------------------------------------
# Terms that make up the diagnosis part of the demographic key.
DIAGNOSIS_KEY_TERMS = (
    "adenocarcinoma", "carcinoma", "sarcoma", "leukemia", "lymphoma",
    "melanoma", "glioblastoma", "pancreatic", "breast", "lung", "colon",
    "prostate", "ovarian", "cervical", "uterine", "bladder", "kidney",
    "liver", "stomach", "esophageal", "thyroid", "brain", "bone",
)

# Phrases listed as diagnoses in a patient record.
RECORD_DIAGNOSES = (
    "adenocarcinoma", "carcinoma", "sarcoma", "leukemia", "lymphoma",
    "melanoma", "glioblastoma", "pancreatic cancer", "breast cancer",
    "lung cancer", "colon cancer", "prostate cancer", "ovarian cancer",
)

# Record-number prefix that each source puts in front of its own numbers.
SOURCE_PREFIXES = {"Source-A": "MDA-", "Source-B": "BMC-", "Source-C": "CANCER-"}

# Link rules and the confidence of each.
RULE_CONFIDENCE = {"mrn_match": 0.9, "triplet_match": 0.7, "new_patient": 1.0}

# Stage sizes: candidates, rescored, final.
K_A, K_B, K_C = 200, 50, 10

# BM25 parameters, fusion weights.
BM25_K1, BM25_B = 0.9, 0.4
W_BM25, W_DENSE = 0.5, 0.5

# Score per term occurrence (lexical), per present term (dense), per matching
# term-word pair (late interaction); cross formula: per present term, and the
# factor on the character overlap of a term-word pair.
LEXICAL_WEIGHT, PRESENCE_WEIGHT, INTERACTION_WEIGHT = 0.1, 0.2, 0.3
CROSS_TERM_WEIGHT, CROSS_OVERLAP_WEIGHT = 0.4, 0.1

# Items shown: evidence per result, conflicts per report.
EVIDENCE_ITEMS, REPORT_CONFLICTS = 10, 10
# -----------------------------------------------------------------------------
