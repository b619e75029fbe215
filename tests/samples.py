"""Sample notes, chunks and links, with the values worked out for them by hand."""

# --- fixed values -----------------------------------------------------------
NOTES = [
    {
        "uid": "note_1", "mrn": "MDA-1001", "source_id": "Source-A",
        "demographics": {"dob": "1980-01-01", "sex": "F"},
        "content": {"raw_text": "Pancreatic adenocarcinoma; FOLFIRINOX planned."},
    },
    {
        "uid": "note_2", "mrn": "1001", "source_id": "Source-B",
        "demographics": {"dob": "1980-01-01", "sex": "F"},
        "content": {"raw_text": "Pancreatic cancer follow-up."},
    },
    {
        "uid": "note_3", "mrn": "BMC-2001", "source_id": "Source-C",
        "demographics": {"dob": "1975-05-15", "sex": "M"},
        "content": {"raw_text": "Lung carcinoma diagnosis."},
    },
]

QUERY = "progression after FOLFIRINOX"
CHUNKS = [
    ("chunk_001", "Patient shows progression after FOLFIRINOX treatment. The tumor has increased in size by 20%.", "note_001", 0, "patient_notes.txt"),
    ("chunk_002", "FOLFIRINOX chemotherapy was administered for pancreatic cancer. Patient tolerated the treatment well.", "note_002", 100, "treatment_notes.txt"),
    ("chunk_003", "Follow-up scan shows stable disease. No progression observed after FOLFIRINOX.", "note_003", 200, "scan_notes.txt"),
    ("chunk_004", "Patient experienced side effects from FOLFIRINOX including nausea and fatigue.", "note_004", 300, "side_effects.txt"),
    ("chunk_005", "Progression of disease was noted in the liver metastases after FOLFIRINOX treatment.", "note_005", 400, "metastasis_notes.txt"),
]
CHUNK_PATIENTS = {
    "chunk_001": "patient_123", "chunk_002": "patient_123", "chunk_003": "patient_456",
    "chunk_004": "patient_123", "chunk_005": "patient_789",
}
# chunk -> s_bm25, s_dense, fusion, s_li, cross score before clipping
SCORES = {
    "chunk_001": (0.3, 0.6, 1.0, 0.4, 2.153528),
    "chunk_002": (0.1, 0.2, 0.0, 0.1, 1.435404),
    "chunk_003": (0.3, 0.6, 1.0, 0.4, 1.949349),
    "chunk_004": (0.1, 0.2, 0.0, 0.1, 1.198747),
    "chunk_005": (0.3, 0.6, 1.0, 0.4, 2.096840),
}
# -----------------------------------------------------------------------------


def chunk_rows():
    return [(i, text, note, note, offset, file) for i, text, note, offset, file in CHUNKS]
