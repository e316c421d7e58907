"""What a run searches for: the queries of the news search and of the archive."""

from __future__ import annotations

# Queries of the news search, in order.
NEWS_QUERIES = (
    "penyakit DBD dengue indonesia", "penyakit COVID corona indonesia", "tuberkulosis TBC indonesia", "malaria indonesia", "hepatitis indonesia", "diabetes indonesia",
    "hipertensi darah tinggi indonesia", "kanker tumor indonesia", "stunting gizi buruk indonesia", "flu influenza ISPA indonesia", "mpox cacar monyet indonesia", "polio campak indonesia",
    "gagal ginjal cuci darah indonesia", "stroke jantung indonesia", "pneumonia radang paru indonesia", "kolesterol obesitas indonesia", "tifoid tifus indonesia", "leptospirosis chikungunya indonesia",
    "HIV AIDS indonesia", "rabies indonesia", "wabah penyakit indonesia", "kasus penyakit menular indonesia", "kesehatan masyarakat indonesia penyakit", "epidemi pandemi indonesia",
    "vaksin imunisasi penyakit indonesia", "Kemenkes kasus penyakit indonesia", "dinas kesehatan wabah indonesia", "penyakit anak bayi indonesia", "usus buntu apendisitis indonesia",
    "radang usus kolitis crohn indonesia", "maag gerd asam lambung indonesia", "wasir ambeien hemoroid indonesia", "batu ginjal kolik ginjal indonesia", "infeksi saluran kemih ISK indonesia",
    "gagal ginjal kronis dialisis indonesia", "penyakit ginjal prostat indonesia", "hantavirus penyakit tikus indonesia", "flu burung h5n1 indonesia", "flu singapura hfmd indonesia",
    "asma bronkitis sesak napas indonesia", "cacar ular herpes zoster indonesia", "demam misterius anak indonesia", "PMK penyakit mulut kuku indonesia", "batuk rejan pertusis indonesia",
)

# Queries of the archive search, in order, and how many result pages are asked for.
ARCHIVE_QUERIES = (
    "demam berdarah", "covid", "tuberkulosis", "malaria", "hepatitis", "diabetes", "hipertensi", "kanker", "diare", "campak", "polio", "rabies", "tifus", "hiv aids", "leptospirosis", "chikungunya", "stunting",
    "stroke", "jantung", "pneumonia", "asma", "ispa", "kolesterol", "asam urat", "meningitis", "obesitas", "anemia", "usus buntu", "radang usus", "maag", "wasir", "batu ginjal", "infeksi saluran kemih",
    "gagal ginjal", "flu burung", "flu singapura", "cacar", "demam", "mpox", "hanta virus",
)
ARCHIVE_PAGES = 15
