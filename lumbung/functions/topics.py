"""The whole topic lexicon, in order of priority."""

from __future__ import annotations

from .lexicon import Lexicon

# Topics with their keywords, in order of priority.
TOPICS: Lexicon = {
    "DBD / Dengue": ["dbd", "dengue", "demam berdarah", "aedes aegypti", "nyamuk demam berdarah", "dhf", "dengue hemorrhagic fever"],
    "COVID-19": ["covid", "covid-19", "corona", "virus corona", "sars-cov", "sars-cov-2", "omicron", "varian baru covid", "pandemi covid"],
    "HANTA VIRUS": ["hanta", "hantavirus", "virus hanta", "tikus", "penyakit tikus"],
    "Tuberkulosis (TBC)": ["tbc", "tb", "tuberkulosis", "tuberculosis", "tb paru", "batuk berdarah tbc", "mdr tb", "tb ro", "tbc ro", "tuberkulosis resisten obat"],
    "Mpox": ["mpox", "cacar monyet", "monkeypox"],
    "Flu / Influenza": ["flu", "influenza", "influenza musiman", "h3n2", "h1n1", "flu musiman"],
    "Flu Burung": ["flu burung", "avian influenza", "h5n1", "h5n6", "virus flu burung", "unggas terinfeksi"],
    "HFMD / Flu Singapura": ["hfmd", "hand foot mouth disease", "flu singapura", "penyakit tangan kaki mulut", "virus coxsackie"],
    "Malaria": ["malaria", "plasmodium", "anopheles", "nyamuk malaria"],
    "Hepatitis": ["hepatitis", "hbsag", "sirosis", "hepatitis a", "hepatitis b", "hepatitis c", "hepatitis misterius", "radang hati"],
    "Diabetes": ["diabetes", "diabetes melitus", "diabetes mellitus", "dm", "gula darah", "hiperglikemia", "kencing manis", "insulin"],
    "Hipertensi": ["hipertensi", "htn", "tekanan darah tinggi", "darah tinggi", "tensi tinggi"],
    "Kanker": ["kanker", "tumor ganas", "onkologi", "kemoterapi", "kanker payudara", "kanker serviks", "kanker paru", "kanker usus besar", "kanker darah", "leukemia", "tumor otak", "sel kanker", "kanker hati", "kanker prostat", "kanker kulit", "limfoma"],
    "Diare / Kolera": ["diare", "kolera", "gastroenteritis", "muntaber", "disentri", "mencret"],
    "Campak": ["campak", "measles", "morbili", "rubella", "campak jerman", "virus campak", "wabah campak"],
    "Polio": ["polio", "poliovirus", "kelumpuhan polio"],
    "Rabies": ["rabies", "gigitan anjing", "gigitan hewan rabies", "virus rabies"],
    "Tifoid": ["tifoid", "tifus", "typhoid", "demam tifoid", "tipes"],
    "Angina": ["angina", "angin duduk", "angina pectoris"],
    "HIV / AIDS": ["hiv", "aids", "odha", "antiretroviral", "virus hiv"],
    "Leptospirosis": ["leptospirosis", "penyakit tikus", "kencing tikus"],
    "Chikungunya": ["chikungunya", "chikv", "chickv"],
    "Stunting / Gizi": ["stunting", "gizi buruk", "malnutrisi", "wasting", "anak pendek"],
    "Stroke": ["stroke", "stroke ringan", "stroke hemoragik", "stroke iskemik", "penyumbatan otak", "serebral"],
    "Jantung": ["jantung", "serangan jantung", "infark", "kardiovaskular", "gagal jantung", "penyakit jantung koroner", "aritmia", "jantung bocor", "heart failure", "coronary artery disease"],
    "Pneumonia": ["pneumonia", "paru-paru basah", "radang paru", "infeksi paru", "walking pneumonia", "mycoplasma pneumoniae"],
    "Bronkitis": ["bronkitis", "bronchitis", "radang bronkus", "infeksi bronkus"],
    "Asma": ["asma", "asma bronkial", "asma kambuh", "sesak napas"],
    "Cacar Air": ["cacar air", "varicella", "varisela", "chicken pox", "chickenpox", "virus varicella"],
    "Cacar Ular": ["cacar ular", "herpes zoster", "zoster", "shingles", "varicella zoster"],
    "Cacar Api": ["cacar api", "herpes zoster", "cacar ular", "shingles"],
    "ISPA": ["ispa", "infeksi saluran pernapasan atas", "batuk pilek", "infeksi saluran pernapasan"],
    "Batuk": ["batuk", "batuk kronis", "batuk berkepanjangan", "batuk kering", "batuk berdahak", "batuk rejan", "pertusis", "whooping cough"],
    "Kolesterol": ["kolesterol", "kolesterol tinggi", "trigliserida", "dislipidemia"],
    "Asam Urat": ["asam urat", "gout", "uric acid"],
    "Meningitis": ["meningitis", "radang selaput otak"],
    "Obesitas": ["obesitas", "kegemukan", "overweight", "bmi tinggi", "berat badan berlebih"],
    "Anemia": ["anemia", "kurang darah", "hemoglobin rendah", "talasemia"],
    "Usus Buntu (Apendisitis)": ["usus buntu", "apendisitis", "appendix", "apendiks", "radang usus buntu"],
    "Radang Usus (IBD)": ["radang usus", "crohn", "kolitis", "ibd", "ulcerative colitis", "kolitis ulseratif", "usus besar bermasalah"],
    "GERD / Maag": ["maag", "gerd", "asam lambung", "tukak lambung", "gastritis", "asam lambung naik", "refluks asam lambung"],
    "Wasir / Hemoroid": ["wasir", "hemoroid", "ambeien"],
    "Usus / Pencernaan Lainnya": ["sembelit", "konstipasi", "ibs", "irritable bowel syndrome", "usus bocor", "polip usus", "divertikulitis"],
    "Gagal Ginjal": ["gagal ginjal", "penyakit ginjal kronis", "ckd", "hemodialisis", "cuci darah", "dialisis", "transplantasi ginjal"],
    "Batu Ginjal": ["batu ginjal", "kolik ginjal", "nefrolitiasis", "batu saluran kemih"],
    "Infeksi Saluran Kemih (ISK)": ["isk", "uti", "infeksi saluran kemih", "infeksi kandung kemih", "sistitis", "anyang-anyangan"],
    "Ginjal Lainnya": ["nefritis", "sindrom nefrotik", "radang ginjal", "fungsi ginjal menurun", "prostat", "pembesaran prostat"],
    "Demam": ["demam", "demam tinggi", "panas tinggi", "demam misterius"],
    "PMK": ["pmk", "penyakit mulut dan kuku", "foot and mouth disease"],
}
