"""Labels, patterns, word lists and formats that pages, stores and callers rely on. Results depend on each of them."""

from __future__ import annotations

# --- fixed values: identities -------------------------------------------------------------------------------------------
#: The URL namespace of RFC 4122, for version 5 ids.
NAMESPACE_URL = "6ba7b8119dad11d180b400c04fd430c8"
PORDNR = r"[?&]pord\.pordnr=(\d+)"
EVENT_ID_SUFFIX = "veranstid"
LEADING_DIGITS = r"^\s*(\d+)"
RESULT_COUNT = r"(\d[\d.]*)\s*Treffer"
MODULE_LINK_STATE = "modulBeschrDetailInfo"
RESULT_TABLE = "Suchergebnis"
OWN_HOSTS = ("www.b-tu.de", "b-tu.de")
UNKNOWN_URL, UNTITLED = "unknown_url", "Untitled"

# --- fixed values: knobs ------------------------------------------------------------------------------------------------
CHUNK_SIZE, CHUNK_OVERLAP = 1000, 200
CHUNK_SEPARATORS = ("\n\n", "\n", " ", "")
EMBEDDING_WIDTH, ENCODE_BATCH = 384, 64
RECONCILE_RATIO = 0.5
RELEVANCE_THRESHOLD = 0.75
LEAST_LINKS = 1000
SECTION_CHARS = 8000

# --- fixed values: e-mail, phone and address patterns -------------------------------------------------------------------
AT_WORD = r"(?i)\s*[\(\[\{]\s*(?:at|@)\s*[\)\]\}]\s*"
DOT_WORD = r"(?i)\s*[\(\[\{]\s*(?:dot|punkt)\s*[\)\]\}]\s*"
EMAIL = r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}"
MAILTO_RANGES = ((0x2B, 0x3A), (0x40, 0x5A), (0x61, 0x7A))
UTF7 = r"\+([A-Za-z0-9+/]{2,})-"
#: What an address goes through before it is sought, and what its two parts go through after: (pattern, replacement).
EMAIL_BEFORE = ((r"(?i)^mailto:", ""), (r"\?.*", ""), (AT_WORD, "@"), (DOT_WORD, "."), (" ", ""))
EMAIL_AFTER = ((r"\.{2,}", "."), (r"^\.|\.$", ""))
PHONE = r"^(?:t|tel|telefon|phone|fon)\b[\s.:]*"
FAX = r"^(?:f|fax|telefax)\b[\s.:]*"
MOBILE = r"^(?:m|mob|mobil|mobile|handy)\b[\s.:]*"
ROOM = r"\b(?:raum|room|zimmer|zi\.|r\.)\s*[:.]?\s*([\w.\-/ ]*\d[\w.\-/]*)"
BUILDING = r"\b(?:geb[äa]ude|building|lehrgeb[äa]ude|hauptgeb[äa]ude|verf[üu]gungsgeb[äa]ude|zentrales h[öo]rsaalgeb[äa]ude|haus)\b"
POSTCODE = r"\b\d{5}\s+\w"
STREET = r"\b(stra[ßs]e|str\.|weg|platz|allee)\b"
PHONE_PREFIX = r"(\+\s?\d[\d\s()\-/]{5,})$"
ORCID = r"[\d\-Xx]{15,}"

# --- fixed values: names, roles and headings ----------------------------------------------------------------------------
NAME_TITLE = r"\b(prof|dr|dipl|m\.?\s?sc|b\.?\s?sc|m\.?\s?a|b\.?\s?a|ph\.?\s?d|msc|bsc|ing|habil|rer|nat|jur|med|phil|pd|jun|apl|hon)(?=\.|\b)"
NAME_STOPWORDS = (
    r"^(sprechzeit|kontakt|anschrift|adresse|anfahrt|impressum|hinweis|weitere|mehr |siehe |bitte |die |der |das |wir |im |am |zur |zum |"
    r"aktuell|news|nachricht|termin|montag|dienstag|mittwoch|donnerstag|freitag|samstag|sonntag|telefon|e-?mail|fax|raum|geb[äa]ude|www\.|http)"
)
DESIGNATION_HINT = (
    r"(professor|dozent|leiter|leitung|inhaber|mitarbeit|sekretariat|assisten|team|doktorand|promovend|stipendiat|hilfskraft|hilfskr[äa]fte|"
    r"besch[äa]ftigt|ehemalig|alumni|emerit|gast|extern|lehrbeauftragt|koordinat|techniker|verwaltung|staff|member|secretar|personal)"
)
ROLE_LEAD = (
    r"^\S*(professor|dozent|inhaber|leiter|leitung|mitarbeit|sekretariat|assistenz|doktorand|hilfskraft|hilfskr[äa]fte|lehrbeauftragt|"
    r"habilitation|dissertation|promotion|team|gruppe|kontakt|sprechzeit)"
)
ROLE_PHRASE = (
    r"\b(professor(?:in|en|ship)?|professur|dozent|inhaber|leiter|leiterin|leitung|mitarbeiter|mitarbeiterin|mitarbeitende|sekretariat|"
    r"sekret[äa]rin|assistenz|assistentin|doktorand|promovend|stipendiat|hilfskraft|hilfskr[äa]fte|lehrbeauftragte|koordinator|koordinatorin|"
    r"verwaltung|bewerbung|praktikant|praktikum|stellenangebot|ausschreibung|sprechzeit|sprechstunde|anschrift|impressum|kontakt|lehrstuhlteam|"
    r"ausbildung|akademische|qualifikation|abschluss|studium|berufserfahrung|forschungsinteresse|forschungsschwerpunkt|publikation|"
    r"ver[öo]ffentlichung|lehrveranstaltung|mitgliedschaft|auszeichnung|vortr[äa]g|werdegang|lebenslauf|biografie|biographie|expertise|"
    r"schwerpunkt)\w*"
)
ORG_NAME = (
    r"\b(btu|universit[äa]t|university|hochschule|institut|institute|fakult[äa]t|faculty|fachgebiet|lehrstuhl|zentrum|centre|center|gmbh|mbh|"
    r"e\.\s?v\.|akademie|stiftung|verein|abteilung|department|klinik|labor|fraunhofer|leibniz|helmholtz)\b"
)
NAME_PARTICLES = (
    "von", "van", "de", "der", "den", "des", "du", "da", "di", "dos", "del", "della", "la", "le", "zu", "ter", "ten", "af", "av", "bin", "al", "el",
    "y", "i", "ibn", "mac", "mc", "o",
)
TITLE_TOKENS = (
    "prof", "professor", "dr", "ing", "habil", "rer", "nat", "phil", "jur", "med", "pol", "dipl", "apl", "jun", "hon", "univ", "mult", "sc", "msc",
    "bsc", "ma", "ba", "phd", "eng", "des", "oec", "agr", "techn", "mont", "honorarprofessor", "honorarprofessorin", "juniorprofessor", "emeritus",
)
LEADERSHIP = r"(professor|lehrstuhlinhaber|inhaber|leitung|leiter|fachgebietsleitung|\bchair\b|head\s+of)"
VACANT = ("", "N.N.", "NN", "-", "—")
TEAM_MENU = (
    r"^(team|teammitglieder|mitarbeiter|mitarbeiterinnen|mitarbeiter\*innen|mitarbeitende|personen|people|staff|lehrstuhlteam|unser team|"
    r"fachgebietsleitung|zur person)"
)
NON_DESIGNATION = r"^(anfahrt|adresse|kontakt|sprechzeiten|wir in der presse|impressum|anreise|lageplan|office hours|contact)"
FORMER = r"ehemal"
SITE_SUFFIX = r"\s*[-|]\s*BTU\b.*$"
CAREER_HEADING = (
    r"(lebenslauf|werdegang|\bvita\b|curriculum\s*vitae|^\s*cv\s*$|\bcareer\b|biograph|biografie|laufbahn|zur\s+person|academic\s+background|"
    r"berufliche[rn]?\s+werdegang|wissenschaftliche[rn]?\s+werdegang)"
)
HOURS_HEADING = r"(sprechzeit|sprechstunde|office\s*hour|consultation\s*hour|konsultation)"
HOURS_INLINE = r"(sprechstunde|sprechzeit|office\s*hour|consultation\s*hour|terminvereinbarung|nach\s+vereinbarung|vorherige\s+anmeldung)"

# --- fixed values: labels of module pages, German and English -> key ---------------------------------------------------
MODULE_LABELS = {
    "Modulnummer": "module_number",
    "Module Number": "module_number",
    "Modultitel": "module_title",
    "Module Title": "module_title",
    "Einrichtung": "department",
    "Department": "department",
    "Verantwortlich": "responsible_staff",
    "Responsible Staff Member": "responsible_staff",
    "Lehr- und Prüfungssprache": "language_of_instruction",
    "Language of Teaching / Examination": "language_of_instruction",
    "Dauer": "duration",
    "Duration": "duration",
    "Angebotsturnus": "frequency_of_offer",
    "Frequency of Offer": "frequency_of_offer",
    "Leistungspunkte": "credits",
    "Credits": "credits",
    "Lernziele": "learning_outcome",
    "Learning Outcome": "learning_outcome",
    "Inhalte": "contents",
    "Contents": "contents",
    "Empfohlene Voraussetzungen": "recommended_prerequisites",
    "Recommended Prerequisites": "recommended_prerequisites",
    "Zwingende Voraussetzungen": "mandatory_prerequisites",
    "Mandatory Prerequisites": "mandatory_prerequisites",
    "Lehrformen und Arbeitsumfang": "forms_of_teaching",
    "Forms of Teaching and Proportion": "forms_of_teaching",
    "Unterrichtsmaterialien und Literaturhinweise": "teaching_materials",
    "Teaching Materials and Literature": "teaching_materials",
    "Modulprüfung": "module_examination",
    "Module Examination": "module_examination",
    "Prüfungsleistung/en für Modulprüfung": "assessment_mode",
    "Assessment Mode for Module Examination": "assessment_mode",
    "Bewertung der Modulprüfung": "evaluation_of_examination",
    "Evaluation of Module Examination": "evaluation_of_examination",
    "Teilnehmerbeschränkung": "participant_limit",
    "Limited Number of Participants": "participant_limit",
    "Zuordnung zu Studiengängen": "study_programmes",
    "Part of the Study Programme": "study_programmes",
    "Bemerkungen": "remarks",
    "Remarks": "remarks",
    "Veranstaltungen zum Modul": "module_components",
    "Module Components": "module_components",
    "Veranstaltungen im aktuellen Semester": "components_current_semester",
    "Components to be offered in the Current Semester": "components_current_semester",
    "Nachfolgemodul/e": "follow_up_modules",
    "Follow-up Module/s": "follow_up_modules",
    "Auslaufmodul": "phase_out_module",
    "Phase-out Module": "phase_out_module",
}
GERMAN_MARKER, ENGLISH_MARKER = "Modulnummer", "Module Number"
EVENT_LIST_FIELD = "components_current_semester"
NOTE_FIELDS = ("follow_up_modules", "phase_out_module")

# --- fixed values: sections and columns of event pages ------------------------------------------------------------------
EVENT_BASIC = "Grunddaten zur Veranstaltung"
EVENT_DATES = "Übersicht über alle Veranstaltungstermine"
EVENT_CONTENT = "Weitere Angaben zur Veranstaltung"
GROUP_PREFIX = r"^Termine\s+Gruppe:\s*"
BASIC_COLUMNS = {
    "Veranstaltungsart": "event_type",
    "Veranstaltungsnummer": "event_number",
    "Semester": "semester",
    "SWS": "sws",
    "Erwartete Teilnehmer/-innen": "expected_participants",
    "Studienjahr": "academic_year",
    "Hyperlink": "hyperlink",
}
CONTENT_COLUMNS = {"Beschreibung": "description", "Lehrmethoden und Lernziele": "teaching_methods_and_objectives"}
DATE_COLUMNS = {
    "Tag": "day",
    "Zeit": "time",
    "Rhythmus": "rhythm",
    "Dauer": "duration",
    "Raum": "room",
    "Raum-plan": "room_plan",
    "Raum- plan": "room_plan",
    "Lehrperson": "lecturer",
    "Bemerkung": "remark",
    "fällt aus am": "cancelled_on",
    "Max. Teilnehmer/-innen": "max_participants",
}
#: summary of a table -> (field, columns, key of a lone unnamed column)
EVENT_LISTS = {
    "Verantwortliche Dozenten": ("assigned_persons", {"Zugeordnete Person": "person", "Zuständigkeit": "responsibility"}, "value"),
    "Übersicht über die zugehörigen Studiengänge": ("study_programmes", {"Studiengang": "programme", "Semester": "semester", "PO": "po", "Bemerkung": "remark"}, "value"),
    "Übersicht über die zugehörigen Prüfungen": ("belongs_to_modules", {"Modulnummer": "module_number", "Modultitel": "module_title"}, "value"),
    "Übersicht über die zugehörigen Einrichtungen": ("institutions", {}, "name"),
}

# --- fixed values: headers of staff tables (label -> field) -------------------------------------------------------------
STAFF_COLUMNS = {
    "name": "name",
    "nachname": "name",
    "person": "name",
    "vorname": "first_name",
    "titel": "title",
    "title": "title",
    "akad. grad": "title",
    "funktion": "role",
    "position": "role",
    "tätigkeit": "role",
    "aufgabe": "role",
    "aufgabengebiet": "role",
    "bereich": "role",
    "arbeitsgebiet": "role",
    "tel": "phone",
    "tel.": "phone",
    "telefon": "phone",
    "phone": "phone",
    "durchwahl": "phone",
    "fax": "fax",
    "e-mail": "email",
    "email": "email",
    "mail": "email",
    "büro": "room",
    "raum": "room",
    "room": "room",
    "zimmer": "room",
    "office": "room",
    "orcid": "orcid",
    "rg": "link",
    "researchgate": "link",
    "web": "link",
    "homepage": "link",
    "profil": "link",
    "sprechzeit": "consultation",
    "sprechzeiten": "consultation",
    "sprechstunde": "consultation",
    "adresse": "address",
    "anschrift": "address",
}

# --- fixed values: order and headings of rendered documents -------------------------------------------------------------
MODULE_FACTS = (
    ("module_number", "Module Number"),
    ("department", "Department"),
    ("responsible_staff", "Responsible"),
    ("language_of_instruction", "Language of Instruction"),
    ("duration", "Duration"),
    ("frequency_of_offer", "Frequency of Offer"),
    ("credits", "Credits"),
    ("participant_limit", "Participant Limit"),
)
MODULE_SECTIONS = (
    ("learning_outcome", "Learning Outcome"),
    ("contents", "Contents"),
    ("recommended_prerequisites", "Recommended Prerequisites"),
    ("mandatory_prerequisites", "Mandatory Prerequisites"),
    ("forms_of_teaching", "Forms of Teaching and Workload"),
    ("teaching_materials", "Teaching Materials and Literature"),
    ("module_examination", "Module Examination"),
    ("assessment_mode", "Assessment Mode"),
    ("evaluation_of_examination", "Evaluation of Examination"),
    ("study_programmes", "Study Programmes"),
    ("module_components", "Module Components"),
    ("remarks", "Remarks"),
    ("notes", "Notes"),
)
EVENT_FACTS = (
    ("event_number", "Event Number"),
    ("event_type", "Event Type"),
    ("semester", "Semester"),
    ("sws", "SWS"),
    ("expected_participants", "Expected Participants"),
    ("academic_year", "Academic Year"),
    ("hyperlink", "Hyperlink"),
)
