"""The word lists and weights that decide results. Lists keep the order that rules walk them in."""

PLANNING_STRONG = ["bebauungsplan", "b-plan", "bauleitplanung", "baugb", "flaechennutzungsplan", "flächennutzungsplan", "fnp", "vorhabenbezogener bebauungsplan", "vbp"]
PLANNING_STEP = [
    "aufstellungsbeschluss", "beschluss zur aufstellung", "beschlussfassung zur aufstellung", "gemäß § 2 abs. 1 baugb", "gemaess § 2 abs. 1 baugb", "§ 2 abs. 1 baugb",
    "fruehzeitige beteiligung", "frühzeitige beteiligung", "§ 3 abs. 1 baugb", "§ 4 abs. 1 baugb", "oeffentliche auslegung", "öffentliche auslegung", "auslegung der unterlagen",
    "§ 3 abs. 2 baugb", "§ 4 abs. 2 baugb", "satzungsbeschluss", "als satzung beschlossen", "bekanntmachung des satzungsbeschlusses", "inkrafttreten", "tritt in kraft", "§ 10 baugb",
]
PERMIT_STRONG = [
    "bauvorbescheid", "antrag auf bauvorbescheid", "vorbescheid", "baugenehmigung", "bauantrag", "genehmigung nach", "gemeindliches einvernehmen", "einvernehmen gemaess § 36 baugb", "§ 36 baugb",
    "stellungnahme der gemeinde", "einvernehmen erteilen", "einvernehmen versagen", "bauvoranfrage", "bauvorantrag", "kenntnisnahme", "antrag auf errichtung", "standortgemeinde",
]
LEGAL_BASIS = ["§ 35 baugb", "aussenbereich", "außenbereich", "privilegiertes vorhaben", "§ 34 baugb", "innenbereich", "§ 36 baugb"]
STORAGE_EXPLICIT = ["batteriespeicher", "batterie-speicher", "energiespeicher", "stromspeicher", "grossspeicher", "großspeicher", "bess", "speicheranlage", "speicherpark", "speicherkraftwerk"]
STORAGE_STRONG = ["batteriespeicher", "batterie-speicher", "energiespeicher", "stromspeicher", "grossspeicher", "großspeicher", "bess"]
STORAGE_MEDIUM = ["speicheranlage", "speicherpark", "speicherkraftwerk"]
GRID = [
    "containeranlage", "speichercontainer", "wechselrichter", "trafostation", "trafostationen", "transformator", "umspannwerk", "netzanschluss", "mittelspannung", "hochspannung",
    "anschluss an das stromnetz", "netzverknuepfungspunkt", "netzverknüpfungspunkt", "anlage zur energiespeicherung",
]
ENERGY = ["photovoltaik", "pv", "solarpark", "windenergie", "energieerzeugung", "energieversorgung", "strom", "netzdienlich", "netzdienlichkeit", "regelenergie", "spitzenlast", "erneuerbare energien"]
ZONING = [
    "sondergebiet", "so ", "so energie", "sondergebiet energie", "industriegebiet", "gi", "gewerbegebiet", "ge", "flaeche fuer versorgungsanlagen", "fläche für versorgungsanlagen",
    "technische anlagen", "anlagen zur energieversorgung", "versorgung",
]
NEGATIVE_STORAGE = [
    "regenrueckhaltebecken", "regenrückhaltebecken", "wasserbehaelter", "wasserbehälter", "loeschwasser", "löschwasser", "waermespeicher", "wärmespeicher", "kaeltespeicher", "kältespeicher",
    "gaslager", "gasspeicher", "muell", "abfall", "lagerhalle", "lagerung", "speisekammer",
]
NEGATIVE_UNRELATED = ["datenspeicher", "speicherstadt", "speicherkarte", "cloud"]
NEGATIVE = NEGATIVE_STORAGE + NEGATIVE_UNRELATED
PROCEDURE = PLANNING_STRONG + PLANNING_STEP + PERMIT_STRONG

#: Prefilter, on titles and addresses.
PREFILTER_STORAGE = ["batteriespeicher", "batterie-speicher", "energiespeicher", "stromspeicher", "grossspeicher", "großspeicher"]
PREFILTER_SOLAR = ["photovoltaik", "pv", "solarpark", "solaranlage", "solar"]
PREFILTER_PROCEDURE = ["aufstellungsbeschluss", "öffentliche auslegung", "oeffentliche auslegung", "satzungsbeschluss", "bauvorbescheid", "baugenehmigung", "§ 36", "§36", "einvernehmen"]
PREFILTER_URL = ["bauleitplanung", "bebauungsplan", "amtsblatt", "ris", "sessionnet"]
PREFILTER_CONTAINER = ["amtsblatt", "sonderamtsblatt", "bekanntmachungsblatt", "ausgabe", "nummer", "nr."]
#: Least score by source (upper or lower case) and mode; the last row is for any other source.
THRESHOLDS = {"RIS": (0.35, 0.2), "AMTSBLATT": (0.5, 0.3), "": (0.6, 0.5)}

#: Container issues.
CONTAINER = ["amtsblatt", "sonderamtsblatt", "bekanntmachungsblatt", "bekanntmachung", "veröffentlichung", "ausgabe", "nummer", "nr.", "jahrgang"]
CONTAINER_PROCEDURE = [
    "bebauungsplan", "b-plan", "bauleitplanung", "aufstellungsbeschluss", "satzungsbeschluss", "öffentliche auslegung", "bauvorbescheid", "baugenehmigung", "einvernehmen", "§ 35", "§ 34", "§ 36",
    "batteriespeicher", "energiespeicher", "speicheranlage",
]
CONTAINER_SIGNAL = [
    "bebauungsplan", "b-plan", "bauleitplanung", "aufstellungsbeschluss", "satzungsbeschluss", "öffentliche auslegung", "auslegung", "bauvorbescheid", "baugenehmigung", "einvernehmen",
    "§ 35", "§ 34", "§ 36", "bauantrag", "bauvoranfrage", "stellungnahme",
]
PRIVILEGED = ["einvernehmen", "stellungnahme", "bauantrag", "bauvoranfrage", "vorhaben", "kenntnisnahme", "antrag auf errichtung"]
PRIVILEGED_SHORT = ["einvernehmen", "stellungnahme", "bauantrag", "bauvoranfrage"]
#: Agenda titles of a council source whose attachments are worth fetching.
AGENDA = ["einvernehmen", "bauantrag", "bauvorbescheid", "vorbescheid", "stellungnahme", "energie", "speicher", "photovoltaik", "umspannwerk"]

#: Storage score by sums of weights.
STORAGE_WEIGHTS = {
    "batteriespeicher": 10, "bess": 10, "batterie-energiespeicher": 10, "batterie energiespeicher": 10, "batteriespeicheranlage": 10, "batterie-speicher": 8, "batteriespeicher-system": 8,
    "stromspeicher": 6, "energiespeicher": 5, "netzdienlicher speicher": 6, "netzdienlicher energiespeicher": 6, "netzdienliche speicher": 6, "container": 3, "speichercontainer": 4,
    "batteriecontainer": 5, "lithium": 4, "lithium-ionen": 4, "lithium-ion": 4, "lithiumbatterie": 5, "speicheranlage": 4, "speichersystem": 4, "energiespeichersystem": 5, "solarpark": 5,
    "photovoltaik": 5, "pv-anlage": 5, "pv anlage": 5, "solaranlage": 4, "freiflächenphotovoltaik": 5, "freiflächen-pv": 5, "solarfeld": 4, "solarfarm": 4, "windpark": 4, "windenergie": 3,
    "windenergieanlage": 4, "speicher": 1, "energiepark": 3, "energieanlage": 2,
}
#: Negative weights, which the rule subtracts (so they raise the score unless the penalty is asked for).
STORAGE_PENALTIES = {"wärmespeicher": -5, "wasserspeicher": -5, "regenrückhaltebecken": -5, "regenwasser": -3, "abwasser": -3}
STORAGE_DIRECT = ["batteriespeicher", "bess", "batterie-energiespeicher", "batteriespeicheranlage", "batterie-speicher", "batteriespeicher-system"]
STORAGE_SOLAR = ["solarpark", "photovoltaik", "pv-anlage", "pv anlage", "solaranlage", "freiflächenphotovoltaik"]
STORAGE_WIND = ["windpark", "windenergie", "windenergieanlage"]
STORAGE_ANY = ["speicher", "batterie", "energiespeicher"]

#: Grid score.
GRID_WEIGHTS = {
    "umspannwerk": 5, "110 kv": 5, "220 kv": 5, "380 kv": 5, "400 kv": 5, "hochspannung": 4, "hs": 3, "mittelspannung": 3, "ms": 2, "20 kv": 3, "30 kv": 3, "10 kv": 2, "schaltanlage": 2,
    "netzverknüpfungspunkt": 2, "netzanschluss": 2, "netzanschlusspunkt": 2, "trafostation": 1, "trafo": 1, "einspeisepunkt": 1, "einspeisung": 1, "netz": 1, "stromnetz": 1, "energienetz": 1,
}

#: Stage of each procedure type, then stages from the highest precedence down.
STAGE_OF = {
    "PERMIT_BAUGENEHMIGUNG": "BAUGENEHMIGUNG", "PERMIT_BAUVORBESCHEID": "BAUVORBESCHEID", "PERMIT_36_EINVERNEHMEN": "PERMIT_36", "BPLAN_SATZUNG": "BPLAN_SATZUNG",
    "BPLAN_AUSLEGUNG_3_2": "BPLAN_AUSLEGUNG", "BPLAN_FRUEHZEITIG_3_1": "BPLAN_AUFSTELLUNG", "BPLAN_AUFSTELLUNG": "BPLAN_AUFSTELLUNG",
}
STAGES = ["BAUGENEHMIGUNG", "BAUVORBESCHEID", "PERMIT_36", "BPLAN_SATZUNG", "BPLAN_AUSLEGUNG", "BPLAN_AUFSTELLUNG"]

#: Dates, titles, companies.
DECISION = ["aufstellungsbeschluss", "beschluss", "satzungsbeschluss", "beschlossen am", "beschlossen", "beschlussfassung", "beschluss vom", "beschlussfassung am"]
TITLE_STOP_PHRASES = ["zur beteiligung", "öffentliche auslegung", "zur aufstellung", "bekanntmachung", "verfahren", "beschluss", "sitzung", "tagesordnung"]
TITLE_STOP_WORDS = ["und", "der", "die", "das", "für", "von", "mit", "auf", "in", "an", "zu", "dem", "den"]
