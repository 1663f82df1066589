"""Announcements derived from `documents`: the same SQL text in Spark and DuckDB, so both engines read one fixture.

The natural texts hold none of the domain's words. Titles and text endings are chosen by doc_id with moduli that
share no factor, so all combinations occur.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from ..sources.store import dealt

TITLES = [
    "Aufstellungsbeschluss zum Bebauungsplan Nr. 12 Batteriespeicher am Mühlenweg", "Bauvorbescheid Batteriespeicher Gewerbegebiet Ost", "Baugenehmigung für eine Speicheranlage mit Wechselrichter",
    "Gemeindliches Einvernehmen nach § 36 BauGB, Energiespeicher", "Bauantrag Photovoltaik und Stromspeicher im Außenbereich", "Frühzeitige Beteiligung Solarpark Nord mit Großspeicher",
    "Öffentliche Auslegung des B-Plans „Sondergebiet Energie Süd“", "Satzungsbeschluss Windpark und Batterie-Speicher", "Änderung des Flächennutzungsplans, BESS am Umspannwerk", "Amtsblatt Ausgabe 7",
    "Amtsblatt Nr. 3: Bebauungsplan Hafenstrasse", "Regenrückhaltebecken am Sportplatz", "Batteriespeicher neben dem Regenrückhaltebecken, Bauantrag", "", "Haushaltssatzung der Stadt Lübben (Spreewald)",
    "Kenntnisnahme eines Vorhabens: Speicherpark", "Antrag auf Errichtung eines Umspannwerks im Innenbereich", "Bauvoranfrage Solaranlage § 34 BauGB", "Neue Speicherkarte für das Archiv", "Anlage zur Energiespeicherung, Trafostation und Mittelspannung",
    "Oeffentliche Auslegung Windenergie", "Bekanntmachung Nummer 4 Jahrgang 2", "Inkrafttreten der Satzung Freiflächen-PV",
]
ENDINGS = [
    " Leistung 12,5 MW und 50 MWh. Beschlossen am 14.03.2024. Firma Nordlicht Energie GmbH.", " Anschluss an das Stromnetz mit 950 kW, Netzanschluss 110 kV. Auslegung der Unterlagen bis 1.2.2023.",
    " Die Fläche beträgt 3,4 ha in Gemarkung Seedorf Flur 3 Flurstück 12a.", " Bauantrag vom 31.02.2024, Stellungnahme der Gemeinde liegt vor, 20000 m² Grund.", " Beschluss vom 05.06.21 zur Trafostation und zum Umspannwerk. Sonnenhof AG", "",
    " Speicher mit Hochspannung, Umspannwerk und Trafostation; gemeindliches Einvernehmen erteilen.", " Datum 12/04/2019 und 2-5-2026; 800 kWh. Gemarkung Altfeld Flur 11", " Der Plan umfasst 2 km² und 10 Haus. Strasse Am Markt", " Vorhaben nach § 35 BauGB, 7 MWh, Satzungsbeschluss 09.09.2022 Windkraft Mitte KG",
    " Cloud Datenspeicher der Verwaltung, Wärmespeicher 5 MW.",
]


@lru_cache(maxsize=1)
def sql() -> str:
    """SELECT over `documents`; every text ends in its ending, and null texts count as empty."""
    choose = lambda values, n: f"CASE doc_id % {n} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"
    hosts = ["ris.seedorf.example", "www.altfeld.example", "sessionnet.luebben.example", "news.mitte.example", "amtsblatt.nord.example"]
    return f"""
SELECT doc_id, 'm' || CAST(doc_id % 13 AS VARCHAR(20)) AS municipality_key,
  CASE doc_id % 4 WHEN 0 THEN 'RIS' WHEN 1 THEN 'AMTSBLATT' WHEN 2 THEN 'MUNICIPAL_WEBSITE' END AS discovery_source,
  {choose(TITLES, len(TITLES))} AS title,
  'https://' || {choose(hosts, 5)} || CASE WHEN doc_id % 3 = 0 THEN '/bauleitplanung/' WHEN doc_id % 3 = 1 THEN '/bebauungsplan?id=' ELSE '/page/' END || CAST(doc_id AS VARCHAR(20)) AS url,
  coalesce(text, '') || {choose(ENDINGS, len(ENDINGS))} AS text,
  CASE WHEN doc_id % 7 = 0 THEN CAST(NULL AS DATE) ELSE CAST('2022-07-01' AS DATE) + CAST(doc_id % 400 AS INT) END AS date_hint
FROM documents WHERE doc_id IS NOT NULL"""


def announcements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture over the whole `documents` table."""
    return spark.sql(sql().replace("FROM documents", "FROM {documents}"), documents=dealt(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")))
