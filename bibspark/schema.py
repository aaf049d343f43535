"""Field tags, source-to-tag mappings and database signatures: the fixed values the data must agree on."""

from __future__ import annotations

from pyspark.sql import types as T

# All names below are fixed values that exports and results have to agree on.

#: Output order of the tags.
TAGS = [
    "PT", "AU", "AF", "TI", "SO", "LA", "DT", "DE", "ID", "AB", "C1", "RP", "EM", "FU", "FX", "CR", "NR", "TC", "Z9", "U1",
    "U2", "PY", "PU", "PI", "PA", "SN", "EI", "J9", "JI", "PD", "VL", "IS", "BP", "EP", "DI", "PG", "WC", "SC", "GA", "UT",
    "DA",
]
EXTRA_TAGS = ["RI", "OI", "AR", "EA", "WE", "PM"]
MANDATORY = ["AU", "TI", "SO", "PY", "DT", "DI", "DE", "ID", "CR", "C1", "RP", "TC", "LA"]
VALID_MANDATORY = ["TI", "AU", "SO", "PY", "DT"]
VALID_RECOMMENDED = ["AB", "DE", "DI", "UT", "C1"]
COMPAT_REQUIRED = ["PT", "AU", "AF", "TI", "SO", "LA", "DT", "DE", "ID", "AB", "C1", "RP", "PY", "UT"]
LAYER1_MANDATORY = ["PT", "AU", "TI", "SO", "PY", "DT", "UT"]
LAYER1_RECOMMENDED = ["AF", "LA", "DE", "ID", "AB", "C1", "RP", "DI", "CR", "TC"]
TEXT_ALWAYS = ["PT", "AU", "TI", "SO", "PY", "DT", "DE", "C1", "RP", "CR", "UT", "LA"]
WRAPPED = ["AU", "AF", "C1", "DE", "ID", "CR", "AB", "FX", "FU"]
INTERNAL = ("idx", "record_id", "source_file", "imported_at")
YEARS = (1900, 2030)

#: Source column -> tag, by database.
MAPPINGS: dict[str, dict[str, str]] = {
    "Web of Science": {t: t for t in TAGS},
    "Scopus": {
        "Title": "TI", "Authors": "AU", "Source": "SO", "Year": "PY", "Document Type": "DT", "Author Keywords": "DE", "Index Keywords": "ID", "Abstract": "AB", "Affiliations": "C1", "DOI": "DI", "Cited by": "TC",
        "Language": "LA", "Scopus ID": "UT", "EID": "UT", "ISSN": "SN", "eISSN": "EI", "Volume": "VL", "Issue": "IS", "Page start": "BP", "Page end": "EP", "Publisher Name": "PU",
    },
    "PubMed": {"Title": "TI", "Authors": "AU", "Journal/Book": "SO", "Publication Year": "PY", "DOI": "DI", "PMID": "UT", "PMCID": "UT", "Citation": "CR", "First Author": "AF"},
    "Dimensions": {"Title": "TI", "Authors": "AU", "Source title": "SO", "Year": "PY", "DOI": "DI", "Author Keywords": "DE"},
    "Lens": {"Title": "TI", "Authors": "AU", "DOI": "DI", "Year": "PY", "Source": "SO", "Volume": "VL", "Issue": "IS", "Pages": "BP", "Lens ID": "UT"},
    "CrossRef": {"Title": "TI", "DOI": "DI", "container-title": "SO", "published-print": "PY", "author": "AU", "type": "DT"},
    "OpenAlex": {"title": "TI", "doi": "DI", "display_name": "SO", "publication_year": "PY", "authorships": "AU", "type": "DT", "cited_by_count": "TC", "keywords": "DE"},
    "Semantic Scholar": {"title": "TI", "externalIds": "DI", "venue": "SO", "year": "PY", "authors": "AU", "abstract": "AB", "citationCount": "TC"},
}
#: Spellings found in real exports beside the mapped ones.
ALIASES = {"Dimensions": {"PubYear": "PY", "Source title/Anthology title": "SO", "Times cited": "TC", "Publication ID": "UT"}}

MANDATORY_SOURCE = {
    "Web of Science": ["AU", "TI", "SO", "PY"],
    "Scopus": ["Title", "Authors", "DOI"],
    "PubMed": ["PMID", "Title", "DOI"],
    "Dimensions": ["Publication ID", "Title", "DOI", "PubYear"],
    "Lens": ["Lens ID", "Title"],
    "CrossRef": ["DOI", "Title"],
    "OpenAlex": ["Title"],
    "Semantic Scholar": ["Title"],
}
#: Columns only one database has, in the order of detection.
INDICATORS = {
    "Dimensions": ["Publication ID", "Dimensions URL", "Sustainable Development Goals"],
    "PubMed": ["PMID", "PMCID", "NIHMS ID"],
    "Web of Science": ["FN ", "VR ", "PT ", "UT "],
    "Scopus": ["Scopus ID", "EID", "Index Keywords"],
    "Lens": ["Lens ID"],
    "CrossRef": ["crossref"],
    "OpenAlex": ["cited_by_count", "openalex"],
    "Semantic Scholar": ["CorpusId"],
}
#: Usual columns of a database; three of them tell it.
PATTERNS = {
    "Web of Science": TAGS,
    "Scopus": ["Scopus ID", "EID", "Title", "Authors", "Source", "Publisher Name", "ISSN", "eISSN", "DOI", "Year", "Abstract", "Affiliations", "Index Keywords"],
    "PubMed": ["PMID", "Title", "Authors", "Citation", "First Author", "Journal/Book", "Publication Year", "Create Date", "PMCID", "NIHMS ID", "DOI"],
    "Dimensions": [
        "Publication ID", "DOI", "Title", "Abstract", "Source title/Anthology title", "PubYear", "Volume", "Issue", "Pagination", "Authors", "Dimensions URL", "Times cited", "Cited references",
        "Authors Affiliations - Name of Research organization", "Authors Affiliations - Country of Research organization",
    ],
    "Lens": ["Lens ID", "Title", "Authors", "DOI", "Year", "Source", "Volume", "Issue", "Pages"],
}
FILE_HINTS = {"Web of Science": ["wos", "web of science", "savedrecs"], "Scopus": ["scopus"], "PubMed": ["pubmed", "pmid"], "Dimensions": ["dimension"], "Lens": ["lens"]}
OPTIONAL_COLUMNS = ["ACKNOWLEDGEMENTS", "FUNDING", "BOOK EDITORS", "ANTHOLOGY TITLE", "OPEN ACCESS", "RCR", "FCR", "SOURCE LINKOUT", "DIMENSIONS URL", "SDGS"]

#: Spellings of countries, in lower case.
COUNTRY_NAMES = {
    "usa": "United States", "us": "United States", "u.s.a.": "United States", "u.s.": "United States",
    "uk": "United Kingdom", "u.k.": "United Kingdom", "england": "United Kingdom", "scotland": "United Kingdom", "wales": "United Kingdom",
    "peoples r china": "China", "pr china": "China", "china pr": "China",
    "s korea": "South Korea", "republic korea": "South Korea", "south-korea": "South Korea",
    "ussr": "Russia", "soviet union": "Russia",
}

MAPPING_SCHEMA = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("duplicate_of", T.StringType()),
        T.StructField("match_type", T.StringType()),
        T.StructField("similarity_score", T.DoubleType()),
        T.StructField("source_file", T.StringType()),
    ]
)
