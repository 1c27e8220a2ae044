"""Dataset registry and the current table schemas.

Fixed values: the twelve dataset names, the convertible subset and the current
table schema of each dataset (Spark DDL).  These must equal the target tables
for loads to line up, so they are stated here as plain data.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -------------------------------------------------------
DATASETS = ("authors", "awards", "concepts", "domains", "fields", "funders",
            "institutions", "publishers", "sources", "subfields", "topics", "works")

# Datasets with repair rules; the rest pass through unchanged.
CONVERTIBLE = ("works", "concepts", "institutions", "sources")
# How a dataset's conversion takes a broken line: works skips it, the others fail the file.
SCAN_MODE = {"works": "tolerant", "concepts": "strict", "institutions": "strict", "sources": "strict"}

# Current table schema per dataset (Spark DDL, one field per line).
TABLE_DDL = {
    "authors": """
affiliations ARRAY<STRUCT<institution: STRUCT<country_code: STRING, display_name: STRING, id: STRING, lineage: ARRAY<STRING>, ror: STRING, `type`: STRING>, years: ARRAY<BIGINT>>>,
cited_by_count BIGINT,
counts_by_year ARRAY<STRUCT<cited_by_count: BIGINT, oa_works_count: BIGINT, works_count: BIGINT, `year`: BIGINT>>,
created_date DATE,
display_name STRING,
display_name_alternatives ARRAY<STRING>,
id STRING,
ids STRUCT<openalex: STRING, orcid: STRING>,
last_known_institutions ARRAY<STRUCT<country_code: STRING, display_name: STRING, id: STRING, lineage: ARRAY<STRING>, ror: STRING, `type`: STRING>>,
orcid STRING,
sources ARRAY<STRUCT<display_name: STRING, host_organization: STRING, host_organization_lineage: ARRAY<STRING>, host_organization_lineage_names: ARRAY<STRING>, host_organization_name: STRING, id: STRING, is_core: BOOLEAN, is_in_doaj: BOOLEAN, is_oa: BOOLEAN, issn: ARRAY<STRING>, issn_l: STRING, `type`: STRING>>,
summary_stats STRUCT<`2yr_mean_citedness`: DOUBLE, h_index: BIGINT, i10_index: BIGINT>,
topic_share ARRAY<STRUCT<display_name: STRING, domain: STRUCT<display_name: STRING, id: STRING>, `field`: STRUCT<display_name: STRING, id: STRING>, id: STRING, subfield: STRUCT<display_name: STRING, id: STRING>, `value`: DOUBLE>>,
topics ARRAY<STRUCT<`count`: BIGINT, display_name: STRING, domain: STRUCT<display_name: STRING, id: STRING>, `field`: STRUCT<display_name: STRING, id: STRING>, id: STRING, score: DOUBLE, subfield: STRUCT<display_name: STRING, id: STRING>>>,
updated_date TIMESTAMP,
works_api_url STRING,
works_count BIGINT,
x_concepts ARRAY<STRUCT<`count`: BIGINT, display_name: STRING, id: STRING, level: BIGINT, score: DOUBLE, wikidata: STRING>>
""",
    "awards": """
amount DOUBLE,
co_lead_investigator STRUCT<affiliation: STRUCT<country: STRING, ids: ARRAY<STRUCT<asserted_by: STRING, id: STRING, `type`: STRING>>, name: STRING>, family_name: STRING, given_name: STRING, orcid: STRING, role_start: DATE>,
created_date TIMESTAMP,
currency STRING,
description STRING,
display_name STRING,
doi STRING,
end_date DATE,
end_year BIGINT,
funded_outputs ARRAY<STRING>,
funded_outputs_count BIGINT,
funder STRUCT<display_name: STRING, doi: STRING, id: STRING, ror_id: STRING>,
funder_award_id STRING,
funder_scheme STRING,
funding_type STRING,
id STRING,
investigators ARRAY<STRUCT<affiliation: STRUCT<country: STRING, ids: ARRAY<STRUCT<asserted_by: STRING, id: STRING, `type`: STRING>>, name: STRING>, family_name: STRING, given_name: STRING, orcid: STRING, role_start: DATE>>,
landing_page_url STRING,
lead_investigator STRUCT<affiliation: STRUCT<country: STRING, ids: ARRAY<STRUCT<asserted_by: STRING, id: STRING, `type`: STRING>>, name: STRING>, family_name: STRING, given_name: STRING, orcid: STRING, role_start: DATE>,
provenance STRING,
start_date DATE,
start_year BIGINT,
updated_date TIMESTAMP,
works_api_url STRING
""",
    "concepts": """
cited_by_count BIGINT,
created_date DATE,
description STRING,
display_name STRING,
id STRING,
ids STRUCT<openalex: STRING, wikidata: STRING, wikipedia: STRING>,
image_thumbnail_url STRING,
image_url STRING,
level BIGINT,
updated_date TIMESTAMP,
wikidata STRING,
works_api_url STRING,
works_count BIGINT
""",
    "domains": """
cited_by_count BIGINT,
created_date TIMESTAMP,
description STRING,
display_name STRING,
display_name_alternatives ARRAY<STRING>,
`fields` ARRAY<STRUCT<display_name: STRING, id: STRING>>,
id STRING,
ids STRUCT<openalex: STRING, wikidata: STRING, wikipedia: STRING>,
original_id BIGINT,
siblings ARRAY<STRUCT<display_name: STRING, id: STRING>>,
updated_date TIMESTAMP,
works_api_url STRING,
works_count BIGINT
""",
    "fields": """
cited_by_count BIGINT,
created_date TIMESTAMP,
description STRING,
display_name STRING,
display_name_alternatives ARRAY<STRING>,
domain STRUCT<display_name: STRING, id: STRING>,
id STRING,
ids STRUCT<openalex: STRING, wikidata: STRING, wikipedia: STRING>,
original_id BIGINT,
siblings ARRAY<STRUCT<display_name: STRING, id: STRING>>,
subfields ARRAY<STRUCT<display_name: STRING, id: STRING>>,
updated_date TIMESTAMP,
works_api_url STRING,
works_count BIGINT
""",
    "funders": """
alternate_titles ARRAY<STRING>,
awards_count BIGINT,
cited_by_count BIGINT,
country_code STRING,
counts_by_year ARRAY<STRUCT<cited_by_count: BIGINT, oa_works_count: BIGINT, works_count: BIGINT, `year`: BIGINT>>,
created_date TIMESTAMP,
description STRING,
display_name STRING,
homepage_url STRING,
id STRING,
ids STRUCT<crossref: BIGINT, doi: STRING, openalex: STRING, ror: STRING, wikidata: STRING>,
image_thumbnail_url STRING,
image_url STRING,
roles ARRAY<STRUCT<id: STRING, role: STRING, works_count: BIGINT>>,
summary_stats STRUCT<`2yr_mean_citedness`: DOUBLE, h_index: BIGINT, i10_index: BIGINT>,
updated_date TIMESTAMP,
works_count BIGINT
""",
    "institutions": """
associated_institutions ARRAY<STRUCT<country_code: STRING, display_name: STRING, id: STRING, relationship: STRING, ror: STRING, `type`: STRING>>,
cited_by_count BIGINT,
country_code STRING,
counts_by_year ARRAY<STRING>,
created_date TIMESTAMP,
display_name STRING,
display_name_acronyms ARRAY<STRING>,
display_name_alternatives ARRAY<STRING>,
geo STRUCT<city: STRING, country: STRING, country_code: STRING, geonames_city_id: BIGINT, latitude: DOUBLE, longitude: DOUBLE, region: STRING>,
homepage_url STRING,
id STRING,
ids STRUCT<openalex: STRING, ror: STRING, wikidata: STRING, wikipedia: STRING>,
image_thumbnail_url STRING,
image_url STRING,
is_super_system BOOLEAN,
lineage ARRAY<STRING>,
repositories ARRAY<STRUCT<display_name: STRING, host_organization: STRING, host_organization_lineage: ARRAY<STRING>, host_organization_name: STRING, id: STRING>>,
roles ARRAY<STRUCT<id: STRING, role: STRING, works_count: BIGINT>>,
ror STRING,
summary_stats STRUCT<`2yr_mean_citedness`: DOUBLE, h_index: BIGINT, i10_index: BIGINT>,
topic_share ARRAY<STRING>,
topics ARRAY<STRING>,
`type` STRING,
type_id STRING,
updated_date STRING,
wiki_page STRING,
wikidata_id STRING,
works_api_url STRING,
works_count BIGINT
""",
    "publishers": """
alternate_titles ARRAY<STRING>,
cited_by_count BIGINT,
country_codes ARRAY<STRING>,
counts_by_year ARRAY<STRUCT<cited_by_count: BIGINT, works_count: BIGINT, `year`: BIGINT>>,
created_date DATE,
display_name STRING,
hierarchy_level BIGINT,
homepage_url STRING,
id STRING,
ids STRUCT<openalex: STRING, ror: STRING, wikidata: STRING>,
image_thumbnail_url STRING,
image_url STRING,
lineage ARRAY<STRING>,
parent_publisher STRUCT<display_name: STRING, id: STRING>,
roles ARRAY<STRUCT<id: STRING, role: STRING, works_count: BIGINT>>,
ror_id STRING,
sources_api_url STRING,
summary_stats STRUCT<`2yr_mean_citedness`: DOUBLE, h_index: BIGINT, i10_index: BIGINT>,
updated_date DATE,
wikidata_id STRING,
works_count BIGINT
""",
    "sources": """
alternate_titles ARRAY<STRING>,
apc_prices ARRAY<STRUCT<currency: STRING, price: BIGINT>>,
apc_usd BIGINT,
cited_by_count BIGINT,
country_code STRING,
counts_by_year ARRAY<STRUCT<cited_by_count: BIGINT, oa_works_count: BIGINT, works_count: BIGINT, `year`: BIGINT>>,
created_date TIMESTAMP,
display_name STRING,
first_publication_year BIGINT,
homepage_url STRING,
host_organization STRING,
host_organization_lineage ARRAY<STRING>,
host_organization_name STRING,
id STRING,
ids STRUCT<issn: ARRAY<STRING>, issn_l: STRING, mag: BIGINT, openalex: STRING, wikidata: STRING>,
is_core BOOLEAN,
is_high_oa_rate BOOLEAN,
is_high_oa_rate_since_year BIGINT,
is_in_doaj BOOLEAN,
is_in_doaj_since_year BIGINT,
is_in_scielo BOOLEAN,
is_oa BOOLEAN,
is_ojs BOOLEAN,
issn ARRAY<STRING>,
issn_l STRING,
last_publication_year BIGINT,
oa_flip_year BIGINT,
oa_works_count BIGINT,
societies ARRAY<STRUCT<organization: STRING, url: STRING>>,
summary_stats STRUCT<`2yr_mean_citedness`: DOUBLE, h_index: BIGINT, i10_index: BIGINT>,
topic_share ARRAY<STRUCT<display_name: STRING, domain: STRUCT<display_name: STRING, id: STRING>, `field`: STRUCT<display_name: STRING, id: STRING>, id: STRING, subfield: STRUCT<display_name: STRING, id: STRING>, `value`: DOUBLE>>,
topics ARRAY<STRUCT<`count`: BIGINT, display_name: STRING, domain: STRUCT<display_name: STRING, id: STRING>, `field`: STRUCT<display_name: STRING, id: STRING>, id: STRING, score: DOUBLE, subfield: STRUCT<display_name: STRING, id: STRING>>>,
`type` STRING,
updated_date TIMESTAMP,
works_api_url STRING,
works_count BIGINT
""",
    "subfields": """
cited_by_count BIGINT,
created_date TIMESTAMP,
description STRING,
display_name STRING,
display_name_alternatives ARRAY<STRING>,
domain STRUCT<display_name: STRING, id: STRING>,
`field` STRUCT<display_name: STRING, id: STRING>,
id STRING,
ids STRUCT<openalex: STRING, wikidata: STRING, wikipedia: STRING>,
original_id BIGINT,
siblings ARRAY<STRUCT<display_name: STRING, id: STRING>>,
topics ARRAY<STRUCT<display_name: STRING, id: STRING>>,
updated_date TIMESTAMP,
works_api_url STRING,
works_count BIGINT
""",
    "topics": """
cited_by_count BIGINT,
created_date TIMESTAMP,
description STRING,
display_name STRING,
domain STRUCT<display_name: STRING, id: STRING>,
`field` STRUCT<display_name: STRING, id: STRING>,
id STRING,
ids STRUCT<openalex: STRING, wikipedia: STRING>,
keywords ARRAY<STRING>,
original_id BIGINT,
siblings ARRAY<STRUCT<display_name: STRING, id: STRING>>,
subfield STRUCT<display_name: STRING, id: STRING>,
updated_date TIMESTAMP,
works_api_url STRING,
works_count BIGINT
""",
    "works": """
abstract STRING,
abstract_inverted_index STRING,
apc_list ARRAY<STRUCT<currency: STRING, provenance: STRING, `value`: BIGINT, value_usd: BIGINT>>,
apc_paid STRUCT<currency: STRING, `value`: BIGINT, value_usd: BIGINT>,
authors_count BIGINT,
authorships ARRAY<STRUCT<affiliations: ARRAY<STRUCT<institution_ids: ARRAY<STRING>, raw_affiliation_string: STRING>>, author: STRUCT<display_name: STRING, id: STRING, orcid: STRING>, countries: ARRAY<STRING>, institutions: ARRAY<STRUCT<country_code: STRING, display_name: STRING, id: STRING, lineage: ARRAY<STRING>, ror: STRING, `type`: STRING>>, is_corresponding: BOOLEAN, raw_affiliation_strings: ARRAY<STRING>, raw_author_name: STRING>>,
awards ARRAY<STRUCT<display_name: STRING, funder_award_id: STRING, funder_display_name: STRING, funder_id: STRING, id: STRING>>,
best_oa_location STRUCT<apc_prices: ARRAY<STRUCT<currency: STRING, price: BIGINT>>, apc_usd: BIGINT, doi: STRING, endpoint_id: STRING, grobid_s3_id: STRING, host_type: STRING, is_accepted: BOOLEAN, is_oa: BOOLEAN, is_published: BOOLEAN, is_unpaywall_record: BOOLEAN, issn: ARRAY<STRING>, landing_page_url: STRING, license: STRING, license_id: STRING, location_type: STRING, native_id: STRING, oa_status: BIGINT, pdf_s3_id: STRING, pdf_url: STRING, pmh_id: STRING, provenance: STRING, raw_source_name: STRING, raw_type: STRING, sort_score: BIGINT, source: STRUCT<display_name: STRING, host_institution_lineage: ARRAY<STRING>, host_institution_lineage_names: ARRAY<STRING>, host_organization: STRING, host_organization_lineage: ARRAY<STRING>, host_organization_lineage_names: ARRAY<STRING>, host_organization_name: STRING, id: STRING, is_core: BOOLEAN, is_in_doaj: BOOLEAN, is_oa: BOOLEAN, issn: ARRAY<STRING>, issn_l: STRING, publisher: STRING, publisher_id: STRING, publisher_lineage: ARRAY<STRING>, publisher_lineage_names: ARRAY<STRING>, `type`: STRING>, updated: TIMESTAMP, url_sort_score: BIGINT, version: STRING>,
biblio STRUCT<first_page: STRING, issue: STRING, last_page: STRING, volume: STRING>,
citation_normalized_percentile STRUCT<is_in_top_10_percent: BOOLEAN, is_in_top_1_percent: BOOLEAN, `value`: DOUBLE>,
cited_by_count BIGINT,
cited_by_percentile_year STRUCT<`max`: BIGINT, `min`: BIGINT>,
concepts ARRAY<STRUCT<display_name: STRING, id: STRING, level: BIGINT, score: DOUBLE, wikidata: STRING>>,
corresponding_author_ids ARRAY<STRING>,
corresponding_institution_ids ARRAY<STRING>,
countries_distinct_count BIGINT,
counts_by_year ARRAY<STRUCT<cited_by_count: BIGINT, `year`: BIGINT>>,
created_date TIMESTAMP,
display_name STRING,
doi STRING,
funders ARRAY<STRUCT<display_name: STRING, id: STRING, ror: STRING>>,
fwci DOUBLE,
has_abstract BOOLEAN,
has_content STRUCT<grobid_xml: BOOLEAN, pdf: BOOLEAN>,
has_fulltext BOOLEAN,
id STRING,
ids STRUCT<doi: STRING, mag: BIGINT, openalex: STRING, pmid: STRING, openalex_curation: STRING>,
indexed_in ARRAY<STRING>,
institutions ARRAY<STRING>,
institutions_distinct_count BIGINT,
is_paratext BOOLEAN,
is_retracted BOOLEAN,
is_xpac BOOLEAN,
keywords ARRAY<STRUCT<display_name: STRING, id: STRING, score: DOUBLE>>,
`language` STRING,
locations ARRAY<STRUCT<is_accepted: BOOLEAN, is_oa: BOOLEAN, is_published: BOOLEAN, landing_page_url: STRING, license: STRING, license_id: STRING, native_id: STRING, pdf_url: STRING, provenance: STRING, raw_source_name: STRING, raw_type: STRING, source: STRUCT<display_name: STRING, host_organization: STRING, host_organization_lineage: ARRAY<STRING>, host_organization_lineage_names: ARRAY<STRING>, host_organization_name: STRING, id: STRING, is_core: BOOLEAN, is_in_doaj: BOOLEAN, is_oa: BOOLEAN, issn: ARRAY<STRING>, issn_l: STRING, `type`: STRING>, version: STRING>>,
locations_count BIGINT,
mesh ARRAY<STRUCT<descriptor_name: STRING, descriptor_ui: STRING, is_major_topic: BOOLEAN, qualifier_name: STRING, qualifier_ui: STRING>>,
open_access STRUCT<any_repository_has_fulltext: BOOLEAN, is_oa: BOOLEAN, oa_status: STRING, oa_url: STRING>,
primary_location STRUCT<apc_prices: ARRAY<STRUCT<currency: STRING, price: BIGINT>>, apc_usd: BIGINT, endpoint_id: STRING, grobid_s3_id: STRING, host_type: STRING, is_accepted: BOOLEAN, is_oa: BOOLEAN, is_published: BOOLEAN, is_unpaywall_record: BOOLEAN, landing_page_url: STRING, license: STRING, license_id: STRING, location_type: STRING, native_id: STRING, oa_status: BIGINT, pdf_s3_id: STRING, pdf_url: STRING, pmh_id: STRING, provenance: STRING, raw_source_name: STRING, raw_type: STRING, sort_score: BIGINT, source: STRUCT<display_name: STRING, host_organization: STRING, host_organization_lineage: ARRAY<STRING>, host_organization_lineage_names: ARRAY<STRING>, host_organization_name: STRING, id: STRING, is_core: BOOLEAN, is_in_doaj: BOOLEAN, is_oa: BOOLEAN, issn: ARRAY<STRING>, issn_l: STRING, `type`: STRING>, updated: TIMESTAMP, url_sort_score: BIGINT, version: STRING>,
primary_topic STRUCT<display_name: STRING, domain: STRUCT<display_name: STRING, id: STRING>, `field`: STRUCT<display_name: STRING, id: STRING>, id: STRING, score: DOUBLE, subfield: STRUCT<display_name: STRING, id: STRING>>,
publication_date DATE,
publication_year BIGINT,
referenced_works ARRAY<STRING>,
referenced_works_count BIGINT,
related_works ARRAY<STRING>,
sustainable_development_goals ARRAY<STRUCT<display_name: STRING, id: STRING, score: DOUBLE>>,
title STRING,
topics ARRAY<STRUCT<display_name: STRING, domain: STRUCT<display_name: STRING, id: STRING>, `field`: STRUCT<display_name: STRING, id: STRING>, id: STRING, score: DOUBLE, subfield: STRUCT<display_name: STRING, id: STRING>>>,
`type` STRING,
updated_date TIMESTAMP
""",
}
# --- end of fixed values ------------------------------------------------


_SCHEMA_CACHE: dict[str, T.StructType] = {}


def table_schema(dataset: str) -> T.StructType:
    """StructType of a dataset's current table (parsed once per process)."""
    check_datasets([dataset])
    if dataset not in _SCHEMA_CACHE:
        ddl = " ".join(line.strip() for line in TABLE_DDL[dataset].splitlines())
        _SCHEMA_CACHE[dataset] = T._parse_datatype_string(ddl)
    return _SCHEMA_CACHE[dataset]


def check_datasets(names) -> list[str]:
    """Dataset membership (B5): ``all`` expands to every dataset; unknown names raise."""
    names = list(names)
    if names == ["all"]:
        return list(DATASETS)
    unknown = [n for n in names if n not in DATASETS]
    if unknown:
        raise ValueError(f"unknown dataset(s) {unknown}; available: {' '.join(DATASETS)}")
    return names


def table_name(dataset: str, version: str) -> str:
    """Versioned table name ``<dataset>_<version>``."""
    return f"{dataset}_{version}"
