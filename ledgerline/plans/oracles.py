"""The same results in DuckDB SQL, for the side-by-side check.

Pages and responses are made from known parts, so their SQL states the expected
fields from those parts instead of parsing the text again.
"""

from __future__ import annotations

from ..operators.pages import COUNTRY_INDICATORS
from ..operators.report import EXPECTED_STATEMENTS
from ..operators.signers import NAME_WORD, ROLE_HINTS, ROLE_LABELS, SIGNATURE_WORDS
from ..functions.names import KEY_WORDS, NAME_SUFFIXES
from .inputs import oracle_source as src

CURRENT_YEAR = 2025


def strip(x: str) -> str:
    return f"trim({x}, ' ' || chr(9) || chr(10) || chr(13))"


def blank_null(x: str) -> str:
    return f"nullif({strip(x)}, '')"


def dmy(x: str) -> str:
    return f"CAST(try_strptime({x}, '%d/%m/%Y') AS DATE)"


def iso(x: str) -> str:
    return f"CAST(try_strptime({x}, '%Y-%m-%d') AS DATE)"


def key_of(x: str) -> str:
    plain = rf"regexp_replace(regexp_replace(lower({x}), '[^\p{{L}}\p{{N}}_\s]', '', 'g'), '\s+', ' ', 'g')"
    return rf"trim(regexp_replace(trim({plain}), '\b({'|'.join(KEY_WORDS)})\b', '', 'g'))"


def normal_name(x: str) -> str:
    out = strip(f"lower({x})")
    for s in NAME_SUFFIXES:
        out = f"replace(replace({out}, ' {s}', ''), ' {s}.', '')"
    out = rf"regexp_replace(regexp_replace({out}, '[^\p{{L}}\p{{N}}_\s]', '', 'g'), '\s+', ' ', 'g')"
    return f"coalesce(trim({out}), '')"


# --- profiles ---

UK = f"""
uk_s AS (SELECT * REPLACE ({strip("CompanyNumber")} AS CompanyNumber, TRY_CAST(StatementYear AS BIGINT) AS StatementYear)
  FROM {src("uk_statements")}),
uk_l AS (SELECT * FROM uk_s WHERE CompanyNumber IS NOT NULL AND CompanyNumber <> ''
  QUALIFY row_number() OVER (PARTITION BY CompanyNumber ORDER BY StatementYear DESC NULLS FIRST, statement_seq) = 1),
uk_r AS (SELECT * REPLACE ({strip("CompanyNumber")} AS CompanyNumber, {dmy("IncorporationDate")} AS IncorporationDate,
    {dmy("DissolutionDate")} AS DissolutionDate, TRY_CAST(Mortgages_NumMortCharges AS BIGINT) AS Mortgages_NumMortCharges)
  FROM {src("uk_registry")}),
uk_j AS (SELECT l.*, r.* EXCLUDE (CompanyNumber) FROM uk_l l LEFT JOIN uk_r r ON l.CompanyNumber = r.CompanyNumber),
uk_m AS (SELECT *, StatementYear - year(IncorporationDate) AS company_age_at_statement,
    StatementIncludesOrgStructure = 'Yes' AS has_org_structure, StatementIncludesPolicies = 'Yes' AS has_policies,
    StatementIncludesRisksAssessment = 'Yes' AS has_risk_assessment,
    StatementIncludesDueDiligence = 'Yes' AS has_due_diligence,
    StatementIncludesTraining = 'Yes' AS has_training, StatementIncludesGoals = 'Yes' AS has_goals,
    Risk1 IS NOT NULL AS has_risk_1, Risk2 IS NOT NULL AS has_risk_2, Risk3 IS NOT NULL AS has_risk_3,
    CompanyStatus = 'Active' AS is_active, DissolutionDate IS NOT NULL AS is_dissolved,
    coalesce(Mortgages_NumMortCharges, 0) > 0 AS has_mortgage_charges,
    trim(regexp_replace(RegAddress_AddressLine1 || ', ' || RegAddress_AddressLine2 || ', ' || RegAddress_PostTown || ', '
      || RegAddress_County || ', ' || RegAddress_PostCode, ', ,', ','), ', ') AS full_address,
    CASE WHEN contains(Turnover, '0-25') THEN 'Micro' WHEN contains(Turnover, '25-50') THEN 'Small'
      WHEN contains(Turnover, '50-250') THEN 'Medium' WHEN contains(Turnover, '250') THEN 'Large' ELSE 'Unknown' END AS company_size
  FROM uk_j),
uk AS (SELECT statement_seq, StatementYear AS statement_year, OrganisationName AS organization_name,
    CompanyNumber AS company_number, SectorType AS business_sector, OrganisationSectors AS industry_sectors, Turnover AS turnover,
    StatementURL AS statement_url, PDFURL AS pdf_url, StatementIncludesOrgStructure AS statement_includes_org_structure,
    StatementIncludesPolicies AS statement_includes_policies, StatementIncludesRisksAssessment AS statement_includes_risks,
    StatementIncludesDueDiligence AS statement_includes_due_diligence, StatementIncludesTraining AS statement_includes_training,
    StatementIncludesGoals AS statement_includes_goals, Risk1 AS risk_1, Risk2 AS risk_2, Risk3 AS risk_3,
    CompanyName AS company_name, RegAddress_AddressLine1 AS address_line_1, RegAddress_AddressLine2 AS address_line_2,
    RegAddress_PostTown AS post_town, RegAddress_County AS county, RegAddress_Country AS country, RegAddress_PostCode AS post_code,
    CompanyStatus AS company_status, DissolutionDate AS dissolution_date, IncorporationDate AS incorporation_date,
    Mortgages_NumMortCharges AS mortgage_charges, company_age_at_statement, has_org_structure, has_policies, has_risk_assessment,
    has_due_diligence, has_training, has_goals, has_risk_1, has_risk_2, has_risk_3,
    CAST(has_risk_1 AS INT) + CAST(has_risk_2 AS INT) + CAST(has_risk_3 AS INT) AS risk_assessment_completeness,
    CAST(has_org_structure AS INT) + CAST(has_policies AS INT) + CAST(has_risk_assessment AS INT)
      + CAST(has_due_diligence AS INT) + CAST(has_training AS INT) + CAST(has_goals AS INT) AS compliance_score,
    is_active, is_dissolved, has_mortgage_charges, full_address, company_size, 'uk' AS data_country
  FROM uk_m)"""

AU = f"""
au_s AS (SELECT * REPLACE ({strip("abn")} AS abn, {iso("period_start")} AS period_start, {iso("period_end")} AS period_end)
  FROM {src("au_statements")}),
au_u AS (SELECT *, idx || '_' || CAST(period_start AS VARCHAR) || '_' || CAST(period_end AS VARCHAR) AS uid FROM au_s
  QUALIFY row_number() OVER (PARTITION BY uid ORDER BY period_end DESC NULLS FIRST, statement_seq) = 1),
au_x AS (SELECT *, unnest(range(CASE WHEN abn IS NULL THEN 1 ELSE len(string_split(abn, ',')) END)) AS pos FROM au_u),
au_e AS (SELECT * REPLACE (CASE WHEN abn IS NULL THEN NULL ELSE {strip("string_split(abn, ',')[pos + 1]")} END AS abn) FROM au_x),
au_g AS (SELECT *, count(abn) OVER (PARTITION BY idx) AS group_entity_count,
    row_number() OVER (PARTITION BY idx ORDER BY uid NULLS FIRST, pos) - 1 AS entity_index_in_group,
    year(period_end) AS statement_year FROM au_e),
au_c AS (SELECT *, coalesce(sum(CAST(Current_Name_Indicator = 'Y' AS INT)) OVER (PARTITION BY ABN), 0) AS y
  FROM {src("au_registry")}),
au_r AS (SELECT registry_seq, {strip("Company_Name")} AS company_name, {blank_null("ABN")} AS abn, Status AS company_status,
    {iso("Date_of_Registration")} AS incorporation_date, {iso("Date_of_Deregistration")} AS dissolution_date,
    Current_Name_Indicator AS is_current_name, upper({strip("Company_Name")}) AS company_name_normalized
  FROM au_c WHERE (y > 0 AND Current_Name_Indicator = 'Y') OR y = 0),
au AS (SELECT g.statement_seq, g.idx AS statement_id, g.period_start AS statement_start_date, g.period_end AS statement_end_date,
    g.reporting_entities AS organization_name, nullif(g.abn, '') AS abn, g.annual_revenue, g.statement_url, g.pdf_url,
    g.industry_sectors, g.headquartered_countries AS headquarter_countries, g.group_entity_count, g.entity_index_in_group,
    g.idx AS statement_group_id, g.entity_index_in_group = 0 AS is_primary_entity, g.statement_year,
    upper({strip("g.reporting_entities")}) AS organization_name_normalized, r.registry_seq, r.company_name, r.company_status,
    r.incorporation_date, r.dissolution_date, r.is_current_name, r.company_name_normalized, 'ABN' AS join_method,
    g.statement_year - year(r.incorporation_date) AS company_age_at_statement, r.company_status = 'Registered' AS is_active,
    r.dissolution_date IS NOT NULL AS is_dissolved, date_diff('day', g.period_start, g.period_end) AS statement_period_days,
    r.company_name IS NOT NULL AS has_company_data, g.group_entity_count > 1 AS is_multi_entity_statement,
    CASE WHEN g.headquartered_countries IS NULL THEN 0 ELSE len(string_split(g.headquartered_countries, ',')) END
      AS num_headquarter_countries,
    g.annual_revenue IS NOT NULL AS has_revenue_data, g.statement_url IS NOT NULL AS has_statement_url,
    g.pdf_url IS NOT NULL AS has_pdf_url, g.industry_sectors IS NOT NULL AS has_industry_data,
    CAST(g.annual_revenue IS NOT NULL AS INT) + CAST(g.statement_url IS NOT NULL AS INT) + CAST(g.pdf_url IS NOT NULL AS INT)
      + CAST(g.industry_sectors IS NOT NULL AS INT) AS data_completeness_score, 'australia' AS data_country
  FROM au_g g LEFT JOIN au_r r ON nullif(g.abn, '') = r.abn)"""

CA = f"""
ca_s AS (SELECT * REPLACE ({strip("organization")} AS organization, TRY_CAST(year AS BIGINT) AS year,
    {strip("lower(language)")} AS language) FROM {src("ca_statements")}),
ca_l AS (SELECT * FROM ca_s WHERE organization IS NOT NULL AND organization <> ''
  QUALIFY row_number() OVER (PARTITION BY organization ORDER BY year DESC NULLS FIRST, statement_seq) = 1),
ca_p AS (SELECT *, {key_of("parent_company")} AS k FROM ca_l
  QUALIFY row_number() OVER (PARTITION BY parent_company ORDER BY organization, statement_seq) = 1),
ca_r AS (SELECT * REPLACE ({strip("business_name")} AS business_name, {strip("business_id_no")} AS business_id_no,
    {strip("upper(prov_terr)")} AS prov_terr) FROM {src("ca_registry")}),
ca_n AS (SELECT * FROM ca_r WHERE business_name IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY business_name ORDER BY idx) = 1),
ca_k AS (SELECT *, {key_of("business_name")} AS k FROM ca_r WHERE business_name IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY k ORDER BY idx) = 1),
ca_m AS (SELECT p.* EXCLUDE (k), p.k AS parent_company_normalized, b.* EXCLUDE (k) FROM ca_p p LEFT JOIN ca_k b ON p.k = b.k),
ca AS (SELECT statement_seq, organization AS organization_name, title AS statement_title, year AS statement_year, language,
    parent_company, subsidiary_companies, pdf_url, statement_url, industry_sector AS industry_sectors, parent_company_normalized,
    idx_text, idx AS registry_id, business_name AS company_name, business_id_no AS business_id, prov_terr AS province_state,
    status AS company_status, derived_NAICS AS naics_code, total_no_employees AS employee_count,
    pdf_url IS NOT NULL AS has_pdf_url, statement_url IS NOT NULL AS has_statement_url,
    parent_company IS NOT NULL AS has_parent_company, subsidiary_companies IS NOT NULL AS has_subsidiaries,
    total_no_employees IS NOT NULL AS has_employee_count, derived_NAICS IS NOT NULL AS has_naics_code,
    status = 'Active' AS is_active, coalesce(prov_terr IN ('ON', 'QC', 'BC', 'AB'), false) AS in_major_province,
    CAST(pdf_url IS NOT NULL AS INT) + CAST(statement_url IS NOT NULL AS INT) + CAST(parent_company IS NOT NULL AS INT)
      + CAST(derived_NAICS IS NOT NULL AS INT) AS data_completeness_score,
    CASE WHEN year IS NULL THEN 0 ELSE greatest(0, 5 - ({CURRENT_YEAR} - year)) END AS recency_score, 'canada' AS data_country
  FROM ca_m)"""

ALL = """
every AS (
  SELECT data_country, organization_name, company_name, company_status, CAST(statement_year AS VARCHAR) AS statement_year,
    is_active, industry_sectors, statement_url, abn AS ekey, statement_group_id AS skey, incorporation_date, annual_revenue FROM au
  UNION ALL SELECT data_country, organization_name, company_name, company_status, CAST(statement_year AS VARCHAR), is_active,
    industry_sectors, statement_url, organization_name, organization_name, NULL, NULL FROM ca
  UNION ALL SELECT data_country, organization_name, company_name, company_status, CAST(statement_year AS VARCHAR), is_active,
    industry_sectors, statement_url, company_number, company_number, incorporation_date, NULL FROM uk)"""


def share(c: str) -> str:
    return f"count({c}) / count(*) * 100"


def unique(c: str) -> str:
    return f"count(DISTINCT {c}) + max(CAST({c} IS NULL AS INT))"


# --- pages ---

K = "c_custkey"
YEAR4 = f"CAST(2021 + {K} % 4 AS VARCHAR)"
TITLE = f"""CASE WHEN {K} % 7 = 0 THEN c_name || ' page' WHEN {K} % 7 = 1 THEN c_name || ' plan'
  WHEN {K} % 7 = 2 THEN c_name || '(' || {YEAR4} || ')' WHEN {K} % 7 = 3 THEN c_name || ' - Modern slavery report (' || {YEAR4} || ')'
  ELSE c_name || ' Inc. (' || {YEAR4} || ')' END"""
PDF = f"""CASE WHEN {K} % 9 = 0 THEN '/doc.PDF' WHEN {K} % 9 = 1 THEN '/get?f=pdf&n=1' WHEN {K} % 9 = 2 THEN NULL
  WHEN {K} % 9 = 3 THEN '/fr.docx?dl=1' ELSE '/' || CAST({K} AS VARCHAR) || '.pdf' END"""
PAGE_YEAR = f"""CASE WHEN {K} % 7 >= 2 THEN 2021 + {K} % 4 WHEN {K} % 6 = 0 THEN 2022 ELSE 2019 + {K} % 6 END"""
ORG = f"""CASE WHEN {K} % 7 < 2 THEN NULL WHEN {K} % 7 IN (2, 3) THEN c_name ELSE c_name || ' Inc.' END"""
LANG = f"""CASE WHEN {K} % 5 = 0 THEN 'fr' WHEN {K} % 5 = 1 THEN 'en' WHEN {K} % 9 = 3 THEN 'fr' ELSE 'en' END"""
TYPE = f"CASE WHEN {K} % 9 = 2 THEN NULL WHEN {K} % 9 = 3 THEN 'docx' ELSE 'pdf' END"
LAW = f"CASE WHEN {K} % 2 = 1 THEN 'Fighting Against Forced Labour Act' END"
FRAME = "'Supply Chains Act (SCALCA)'"
STYPE = f"CASE WHEN {K} % 2 = 0 THEN 'mandatory' END"
SECTOR = f"CASE WHEN {K} % 3 = 0 THEN 'Manufacturing' WHEN {K} % 3 = 1 THEN 'Utilities' ELSE 'Retail trade' END"
SECTORS2 = f"CASE WHEN {K} % 3 < 2 THEN 'Retail trade' END"
PARENT = f"CASE WHEN {K} % 4 = 0 THEN NULL ELSE c_name END"
SUBS = f"CASE WHEN {K} % 4 = 1 THEN 'Sub ' || CAST({K} AS VARCHAR) || '|Twin & Co' END"
COUNTRY = f"CASE WHEN {K} % 6 = 0 THEN NULL ELSE c_mktsegment END"
DOCTYPE = f"CASE WHEN {K} % 8 = 0 THEN NULL ELSE 'Report' END"
AU_PDF = f"""CASE WHEN {K} % 6 = 0 THEN 'https://modernslaveryregister.gov.au/statements/' || CAST({K} AS VARCHAR) || '/pdf/'
  WHEN {K} % 6 = 1 THEN 'https://cdn.example.org/' || CAST({K} AS VARCHAR) || '.PDF'
  WHEN {K} % 6 = 2 THEN 'https://modernslaveryregister.gov.au/get/' || CAST({K} AS VARCHAR)
  WHEN {K} % 6 = 3 THEN 'https://f.example.org/' || CAST({K} AS VARCHAR) || '.pdf'
  WHEN {K} % 6 = 4 THEN 'https://modernslaveryregister.gov.au/pdf/' || CAST({K} AS VARCHAR) END"""
RAW_TITLE = r"""regexp_replace(regexp_replace(trim(replace(regexp_extract(html, '<title>(.*?)</title>', 1), '&amp;', '&')),
  '^.*?\s*-\s*', ''), '\s*-\s*.*?$', '')"""
RAW_TITLE = f"CASE WHEN length({RAW_TITLE}) > 10 THEN {RAW_TITLE} END"
RAW_LINKS = f"""SELECT page_id, CAST(n - 1 AS INT) AS position, href, 'https://www.example.ca' || href AS link
FROM (SELECT page_id, unnest(links) AS href, unnest(range(1, len(links) + 1)) AS n
  FROM (SELECT page_id, [replace(x, '&amp;', '&') FOR x IN regexp_extract_all(html, '<a href="([^"]*)"', 1)] AS links FROM {src("linked_pages")}))"""
LINKS = """(SELECT s_suppkey AS page_id, 0 AS position, 'https://www.example.ca/cnt/dtls-en.aspx?d=PS&i=' || CAST(s_suppkey % 40 AS VARCHAR)
  AS statement_url FROM supplier
  UNION ALL SELECT s_suppkey, 2, 'https://www.example.ca/cnt/dtls-en.aspx?d=PS&i=' || CAST(s_suppkey AS VARCHAR) FROM supplier)"""


def register_fields() -> str:
    old = {"IDX": "idx", "PeriodStart": "period_start", "PeriodEnd": "period_end", "Type": "statement_type",
           "HeadquarteredCountries": "headquartered_countries", "ReportingEntities": "reporting_entities",
           "ABN": "abn", "Link": "statement_url"}
    fields = ", ".join(f"{blank_null(f'CAST({o} AS VARCHAR)')} AS {n}" for o, n in old.items())
    absent = ("annual_revenue", "included_entities", "acn", "arbn", "industry_sectors", "related_statements")
    fields += "".join(f", CAST(NULL AS VARCHAR) AS {n}" for n in absent)
    return f"SELECT {fields} FROM {src('register')}"


def country_sql() -> str:
    """Score of every country as one row each, best first."""
    text = "concat_ws(' ', title, nullif(organization, ''), nullif(parent_company, ''))"
    rows = []
    for rank, (country, marks) in enumerate(COUNTRY_INDICATORS.items()):
        score = " + ".join(
            f"CASE WHEN contains(t, '{m}') THEN {2 if len(m) > 3 else 1} ELSE 0 END" for m in marks)
        rows.append(f"SELECT page_id, {rank} AS rank, '{country}' AS country, {score} AS score FROM base")
    return f"""WITH base AS (SELECT *, {text} AS t FROM {src("ca_records")}), s AS ({" UNION ALL ".join(rows)}),
best AS (SELECT page_id, country FROM s WHERE score > 0
  QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY score DESC, rank) = 1),
found AS (SELECT base.* EXCLUDE (t), coalesce(company_country, country, 'Canada') AS detected_country
  FROM base LEFT JOIN best USING (page_id))"""


# --- responses ---

SID = "'src_' || CAST(conv_id AS VARCHAR)"
PG = "CAST(turn + 1 AS INT)"
DOC = f"""
pg AS (SELECT conv_id, turn, {SID} AS source_id, {PG} AS page_number,
    (conv_id + turn) % 5 <> 4 AS should_parse, (conv_id + turn) % 11 <> 7 AS has_text, (conv_id + turn) % 3 = 0 AS has_tables,
    (conv_id + turn) % 2 = 0 AS has_figures, turn % 3 = 2 AS has_signatures,
    CASE WHEN (conv_id + turn) % 13 = 12 THEN '[TABLE_1]' ELSE '# Page ' || CAST(turn AS VARCHAR) || chr(10) || chr(10) || text
      || chr(10) || '[TABLE_1]' || chr(10) || chr(10) || chr(10) || chr(10) || '[FIGURE_1] and [TABLE_2] [TABLE_2]' || chr(10)
      || '[FIGURE_7][SIGNATURE_1]' || chr(10) END AS raw,
    CASE WHEN conv_id % 3 = 0 THEN 'later' ELSE '| a$1 | b |' || chr(10) || '| ' || CAST(conv_id AS VARCHAR) || ' | 2 |' END AS t1,
    CASE WHEN conv_id % 2 = 0 THEN 'NOT_INFORMATIVE' ELSE 'see TABLE_1' END AS t2,
    '**Chart ' || CAST(turn AS VARCHAR) || '**' || chr(10) || '- item' AS f1 FROM conversations),
ct AS (SELECT *, CASE WHEN has_text THEN raw END AS text_content FROM pg WHERE should_parse),
i1 AS (SELECT *, CASE WHEN has_tables THEN replace(replace(text_content, '[TABLE_1]',
      chr(10) || chr(10) || '## Table 1' || chr(10) || chr(10) || t1 || chr(10) || chr(10)), '[TABLE_2]',
      CASE WHEN conv_id % 2 = 0 THEN chr(10) || chr(10) || '[TABLE_2] - NOT_INFORMATIVE table (not parsed)' || chr(10) || chr(10)
      ELSE chr(10) || chr(10) || '## Table 2' || chr(10) || chr(10) || t2 || chr(10) || chr(10) END)
    ELSE regexp_replace(text_content, '\\[TABLE_\\d+\\]', '', 'g') END AS a FROM ct),
i2 AS (SELECT *, CASE WHEN has_figures THEN replace(a, '[FIGURE_1]',
      chr(10) || chr(10) || '## Figure 1' || chr(10) || chr(10) || f1 || chr(10) || chr(10))
    ELSE regexp_replace(a, '\\[FIGURE_\\d+\\]', '', 'g') END AS b FROM i1),
i3 AS (SELECT *, CASE WHEN has_signatures THEN b ELSE replace(b, '[SIGNATURE_1]', '') END AS c FROM i2),
done AS (SELECT *, coalesce({strip("regexp_replace(c, '\\n{3,}', chr(10) || chr(10), 'g')")}, '') AS integrated_content FROM i3)"""

SIG_RAW = """CASE WHEN conv_id % 5 = 0 THEN '' WHEN conv_id % 5 = 1 THEN '15 March 2024' WHEN conv_id % 5 = 2 THEN '03/04/2024'
  WHEN conv_id % 5 = 3 THEN '25/12/2024' ELSE 'soon: ' || role END"""
SIG_STD = "CASE WHEN conv_id % 7 = 0 THEN '2024-03-15x' ELSE '' END"
SIG = f"""
sg AS (SELECT conv_id, turn, {SID} AS source_id, {PG} AS page_number, 'Jane  Smith' || CAST(conv_id AS VARCHAR) || '*' || chr(10)
      || 'Managing Director' || CASE WHEN turn % 4 = 0 THEN chr(10) || chr(10) || 'Acme Ltd' ELSE '' END AS signatory_text,
    CASE WHEN conv_id % 2 = 0 THEN '' WHEN conv_id % 7 = 0 THEN '2024-03-15x' ELSE {SIG_RAW} END AS signature_date,
    CASE WHEN conv_id % 3 = 0 THEN 'high' WHEN conv_id % 3 = 1 THEN 'medium' ELSE 'low' END AS confidence
  FROM conversations WHERE turn % 2 = 0),
so AS (SELECT *, 'Jane Smith' || CAST(conv_id AS VARCHAR) || ' Managing Director' || CASE WHEN turn % 4 = 0 THEN ' Acme Ltd' ELSE '' END AS t,
    CASE signature_date WHEN '15 March 2024' THEN '2024-03-15' WHEN '03/04/2024' THEN '2024-03-04'
      WHEN '25/12/2024' THEN '2024-12-25' ELSE signature_date END AS d FROM sg)"""
OUT = """'Yes' AS Signature, {text} AS Signature_Yes_text, 'No' AS Signature_Image, {scanned} AS Signature_scanned,
  CASE WHEN d <> '' THEN 'Yes' ELSE 'No' END AS Presence_Signature_date, d AS Signature_Date, source_id,
  CAST(page_number AS BIGINT) AS page_number, confidence"""
DETECT_DEFAULT = "unknown/false/false/none"

W = r"\p{L}\p{N}_"
NAME = rf"(?:^|[^{W}])({NAME_WORD}(?:\s+{NAME_WORD}){{1,3}})(?:$|[^{W}])"
ROLE = rf"(?i)(?:{'|'.join(ROLE_LABELS)})\s*[:\-–]\s*(.+)$"
CLEAN = r"trim(regexp_replace(regexp_replace({0}, '[•·●]+', ' ', 'g'), '\s+', ' ', 'g'))"


def numbered_lines(table: str, keys: str) -> str:
    """Non-empty cleaned lines with their 0-based number."""
    return rf"""
cut AS (SELECT {keys}, length(text) AS raw_text_len, regexp_split_to_array(text, '\r\n|[\n\r]') AS parts FROM {table}),
raw AS (SELECT {keys}, raw_text_len, unnest(parts) AS part, unnest(range(len(parts))) AS n FROM cut),
ln AS (SELECT {keys}, raw_text_len, {CLEAN.format("part")} AS line,
    row_number() OVER (PARTITION BY {keys} ORDER BY n) - 1 AS line_no FROM raw WHERE {CLEAN.format("part")} <> '')"""


def signer_sql() -> str:
    keys = "doc_id, page_number"
    frame = f"OVER (PARTITION BY {keys} ORDER BY line_no ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING)"
    return f"""WITH {numbered_lines(src("signer_pages"), keys)},
f AS (SELECT *, regexp_matches(line, '(?i)(^|[^{W}])({"|".join(SIGNATURE_WORDS)})($|[^{W}])') AS signed,
    regexp_matches(line, '(?i)({"|".join(ROLE_HINTS)})') AS hinted,
    nullif({CLEAN.format(f"regexp_extract(line, '{NAME}', 1)")}, '') AS own_name,
    nullif({CLEAN.format(f"regexp_extract(line, '{ROLE}', 1)")}, '') AS own_role FROM ln),
w AS (SELECT *, first_value(own_name IGNORE NULLS) {frame} AS near_name, first_value(own_role IGNORE NULLS) {frame} AS near_role,
    string_agg(line, chr(10)) {frame} AS near FROM f),
h AS (SELECT {keys}, line_no, coalesce(own_name, near_name) AS name, near_role AS role, near AS context FROM w
  WHERE signed AND coalesce(own_name, near_name, near_role) IS NOT NULL AND NOT starts_with(lower(line), 'firma:')
  UNION ALL SELECT {keys}, line_no, own_name, own_role, line FROM w
  WHERE NOT signed AND hinted AND coalesce(own_name, own_role) IS NOT NULL),
hits AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY {keys}, name, role ORDER BY line_no) = 1)"""


EVENT_TITLE = "event_type || '; ' || replace(props, ',', ';')"
EVENT_URL = "CASE WHEN event_id % 4 <> 0 THEN 'https://e.example.org/' || CAST(user_id AS VARCHAR) ELSE 'NO_URL' END"
DAY = "CAST(o_orderdate AS DATE)"
# Day and month swap where the month-first reading is possible.
SWAPPED = f"""CASE WHEN day({DAY}) <= 12 THEN CAST(year({DAY}) AS VARCHAR) || '-' || lpad(CAST(day({DAY}) AS VARCHAR), 2, '0') || '-'
  || lpad(CAST(month({DAY}) AS VARCHAR), 2, '0') ELSE CAST({DAY} AS VARCHAR) END"""
DATE_OUT = f"""CASE WHEN o_orderkey % 8 = 7 THEN '' WHEN o_orderkey % 8 = 6 THEN 'soon' WHEN o_orderkey % 8 = 1 THEN {SWAPPED}
  ELSE CAST({DAY} AS VARCHAR) END"""
STATEMENT_TEXT = """CASE WHEN k % 5 = 0 THEN 'John Smith' WHEN k % 5 = 1 THEN 'Jane Doe, Managing Director ' || replace(c_name, '#', '')
  WHEN k % 5 = 2 THEN 'Acme Holdings Limited ' || replace(c_name, '#', '') WHEN k % 5 = 3 THEN 'éva Young' ELSE '' END"""
PICKED = """
b AS (SELECT *, confidence >= 6.0 AS likely_signature, max(CAST(confidence >= 6.0 AS INT)) OVER p AS any_likely,
    row_number() OVER (PARTITION BY source_id, page_number ORDER BY confidence DESC, xmin, ymin, box_area) AS rn
  FROM {0} WINDOW p AS (PARTITION BY source_id, page_number)),
picks AS (SELECT source_id, page_number, xmin, ymin, box_area, confidence, likely_signature,
    any_likely = 0 AND rn = 1 AS forced_pick, likely_signature OR (any_likely = 0 AND rn = 1) AS picked FROM b)""".format(src("detections"))
URLS = f"(SELECT idx, {strip('value')} AS url, document_name FROM {src('urls')} WHERE {strip('value')} <> '' AND NOT starts_with({strip('value')}, '#'))"
URL_FILE = r"regexp_extract(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)', 1), '([^/]*)/*$', 1)"
FORCED_NAME = f"CASE WHEN ends_with({URL_FILE}, '.pdf') THEN {URL_FILE} ELSE 'document_' || CAST(idx AS VARCHAR) || '.pdf' END"

ORACLES: dict[str, str] = {
    "scan_glob": f"""SELECT * EXCLUDE (statement_seq) FROM {src("au_statements")}
UNION ALL BY NAME SELECT * EXCLUDE (statement_seq, annual_revenue, pdf_url) FROM {src("au_statements")}""",
    "scan_csv_permissive": f"""SELECT {strip("CompanyNumber")} AS CompanyNumber, TRY_CAST(StatementYear AS BIGINT) AS StatementYear,
  Turnover, Risk1 FROM {src("uk_statements")}""",
    "scan_tsv_ragged": """SELECT c_name AS Company_Name, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS Status,
  CAST(c_custkey AS VARCHAR) AS ABN FROM customer""",
    "union_relaxed": """SELECT CAST(s_suppkey AS VARCHAR) AS key, s_name AS name FROM supplier
UNION ALL SELECT 'c' || CAST(c_custkey AS VARCHAR), c_name FROM customer""",
    "clean_names": "SELECT * FROM part",
    "select_existing": "SELECT o_custkey, o_orderkey, o_orderstatus FROM orders",
    "register_rows": f"""SELECT *, 'AU' AS jurisdiction, 'Australian Modern Slavery Register' AS source_system,
  'Australia' AS country_filter FROM ({register_fields()})""",
    "pdf_sources_csv": f"""SELECT 'csv_' || CAST(n AS VARCHAR) AS source_id, value AS pdf_url, document_name,
  n AS original_index FROM (SELECT *, row_number() OVER (ORDER BY idx) - 1 AS n FROM {src("urls")})""",
    "pdf_sources_dir": """WITH l AS (SELECT '/data/in/' || lower(c_mktsegment) || '/' || c_name || '.v1.pdf' AS path, c_custkey, c_name,
    c_mktsegment FROM customer)
SELECT 'dir_' || CAST(row_number() OVER (ORDER BY path) - 1 AS VARCHAR) || '_' || c_name || '.v1' AS source_id, path AS pdf_path,
  c_name || '.v1' AS document_name, c_custkey AS file_size, lower(c_mktsegment) || '/' || c_name || '.v1.pdf' AS relative_path FROM l""",
    "pdf_sources_urls": rf"""SELECT 'url_' || CAST(idx AS VARCHAR) || '_' || regexp_replace(f, '\.pdf$', '') AS source_id, url AS pdf_url,
  regexp_replace(f, '\.pdf$', '') AS document_name, idx AS original_index, f AS expected_filename
FROM (SELECT idx, url, {FORCED_NAME} AS f FROM (SELECT url, row_number() OVER (ORDER BY idx) - 1 AS idx FROM {URLS}))""",
    "url_validation": f"""SELECT idx, url, 'Line ' || CAST(idx + 1 AS VARCHAR) || ': Invalid URL format: ' || url AS message FROM {URLS}
WHERE NOT regexp_matches(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+')""",
    "url_filename": f"""SELECT idx, CASE WHEN ends_with({URL_FILE}, '.pdf') THEN {URL_FILE}
  ELSE 'document_' || substring(md5(url), 1, 8) || '.pdf' END AS file_name FROM {URLS}""",
    "clean_strings": f"""SELECT registry_seq, {strip("ABN")} AS ABN, {strip("Company_Name")} AS Company_Name, Status
FROM {src("au_registry")}""",
    "clean_typed": f"""SELECT statement_seq, {strip("organization")} AS organization, TRY_CAST(year AS BIGINT) AS year,
  {strip("lower(language)")} AS language FROM {src("ca_statements")}""",
    "clean_registry": f"""SELECT idx, {strip("business_name")} AS business_name, {strip("business_id_no")} AS business_id_no,
  {strip("upper(prov_terr)")} AS prov_terr FROM {src("ca_registry")}""",
    "parse_dates_iso": f"SELECT statement_seq, {iso('period_start')} AS period_start, {iso('period_end')} AS period_end FROM {src('au_statements')}",
    "parse_dates_uk": f"""SELECT CompanyName, {strip("CompanyNumber")} AS CompanyNumber, {dmy("IncorporationDate")} AS IncorporationDate,
  {dmy("DissolutionDate")} AS DissolutionDate, TRY_CAST(Mortgages_NumMortCharges AS BIGINT) AS Mortgages_NumMortCharges
FROM {src("uk_registry")}""",
    "null_if_empty": f"SELECT statement_seq, {blank_null('abn')} AS abn FROM {src('au_statements')}",
    "name_upper": f"SELECT statement_seq, upper({strip('reporting_entities')}) AS entity_name FROM {src('au_statements')}",
    "filter_nonempty": f"""SELECT statement_seq, {strip("CompanyNumber")} AS CompanyNumber FROM {src("uk_statements")}
WHERE {strip("CompanyNumber")} <> ''""",
    "clean_records": f"""SELECT * FROM (SELECT page_id, {blank_null("title")} AS title, {blank_null("pdf_url")} AS pdf_url, pages,
  url AS source_url, 'CA' AS jurisdiction FROM {src("raw_records")}) WHERE coalesce(title, pdf_url, CAST(pages AS VARCHAR)) IS NOT NULL""",
    "required_fields": f"SELECT page_id, title, pages FROM {src('raw_records')} WHERE title <> '' AND pages <> 0",
    "standardize": f"""SELECT idx_text, idx AS registry_id, business_name AS company_name, business_id_no AS business_id,
  prov_terr AS province_state, status AS company_status, derived_NAICS AS naics_code, total_no_employees AS employee_count,
  'canada' AS data_country FROM {src("ca_registry")}""",
    "snake_case": f"""SELECT CompanyName AS company_name, CompanyNumber AS company_number,
  RegAddress_AddressLine1 AS reg_address_address_line1, RegAddress_AddressLine2 AS reg_address_address_line2,
  RegAddress_PostTown AS reg_address_post_town, RegAddress_County AS reg_address_county, RegAddress_Country AS reg_address_country,
  RegAddress_PostCode AS reg_address_post_code, CompanyStatus AS company_status, DissolutionDate AS dissolution_date,
  IncorporationDate AS incorporation_date, Mortgages_NumMortCharges AS mortgages_num_mort_charges FROM {src("uk_registry")}""",
    "country_filter": country_sql() + " SELECT * FROM found WHERE lower(detected_country) = 'germany'",
    "uk_profiles": f"WITH {UK} SELECT * FROM uk",
    "au_profiles": f"WITH {AU} SELECT * FROM au",
    "ca_profiles": f"WITH {CA} SELECT * FROM ca",
    "ca_direct_join": f"""WITH {CA} SELECT p.parent_company, p.organization, n.idx, n.business_name, p.statement_seq
FROM ca_p p LEFT JOIN ca_n n ON p.parent_company = n.business_name""",
    "ca_fuzzy_join": f"WITH {CA} SELECT parent_company, organization, idx, business_name, statement_seq FROM ca_m",
    "join_stats": f"""WITH {AU}, r AS (SELECT statement_seq, entity_index_in_group, count(company_name) AS h FROM au GROUP BY ALL)
SELECT count(*) AS total_records, CAST(sum(h) AS BIGINT) AS successful_joins, count_if(h > 0) AS matched_rows,
  count(*) - count_if(h > 0) AS failed_joins, count_if(h > 0) / count(*) * 100 AS join_rate FROM r""",
    "register_with_pdf": f"""WITH p AS (SELECT 'https://modernslaveryregister.gov.au/statements/' || CAST({K} AS VARCHAR) || '/' AS u,
  min({AU_PDF}) AS pdf_url FROM customer GROUP BY 1)
SELECT idx, statement_url, pdf_url FROM ({register_fields()}) r LEFT JOIN p ON r.statement_url = p.u""",
    "latest_per_key": f"WITH {UK} SELECT CompanyNumber, StatementYear, statement_seq FROM uk_l",
    "unique_statements": f"WITH {AU} SELECT uid AS statement_unique_id, statement_seq FROM au_u",
    "unique_keep_first": f"WITH {CA} SELECT parent_company, organization, statement_seq FROM ca_p",
    "prefer_current": f"WITH {AU} SELECT * EXCLUDE (y) FROM au_c WHERE (y > 0 AND Current_Name_Indicator = 'Y') OR y = 0",
    "distinct_first_seen": f"""SELECT statement_url, page_id, position FROM {LINKS}
QUALIFY row_number() OVER (PARTITION BY statement_url ORDER BY page_id, position) = 1""",
    "detection_select": f"WITH {PICKED} SELECT * FROM picks",
    "expand_entities": f"""WITH {AU} SELECT statement_seq, abn, group_entity_count, entity_index_in_group, idx AS statement_group_id,
  entity_index_in_group = 0 AS is_primary_entity, statement_year FROM au_g""",
    "split_head_tail": rf"""SELECT statement_seq, l[1] AS first_id, CASE WHEN len(l) > 1 THEN array_to_string(l[2:], '|') END AS other_ids
FROM (SELECT statement_seq, string_split(regexp_replace(trim(abn), '\s*,\s*', ',', 'g'), ',') AS l FROM {src("au_statements")})""",
    "sector_split": f"""SELECT {K} AS page_id, {SECTOR} AS industry_sector, {SECTORS2} AS industry_sectors_additional,
  'Food Manufacturing plants' AS industry_subsector, CAST(NULL AS VARCHAR) AS industry_subsectors_additional FROM customer""",
    "completeness": f"WITH {UK} " + " UNION ALL ".join(
        f"SELECT '{f}' AS field, {share(f)} AS completeness FROM uk"
        for f in ("organization_name", "company_name", "incorporation_date", "company_status", "industry_sectors")),
    "au_report_basic": f"""WITH {AU} SELECT count(*) AS total_records, {unique("abn")} AS unique_entities,
  {unique("statement_group_id")} AS unique_statements FROM au""",
    "join_method_dist": f"""WITH {AU} SELECT CASE WHEN company_name IS NULL THEN 'NO_MATCH' ELSE 'ABN' END AS join_method,
  count(*) AS count, count(*) / sum(count(*)) OVER () * 100 AS percentage FROM au GROUP BY 1""",
    "entity_structure": f"""WITH {AU} SELECT count_if(is_primary_entity) AS primary_entities,
  count_if(NOT is_primary_entity) AS subsidiary_entities, count_if(group_entity_count = 1) AS single_entity_statements,
  count_if(group_entity_count > 1) AS multi_entity_statements,
  count(*) / ({unique("statement_group_id")}) AS avg_entities_per_statement FROM au""",
    "expansion_stats": f"""WITH {AU} SELECT statement_year, count(*) AS total_entities, count(abn) AS entities_with_id,
  count(*) - count(abn) AS entities_without_id FROM au_g GROUP BY 1""",
    "dist_by_key": f"""WITH {CA} SELECT 'year' AS field, CAST(year AS VARCHAR) AS value, count(*) AS count FROM ca_l GROUP BY 2
UNION ALL SELECT 'language', language, count(*) FROM ca_l GROUP BY 2""",
    "duplicate_keys": f"""WITH {CA} SELECT business_name, count(*) AS count FROM ca_r GROUP BY 1 HAVING count(*) > 1
ORDER BY count DESC, business_name NULLS FIRST LIMIT 5""",
    "geo_dist": f"WITH {CA} SELECT province_state, count(*) AS count FROM ca WHERE province_state IS NOT NULL GROUP BY 1",
    "top_sectors": f"""WITH {CA} SELECT industry_sectors, count(*) AS count FROM ca WHERE industry_sectors IS NOT NULL GROUP BY 1
ORDER BY count DESC, industry_sectors LIMIT 10""",
    "status_dist": f"WITH {UK} " + " UNION ALL ".join(
        f"SELECT '{f}' AS field, {f} AS value, count(*) AS count FROM uk GROUP BY 2"
        for f in ("company_status", "business_sector", "company_size")),
    "compliance_dist": f"""WITH {UK} SELECT CAST(compliance_score AS BIGINT) AS compliance_score, count(*) AS count,
  (SELECT sum(compliance_score) / count(compliance_score) FROM uk) AS average_score FROM uk GROUP BY 1""",
    "country_summary": f"""WITH {AU}, {CA}, {UK}, {ALL},
s AS (SELECT data_country, count(*) AS records, {unique("ekey")} AS unique_entities, {unique("skey")} AS unique_statements,
  ({share("organization_name")} + {share("company_name")} + CASE WHEN data_country <> 'canada' THEN {share("incorporation_date")} ELSE 0 END
    + {share("company_status")} + CASE WHEN data_country = 'australia' THEN {share("annual_revenue")} ELSE 0 END + {share("industry_sectors")})
    / CASE data_country WHEN 'australia' THEN 6 WHEN 'uk' THEN 5 ELSE 4 END AS average_completeness, count(company_name) / count(*) * 100 AS join_success_rate FROM every GROUP BY 1)
SELECT * FROM s UNION ALL SELECT 'all', CAST(sum(records) AS BIGINT), CAST(sum(unique_entities) AS BIGINT),
  CAST(sum(unique_statements) AS BIGINT), NULL, NULL FROM s""",
    "crawl_stats": f"""SELECT count({AU_PDF}) AS successful_extractions, count(*) - count({AU_PDF}) AS failed_extractions,
  count(*) AS total_processed, count({AU_PDF}) / count(*) * 100 AS success_rate FROM customer""",
    "expected_vs_actual": f"""WITH e(country, expected) AS (VALUES {", ".join(f"('{c}', {n})" for c, n in EXPECTED_STATEMENTS)}),
a AS (SELECT headquartered_countries AS c, count(*) AS n FROM ({register_fields()}) GROUP BY 1)
SELECT country, CAST(expected AS BIGINT) AS expected, coalesce(n, 0) AS actual,
  CASE WHEN coalesce(n, 0) = 0 THEN 'no data' WHEN n = expected THEN 'match' ELSE 'differs' END AS status
FROM e LEFT JOIN a ON country = c""",
    "all_countries": f"WITH {AU}, {CA}, {UK}, {ALL} SELECT * EXCLUDE (ekey, skey, incorporation_date, annual_revenue) FROM every",
    "align_union": """SELECT s_acctbal AS balance, CAST(s_suppkey AS VARCHAR) AS id, s_name AS name, CAST(NULL AS INT) AS region FROM supplier
UNION ALL SELECT NULL, NULL, n_name, n_regionkey FROM nation
UNION ALL SELECT NULL, 'p' || CAST(p_partkey AS VARCHAR), p_name, NULL FROM part""",
    "common_columns": f"""WITH {AU}, {CA}, {UK} """ + " UNION ALL ".join(
        "SELECT company_name, company_status, data_country, industry_sectors, is_active, organization_name, pdf_url, "
        f"CAST(statement_seq AS BIGINT) AS seq, statement_url, CAST(statement_year AS VARCHAR) AS statement_year FROM {t}"
        for t in ("au", "ca", "uk")),
    "normalize_name": f"SELECT statement_seq, {normal_name('parent_company')} AS name FROM {src('ca_statements')}",
    "match_key": f"SELECT statement_seq, {key_of('parent_company')} AS key FROM {src('ca_statements')}",
    "company_age": f"""WITH {UK} SELECT company_number AS CompanyNumber, company_age_at_statement AS CompanyAgeAtStatement FROM uk""",
    "period_days": f"SELECT statement_seq, date_diff('day', {iso('period_start')}, {iso('period_end')}) AS days FROM {src('au_statements')}",
    "count_matches": f"""SELECT statement_seq, coalesce(len(string_split(headquartered_countries, ',')), 0) AS countries
FROM {src("au_statements")}""",
    "flags": f"""WITH {UK} SELECT company_number AS CompanyNumber, has_org_structure AS HasOrgStructure, has_policies AS HasPolicies,
  has_risk_assessment AS HasRiskAssessment, has_due_diligence AS HasDueDiligence, has_training AS HasTraining, has_goals AS HasGoals,
  has_risk_1 AS HasRisk1, has_risk_2 AS HasRisk2, has_risk_3 AS HasRisk3, is_active AS IsActive, is_dissolved AS IsDissolved,
  has_mortgage_charges AS HasMortgageCharges FROM uk""",
    "scores": f"""WITH {UK} SELECT company_number AS CompanyNumber, CAST(compliance_score AS BIGINT) AS ComplianceScore,
  CAST(risk_assessment_completeness AS BIGINT) AS RiskAssessmentCompleteness FROM uk""",
    "recency": f"""SELECT statement_seq, coalesce(greatest(0, 5 - ({CURRENT_YEAR} - y)), 0) AS recency
FROM (SELECT statement_seq, TRY_CAST(year AS BIGINT) AS y FROM {src("ca_statements")}) WHERE y IS NOT NULL
UNION ALL SELECT statement_seq, 0 FROM {src("ca_statements")} WHERE TRY_CAST(year AS BIGINT) IS NULL""",
    "size_band": f"""SELECT statement_seq, CASE WHEN contains(Turnover, '0-25') THEN 'Micro' WHEN contains(Turnover, '25-50') THEN 'Small'
  WHEN contains(Turnover, '250') THEN 'Large' ELSE 'Unknown' END AS size,
  CASE Turnover WHEN '0-25' THEN 'Micro' WHEN '25-50' THEN 'Small' WHEN '50-250' THEN 'Medium' WHEN '250+' THEN 'Large'
  ELSE 'Unknown' END AS corrected_size FROM {src("uk_statements")}""",
    "full_address": f"""SELECT CompanyName, trim(regexp_replace(RegAddress_AddressLine1 || ', ' || RegAddress_AddressLine2 || ', '
  || RegAddress_PostTown || ', ' || RegAddress_County || ', ' || RegAddress_PostCode, ', ,', ','), ', ') AS address
FROM {src("uk_registry")}""",
    "normalize_date": f"SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE {DATE_OUT} END AS date FROM orders",
    "normalize_date_v5": f"SELECT o_orderkey, {DATE_OUT} AS date FROM orders",
    "clean_signatory": r"""SELECT doc_id, regexp_replace(regexp_replace(trim(text, ' ' || chr(10)), '\s+', ' ', 'g'),
  '[^\p{L}\p{N}_\s.,\-()/]', '', 'g') AS cleaned FROM documents""",
    "signatory_parts": f"""WITH s AS (SELECT c_custkey AS k, c_name FROM customer), t AS (SELECT k, {STATEMENT_TEXT} AS t FROM s),
p AS (SELECT k, CASE WHEN k % 5 IN (0, 2) THEN t ELSE '' END AS name, CASE WHEN k % 5 = 1 THEN lower(t) ELSE '' END AS title,
  CASE WHEN k % 5 = 2 THEN t ELSE '' END AS company FROM t)
SELECT k AS c_custkey, name, title, company, concat_ws(' | ', nullif(name, ''), nullif(title, ''), nullif(company, '')) AS joined FROM p""",
    "absolute_urls": """WITH u AS (SELECT c_custkey AS idx, CAST(c_custkey AS VARCHAR) AS k FROM customer)
SELECT idx, CASE idx % 8 WHEN 0 THEN 'https://www.example.ca/cnt/rsrcs/dtls-en.aspx?i=' || k WHEN 1 THEN 'https://www.example.ca/a/' || k
  WHEN 2 THEN 'https://www.example.ca/cnt/up/' || k WHEN 3 THEN 'https://cdn.example.org/' || k
  WHEN 4 THEN 'https://www.example.ca/cnt/rsrcs/ctlg?q=' || k WHEN 5 THEN 'http://o.example.org/' || k
  WHEN 6 THEN 'https://www.example.ca/cnt/rsrcs/t/' || k || '#top' ELSE 'https://www.example.ca/cnt/rsrcs/ctlg?x=1' END AS url FROM u""",
    "generate_urls": f"""WITH r AS (SELECT *, CASE WHEN template IS NULL OR first IS NULL OR last IS NULL THEN 'template, first or last page is missing'
    WHEN first = -1 THEN 'first page is negative' WHEN first > last THEN 'range ends before it starts'
    WHEN first < last AND contains(template, '/all?n=') THEN 'several pages need {{page}} in the template' END AS error FROM {src("url_ranges")})
SELECT range_id, page, replace(template, '{{page}}', CAST(page AS VARCHAR)) AS url, error
FROM (SELECT *, unnest(range(CAST(first AS BIGINT), CAST(last AS BIGINT) + 1)) AS page FROM r WHERE error IS NULL)
UNION ALL SELECT range_id, NULL, NULL, error FROM r WHERE error IS NOT NULL""",
    "file_type": r"""SELECT page_id, CASE WHEN regexp_matches(lower(url), '\.([a-z0-9]+)(\?|$)')
  THEN regexp_extract(lower(url), '\.([a-z0-9]+)(\?|$)', 1) ELSE 'pdf' END AS file_type FROM pages""",
    "log_lines": f"""SELECT page_id, {strip("replace(replace(coalesce(nullif(title, ''), 'NO_TITLE'), ',', ';'), chr(10), ' ')")} AS title,
  {strip("replace(coalesce(nullif(pdf_url, ''), url), ',', ';')")} AS url FROM {src("raw_records")}""",
    "page_links": f"SELECT page_id, CAST(position AS BIGINT) AS position, statement_url FROM {LINKS}",
    "page_title": f"SELECT page_id, {RAW_TITLE} AS title FROM pages",
    "page_language": rf"""SELECT page_id, CASE WHEN contains(l, 'fr') THEN 'fr' WHEN contains(l, 'en') THEN 'en'
  WHEN regexp_matches(html, '(?i)(^|[^{W}])français($|[^{W}])') THEN 'fr' ELSE 'en' END AS language
FROM (SELECT page_id, html, lower(regexp_extract(html, '<html lang="([^"]*)"', 1)) AS l FROM pages)""",
    "page_pdf_url": f"SELECT {K} AS page_id, {PDF} AS pdf_url FROM customer",
    "raw_pdf_url": "SELECT page_id, CASE WHEN page_id % 3 = 0 THEN '/files/' || CAST(page_id AS VARCHAR) || '.pdf' END AS pdf_url FROM pages",
    "raw_links": RAW_LINKS,
    "lateral_links": RAW_LINKS,
    "page_year": f"SELECT {K} AS page_id, {PAGE_YEAR} AS year FROM customer",
    "page_org": f"SELECT {K} AS page_id, {TITLE} AS title, {ORG} AS organization FROM customer",
    "page_legal": f"SELECT {K} AS page_id, {LAW} AS reporting_law, {FRAME} AS legal_framework, {STYPE} AS statement_type FROM customer",
    "page_industry": f"""SELECT {K} AS page_id, {SECTOR} AS industry_sector, {SECTORS2} AS industry_sectors_additional,
  'Food Manufacturing plants' AS industry_subsector FROM customer""",
    "page_company": f"SELECT {K} AS page_id, {PARENT} AS parent_company, {SUBS} AS subsidiary_companies, {COUNTRY} AS company_country FROM customer",
    "page_doctype": f"SELECT {K} AS page_id, {DOCTYPE} AS document_type FROM customer",
    "page_records": f"""SELECT {K} AS page_id, {TITLE} AS title, {PDF} AS pdf_url, {PAGE_YEAR} AS year, {ORG} AS organization, {LANG} AS language,
  {TYPE} AS file_type, {LAW} AS reporting_law, {FRAME} AS legal_framework, {STYPE} AS statement_type, {SECTOR} AS industry_sector,
  {SECTORS2} AS industry_sectors_additional, 'Food Manufacturing plants' AS industry_subsector,
  CAST(NULL AS VARCHAR) AS industry_subsectors_additional, {PARENT} AS parent_company, {SUBS} AS subsidiary_companies,
  {COUNTRY} AS company_country, {DOCTYPE} AS document_type,
  'https://www.example.ca/cnt/dtls-en.aspx?d=PS&i=' || CAST({K} AS VARCHAR) AS source_url, 'CA' AS jurisdiction FROM customer""",
    "au_pdf_url": f"SELECT {K} AS page_id, {AU_PDF} AS pdf_url FROM customer",
    "detect_country": country_sql() + " SELECT page_id, detected_country FROM found",
    "custom_extractor": """SELECT page_id, url, (length(html) - length(replace(html, '<p>', ''))) // 3 AS paragraphs,
  trim(replace(regexp_extract(html, '<h1>(.*?)</h1>', 1), '&amp;', '&')) AS first_bold FROM pages""",
    "page_analysis": f"WITH {DOC} SELECT source_id, page_number, should_parse, has_text, has_tables, has_figures, has_signatures FROM pg",
    "page_routing": f"""WITH {DOC} SELECT source_id, page_number, concat_ws('|', CASE WHEN has_text THEN 'text' END,
  CASE WHEN has_tables THEN 'tables' END, CASE WHEN has_figures THEN 'figures' END,
  CASE WHEN has_signatures THEN 'signatures' END) AS extractors,
  has_text OR has_tables OR has_figures OR has_signatures AS needs_processing FROM pg WHERE should_parse""",
    "table_sections": f"""WITH {DOC} SELECT source_id, page_number, 'TABLE_1' AS id, t1 AS content FROM pg
UNION ALL SELECT source_id, page_number, 'TABLE_2', t2 FROM pg""",
    "figure_sections": f"WITH {DOC} SELECT source_id, page_number, 'FIGURE_1' AS id, f1 AS content FROM pg",
    "placeholders": f"""WITH {DOC} SELECT source_id, page_number,
  CASE WHEN raw = '[TABLE_1]' THEN 'TABLE_1' ELSE 'TABLE_1|TABLE_2|TABLE_2' END AS "table",
  CASE WHEN raw = '[TABLE_1]' THEN '' ELSE 'FIGURE_1|FIGURE_7' END AS figure,
  CASE WHEN raw = '[TABLE_1]' THEN '' ELSE 'SIGNATURE_1' END AS signature FROM pg""",
    "placeholder_counts": f"""WITH {DOC} SELECT source_id, page_number, CASE WHEN raw = '[TABLE_1]' THEN 1 ELSE 3 END AS "table",
  CASE WHEN raw = '[TABLE_1]' THEN 0 ELSE 2 END AS figure, CASE WHEN raw = '[TABLE_1]' THEN 0 ELSE 1 END AS signature FROM pg""",
    "integrate_pages": f"WITH {DOC} SELECT source_id, page_number, integrated_content FROM done",
    "integration_check": rf"""WITH {DOC}, x AS (SELECT *,
    regexp_extract_all(coalesce(text_content, ''), '\[TABLE_\d+\]') AS et, regexp_extract_all(coalesce(text_content, ''), '\[FIGURE_\d+\]') AS ef,
    regexp_extract_all(integrated_content, '\[TABLE_\d+\]') AS rt, regexp_extract_all(integrated_content, '\[FIGURE_\d+\]') AS rf FROM done)
SELECT source_id, page_number, CASE WHEN len(et) + len(ef) = 0 THEN 0.0
    ELSE (len(et) + len(ef) - len(rt) - len(rf)) / (len(et) + len(ef)) * 100 END AS success_rate,
  len(et) + len(ef) AS total_placeholders, len(rt) + len(rf) AS remaining_placeholders,
  array_to_string(list_filter(et, lambda p: list_contains(rt, p)), '|') AS missing_tables,
  array_to_string(list_filter(ef, lambda p: list_contains(rf, p)), '|') AS missing_figures,
  CASE WHEN has_tables THEN 'TABLE_1|TABLE_2' ELSE '' END AS available_tables,
  CASE WHEN has_figures THEN 'FIGURE_1' ELSE '' END AS available_figures FROM x""",
    "combine_pages": f"""WITH {DOC}, p AS (SELECT *, coalesce(nullif(integrated_content, ''), text_content) AS piece FROM done)
SELECT source_id, {strip("regexp_replace(string_agg(piece, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY page_number), '\\n{3,}', chr(10) || chr(10), 'g')")} AS markdown
FROM p WHERE piece IS NOT NULL GROUP BY 1""",
    "page_summary": f"""WITH {DOC}, x AS (SELECT source_id, page_number, concat_ws(', ', CASE WHEN has_text THEN 'text' END,
    CASE WHEN has_tables THEN '2 table(s)' END, CASE WHEN has_figures THEN '1 figure(s)' END,
    CASE WHEN has_signatures THEN 'signatures (placeholder mode)' END) AS s FROM done)
SELECT source_id, page_number, 'Page ' || CAST(page_number AS VARCHAR) || ': Extracted ' || CASE WHEN s = '' THEN 'no content' ELSE s END
  AS summary FROM x""",
    "document_stats": f"""WITH {DOC}, c AS (SELECT source_id, count(*) AS processed, sum(CASE WHEN has_tables THEN 2 ELSE 0 END) AS t,
    sum(CASE WHEN has_figures THEN 1 ELSE 0 END) AS f,
    sum(CASE WHEN text_content IS NULL THEN 0 WHEN text_content = '[TABLE_1]' THEN 1 ELSE 5 END) AS p,
    count_if(integrated_content <> '') AS i FROM done GROUP BY 1),
a AS (SELECT source_id, count(*) AS total_pages FROM pg GROUP BY 1)
SELECT source_id, total_pages, coalesce(processed, 0) AS processed_pages, total_pages - coalesce(processed, 0) AS skipped_pages,
  CAST(coalesce(t, 0) AS BIGINT) AS total_tables, CAST(coalesce(f, 0) AS BIGINT) AS total_figures,
  CAST(coalesce(p, 0) AS BIGINT) AS total_placeholders, coalesce(i, 0) AS successful_integrations,
  coalesce(processed, 0) / total_pages * 100 AS success_rate FROM a LEFT JOIN c USING (source_id)""",
    "page_limit": f"SELECT source_id, page_number, kind FROM {src('responses')} WHERE page_number <= 3",
    "sig_detection": f"""SELECT {SID} AS source_id, {PG} AS page_number, turn % 2 = 0 AS has_signatures, turn % 4 AS signature_count,
  CASE WHEN conv_id % 3 = 0 THEN 'high' WHEN conv_id % 3 = 1 THEN 'medium' ELSE 'low' END AS confidence,
  '{DETECT_DEFAULT}|' || CASE WHEN conv_id % 4 = 0 THEN '' ELSE '{DETECT_DEFAULT}|' END
  || 'handwritten/true/false/formal|unknown/false/true/none' AS signatures_analysis FROM conversations""",
    "sig_extraction": f"""SELECT {SID} AS source_id, {PG} AS page_number, 'Jane  Smith' || CAST(conv_id AS VARCHAR) || '*' || chr(10)
  || 'Managing Director' || CASE WHEN turn % 4 = 0 THEN '|Acme Ltd' ELSE '' END AS signatory_texts,
  CASE WHEN conv_id % 2 = 0 THEN '///low|' ELSE '' END || {SIG_RAW} || '/1/' || {SIG_STD} || '/high' AS dates,
  {SIG_RAW} <> '' AS has_date FROM conversations""",
    "sig_records": f"""WITH {SIG} SELECT source_id, page_number, true AS has_signature, signatory_text, false AS is_image_signature,
  false AS is_scanned, signature_date <> '' AS has_date, signature_date, confidence FROM sg""",
    "sig_v2_records": f"""SELECT {SID} AS source_id, {PG} AS page_number, true AS has_signature,
  CASE WHEN conv_id % 4 = 0 THEN 'plain answer ' || role WHEN conv_id % 4 = 1 THEN 'A. Person' || CAST(turn AS VARCHAR)
    ELSE 'A. Person' || CAST(turn AS VARCHAR) || chr(10) || 'CEO' END AS signatory_text, conv_id % 3 = 0 AS is_image_signature,
  CASE WHEN conv_id % 4 = 3 THEN 0 ELSE CAST(turn + 1 AS INT) END AS signature_count,
  CASE conv_id % 4 WHEN 0 THEN 'typed' WHEN 1 THEN 'unknown' ELSE 'handwritten' END AS signature_type,
  CASE WHEN conv_id % 3 = 1 THEN '' ELSE '5 May 2024' END AS raw_date_text,
  true AS is_scanned, conv_id % 3 <> 1 AS has_date, CASE WHEN conv_id % 5 = 0 THEN '' ELSE '2024-05-05' END AS signature_date,
  CASE WHEN conv_id % 2 = 0 THEN 'high' ELSE 'low' END AS confidence FROM conversations WHERE turn % 2 = 0""",
    "sig_v5_parse": f"""SELECT {SID} AS source_id, {PG} AS page_number, (conv_id + turn) % 3 = 0 AS has_signatures,
  CASE WHEN turn % 2 = 0 THEN 2 ELSE 0 END AS signature_count, 'typed' AS signature_type, conv_id % 2 = 0 AS is_image, false AS is_scanned,
  'high' AS confidence, CASE WHEN (conv_id + turn) % 9 = 6 THEN '' ELSE 'Ann ' || CAST(conv_id AS VARCHAR) || '/'
  || CASE WHEN turn % 2 = 0 THEN 'CEO' ELSE '' END || '/Acme: North/' || CASE WHEN conv_id % 4 = 0 THEN '3 May 2024'
  WHEN conv_id % 4 = 1 THEN 'May 3rd, 2024' WHEN conv_id % 4 = 2 THEN '' ELSE 'someday' END || '|Bob///' END AS people FROM conversations""",
    "sig_v5_records": f"""WITH c AS (SELECT *, {SID} AS source_id, {PG} AS page_number,
    CASE WHEN conv_id % 4 < 2 THEN '2024-05-03' WHEN conv_id % 4 = 2 THEN '' ELSE 'someday' END AS d,
    CASE WHEN conv_id % 2 = 0 THEN 'Yes' ELSE 'No' END AS img FROM conversations),
y AS (SELECT * FROM c WHERE (conv_id + turn) % 3 = 0 AND (conv_id + turn) % 9 <> 6 AND (conv_id + turn) % 7 <> 5 AND (conv_id + turn) % 8 <> 3)
SELECT source_id, page_number, 'Yes' AS Signature, 'Ann ' || CAST(conv_id AS VARCHAR) || CASE WHEN turn % 2 = 0 THEN ' | CEO' ELSE '' END
  || ' | Acme: North' AS Signature_Yes_text, img AS Signature_Image, 'No' AS Signature_scanned,
  CASE WHEN d <> '' THEN 'Yes' ELSE 'No' END AS Presence_Signature_date, d AS Signature_Date, 'high' AS confidence FROM y
UNION ALL SELECT source_id, page_number, 'Yes', 'Bob', img, 'No', 'No', '', 'high' FROM y
UNION ALL SELECT source_id, page_number, 'No', '', 'No', 'No', 'No', '', 'N/A' FROM c WHERE ((conv_id + turn) % 3 <> 0 OR (conv_id + turn) % 7 = 5)
  AND turn = 0 AND NOT ((conv_id + turn) % 7 = 5 AND (conv_id + turn) % 8 = 3)""",
    "page_pairs": f"""SELECT {SID} AS source_id, {PG} AS page_number, CASE WHEN (conv_id + turn) % 7 <> 5 THEN detection END AS detection,
  CASE WHEN (conv_id + turn) % 8 <> 3 THEN extraction END AS extraction, CAST(NULL AS VARCHAR) AS error
FROM conversations JOIN {src("person_responses")} p ON p.source_id = {SID} AND p.page_number = {PG}
WHERE (conv_id + turn) % 7 <> 5 OR (conv_id + turn) % 8 <> 3""",
    "unpaired_pages": f"""SELECT 'Error' AS Signature, 'Processing Error: no ' || CASE WHEN (conv_id + turn) % 7 = 5 THEN 'detection' ELSE 'extraction' END
  || ' response' AS Signature_Yes_text, 'No' AS Signature_Image, 'No' AS Signature_scanned, 'No' AS Presence_Signature_date, '' AS Signature_Date,
  {SID} AS source_id, turn + 1 AS page_number, 'error' AS confidence FROM conversations
WHERE ((conv_id + turn) % 7 = 5) <> ((conv_id + turn) % 8 = 3)""",
    "latest_answers": f"""SELECT {SID} AS source_id, {PG} AS page_number, CASE WHEN conv_id % 3 = 0 THEN 'a second ' ELSE 'first ' END || role AS text,
  CASE WHEN turn % 6 IN (2, 4) THEN 'TABLE_1' END AS tables FROM conversations""",
    "answer_conflicts": f"""SELECT {SID} AS source_id, {PG} AS page_number, CASE WHEN conv_id % 3 <> 0 THEN 'first ' || role END AS text,
  CASE WHEN turn % 6 IN (2, 4) THEN 'TABLE_1' END AS tables, CASE WHEN conv_id % 3 = 0 THEN 'several different answers: text' END AS error
FROM conversations""",
    "signature_records": f"WITH {SIG} SELECT {OUT.format(text='t', scanned=chr(39) + 'No' + chr(39))} FROM so",
    "signature_records_parts": f"""WITH {SIG}, q AS (SELECT * REPLACE (CASE WHEN turn % 4 = 0 THEN lower(t) || ' | ' || t
  ELSE t || ' | ' || lower(t) END AS t) FROM so) SELECT {OUT.format(text='t', scanned=chr(39) + 'No' + chr(39))} FROM q""",
    "signature_errors": f"""SELECT 'Error' AS Signature, 'Processing Error: no image for ' || {SID} AS Signature_Yes_text, 'No' AS Signature_Image,
  'No' AS Signature_scanned, 'No' AS Presence_Signature_date, '' AS Signature_Date, {SID} AS source_id, turn + 1 AS page_number,
  'error' AS confidence FROM conversations""",
    "consolidated_signatures": f"""WITH {SIG} SELECT {OUT.format(text='t', scanned=chr(39) * 2)},
  '2025-09-20T18:18:25' AS processing_timestamp FROM so""",
    "source_summary": f"""WITH {SIG}, n AS (SELECT source_id, count(*) AS a, count_if(d <> '') AS b,
  count(DISTINCT page_number) AS p FROM so GROUP BY 1)
SELECT s.source_id, coalesce(a, 0) AS total_signatures, CAST(0 AS BIGINT) AS image_signatures, CAST(0 AS BIGINT) AS scanned_signatures,
  coalesce(b, 0) AS signatures_with_dates, coalesce(p, 0) AS pages_with_signatures
FROM (SELECT DISTINCT {SID} AS source_id FROM conversations) s LEFT JOIN n USING (source_id)""",
    "corpus_summary": f"""WITH {SIG} SELECT (SELECT count(DISTINCT conv_id) FROM conversations) AS total_sources,
  (SELECT count(DISTINCT conv_id) FROM conversations) AS successful_sources, count(*) AS total_signatures,
  count(DISTINCT source_id) AS sources_with_signatures FROM so""",
    "detection_summary": f"""WITH {PICKED} SELECT source_id, count(*) AS signatures_found, count(DISTINCT page_number) AS pages_processed
FROM picks WHERE picked GROUP BY 1""",
    "detection_totals": f"""WITH {PICKED} SELECT (SELECT count(DISTINCT l_suppkey) FROM lineitem) AS total_pdfs,
  count(*) AS total_signatures FROM picks WHERE picked""",
    "line_context": f"""WITH {numbered_lines("documents", "doc_id")} SELECT doc_id, line_no, line,
  string_agg(line, chr(10)) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING) AS context FROM ln""",
    "signer_hits": signer_sql() + " SELECT *, 'pdf_text' AS source FROM hits",
    "signer_dedup": signer_sql() + " SELECT doc_id, page_number, name, role, line_no FROM hits",
    "signer_rows": signer_sql() + f""" SELECT p.doc_id, p.page_number, length(p.text) AS raw_text_len, h.name, h.role, h.context,
  'pdf_text' AS source FROM {src("signer_pages")} p LEFT JOIN hits h ON p.doc_id = h.doc_id AND p.page_number = h.page_number""",
    "stream_log": f"""SELECT page_id, replace(coalesce({RAW_TITLE}, 'NO_TITLE'), ',', ';') AS title, url FROM pages""",
    "stream_country_log": f"""SELECT {K} AS page_id, {TITLE} AS title, coalesce({PDF}, 'https://www.example.ca/cnt/dtls-en.aspx?d=PS&i=' || CAST({K} AS VARCHAR)) AS url
FROM customer WHERE {K} % 6 = 0 AND {K} % 7 > 3""",
    "stream_count": "SELECT count(*) AS count FROM events",
    "latest_log": f"""SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp, {EVENT_TITLE} AS title, {EVENT_URL} AS url
FROM events ORDER BY 2 DESC, event_id DESC LIMIT 5""",
}

# Documents as parts with their page totals.
ORACLES["document_result"] = f"""WITH {DOC}, p AS (SELECT *, coalesce(nullif(integrated_content, ''), text_content) AS piece FROM done),
m AS (SELECT source_id, {strip("regexp_replace(string_agg(piece, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY page_number), '\\n{3,}', chr(10) || chr(10), 'g')")} AS markdown
  FROM p WHERE piece IS NOT NULL GROUP BY 1),
a AS (SELECT source_id, count(*) AS total_pages, count_if(should_parse) AS processed_pages,
  count_if(NOT should_parse) AS skipped_pages, count_if(should_parse) / count(*) * 100 AS success_rate FROM pg GROUP BY 1)
SELECT a.*, coalesce(markdown, '') AS final_markdown FROM a LEFT JOIN m USING (source_id)"""

_BLOCK = """'**Signature Information**' || chr(10) || '- **Signatory:** ' || signatory_text || chr(10)
  || CASE WHEN signature_date <> '' THEN '- **Date:** ' || signature_date || chr(10) ELSE '' END
  || '- **Detection confidence:** ' || upper(confidence[1]) || confidence[2:] || chr(10)"""
ORACLES["signature_markdown"] = f"""WITH {SIG} SELECT {SID} AS source_id, {PG} AS page_number, {_BLOCK} AS signature_block
FROM conversations LEFT JOIN sg USING (conv_id, turn)"""
ORACLES["integrate_with_signatures"] = f"""WITH {SIG}, {DOC},
x AS (SELECT i3.source_id, i3.page_number, CASE WHEN i3.has_signatures AND sg.conv_id IS NOT NULL THEN replace(c, '[SIGNATURE_1]',
    chr(10) || chr(10) || '## Signature 1' || chr(10) || chr(10) || {_BLOCK} || chr(10) || chr(10)) ELSE c END AS e
  FROM i3 LEFT JOIN sg ON i3.conv_id = sg.conv_id AND i3.turn = sg.turn)
SELECT source_id, page_number, coalesce({strip("regexp_replace(e, '\\n{3,}', chr(10) || chr(10), 'g')")}, '') AS integrated_content FROM x"""

# Sinks give back what was written.
ORACLES["sink_csv"] = f"SELECT page_id, url, title, pdf_url, CAST(pages AS VARCHAR) AS pages FROM {src('raw_records')}"
ORACLES["sink_json"] = f"""SELECT {K} AS page_id, {TITLE} AS title, {PAGE_YEAR} AS year, {SECTORS2} AS industry_sectors_additional,
  {SUBS} AS subsidiary_companies FROM customer"""
ORACLES["sink_per_source"] = ORACLES["signature_records"]
ORACLES["sink_markdown"] = f"""SELECT source_id, CASE WHEN final_markdown = '' THEN 'No content was extracted from the document.'
  ELSE final_markdown END AS final_markdown FROM ({ORACLES["document_result"]}) d"""
ORACLES["sink_summary"] = ORACLES["country_summary"]
ORACLES["sink_signers"] = f"SELECT r.*, format FROM ({ORACLES['signer_rows']}) r, (VALUES ('csv'), ('json')) f(format)"
ORACLES["sink_links"] = f"""WITH u AS (SELECT DISTINCT statement_url AS line FROM {LINKS})
SELECT line FROM u UNION ALL SELECT '# Total URLs: ' || CAST(count(*) AS VARCHAR) FROM u
UNION ALL VALUES ('# Statement URLs collected for CA'), ('# Generated: 2025-01-01 00:00:00'), ('#')"""
ORACLES["concat_batches"] = f"SELECT * FROM ({ORACLES['signature_records']}) a UNION ALL BY NAME SELECT * FROM ({ORACLES['signature_errors']}) b"
ORACLES["mean_scores"] = f"""WITH {CA} SELECT round_even(avg(data_completeness_score), 2) AS data_completeness_score,
  round_even(avg(recency_score), 2) AS recency_score FROM ca"""
ORACLES["scan_uk_registry"] = f"SELECT * FROM {src('uk_registry')}"
ORACLES["scan_ca_registry"] = f"SELECT * EXCLUDE (idx_text) REPLACE (CAST(idx AS VARCHAR) AS idx) FROM {src('ca_registry')}"
