"""Statement, registry, page and response tables derived from the test tables.

The test data has no statements, so these SELECTs build them. They keep to SQL
that Spark and DuckDB read alike, so that a check can start from the same rows;
names in braces are the source tables. Every table grows with its source, and
each holds the awkward values the rules are about: blanks, nulls, bad numbers
and dates, repeated keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Days and months without leading zeros, as d/M/yyyy.
_DMY = "CAST(day({0}) AS STRING) || '/' || CAST(month({0}) AS STRING) || '/' || CAST(year({0}) AS STRING)"
_ISO = "CAST(CAST({0} AS DATE) AS STRING)"


def _yes_no(column: str, a: int, b: int, name: str) -> str:
    """Yes, No or null in turn."""
    return (
        f"CASE WHEN ({column} + {a}) % {b} = 0 THEN NULL WHEN ({column} + {a}) % 3 = 0 THEN 'No' "
        f"ELSE 'Yes' END AS {name}"
    )


INPUTS = {
    "uk_statements": f"""
SELECT o_orderkey AS statement_seq,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 29 = 0 THEN 'n/a'
       ELSE CAST(year(o_orderdate) AS STRING) END AS StatementYear,
  'Organisation ' || CAST(o_custkey AS STRING) AS OrganisationName,
  CASE WHEN o_orderkey % 41 = 0 THEN NULL WHEN o_orderkey % 43 = 0 THEN ''
       WHEN o_orderkey % 7 = 0 THEN ' ' || CAST(o_custkey AS STRING) || chr(9)
       ELSE CAST(o_custkey AS STRING) END AS CompanyNumber,
  o_orderpriority AS SectorType,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'Sector ' || o_orderstatus END AS OrganisationSectors,
  CASE WHEN o_orderkey % 6 = 0 THEN '0-25' WHEN o_orderkey % 6 = 1 THEN '25-50'
       WHEN o_orderkey % 6 = 2 THEN '50-250' WHEN o_orderkey % 6 = 3 THEN '250+'
       WHEN o_orderkey % 6 = 4 THEN 'Under 36 million' ELSE NULL END AS Turnover,
  'https://register.example.org/' || CAST(o_orderkey AS STRING) AS StatementURL,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL
       ELSE 'https://register.example.org/' || CAST(o_orderkey AS STRING) || '.pdf' END AS PDFURL,
  {_yes_no("o_orderkey", 1, 23, "StatementIncludesOrgStructure")},
  {_yes_no("o_orderkey", 2, 19, "StatementIncludesPolicies")},
  {_yes_no("o_custkey", 3, 31, "StatementIncludesRisksAssessment")},
  {_yes_no("o_orderkey", 4, 37, "StatementIncludesDueDiligence")},
  {_yes_no("o_custkey", 5, 29, "StatementIncludesTraining")},
  {_yes_no("o_orderkey", 6, 53, "StatementIncludesGoals")},
  CASE WHEN o_orderkey % 2 = 0 THEN 'forced labour' ELSE NULL END AS Risk1,
  CASE WHEN o_orderkey % 3 = 0 THEN 'recruitment' ELSE NULL END AS Risk2,
  CASE WHEN o_orderkey % 5 = 0 THEN 'migrant workers' ELSE NULL END AS Risk3
FROM {{orders}}""",
    "uk_registry": f"""
SELECT 'Company ' || CAST(c_custkey AS STRING) AS CompanyName,
  CASE WHEN c_custkey % 37 = 0 THEN NULL ELSE ' ' || CAST(c_custkey AS STRING) END AS CompanyNumber,
  CASE WHEN c_custkey % 4 = 0 THEN '' ELSE CAST(c_custkey AS STRING) || ' High St' END AS RegAddress_AddressLine1,
  CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'Unit ' || CAST(c_nationkey AS STRING) END AS RegAddress_AddressLine2,
  CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE 'Town ' || CAST(c_nationkey AS STRING) END AS RegAddress_PostTown,
  CASE WHEN c_custkey % 5 = 0 THEN '' ELSE 'County' END AS RegAddress_County,
  n_name AS RegAddress_Country,
  CASE WHEN c_custkey % 7 = 0 THEN '' ELSE 'PC' || CAST(c_nationkey AS STRING) END AS RegAddress_PostCode,
  CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN 'Liquidation'
       ELSE 'Active' END AS CompanyStatus,
  CASE WHEN c_custkey % 10 = 0
       THEN CAST(c_custkey % 28 + 1 AS STRING) || '/0' || CAST(c_custkey % 9 + 1 AS STRING) || '/2019'
       WHEN c_custkey % 10 = 1 THEN '31/31/2020' ELSE NULL END AS DissolutionDate,
  CASE WHEN c_custkey % 9 = 0 THEN NULL
       ELSE CAST(c_custkey % 28 + 1 AS STRING) || '/' || CAST(c_custkey % 12 + 1 AS STRING) || '/'
            || CAST(1950 + c_custkey % 45 AS STRING) END AS IncorporationDate,
  CASE WHEN c_custkey % 6 = 0 THEN NULL WHEN c_custkey % 6 = 1 THEN 'x'
       ELSE CAST(c_custkey % 4 AS STRING) END AS Mortgages_NumMortCharges
FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey""",
    "au_statements": f"""
SELECT o_orderkey AS statement_seq,
  CAST(o_custkey AS STRING) AS idx,
  CASE WHEN o_orderkey % 97 = 0 THEN '31-12-2020' ELSE {_ISO.format("o_orderdate")} END AS period_start,
  CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE {_ISO.format("o_orderdate + INTERVAL 364 DAY")} END AS period_end,
  'Reporter ' || CAST(o_custkey AS STRING) || ' ' AS reporting_entities,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN ''
       WHEN o_orderkey % 3 = 0 THEN CAST(o_custkey AS STRING)
       WHEN o_orderkey % 3 = 1 THEN CAST(o_custkey AS STRING) || ', ' || CAST(o_custkey * 7 % 1000 AS STRING)
       ELSE CAST(o_custkey AS STRING) || ',' || CAST(o_custkey * 3 % 777 AS STRING) || ' , '
            || CAST(o_orderkey % 500 AS STRING) END AS abn,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE '100-150M' END AS annual_revenue,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'https://r.example.org/' || CAST(o_orderkey AS STRING) END AS statement_url,
  CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE '/' || CAST(o_orderkey AS STRING) || '.pdf' END AS pdf_url,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE 'Mining, Energy' END AS industry_sectors,
  CASE WHEN o_orderkey % 8 = 0 THEN NULL WHEN o_orderkey % 8 = 1 THEN 'Australia, Japan'
       WHEN o_orderkey % 8 = 2 THEN 'Australia, Japan, Canada' ELSE 'Australia' END AS headquartered_countries
FROM {{orders}}""",
    "au_registry": f"""
SELECT c_custkey * 2 AS registry_seq, 'Company ' || CAST(c_custkey AS STRING) || ' Pty Ltd' AS Company_Name,
  CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE CAST(c_custkey AS STRING) END AS ABN,
  CASE WHEN c_custkey % 4 = 0 THEN 'Deregistered' WHEN c_custkey % 23 = 0 THEN NULL ELSE 'Registered' END AS Status,
  CASE WHEN c_custkey % 8 = 0 THEN 'not known'
       ELSE CAST(1960 + c_custkey % 50 AS STRING) || '-0' || CAST(c_custkey % 9 + 1 AS STRING) || '-15' END
    AS Date_of_Registration,
  CASE WHEN c_custkey % 4 = 0 THEN '2015-06-30' ELSE NULL END AS Date_of_Deregistration,
  CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'Y' END AS Current_Name_Indicator
FROM {{customer}}
UNION ALL
SELECT c_custkey * 2 + 1, 'Former ' || CAST(c_custkey AS STRING),
  CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE ' ' || CAST(c_custkey AS STRING) END,
  'Registered', '1999-01-01', NULL,
  CASE WHEN c_custkey % 5 = 0 THEN 'Y' WHEN c_custkey % 5 = 1 THEN NULL ELSE 'N' END
FROM {{customer}}
UNION ALL
SELECT c_custkey * 2 + 1000000000, 'Old ' || CAST(c_custkey AS STRING),
  CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE CAST(c_custkey AS STRING) END,
  'Registered', '1998-01-01', NULL, CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE 'N' END
FROM {{customer}}""",
    "ca_statements": f"""
SELECT o_orderkey AS statement_seq,
  CASE WHEN o_orderkey % 47 = 0 THEN NULL WHEN o_orderkey % 43 = 0 THEN ''
       ELSE 'Org ' || CAST(o_orderkey % 5000 AS STRING) || chr(10) END AS organization,
  'Report (' || CAST(year(o_orderdate) AS STRING) || ')' AS title,
  CASE WHEN o_orderkey % 31 = 0 THEN 'unknown' WHEN o_orderkey % 37 = 0 THEN NULL
       ELSE CAST(year(o_orderdate) + 22 AS STRING) END AS year,
  CASE WHEN o_orderkey % 3 = 0 THEN ' FR ' ELSE 'En' END AS language,
  CASE WHEN o_orderkey % 6 = 0 THEN NULL
       WHEN o_orderkey % 4 = 0 THEN 'Maple ' || CAST(o_custkey AS STRING)
       WHEN o_orderkey % 4 = 1 THEN 'MAPLE ' || CAST(o_custkey AS STRING) || '  Co., Ltd.'
       WHEN o_orderkey % 4 = 2 THEN 'maple ' || CAST(o_custkey AS STRING) || ' inc'
       ELSE 'Société Maple-' || CAST(o_custkey AS STRING) || ' Ltée' END AS parent_company,
  CASE WHEN o_orderkey % 5 = 0 THEN 'Sub A, Sub B' ELSE NULL END AS subsidiary_companies,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'https://ps.example.ca/' || CAST(o_orderkey AS STRING) || '.pdf' END
    AS pdf_url,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE 'https://ps.example.ca/' || CAST(o_orderkey AS STRING) END
    AS statement_url,
  CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE 'Sector ' || o_orderpriority END AS industry_sector
FROM {{orders}}""",
    "ca_registry": f"""
SELECT CAST(c_custkey AS STRING) AS idx_text, c_custkey AS idx,
  CASE WHEN c_custkey % 29 = 0 THEN NULL
       WHEN c_custkey % 5 = 0 THEN ' Maple ' || CAST(c_custkey AS STRING) || ' Inc.'
       WHEN c_custkey % 5 = 1 THEN 'Maple ' || CAST(c_custkey AS STRING) || ' Ltd'
       WHEN c_custkey % 5 = 2 THEN 'Maple ' || CAST(c_custkey AS STRING)
       WHEN c_custkey % 5 = 3 THEN 'Société Maple-' || CAST(c_custkey AS STRING) || ' Ltée'
       ELSE 'Maple ' || CAST(c_custkey % 50 AS STRING) || ' Corporation' END AS business_name,
  CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE ' ' || CAST(c_custkey AS STRING) END AS business_id_no,
  CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 7 < 3 THEN ' on ' WHEN c_custkey % 7 = 3 THEN 'QC'
       WHEN c_custkey % 7 = 4 THEN 'mb' ELSE 'Bc' END AS prov_terr,
  CASE WHEN c_custkey % 8 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN 'Inactive' ELSE 'Active' END AS status,
  CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE CAST(c_custkey % 90 AS STRING) END AS derived_NAICS,
  CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE CAST(c_custkey % 250 AS STRING) END AS total_no_employees
FROM {{customer}}""",
    "register": """
SELECT o_orderkey AS IDX,
  ' ' || CAST(CAST(o_orderdate AS DATE) AS STRING) AS PeriodStart,
  CASE WHEN o_orderkey % 3 = 0 THEN '  ' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) || chr(9) END AS PeriodEnd,
  CASE WHEN o_orderkey % 2 = 0 THEN 'Single' ELSE 'Joint ' END AS Type,
  CASE WHEN o_orderkey % 10 < 6 THEN 'Australia' WHEN o_orderkey % 10 = 6 THEN 'Japan'
       WHEN o_orderkey % 10 = 7 THEN 'New Zealand' WHEN o_orderkey % 10 = 8 THEN ' ' ELSE 'Peru' END
    AS HeadquarteredCountries,
  'Reporter ' || CAST(o_custkey AS STRING) AS ReportingEntities,
  CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE CAST(o_custkey AS STRING) END AS ABN,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL
       ELSE 'https://modernslaveryregister.gov.au/statements/' || CAST(o_custkey AS STRING) || '/' END AS Link
FROM {orders}""",
    "register_pages": """
SELECT c_custkey AS page_id,
  'https://modernslaveryregister.gov.au/statements/' || CAST(c_custkey AS STRING) || '/' AS url,
  '<html><body><h2>Statement</h2>' ||
  CASE WHEN c_custkey % 6 = 0 THEN '<div id="the-statement-file"><p>x</p><iframe src="/statements/'
            || CAST(c_custkey AS STRING) || '/pdf/"></iframe></div>'
       WHEN c_custkey % 6 = 1 THEN '<iframe src="/about"></iframe><iframe src="https://cdn.example.org/'
            || CAST(c_custkey AS STRING) || '.PDF"></iframe>'
       WHEN c_custkey % 6 = 2 THEN '<a class="au-btn" href="/more">More</a><a class="big au-btn" href="/get/'
            || CAST(c_custkey AS STRING) || '"> Download </a>'
       WHEN c_custkey % 6 = 3 THEN '<a href="/home">Home</a><a href="https://f.example.org/'
            || CAST(c_custkey AS STRING) || '.pdf">File</a>'
       WHEN c_custkey % 6 = 4 THEN '<a href="/pdf/' || CAST(c_custkey AS STRING) || '">Old file</a>'
       ELSE '<p>Nothing &amp; no one</p>' END || '</body></html>' AS html
FROM {customer}""",
    "linked_pages": """
SELECT page_id, url, html || CASE WHEN page_id % 3 = 0 THEN '<p><a href="/files/' || CAST(page_id AS STRING) || '.pdf">Report</a> <a name="x">none</a></p>' ELSE '' END AS html
FROM {pages}""",
    "search_pages": """
SELECT s_suppkey AS page_id, 'https://www.example.ca/cnt/rslts-en.aspx?pn=' || CAST(s_suppkey AS STRING) AS url,
  '<table><tr><th>Title</th></tr><tr><td><a href="dtls-en.aspx?d=PS&amp;i=' || CAST(s_suppkey % 40 AS STRING)
  || '">A</a> <a href="dtls-en.aspx?d=PS&amp;i=9999">B</a></td></tr><tr><td><a href="other.aspx?d=PS&amp;i=5">C</a></td></tr>'
  || '<tr><td><a name="x">no link</a><a href="/cnt/dtls-en.aspx?d=PS&amp;i=' || CAST(s_suppkey AS STRING)
  || '">D</a><br></td></tr></table>' AS html
FROM {supplier}""",
    "statement_pages": """
SELECT c_custkey AS page_id, 'https://www.example.ca/cnt/dtls-en.aspx?d=PS&i=' || CAST(c_custkey AS STRING) AS url,
  '<!DOCTYPE html><html' || CASE WHEN c_custkey % 5 = 0 THEN ' lang="fr-CA"' WHEN c_custkey % 5 = 1 THEN ' lang="en"' ELSE '' END
  || '><head><title>Site - ' || CASE WHEN c_custkey % 7 = 0 THEN c_name || ' page - Library' ELSE 'x' END
  || '</title><script>var t="</p>2029";</script></head><body><!-- 2030 francais -->'
  || CASE WHEN c_custkey % 7 = 0 THEN '' WHEN c_custkey % 7 = 1 THEN '<h2>Search menu</h2><h2>' || c_name || ' plan</h2>'
     WHEN c_custkey % 7 = 2 THEN '<h2>Language</h2><h2> ' || c_name || ' <b>(' || CAST(2021 + c_custkey % 4 AS STRING) || ')</b></h2>'
     WHEN c_custkey % 7 = 3 THEN '<h2>' || c_name || ' - Modern slavery report (' || CAST(2021 + c_custkey % 4 AS STRING) || ')</h2>'
     ELSE '<h2>' || c_name || ' Inc. (' || CAST(2021 + c_custkey % 4 AS STRING) || ')</h2>' END
  || '<p>Reporting year: ' || CAST(2019 + c_custkey % 6 AS STRING) || ' and year 2022</p>'
  || '<h3>Subject</h3> <p>-</p><ul><li><a href="#">'
  || CASE WHEN c_custkey % 3 = 0 THEN 'Manufacturing' WHEN c_custkey % 3 = 1 THEN 'Utilities' ELSE 'Other things' END
  || '</a></li><li><a>Food Manufacturing plants</a></li><li><a> SCALCA </a></li><li><a>Retail trade</a></li>'
  || CASE WHEN c_custkey % 2 = 0 THEN '<li><a>Annual Reports: 2024</a></li>' ELSE '<li><a>Fighting Against Forced Labour Act</a></li>' END
  || '</ul>'
  || CASE WHEN c_custkey % 4 = 0 THEN '' ELSE '<h3>Authors</h3><ul><li><a>' || c_name || ', author.</a></li>'
     || CASE WHEN c_custkey % 4 = 1 THEN '<li><a>Sub ' || CAST(c_custkey AS STRING) || ', author.</a></li><li><a>Twin &amp; Co</a></li>' ELSE '' END || '</ul>' END
  || '<h3>Publishers</h3><ul><li>none</li>' || CASE WHEN c_custkey % 6 = 0 THEN '' ELSE '<li> ' || c_mktsegment || ' : ' || c_name || '</li><li>X : Y</li>' END || '</ul>'
  || '<h3>Resource</h3><p>' || CASE WHEN c_custkey % 8 = 0 THEN ' ' ELSE 'Report ' END || '</p>'
  || CASE WHEN c_custkey % 9 = 0 THEN '<a href="/doc.PDF">File</a>' WHEN c_custkey % 9 = 1 THEN '<a href="/get?f=pdf&amp;n=1">Get</a>'
     WHEN c_custkey % 9 = 2 THEN '' WHEN c_custkey % 9 = 3 THEN '<a href="/b.pdf">x</a><a href="/fr.docx?dl=1">Accès en ligne</a>'
     ELSE '<a href="/b.pdf">x</a><a href="/' || CAST(c_custkey AS STRING) || '.pdf"><span>Online access</span></a>' END
  || '</body></html>' AS html
FROM {customer}""",
    "ca_records": """
SELECT c_custkey AS page_id,
  CASE WHEN c_custkey % 4 = 0 THEN c_name || ' GmbH' WHEN c_custkey % 4 = 1 THEN c_name || ' AG (2024)'
       WHEN c_custkey % 4 = 2 THEN c_name || ' Pty Ltd Australia' ELSE c_name END AS title,
  CASE WHEN c_custkey % 3 = 0 THEN 'Holding B.V. Amsterdam' WHEN c_custkey % 3 = 1 THEN '' ELSE NULL END AS organization,
  CASE WHEN c_custkey % 5 = 0 THEN 'Parent Corp. of New York' WHEN c_custkey % 5 = 1 THEN 'Nippon K.K. Tokyo' ELSE NULL END
    AS parent_company,
  CASE WHEN c_custkey % 10 = 0 THEN 'Norway' ELSE NULL END AS company_country
FROM {customer}""",
    "raw_records": """
SELECT c_custkey AS page_id, 'https://s.example.org/' || CAST(c_custkey AS STRING) AS url,
  CASE WHEN c_custkey % 3 = 0 THEN '  ' WHEN c_custkey % 3 = 1 THEN ' ' || c_name || chr(10) ELSE NULL END AS title,
  CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 4 = 1 THEN '' ELSE '/' || c_mktsegment || '.pdf ' END AS pdf_url,
  CASE WHEN c_custkey % 5 = 0 THEN CAST(c_custkey % 3 AS INT) ELSE NULL END AS pages
FROM {customer}""",
    "urls": """
SELECT c_custkey AS idx,
  CASE WHEN c_custkey % 6 = 0 THEN 'https://a.example.org/x/Report' || CAST(c_custkey AS STRING) || '.pdf'
       WHEN c_custkey % 6 = 1 THEN ' https://a.example.org/view?id=' || CAST(c_custkey AS STRING)
       WHEN c_custkey % 6 = 2 THEN 'not a url' WHEN c_custkey % 6 = 3 THEN '# note'
       WHEN c_custkey % 6 = 4 THEN '   ' ELSE '//b.example.org/c/' || CAST(c_custkey AS STRING) || '.PDF' END AS value,
  CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_name END AS document_name
FROM {customer}""",
    "relative_urls": """
SELECT c_custkey AS idx, 'https://www.example.ca/cnt/rsrcs/ctlg?x=1' AS base,
  CASE WHEN c_custkey % 8 = 0 THEN 'dtls-en.aspx?i=' || CAST(c_custkey AS STRING)
       WHEN c_custkey % 8 = 1 THEN '/a/' || CAST(c_custkey AS STRING)
       WHEN c_custkey % 8 = 2 THEN '../up/' || CAST(c_custkey AS STRING)
       WHEN c_custkey % 8 = 3 THEN '//cdn.example.org/' || CAST(c_custkey AS STRING)
       WHEN c_custkey % 8 = 4 THEN '?q=' || CAST(c_custkey AS STRING)
       WHEN c_custkey % 8 = 5 THEN 'http://o.example.org/' || CAST(c_custkey AS STRING)
       WHEN c_custkey % 8 = 6 THEN './s/../t/' || CAST(c_custkey AS STRING) || '#top' ELSE '' END AS url
FROM {customer}""",
    "responses": """
SELECT 'src_' || CAST(conv_id AS STRING) AS source_id, CAST(turn + 1 AS INT) AS page_number, 'analysis' AS kind,
  'PAGE_ANALYSIS:' || chr(10) || '- should_parse: ' || CASE WHEN (conv_id + turn) % 5 = 4 THEN 'false' ELSE 'TRUE' END || chr(10)
  || '- has_text: ' || CASE WHEN (conv_id + turn) % 11 = 7 THEN 'false' ELSE 'true' END || chr(10)
  || '- has_tables: ' || CASE WHEN (conv_id + turn) % 3 = 0 THEN 'true' ELSE 'no' END || chr(10)
  || '- has_figures: ' || CASE WHEN (conv_id + turn) % 2 = 0 THEN 'true' ELSE 'false' END || chr(10)
  || CASE WHEN turn % 3 = 2 THEN '- has_signatures: false' || chr(10) || 'has_signatures: true' ELSE '- has_signatures: false' END AS response
FROM {conversations}
UNION ALL
SELECT 'src_' || CAST(conv_id AS STRING), CAST(turn + 1 AS INT), 'text',
  CASE WHEN (conv_id + turn) % 13 = 12 THEN '[TABLE_1]' ELSE
  '# Page ' || CAST(turn AS STRING) || chr(10) || chr(10) || text || chr(10) || '[TABLE_1]' || chr(10) || chr(10) || chr(10) || chr(10)
  || '[FIGURE_1] and [TABLE_2] [TABLE_2]' || chr(10) || '[FIGURE_7][SIGNATURE_1]' || chr(10) END
FROM {conversations}
UNION ALL
SELECT 'src_' || CAST(conv_id AS STRING), CAST(turn + 1 AS INT), 'tables',
  'note' || chr(10) || 'TABLE_1' || chr(10) || '| a$1 | b |' || chr(10) || '| ' || CAST(conv_id AS STRING) || ' | 2 |' || chr(10) || chr(10)
  || 'TABLE_2' || chr(10) || CASE WHEN conv_id % 2 = 0 THEN 'NOT_INFORMATIVE' ELSE ' see TABLE_1 ' END || chr(10) || 'TABLE_3' || chr(10) || '  '
  || CASE WHEN conv_id % 3 = 0 THEN chr(10) || 'TABLE_1' || chr(10) || 'later' ELSE '' END
FROM {conversations}
UNION ALL
SELECT 'src_' || CAST(conv_id AS STRING), CAST(turn + 1 AS INT), 'figures',
  'FIGURE_1' || chr(10) || '**Chart ' || CAST(turn AS STRING) || '**' || chr(10) || '- item' || chr(10)
FROM {conversations}
UNION ALL
SELECT 'src_' || CAST(conv_id AS STRING), CAST(turn + 1 AS INT), 'detection',
  'SIGNATURE_DETECTION:' || chr(10) || '- has_signatures: ' || CASE WHEN turn % 2 = 0 THEN 'true' ELSE 'false' END || chr(10)
  || '- signature_count: ' || CAST(turn % 4 AS STRING) || chr(10) || '- confidence: '
  || CASE WHEN conv_id % 3 = 0 THEN 'High' WHEN conv_id % 3 = 1 THEN 'medium' ELSE 'unsure' END || chr(10) || chr(10)
  || CASE WHEN conv_id % 4 = 0 THEN '' ELSE 'SIGNATURE_ANALYSIS:' || chr(10) END || 'SIGNATURE_1:' || chr(10)
  || '- signature_type: Handwritten' || chr(10) || '- is_image: true' || chr(10) || '- is_scanned: false' || chr(10)
  || '- signature_block_format: formal' || chr(10) || 'SIGNATURE_2:' || chr(10) || '- is_scanned: true'
FROM {conversations}
UNION ALL
SELECT 'src_' || CAST(conv_id AS STRING), CAST(turn + 1 AS INT), 'extraction',
  'Preamble' || chr(10) || 'SIGNATORY_TEXT_1:' || chr(10) || 'Jane  Smith' || CAST(conv_id AS STRING) || '*  ' || chr(10) || '- ignored' || chr(10)
  || 'Managing Director' || chr(10) || chr(10) || CASE WHEN turn % 4 = 0 THEN 'Signatory_Text_2:' || chr(10) || 'Acme Ltd' || chr(10) ELSE '' END
  || CASE WHEN conv_id % 2 = 0 THEN 'DATE_INFORMATION:' || chr(10) ELSE '' END || 'DATE_1:' || chr(10)
  || '- raw_date_text: ' || CASE WHEN conv_id % 5 = 0 THEN '' WHEN conv_id % 5 = 1 THEN '15 March 2024' WHEN conv_id % 5 = 2 THEN '03/04/2024'
     WHEN conv_id % 5 = 3 THEN '25/12/2024' ELSE 'soon: ' || role END || chr(10)
  || '- associated_signature: 1' || chr(10) || CASE WHEN conv_id % 7 = 0 THEN '- standardized_date: 2024-03-15x' || chr(10) ELSE '' END
  || '- date_confidence: high'
FROM {conversations}""",
    "four_responses": """
SELECT 'src_' || CAST(conv_id AS STRING) AS source_id, CAST(turn + 1 AS INT) AS page_number,
  'has_signatures: ' || CASE WHEN turn % 2 = 0 THEN 'True' ELSE 'no' END || chr(10) || 'signature_count: '
  || CASE WHEN conv_id % 4 = 3 THEN 'some' ELSE CAST(turn + 1 AS STRING) || ' of 90' END || chr(10)
  || 'confidence: ' || CASE WHEN conv_id % 2 = 0 THEN 'HIGH' ELSE 'low' END AS detection,
  'signature_type: ' || CASE WHEN conv_id % 4 = 0 THEN 'Typed' WHEN conv_id % 4 = 1 THEN 'stamp' ELSE 'typed or Handwritten' END
  || chr(10) || 'is_image: ' || CASE WHEN conv_id % 3 = 0 THEN 'true' ELSE 'false' END || chr(10) || 'is_scanned: True'
    AS sig_analysis,
  CASE WHEN conv_id % 4 = 0 THEN ' plain answer ' || role || chr(10) ELSE 'x SIGNATORY_TEXT_1:' || chr(10) || 'A. Person' || CAST(turn AS STRING)
    || chr(10) || CASE WHEN conv_id % 4 = 1 THEN 'SIGNATORY_TEXT_2: other' ELSE 'CEO ' END END AS sig_text,
  CASE WHEN conv_id % 3 = 1 THEN 'raw_date_text: ' ELSE 'raw_date_text: 5 May 2024' END || chr(10) || 'standardized_date: '
    || CASE WHEN conv_id % 5 = 0 THEN '[YYYY-MM-DD format if determinable]' ELSE '2024-05-05' END AS sig_dates
FROM {conversations}""",
    "person_responses": """
SELECT 'src_' || CAST(conv_id AS STRING) AS source_id, CAST(turn + 1 AS INT) AS page_number,
  'HAS_SIGNATURES: ' || CASE WHEN (conv_id + turn) % 3 = 0 THEN 'Yes' ELSE 'no' END || chr(10) || 'SIGNATURE_COUNT: '
  || CASE WHEN turn % 2 = 0 THEN '2' ELSE 'two' END || chr(10) || 'SIGNATURE_TYPE: Typed' || chr(10) || 'IS_IMAGE: '
  || CASE WHEN conv_id % 2 = 0 THEN 'yes' ELSE 'no' END || chr(10) || 'IS_SCANNED: no' || chr(10) || 'CONFIDENCE: High' AS detection,
  CASE WHEN (conv_id + turn) % 9 = 6 THEN 'NO_SIGNATURES_FOUND' ELSE 'SIGNATORY_1:' || chr(10) || 'NAME: Ann ' || CAST(conv_id AS STRING) || chr(10)
  || 'TITLE: ' || CASE WHEN turn % 2 = 0 THEN 'CEO' ELSE '' END || chr(10) || 'COMPANY: Acme: North' || chr(10) || 'DATE: '
  || CASE WHEN conv_id % 4 = 0 THEN '3 May 2024' WHEN conv_id % 4 = 1 THEN 'May 3rd, 2024' WHEN conv_id % 4 = 2 THEN '' ELSE 'someday' END || chr(10)
  || 'SIGNATORY_2:' || chr(10) || 'NAME: Bob' END AS extraction
FROM {conversations}""",
    "delivered_responses": """
SELECT 'src_' || CAST(conv_id AS STRING) AS source_id, CAST(turn + 1 AS INT) AS page_number, 'text' AS kind, 'first ' || role AS response, 1 AS arrival
FROM {conversations}
UNION ALL
SELECT 'src_' || CAST(conv_id AS STRING), CAST(turn + 1 AS INT), 'text', CASE WHEN conv_id % 3 = 0 THEN 'a second ' ELSE 'first ' END || role, 2
FROM {conversations} WHERE conv_id % 3 < 2
UNION ALL
SELECT 'src_' || CAST(conv_id AS STRING), CAST(turn + 1 AS INT), 'tables', CASE WHEN turn % 3 = 0 THEN NULL ELSE 'TABLE_1' END, 1 + CAST(turn % 3 AS INT)
FROM {conversations} WHERE turn % 2 = 0""",
    "url_ranges": """
SELECT s_suppkey AS range_id,
  CASE WHEN s_suppkey % 23 = 7 THEN NULL WHEN s_suppkey % 6 = 5 THEN 'https://www.example.ca/all?n=' || CAST(s_nationkey AS STRING)
       ELSE 'https://www.example.ca/rslts-en.aspx?nb=50&n=' || CAST(s_nationkey AS STRING) || '&pn={{page}}' END AS template,
  CASE WHEN s_suppkey % 19 = 3 THEN NULL ELSE s_suppkey % 8 - 1 END AS first,
  s_suppkey % 8 - 1 + CASE WHEN s_suppkey % 50 = 1 THEN 120 ELSE s_suppkey % 9 - 2 END AS last
FROM {supplier}""",
    "signer_pages": """
SELECT doc_id, CAST(1 AS INT) AS page_number, text
  || CASE WHEN doc_id % 7 = 0 THEN chr(10) || 'Signed by John Smith' || chr(10) || '• on behalf' || chr(10) || 'Title:  Director of Trade'
     WHEN doc_id % 7 = 1 THEN chr(13) || chr(10) || 'firmado por Juan Pérez' || chr(10) || 'cargo - Gerente  General' || chr(10) || 'Signature'
     WHEN doc_id % 7 = 2 THEN chr(10) || 'Position: Chief Officer' || chr(10) || 'Firma: ANA MARÍA LÓPEZ'
     WHEN doc_id % 7 = 3 THEN chr(10) || 'Manager Maria Torres Ruiz' || chr(10) || 'Manager Maria Torres Ruiz' ELSE '' END AS text
FROM {documents}""",
    "detections": """
SELECT 'pdf_' || CAST(l_suppkey AS STRING) AS source_id, l_orderkey AS page_number, l_linenumber AS xmin, l_partkey AS ymin,
  l_linenumber + 10 AS xmax, l_partkey + 20 AS ymax, l_extendedprice AS box_area, l_discount * 10 AS confidence, CAST(0 AS INT) AS class_id
FROM {lineitem}""",
}

# The two responses of a page arrive as two tables, and either may lack a page.
for _name, _field, _rest in (("person_detections", "detection", "(page_number + n) % 7 <> 6"), ("person_extractions", "extraction", "(page_number + n) % 8 <> 4")):
    INPUTS[_name] = f"""SELECT source_id, page_number, {_field} AS response
FROM (SELECT *, CAST(substring(source_id, 5) AS INT) AS n FROM ({INPUTS["person_responses"]}) p) q WHERE {_rest}"""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores before work that is heavy per row.

    Only for a scan with fewer splits than cores, such as one small file; a
    table of many files is left as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def load(spark: SparkSession, folder: str, name: str, heavy: bool = False, **given: DataFrame) -> DataFrame:
    """A derived input as a DataFrame over the tables in ``folder``, or over ``given`` ones such as streams."""
    sql = INPUTS[name]
    used = {t: given.get(t) or table(spark, folder, t) for t in TABLES if "{" + t + "}" in sql}
    if heavy:
        used = {t: spread(df) for t, df in used.items()}
    return spark.sql(sql, **used)


def oracle_source(name: str) -> str:
    """The same input as a SQL subquery over tables registered by name."""
    return "(" + INPUTS[name].format(**{t: t for t in TABLES}) + ")"
