"""Statement pages to records: rules over the elements of ``html.parse_pages``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank_to_null, bound, first_match, strip
from ..functions.urls import absolute_url, file_type
from .expand import head, rest
from .joins import registry_join

# Headings that belong to navigation, link labels, sectors and laws.
NAVIGATION = ["language", "search", "menu", "navigation", "breadcrumb"]
ACCESS_EN, ACCESS_FR = "Online access", "Accès en ligne"
SECTORS = [
    "Manufacturing", "Construction", "Retail trade", "Wholesale trade",
    "Transportation and warehousing", "Finance and insurance",
    "Professional, scientific and technical services", "Utilities",
    "Information and cultural industries", "Accommodation and food services",
    "Health care and social assistance", "Educational services",
    "Arts, entertainment and recreation", "Other services",
    "Public administration", "Mining, quarrying, and oil and gas extraction",
    "Agriculture, forestry, fishing and hunting",
]
YEAR_PATTERNS = [
    r"(?iuU)reporting year[:\s]+(\d{4})",
    r"(?iuU)year[:\s]+(\d{4})",
    r"(?U)\b(20\d{2})\b",
]
REGISTER_SITE = "https://modernslaveryregister.gov.au"

# Texts that point to a country; longer ones (over 3 characters) weigh 2, others 1.
COUNTRY_INDICATORS = {
    "Canada": [
        "Canada", "Canadian", "Ontario", "Quebec", "Alberta", "British Columbia", "B.C.",
        "Manitoba", "Saskatchewan", "Nova Scotia", "New Brunswick", "Newfoundland",
        "Prince Edward Island", "Northwest Territories", "Nunavut", "Yukon",
    ],
    "United States": [
        "USA", "U.S.", "United States", "American", "Delaware", "Nevada", "California",
        "New York", "Texas", "Florida", "Illinois", "Corp.", "LLC", "Inc.",
    ],
    "Netherlands": ["B.V.", "N.V.", "Netherlands", "Dutch", "Holland", "Amsterdam"],
    "United Kingdom": [
        "UK", "U.K.", "British", "England", "Scotland", "Wales", "London", "plc", "Limited",
    ],
    "Germany": ["GmbH", "AG", "German", "Germany", "Deutschland", "Berlin", "Munich"],
    "France": ["S.A.", "S.A.S.", "SARL", "French", "France", "Paris", "Lyon"],
    "Japan": ["K.K.", "Japanese", "Japan", "Tokyo", "Osaka", "Co., Ltd."],
    "Australia": ["Pty Ltd", "Australian", "Australia", "Sydney", "Melbourne"],
    "Switzerland": ["AG", "SA", "Swiss", "Switzerland", "Zurich", "Geneva"],
    "Sweden": ["AB", "Swedish", "Sweden", "Stockholm"],
}


# Elements of ``html.parse_pages`` that a rule reads.
NEEDS = {
    "title": ("title_tag", "h2"),
    "pdf_url": ("links",),
    "year": ("page_text",),
    "language": ("lang", "links", "all_text"),
    "statement_links": ("row_links",),
    "register_pdf_url": ("frames", "links"),
    "sections": ("sections",),
}


def needs(*rules: str) -> tuple[str, ...]:
    """The elements that these rules read together."""
    return tuple(dict.fromkeys(element for rule in rules for element in NEEDS[rule]))


def _first(items: Column, test) -> Column:
    return F.get(F.filter(items, test), 0)


def _section(heading: str, field: str) -> Column:
    """A field of the first section with exactly this heading."""
    return _first(F.col("sections"), lambda s: s["heading"] == heading)[field]


def title() -> Column:
    """Heading with a year, else the first that is not navigation, else the page title."""
    dated = _first(F.col("h2"), lambda t: F.regexp_like(t, F.lit(r"(?U)\b20\d{2}\b")))
    nav = "|".join(NAVIGATION)
    other = _first(F.col("h2"), lambda t: ~F.regexp_like(F.lower(t), F.lit(nav)))
    bare = F.regexp_replace("title_tag", r"(?dU)^.*?\s*-\s*", "")
    bare = F.regexp_replace(bare, r"(?dU)\s*-\s*.*?$", "")
    return F.nullif(F.coalesce(dated, other, F.when(F.length(bare) > 10, bare)), F.lit(""))


def pdf_url() -> Column:
    links = F.col("links")

    def labelled(label):
        return F.nullif(_first(links, lambda a: a["label"] == label)["href"], F.lit(""))

    ending = _first(links, lambda a: F.regexp_like(a["href"], F.lit(r"(?i)\.pdf$")))["href"]
    holding = _first(links, lambda a: F.regexp_like(a["href"], F.lit("(?i)pdf")))["href"]
    return F.coalesce(labelled(ACCESS_EN), labelled(ACCESS_FR), ending, holding)


def year(title_col: Column) -> Column:
    """Year in the title, else the latest 2020-2030 year of the first pattern that finds one."""
    in_text = [
        F.array_max(
            F.filter(
                F.transform(F.regexp_extract_all("page_text", F.lit(p), 1), lambda y: y.cast("int")),
                lambda y: y.between(2020, 2030),
            )
        )
        for p in YEAR_PATTERNS
    ]
    return F.coalesce(first_match(title_col, r"(?U)\b(20\d{2})\b").cast("int"), *in_text)


def organization(title_col: Column) -> Column:
    def shortened(title):
        name = F.regexp_replace(title, r"(?U)\s*\(20\d{2}\)\s*", "")
        name = F.regexp_replace(name, r"(?iudU)\s*-?\s*Modern Slavery.*", "")
        name = strip(F.regexp_replace(name, r"(?iudU)\s*-?\s*Statement.*", ""))
        return bound(name, lambda n: F.when((n != title) & (F.length(n) > 5), n))

    return bound(title_col, shortened)


def language() -> Column:
    lang = F.lower("lang")

    def marked(label, word):
        labelled = F.exists("links", lambda a: F.coalesce(a["label"] == label, F.lit(False)))
        return labelled | F.regexp_like("all_text", F.lit(rf"(?iuU)\b{word}\b"))

    return (
        F.when(F.contains(lang, F.lit("fr")), "fr")
        .when(F.contains(lang, F.lit("en")), "en")
        .when(marked(ACCESS_FR, "français"), "fr")
        .otherwise("en")
    )


def legal_fields() -> dict[str, Column]:
    subjects = _section("Subject", "anchors")
    law = "Fighting Against Forced Labour"
    laws = F.filter(
        subjects, lambda s: F.contains(s, F.lit(law)) & ~F.contains(s, F.lit(":"))
    )
    return {
        "reporting_law": F.get(laws, F.size(laws) - 1),
        "legal_framework": F.when(
            F.array_contains(subjects, "SCALCA"), "Supply Chains Act (SCALCA)"
        ),
        "statement_type": F.when(
            F.exists(subjects, lambda s: F.contains(s, F.lit("Annual Reports:"))), "mandatory"
        ),
    }


def sector_fields(subjects: Column) -> dict[str, Column]:
    """Known sectors and texts that contain one, each split into first and others."""
    sectors = F.filter(subjects, lambda s: s.isin(SECTORS))

    def contains_sector(s):
        found = F.contains(s, F.lit(SECTORS[0]))
        for sector in SECTORS[1:]:
            found = found | F.contains(s, F.lit(sector))
        return found

    subsectors = F.filter(subjects, lambda s: ~s.isin(SECTORS) & contains_sector(s))
    return {
        "industry_sector": head(sectors),
        "industry_sectors_additional": rest(sectors),
        "industry_subsector": head(subsectors),
        "industry_subsectors_additional": rest(subsectors),
    }


def company_fields() -> dict[str, Column]:
    authors = F.transform(
        _section("Authors", "anchors"), lambda a: F.regexp_replace(a, r"(?U),\s*author\.$", "")
    )
    publisher = _first(_section("Publishers", "items"), lambda t: F.contains(t, F.lit(":")))
    return {
        "parent_company": head(authors),
        "subsidiary_companies": rest(authors),
        "company_country": strip(F.substring_index(publisher, ":", 1)),
    }


def with_title(elements: DataFrame) -> DataFrame:
    return elements.withColumn("title", title())


def page_records(elements: DataFrame, jurisdiction: str, source_url: str = "url") -> DataFrame:
    """One cleaned record per page. Every page has at least a language, so none is empty."""
    base = with_title(elements).withColumn("pdf_url", pdf_url())
    fields = {
        "title": F.col("title"),
        "pdf_url": F.col("pdf_url"),
        "year": year(F.col("title")),
        "organization": organization(F.col("title")),
        "language": language(),
        "file_type": file_type(F.col("pdf_url")),
        **legal_fields(),
        **sector_fields(_section("Subject", "anchors")),
        **company_fields(),
        "document_type": F.nullif(_section("Resource", "paragraph"), F.lit("")),
    }
    raw = base.select("page_id", source_url, *[c.alias(n) for n, c in fields.items()])
    return _cleaned(raw, list(fields), source_url, jurisdiction)


def _cleaned(df: DataFrame, fields: list[str], source_url: str, jurisdiction: str) -> DataFrame:
    kinds = dict(df.dtypes)
    values = [blank_to_null(F.col(c)).alias(c) if kinds[c] == "string" else F.col(c) for c in fields]
    others = [c for c in df.columns if c not in fields and c != source_url]
    return df.select(
        *others, *values, F.col(source_url).alias("source_url"), F.lit(jurisdiction).alias("jurisdiction")
    )


def clean_records(df: DataFrame, fields: list[str], source_url: str, jurisdiction: str) -> DataFrame:
    """Strip text, drop blanks, drop empty records, add source and jurisdiction."""
    cleaned = _cleaned(df, fields, source_url, jurisdiction)
    any_value = F.lit(False)
    for c in fields:
        any_value = any_value | F.col(c).isNotNull()
    return cleaned.filter(any_value)


def has_required(df: DataFrame, fields: list[str]) -> Column:
    """All fields there and not empty; 0, '' and empty lists count as missing."""
    types = dict(df.dtypes)
    ok = F.lit(True)
    for name in fields:
        if name not in types:
            return F.lit(False)
        c, kind = F.col(name), types[name]
        if kind == "string":
            present = c != ""
        elif kind.startswith(("array", "map")):
            present = F.size(c) > 0
        elif kind == "boolean":
            present = c
        elif kind in ("date", "timestamp", "timestamp_ntz") or kind.startswith("struct"):
            present = c.isNotNull()
        else:
            present = c != 0
        ok = ok & F.coalesce(present, F.lit(False))
    return ok


def statement_links(elements: DataFrame, base_url: str) -> DataFrame:
    """Detail links of search pages, absolute, with their position."""
    links = elements.select(
        "page_id", "url", F.posexplode("row_links").alias("position", "href")
    ).filter(F.contains("href", F.lit("dtls-en.aspx")) & F.contains("href", F.lit("d=PS&i=")))
    return links.withColumn("statement_url", absolute_url(F.col("href"), F.lit(base_url)))


def register_pdf_url() -> Column:
    """PDF of a register page: file frame, PDF-like frame, download button, PDF link."""
    frames, links = F.col("frames"), F.col("links")
    in_file = _first(frames, lambda f: f["leads_file"] & (f["src"] != ""))["src"]
    like_pdf = _first(
        frames,
        lambda f: F.contains(F.lower(f["src"]), F.lit("pdf")) | F.contains(f["src"], F.lit("/statements/")),
    )["src"]
    button = _first(
        links,
        lambda a: F.array_contains(a["css"], "au-btn") & (F.lower(a["text"]) == "download") & (a["href"] != ""),
    )["href"]
    linked = _first(
        links, lambda a: F.contains(a["href"], F.lit("/pdf/")) | F.endswith(a["href"], F.lit(".pdf"))
    )["href"]
    found = F.coalesce(in_file, like_pdf, button, linked)
    return F.when(F.startswith(found, F.lit("/")), F.concat(F.lit(REGISTER_SITE), found)).otherwise(found)


def detected_country(text: Column, known: Column) -> Column:
    """Country with the highest indicator score, the first listed on ties, Canada without any.

    Plain column work: the table is fixed and small, so no join is needed. The text, which stands for rules over a
    whole page, is bound, since every indicator looks at it.
    """
    return F.coalesce(known, bound(text, _ranked_country))


def _ranked_country(text: Column) -> Column:
    def found(marks):
        return F.size(F.filter(F.array(*map(F.lit, marks)), lambda m: F.contains(text, m))) if marks else F.lit(0)

    # The default outranks every country that scores 0.
    ranked = [(F.lit(0), 1, "Canada")]
    for rank, (country, marks) in enumerate(COUNTRY_INDICATORS.items()):
        score = 2 * found([m for m in marks if len(m) > 3]) + found([m for m in marks if len(m) <= 3])
        ranked.append((score, -rank, country))
    scores = [
        F.struct(score.alias("score"), F.lit(rank).alias("rank"), F.lit(country).alias("country"))
        for score, rank, country in ranked
    ]
    return F.array_max(F.array(*scores))["country"]


def detect_country(df: DataFrame) -> DataFrame:
    present = [c for c in ("title", "organization", "statement_name", "parent_company") if c in df.columns]
    text = F.coalesce(F.concat_ws(" ", *[F.nullif(F.col(c), F.lit("")) for c in present]), F.lit(""))
    known = F.col("company_country") if "company_country" in df.columns else F.lit(None).cast("string")
    return df.withColumn("detected_country", detected_country(text, known))


def country_filter(df: DataFrame, country: str | None) -> DataFrame:
    """Records of one detected country, any case; no country means all records."""
    if not country:
        return df
    return detect_country(df).filter(F.lower("detected_country") == country.lower())


def register_with_pdf(register: DataFrame, pages: DataFrame) -> DataFrame:
    """Register rows with the PDF found on their page; rows without a page stay.

    Joined on the URL, and one PDF per URL is kept, so rows never multiply.
    """
    found = (
        pages.select(F.col("url").alias("_url"), register_pdf_url().alias("pdf_url"))
        .filter(F.col("pdf_url").isNotNull())
        .groupBy("_url").agg(F.min("pdf_url").alias("pdf_url"))
    )
    return registry_join(
        register, found, "statement_url", "_url", "_page", unique_right=True
    ).drop("_url")
