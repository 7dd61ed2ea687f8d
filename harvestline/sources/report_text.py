"""Statistical-report page text -> price rows.

Input is one row per page (document id, page text); PDF decoding is outside
the library. Lines are produced with ``posexplode(split(text, '\\n'))`` and
parsed with built-in regex functions, so the work is spread over all pages.
Regex classes use ASCII ``[0-9]`` (Python's ``\\d`` also accepts other
Unicode digits; such digits do not occur in these reports).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestline.functions import try_date

# The six zones (column order of the zonal table) and the
# header spellings used to recognise a zonal page.
ZONES = ["North Central", "North East", "North West", "South East", "South South", "South West"]
ZONE_HEADER_PATTERNS = ["NORTH CEN", "NORTH EAST", "NORTH WEST", "SOUTH EAST", "SOUTH SOUTH", "SOUTH WEST"]
# Item names that mark a national summary page.
NATIONAL_ITEMS = ["Beans", "Garri", "Rice"]
# The price token and month abbreviations of report file names.
PRICE_PATTERN = r"[0-9,]+\.[0-9]{2}"
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
CATALOGUE_LINK = r"/catalog/162/download/([0-9]+)([^\"'<> ]*)"
# Markers of item tables and lines to skip are 'Item Label', 'APPENDIX',
# 'NORTH' and 'Average of', in the functions below.
MIN_PAGE_CHARS = 100
MIN_LINE_CHARS = 20


def _has(text: Column, s: str) -> Column:
    return text.contains(s)


def classify_pages(df: DataFrame, text: str = "text") -> DataFrame:
    """Flag zonal and national pages; pages under 100 characters are skipped.

    zonal = at least 3 of the 6 zone headers (upper-cased text) and an item
    marker ('Item Label' or 'APPENDIX'); national = MoM and YoY markers and a
    known item. A page that is zonal is not also national.
    """
    t = F.col(text)
    up = F.upper(t)
    nospace = F.replace(t, F.lit(" "), F.lit(""))
    zone_hits = sum(_has(up, z).cast("int") for z in ZONE_HEADER_PATTERNS)
    zonal = (zone_hits >= 3) & (_has(t, "Item Label") | _has(t, "APPENDIX"))
    mom = _has(t, "MoM") | _has(nospace, "Month-on-Month")
    yoy = _has(t, "YoY") | _has(nospace, "Year-on-Year")
    items = F.lit(False)
    for it in NATIONAL_ITEMS:
        items = items | _has(t, it)
    national = ~zonal & mom & yoy & items
    return df.where(F.length(t) >= MIN_PAGE_CHARS).select(
        "*", zone_hits.alias("zone_headers"), zonal.alias("is_zonal"), national.alias("is_national")
    )


def _lines(df: DataFrame, text: str, keep: Sequence[str]) -> DataFrame:
    return df.select(*keep, F.posexplode(F.split(F.col(text), "\n")).alias("line_no", "line"))


def _name_and_prices(lines: DataFrame) -> DataFrame:
    """All price tokens of a line, and the (trimmed) text before the first."""
    line = F.col("line")
    with_p = lines.select("*", F.regexp_extract_all(line, F.lit(PRICE_PATTERN), 0).alias("_prices"))
    first = F.try_element_at(F.col("_prices"), F.lit(1))
    before = F.substring(line, F.lit(1), F.instr(line, first) - 1)
    name = F.when(F.size("_prices") > 0, F.regexp_replace(before, r"^\s+|\s+$", ""))
    return with_p.select("*", name.alias("commodity_name"))


def _valid_name(c: Column) -> Column:
    return (F.length(c) > 0) & ~c.rlike("^[0-9]+$")


def _to_number(c: Column) -> Column:
    return F.replace(c, F.lit(","), F.lit("")).cast("double")


def parse_zonal_lines(
    df: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), zones: Sequence[str] = ZONES
) -> DataFrame:
    """Zonal table lines: skip headers ('Item Label', 'NORTH', 'APPENDIX') and
    lines under 20 characters; need >= 6 prices; the name is the text before
    the first price; the first 6 prices map to the zones by position (S11, R3)."""
    line = F.col("line")
    lines = _lines(df, text, keep).where(
        ~line.contains("Item Label")
        & ~F.upper(line).contains("NORTH")
        & (F.length(line) >= MIN_LINE_CHARS)
        & ~line.contains("APPENDIX")
    )
    parsed = _name_and_prices(lines).where((F.size("_prices") >= len(zones)) & _valid_name(F.col("commodity_name")))
    zone_arr = F.array(*[F.lit(z) for z in zones])
    exploded = parsed.select(
        *keep, "line_no", "commodity_name", F.posexplode(F.slice("_prices", 1, len(zones))).alias("_pos", "_p")
    )
    return exploded.select(
        *keep,
        "line_no",
        "commodity_name",
        F.try_element_at(zone_arr, F.col("_pos") + 1).alias("zone"),
        _to_number(F.col("_p")).alias("price"),
    )


def parse_national_lines(
    df: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), lo: float = 50, hi: float = 50000
) -> DataFrame:
    """National summary lines: >= 2 prices, valid name; the current price is
    the last of the first 4 values lying in [lo, hi]; zone = 'National' (S12)."""
    line = F.col("line")
    lines = _lines(df, text, keep).where(
        ~line.contains("Item Label") & ~line.contains("Average of") & (F.length(line) >= MIN_LINE_CHARS)
    )
    parsed = _name_and_prices(lines).where((F.size("_prices") >= 2) & _valid_name(F.col("commodity_name")))
    vals = F.transform(F.slice("_prices", 1, 4), lambda p: _to_number(p))
    ok = F.filter(vals, lambda v: (v >= lo) & (v <= hi))
    current = F.try_element_at(ok, F.lit(-1))
    out = parsed.select(*keep, "line_no", "commodity_name", current.alias("price"))
    return out.where(F.col("price").isNotNull() & (F.col("price") != 0)).select(
        *keep, "line_no", "commodity_name", F.lit("National").alias("zone"), "price"
    )


def extract_prices(df: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Whole extractor: classify pages, parse zonal pages as zonal tables and
    national pages as national summaries (S10-S12)."""
    pages = classify_pages(df, text)
    z = parse_zonal_lines(pages.where("is_zonal"), text, keep)
    n = parse_national_lines(pages.where("is_national"), text, keep)
    return z.unionByName(n)


# Constants of the loaded report rows.
REPORT_UNIT = "KG"
REPORT_SOURCE = "NBS"


def read_report_files(spark: SparkSession, path: str) -> DataFrame:
    """(report_month, file, page, text) of the report files below ``path``, one text file a
    report, its pages parted by form feeds. The month is the last ``YYYY-MM`` in the file's
    path; files without one are left out. A report is read whole, by one task."""
    files = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
    name = F.col("_metadata.file_path")
    month = F.regexp_extract(name, r".*([0-9]{4}-(?:0[1-9]|1[0-2]))(?![0-9])", 1)
    dated = files.select(F.when(month != "", try_date(F.concat(month, F.lit("-01")))).alias("report_month"), name.alias("file"), "value")
    pages = dated.where("report_month is not null").select(
        "report_month", "file", F.posexplode(F.split("value", "\f")).alias("page", "text")
    )
    return pages


def report_rows(pages: DataFrame) -> DataFrame:
    """(commodity_name, unit, price, report_month, state) of all prices in report pages, in
    the raw layout but for its constants (S10-S13, K1)."""
    found = extract_prices(pages, "text", keep=["report_month", "file", "page"])
    return found.select(
        "commodity_name", F.lit(REPORT_UNIT).alias("unit"), "price", "report_month", F.col("zone").alias("state")
    )


def extract_links(
    df: DataFrame,
    html: str = "html",
    pattern: str = CATALOGUE_LINK,
    keep: Sequence[str] = ("page_id",),
) -> DataFrame:
    """All matches of ``pattern`` in the page: group 1 = resource id, group 2
    = the rest of the link (file name) (S13)."""
    ids = F.regexp_extract_all(F.col(html), F.lit(pattern), 1)
    rest = F.regexp_extract_all(F.col(html), F.lit(pattern), 2)
    z = df.select(*keep, F.arrays_zip(ids.alias("resource_id"), rest.alias("link_rest")).alias("_m"))
    return z.select(*keep, F.posexplode("_m").alias("link_no", "_l")).select(
        *keep, "link_no", "_l.resource_id", "_l.link_rest"
    )


def month_key(name: Column) -> Column:
    """'YYYY-MM' from the first 'MonYY' token in a file name, else NULL.

    The reference's expression only sees a month placed right after the slash;
    this finds it anywhere in the name (its evident intent)."""
    m = F.regexp_extract(name, r"(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)([0-9]{2})", 1)
    y = F.regexp_extract(name, r"(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)([0-9]{2})", 2)
    month_no = F.lpad((F.array_position(F.array(*[F.lit(x) for x in MONTHS]), m)).cast("string"), 2, "0")
    return F.when(F.length(m) > 0, F.concat(F.lit("20"), y, F.lit("-"), month_no))


def discover_reports(
    links: DataFrame,
    known: DataFrame,
    name_col: str = "link_rest",
    order: Sequence[str] = ("page_id", "link_no"),
) -> DataFrame:
    """(month_key, resource_id) of links whose month is not already known
    (S13, J8). ``known`` has a ``month_key`` column. When several links name
    the same month, the first in (page, position) order wins."""
    found = links.select(
        month_key(F.col(name_col)).alias("month_key"), "resource_id", *order
    ).where(F.col("month_key").isNotNull())
    new = found.join(known.select("month_key"), "month_key", "left_anti")
    first = F.min_by("resource_id", F.struct(*[F.col(c) for c in order]))
    return new.groupBy("month_key").agg(first.alias("resource_id"))
