"""Board feeds: landed JSON pages of five platforms to one posting schema.

Input is one row per landed page (``schemas.PAYLOADS``), so a board with a
third of all postings is spread over many rows and tasks. Listings are
exploded map-side; only the two platforms with separate detail documents need
a join, and their listings pass the title filter before it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from openroles import schemas
from openroles.functions.dates import from_epoch, parse_posted, relative_date
from openroles.functions.html import html_blocks_to_text, html_to_text
from openroles.functions.rules import title_level
from openroles.functions.text import (
    canonical_url, first_non_empty, join_non_empty, let, strip, text_or_empty, url_hash,
)

PERMISSIVE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
ROOTS = {
    "greenhouse": schemas.GREENHOUSE, "lever": schemas.LEVER, "ashby": schemas.ASHBY,
    "smartrecruiters": schemas.SMARTRECRUITERS, "workday": schemas.WORKDAY,
}
POSTING_COLUMNS = (
    "title", "company", "location", "description", "job_url", "url_hash", "source",
    "posted_date", "source_job_id", "source_board", "scraped_at", "page_no", "pos",
)


def read_landed(spark: SparkSession, path: str, schema: str = schemas.PAYLOADS, fmt: str = "parquet") -> DataFrame:
    """Landed list pages, or details with ``schemas.DETAILS``, as Parquet or JSON lines."""
    return spark.read.schema(schema).format(fmt).load(path)


def normalize_postings(raw: DataFrame, html: bool = True) -> DataFrame:
    """The posting schema. Rows without a title or a URL are dropped.

    ``html=False`` skips the parser for descriptions known to be plain text.
    """
    url = canonical_url(raw["job_url"])
    description = raw["description"]
    kept = raw.withColumn("job_url", url).filter(
        (F.coalesce(F.col("title"), F.lit("")) != "") & (F.col("job_url") != ""))
    passed = [c for c in ("page_no", "pos", "ord") if c in raw.columns]
    return kept.select(
        strip(F.col("title")).alias("title"),
        strip(first_non_empty(F.col("company"), F.col("source_board"))).alias("company"),
        strip(text_or_empty(F.col("location"))).alias("location"),
        (html_to_text(description) if html else strip(text_or_empty(description)))
        .alias("description"),
        "job_url",
        url_hash(F.col("job_url")).alias("url_hash"),
        "source",
        "posted_date",
        text_or_empty(F.col("source_job_id").cast("string")).alias("source_job_id"),
        text_or_empty(F.col("source_board")).alias("source_board"),
        "scraped_at",
        *passed,
    )


def _pages(payloads: DataFrame, platform: str) -> DataFrame:
    return payloads.filter(F.col("platform") == platform)


def _listings(payloads: DataFrame, platform: str, items: str | None, delay: str | None = None) -> DataFrame:
    """One row per listing with its page and position.

    ``delay`` gives streamed pages a watermark. Pages without listings do not make time pass.
    """
    # Exploded rather than filtered: a filter goes below the projection and parses the page again for each condition.
    doc = F.from_json("payload", ROOTS[platform], PERMISSIVE)
    some = F.filter(F.array(doc if items is None else doc[items]), lambda a: F.size(a) > 0)
    parsed = _pages(payloads, platform).select(
        "identifier", "company", "base_url", "site", "page_no", "scraped_at", F.explode(some).alias("items"))
    if delay is not None:
        parsed = parsed.withWatermark("scraped_at", delay)
    return parsed.select(*[c for c in parsed.columns if c != "items"], F.posexplode("items").alias("pos", "item"))


def greenhouse(payloads: DataFrame) -> DataFrame:
    rows = _listings(payloads, "greenhouse", "jobs")
    return normalize_postings(rows.select(
        F.col("item.title").alias("title"), "company",
        F.col("item.location.name").alias("location"),
        F.col("item.content").alias("description"),
        F.col("item.absolute_url").alias("job_url"),
        F.lit("greenhouse_feed").alias("source"),
        parse_posted(F.col("item.updated_at")).alias("posted_date"),
        F.col("item.id").alias("source_job_id"),
        F.col("identifier").alias("source_board"), "scraped_at", "page_no", "pos",
    ))


def lever(payloads: DataFrame) -> DataFrame:
    rows = _listings(payloads, "lever", None)
    blocks = html_blocks_to_text(F.col("item.lists.content"))
    main = first_non_empty(F.col("item.descriptionPlain"), F.col("item.description"))
    return normalize_postings(rows.select(
        F.col("item.text").alias("title"), "company",
        F.col("item.categories.location").alias("location"),
        F.when(F.size("item.lists") > 0, F.concat(main, F.lit(" "), blocks))
        .otherwise(main).alias("description"),
        first_non_empty(F.col("item.hostedUrl"), F.col("item.applyUrl")).alias("job_url"),
        F.lit("lever_feed").alias("source"),
        F.coalesce(from_epoch(F.col("item.createdAt").try_cast("decimal(20,3)")),
                   parse_posted(F.col("item.createdAt"))).alias("posted_date"),
        F.col("item.id").alias("source_job_id"),
        F.col("identifier").alias("source_board"), "scraped_at", "page_no", "pos",
    ))


def ashby(payloads: DataFrame) -> DataFrame:
    rows = _listings(payloads, "ashby", "jobs").filter(
        F.coalesce(F.col("item.isListed"), F.lit(True)))
    places = F.concat(
        F.array(F.col("item.location")),
        F.coalesce(F.col("item.secondaryLocations.location"), F.array().cast("array<string>")))
    url = first_non_empty(F.col("item.jobUrl"), F.col("item.applyUrl"))
    return normalize_postings(rows.select(
        F.col("item.title").alias("title"), "company",
        join_non_empty(places, "; ").alias("location"),
        first_non_empty(F.col("item.descriptionHtml"), F.col("item.descriptionPlain"))
        .alias("description"),
        url.alias("job_url"), F.lit("ashby_feed").alias("source"),
        parse_posted(F.col("item.publishedAt")).alias("posted_date"),
        first_non_empty(F.col("item.id"), F.substring_index(canonical_url(url), "/", -1))
        .alias("source_job_id"),
        F.col("identifier").alias("source_board"), "scraped_at", "page_no", "pos",
    ))


def parsed_details(details: DataFrame, platform: str, schema: str, *passed: str) -> DataFrame:
    """The detail documents of a platform that parse."""
    doc = F.from_json("payload", schema, PERMISSIVE)
    # Exploded, not filtered, as pages are in _listings.
    parses = F.filter(F.array(doc), lambda d: d.isNotNull() & d["_corrupt_record"].isNull())
    return details.filter(F.col("platform") == platform).select(
        "identifier", "detail_key", *passed, F.explode(parses).alias("detail"))


def _smartrecruiters_listings(payloads: DataFrame, delay: str | None = None) -> DataFrame:
    rows = _listings(payloads, "smartrecruiters", "content", delay)
    return rows.filter(title_level(F.col("item.name"))).withColumn(
        "detail_key", F.coalesce(F.col("item.id"), F.lit("")))


def _workday_listings(payloads: DataFrame, delay: str | None = None) -> DataFrame:
    rows = _listings(payloads, "workday", "jobPostings", delay)
    return rows.filter(title_level(F.col("item.title"))).withColumn(
        "detail_key", F.coalesce(F.col("item.externalPath"), F.lit("")))


DETAILED = {"smartrecruiters": (_smartrecruiters_listings, schemas.SMARTRECRUITERS_DETAIL),
            "workday": (_workday_listings, schemas.WORKDAY_DETAIL)}


def _with_details(payloads: DataFrame, details: DataFrame, platform: str, how: str) -> DataFrame:
    listings, schema = DETAILED[platform]
    return listings(payloads).join(parsed_details(details, platform, schema), ["identifier", "detail_key"], how)


def smartrecruiters(payloads: DataFrame, details: DataFrame) -> DataFrame:
    return _smartrecruiters_postings(_with_details(payloads, details, "smartrecruiters", "inner"))


def _smartrecruiters_postings(rows: DataFrame) -> DataFrame:
    place = F.coalesce(F.col("detail.location"), F.col("item.location"))
    url = F.coalesce(
        F.when(F.col("detail.ref") != "", F.col("detail.ref")),
        F.when(F.col("item.ref") != "", F.col("item.ref")),
        F.concat(F.lit("https://jobs.smartrecruiters.com/"), F.col("identifier"), F.lit("/"),
                 F.col("detail_key")))
    sections = F.transform(F.map_values(F.col("detail.jobAd.sections")),
                           lambda s: text_or_empty(s["text"]))
    return normalize_postings(rows.select(
        first_non_empty(F.col("detail.name"), F.col("item.name")).alias("title"), "company",
        join_non_empty(F.array(place["city"], place["region"], place["country"]), ", ")
        .alias("location"),
        F.array_join(sections, " ").alias("description"),
        url.alias("job_url"), F.lit("smartrecruiters_feed").alias("source"),
        parse_posted(first_non_empty(F.col("detail.releasedDate"), F.col("item.releasedDate")))
        .alias("posted_date"),
        F.col("detail_key").alias("source_job_id"),
        F.col("identifier").alias("source_board"), "scraped_at", "page_no", "pos",
    ))


def workday(payloads: DataFrame, details: DataFrame, asof: Column) -> DataFrame:
    return _workday_postings(_with_details(payloads, details, "workday", "inner"), asof)


def _workday_postings(rows: DataFrame, asof: Column) -> DataFrame:
    info = F.col("detail.jobPostingInfo")
    places = F.concat(
        F.array(first_non_empty(info["location"], F.col("item.locationsText"))),
        F.coalesce(info["additionalLocations"], F.array().cast("array<string>")))
    return normalize_postings(rows.select(
        first_non_empty(info["title"], F.col("item.title")).alias("title"), "company",
        join_non_empty(places, "; ").alias("location"),
        info["jobDescription"].alias("description"),
        F.concat(F.rtrim(F.col("base_url"), F.lit("/")), F.col("detail_key")).alias("job_url"),
        F.lit("workday_feed").alias("source"),
        relative_date(first_non_empty(info["postedOn"], F.col("item.postedOn")), asof)
        .alias("posted_date"),
        first_non_empty(info["jobReqId"], F.substring_index(F.col("detail_key"), "_", -1))
        .alias("source_job_id"),
        F.concat("identifier", F.lit("/"), "site").alias("source_board"),
        "scraped_at", "page_no", "pos",
    ))


def detailed_postings(joined: DataFrame, platform: str, asof: Column) -> DataFrame:
    """Postings of listings that were joined with their ``detail``; ``asof`` is what relative dates refer to."""
    return _smartrecruiters_postings(joined) if platform == "smartrecruiters" else _workday_postings(joined, asof)


def all_feeds(payloads: DataFrame, details: DataFrame, asof: Column) -> DataFrame:
    """Postings of every platform; a broken page costs that page only."""
    frames = [greenhouse(payloads), lever(payloads), ashby(payloads),
              smartrecruiters(payloads, details), workday(payloads, details, asof)]
    return reduce(DataFrame.unionByName, [f.select(*POSTING_COLUMNS) for f in frames])


def feed_errors(payloads: DataFrame, details: DataFrame) -> DataFrame:
    """Boards with pages that do not parse, or listings without a detail document that does; how many.

    A board with both has a row for each. Listings that the title filter drops need no detail.
    """
    return reduce(DataFrame.unionByName, [_page_errors(payloads),
                                          *[_detail_errors(payloads, details, p) for p in DETAILED]])


def _detail_errors(payloads: DataFrame, details: DataFrame, platform: str) -> DataFrame:
    return lost_details(_with_details(payloads, details, platform, "left_anti"), platform)


def lost_details(lost: DataFrame, platform: str) -> DataFrame:
    """Listings without a detail counted by board."""
    return lost.groupBy("identifier").agg(F.count("*").alias("broken_details")).select(
        F.lit(platform).alias("platform"), "identifier", F.lit(0).cast("bigint").alias("broken_pages"),
        "broken_details", F.concat_ws(":", F.lit(platform), "identifier", F.lit(" detail is missing or does not parse"))
        .alias("error"))


def _page_errors(payloads: DataFrame) -> DataFrame:
    def unparsed(text: Column, platform: str) -> Column:
        doc = F.from_json(text, ROOTS[platform], PERMISSIVE)
        if platform == "lever":
            # Arrays carry no corrupt-record field: a page that is no array,
            # or one whose items were all lost, is broken.
            return doc.isNull() | ~F.ltrim(text_or_empty(text)).startswith("[") | F.try_parse_json(text).isNull()
        return let(doc, lambda d: d.isNull() | d["_corrupt_record"].isNotNull())

    def broken_as(text: Column) -> Column:
        broken = F.lit(False)
        for platform in ROOTS:
            broken = F.when(F.col("platform") == platform, unparsed(text, platform)).otherwise(broken)
        return broken

    # Text and document are bound, so that a filter moved below other steps makes and parses a page once.
    broken = let(F.col("payload"), broken_as)
    return (
        payloads.filter(broken)
        .groupBy("platform", "identifier").agg(F.count("*").alias("broken_pages"))
        .withColumn("broken_details", F.lit(0).cast("bigint"))
        .withColumn("error", F.concat_ws(": ", F.concat_ws(":", "platform", "identifier"),
                                         F.lit("payload does not parse")))
    )


def board_api_rows(rows: DataFrame, source: str) -> DataFrame:
    """One of the two open job-board APIs in the common columns."""
    if source == "remoteok":
        title, posted = "position", "date"
        location = first_non_empty(F.col("location"), F.lit("Remote"))
    elif source == "github":
        title, posted, location = "title", "created_at", F.col("location")
    else:
        raise ValueError(f"unknown source: {source}")
    return rows.select(
        F.col(title).alias("title"), "company", "description", location.alias("location"),
        F.col("url").alias("job_url"), F.lit(source).alias("source"),
        F.col(posted).alias("posted_date"), F.md5("url").alias("url_hash"),
    )
