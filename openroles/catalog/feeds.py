"""Feed and page queries: payloads are built from the posting view, then read back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from openroles.catalog.patterns import title_level
from openroles.catalog.postings import ISO, shown_date
from openroles.catalog.registry import query
from openroles.catalog.views import ASOF
from openroles.session import scratch_path, written_once
from openroles.sources import feeds, landed, targets
from openroles.sources.pages import page_postings

PAGE_SPAN = 100  # order keys per landed page, so a page holds at most that many listings
COLUMNS = ["title", "company", "location", "description", "job_url", "url_hash", "source",
           "source_job_id", "source_board"]


def escaped(c: Column) -> Column:
    return F.replace(c, F.lit("&"), F.lit("&amp;"))


def postings(v, platform: str) -> DataFrame:
    return v("v_postings").filter(F.col("platform") == platform).withColumn(
        "posted_text", F.date_format("posted_date", "yyyy-MM-dd'T'HH:mm:ss'Z'"))


def landed_pages(rows: DataFrame, platform: str, item: Column, wrap: str | None) -> DataFrame:
    """Listing pages of each board as JSON. A page covers a fixed range of keys."""
    page = F.floor(F.col("job_id") / PAGE_SPAN).cast("bigint").alias("page_no")
    items = F.transform(F.array_sort(F.collect_list(F.struct("job_id", item.alias("item")))),
                        lambda s: s["item"])
    pages = rows.groupBy("board", page).agg(items.alias("items"))
    payload = F.to_json("items") if wrap is None else F.to_json(
        F.struct(F.col("items").alias(wrap)))
    return pages.select(
        F.lit(platform).alias("platform"), F.col("board").alias("identifier"),
        F.concat(F.lit("Co "), "board").alias("company"),
        (F.concat(F.lit("https://"), "board", F.lit(".wd5.myworkdayjobs.com/"))
         if platform == "workday" else F.lit("")).alias("base_url"),
        F.lit("Careers" if platform == "workday" else "").alias("site"), "page_no",
        F.lit(ASOF).cast("timestamp").alias("scraped_at"), payload.alias("payload"))


def greenhouse_pages(v) -> DataFrame:
    return landed_pages(postings(v, "greenhouse"), "greenhouse", F.struct(
        F.col("ext_id").cast("bigint").alias("id"), "title",
        F.struct(F.col("location").alias("name")).alias("location"),
        F.concat(F.lit("<div><p>"), escaped(F.col("description")), F.lit("</p></div>"))
        .alias("content"),
        F.col("raw_url").alias("absolute_url"), F.col("posted_text").alias("updated_at")), "jobs")


def lever_pages(v) -> DataFrame:
    return landed_pages(postings(v, "lever"), "lever", F.struct(
        F.col("ext_id").alias("id"), F.col("title").alias("text"),
        F.struct("location").alias("categories"),
        escaped(F.col("description")).alias("descriptionPlain"),
        F.array(F.struct(F.lit("<b>Python</b>").alias("content")),
                F.struct(F.lit("<li>SQL &amp; Go</li>").alias("content"))).alias("lists"),
        F.when(F.col("job_id") % 4 == 0, "").otherwise(F.col("raw_url")).alias("hostedUrl"),
        F.col("raw_url").alias("applyUrl"),
        (F.unix_timestamp("posted_date") * 1000).alias("createdAt")), None)


def ashby_pages(v) -> DataFrame:
    listed = F.when(F.col("job_id") % 3 == 0, F.lit(None).cast("boolean")).otherwise(
        F.col("job_id") % 7 != 1)
    return landed_pages(postings(v, "ashby"), "ashby", F.struct(
        F.when(F.col("job_id") % 2 == 0, F.col("ext_id")).otherwise("").alias("id"), "title",
        "location",
        F.array(F.struct(F.lit("Remote - US").alias("location")),
                F.struct(F.lit("").alias("location"))).alias("secondaryLocations"),
        F.when(F.col("job_id") % 5 == 0, "").otherwise(
            F.concat(F.lit("<p>"), escaped(F.col("description")), F.lit("</p>")))
        .alias("descriptionHtml"),
        escaped(F.col("description")).alias("descriptionPlain"),
        F.col("raw_url").alias("jobUrl"), F.col("posted_text").alias("publishedAt"),
        listed.alias("isListed")), "jobs")


def smartrecruiters_pages(v) -> tuple[DataFrame, DataFrame]:
    rows = postings(v, "smartrecruiters")
    lists = landed_pages(rows, "smartrecruiters", F.struct(
        F.col("ext_id").alias("id"), F.col("title").alias("name"),
        F.struct(F.lit("Austin").alias("city"), F.lit("us").alias("country")).alias("location"),
        F.col("raw_url").alias("ref"), F.col("posted_text").alias("releasedDate")), "content")
    details = rows.select(
        F.lit("smartrecruiters").alias("platform"), F.col("board").alias("identifier"),
        F.col("ext_id").alias("detail_key"), F.to_json(F.struct(
            F.col("ext_id").alias("id"),
            F.when(F.col("job_id") % 2 == 0, F.struct(
                F.lit("Reno").alias("city"), F.lit("NV").alias("region"),
                F.lit("US").alias("country"))).alias("location"),
            F.struct(F.struct(
                F.struct(F.lit("<h1>About</h1>").alias("text")).alias("companyDescription"),
                F.struct(escaped(F.col("description")).alias("text")).alias("jobDescription"),
            ).alias("sections")).alias("jobAd"))).alias("payload"))
    return lists, details


def workday_pages(v) -> tuple[DataFrame, DataFrame]:
    path = F.concat(F.lit("/job/City/Role_"), "ext_id")
    rows = postings(v, "workday").withColumn("path", path)
    lists = landed_pages(rows, "workday", F.struct(
        "title", F.col("path").alias("externalPath"), F.col("location").alias("locationsText"),
        F.lit("Posted 2 Days Ago").alias("postedOn")), "jobPostings")
    details = rows.select(
        F.lit("workday").alias("platform"), F.col("board").alias("identifier"),
        F.col("path").alias("detail_key"), F.to_json(F.struct(F.struct(
            F.when(F.col("job_id") % 2 == 0, F.lit("US, TX, Austin")).alias("location"),
            F.array(F.lit("US, Remote")).alias("additionalLocations"),
            F.concat(F.lit("<p>"), escaped(F.col("description")), F.lit("</p>"))
            .alias("jobDescription"),
            F.when(F.col("job_id") % 3 == 0, F.lit("Posted Yesterday")).alias("postedOn"),
            F.when(F.col("job_id") % 4 != 0, F.col("ext_id")).alias("jobReqId"),
        ).alias("jobPostingInfo"))).alias("payload"))
    return lists, details


def shown(rows: DataFrame) -> DataFrame:
    return rows.select(*COLUMNS, shown_date().alias("posted"))


def expected(platform: str, location: str = "location", description: str = "description",
             url: str = "canon_url", where: str = "title <> ''", posted: str = ISO,
             board: str = "board") -> str:
    return f"""
    SELECT trim(title) AS title, 'Co ' || board AS company, trim({location}) AS location,
           {description} AS description, {url} AS job_url, md5({url}) AS url_hash,
           '{platform}_feed' AS source, ext_id AS source_job_id, {board} AS source_board,
           {posted} AS posted
    FROM @v_postings WHERE platform = '{platform}' AND {where}"""


RELEVANT = title_level("title")


FEEDS = {
    "greenhouse": expected("greenhouse"),
    "lever": expected("lever", description="description || ' Python SQL & Go'"),
    "ashby": expected(
        "ashby", location="CASE WHEN location = '' THEN 'Remote - US' ELSE location || '; Remote - US' END",
        where="title <> '' AND (job_id % 3 = 0 OR job_id % 7 <> 1)"),
    "smartrecruiters": expected(
        "smartrecruiters", location="CASE WHEN job_id % 2 = 0 THEN 'Reno, NV, US' ELSE 'Austin, us' END",
        description="'About ' || description", where=RELEVANT),
    "workday": expected(
        "workday",
        location="""CASE WHEN job_id % 2 = 0 THEN 'US, TX, Austin; US, Remote'
                    WHEN location = '' THEN 'US, Remote' ELSE location || '; US, Remote' END""",
        url="'https://' || board || '.wd5.myworkdayjobs.com/job/City/Role_' || ext_id",
        where=RELEVANT, board="board || '/Careers'",
        posted=f"""strftime(TIMESTAMP '{ASOF}' - to_days(CASE WHEN job_id % 3 = 0 THEN 1 ELSE 2 END),
                   '%Y-%m-%dT%H:%M:%SZ')"""),
}


@query("feed_greenhouse", FEEDS["greenhouse"])
def feed_greenhouse(v):
    return shown(feeds.greenhouse(greenhouse_pages(v)))


@query("feed_lever", FEEDS["lever"])
def feed_lever(v):
    return shown(feeds.lever(lever_pages(v)))


@query("feed_ashby", FEEDS["ashby"])
def feed_ashby(v):
    return shown(feeds.ashby(ashby_pages(v)))


@query("feed_smartrecruiters", FEEDS["smartrecruiters"])
def feed_smartrecruiters(v):
    return shown(feeds.smartrecruiters(*smartrecruiters_pages(v)))


@query("feed_workday", FEEDS["workday"])
def feed_workday(v):
    lists, details = workday_pages(v)
    return shown(feeds.workday(lists, details, F.lit(ASOF).cast("timestamp")))


# Details are missing or cut by the first digit of their key's digest.
LOST_DETAIL = "left(md5(CASE platform WHEN 'workday' THEN '/job/City/Role_' || ext_id ELSE ext_id END), 1)"


@query("feed_errors", f"""
    SELECT platform, board AS identifier, count(*) AS broken_pages, 0::BIGINT AS broken_details,
           platform || ':' || board || ': payload does not parse' AS error
    FROM (SELECT DISTINCT platform, board, CAST(floor(job_id / 100.0) AS BIGINT) AS page_no FROM @v_postings
          WHERE platform IN ('greenhouse', 'lever', 'ashby', 'smartrecruiters', 'workday'))
    WHERE page_no % 5 = 2 GROUP BY platform, board
    UNION ALL
    SELECT platform, board, 0, count(*), platform || ':' || board || ': detail is missing or does not parse'
    FROM @v_postings WHERE platform IN ('smartrecruiters', 'workday') AND {RELEVANT}
      AND CAST(floor(job_id / 100.0) AS BIGINT) % 5 <> 2 AND {LOST_DETAIL} IN ('0', '1', '2', '3', '4', '5')
    GROUP BY platform, board""")
def feed_errors(v):
    details = [smartrecruiters_pages(v)[1], workday_pages(v)[1]]
    pages = every_page(v)
    digit = F.left(F.md5("detail_key"), F.lit(1))
    details = details[0].unionByName(details[1]).filter(~digit.isin("0", "1", "2")).withColumn(
        "payload", F.when(digit.isin("3", "4", "5"), F.expr("left(payload, length(payload) - 2)"))
        .otherwise(F.col("payload")))
    broken = F.when(F.col("page_no") % 5 == 2, F.expr("left(payload, length(payload) - 2)"))
    return feeds.feed_errors(pages.withColumn("payload", F.coalesce(broken, F.col("payload"))), details)


def every_page(v) -> DataFrame:
    lists = [f(v) for f in (greenhouse_pages, lever_pages, ashby_pages)]
    return reduce(DataFrame.unionByName, [*lists, smartrecruiters_pages(v)[0], workday_pages(v)[0]])


def landed_files(v) -> tuple[str, str]:
    """All pages and details as JSON lines; pages whose number leaves 2 by 5 have a broken line besides."""
    root = scratch_path(v.spark, "landed")
    pages = written_once(every_page(v), "landed-pages")
    pages.write.partitionBy("platform").json(f"{root}/pages")
    broken = pages.filter("page_no % 5 = 2").select(
        "platform", F.expr("left(to_json(struct(*)), length(to_json(struct(*))) - 2)").alias("value"))
    broken.write.mode("append").partitionBy("platform").text(f"{root}/pages")
    smartrecruiters_pages(v)[1].unionByName(workday_pages(v)[1]).write.partitionBy("platform").json(f"{root}/details")
    return f"{root}/pages", f"{root}/details"


@query("landed_feeds", " UNION ALL ".join(FEEDS.values()))
def landed_feeds(v):
    return shown(landed.all_feeds(v.spark, *landed_files(v), F.lit(ASOF).cast("timestamp")))


@query("landed_file_errors", """
    SELECT platform, count(*) AS broken_lines FROM (
      SELECT DISTINCT platform, board, CAST(floor(job_id / 100.0) AS BIGINT) AS page_no FROM @v_postings
      WHERE platform IN ('greenhouse', 'lever', 'ashby', 'smartrecruiters', 'workday'))
    WHERE page_no % 5 = 2 GROUP BY platform""")
def landed_file_errors(v):
    rows = landed.read_files(v.spark, landed_files(v)[0])
    return landed.file_errors(rows).groupBy("platform").agg(F.count("*").alias("broken_lines"))


PAGES = """
    SELECT page_id, CASE page_id % 5
             WHEN 0 THEN 'https://careers.example.com/job/' || CAST(page_id AS STRING)
             WHEN 1 THEN 'https://jobs.lever.co/acme-' || CAST(page_id AS STRING) || 'x/77/apply'
             WHEN 2 THEN 'https://big-corp' || CAST(page_id AS STRING) || '.wd1.myworkdayjobs.com/jobs/job/1'
             WHEN 3 THEN 'https://jobs.smartrecruiters.com/Some-Co/' || CAST(page_id AS STRING) || '-dev'
             ELSE url END AS url,
           CASE page_id % 5
             WHEN 0 THEN replace(html, '</head>', '<script type="application/ld+json">[{"' || chr(64) || 'type":"WebSite"},'
                  || '{"' || chr(64) || 'type":"JobPosting","title":"Engineer ' || CAST(page_id AS STRING)
                  || '","description":"<p>Build</p><p>APIs</p>","datePosted":"2026-08-30",'
                  || '"hiringOrganization":{"name":"Acme"},"jobLocation":[{"address":{"addressLocality":'
                  || '"Austin","addressRegion":"TX","addressCountry":"US"}},{"address":"Remote"}]}]</script></head>')
             WHEN 1 THEN replace(html, '<body>', '<body><div class="x posting-headline"><h2>Lead '
                  || CAST(page_id AS STRING) || '</h2></div><div class="location">Oslo</div>')
             WHEN 2 THEN replace(html, '<body>', '<body><h2 data-automation-id="jobPostingHeader">Ops '
                  || CAST(page_id AS STRING) || '</h2><div data-automation-id="locations">US</div>')
             WHEN 3 THEN replace(html, '<title>', '<title>Dev ' || CAST(page_id AS STRING) || ' | ')
             ELSE html END AS html
    FROM @pages"""


@query("page_postings", f"""
    SELECT page_id, title, company, location, source, posted, url AS job_url, md5(url) AS url_hash
    FROM (SELECT page_id, url,
             CASE page_id % 5 WHEN 0 THEN 'Engineer ' || CAST(page_id AS VARCHAR)
               WHEN 1 THEN 'Lead ' || CAST(page_id AS VARCHAR) WHEN 2 THEN 'Ops ' || CAST(page_id AS VARCHAR)
               WHEN 3 THEN 'Dev ' || CAST(page_id AS VARCHAR)
               ELSE trim(replace(regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1), '&amp;', '&')) END AS title,
             CASE page_id % 5 WHEN 0 THEN 'Acme' WHEN 1 THEN 'Acme ' || CAST(page_id AS VARCHAR) || 'X'
               WHEN 2 THEN 'Big Corp' || CAST(page_id AS VARCHAR) WHEN 3 THEN 'Some Co' ELSE '' END AS company,
             CASE page_id % 5 WHEN 0 THEN 'Austin, TX, US; Remote' WHEN 1 THEN 'Oslo' WHEN 2 THEN 'US'
               ELSE '' END AS location,
             CASE page_id % 5 WHEN 0 THEN 'structured_job_posting' WHEN 1 THEN 'lever' WHEN 2 THEN 'workday'
               WHEN 3 THEN 'smartrecruiters' ELSE 'generic' END AS source,
             CASE page_id % 5 WHEN 0 THEN '2026-08-30' ELSE '' END AS posted
          FROM ({PAGES})) WHERE title <> ''""")
def pages_to_postings(v):
    return page_postings(v.sql(PAGES)).select(
        "page_id", "title", "company", "location", "source",
        F.coalesce("posted_date", F.lit("")).alias("posted"), "job_url", "url_hash")


BRAND = """array_to_string(list_filter(regexp_extract_all(lower({0}), '[a-z0-9]+'),
    lambda w: w NOT IN ('llc', 'inc', 'technologies', 'ltd', 'holdings')), '')"""
DISCOVERED = f"""
    SELECT platform, CASE WHEN platform = 'smartrecruiters' THEN board ELSE board END AS identifier,
           employer_name AS company,
           CASE platform WHEN 'lever' THEN 'https://api.lever.co'
                WHEN 'workday' THEN 'https://' || board || '.wd5.myworkdayjobs.com' ELSE '' END AS base_url,
           CASE platform WHEN 'workday' THEN 'Careers' ELSE '' END AS site
    FROM (SELECT p.platform, p.board, c.employer_name, row_number() OVER (
             PARTITION BY p.platform, lower(p.board) ORDER BY j.job_id DESC) AS n
          FROM @v_jobs j JOIN @v_postings p ON p.job_id = j.job_id
               JOIN @v_companies c ON c.company_id = j.company_id
          WHERE {BRAND.format('c.employer_name')} = {BRAND.format('p.board')}) WHERE n = 1"""


def discovered(v) -> DataFrame:
    return targets.discover_targets(targets.known_feed_jobs(v("v_jobs"), v("v_companies")))


@query("targets_discovered", DISCOVERED)
def targets_discovered(v):
    return discovered(v)


SEEDS = ", ".join("(" + ", ".join(f"'{x}'" for x in row) + ")"
                  for row in targets.fixed.SEED_TARGETS)


@query("targets_merged", f"""
    SELECT platform, identifier, company, base_url, site FROM (
      SELECT *, row_number() OVER (PARTITION BY platform, lower(identifier), lower(site)
                                   ORDER BY g DESC) AS n
      FROM (SELECT *, 0 AS g FROM (VALUES {SEEDS}) s(platform, identifier, company, base_url, site)
            UNION ALL SELECT *, 1 FROM ({DISCOVERED}))) WHERE n = 1""")
def targets_merged(v):
    return targets.merge_targets(targets.seed_targets(v.spark), discovered(v))
