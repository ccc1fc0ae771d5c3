"""Board feeds: listings are generated field by field, and the wanted posting is worked out by the stated rule.

Every field of an item is present, empty or missing by chance, so that the order
in which a rule falls back from one field to the next is met in all its cases.
"""

import json
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from openroles import schemas
from openroles.sources import feeds, targets
from openroles.sources.pages import extract_page

ASOF = datetime(2024, 3, 9)
BOARDS = [("kelpharbor", "Kelp Harbor"), ("Oakline", ""), ("tarn-9", "Tarn Nine")]
ROLES = ["Software Engineer", "Data Engineer", "Platform Engineer", "Bookkeeper", "Chef de Partie"]
RELEVANT = ROLES[:3]
PLACES = ["Duluth, MN", "Remote - US", "Bend, OR", "Leeds"]


class Items:
    """Fields of random items: a value, nothing, or an empty text."""

    def __init__(self, seed):
        self.rng = random.Random(seed)

    def some(self, **fields):
        """Each field with its value, empty, or left out."""
        kept = {}
        for name, value in fields.items():
            chance = self.rng.random()
            if chance < 0.7:
                kept[name] = value
            elif chance < 0.85:
                kept[name] = ""
        return kept

    def pick(self, values):
        return self.rng.choice(values)

    def moment(self):
        return datetime(2023, 5, 4) + timedelta(seconds=self.rng.randrange(20_000_000))


def first(*values):
    return next((v for v in values if v), "")


def landed(spark, platform, pages, base="", site=""):
    rows = [(platform, board, name, base, site, number, ASOF, json.dumps(page))
            for board, name, number, page in pages]
    return spark.createDataFrame(rows, schemas.PAYLOADS)


def paged(make, root, boards=BOARDS, count=30):
    """Pages of each board with items made one by one; and each item with its board."""
    pages, items = [], []
    for board, name in boards:
        for number in range(2):
            made = [make(f"{board}-{number}-{i}") for i in range(count)]
            pages.append((board, name, number, {root: made} if root else made))
            items += [(board, name, item) for item in made]
    return pages, items


def posting(board, name, title, url, place, description, job_id, posted):
    if not title or not url:
        return None
    return (board, first(name, board), title, url, place, description, job_id, posted)


def compare(frame, wanted):
    got = [(r.source_board, r.company, r.title, r.job_url, r.location, r.description, r.source_job_id, r.posted_date)
           for r in frame.collect()]
    wanted = [w for w in wanted if w]
    assert sorted(got, key=str) == sorted(wanted, key=str) and len(wanted) > 20


def zoned(moment):
    return moment.isoformat() + "Z"


def test_greenhouse_items(spark):
    make = Items(1)

    def item(key):
        made = make.some(title=make.pick(ROLES), content=f"<div>text <i>of</i> {key}</div>",
                         absolute_url=f"https://boards.greenhouse.io/b/jobs/{key}?gh_src=feed")
        return made | {"id": make.rng.randrange(10**9), "location": {"name": make.pick(PLACES)}, "updated_at": zoned(make.moment())}

    pages, items = paged(item, "jobs")
    compare(feeds.greenhouse(landed(spark, "greenhouse", pages)), [
        posting(b, n, x.get("title"), x.get("absolute_url", "").split("?")[0], x["location"]["name"],
                " ".join(x.get("content", "").replace("<", " <").replace(">", "> ").replace("<div>", "").replace("</div>", "")
                         .replace("<i>", "").replace("</i>", "").split()), str(x["id"]),
                datetime.fromisoformat(x["updated_at"][:-1])) for b, n, x in items])


def test_lever_items_and_whole_boards(spark):
    make = Items(2)

    def item(key):
        made = make.some(text=make.pick(ROLES), descriptionPlain=f"plain {key}", description=f"<p>marked {key}</p>",
                         hostedUrl=f"https://jobs.lever.co/b/{key}", applyUrl=f"https://jobs.lever.co/b/{key}-x/apply")
        blocks = [{"content": f"<ul><li>block {i}</li></ul>"} for i in range(make.rng.randrange(3))]
        return made | {"id": key, "categories": {"location": make.pick(PLACES)}, "lists": blocks,
                       "createdAt": int(make.moment().replace(tzinfo=timezone.utc).timestamp()) * 1000}

    def described(x):
        main = first(x.get("descriptionPlain"), x.get("description", "").replace("<p>", "").replace("</p>", ""))
        return " ".join([main, *[f"block {i}" for i in range(len(x["lists"]))]]).strip()

    # Boards are not cut, however many pages they have.
    pages, items = paged(item, None, count=270)
    compare(feeds.lever(landed(spark, "lever", pages)), [
        posting(b, n, x.get("text"), first(x.get("hostedUrl"), x.get("applyUrl", "").removesuffix("/apply")),
                x["categories"]["location"], described(x), x["id"],
                datetime.fromtimestamp(x["createdAt"] / 1000, timezone.utc).replace(tzinfo=None)) for b, n, x in items])


def test_ashby_items(spark):
    make = Items(3)

    def item(key):
        made = make.some(title=make.pick(ROLES), location=make.pick(PLACES), descriptionHtml=f"<p>marked {key}</p>",
                         descriptionPlain=f"plain {key}", jobUrl=f"https://jobs.ashbyhq.com/b/j{key}",
                         applyUrl=f"https://jobs.ashbyhq.com/b/a{key}/application", id=f"id{key}")
        made["secondaryLocations"] = [{"location": p} if p else {} for p in make.rng.sample([*PLACES, None], make.rng.randrange(3))]
        if make.rng.random() < 0.6:
            made["isListed"] = make.rng.random() < 0.7
        return made | {"publishedAt": zoned(make.moment())}

    def wanted(b, n, x):
        if x.get("isListed") is False:
            return None
        url = first(x.get("jobUrl"), x.get("applyUrl", "").removesuffix("/application"))
        place = "; ".join(p for p in [x.get("location"), *[s.get("location") for s in x["secondaryLocations"]]] if p)
        text = first(x.get("descriptionHtml", "").replace("<p>", "").replace("</p>", ""), x.get("descriptionPlain"))
        return posting(b, n, x.get("title"), url, place, text, first(x.get("id"), url.rsplit("/", 1)[-1]),
                       datetime.fromisoformat(x["publishedAt"][:-1]))

    pages, items = paged(item, "jobs")
    compare(feeds.ashby(landed(spark, "ashby", pages)), [wanted(*i) for i in items])


def test_smartrecruiters_items_meet_their_details(spark):
    make = Items(4)
    pages, items = paged(lambda key: {"id": key, "name": make.pick(ROLES)} | make.some(ref=f"https://jobs.smartrecruiters.com/l/{key}"),
                         "content")
    documents = {}
    for board, _, x in items:
        if make.rng.random() < 0.8:
            documents[board, x["id"]] = make.some(name=f"{x['name']} {make.rng.randrange(9)}",
                                                  ref=f"https://jobs.smartrecruiters.com/d/{x['id']}") | {
                "location": make.some(city="Bend", region="OR", country="us"), "releasedDate": zoned(make.moment()),
                "jobAd": {"sections": {f"s{i}": {"text": f"<p>part {i}</p>"} for i in range(make.rng.randrange(4))}}}
    details = spark.createDataFrame([("smartrecruiters", b, k, json.dumps(d)) for (b, k), d in documents.items()], schemas.DETAILS)

    def wanted(b, n, x):
        d = documents.get((b, x["id"]))
        if d is None or x["name"] not in RELEVANT:  # details are looked up for relevant titles only
            return None
        url = first(d.get("ref"), x.get("ref"), f"https://jobs.smartrecruiters.com/{b}/{x['id']}")
        return posting(b, n, first(d.get("name"), x["name"]), url,
                       ", ".join(p for p in (d["location"].get(k) for k in ("city", "region", "country")) if p),
                       " ".join(f"part {i}" for i in range(len(d["jobAd"]["sections"]))), x["id"],
                       datetime.fromisoformat(d["releasedDate"][:-1]))

    lists = landed(spark, "smartrecruiters", pages)
    compare(feeds.smartrecruiters(lists, details), [wanted(*i) for i in items])
    lost = {b: sum(1 for c, _, x in items if c == b and x["name"] in RELEVANT and (b, x["id"]) not in documents) for b, _ in BOARDS}
    assert {r.identifier: r.broken_details for r in feeds.feed_errors(lists, details).collect()} == {b: n for b, n in lost.items() if n}


def test_workday_items_meet_their_details(spark):
    make = Items(5)
    pages, items = paged(lambda key: make.some(locationsText=make.pick(PLACES), postedOn="Posted Yesterday") | {
        "title": make.pick(ROLES), "externalPath": f"/job/Bend/Role-{key}_Q{key}"}, "jobPostings")
    documents = {(b, x["externalPath"]): make.some(title=f"{x['title']} I", location=make.pick(PLACES), jobReqId=f"REQ{i}",
                                                   postedOn=f"Posted {i % 25 + 2} Days Ago")
                 | {"additionalLocations": make.rng.sample(PLACES, make.rng.randrange(3)), "jobDescription": f"<b>about {i}</b>"}
                 for i, (b, _, x) in enumerate(items) if make.rng.random() < 0.8}
    details = spark.createDataFrame([("workday", b, k, json.dumps({"jobPostingInfo": d})) for (b, k), d in documents.items()],
                                    schemas.DETAILS)

    def wanted(b, n, x):
        d = documents.get((b, x["externalPath"]))
        if d is None or x["title"] not in RELEVANT:
            return None
        told = first(d.get("postedOn"), x.get("postedOn"))
        age = None if not told else 1 if told.endswith("Yesterday") else int(told.split()[1])
        place = "; ".join(p for p in [first(d.get("location"), x.get("locationsText")), *d["additionalLocations"]] if p)
        return posting(f"{b}/ext", first(n, f"{b}/ext"), first(d.get("title"), x["title"]),
                       f"https://{b.lower()}.wd3.myworkdayjobs.com".replace(b.lower(), "tenant") + x["externalPath"], place,
                       d["jobDescription"].replace("<b>", "").replace("</b>", ""),
                       first(d.get("jobReqId"), x["externalPath"].rsplit("_", 1)[-1]),
                       None if age is None else ASOF - timedelta(days=age))

    lists = landed(spark, "workday", pages, base="https://tenant.wd3.myworkdayjobs.com/", site="ext")
    compare(feeds.workday(lists, details, F.lit(ASOF)), [wanted(*i) for i in items])


@pytest.mark.parametrize("seed", range(6))
def test_structured_data_of_a_page_comes_first(seed):
    make = Items(seed + 20)
    posting_ = {"@type": "JobPosting", "title": f"Role {seed}", "description": f"<p>About <b>{seed}</b></p>",
                "datePosted": f"2023-0{seed + 1}-17", "hiringOrganization": {"name": f"Firm {seed}"},
                "jobLocation": {"address": make.some(addressLocality="Bend", addressRegion="OR", addressCountry="US")}}
    told = [posting_, [{"@type": "Person"}, posting_], {"@graph": [{"@type": "WebSite"}, posting_]}][seed % 3]
    html = f"<html><head><script type='application/ld+json'>{json.dumps(told)}</script></head><h1>Another title</h1></html>"
    got = extract_page(f"https://careers.firm{seed}.test/{seed}", html)
    place = ", ".join(v for v in posting_["jobLocation"]["address"].values() if v)
    assert (got["title"], got["company"], got["description"], got["location"]) == (
        f"Role {seed}", f"Firm {seed}", f"About {seed}", place)


def test_a_target_needs_a_board_that_agrees_with_the_employer(spark):
    urls = {"greenhouse": "https://boards.greenhouse.io/{}/jobs/5", "lever": "https://jobs.lever.co/{}/5",
            "lever eu": "https://jobs.eu.lever.co/{}/5", "ashby": "https://jobs.ashbyhq.com/{}/5",
            "smartrecruiters": "https://jobs.smartrecruiters.com/{}/5", "workday": "https://{}.wd2.myworkdayjobs.com/fr-FR/Open/job/x_5"}
    rows, want = [], set()
    for kind, url in urls.items():
        for slug, name in (("kelpharbor", "Kelp Harbor LLC"), ("oakline", "Tarn Nine Inc"), ("tarnnine", "TARN-NINE")):
            rows.append((len(rows), url.format(slug), name))
            if slug != "oakline":
                platform = kind.split()[0]
                base = {"lever": "https://api.lever.co", "lever eu": "https://api.eu.lever.co",
                        "workday": f"https://{slug}.wd2.myworkdayjobs.com"}.get(kind, "")
                want.add((platform, slug, name, base, "Open" if platform == "workday" else ""))
    # Of two stored jobs of one board the later one tells the name and address.
    want -= {w for w in want if w[3] == "https://api.lever.co"}
    rows += [(90, "https://jobs.lever.co/", "Kelp Harbor"), (91, "https://kelpharbor.wd2.myworkdayjobs.com/job/x", "Kelp Harbor")]
    found = targets.discover_targets(spark.createDataFrame(rows, "job_id long, job_url string, employer_name string"))
    assert {(r.platform, r.identifier, r.company, r.base_url, r.site) for r in found.collect()} == want
