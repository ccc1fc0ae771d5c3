"""Fixed schemas of landed inputs and stored tables. Nothing is inferred."""

H1B_RAW = (
    "`Employer` string, `Initial Approval` string, `Initial Denial` string, "
    "`Continuing Approval` string, `Continuing Denial` string, `NAICS` string"
)
PERM_RAW = "EMP_BUSINESS_NAME string, CASE_STATUS string"
LCA_RAW = "EMPLOYER_NAME string, CASE_STATUS string"

COUNTERS = (
    "h1b_approvals", "h1b_denials", "perm_approvals", "perm_denials",
    "lca_approvals", "lca_denials",
)
COMPANIES = (
    "employer_name string, naics_code string, "
    + ", ".join(f"{name} bigint" for name in COUNTERS)
    + ", total_approvals bigint, total_denials bigint, approval_rate decimal(5,2)"
)
JOBS = (
    "id bigint, company_id bigint, title string, description string, location string, "
    "salary_min int, salary_max int, job_url string, url_hash string, source string, "
    "posted_date timestamp, scraped_at timestamp, is_active boolean"
)
JOB_EMBEDDINGS = "job_id bigint, embedding array<float>"
USER_RESUME = (
    "id bigint, profile_name string, resume_text string, embedding array<float>, "
    "skills array<string>, experience_years int, target_roles array<string>, is_active boolean"
)
JOB_MATCHES = (
    "id bigint, job_id bigint, resume_id bigint, cosine_similarity decimal(5,4), "
    "score int, reasoning string, is_notified boolean, matched_at timestamp"
)

# One landed page of a board listing. `page_no` counts from 0.
PAYLOADS = (
    "platform string, identifier string, company string, base_url string, site string, "
    "page_no bigint, scraped_at timestamp, payload string"
)
# One landed detail document; `detail_key` is the listing id or path it belongs to.
DETAILS = "platform string, identifier string, detail_key string, payload string"

GREENHOUSE = (
    "struct<jobs: array<struct<id: string, title: string, location: struct<name: string>, "
    "content: string, absolute_url: string, updated_at: string>>, _corrupt_record: string>"
)
LEVER_ITEM = (
    "struct<id: string, text: string, categories: struct<location: string>, "
    "descriptionPlain: string, description: string, lists: array<struct<content: string>>, "
    "hostedUrl: string, applyUrl: string, createdAt: string>"
)
LEVER = f"array<{LEVER_ITEM}>"
ASHBY = (
    "struct<jobs: array<struct<id: string, title: string, location: string, "
    "secondaryLocations: array<struct<location: string>>, descriptionHtml: string, "
    "descriptionPlain: string, jobUrl: string, applyUrl: string, publishedAt: string, "
    "isListed: boolean>>, _corrupt_record: string>"
)
SMARTRECRUITERS = (
    "struct<totalFound: int, content: array<struct<id: string, name: string, "
    "location: struct<city: string, region: string, country: string>, ref: string, "
    "releasedDate: string>>, _corrupt_record: string>"
)
SMARTRECRUITERS_DETAIL = (
    "struct<id: string, name: string, "
    "location: struct<city: string, region: string, country: string>, ref: string, "
    "releasedDate: string, jobAd: struct<sections: map<string, struct<text: string>>>, "
    "_corrupt_record: string>"
)
WORKDAY = (
    "struct<total: int, jobPostings: array<struct<title: string, externalPath: string, "
    "locationsText: string, postedOn: string>>, _corrupt_record: string>"
)
WORKDAY_DETAIL = (
    "struct<jobPostingInfo: struct<title: string, location: string, "
    "additionalLocations: array<string>, jobDescription: string, postedOn: string, "
    "jobReqId: string>, _corrupt_record: string>"
)
SEARCH_RESPONSE = (
    "struct<organic_results: array<struct<title: string, link: string, snippet: string, "
    "position: int>>, items: array<struct<title: string, link: string, snippet: string, "
    "displayLink: string>>>"
)
