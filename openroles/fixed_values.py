"""Fixed values.

Word lists, patterns, formats and thresholds that decide results. They are
data that must stay exactly as given for results to be right, kept here
together and in their natural order; the logic that uses them is elsewhere.
"""

# --- fixed values: job title levels -----------------------------------------

ENGINEERING_TITLE = (
    r"\b(?:software|backend|back-end|fullstack|full-stack|platform|infrastructure|"
    r"site reliability|sre|devops|cloud|data|machine learning|ml|ai|agentic|"
    r"application)\s+(?:development\s+)?(?:engineer|developer)|"
    r"\b(?:software developer|application developer|member of technical staff|mts|sde)\b"
)
UPPER_LEVEL_TITLE = (
    r"\b(?:senior|sr\.?|staff|principal|lead|manager|director|architect|vp|vice president)\b"
)
EARLY_CAREER_TITLE = (
    r"\b(?:new grad(?:uate)?|university|entry[- ]level|junior|associate|campus|"
    r"early career|graduate|engineer i|developer i|sde i|sde 1)\b"
)
INTERN_TITLE = r"\b(?:intern|internship)\b"

# --- fixed values: location patterns ----------------------------------------

US_STATE_CODE = (
    r",\s*(?:AL|AK|AZ|AR|CA|CO|CT|DE|FL|GA|HI|ID|IL|IN|IA|KS|KY|LA|ME|MD|"
    r"MA|MI|MN|MS|MO|MT|NE|NV|NH|NJ|NM|NY|NC|ND|OH|OK|OR|PA|RI|SC|SD|TN|"
    r"TX|UT|VT|VA|WA|WV|WI|WY)(?:\b|\s)"
)
US_NAMED_LOCATION = (
    r"\bunited states(?: of america)?\b",
    r"\busa\b",
    r"\bu\.s\.a\.?(?=\s|$|[,;/])",
    r"\bu\.s\.(?=\s|$|[,;/])",
    r"\bus\b",
    r"\bremote\s*[-–—,(]?\s*us\b",
    r"\bus\s*[-–— ](?:remote|based|only)\b",
    r"\b(?:new york|san francisco|san jose|sunnyvale|mountain view|palo alto|"
    r"seattle|austin|boston|chicago|dallas|denver|atlanta|los angeles|"
    r"washington,? d\.?c\.?|raleigh|miami|portland|philadelphia|pittsburgh)\b",
    r"\b(?:alabama|alaska|arizona|arkansas|california|colorado|connecticut|"
    r"delaware|florida|georgia|hawaii|idaho|illinois|indiana|iowa|kansas|"
    r"kentucky|louisiana|maine|maryland|massachusetts|michigan|minnesota|"
    r"mississippi|missouri|montana|nebraska|nevada|new hampshire|new jersey|"
    r"new mexico|new york|north carolina|north dakota|ohio|oklahoma|oregon|"
    r"pennsylvania|rhode island|south carolina|south dakota|tennessee|texas|"
    r"utah|vermont|virginia|washington|west virginia|wisconsin|wyoming)\b",
)
US_DESCRIPTION = (
    r"\b(?:this|the)\s+(?:role|position|job|opening)\b.{0,80}\b(?:available|open|based|located|remote)\b.{0,45}\b(?:united states|usa|u\.s\.)\b",
    r"\b(?:available|open|hiring|locations?)\b.{0,55}\b(?:united states|usa|u\.s\.)\b",
    r"\b(?:work authorization|authorized|eligible)\b.{0,45}\b(?:united states|the us|u\.s\.)\b",
)
GLOBAL_LOCATION = (
    r"\bglobal\b",
    r"\bworldwide\b",
    r"\bwork from anywhere\b",
    r"\banywhere in the world\b",
)
GLOBAL_DESCRIPTION = (
    r"\b(?:this|the)\s+(?:role|position|job|opening)\b.{0,60}\b(?:available|open|remote)\b.{0,35}\b(?:globally|worldwide|anywhere in the world)\b",
    r"\b(?:candidates|applicants)\b.{0,45}\b(?:worldwide|globally)\b",
)
FOREIGN_LOCATION = (
    r"\b(?:india|bengaluru|bangalore|hyderabad|pune|gurugram|gurgaon|noida|"
    r"mumbai|chennai|delhi|telangana|telengana|karnataka|maharashtra|kerala|"
    r"tamil nadu|andhra pradesh|haryana|uttar pradesh|gujarat|rajasthan|"
    r"west bengal)\b",
    r"\b(?:brazil|brasil|sao paulo|são paulo|rio de janeiro|latam|latin america|"
    r"south america)\b",
    r"\b(?:united kingdom|u\.?k\.?|london|manchester|ireland|dublin)\b",
    r"\b(?:canada|toronto|vancouver|montreal|ottawa)\b",
    r"\b(?:ontario|quebec|alberta|british columbia|nova scotia|manitoba|"
    r"saskatchewan|new brunswick|newfoundland and labrador)\b",
    r"\b(?:europe|emea|apac|asia|australia|new zealand|singapore|japan|tokyo|"
    r"mexico|indonesia|china|netherlands|spain|portugal|germany|france|sweden|"
    r"denmark|finland|norway|switzerland|austria|belgium|poland|czechia|"
    r"czech republic|romania|bulgaria|ukraine|lithuania|south korea|malaysia|"
    r"philippines|thailand|vietnam|taiwan|hong kong|israel|united arab emirates|"
    r"uae|saudi arabia|south africa|turkey|argentina|colombia|chile|peru)\b",
    r"\b(?:berlin|munich|hamburg|frankfurt|amsterdam|stockholm|copenhagen|"
    r"helsinki|oslo|paris|madrid|barcelona|lisbon|porto|prague|warsaw|"
    r"zurich|geneva|vienna|brussels|sofia|bucharest|kyiv|vilnius|seoul)\b",
    r"\b(?:lithuania|south korea|republic of korea)\b",
)
FOREIGN_DESCRIPTION = (
    r"\b(?:role|position|job|candidate|applicant)s?\b.{0,45}\b(?:based|located|remote)\b.{0,25}\b(?:india|brazil|brasil|latam|latin america|united kingdom|uk|canada|europe|emea|apac)\b",
    r"\b(?:based|located|remote)\s+(?:in|from|within)\s+(?:india|brazil|brasil|latam|latin america|united kingdom|uk|canada|europe|emea|apac)\b",
)
US_INCLUSIVE_REGION = r"\b(?:north america|americas)\b"
CANADIAN_CODE_SEGMENT = (
    r"(?:^|[;/])\s*[^;/]+,\s*(?:AB|BC|MB|NB|NL|NS|NT|NU|ON|PE|QC|SK|YT)"
    r"\s*,\s*CA\s*(?=$|[;/])"
)

REASON_US = "explicit US availability"
REASON_GLOBAL = "global/worldwide availability"
REASON_FOREIGN = "non-US-only location"
REASON_REGION = "US-inclusive region"
REASON_UNKNOWN = "location unknown or not explicitly restricted"

# --- fixed values: work-authorization language ------------------------------

TITLE_CLEARANCE = (
    r"\b(?:top secret|secret|ts/?sci)\b.{0,25}\bclearance\b|"
    r"\bclearance\b.{0,25}\b(?:required|top secret|secret|ts/?sci)\b"
)
NO_SPONSORSHIP = (
    r"\b(?:must|should)\s+(?:already\s+)?be\s+(?:legally\s+)?authorized\b"
    r".{0,80}\bwithout\b.{0,30}\bsponsorship\b|"
    r"\b(?:will|can|does|do)\s+not\s+(?:provide|offer|support)\b.{0,35}\bsponsorship\b|"
    r"\b(?:unable|not able)\s+to\s+(?:sponsor|(?:provide|offer|support)\s+"
    r"(?:visa\s+)?sponsorship)\b|"
    r"\b(?:cannot|can't)\s+(?:sponsor|(?:provide|offer|support)\s+"
    r"(?:visa\s+)?sponsorship)\b|"
    r"\bno\s+(?:visa\s+)?sponsorship\b(?!\s+required)|"
    r"\b(?:visa|immigration|employment)\s+sponsorship\s+(?:is\s+)?"
    r"(?:not available|unavailable|not offered|not provided)|"
    r"\b(?:this|the)\s+(?:role|position|job)\s+(?:is\s+)?not\s+eligible\b"
    r".{0,35}\bsponsorship\b"
)
CITIZENSHIP = (
    r"\b(?:u\.?s\.?|united states)\s+citizenship\s+(?:is\s+)?required\b|"
    r"\bmust\s+be\s+(?:a\s+)?(?:u\.?s\.?|united states)\s+citizens?\b|"
    r"\b(?:only|solely)\s+(?:u\.?s\.?|united states)\s+citizens?\b|"
    r"\b(?:u\.?s\.?\s+)?citizens?\s+(?:only|required)\b|"
    r"\b(?:applicants?|candidates?)\s+must\s+be\b.{0,100}"
    r"\b(?:u\.?s\.?|united states)\s+citizens?\b"
)
PERMANENT_RESIDENT = (
    r"\b(?:green card|lawful permanent resident|permanent resident status)"
    r"\s+(?:is\s+)?required\b|"
    r"\bmust\s+be\b.{0,35}\b(?:green card holder|lawful permanent resident)\b|"
    r"\b(?:citizens?|nationals?|lawful permanent residents?|green card holders?)"
    r"(?:\s*(?:,|or|and)\s*(?:citizens?|nationals?|lawful permanent residents?|"
    r"green card holders?))*\s+only\b|"
    r"\bmust\s+(?:qualify|be eligible)\s+as\s+(?:a\s+)?u\.?s\.?\s+person\b|"
    r"\b(?:u\.?s\.?\s+citizens?|green card holders?)\s+(?:or|and)\s+"
    r"(?:u\.?s\.?\s+citizens?|green card holders?)\b|"
    r"\b(?:must|required\s+to)\s+be\b.{0,100}\b(?:u\.?s\.?\s+person|"
    r"u\.?s\.?\s+national|lawful permanent residents?|protected individual)\b"
)
CLEARANCE = (
    r"\b(?:active|current|existing)\b.{0,30}\b(?:security\s+)?clearance\b|"
    r"\b(?:top secret|secret|ts/?sci)\b.{0,20}\b(?:security\s+)?clearance\b|"
    r"\b(?:security\s+)?clearance\s+(?:is\s+)?required\b|"
    r"\bmust\s+(?:hold|possess|maintain|obtain)\b.{0,40}\bclearance\b|"
    r"\b(?:ability|eligible|eligibility)\s+to\s+(?:obtain|maintain)\b"
    r".{0,40}\bclearance\b"
)
OPT_EXCLUDED = (
    r"\b(?:do|does|will)\s+not\s+(?:accept|consider|support)\b.{0,35}"
    r"\b(?:stem\s+)?opt\b|"
    r"\b(?:stem\s+)?opt\s+(?:candidates?|holders?)\s+(?:are\s+)?not\b|"
    r"\b(?:stem\s+)?opt(?:/cpt|\s+or\s+cpt)?\s+(?:candidates?|holders?)"
    r"\s+(?:will\s+)?not\s+be\s+(?:accepted|considered)\b|"
    r"\bno\s+(?:stem\s+)?opt(?:\s+or\s+cpt)?\b|"
    r"\b(?:not eligible|ineligible)\b.{0,35}\b(?:stem\s+)?opt\b"
)
EXPLICIT_SPONSORSHIP = (
    r"\b(?:visa|immigration|employment|h-?1b)\s+sponsorship\s+(?:is\s+)?"
    r"(?:available|provided|offered|supported)\b",
    r"\bwe\s+(?:will|can|may)\s+sponsor\b",
    r"\b(?:eligible|considered)\s+for\s+(?:visa|h-?1b)\s+sponsorship\b",
    r"\bh-?1b\s+(?:transfer|sponsorship)\b",
)

REASON_TITLE_CLEARANCE = "job title requires or emphasizes a security clearance"
REASON_NO_SPONSORSHIP = "posting explicitly excludes visa sponsorship"
REASON_CITIZENSHIP = "posting requires US citizenship"
REASON_PERMANENT_RESIDENT = "posting requires citizenship or permanent-resident status"
REASON_CLEARANCE = "posting requires or conditions employment on a security clearance"
REASON_OPT_EXCLUDED = "posting explicitly excludes OPT/STEM OPT candidates"
REASON_SPONSORS = "posting explicitly indicates sponsorship support"
REASON_NOT_SPECIFIED = (
    "compatible with current OPT/STEM OPT unless the employer confirms otherwise"
)

# --- fixed values: sponsorship signal texts ---------------------------------

SIGNAL_EXPLICIT_HISTORY = (
    "JD indicates sponsorship support; DOL history: %d approvals (%s%%)."
)
SIGNAL_EXPLICIT_ONLY = (
    "JD indicates sponsorship support; no DOL history found in loaded datasets."
)
SIGNAL_HISTORY = (
    "JD has no work-authorization exclusion; DOL history: %d approvals (%s%%). "
    "Confirm future sponsorship."
)
SIGNAL_NONE = (
    "JD has no work-authorization exclusion; no DOL sponsorship history found. "
    "OPT/STEM OPT may work now, but future sponsorship is unconfirmed."
)

# --- fixed values: boards, URLs and search ----------------------------------

PLATFORMS = ("greenhouse", "lever", "ashby", "smartrecruiters", "workday")
ATS_URL_MARKERS = (
    "greenhouse.io", "ashbyhq.com", "lever.co", "myworkdayjobs.com",
    "jobvite.com", "smartrecruiters.com", "icims.com", "oraclecloud.com",
    "eightfold.ai", "apply.workable.com", "recruitee.com", "successfactors.com",
)
ATS_URL_MARKERS_SHORT = (
    "greenhouse.io", "ashbyhq.com", "lever.co", "myworkdayjobs.com",
    "smartrecruiters.com", "jobvite.com", "icims.com",
)
SEARCH_SITES = (
    "boards.greenhouse.io", "jobs.ashbyhq.com", "jobs.lever.co", "myworkdayjobs.com",
    "jobvite.com", "smartrecruiters.com", "icims.com",
)
LEGAL_SUFFIX_WORDS = (
    "co", "company", "corp", "corporation", "inc", "incorporated", "international",
    "llc", "ltd", "limited", "plc", "software", "systems", "technologies",
    "technology", "group", "holdings", "energy", "labs",
)
# platform, identifier, company, base_url, site
SEED_TARGETS = (
    ("greenhouse", "spacex", "SpaceX", "", ""),
    ("greenhouse", "pinterest", "Pinterest", "", ""),
    ("greenhouse", "rubrik", "Rubrik", "", ""),
    ("greenhouse", "clickhouse", "ClickHouse", "", ""),
    ("ashby", "cerebras", "Cerebras Systems", "", ""),
    ("ashby", "Crusoe", "Crusoe Energy Systems", "", ""),
    ("ashby", "ramp", "Ramp", "", ""),
    ("ashby", "socure", "Socure", "", ""),
    ("lever", "zoox", "Zoox", "", ""),
    ("lever", "shieldai", "Shield AI", "", ""),
    ("lever", "veeva", "Veeva Systems", "", ""),
    ("smartrecruiters", "Visa", "Visa", "", ""),
    ("smartrecruiters", "Canva", "Canva", "", ""),
    ("smartrecruiters", "Wabtec", "Wabtec", "", ""),
    ("workday", "nvidia", "NVIDIA", "https://nvidia.wd5.myworkdayjobs.com",
     "NVIDIAExternalCareerSite"),
    ("workday", "paypal", "PayPal", "https://paypal.wd1.myworkdayjobs.com", "jobs"),
)
# level, query text
SEARCH_QUERIES = (
    ("newgrad",
     "(site:boards.greenhouse.io OR site:jobs.ashbyhq.com OR site:jobs.lever.co OR "
     "site:myworkdayjobs.com OR site:jobs.jobvite.com OR site:smartrecruiters.com OR "
     "site:icims.com OR site:fa.oraclecloud.com/hcmUI/CandidateExperience OR "
     "site:eightfold.ai/careers OR site:apply.workable.com OR site:recruitee.com) "
     '("New Grad" OR "University" OR "Associate Software" OR '
     '"Associate MTS" OR "SMTS" OR "Entry Level" OR "SDE I" OR "Junior Software" OR '
     '"Campus" OR "Early Talent" OR "Rotational" OR "Technology Analyst") '
     '("Software Engineer" OR "Developer" OR "SDE") -Senior -Sr -Staff -Principal -Director'),
    ("midlevel",
     "(site:boards.greenhouse.io OR site:jobs.ashbyhq.com OR site:jobs.lever.co OR "
     "site:myworkdayjobs.com OR site:jobs.jobvite.com OR site:smartrecruiters.com OR "
     "site:fa.oraclecloud.com/hcmUI/CandidateExperience OR site:eightfold.ai/careers OR "
     "site:apply.workable.com OR site:recruitee.com) "
     '("Software Engineer" OR "Application Developer" OR "SDE II" OR "SDE 2" OR '
     '"MTS" OR "Member of Technical Staff" OR "Backend") '
     '("Distributed Systems" OR "Java" OR "Cloud") '
     '-Intern -Senior -Sr -Staff -Principal -Director -"New Grad"'),
)
BOARD_LISTING_CAP = 500

# --- fixed values: résumé skills --------------------------------------------

KNOWN_SKILLS = (
    "Java", "Python", "SQL", "C/C++", "Go", "TypeScript", "Bash",
    "Spring Boot", "Django", "Next.js", "React", "PyTest", "JUnit",
    "PyTorch", "AWS", "Kubernetes", "Docker", "Terraform", "Kafka",
    "Jenkins", "Prometheus", "Grafana", "PostgreSQL", "pgvector",
    "MongoDB", "Redis", "Supabase", "OpenSearch", "Spark",
    "Distributed Systems", "Microservices", "Event-Driven Architecture",
    "CI/CD", "REST", "GraphQL", "System Design", "RAG", "LLM",
    "LangChain", "MCP", "Agents",
)
DEFAULT_PROFILE = "SDE"

# --- fixed values: filings ---------------------------------------------------

# Field texts a CSV reader takes for a missing value.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
MIN_QUALITY_APPROVALS = 3
MIN_SPONSOR_RATE = 70
RELEASE_MIN_BYTES = 10_000

# --- fixed values: matching --------------------------------------------------

MATCH_THRESHOLD = 0.4
MATCH_LIMIT = 50
SCORE_LIMIT = 20
NOTIFY_SCORE = 80
COMPANY_CAP = 10
PROMPT_CHARS = 2000
PROMPT_LINES_DESCRIPTION_CHARS = 1500
SCORE_OBJECT = r"\{[^{}]*(?:\{[^{}]*\}[^{}]*)*\}"
RETRY_HINT = r"try again in\s+([0-9.]+)\s*(ms|s)"
SCORE_SYSTEM_PROMPT = (
    "You are an expert job matching AI. You MUST respond with ONLY a valid JSON object, "
    "no other text.\nReturn exactly this format:\n"
    '{"score": <0-100 integer>, "reasoning": "<2-3 sentence explanation>", '
    '"key_matches": ["<skill1>", "<skill2>", "<skill3>"]}'
)
# The prompt for a local model, which answers in lines (fixed text, the remark after the résumé included).
SCORE_LINES_TEMPLATE = (
    "You are an expert career advisor. Analyze how well this resume matches the job posting.\n\n"
    "Resume:\n%s  # Truncate to fit context\n\n"
    "Job Title: %s\nCompany: %s\nJob Description:\n%s\n\n"
    "Provide:\n1. A relevance score from 0-100 (where 100 is perfect match)\n2. Brief reasoning (2-3 sentences)\n\n"
    "Format your response as:\nSCORE: <number>\nREASONING: <explanation>\n"
)
SCORE_PROMPT_TEMPLATE = (
    "Job Title: %s\nCompany: %s\n\nJob Description:\n%s\n\nResume:\n%s\n\n"
    "Rate this job's relevance to the resume (0-100). Focus on:\n"
    "1. Required skills match\n2. Experience level alignment\n"
    "3. Domain/industry fit\n4. Career progression potential\n\n"
    "Respond with ONLY a JSON object."
)

# --- fixed values: text ------------------------------------------------------

# Every white-space character of Unicode, as Python's ``str.strip`` counts them.
WHITESPACE = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())
# Free-text date formats accepted besides ISO 8601.
DATE_FORMATS = (
    "d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm:ss z",
    "MMMM d yyyy", "MMM d yyyy", "d MMMM yyyy", "d MMM yyyy", "M/d/yyyy", "M/d/yy", "yyyy/M/d", "yyyy.M.d",
    "yyyyMMdd",
)
# May follow a date without a time.
TIME_OF_DAY = "[ h:mm[:ss] a][ H:mm[:ss]]"
