"""Default parameters. Every function takes these as keyword arguments; nothing reads them at import."""

# --- fixed values -----------------------------------------------------------------------------
# Host patterns: "*.<domain>/" stands for the domain and all hosts below it.
DOMAIN_PATTERNS = [
    "*.stuff.co.nz/",
    "*.nzherald.co.nz/",
    "*.rnz.co.nz/",
    "*.newsroom.co.nz/",
    "*.tvnz.co.nz/",
    "*.3news.co.nz/",
    "*.one-news.co.nz/",
    "*.biznews.co.nz/",
]

CRAWL_IDS = ["CC-MAIN-2020-16", "CC-MAIN-2020-24", "CC-MAIN-2020-40"]

KEYWORDS = [
    "covid", "coronavirus", "sars-cov-2", "virus",
    "pandemic", "outbreak", "epidemic", "infection", "infections", "transmission", "contagion",
    "vaccine", "vaccination", "vaccines", "immunisation", "hospital", "hospitalised", "icu",
    "ventilator", "health", "ministry of health", "director-general", "medical",
    "lockdown", "alert level", "state of emergency", "quarantine", "isolation", "border",
    "travel ban", "border closure", "biosecurity",
    "social distancing", "physical distancing", "face mask", "mask", "hand sanitiser", "hygiene",
    "covid tracer", "contact tracing", "trace",
    "restric", "reopening", "curfew", "gathering limit", "stay home", "stay home order",
    "cases", "deaths", "fatalities", "positives", "rt rate", "reproduction rate",
    "variant", "omicron", "delta", "alpha", "beta", "gamma",
    "jobkeeper", "support", "business", "economic",
]

CATEGORIES = [
    "health_outcomes",
    "vaccination",
    "lockdown_measures",
    "border_policy",
    "economic_impact",
    "public_behavior",
    "government_response",
    "science_research",
    "international",
    "miscellaneous",
]

MIN_TEXT_CHARS = 100
MAX_CONTENT_CHARS = 50000
LANGUAGES = ["en"]
PROMPT_CONTENT_CHARS = 4000
PREVIEW_CHARS = 200

# The question put to an external classifier; {categories}, {title} and {content} are filled in.
PROMPT = (
    "You are a news article classifier. Classify the following article into exactly ONE of these categories:\n"
    "\n"
    "{categories}\n"
    "\n"
    "Article Title: {title}\n"
    "\n"
    "Article Content:\n"
    "{content}\n"
    "\n"
    "Respond with ONLY the category name, nothing else."
)
# --- end of fixed values ----------------------------------------------------------------------

# Terms that vote for a category in the built-in scorer; the last category takes what nobody claims.
CATEGORY_TERMS = {
    "health_outcomes": ["case", "death", "hospitali", "icu"],
    "vaccination": ["vaccin", "immunis", "dose"],
    "lockdown_measures": ["lockdown", "restriction", "alert level", "curfew"],
    "border_policy": ["border", "quarantine", "managed isolation", "travel"],
    "economic_impact": ["business", "job loss", "economic", "wage subsidy"],
    "public_behavior": ["mask", "distancing", "hygiene"],
    "government_response": ["policy", "cabinet", "minister", "government"],
    "science_research": ["variant", "study", "research", "scientist"],
    "international": ["global", "overseas", "countries", "world"],
}
