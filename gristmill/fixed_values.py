"""Values that must match the published behaviour exactly for results to agree."""

# ---- fixed values: currencies, by leading symbol -------------------------------------------
CURRENCY_BY_SYMBOL = {"£": "GBP", "$": "USD", "€": "EUR"}

# ---- fixed values: star ratings, by class word ---------------------------------------------
RATING_BY_WORD = {"One": 1, "Two": 2, "Three": 3, "Four": 4, "Five": 5}

# ---- fixed values: soft-block markers and the minimum visible text -------------------------
SOFT_BLOCK_MARKERS = (
    "just a moment",
    "checking your browser",
    "attention required",
    "verify you are human",
    "are you a robot",
    "captcha",
    "access denied",
    "please enable javascript and cookies",
    "unusual traffic",
)
MIN_VISIBLE_CHARS = 50

# ---- fixed values: retry budgets and waits (seconds) ---------------------------------------
ATTEMPT_BUDGET = {"rate_limited": 3, "server_error": 3, "timeout_or_network": 4}
RETRY_AFTER_MAX = 60.0
SERVER_ERROR_BASE = 1.0
SERVER_ERROR_MAX = 30.0
SERVER_ERROR_JITTER = 0.25
TIMEOUT_BASE = 0.2
TIMEOUT_MAX = 2.0
TIMEOUT_JITTER = 0.5

# ---- fixed values: circuit breaker ---------------------------------------------------------
BREAKER_FAIL_MAX = 5
BREAKER_RESET_SECONDS = 60.0

# ---- fixed values: dedupe ------------------------------------------------------------------
DEDUPE_TTL_DAYS = 90

# ---- fixed values: quality profiles (dimension, warn, fail) --------------------------------
PROFILES = {
    "strict": (
        ("completeness", 0.99, 0.95),
        ("uniqueness", 0.995, 0.98),
        ("validity", 0.99, 0.95),
        ("consistency", 0.99, 0.95),
    )
}

# ---- fixed values: article clean-up patterns -----------------------------------------------
# letters, numbers of any kind and the underscore in brackets; %s stands for whitespace
CITATION_MARKER = r"\[[%s]*[\p{L}\p{N}_]+[%s]*\]"
CLOSING_PUNCTUATION = ",.;:"
MIN_LEAD_CHARS = 80

# ---- fixed values: frontier of the four registered sites -----------------------------------
PAGED_FRONTIERS = (
    ("books_sandbox", "https://books.toscrape.com/catalogue/page-{page}.html", 1, 50, 0),
    ("quotes_js", "https://quotes.toscrape.com/js/page/{page}/", 1, 10, 0),
    ("quotes_scroll", "https://quotes.toscrape.com/scroll", 1, 1, 15),
)
ARTICLE_SITE = "wikipedia_tech"
ARTICLE_BASE_URL = "https://en.wikipedia.org/wiki/"
ARTICLE_TITLES = (
    "Python_(programming_language)",
    "JavaScript",
    "Rust_(programming_language)",
    "Go_(programming_language)",
    "TypeScript",
    "Hypertext_Transfer_Protocol",
    "Representational_state_transfer",
    "GraphQL",
    "WebSocket",
    "Docker_(software)",
    "Kubernetes",
    "PostgreSQL",
    "Redis",
    "Apache_Kafka",
    "SQLite",
    "Apache_Parquet",
    "DuckDB",
    "Machine_learning",
    "Artificial_intelligence",
    "Artificial_neural_network",
    "Web_scraping",
    "Web_crawler",
    "Robots_exclusion_standard",
    "Rate_limiting",
    "Circuit_breaker_design_pattern",
    "Data_quality",
    "Distributed_computing",
    "Microservices",
    "Continuous_integration",
    "Git",
)

# ---- fixed values: registry rows (id, schedule, strategy, rps, burst) ----------------------
REGISTERED_SITES = (
    ("books_sandbox", "product_listing", "0 2 * * *", "http", 2.0, 5),
    ("quotes_js", "quote", "0 2 * * *", "browser", 2.0, 5),
    ("quotes_scroll", "quote", "0 2 * * *", "browser", 2.0, 5),
    ("wikipedia_tech", "article", "0 2 * * *", "http", 1.0, 1),
)

# ---- fixed values: rejection reasons and page errors ---------------------------------------
REASON_NO_TITLE = "missing title anchor in product listing"
REASON_NO_LINK = "missing detail link in product listing"
REASON_NO_PRICE = "missing price in product listing"
REASON_BAD_PRICE = "cannot parse price from "
REASON_BAD_CURRENCY = "no recognized currency symbol in "
REASON_NO_QUOTE = "missing quote text"
REASON_NO_AUTHOR = "missing author"
REASON_NO_LEAD = "no substantial lead paragraph found"
ERROR_STATUS = "unexpected status "
ERROR_NO_PRODUCTS = "no product listings found on "
ERROR_NO_QUOTES = "no rendered quotes found on "
ERROR_NO_HEADING = "no article heading found on "

# ---- fixed values: quality detail texts ----------------------------------------------------
DETAIL_COMPLETENESS = "mean per-record completeness across %d records"
DETAIL_UNIQUENESS = "%d unique of %d content hashes"
DETAIL_VALIDITY = "%d of %d records failed a validity check"
DETAIL_VALIDITY_EMPTY = "no records to validate"
DETAIL_CONSISTENCY = "price and currency must both be present or both be absent"

# Hours east of Greenwich of the zone names that dates in mail and HTTP headers may carry.
ZONE_HOURS = {
    "UT": 0, "UTC": 0, "GMT": 0, "Z": 0,
    "AST": -4, "ADT": -3, "EST": -5, "EDT": -4, "CST": -6, "CDT": -5,
    "MST": -7, "MDT": -6, "PST": -8, "PDT": -7,
}
