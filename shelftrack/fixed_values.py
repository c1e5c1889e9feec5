"""Names, labels, word lists and patterns that results depend on.

They are part of the data contract, not of the logic, and are therefore kept
together here. Patterns use Java syntax.
"""

CURRENCY = "RSD"
CURRENCY_LENGTH = 3
LOCAL_ZONE = "Europe/Belgrade"
MISSING_TEXT = "None"
UNKNOWN_AUTHOR = "Nepoznat Autor"
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
MULTI_PUBLISHER_HOST = "mikroknjiga.rs"
SOURCES = ("laguna", "mikrok", "prometej")

RECORD_FIELDS = (
    "title", "author", "book_link", "category", "old_price",
    "discount_price", "currency", "publisher", "description",
)
REQUIRED_COLUMNS = RECORD_FIELDS + ("scraped_at",)
REQUIRED_VALUES = ("title", "book_link", "publisher", "scraped_at")

# Cells a default text-frame CSV reader takes as missing.
NA_CELLS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

SCRAPED_AT_FORMAT = "yyyy-MM-dd HH:mm:ss z"
LANDING_FOLDER = "books_publishers"
STATS_FOLDER = "stats"
PROJECT_VERSION = "1.0"
MONITORING_CLOCK_SHIFT_HOURS = 2

# Description patterns.
ISBN_PATTERN = r"(?iu)(?:ISBN|ИСБН)\s*[: ]?\s*([0-9-]+[0-9X])"
ISBN_SHAPE = r"^(\d{9}[0-9Xx]|\d{13})\z"
ISBN_SEPARATORS = r"[-\s]"
PUBLISHER_PATTERN = r"(?iu)Izdavač:\s*([^\n]+)"
LABELS_AFTER_PUBLISHER = (
    "Strana u boji:", "Strana:", "Povez:", "Pismo:", "Format:", "Godina",
    "Naslov originala:", "Izdavač originala:",
)
PAGE_PATTERNS = (
    r"Broj strana:\s*(\d+)",
    r"Strana:\s*(\d+)",
    r"Страна:\s*(\d+)",
    r"(?s)Број страна /.*?(\d+)\s*/",
    r"Strana u boji:\s*(\d+)",
)
YEAR_PATTERN = r"(1[89]\d{2}|20[0-2]\d|202[0-5])"
LINK_PATTERN = r"(?i)^https?://.+"

LATIN_SCRIPT = "Latinica"
LATIN_WORDS = (
    "latinica", "latinična", "latinicno", "latinic", "латиница",
    "latinicirilica", "cirilatinića",
)
CYRILLIC_SCRIPT = "Ćirilica"
CYRILLIC_WORDS = ("ćirilica", "ćirilična", "ćirilicno", "ćirilic", "ћирилица")

# Price text: kept characters and the two endings of a text that mark decimals.
PRICE_NOISE = r"[^0-9.,]+"
COMMA_DECIMALS = r",\d{2}"
DOT_DECIMALS = r"\.\d{2}"

DATE_LIMIT = "2030-12-31"
OUTLIER_DEVIATIONS = 5
FRESHNESS_WARN_HOURS = 24
FRESHNESS_ERROR_HOURS = 25
NEW_BOOK_DAYS = 7
CHANGE_MONTHS = 1
CHANGE_TOP = 100
ITEMS_PER_SOURCE = 2
