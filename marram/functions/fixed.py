"""Fixed values.

Results are only right with exactly these numbers, patterns and names, so they
are stated here as they are and nowhere else.
"""

# Text -----------------------------------------------------------------------

# A word is one or more English letters and nothing else.
WORD = r"^[a-zA-Z]+\z"
# A pure number is one or more ASCII digits and nothing else.
NUMBER = r"^[0-9]+\z"
# Runs of the six whitespace characters that Java's \s stands for.
WHITESPACE_RUN = r"[ \t\n\x0B\f\r]+"
# Runs of the five separators of the word count.
SEPARATOR_RUN = r"[ \t\n\r\f]+"
# Runs of whitespace and ASCII punctuation; the underscore belongs to words.
DELIMITER_RUN = r"""[ \t\n\r\f!"\\#$%&()'*+,\-./:;<=>?@\[\]^`{|}~]+"""
# Line ends as a text reader sees them.
LINE_END = r"\r\n|\r|\n"
# A line that starts so opens a document; its id stands in the first quotes.
DOCUMENT_HEADER = "<Document"
# Words must occur this often to be reported by the word count.
FREQUENT_WORD_MINIMUM = 500
# Lines shown by the line search.
LINES_SHOWN = 20
# The index spreads words over this many length ranges, up to this word length.
INDEX_BUCKETS = 8
INDEX_MAX_WORD_BYTES = 30

# Article dumps --------------------------------------------------------------

PAGE_END = "</page>"
MISSING_ID = -1
ELEMENT = "(?s)(<{name}[^>]*?>.+?</{name}>)"
ELEMENT_TEXT = "(?s)<{name}[^>]*?>(.+?)</{name}>"
UTC_INSTANT = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,9})?Z\z"
MINIMUM_REVISIONS = 100
MINIMUM_CONTRIBUTORS = 10
TOP = 3

# Retirement projection ------------------------------------------------------

REFERENCE_YEAR = 2018
MALE = "male"
MALE_AGE, MALE_YEARS_PER_EXTRA = 79, 20
FEMALE_AGE, FEMALE_YEARS_PER_EXTRA = 83, 30
STRATEGY_RATES = {
    "growth": 1.045,
    "balanced": 1.035,
    "conservative": 1.025,
    "cash": 1.01,
}
MODEST_FROM, COMFORTABLE_FROM = 0.56, 1.0
BANDS = ("miserable", "modest", "comfortable")
# Drawn plan values: lowest value and number of values.
START_AGE = (25, 16)
CONTRIBUTION = (5, 16)
RETIREMENT_AGE = (60, 11)

# Rasters --------------------------------------------------------------------

BLACK, WHITE = 0x000000, 0xFFFFFF
EDGE_THRESHOLD = 128
COLOURS = 3
SEPIA = (
    (0.393, 0.769, 0.189),
    (0.349, 0.686, 0.168),
    (0.272, 0.534, 0.131),
)
GAUSSIAN = (
    (2, 4, 5, 4, 2),
    (4, 9, 12, 9, 4),
    (5, 12, 15, 12, 5),
    (4, 9, 12, 9, 4),
    (2, 4, 5, 4, 2),
)
GAUSSIAN_TOTAL = 159
SOBEL_VERTICAL = (
    (-1, 0, 1),
    (-2, 0, 2),
    (-1, 0, 1),
)
SOBEL_HORIZONTAL = (
    (1, 2, 1),
    (0, 0, 0),
    (-1, -2, -1),
)
