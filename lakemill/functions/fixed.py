"""Word lists, limits and column lists that results depend on."""

# Months and chunking.
ROWS_PER_PERIOD = 10_000
BASE_MONTH = "2024-11"
SEED = 42

# Text limits.
MIN_TOKEN_LEN = 3
MIN_CHARS = 50
MAX_CHARS = 100_000
MARKER = "escapenumber"

# Keywords counted in cleaned text.
SPAM_KEYWORDS = [
    "free", "win", "winner", "cash", "prize", "offer",
    "discount", "cheap", "deal", "limited", "urgent",
    "congratulations", "unsubscribe", "credit", "loan",
    "viagra", "casino", "lottery", "guarantee", "investment",
    "click here", "act now", "order now", "special promotion",
]

# Texts that stand for a missing value.
PLACEHOLDERS = ["na", "n/a", "none", "null", "unknown"]

# Spam share outside these bounds raises the monthly flag.
SPAM_SHARE_LOW = 0.10
SPAM_SHARE_HIGH = 0.90

# Features left out of, and kept in, the gold table.
DROPPED_FEATURES = [
    "repetition_ratio", "info_density", "complexity", "spam_keyword_count", "log_words",
    "has_escapenumber", "question_count", "digit_ratio", "upper_ratio",
]
NUMERIC_FEATURES = ["log_chars", "avg_word_length", "unique_word_ratio", "exclaim_count"]

# Silver columns in table order.
SILVER_FEATURES = [
    "char_count", "word_count", "n_unique_words", "avg_word_length", "log_chars", "log_words",
    "unique_word_ratio", "repetition_ratio", "complexity", "info_density",
    "exclaim_count", "question_count", "digit_ratio", "upper_ratio",
    "spam_keyword_count", "has_escapenumber",
]

# Numeric features profiled per class.
PROFILE_FEATURES = [
    "char_count", "word_count", "avg_word_length", "unique_word_ratio",
    "repetition_ratio", "complexity", "info_density",
    "exclaim_count", "question_count", "digit_ratio", "upper_ratio",
    "spam_keyword_count", "log_chars", "log_words",
]

# Numeric features of the cross-validated baseline.
BASELINE_FEATURES = [
    "char_count", "word_count", "avg_word_length", "unique_word_ratio", "repetition_ratio",
    "complexity", "exclaim_count", "question_count", "digit_ratio", "upper_ratio",
    "spam_keyword_count", "has_escapenumber", "log_chars", "log_words",
]

# Split shares and term weighting.
VAL_SHARE = 0.15
NGRAMS = (1, 2)
MIN_DF = 5
MAX_DF = 0.95
MAX_TERMS = 30_000

# Drift limits.
DRIFT_TERMS = 100
DRIFT_MIN_DF = 2
PSI_BINS = 10
PSI_FLOOR = 1e-6
PSI_CUTOFF = 0.1
PSI_FULL = 0.25
KS_EXACT = 10_000
P_CUTOFF = 0.05
CHI2_CUTOFF = 3.841458820694124
DRIFT_GATE = 0.25
REF_MONTHS = 6

# Scoring and selection.
TARGET_PRECISION = 0.99
DEFAULT_THRESHOLD = 0.5
CANDIDATES = ["lr", "nb", "rf", "hgb"]
EMPTY_NOTE = "input contained no usable tokens after cleaning"

# Words of the mail trade added to the stop words.
DOMAIN_STOP_WORDS = ["click", "here", "free", "offer", "limited"]

# The English stop words commonly used for word counts.
STOP_WORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "you're", "you've", "you'll",
    "you'd", "your", "yours", "yourself", "yourselves", "he", "him", "his", "himself", "she", "she's",
    "her", "hers", "herself", "it", "it's", "its", "itself", "they", "them", "their", "theirs",
    "themselves", "what", "which", "who", "whom", "this", "that", "that'll", "these", "those", "am",
    "is", "are", "was", "were", "be", "been", "being", "have", "has", "had", "having", "do", "does",
    "did", "doing", "a", "an", "the", "and", "but", "if", "or", "because", "as", "until", "while",
    "of", "at", "by", "for", "with", "about", "against", "between", "into", "through", "during",
    "before", "after", "above", "below", "to", "from", "up", "down", "in", "out", "on", "off", "over",
    "under", "again", "further", "then", "once", "here", "there", "when", "where", "why", "how",
    "all", "any", "both", "each", "few", "more", "most", "other", "some", "such", "no", "nor", "not",
    "only", "own", "same", "so", "than", "too", "very", "s", "t", "can", "will", "just", "don",
    "don't", "should", "should've", "now", "d", "ll", "m", "o", "re", "ve", "y", "ain", "aren",
    "aren't", "couldn", "couldn't", "didn", "didn't", "doesn", "doesn't", "hadn", "hadn't", "hasn",
    "hasn't", "haven", "haven't", "isn", "isn't", "ma", "mightn", "mightn't", "mustn", "mustn't",
    "needn", "needn't", "shan", "shan't", "shouldn", "shouldn't", "wasn", "wasn't", "weren",
    "weren't", "won", "won't", "wouldn", "wouldn't",
]
