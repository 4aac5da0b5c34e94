"""Fixed values.

These lists must stay exactly as written: results (and the DuckDB oracle
SQL, which inlines the same lists) depend on them.
"""

# --- fixed values: MLlib StopWordsRemover default English list (181 words),
# --- in the order Spark ships it.
MLLIB_ENGLISH_STOP_WORDS = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours", "yourself",
    "yourselves", "he", "him", "his", "himself", "she", "her", "hers", "herself", "it", "its", "itself",
    "they", "them", "their", "theirs", "themselves", "what", "which", "who", "whom", "this", "that",
    "these", "those", "am", "is", "are", "was", "were", "be", "been", "being", "have", "has", "had",
    "having", "do", "does", "did", "doing", "a", "an", "the", "and", "but", "if", "or", "because", "as",
    "until", "while", "of", "at", "by", "for", "with", "about", "against", "between", "into", "through",
    "during", "before", "after", "above", "below", "to", "from", "up", "down", "in", "out", "on", "off",
    "over", "under", "again", "further", "then", "once", "here", "there", "when", "where", "why", "how",
    "all", "any", "both", "each", "few", "more", "most", "other", "some", "such", "no", "nor", "not",
    "only", "own", "same", "so", "than", "too", "very", "s", "t", "can", "will", "just", "don", "should",
    "now", "i'll", "you'll", "he'll", "she'll", "we'll", "they'll", "i'd", "you'd", "he'd", "she'd",
    "we'd", "they'd", "i'm", "you're", "he's", "she's", "it's", "we're", "they're", "i've", "we've",
    "you've", "they've", "isn't", "aren't", "wasn't", "weren't", "haven't", "hasn't", "hadn't", "don't",
    "doesn't", "didn't", "won't", "wouldn't", "shan't", "shouldn't", "mustn't", "can't", "couldn't",
    "cannot", "could", "here's", "how's", "let's", "ought", "that's", "there's", "what's", "when's",
    "where's", "who's", "why's", "would",
)

# --- fixed values: the dashboard's product-word stop list, exactly as the
# --- reference writes it (it repeats a few words; it is used as a set).
DASHBOARD_STOP_WORDS = (
    "the", "and", "a", "an", "of", "to", "for", "in", "on", "at", "by", "with", "without",
    "this", "that", "these", "those", "it", "its", "they", "them", "their", "we", "our",
    "you", "your", "i", "my", "me", "he", "she", "him", "her", "but", "or", "so", "nor", "yet",
    "because", "if", "then", "else", "when", "where", "which", "while", "whom", "who", "whose",
    "why", "how", "however", "is", "are", "was", "were", "be", "been", "being", "am", "have",
    "has", "had", "having", "do", "does", "did", "doing", "can", "could", "will", "would",
    "should", "may", "might", "must", "shall", "up", "down", "off", "over", "under", "again",
    "further", "once", "here", "there", "all", "any", "both", "each", "few", "more", "most",
    "other", "some", "such", "no", "not", "only", "own", "same", "than", "through", "until",
    "very", "really", "just", "like", "get", "got", "make", "made", "much", "many", "lot",
    "also", "even", "though", "although", "well", "good", "nice", "bad", "poor", "little",
    "bit", "quite", "rather", "somewhat", "anything", "nothing", "everything", "everyone",
    "nobody", "anyone", "someone", "one", "two", "three", "four", "five", "six", "seven",
    "eight", "nine", "ten", "first", "second", "third", "next", "last", "previous", "final",
    "initial", "product", "item", "pack", "packaging", "box", "bag", "bottle", "bought",
    "purchase", "purchased", "order", "ordered", "received", "arrived", "delivery",
    "shipping", "shipped", "buy", "buying", "use", "used", "using", "eat", "eating", "ate",
    "drink", "drinking", "drank", "food", "snack", "meal", "time", "days", "week", "month",
    "year", "back", "again", "since", "until", "while", "after", "before", "during",
    "without", "please", "thanks", "thank", "appreciate", "recommend", "recommended",
)

# --- fixed values: text-cleaning patterns (Java regex syntax).
TAG_PATTERN = r"<[^>]+>"
URL_PATTERN = r"https?://\S+|www\.\S+"
NON_LETTER_PATTERN = r"[^a-z\s]"
BLANKS_PATTERN = r"\s+"

# --- fixed values: label / sentiment coding.
# Score 1-2 -> 0 negative, 3 -> 1 neutral, 4-5 -> 2 positive.
SENTIMENTS = ("negative", "neutral", "positive")

# --- fixed values: thresholds.
MIN_TEXT_LENGTH = 10          # keep cleaned_text strictly longer than this
MIN_RETRAIN_SAMPLES = 300     # retraining is skipped below this many rows
PROMOTION_GAIN = 0.015        # absolute F1 gain a candidate must exceed
NEGATIVE_THRESHOLD = 0.35     # optional negative-class override
WATCHLIST_SIZE = 50
LENGTH_CAP = 3000             # EDA clip for length histograms / box plots
LENGTH_BINS = 50
