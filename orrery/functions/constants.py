"""Fixed values that must equal the reference's for the same results."""

# --- fixed values -----------------------------------------------------------

# ASCII punctuation removed by the cleaning step (the 32 characters of
# Python's ``string.punctuation``).
ASCII_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# Characters that the sequence tokenizer turns into tokens of their own
# (every ASCII punctuation mark except the angle brackets; '~' is listed
# twice in the original set, which changes nothing).
SEQUENCE_PUNCTUATION = "~!\"#$%&'()*+,-./:;=?@[\\]^_`{|}~"

# Extra stop words of the review classifier.
EXTRA_STOPWORDS = ["movie", "film", "br", "one"]

# Spark's default English stop-word list (``StopWordsRemover``), 181 words.
SPARK_ENGLISH_STOPWORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours",
    "yourself", "yourselves", "he", "him", "his", "himself", "she", "her", "hers", "herself",
    "it", "its", "itself", "they", "them", "their", "theirs", "themselves", "what", "which",
    "who", "whom", "this", "that", "these", "those", "am", "is", "are", "was", "were", "be",
    "been", "being", "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an",
    "the", "and", "but", "if", "or", "because", "as", "until", "while", "of", "at", "by",
    "for", "with", "about", "against", "between", "into", "through", "during", "before",
    "after", "above", "below", "to", "from", "up", "down", "in", "out", "on", "off", "over",
    "under", "again", "further", "then", "once", "here", "there", "when", "where", "why",
    "how", "all", "any", "both", "each", "few", "more", "most", "other", "some", "such", "no",
    "nor", "not", "only", "own", "same", "so", "than", "too", "very", "s", "t", "can", "will",
    "just", "don", "should", "now", "i'll", "you'll", "he'll", "she'll", "we'll", "they'll",
    "i'd", "you'd", "he'd", "she'd", "we'd", "they'd", "i'm", "you're", "he's", "she's",
    "it's", "we're", "they're", "i've", "we've", "you've", "they've", "isn't", "aren't",
    "wasn't", "weren't", "haven't", "hasn't", "hadn't", "don't", "doesn't", "didn't",
    "won't", "wouldn't", "shan't", "shouldn't", "mustn't", "can't", "couldn't", "cannot",
    "could", "here's", "how's", "let's", "ought", "that's", "there's", "what's", "when's",
    "where's", "who's", "why's", "would",
]

# Candidate row counts when folding a flat list of cells into columns.
FOLD_ROW_CANDIDATES = [28, 29, 30, 31]

# Character window around the first match: before, after.
MATCH_WINDOW = (100, 500)

# --- end of fixed values ----------------------------------------------------


def stopwords(extra=EXTRA_STOPWORDS, strip_punctuation: bool = True) -> list[str]:
    """Stop list as used on de-punctuated tokens: entries lose their
    punctuation too, so ``don't`` can match the token ``dont``."""
    words = list(SPARK_ENGLISH_STOPWORDS) + list(extra)
    if strip_punctuation:
        table = str.maketrans("", "", ASCII_PUNCTUATION)
        words = [w.translate(table) for w in words]
    return sorted(set(w for w in words if w))
