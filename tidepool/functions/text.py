"""Text cleaning, tokenising and the comma-list <-> array edge functions.

All functions return Column expressions built from Spark built-ins, so they
stay inside whole-stage codegen and Catalyst can prune around them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidepool.functions._col import as_col

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for identical results).
# English stopword list of the NLTK corpus, in its published order. Entries
# with an apostrophe are kept although cleaned text never contains one.
STOPWORDS_EN = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you",
    "you're", "you've", "you'll", "you'd", "your", "yours", "yourself",
    "yourselves", "he", "him", "his", "himself", "she", "she's", "her",
    "hers", "herself", "it", "it's", "its", "itself", "they", "them",
    "their", "theirs", "themselves", "what", "which", "who", "whom", "this",
    "that", "that'll", "these", "those", "am", "is", "are", "was", "were",
    "be", "been", "being", "have", "has", "had", "having", "do", "does",
    "did", "doing", "a", "an", "the", "and", "but", "if", "or", "because",
    "as", "until", "while", "of", "at", "by", "for", "with", "about",
    "against", "between", "into", "through", "during", "before", "after",
    "above", "below", "to", "from", "up", "down", "in", "out", "on", "off",
    "over", "under", "again", "further", "then", "once", "here", "there",
    "when", "where", "why", "how", "all", "any", "both", "each", "few",
    "more", "most", "other", "some", "such", "no", "nor", "not", "only",
    "own", "same", "so", "than", "too", "very", "s", "t", "can", "will",
    "just", "don", "don't", "should", "should've", "now", "d", "ll", "m",
    "o", "re", "ve", "y", "ain", "aren", "aren't", "couldn", "couldn't",
    "didn", "didn't", "doesn", "doesn't", "hadn", "hadn't", "hasn",
    "hasn't", "haven", "haven't", "isn", "isn't", "ma", "mightn",
    "mightn't", "mustn", "mustn't", "needn", "needn't", "shan", "shan't",
    "shouldn", "shouldn't", "wasn", "wasn't", "weren", "weren't", "won",
    "won't", "wouldn", "wouldn't",
]

# Characters kept by the cleaner, and the URL shape it removes: a word
# (letters, digits, underscore in any script), "://", then non-blank text.
# Blank = Unicode white space plus the separators \x1C-\x1F, as Python's
# ``str.split`` sees it. Written without \w / \s so that Java and RE2
# read it alike.
URL_TAIL = r"[^\s\x0B\x1C-\x1F\x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
CLEAN_PATTERN = r"([^0-9A-Za-z \t])|([\p{L}\p{N}_]+://" + URL_TAIL + ")"
URL_PATTERN = r"[0-9A-Za-z][\p{L}\p{N}_]*://" + URL_TAIL
KEEP_RUNS = r"[0-9A-Za-z \t]+"
# Tokens of cleaned text (only [0-9a-z], space and tab are left), the tweet
# tokenizer's rules in its order, first match wins: a phone number (optional
# 0/1 prefix, optional 3-digit area code, 3 + 4 digits, blanks allowed
# between the parts), an "8d"/"d8"-style emoticon, a run of 3+ letters, any
# other alphanumeric run.
TOKEN_PATTERN = r"(?:[01] *)?(?:[0-9]{3} *)?[0-9]{3} *[0-9]{4}|8o?[dp]|[dp]o?8|[a-z]{3,}|[0-9a-z]+"
# ---------------------------------------------------------------------------


def _kept_text(c) -> Column:
    """Lower-cased text with URLs and every character outside [0-9A-Za-z
    space tab] deleted (not blanked: ``a\nb`` -> ``ab``, as the reference).

    Equivalent to one ``regexp_replace`` with ``CLEAN_PATTERN``, but built
    for speed: a URL can only start where the character filter keeps a
    character (an ASCII letter or digit), so URLs go first with
    ``URL_PATTERN`` (only in texts containing "://"); the kept runs are then
    collected with ``regexp_extract_all`` and concatenated, which scales
    with cores where a replace with one match per accent does not."""
    low = F.lower(as_col(c))
    no_urls = F.when(F.instr(low, "://") > 0, F.regexp_replace(low, URL_PATTERN, "")).otherwise(low)
    return F.array_join(F.regexp_extract_all(no_urls, F.lit(KEEP_RUNS), 0), "")


def clean_text(c) -> Column:
    """Lower-case, drop URLs and every character outside [0-9A-Za-z space
    tab], then squeeze blank runs to one space and strip the ends."""
    words = F.filter(F.split(_kept_text(c), r"[ \t]+", -1), lambda w: w != "")
    return F.array_join(words, " ")


def tokens(c, stopwords: list[str] | None = None, clean: bool = True) -> Column:
    """Tokens of cleaned text with stopwords removed, as array<string>."""
    text = clean_text(c) if clean else as_col(c)
    words = F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), 0)
    stop = STOPWORDS_EN if stopwords is None else stopwords
    if not stop:
        return words
    # ``isin`` over a literal list becomes a hash-set lookup (InSet).
    return F.filter(words, lambda w: ~w.isin(list(stop)))


def split_entities(c, lower: bool = True) -> Column:
    """Comma-joined text -> array of non-empty items (lower-cased for tags
    and mentions; URLs keep their case)."""
    col = as_col(c)
    col = F.lower(col) if lower else col
    return F.filter(F.split(F.coalesce(col, F.lit("")), ","), lambda x: x != "")


def join_list(arr, prefix: str = "") -> Column:
    """array<string> -> comma-joined text, each item prefixed."""
    a = as_col(arr)
    if prefix:
        a = F.transform(a, lambda x: F.concat(F.lit(prefix), x))
    return F.coalesce(F.array_join(a, ","), F.lit(""))
