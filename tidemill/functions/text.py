"""Text cleaning and tokens as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The English stop words.
ENGLISH_STOP_WORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "you're", "you've", "you'll", "you'd",
    "your", "yours", "yourself", "yourselves", "he", "him", "his", "himself", "she", "she's", "her", "hers",
    "herself", "it", "it's", "its", "itself", "they", "them", "their", "theirs", "themselves", "what", "which",
    "who", "whom", "this", "that", "that'll", "these", "those", "am", "is", "are", "was", "were", "be", "been",
    "being", "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an", "the", "and", "but", "if",
    "or", "because", "as", "until", "while", "of", "at", "by", "for", "with", "about", "against", "between", "into",
    "through", "during", "before", "after", "above", "below", "to", "from", "up", "down", "in", "out", "on", "off",
    "over", "under", "again", "further", "then", "once", "here", "there", "when", "where", "why", "how", "all",
    "any", "both", "each", "few", "more", "most", "other", "some", "such", "no", "nor", "not", "only", "own",
    "same", "so", "than", "too", "very", "s", "t", "can", "will", "just", "don", "don't", "should", "should've",
    "now", "d", "ll", "m", "o", "re", "ve", "y", "ain", "aren", "aren't", "couldn", "couldn't", "didn", "didn't",
    "doesn", "doesn't", "hadn", "hadn't", "hasn", "hasn't", "haven", "haven't", "isn", "isn't", "ma", "mightn",
    "mightn't", "mustn", "mustn't", "needn", "needn't", "shan", "shan't", "shouldn", "shouldn't", "wasn", "wasn't",
    "weren", "weren't", "won", "won't", "wouldn", "wouldn't",
]

# Tokens dropped from segmented text.
SEGMENT_STOP_WORDS = ["\n", "", " ", "\n\n"]

# A word of at least two letters, digits or underscores in any script.
WORD_PATTERN = r"[\p{L}\p{N}_]{2,}"


def literal_array(values: Sequence[object]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def remove_stop_words(tokens: Column, stop_words: Sequence[str] = ENGLISH_STOP_WORDS) -> Column:
    """Drops stop words and keeps order and repeats."""
    if not stop_words:
        return tokens
    return F.filter(tokens, lambda t: ~t.isin(*stop_words))


def clean_english(text: Column, stop_words: Sequence[str] = ENGLISH_STOP_WORDS) -> Column:
    """Lower case, brackets and separators to spaces, other symbols dropped, stop words removed.

    Line breaks and tabs count as symbols and are dropped, which joins the words around them.
    """
    spaced = F.regexp_replace(F.lower(text), r"[/(){}\[\]|@,;]", " ")
    # What is kept is put together: replacing each dropped symbol took eight times as long.
    plain = F.array_join(F.regexp_extract_all(spaced, F.lit("[0-9a-z #+_]+"), F.lit(0)), "")
    words = F.filter(F.split(plain, " "), lambda w: w != "")
    return F.array_join(remove_stop_words(words, stop_words), " ")


def keep_cjk(text: Column) -> Column:
    """Only Chinese characters, runs of anything else become one space."""
    spaced = F.regexp_replace(text, "[^一-鿿]", " ")
    return F.trim(F.regexp_replace(spaced, r"\s{2,}", " "))


def space_characters(text: Column) -> Column:
    return F.regexp_replace(text, "(?s)(.)", "$1 ")


def clean_labelled_line(text: Column) -> Column:
    """The cleaning of labelled line files: characters set apart, then only Chinese kept."""
    return keep_cjk(space_characters(text))


def character_tokens(text: Column, stop_words: Sequence[str] = SEGMENT_STOP_WORDS) -> Column:
    """The Chinese characters of a text. A text without any gives one empty token, unless that is a stop word."""
    found = F.regexp_extract_all(text, F.lit("[一-鿿]"), F.lit(0))
    if "" not in stop_words:
        found = F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("")))
    return remove_stop_words(found, stop_words)


def word_tokens(text: Column, pattern: str = WORD_PATTERN, lower: bool = True) -> Column:
    return F.regexp_extract_all(F.lower(text) if lower else text, F.lit(pattern), F.lit(0))


def segment(text: Column, kind: str | None = "word", stop_words: Sequence[str] = ()) -> Column:
    """Word tokens or character tokens without stop words.

    Words of texts without spaces come from ``operators.segmentation``; pass them through ``remove_stop_words``.
    """
    if kind in (None, "word"):
        return remove_stop_words(word_tokens(text, lower=False), stop_words)
    if kind == "char":
        return character_tokens(text, stop_words)
    raise ValueError("kind must be 'word' or 'char'")


def strip_blank_lines(text: Column) -> Column:
    """Every line stripped, empty lines dropped, rejoined with line breaks."""
    lines = F.transform(F.split(text, r"\r?\n"), lambda line: F.regexp_replace(line, r"^\s+|\s+$", ""))
    return F.array_join(F.filter(lines, lambda line: line != ""), "\n")


def pad_tokens(tokens: Column, length: int, padding: str = "<PAD>") -> Column:
    """Cut or filled up to exactly ``length`` tokens."""
    return F.slice(F.concat(tokens, F.array_repeat(F.lit(padding), length)), 1, length)


def ngrams(tokens: Column, low: int, high: int | None = None) -> Column:
    """All runs of ``low`` to ``high`` tokens joined by a space, repeats kept.

    Each list is the list before it zipped with the tokens moved on by one, so the work is linear in the text.
    Pass a plain column: an expression would be evaluated once per use.
    """
    by_length = [tokens]
    for n in range(2, (high or low) + 1):
        moved = F.slice(tokens, n, F.greatest(F.size(tokens), F.lit(0)))
        pairs = F.zip_with(by_length[-1], moved, lambda run, word: F.concat(run, F.lit(" "), word))
        by_length.append(F.filter(pairs, lambda run: run.isNotNull()))
    kept = by_length[low - 1:]
    return kept[0] if len(kept) == 1 else F.concat(*kept)


def content_words(text: Column, stop_words: Sequence[str] = ENGLISH_STOP_WORDS) -> Column:
    """Lower-case words of two characters or more without stop words: the terms of the n-gram counts."""
    return remove_stop_words(word_tokens(text), stop_words)


def url_quote(text: Column) -> Column:
    """Percent encoding that leaves letters, digits, ``_.-~`` and the slash as they are."""
    quoted = F.url_encode(text)
    for form, path in (("+", "%20"), ("*", "%2A"), ("%7E", "~"), ("%2F", "/")):
        quoted = F.replace(quoted, F.lit(form), F.lit(path))
    return quoted
