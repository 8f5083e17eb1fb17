"""Column expressions over raw text lines."""

from pyspark.sql import functions as F

# Fixed value: the characters a JVM regular expression counts as \s.
_BLANKS = " \t\n\x0b\f\r"


def comma_fields(line):
    """Comma fields without trailing empty ones (``'a,b,,'`` has two)."""
    return F.split(F.rtrim(line, F.lit(",")), ",")


def blank_fields(line):
    """Blank-separated fields; a leading blank gives an empty first field."""
    return F.split(F.rtrim(line, F.lit(_BLANKS)), r"[\s]+")


# Fixed value: what a token is made of.
_TOKEN = r"[\p{L}\p{M}\p{N}_]"


def _any_word(words):
    """Matches any of the words as a whole token, in any case.

    The word comes first and its surroundings are looked at only where it is found: asked
    at every position, they cost several times as much.
    """
    found = [rf"\Q{w}\E(?!{_TOKEN})(?<!{_TOKEN}\Q{w}\E)" for w in words]
    return "(?iu)" + "|".join(found)


# From as many terms on, tokens are looked up; fewer are found faster by one expression.
MANY_TERMS = 50


# Fixed value: the other characters that a regular expression without regard to case takes for s, k, i.
_LIKE_ASCII = ("\u017f\u212a\u0130\u0131", "skii")


def _plain(word):
    """Whether a term is one token of ASCII letters and digits."""
    return word.isalnum() and word.isascii()


def _among(text, words):
    """Whether one of the tokens of the text is among ``words``; each token is looked up.

    The cost of a text does not grow with the terms: they are a hash set made once for a task.
    """
    lower = F.lower(F.translate(text, *_LIKE_ASCII))
    tokens = F.regexp_extract_all(lower, F.lit(f"({_TOKEN}+)"), F.lit(1))
    known = sorted({w.lower() for w in words})
    return F.exists(tokens, lambda t: t.isin(known)) if known else F.lit(False)


def has_keyword(text, terms):
    """True where the text holds any term as a whole token, in any case.

    A term of several words asks for each of its words, in any order.
    """
    split = [term.split() for term in terms]
    if not split or not all(split) or any(r"\E" in term for term in terms):
        raise ValueError(f"bad keywords {terms!r}")
    if len(split) >= MANY_TERMS:
        plain = [words for words in split if len(words) == 1 and _plain(words[0])]
        split = [words for words in split if not (len(words) == 1 and _plain(words[0]))]
        found = _among(text, [words[0] for words in plain])
        return found | _any_term(text, split) if split else found
    return _any_term(text, split)


def _any_term(text, split):
    single = [words[0] for words in split if len(words) == 1]
    found = text.rlike(_any_word(single)) if single else F.lit(False)
    for words in split:
        if len(words) > 1:
            every = F.lit(True)
            for word in words:
                every = every & text.rlike(_any_word([word]))
            found = found | every
    return found
