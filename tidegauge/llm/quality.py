"""Quality rules under weak supervision.

Each rule looks at one measure of a text and votes good, bad or abstains. How far each rule
can be trusted is not given but estimated: expectation-maximisation fits, without labels, the
chance of each vote for good and for bad documents, from how often the vote patterns occur
together over all documents. A document is kept if its posterior probability of being good is
at least one half. The measures also give two hard base rules, which reject by themselves.

Eight rules with three outcomes make at most 3**8 = 6,561 vote patterns, whatever the number
of documents; only their counts come to the driver.

Nulls: a null text has no words, so the base rule rejects it. Empty texts likewise. Equal
texts get equal verdicts. An empty table gives an empty result.
"""

import math
import operator
import re

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.llm.common import keep, ready

# The symbols counted, and frequent words of four languages.
SYMBOLS = b"#*$%&|<>"
STOP_WORDS = frozenset(w.encode() for w in (
    "the of and to in is that for with on are was as at be by or from this it an have has not "
    "de la le les des et un une du en que est dans pour sur par au avec pas "
    "der die das und ein eine zu den von mit ist im für auf dem nicht sich "
    "el los las y por con una para se del al como").split())

# Fixed values: (measure, good up to, bad from); between the two the rule abstains.
RULES = (
    ("symbols", 0.02, 0.10),
    ("repeats", 0.02, 0.10),
    ("duplicate_lines", 0.05, 0.30),
    ("capitals", 0.15, 0.40),
    ("marks", 0.25, 0.50),
    ("odd_words", 0.15, 0.30),
    ("echoes", 0.05, 0.30),
    ("no_stop_words", 0.94, 0.98),
)
BASE = T.StructType([
    *[T.StructField(n, T.LongType()) for n in
      ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
    T.StructField("base_failed", T.BooleanType()), T.StructField("votes", T.StringType())])
_BLANK = " \t\r\x0b\x0c"
_LETTER = re.compile(rb"[A-Za-z\x80-\xff]")


def repeated_words(words, width=5):
    """Words within windows of ``width`` words that occur twice or more in the list."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    grams = list(zip(*[words[i:] for i in range(width)], strict=False))
    if len(set(grams)) == n:
        return 0
    count = {}
    for gram in grams:
        count[gram] = count.get(gram, 0) + 1
    often = np.fromiter((count[g] > 1 for g in grams), bool, n)
    edge = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(often)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + width, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def measure(text):
    """Base counts of a text and what the rules look at."""
    raw = text.encode("utf-8", "replace")
    words = raw.split()  # bytes are split at ASCII white space only
    n = len(words)
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    blanks = int(count[9:14].sum() + count[32])
    symbols = int(sum(count[b] for b in SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(_BLANK)]
    doubles = len(lines) - len(set(lines))
    repeats = repeated_words(words)
    upper, lower = int(count[65:91].sum()), int(count[97:123].sum())
    high = int((count[0xC3:0xE0]).sum())
    marks = int(sum(count[b] for b in b"!?;:.,"))
    odd = sum(1 for w in words if not _LETTER.search(w))
    stops = sum(map(STOP_WORDS.__contains__, words))
    chars = len(text) - blanks
    echoes = sum(map(operator.eq, words, words[1:]))
    measures = {
        "symbols": symbols / max(1, n),
        "repeats": repeats / max(1, n),
        "duplicate_lines": doubles / max(1, len(lines)),
        "capitals": upper / max(1, upper + lower + high),
        # Allowances keep a few words from voting on what only longer texts show.
        "marks": max(0, marks - 4) / max(1, n),
        "odd_words": odd / max(1, n),
        "echoes": echoes / max(1, n),
        "no_stop_words": 1 - (stops + 2) / (n + 5),
    }
    failed = n < 10 or 100 * repeats > 20 * n
    return (n, chars, symbols, doubles, repeats, failed), measures


def votes(measures):
    """One letter for each rule: g, b or - for abstaining."""
    return "".join("g" if measures[name] <= good else "b" if measures[name] >= bad else "-"
                   for name, good, bad in RULES)


@F.pandas_udf(BASE)
def judged(texts: pd.Series) -> pd.DataFrame:
    found = []
    for text in texts:
        base, measures = measure(text if isinstance(text, str) else "")
        found.append((*base, votes(measures)))
    return pd.DataFrame(found, columns=BASE.names)


def fit(patterns, rounds=200, tolerance=1e-9, weight=1.0):
    """Expectation-maximisation over {pattern: documents}.

    Returns (prior, rates, posterior): rates[class][rule][vote] with class 1 good, and the
    probability of good for each pattern. It starts from majority votes, which decides which
    class is the good one, and smooths every rate by ``weight`` documents.
    """
    keys = sorted(patterns)
    if not keys:
        return 0.5, None, {}
    n_rules = len(keys[0])
    letters = "gb-"
    one = np.array([[letters.index(v) for v in k] for k in keys])
    mass = np.array([patterns[k] for k in keys], float)
    lead = (one == 0).sum(1) - 2.0 * (one == 1).sum(1)
    good = 1 / (1 + np.exp(-lead))
    rates = np.zeros((2, n_rules, 3))
    prior, last = 0.5, -math.inf
    for _ in range(rounds):
        for c, share in ((1, good * mass), (0, (1 - good) * mass)):
            for r in range(n_rules):
                got = np.bincount(one[:, r], share, 3) + weight / 3
                rates[c, r] = got / got.sum()
        prior = float(np.clip((good * mass).sum() / mass.sum(), 1e-6, 1 - 1e-6))
        logs = [np.log(p) + np.log(rates[c][np.arange(n_rules), one]).sum(1)
                for c, p in ((0, 1 - prior), (1, prior))]
        whole = np.logaddexp(*logs)
        good = np.exp(logs[1] - whole)
        fitted = float((mass * whole).sum())
        if abs(fitted - last) <= tolerance * abs(fitted):
            break
        last = fitted
    return prior, rates, dict(zip(keys, good.tolist(), strict=True))


def posteriors(voted):
    """Posterior of every vote pattern in ``voted`` as a table (votes, p_good)."""
    counted = voted.groupBy("votes").count().collect()
    posterior = fit({r["votes"]: r["count"] for r in counted})[2]
    return voted.sparkSession.createDataFrame(list(posterior.items()),
                                              "votes string, p_good double")


def verdicts(voted, least=0.5):
    """Adds p_good and kept to rows with base_failed and votes."""
    table = F.broadcast(posteriors(voted))  # at most 3**8 rows
    kept = ~F.col("base_failed") & (F.col("p_good") >= least)
    return voted.join(table, "votes").withColumn("kept", kept)


def score(docs, key="doc_id", text="text"):
    """(key, base counts, base_failed, votes, p_good, kept) of each document."""
    ready(docs.sparkSession)
    rows = docs.select(F.col(key), judged(F.col(text)).alias("_r")).select(key, "_r.*")
    return verdicts(keep(rows, "quality"))


def keep_good(docs, text="text", least=0.5):
    """The documents that the rules keep, with all their columns.

    The rules look at each text twice, to fit and to filter: their votes are many times cheaper
    than a copy of the texts.
    """
    ready(docs.sparkSession)
    votes_ = docs.select(judged(F.col(text)).alias("_r")).select("_r.votes")
    counted = votes_.groupBy("votes").count().collect()  # at most 3**8 rows
    good = {v for v, p in fit({r["votes"]: r["count"] for r in counted})[2].items() if p >= least}

    @F.pandas_udf(T.BooleanType())
    def passes(texts: pd.Series) -> pd.Series:
        found = []
        for text in texts:
            base, measures = measure(text if isinstance(text, str) else "")
            found.append(not base[-1] and votes(measures) in good)
        return pd.Series(found, dtype=bool)

    return docs.filter(passes(F.col(text)))
