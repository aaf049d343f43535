"""Problem 10: pages that are spam of repeated terms, links or product tags.

Phrase shingles of one and two words are exploded from the whole text of every page, words of link targets
included, and the distinct hosts of each phrase are counted over all pages. A page is flagged if both kinds
of evidence agree: it is stitched together from phrases that other hosts have as well, and it has the form
of lists: most of its words stand in lists rather than in sentences (links, tags, offers, terms in a row),
or one term makes up the text. Of a page of lists the phrases count, not their single words, which nearly all
are on other hosts.

Phrases travel as 64-bit hashes. A phrase is known elsewhere if its smallest and its largest host differ,
which is to have two distinct hosts; both combine before the shuffle, so a phrase that a third of all
pages contains costs one row for each task. Counts cover all pages; only pages of the right form are
looked up in them.

Lists of cited works, contents pages, glossaries and footers keep their place and function words and
numbers of pages or years, by which they are told from lists of terms.

Defined results: null, blank and very short texts are no spam; copies of a page on one host count as
one host; a missing host counts as a host of its own; very long texts are read whole; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bibspark.session import cut

#: Words that a page must have, share of them in list form, share of one term, of one word, share of its phrases that other hosts have.
MIN_WORDS = 12
MIN_LIST = 0.35
#: A line of so many words without an end is no sentence.
LONG_LINE = 40
MIN_TERM = 0.38
MIN_WORD = 0.26
MIN_STITCHED = 0.3

#: Function words of the languages of the corpus.
FUNCTION = frozenset(
    "a an the of and or in on at by for from to with as is are was were be been it its this that these those which who we our us they their but not no than then more most can may has have had after before between under over into about near during there here also if whether because since while so such both"
    " el la los las un una unos unas de del y o en con por para que se su sus al es son fue entre como más no"
    " os as um uma dos das do da e em no na nos nas com por para que se seu sua ao à é são foi entre como mais não"
    " le les une des du et ou au aux dans par pour sur avec qui que est sont ce cette ces son sa ses il elle nous plus depuis entre"
    " der die das den dem des ein eine einer eines einem und oder im in am an auf aus bei mit nach von vom zu zum zur für über unter ist sind war wird werden dass durch nicht auch als"
    " и в во на с со к о об от до по за из у для что как это не но или при между над под".split()
)
_URL = re.compile(r"(?:https?://|www\.)[^\s<>\"')\]|]+", re.I)
_MD = re.compile(r"\[([^\[\]\n]{1,80})\]\(\s*((?:https?://|www\.)?[^\s()]*)\s*\)")
_A = re.compile(r"<a\s[^<>]*>(.*?)</a>", re.I | re.S)
_BR = re.compile(r"<(?:br|/?p|/?li|/?ul|/?div|/?td|/?tr)\b[^<>]*>", re.I)
_TAGS = re.compile(r"</?[a-zA-Z!][^<>]{0,200}>")
_WORD = re.compile(r"[^\W_]+(?:['’\-_][^\W_]+)*")
_SENTENCE = re.compile(r"(?<=[.!?…])\s+|\n+")
_ITEM = re.compile(r"[;,|•·▪►»>«<\t]+|\s[-–*/]\s|(?:^|\n)\s*[-*•]\s*")
_REFERENCE = re.compile(r"^\s*\[?\d{1,3}[\].)]\s|\b(?:19|20)\d\d;\s*\d+|\b(?:19|20)\d\d\)|\bdoi\b|\.{3,}\s*\d+\s*$", re.I)
_KEYWORDS = re.compile(r"^\s*(?:key\s?-?words?|palabras clave|palavras-chave|mots[- ]cl[ée]s|schlag\w+|stichw\w+|ключевые слова|topics|subjects)\b", re.I)
_OFFER = re.compile(r"[€$£¥]\s?\d|\b(?:SKU|Cat#|Art\.)\s*\d|add to cart|in stock|wishlist|\bsale!", re.I)
_HASH = re.compile(r"(?:^|\s)#[\w\-]+")
_LINK = "\u0001"


def _items(s: str) -> list[list[str]]:
    return [i for i in (_WORD.findall(x) for x in _ITEM.split(s)) if i]


def evidence(text: str | None) -> tuple[int, int, float, float]:
    """(words, words in list form, share of the commonest term of 2-3 words, of one word)."""
    if not text or not text.strip():
        return 0, 0, 0.0, 0.0
    t = _MD.sub(lambda m: f" {m.group(1)} {_LINK} ; ", text)
    t = _A.sub(lambda m: f" {m.group(1)} {_LINK} ; ", t)
    t = _BR.sub("\n", t)
    t = _TAGS.sub(" ", t)
    t = _URL.sub(f" {_LINK} ", t).lower()
    total = listed = 0
    prose: list[str] = []
    telling: list[str] = []  # without function words
    for s in _SENTENCE.split(t):
        links = s.count(_LINK)
        words = _WORD.findall(s)
        n = len(words) + links
        if not n:
            continue
        total += n
        rare = [w for w in words if w not in FUNCTION]
        prose += words
        telling += rare
        share = 1 - len(rare) / len(words) if words else 0.0
        closed = s.rstrip().endswith((".", "!", "?", "…", ":"))
        if share >= 0.25 and "#" not in s:
            continue  # no form of list holds so many function words
        if not links and (_REFERENCE.search(s) or _KEYWORDS.match(s)):
            continue
        is_list = (
            links >= max(1, 0.06 * n) and share < 0.25
            or ("#" in s and len(_HASH.findall(s)) >= 0.4 * n)
            or (share < 0.15 and bool(_OFFER.search(s)))
            or (not closed and share < (0.1 if n < LONG_LINE else 0.22))
        )
        if not is_list and closed and share < 0.12 and len(_ITEM.findall(s)) >= 5:
            items = _items(s)
            is_list = len(items) >= 6 and sum(len(i) for i in items if len(i) <= 4) >= 0.8 * len(words)
        listed += n if is_list else 0
    term = word = 0.0
    if len(prose) >= MIN_WORDS:
        n = len(prose)
        m = max(Counter(telling).values(), default=0)
        word = m / n if m > 3 else 0.0
        # a term of three words makes up MIN_TERM of the text only if one of them makes up a third of that
        if 3 * m >= MIN_TERM * n:
            for size in (2, 3):
                c = Counter(tuple(prose[k : k + size]) for k in range(n - size + 1))
                (top, m) = max(c.items(), key=lambda x: (x[1] * any(w not in FUNCTION for w in x[0]), x[0]))
                if m > 2 and any(w not in FUNCTION for w in top):
                    term = max(term, size * m / n)
    return total, listed, term, word


_MARKUP = re.compile(r"</?[a-zA-Z!][^<>]*>")
#: A word, or what ends a phrase: punctuation, a line, a link's start.
_TOKEN = re.compile(r"https?://(?:www\.)?|\bwww\.|[;,|•·▪►»>«<\t\n()\[\]\"“”#]|[.!?…:]+(?=\s)|\s[-–*/]\s|[^\W_]+(?:['’][^\W_]+)*")


class _Hashes(dict):
    """Hashes of words, 0 for what ends a phrase; made when first asked for."""

    def __missing__(self, token: str) -> int:
        import xxhash

        stop = not token[0].isalnum() or token.startswith(("http://", "https://")) or token == "www."
        h = self[token] = 0 if stop else xxhash.xxh3_64_intdigest(token.encode("utf-8", "surrogatepass")) | 1
        return h


def shingles(text: str | None, known: _Hashes) -> np.ndarray:
    """Hashes, as often as they occur: of words, which are odd, and of phrases, which are even: two neighbouring words, or one that stands alone."""
    if not text:
        return np.zeros(0, np.int64)
    t = _MARKUP.sub(lambda m: f" ; {' ; '.join(_URL.findall(m.group()))} ; ", text) if "<" in text else text
    one = np.array([known[w] for w in _TOKEN.findall(t.lower())], np.uint64)
    word = one != 0
    both = word[:-1] & word[1:]
    two = (one[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ one[1:])[both]
    alone = word.copy()
    alone[:-1] &= ~both
    alone[1:] &= ~both
    return np.concatenate([one[word], np.concatenate([one[alone], two]) & ~np.uint64(1)]).view(np.int64)


def suspicious(total: int, listed: int, term: float, word: float) -> bool:
    """The evidence of form alone."""
    return total >= MIN_WORDS and ((listed >= MIN_WORDS and listed >= MIN_LIST * total) or term >= MIN_TERM or word >= MIN_WORD)


_SCHEMA = "doc_id long, host long, form boolean, words int, listed int, term double, word double, phrases array<long>, times array<int>"
#: Words whose hashes a Python worker keeps.
_WORDS = 500_000


def judge(documents: DataFrame) -> DataFrame:
    """The evidence and the phrases of every page."""
    pages = documents.select("doc_id", "text", F.when(F.col("site").isNull(), F.xxhash64(F.lit("?"), "doc_id")).otherwise(F.xxhash64(F.lower("site"))).alias("host"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _Hashes()
        none = np.zeros(0, np.int32)
        for b in batches:
            out = []
            for i, text, host in zip(b["doc_id"], b["text"], b["host"]):
                e, phrases = evidence(text), shingles(text, known)
                form = suspicious(*e)
                # only pages of the right form are asked how often they have a phrase
                out.append((i, host, form, *e, *(np.unique(phrases, return_counts=True) if form else (np.unique(phrases), none))))
            if len(known) > _WORDS:
                known.clear()
            yield pd.DataFrame(out, columns=["doc_id", "host", "form", "words", "listed", "term", "word", "phrases", "times"])

    return pages.mapInPandas(run, _SCHEMA)


def spam_pages(documents: DataFrame) -> DataFrame:
    """(doc_id) of the pages that are spam."""
    seen = cut(judge(documents))
    exploded = seen.select("host", F.explode("phrases").alias("phrase"))
    wide = exploded.groupBy("phrase").agg(F.min("host").alias("a"), F.max("host").alias("b")).where("a <> b").select("phrase", F.lit(1).alias("known"))
    # nearly every word of any text is on other hosts: single words tell something of a page of one term only
    repeated = (F.col("term") >= MIN_TERM) | (F.col("word") >= MIN_WORD)
    mine = seen.where("form").select("doc_id", repeated.alias("repeated"), F.explode(F.arrays_zip("phrases", "times")).alias("x")).select("doc_id", "repeated", F.col("x.phrases").alias("phrase"), F.col("x.times").alias("n"))
    mine = mine.where("repeated OR phrase & 1 = 0").drop("repeated")
    stitched = mine.join(wide, "phrase", "left").groupBy("doc_id").agg((F.sum(F.col("n") * F.coalesce("known", F.lit(0))) / F.sum("n")).alias("stitched"))
    return stitched.where(F.col("stitched") >= MIN_STITCHED).select("doc_id")
