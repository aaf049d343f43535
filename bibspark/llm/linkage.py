"""Problem 7: matching the records of two sources that share no key, each match with a confidence.

Label-model linkage. Candidates are pairs that share a combination of two title words or of an author with
title words (one rare word, or two frequent ones that are neighbours by alphabet), of authors or the start or end of the
title with journal and year, or the whole title; single words would make hot keys, and pairs of words count only if two of them agree. Heuristic matching
functions vote on each candidate (same, undecided, different, or nothing where a value is missing). A
generative model learns from the votes alone how often each function says what of pairs that are one
publication, of related publications (a correction, a reply, a second part, another place) and of strangers.
The votes of related pairs hang together, which two classes can't tell; the third class carries these
correlations. The posterior probability of the first class is the confidence, and it alone decides.

Work follows classes of identical descriptions, not copies: both sides are first reduced to their
distinct profiles, candidates and votes are made for profiles, and memberships are joined at the end.
The driver sees the counts of vote patterns (at most 4 ** 8) and the words that a share of at least
``FREQUENT`` of the rows contains (their number is bounded by words a title / FREQUENT).

Defined results: a row without usable title takes part through authors, journal and year; rows without
anything to compare match nothing; repeated rows give a match each; empty tables give an empty result;
very long titles are compared whole; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bibspark.llm.canonical import _VOLUME, Journals, bounded_list
from bibspark.llm.garbled import repair
from bibspark.llm.trie import fold
from bibspark.operators.packed import split_field
from bibspark.session import cut

#: A word is frequent in so large a share of the rows, and in no fewer rows than this.
FREQUENT = 2e-3
FREQUENT_ROWS = 20
THRESHOLD = 0.5
FUNCTIONS = ("title_words", "title_text", "first_author", "authors", "year", "journal", "left_over", "numbers")
#: A vote where there is nothing to compare; it is no evidence for any class.
NONE = None

_TAG = re.compile(r"<[^<>]{1,40}>|&[a-z]{2,8};")
#: Numbers, also Roman ones of two letters and more.
_NUMBER = re.compile(r"\d+|\b(?:i[iv]+|vi+|xi+|ix)\b")
_CUT = re.compile(r"\s*(?:\.\.\.|…)\s*$")
_PROFILE = "side string, id string, ph long, title string, cut boolean, numbers string, names array<string>, partial boolean, journal string, year int, words array<string>"


def indel(a: str, b: str) -> float:
    """2 * LCS / (|a| + |b|), by bits."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    mask: dict[str, int] = {}
    for i, c in enumerate(a):
        mask[c] = mask.get(c, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for c in b:
        u = v & mask.get(c, 0)
        v = ((v + u) | (v - u)) & full
    return 2.0 * (len(a) - v.bit_count()) / (len(a) + len(b))


@lru_cache(200_000)
def close(a: str, b: str) -> bool:
    """One word, allowing for the slips of typing."""
    if a == b:
        return True
    n = max(len(a), len(b))
    return n > 3 and abs(len(a) - len(b)) <= 2 and indel(a, b) >= (0.75 if n < 8 else 0.78)


def clean_title(title: str | None) -> tuple[str, bool]:
    """(folded title without markup, whether it is cut off)."""
    if not title or not title.strip():
        return "", False
    t = _TAG.sub("", repair(title)).strip()
    return fold(_CUT.sub("", t).strip("[] .")), bool(_CUT.search(t))


_ET_AL = re.compile(r"[;,]?\s*(?:et al\.?|and others)\s*$", re.I)
_INIT = re.compile(r"(?:[^\W\d_]\.?-?){1,3}$")


def surnames(authors: str | None) -> tuple[list[str], bool]:
    """Last word of each surname in order; whether the list is only a part of the authors."""
    if not authors or not authors.strip():
        return [], False
    text = repair(authors)
    part = bool(_ET_AL.search(text))
    out = []
    for a in split_field(_ET_AL.sub("", text), "au"):
        left = a.split(",")[0] if "," in a else a
        words = left.split()
        if "," not in a and len(words) > 1 and words[-1].isupper() and _INIT.match(words[-1]):
            words = words[:-1]
        w = fold(" ".join(words)).split()
        if w:
            out.append(w[-1])
    return out, part


def profile(title, authors, journal, year, journals: Journals, cache: dict) -> tuple:
    t, short = clean_title(title)
    names, part = surnames(authors)
    j = (journal or "").strip()
    if j:
        if j not in cache:
            if len(cache) > 200_000:
                cache.clear()
            ref = journals.lookup(j)[1]
            cache[j] = f"#{ref}" if ref else journals.vocab.key(_VOLUME.sub("", repair(j)))
        j = cache[j]
    y = int(year) if year is not None and year == year and 1900 <= year <= 2030 else None
    words = [w for w in dict.fromkeys(t.split()) if len(w) > 2]
    return t, short, " ".join(sorted(_NUMBER.findall(t))), names, part, j, y, words


def votes(a: tuple, b: tuple) -> tuple[int | None, ...]:
    """Votes of FUNCTIONS on two (title, cut, numbers, names, partial, journal, year)."""
    ta, ca, na, sa, pa, ja, ya = a
    tb, cb, nb, sb, pb, jb, yb = b
    words = text = over_vote = numbers = first = both = year = journal = NONE
    if ta and tb:
        x, y, wx, wy = ta, tb, ta.split(), tb.split()
        generic = min(len(wx), len(wy)) <= 3
        if ca or cb:  # compare the kept beginning only, of which the last word may be cut itself
            n = min(len(t) for t, c in ((ta, ca), (tb, cb)) if c)
            x, y = ta[:n], tb[:n]
            m = max(1, min(len(x.split()), len(y.split())) - 1)
            tail = wx[m : m + 1] + wy[m : m + 1]
            wx, wy = wx[:m], wy[:m]
        rest, over = list(wy), []
        for w in wx:
            hit = next((k for k, v in enumerate(rest) if close(w, v)), None)
            if hit is None:
                over.append(w)
            else:
                del rest[hit]
        alike = indel(x, y)
        # what is left on both sides must be one text with slips, not another place or species
        left = indel("".join(over), "".join(rest)) if over and rest else float(not over and not rest)
        slip = min(map(len, (over, rest))) > 0 and max(map(len, over + rest)) > 1 and (1 - left) * sum(map(len, over + rest)) <= 2.01
        words = 1 if left == 1.0 or ((left >= 0.7 or slip) and alike >= 0.9) else 0 if left >= 0.5 and alike >= 0.9 else -1
        if (ca or cb) and len(tail) == 2 and indel(tail[0][: len(tail[1])], tail[1][: len(tail[0])]) < 0.5:
            words = -1  # the word within which it is cut is another one
        # equal titles of a word or two say little
        text = (NONE if generic else 1) if alike >= 0.9 else -1 if alike < 0.82 else 0
        if not (ca or cb):
            # words that only one of the titles has, such as those of a reply or a second part
            more = len(wx) != len(wy) and abs(sum(map(len, over)) - sum(map(len, rest))) >= 3 and left < 0.6
            over_vote = -1 if more else 1 if not over and not rest else 0
            if na or nb:
                numbers = 1 if na == nb else -1
    if len(sa) and len(sb):
        first = 1 if close(sa[0], sb[0]) else -1
        small, large = (sa, sb) if len(sa) <= len(sb) else (sb, sa)
        share = sum(any(close(w, v) for v in large) for w in small) / len(small)
        full = len(small) / len(large) >= 0.5 or pa or pb
        both = 1 if share >= 0.6 and full else -1 if share < 0.34 else 0
    if ya is not None and yb is not None:
        year = 1 if abs(ya - yb) <= 1 else -1
    if ja and jb:
        journal = 1 if ja == jb or (ja[0] != "#" and jb[0] != "#" and indel(ja, jb) >= 0.85) else -1
    return words, text, first, both, year, journal, over_vote, numbers


#: Where learning starts: shares of "different" and of "same" that each of FUNCTIONS says of a class.
_START = np.array(
    [
        [(0.01, 0.9), (0.02, 0.9), (0.1, 0.8), (0.02, 0.8), (0.03, 0.85), (0.03, 0.8), (0.01, 0.8), (0.005, 0.7)],  # one publication
        [(0.9, 0.02), (0.3, 0.4), (0.1, 0.8), (0.05, 0.8), (0.3, 0.6), (0.1, 0.8), (0.6, 0.02), (0.5, 0.3)],  # related ones
        [(0.98, 0.01), (0.95, 0.01), (0.9, 0.05), (0.8, 0.05), (0.6, 0.3), (0.8, 0.1), (0.4, 0.02), (0.8, 0.1)],  # strangers
    ]
)
#: The start weighs as much as this share of all candidates.
_STRENGTH = 0.01


def fit_label_model(patterns: np.ndarray, counts: np.ndarray, rounds: int = 500) -> np.ndarray:
    """Posterior of a match for each pattern of votes: -1, 0, 1, or nan where a function has nothing to compare.

    Latent classes (one publication, related, strangers), learned by expectation maximisation from the
    pattern counts; in each class a function has its own probabilities of the three votes.
    """
    n = len(patterns)
    if n == 0:
        return np.zeros(0)
    one = np.stack([patterns == v for v in (-1, 0, 1)], axis=2).astype(float)  # n, functions, 3
    start = np.stack([_START[:, :, 0], 1 - _START.sum(2), _START[:, :, 1]], axis=2)
    theta, prior, strength = start, np.array([0.2, 0.2, 0.6]), _STRENGTH * counts.sum()
    for _ in range(rounds):
        ll = np.einsum("nfv,kfv->nk", one, np.log(theta)) + np.log(prior)
        post = np.exp(ll - ll.max(1, keepdims=True))
        post /= post.sum(1, keepdims=True)
        w = post * counts[:, None]
        prior = (w.sum(0) + 1) / (counts.sum() + 3)
        new = np.einsum("nk,nfv->kfv", w, one) + strength * start + 1e-3
        new /= new.sum(2, keepdims=True)
        done = np.abs(new - theta).max() < 1e-7
        theta = new
        if done:
            break
    return post[:, 0]


#: Candidate keys in SQL over (side, title, cut, names, words, rare, journal, year): a pair needs one of _KEYS or two of _WEAK in common.
_PREPARED = {
    "names": "array_distinct(names)",
    "years": "IF(year IS NULL, CAST(array() AS array<int>), array(year, year + 1))",  # at most a year apart: one in common
    "near": "CASE WHEN year IS NULL THEN CAST(array() AS array<int>) WHEN side = 'b' THEN array(year) ELSE array(year - 1, year, year + 1) END",  # the same, but one in common only
    "journal": "nullif(journal, '')",
    "start": "slice(words, 1, 3)",
    "usual": "IF(size(plain) < 2, array(), transform(sequence(1, size(plain) - 1), i -> concat_ws(' ', plain[i - 1], plain[i])))",
}
_WEAK = (
    # each title word with each other one; two frequent words together are no key: too many titles share them
    "flatten(transform(rare, a -> transform(filter(words, b -> b < a OR (b > a AND NOT array_contains(rare, b))), b -> xxhash64('w', least(a, b), greatest(a, b)))))",
    # each author with each rare title word and each two frequent ones next by alphabet
    "flatten(transform(names, s -> transform(rare, w -> xxhash64('a', w, s))))",
    "flatten(transform(names, s -> transform(usual, w -> xxhash64('f', w, s))))",
    # each author in a year
    "flatten(transform(names, s -> transform(near, y -> xxhash64('z', s, y))))",
    # a cut title with all that begin like it in a year: the side of the cut one is part of the key
    *(f"IF(size(words) > 3 AND (side <> '{x}' OR cut), transform(years, y -> xxhash64('c{x}', start, y)), NULL)" for x in "bd"),
)
_KEYS = (
    # titles of few words have few pairs of them
    "IF(size(words) <= 4, flatten(transform(names, s -> transform(usual, w -> xxhash64('f', w, s)))), NULL)",
    # each author in journal and year, and with each other author in the journal
    "IF(journal IS NULL, NULL, flatten(transform(names, s -> transform(years, y -> xxhash64('y', s, journal, y)))))",
    "IF(journal IS NULL, NULL, flatten(transform(names, s -> transform(filter(names, r -> r > s), r -> xxhash64('s', s, r, journal)))))",
    # the whole title; a short one only with an author or in journal and year
    "IF(size(words) > 3, array(xxhash64('v', title)), NULL)",
    "IF(size(words) <= 3 AND title <> '', transform(names, s -> xxhash64('t', title, s)), NULL)",
    "IF(size(words) <= 3 AND title <> '' AND journal IS NOT NULL, transform(years, y -> xxhash64('u', title, journal, y)), NULL)",
    # start and end of the title in journal and year
    "IF(size(words) > 3 AND journal IS NOT NULL, transform(years, y -> xxhash64('p', start, journal, y)), NULL)",
    "IF(size(words) > 3 AND journal IS NOT NULL AND NOT cut, transform(years, y -> xxhash64('e', slice(words, -3, 3), journal, y)), NULL)",
    # a cut title with all that begin like it in a journal
    *(f"IF(size(words) > 3 AND journal IS NOT NULL AND (side <> '{x}' OR cut), array(xxhash64('j{x}', start, journal)), NULL)" for x in "bd"),
)


def candidate_keys(reps: DataFrame, frequent: list[str]) -> DataFrame:
    """(side, ph, k): the candidate keys of each description, weak ones odd; ``frequent`` are words that make no key together."""
    often = lambda w: w.isin(*frequent) if frequent else F.lit(False)  # noqa: E731 (a hash set, made once)
    rows = reps.select("side", "ph", "title", "cut", "names", "words", "journal", "year")
    rows = rows.withColumns({"rare": F.filter("words", lambda w: ~often(w)), "plain": F.array_sort(F.filter("words", often))})
    rows = rows.withColumns({c: F.expr(e) for c, e in _PREPARED.items()})
    none = F.expr("CAST(array() AS array<bigint>)")
    array = lambda es: F.concat(*[F.coalesce(F.expr(e), none) for e in es])
    both = rows.select("side", "ph", array(_KEYS).alias("strong"), array(_WEAK).alias("weak"))
    each = both.select("side", "ph", F.size("strong").alias("n"), F.posexplode(F.concat("strong", "weak")).alias("pos", "k"))
    return each.select("side", "ph", F.expr("(k & -2L) | IF(pos < n, 0L, 1L)").alias("k"))


def candidates(keyed: DataFrame) -> DataFrame:
    """(pa, pb): descriptions of either side with a key or two weak ones in common."""
    left = keyed.where("side = 'b'").select("k", F.col("ph").alias("pa"))
    right = keyed.where("side = 'd'").select("k", F.col("ph").alias("pb"))
    return left.join(right.hint("merge"), "k").groupBy("pa", "pb").agg(F.sum(F.expr("IF(k & 1 = 1, 1, 2)")).alias("n")).where("n > 1").select("pa", "pb")


def link(records: DataFrame, others: DataFrame, journals: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(idx, publication_id, confidence) for all pairs that describe the same publication."""
    spark = records.sparkSession
    refs = bounded_list(journals, ["ref_id", "journal_title", "iso_abbrev"])
    shared = spark.sparkContext.broadcast(refs)
    a = records.select(F.lit("b").alias("side"), F.col("idx").cast("string").alias("id"), F.col("ti").alias("t"), F.col("au").alias("a"), F.col("so").alias("j"), F.col("py").cast("double").alias("y"))
    b = others.select(F.lit("d").alias("side"), F.col("publication_id").cast("string").alias("id"), F.col("title").alias("t"), F.col("authors").alias("a"), F.col("source_title").alias("j"), F.col("pubyear").cast("double").alias("y"))

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        js, cache = Journals(shared.value), {}
        for p in batches:
            out = []
            for side, i, t, au, j, y in p.itertuples(index=False):
                r = profile(t, au, j, y, js, cache)
                ph = xxhash.xxh3_64_intdigest(repr(r).encode()) - (1 << 63)
                out.append((side, i, ph, *r))
            yield pd.DataFrame(out, columns=["side", "id", "ph", "title", "cut", "numbers", "names", "partial", "journal", "year", "words"]).astype({"year": "Int32"})

    rows = cut(a.unionByName(b).mapInPandas(parse, _PROFILE))
    least = max(FREQUENT_ROWS, rows.count() * FREQUENT)
    frequent = {r.w: r.n for r in rows.select(F.explode("words").alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).collect()}

    members = rows.select("side", "ph", "id")
    # one row for each distinct description of a side; a hash is no more than 16 bytes of shuffle
    reps = cut(rows.drop("id").dropDuplicates(["side", "ph"]))

    pairs = candidates(candidate_keys(reps, sorted(frequent)))
    cols = ["title", "cut", "numbers", "names", "partial", "journal", "year"]
    side = lambda s, x: reps.where(f"side = '{s}'").select(F.col("ph").alias(f"p{x}"), *[F.col(c).alias(f"{x}_{c}") for c in cols])
    full = pairs.join(side("b", "a").hint("merge"), "pa").join(side("d", "b").hint("merge"), "pb")

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            year = lambda c: [None if y != y else int(y) for y in p[c].astype("float64")]
            side = lambda x: zip(*[year(f"{x}_year") if c == "year" else p[f"{x}_{c}"].tolist() for c in cols])
            marks = ["".join("." if k is None else "-0+"[k + 1] for k in votes(a, b)) for a, b in zip(side("a"), side("b"))]
            yield pd.DataFrame({"pa": p["pa"], "pb": p["pb"], "pattern": pd.Series(marks, dtype=object)})

    voted = cut(full.mapInPandas(judge, "pa long, pb long, pattern string"))
    counted = voted.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).orderBy("pattern").collect()
    value = {"-": -1.0, "0": 0.0, "+": 1.0, ".": np.nan}
    pats = np.array([[value[c] for c in r.pattern] for r in counted]).reshape(len(counted), len(FUNCTIONS))
    post = fit_label_model(pats, np.array([float(r.n) for r in counted]))
    table = spark.createDataFrame([(r.pattern, float(p)) for r, p in zip(counted, post)], "pattern string, confidence double")
    good = voted.join(F.broadcast(table), "pattern").where(F.col("confidence") >= threshold).select("pa", "pb", "confidence")
    return (
        good.join(members.where("side = 'b'").select(F.col("ph").alias("pa"), F.col("id").cast("long").alias("idx")).hint("merge"), "pa")
        .join(members.where("side = 'd'").select(F.col("ph").alias("pb"), F.col("id").alias("publication_id")).hint("merge"), "pb")
        .select("idx", "publication_id", "confidence")
    )
