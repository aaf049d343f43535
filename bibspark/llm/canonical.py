"""Problem 6: values typed freely, mapped to the entries of a reference list.

Every reference entry goes into a trie under its name and its alias paths (abbreviated title, words
in the other order, acronym); a Levenshtein automaton walks the trie and returns all entries within a
distance that depends on the length of the value. Before that both sides are brought to one form:
case, accents, punctuation, small words, volume numbers, and abbreviated words, which are expanded by
the pairs that the reference list itself shows or where they begin exactly one word of it.

A list of at most ``MAX_REFERENCE`` entries is broadcast, and values are looked up where they stand, so
there is no shuffle; a bounded cache for each Python worker spares repeated values. A longer list is
searched in shards of that size, one after the other, by the distinct values; all shards use the
vocabulary of the whole list, and the best of their answers wins, so the result is the same.

Defined results: a blank value gives no row for ``so``; a value without any entry close enough gives
0; among equally close entries the one in the city the address names, then the smallest id wins;
empty reference lists map everything to 0; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bibspark.llm.garbled import repair
from bibspark.llm.trie import Trie, allowed, fold
from bibspark.operators.packed import split_field
from bibspark.session import cut

MAX_REFERENCE = 100_000
CACHE = 200_000

#: Small words that titles and names are written with or without.
SMALL = frozenset("of the de la le et and und e y for f fur in a an des du del do da dos".split())
#: Words of organisation names and their translations and irregular abbreviations.
WORDS = {
    "natl": "national", "nat": "national", "ctr": "centre", "center": "centre", "cent": "centre", "univ": "university", "universitat": "university", "universite": "university",
    "universidad": "university", "universidade": "university", "universita": "university", "universiteit": "university", "uniwersytet": "university", "tech": "technical",
    "coll": "college", "gen": "general", "hosp": "hospital", "med": "medical", "acad": "academy", "inst": "institute", "res": "research", "lab": "laboratory", "stn": "station",
    "agcy": "agency", "fdn": "foundation", "fac": "faculty", "dept": "department", "sch": "school", "jour": "journal", "jnl": "journal", "stud": "studies", "pract": "practice", "int": "international", "proc": "proceedings",
}
_VOLUME = re.compile(r"\s*,?\s*(?:vol(?:ume)?\.?\s*)?\d+\s*(?:\(\d+\))?\s*$", re.I)
_AUTHORS = re.compile(r"^\s*\[[^\]]*\]\s*")


class Vocabulary:
    """Expands abbreviated words by what the reference list shows."""

    def __init__(self, names: list[str], pairs: list[tuple[str, str]] = ()) -> None:
        self.words = {w for n in names for w in fold(n).split() if w not in SMALL}
        self.map: dict[str, str] = dict(WORDS)
        for full, short in pairs:
            a = [w for w in fold(full).split() if w not in SMALL]
            b = [w for w in fold(short).split() if w not in SMALL]
            if len(a) == len(b):
                for x, y in zip(a, b):
                    if x != y and x[0] == y[0]:
                        self.map.setdefault(y, x)
        by: dict[str, set[str]] = {}
        for w in self.words:
            for k in range(3, len(w)):
                by.setdefault(w[:k], set()).add(w)
        self.prefix = {p: next(iter(ws)) for p, ws in by.items() if len(ws) == 1}

    def key(self, text: str) -> str:
        out = []
        for w in fold(text).split():
            if w in SMALL:
                continue
            out.append(w if w in self.words else self.map.get(w) or self.prefix.get(w, w))
        return " ".join(out)


class Journals:
    def __init__(self, rows: list[tuple[int, str, str]], vocab: Vocabulary | None = None) -> None:
        self.vocab = vocab or self.vocabulary(rows)
        self.trie, self.raw = Trie(), Trie()
        for ref, title, abbrev in rows:
            for name in (title, abbrev):
                if name:
                    self.trie.add(self.vocab.key(name), ref)
                    self.raw.add(fold(name), ref)
        self.word_trie = Trie()
        for w in sorted(self.vocab.words | set(self.vocab.map)):
            self.word_trie.add(w, 0)
        self._known = lru_cache(CACHE)(lambda w: bool(self.word_trie.closest(w, min(2, allowed(len(w))))[1]))

    @staticmethod
    def vocabulary(rows: list[tuple[int, str, str]]) -> Vocabulary:
        return Vocabulary([r[1] for r in rows if r[1]], [(r[1], r[2]) for r in rows if r[1] and r[2]])

    def lookup(self, so: str) -> tuple[int, int]:
        """(distance, ref_id), ref_id 0 if no journal is close enough."""
        text = _VOLUME.sub("", repair(so))
        key = self.vocab.key(text)
        if not key:
            return 99, 0
        exact = self.trie.closest(key, 0)[1] or self.raw.closest(fold(text), 0)[1]
        if exact:
            return 0, min(exact)
        if not any(self._known(w) for w in key.split()):
            return 99, 0  # no word of it is near any word of the list
        dist, hits = self.trie.closest(key, allowed(len(key)))
        if not hits:  # a small or abbreviated word may be misspelt itself
            raw = fold(text)
            dist, hits = self.raw.closest(raw, allowed(len(raw)))
        return (dist, min(e for e, d in hits.items() if d == dist)) if hits else (99, 0)


class Institutions:
    """One small trie for each city; the city is found in the address or, misspelt, in the name."""

    CITY_EDITS = 2

    def __init__(self, rows: list[tuple[int, str, str, str]], pairs: list[tuple[str, str]] = (), vocab: Vocabulary | None = None) -> None:
        self.vocab = vocab or self.vocabulary(rows, pairs)
        self.acronym = {r[2]: r[0] for r in rows if r[2]}
        short = {v: k for k, v in reversed(self.vocab.map.items())}
        # endings the lists cut off ("thermograp|hics") are cut off other words too
        ends: Counter[str] = Counter()
        for x, y in pairs:
            a, b = ([w for w in fold(t).split() if w not in SMALL] for t in (x, y))
            if len(a) == len(b):
                ends.update(u[len(v) :] for u, v in zip(a, b) if u != v and u.startswith(v))
        cut = sorted((e for e, n in ends.items() if n > 2 and len(e) > 2), key=len)

        def brief(w: str) -> str:
            return short.get(w) or next((w[: -len(e)] for e in cut if w.endswith(e) and len(w) - len(e) > 4), w)

        self.tries: dict[str, Trie] = {}
        self.one_word = Trie()
        self.city_trie = Trie()
        self.city_no: list[str] = []
        for ref, name, _, city in rows:
            if not name:
                continue
            c = fold(city or "")
            if c not in fold(name):
                c = ""
            if c not in self.tries:
                self.tries[c] = Trie()
                if c:
                    self.city_trie.add(c, len(self.city_no))
                    self.city_no.append(c)
            key, raw = self.vocab.key(name), fold(name)
            words = key.split()
            if len(words) == 1:
                self.one_word.add(key, ref)
                self.one_word.add(raw, ref)
            spellings = {key, raw, " ".join(map(brief, words)), " ".join(map(brief, raw.split()))}
            if len(words) == 2 and words[0] == "university":
                spellings |= {f"{words[1]} university", f"{words[1]} univ"}
            for x in spellings:
                self.tries[c].add(x, ref)
        #: Cities that the words of a name can't lead to; these institutions are tried for every address.
        self.unseen = {c for c in self.tries if c and (len(c) < 6 or " " in c)}
        self._near = lru_cache(CACHE)(self._near_cities)

    @staticmethod
    def vocabulary(rows: list[tuple[int, str, str, str]], pairs: list[tuple[str, str]] = ()) -> Vocabulary:
        return Vocabulary([r[1] for r in rows if r[1]] + [r[3] for r in rows if r[3]], pairs)

    def _near_cities(self, token: str) -> tuple[str, ...]:
        if len(token) < 6:
            return ()
        _, hits = self.city_trie.closest(token, min(self.CITY_EDITS, allowed(len(token))))
        return tuple(self.city_no[e] for e in hits)

    @staticmethod
    def parts(address: str) -> list[str]:
        bare = _AUTHORS.sub("", repair(address)).strip().rstrip(".")
        return [p.strip() for p in bare.split(",") if p.strip()]

    def lookup(self, address: str) -> tuple[int, int]:
        """(distance, ref_id), ref_id 0 if no organisation is close enough."""
        best = self.best(address)
        return best[0], best[2]

    def best(self, address: str) -> tuple[int, int, int]:
        """(distance, 0 if it is in the city that the address names, ref_id)."""
        parts = self.parts(address)
        for p in parts:
            if p in self.acronym:
                return -1, 0, self.acronym[p]
        folded = [fold(p) for p in parts]
        named = {c for p in folded[1:] for c in (re.sub(r"\d+", "", p).strip(),) if c in self.tries}
        best = (99, 2, 0)
        for p, raw in zip(parts, folded):
            words = raw.split()
            if not words or words[0].isdigit():
                continue
            key = self.vocab.key(p)
            if len(words) == 1:
                if self.one_word.exact:
                    for e, d in self.one_word.closest(key, allowed(len(key)))[1].items():
                        best = min(best, (d, 1, e))
                continue
            near = {c for w in words for c in self._near(w)} | named
            for c in sorted(near | self.unseen | ({""} if "" in self.tries else set())):
                for text in (key, raw) if key != raw else (key,):
                    # no more edits than the city itself may have: Bonn isn't Bern
                    most = allowed(len(text)) if c in near or not c else min(allowed(len(text)), allowed(len(c)))
                    dist, hits = self.tries[c].closest(text, most)
                    if named and c not in named and dist > 1:
                        continue  # the address names another known city
                    for e, d in hits.items():
                        best = min(best, (d, 0 if c in named else 1, e))
                    if best[:2] == (0, 0) or (best[0] == 0 and not named):
                        return best
        return best


def bounded_list(df: DataFrame, cols: list[str], most: int = MAX_REFERENCE) -> list[tuple]:
    """A reference list that is to be broadcast; one of more entries is refused."""
    rows = [tuple(r) for r in df.select(*cols).orderBy(cols[0]).limit(most + 1).toLocalIterator()]
    if len(rows) > most:
        raise ValueError(f"a reference list of more than {most} entries: map the values with map_values first")
    return rows


def _list(df: DataFrame, cols: list[str]) -> list[tuple]:
    return [tuple(r) for r in df.select(*cols).orderBy(cols[0]).toLocalIterator()]


def _searcher(kind: str, rows: list[tuple], vocab: Vocabulary, pairs: list[tuple[str, str]]):
    """A function from a value to (distance, rank, ref_id)."""
    if kind == "so":
        j = Journals(rows, vocab)
        return lambda v: (lambda x: (x[0], 0, x[1]))(j.lookup(v))
    i = Institutions(rows, pairs, vocab)
    return lambda v: i.best(_AUTHORS.sub("", v))


def map_values(records: DataFrame, journals: DataFrame, institutions: DataFrame, most: int = MAX_REFERENCE) -> DataFrame:
    """(idx, fld, pos, ref_id) for each address in c1 and each non-blank so."""
    spark = records.sparkSession
    lists = {"so": _list(journals, ["ref_id", "journal_title", "iso_abbrev"]), "c1": _list(institutions, ["ref_id", "org_name", "acronym", "city"])}
    pairs = [(r[1], r[2]) for r in lists["so"] if r[1] and r[2]]
    vocabs = {"so": Journals.vocabulary(lists["so"]), "c1": Institutions.vocabulary(lists["c1"], pairs)}

    def values(idx, so, c1) -> Iterator[tuple]:
        if so and so.strip():
            yield idx, "so", 1, so.strip()
        if c1:
            for k, v in enumerate(split_field(c1, "c1"), 1):
                yield idx, "c1", k, v

    rows = records.select("idx", "so", "c1")
    if max(map(len, lists.values())) <= most:
        shared = spark.sparkContext.broadcast((lists, vocabs, pairs))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            lists, vocabs, pairs = shared.value
            look = {k: lru_cache(CACHE)(_searcher(k, lists[k], vocabs[k], pairs)) for k in lists}
            for b in batches:
                out = [(i, f, k, look[f](v)[2]) for r in zip(b["idx"], b["so"], b["c1"]) for i, f, k, v in values(*r)]
                yield pd.DataFrame(out, columns=["idx", "fld", "pos", "ref_id"]).astype({"pos": "int32", "ref_id": "int32"})

        return rows.mapInPandas(run, "idx long, fld string, pos int, ref_id int")

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([x for r in zip(b["idx"], b["so"], b["c1"]) for x in values(*r)], columns=["idx", "fld", "pos", "v"]).astype({"pos": "int32"})

    each = cut(rows.mapInPandas(split, "idx long, fld string, pos int, v string"))
    distinct = cut(each.select("fld", "v").distinct())
    answers = None
    for kind, entries in lists.items():
        for k in range(0, max(1, len(entries)), most):
            shared = spark.sparkContext.broadcast((kind, entries[k : k + most], vocabs[kind], pairs))

            def search(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
                find = _searcher(*shared.value)
                for b in batches:
                    yield pd.DataFrame([(f, v, *find(v)) for f, v in zip(b["fld"], b["v"])], columns=["fld", "v", "d", "rank", "ref_id"])

            found = distinct.where(F.col("fld") == kind).mapInPandas(search, "fld string, v string, d int, rank int, ref_id int").where("ref_id <> 0")
            answers = found if answers is None else answers.unionByName(found)
    best = answers.groupBy("fld", "v").agg(F.min(F.struct("d", "rank", "ref_id")).alias("b"))
    return each.join(best, ["fld", "v"], "left").select("idx", "fld", "pos", F.coalesce("b.ref_id", F.lit(0)).alias("ref_id"))
