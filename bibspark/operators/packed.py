"""Problem 1: several values packed in one field, one row per value with its position.

Dictionary-guided segmentation. A first pass over the whole table collects, inside Spark, values that are
known to be whole although they contain a delimiter: keywords ("models, biological"), inverted names and
addresses between unmistakable delimiters, and quoted or listed values with any delimiter inside; and the
given names that follow the comma of an inverted name. A multi-pattern automaton finds the known values in
a field; dynamic programming over the delimiter positions then picks the cheapest cover of the field by
segments: a stretch between neighbouring delimiters, or a known value that spans several of them. Quotes,
list brackets, entities and bracketed author lists protect what they enclose.

Every value seen in two places is in the dictionary. Up to ``BROADCAST`` characters it is broadcast as
automatons; a longer one is joined, distributed, with the stretches of delimited text that could be values
(the same stretches an automaton would find), and each text gets an automaton of what it contains.

Defined results: a null, blank or delimiter-only field yields no row; a field with one value yields
that value at position 1; repeated values stay; texts of any length are handled in one pass; columns
other than the id and the named fields are ignored, whatever their names; an empty table gives an
empty result.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bibspark.session import cut

FIELDS = ("au", "de", "id", "c1")
#: A value must be seen whole so often to be known.
MIN_ROWS = 2
#: Characters of a dictionary that is broadcast; an automaton takes some 50 bytes for each.
BROADCAST = 1_500_000
#: Fields with a common dictionary.
KINDS = {"au": "au", "de": "kw", "id": "kw", "c1": "c1"}
Known = dict  # kind -> automaton of its known values

#: Delimiter classes from the unmistakable to the doubtful; a field is split at the strongest it has.
_STRONG = {"de": ";；|·\t\n\r", "id": ";；|·\t\n\r", "au": ";；|·\t\n\r", "c1": ";；|\t\n\r"}
_ENTITY = r"&(?:[a-zA-Z]{2,8}|#\d{1,6}|#x[0-9a-fA-F]{1,5});"
_LIST = re.compile(r"^\s*\[\s*['\"].*['\"]\s*,?\s*\]\s*$", re.S)
_LIST_ITEM = re.compile(r"'((?:[^'\\]|\\.|'(?!\s*(?:,\s*['\"]|,?\s*\]\s*$)))*)'|\"((?:[^\"\\]|\\.)*)\"", re.S)
_QUOTED = r"\"(?:[^\"]|\"\")*\""
#: A quoted value is one that a delimiter or the end of the field follows.
_AFTER_QUOTE = {f: re.compile(r"\s*(?:[%s,]|/\s|and\s|$)" % re.escape(s)) for f, s in _STRONG.items()}
_OPEN_QUOTE = re.compile(_QUOTED, re.S)


def _tokens(text: str, fld: str) -> list[tuple[int, int, str]]:
    """Delimiters outside protected stretches: (start, end, class), class in s(trong), m(edium), w(eak), a(nd)."""
    out = []
    strong = _STRONG[fld]
    i, n, at_start = 0, len(text), True
    while i < n:
        c = text[i]
        if c == '"' and at_start:
            m = _OPEN_QUOTE.match(text, i)
            if m and _AFTER_QUOTE[fld].match(text, m.end()):
                i, at_start = m.end(), False
                continue
        elif c == "[" and fld == "c1" and at_start:
            end = text.find("]", i)
            if end > 0:
                i, at_start = end + 1, False
                continue
        elif c == "&":
            m = _ENTITY_RE.match(text, i)
            if m:
                i, at_start = m.end(), False
                continue
        if c in strong:
            out.append((i, i + 1, "s"))
            at_start = True
        elif c == ",":
            out.append((i, i + 1, "w"))
            at_start = True
        elif c == "/" and 0 < i < n - 1 and text[i - 1] == " " and text[i + 1] == " ":
            out.append((i, i + 1, "m"))
            at_start = True
        elif c == "a" and fld == "au" and text.startswith("and ", i) and i and text[i - 1] in " \n,":
            out.append((i, i + 3, "a"))
            i += 3
            at_start = True
            continue
        elif not c.isspace():
            at_start = False
        i += 1
    return out


_ENTITY_RE = re.compile(_ENTITY)
#: Where none of these occurs, a field needs no look at single characters.
_PLAIN = {f: re.compile(r'["\[&]') for f in _STRONG}
_SPLIT_STRONG = {f: re.compile("[" + re.escape(s) + "]") for f, s in _STRONG.items()}


def _clean(piece: str) -> str:
    p = piece.strip()
    if len(p) > 1 and p[0] == '"' and p[-1] == '"' and _OPEN_QUOTE.fullmatch(p):
        p = p[1:-1].replace('""', '"').strip()
    return p


# --- names -----------------------------------------------------------------------------------------

_INITIALS = re.compile(r"(?:[^\W\d_a-zß-ÿ]\.?[- ]?){1,4}$")
_INITIAL_TOKEN = re.compile(r"(?:[^\W\d_]\.-?)+$|[^\W\d_]$")
_CAPS = re.compile(r"[^\W\d_]{1,3}$")


def _name_kind(atom: str, given: frozenset[str]) -> str:
    """S surname alone, I initials, G given name(s), N whole name in one stretch, U one unknown word."""
    words = atom.split()
    if "," in atom:  # quoted as a whole
        return "N"
    if _INITIALS.match(atom):
        return "I"
    last, first = words[-1], words[0]
    if len(words) == 1:
        return "G" if first.lower() in given else "U"
    if _INITIAL_TOKEN.match(last):
        return "G" if first.lower() in given or (len(words) == 2 and last.endswith(".")) else "N"
    if _CAPS.match(last) and last.isupper():
        return "N"
    if all(w.lower() in given or _INITIAL_TOKEN.match(w) for w in words):
        return "G"
    if first.lower() in given or any(_INITIAL_TOKEN.match(w) for w in words):
        return "N"
    return "M"


#: Cost of reading a stretch as one value; pairs are joined by a comma.
_SINGLE = {"N": 0.0, "M": 1.2, "S": 2.0, "U": 2.0, "G": 3.0, "I": 4.0}
_PAIR = {("U", "I"): 0.0, ("M", "I"): 0.0, ("U", "G"): 0.0, ("M", "G"): 0.0, ("G", "G"): 1.0, ("G", "I"): 0.5, ("U", "U"): 1.0, ("M", "U"): 0.6, ("G", "U"): 1.5, ("N", "G"): 2.5, ("N", "I"): 1.5, ("N", "U"): 2.1}


def _cover_names(text: str, toks: list[tuple[int, int, str]], given: frozenset[str], automaton=None) -> list[str]:
    """Dynamic programming over commas and 'and': which commas invert a name, which part two names; a known name costs least."""
    bounds = [(0, 0, "s"), *toks, (len(text), len(text), "s")]
    atoms, glue = [], []  # glue[i]: a plain comma between atom i-1 and atom i
    pend = "s"
    for (_, s, _), (e, _, cls) in zip(bounds, bounds[1:]):
        piece = text[s:e].strip()
        if piece:
            atoms.append((s, e, piece))
            glue.append(pend == "w")
            pend = cls
        else:
            pend = cls if pend == "w" else pend
    kinds = [_name_kind(_clean(a[2]), given) for a in atoms]
    quoted = [a[2][0] == '"' for a in atoms]
    n = len(atoms)
    spans = _spans(text, [(s, e) for s, e, _ in atoms], automaton)
    best: list[tuple[float, int]] = [(0.0, 0)] + [(1e9, 0)] * n
    for j in range(1, n + 1):
        best[j] = (best[j - 1][0] + _SINGLE[kinds[j - 1]], j - 1)
        for i in spans.get(j, ()):
            if j - i == 2 and glue[j - 1] and best[i][0] < best[j][0]:
                best[j] = (best[i][0], i)
        if j > 1 and glue[j - 1] and not (quoted[j - 1] or quoted[j - 2]):
            c = best[j - 2][0] + _PAIR.get((kinds[j - 2], kinds[j - 1]), 4.0)
            if c < best[j][0]:
                best[j] = (c, j - 2)
    cuts, j = [], n
    while j:
        cuts.append((best[j][1], j))
        j = best[j][1]
    return [text[atoms[a][0] : atoms[b - 1][1]] for a, b in reversed(cuts)]


def _lower(text: str) -> str:
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def _spans(text: str, pieces: list[tuple[int, int]], automaton) -> dict[int, list[int]]:
    """Known values over several pieces: {piece after the last one: [first pieces]}."""
    spans: dict[int, list[int]] = {}
    if automaton is None or len(pieces) < 2:
        return spans
    start, end = {}, {}
    for k, (s, e) in enumerate(pieces):
        piece = text[s:e]
        start[s + len(piece) - len(piece.lstrip())] = k
        end[s + len(piece.rstrip())] = k + 1
        if (m := _BRACKETED.match(piece)) and m.end() < len(piece):
            start[s + m.end()] = k
    for last, size in automaton.iter(_lower(text)):
        a, b = last + 1 - size, last + 1
        if a in start and b in end and end[b] - start[a] > 1:
            spans.setdefault(end[b], []).append(start[a])
    return spans


#: The authors before an address; a known address is known without them.
_BRACKETED = re.compile(r"\s*\[[^\]]*\]\s*")


def _pieces(text: str, cuts: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    bounds = [(0, 0), *[(a, b) for a, b, _ in cuts], (len(text), len(text))]
    return [(s, e) for (_, s), (e, _) in zip(bounds, bounds[1:])]


def _cover_known(text: str, cuts: list[tuple[int, int, str]], automaton, atom: float = 1.0) -> list[str]:
    """Cheapest cover by atoms between delimiters (``atom`` each) or known values spanning several (0.5)."""
    pieces = _pieces(text, cuts)
    spans = _spans(text, pieces, automaton)
    if not spans:
        return [text[s:e] for s, e in pieces] if atom < ONLY_KNOWN else [text]
    n = len(pieces)
    best: list[tuple[float, int]] = [(0.0, 0)] + [(ONLY_KNOWN, 0)] * n
    for j in range(1, n + 1):
        best[j] = (best[j - 1][0] + atom, j - 1)
        for i in spans.get(j, ()):
            if best[i][0] + 0.5 < best[j][0]:
                best[j] = (best[i][0] + 0.5, i)
    if best[n][0] >= ONLY_KNOWN:
        return [text]
    out, j = [], n
    while j:
        i = best[j][1]
        out.append(text[pieces[i][0] : pieces[j - 1][1]])
        j = i
    return out[::-1]


#: A cost that no cover by known values reaches; with it for an atom, a text is covered by known values or stays whole.
ONLY_KNOWN = 1e9


def split_field(text: str | None, fld: str, known: Known | None = None, given: frozenset[str] = frozenset()) -> list[str]:
    """The values of one field in order."""
    if text is None or not text.strip():
        return []
    if fld in ("de", "id") and _LIST.match(text):
        return [v for m in _LIST_ITEM.finditer(text.strip()[1:-1]) if (v := re.sub(r"\\(.)", r"\1", (m.group(1) if m.group(1) is not None else m.group(2))).strip())]
    automaton = known.get(KINDS[fld]) if known else None
    strong = _SPLIT_STRONG[fld].search(text)
    if strong and not _PLAIN[fld].search(text):
        toks = [(m.start(), m.end(), "s") for m in _SPLIT_STRONG[fld].finditer(text)]
    else:
        toks = _tokens(text, fld)
    classes = {t[2] for t in toks}
    if "s" in classes:
        pieces = _cover_known(text, [t for t in toks if t[2] == "s"], automaton)
    elif fld == "c1":
        weak = [t for t in toks if t[2] == "w"]
        quoted = [t for t in weak if text[: t[0]].rstrip().endswith('"') and text[t[1] :].lstrip().startswith('"')] if '"' in text else []
        # commas part the lines of an address: they part addresses only where all of them are known
        pieces = _cover_known(text, quoted, None) if quoted else _cover_known(text, weak, automaton, ONLY_KNOWN)
    elif fld == "au":
        pieces = _cover_names(text, [t for t in toks if t[2] in "wa"], given, automaton) if toks else [text]
    elif "m" in classes:
        pieces = _cover_known(text, [t for t in toks if t[2] == "m"], automaton)
    else:
        pieces = _cover_known(text, toks, automaton)
    return [v for p in pieces if (v := _clean(p))]


# --- Spark -----------------------------------------------------------------------------------------


#: A quoted or listed value: what stands around it is a delimiter or the end of the field or list.
_WHOLE = r"""(?:^|[;；|,\[])\s*(?:"((?:[^"]|"")+)"|'([^']+)')(?=\s*(?:[;；|,\]]|$))"""


def mine_dictionary(df: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """(kind, v): known whole values with a delimiter inside, in lower case; kind ``given`` has the given names."""
    sides = []
    for f in fields:
        kind, bare = KINDS[f], F.regexp_replace(F.col(f), _ENTITY, "")
        if f == "c1":  # the authors' own delimiters are none
            bare = F.regexp_replace(bare, "\\[[^\\]]*\\]", "")
        pieces = F.split(bare, "[;；|\\n\\t" + ("" if f == "c1" else "·") + "]")
        # between strong delimiters, where no quote is cut apart
        parts = F.filter(pieces, lambda p: F.pmod(F.length(p) - F.length(F.replace(p, F.lit('"'), F.lit(""))), F.lit(2)) == 0)
        apart = F.when(F.size(pieces) > 1, parts)
        strong = df.select(F.lit(kind).alias("kind"), F.explode(apart).alias("raw"))
        quoted = df.where(F.col(f).rlike("[\"']")).select(F.lit(kind).alias("kind"), F.explode(F.flatten(F.array(*[F.regexp_extract_all(F.col(f), F.lit(_WHOLE), F.lit(g)) for g in (1, 2)]))).alias("raw")).where("raw like '%;%'")
        both = strong.unionByName(quoted) if f != "au" else strong
        sides.append(both.select("kind", F.lower(F.trim(F.regexp_replace("raw", '^\\s*"|"\\s*$', ""))).alias("v")).where("(v like '%, %' or v like '% / %' or v like '%;%') and not v like '%\"%'"))
        if f == "au":
            # inverted names: the first word after the only comma, unless it is initials
            word = F.lower(F.regexp_extract(F.trim("raw"), "^[^,]+, *(\\p{Lu}\\p{Ll}+)(?: |$)[^,]*$", 1))
            sides.append(strong.select(F.lit("given").alias("kind"), word.alias("v")).where("length(v) > 1"))
    every = functools.reduce(DataFrame.unionByName, sides)
    return every.groupBy("kind", "v").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_ROWS).select("kind", "v")


@functools.lru_cache(maxsize=8)
def _automaton(values: tuple[str, ...]):
    import ahocorasick

    if not values:
        return None
    a = ahocorasick.Automaton()
    for v in values:
        a.add_word(v, len(v))
    a.make_automaton()
    return a


def _lookups(rows: Iterable[tuple[str, str]]) -> tuple[Known, frozenset[str]]:
    """Automatons and given names of (kind, value) rows."""
    by: dict[str, list[str]] = {}
    for kind, v in rows:
        by.setdefault(kind, []).append(v)
    given = frozenset(by.pop("given", ()))
    return {k: _automaton(tuple(sorted(v))) for k, v in by.items()}, given


def stretches(text: str | None, fld: str) -> set[tuple[str, str]]:
    """(kind, value) for all that a dictionary could know in a field: stretches over several delimiters, and words of names."""
    if text is None or not text.strip() or (fld in ("de", "id") and _LIST.match(text)):
        return set()
    toks, low = _tokens(text, fld), _lower(text)
    top = next((c for c in "sm" if any(t[2] == c for t in toks)), "w")
    if fld in ("au", "c1"):
        top = "s" if top == "s" else "wa"
    pieces = _pieces(text, [t for t in toks if t[2] in top])
    out = set()
    for i, (s, _) in enumerate(pieces):
        for head in {s, s + (m.end() if (m := _BRACKETED.match(text[s:])) else 0)}:
            # known names have one comma
            out |= {(KINDS[fld], low[head:e].strip()) for _, e in (pieces[i + 1 : i + 2] if fld == "au" and top != "s" else pieces[i + 1 :])}
    if fld == "au":
        out |= {("given", w) for w in re.findall(r"[^\W\d_]+", low) if len(w) > 1}
    return out


def _by_join(df: DataFrame, fields: tuple[str, ...], dictionary: DataFrame) -> DataFrame:
    """The rows with a column ``_known``: for each field what the dictionary knows of its text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [(h, f, kind, v) for h, f, t in zip(b["h"], b["fld"], b["t"]) for kind, v in stretches(t, f)]
            yield pd.DataFrame(out, columns=["h", "fld", "kind", "v"])

    texts = functools.reduce(DataFrame.unionByName, [df.select(F.xxhash64(F.lit(f), F.col(f"_{k}")).alias("h"), F.lit(f).alias("fld"), F.col(f"_{k}").alias("t")).where("t IS NOT NULL") for k, f in enumerate(fields)])
    found = texts.dropDuplicates(["h", "t"]).mapInPandas(run, "h long, fld string, kind string, v string").join(dictionary, ["kind", "v"])
    known = found.groupBy("h").agg(F.collect_set(F.struct("kind", "v")).alias("known"))  # no more than one text holds
    for k, f in enumerate(fields):
        df = df.withColumn("h", F.xxhash64(F.lit(f), F.col(f"_{k}"))).join(known.withColumnRenamed("known", f"_k{k}"), "h", "left").drop("h")
    return df


def explode_packed(df: DataFrame, id_col: str = "idx", fields: tuple[str, ...] = FIELDS, dictionary: DataFrame | None = None, bound: int = BROADCAST) -> DataFrame:
    """(id, fld, pos, val): one row for each value of each field."""
    words = cut(dictionary if dictionary is not None else mine_dictionary(df, fields))
    small = (words.agg(F.sum(F.length("v"))).first()[0] or 0) <= bound
    rows = sorted(tuple(r) for r in words.select("kind", "v").collect()) if small else []
    shared = df.sparkSession.sparkContext.broadcast(rows)
    id_type = df.schema[id_col].dataType.simpleString()
    cols = df.select(F.col(id_col).alias("_id"), *[F.col(f).cast("string").alias(f"_{k}") for k, f in enumerate(fields)])
    if not small:
        cols = _by_join(cols, fields, words)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, names = _lookups(shared.value)
        for b in batches:
            ids, flds, poss, out = [], [], [], []
            for k, f in enumerate(fields):
                for i, text, own in zip(b["_id"], b[f"_{k}"], b[f"_{k}"] if small else b[f"_k{k}"]):
                    if text:
                        if not small:
                            known, names = _lookups((x["kind"], x["v"]) for x in (own if own is not None else ()))
                        got = split_field(text, f, known, names)
                        out += got
                        n = len(got)
                        ids += [i] * n
                        flds += [f] * n
                        poss += range(1, n + 1)
            if ids:
                yield pd.DataFrame({"_id": ids, "fld": flds, "pos": pd.Series(poss, dtype="int32"), "val": out})

    return cols.mapInPandas(run, f"_id {id_type}, fld string, pos int, val string").withColumnRenamed("_id", id_col)


def p1_found(df: DataFrame) -> DataFrame:
    return explode_packed(df).select("idx", "fld", "pos", "val")
