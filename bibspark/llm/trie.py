"""A trie of reference spellings searched with a Levenshtein automaton."""

from __future__ import annotations

import re
import unicodedata

#: Letters that have no decomposition into a base letter and a mark.
_PLAIN = str.maketrans({"ø": "o", "ł": "l", "ß": "ss", "æ": "ae", "œ": "oe", "đ": "d", "ı": "i", "þ": "th", "ð": "d", "’": "'"})
#: One character that was lost counts as one unknown letter.
_LOST = re.compile("�+|(?<=\\w)\\?+(?=\\w)|^\\?(?=\\w)")
_WORDS = re.compile(r"[^\W_~]*(?:~[^\W_~]*)+|[^\W_]+")


def fold(text: str) -> str:
    """Lower case, without accents and punctuation, lost characters as ``~``."""
    if text.isascii():
        t = _LOST.sub("~", text) if "?" in text else text
        t = t.lower().replace("&", " and ")
        return " ".join(_WORDS.findall(t))
    t = _LOST.sub("~", text)
    t = unicodedata.normalize("NFKD", t.lower().translate(_PLAIN)).replace("&", " and ")
    return " ".join(_WORDS.findall("".join(c for c in t if not unicodedata.combining(c))))


class Trie:
    """Maps spellings to entries; several spellings (aliases) may lead to one entry."""

    def __init__(self) -> None:
        self.root: dict = {}
        self.exact: dict[str, set[int]] = {}

    def add(self, word: str, entry: int) -> None:
        if not word:
            return
        self.exact.setdefault(word, set()).add(entry)
        node = self.root
        for c in word:
            node = node.setdefault(c, {})
        node.setdefault("", set()).add(entry)

    def search(self, word: str, k: int) -> dict[int, int]:
        """{entry: distance} of all entries with a spelling within ``k`` edits of ``word``.

        The automaton's state is one bit set for each number of errors: bit i of set d says that i
        characters of the word can be consumed with d errors along the path walked so far.
        """
        m = len(word)
        mask: dict[str, int] = {}
        for i, c in enumerate(word):
            mask[c] = mask.get(c, 0) | (1 << i)
        top, full = 1 << m, (1 << (m + 1)) - 1
        found: dict[int, int] = {}
        start = tuple((1 << (d + 1)) - 1 for d in range(k + 1))
        stack = [(self.root, start)]
        while stack:
            node, r = stack.pop()
            for c, child in node.items():
                if c == "":
                    for d in range(k + 1):
                        if r[d] & top:
                            for e in child:
                                if found.get(e, k + 1) > d:
                                    found[e] = d
                            break
                    continue
                b = mask.get(c, 0)
                prev_old = r[0]
                prev_new = ((prev_old & b) << 1) & full
                new = [prev_new]
                for d in range(1, k + 1):
                    old = r[d]
                    now = ((old & b) << 1) | prev_old | (prev_old << 1) | (prev_new << 1)
                    now &= full
                    new.append(now)
                    prev_old, prev_new = old, now
                if new[k]:
                    stack.append((child, tuple(new)))
        return found

    def closest(self, word: str, most: int) -> tuple[int, dict[int, int]]:
        """Distance of the closest entries and {entry: distance} at the first distance that has any."""
        if word in self.exact:
            return 0, dict.fromkeys(self.exact[word], 0)
        tried = 0
        for k in (1, 2, most):
            if k > most or k <= tried:
                continue
            tried = k
            if hits := self.search(word, k):
                return min(hits.values()), hits
        return most + 1, {}


def allowed(length: int) -> int:
    """Edits allowed for a spelling of this length."""
    return 0 if length < 5 else 1 if length < 9 else 2 if length < 16 else 3 if length < 24 else 4
