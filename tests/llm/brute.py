"""Plain Python versions of what the operators must return."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from itertools import combinations

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
ITEM = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode())


def item_words(text: str | None) -> list[bytes]:
    return ITEM.findall((text or "").encode().lower())


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def fold(doc_id, folds: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % folds


def line_dedup(docs: list[tuple]) -> dict:
    """id -> (n_lines, n_dropped, kept hash)."""

    def key(line: str) -> str:
        return line.strip(" \t\n\x0b\x0c\r").encode().lower().decode()

    holders: dict[str, set] = {}
    for doc, text in docs:
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), set()).add(doc)
    out = {}
    for doc, text in docs:
        lines = (text or "").split("\n")
        kept = [
            x for x in lines
            if len(key(x)) < 10 or len(holders[key(x)]) < 2 or min(holders[key(x)]) == doc
        ]
        out[doc] = (len(lines), len(lines) - len(kept), sha("\n".join(kept)))
    return out


def shingles(text: str | None, n: int) -> set:
    own = [w.lower() for w in words(text)]
    if not own:
        return set()
    if len(own) < n:
        return {("short", *own)}
    return {tuple(own[i : i + n]) for i in range(len(own) - n + 1)}


def components(docs: list[tuple], n: int, percent: int) -> dict:
    sets = {doc: shingles(text, n) for doc, text in docs}
    root = {doc: doc for doc in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {doc: (len(sets[doc]), find(doc)) for doc in sets}


def contamination(docs: list[tuple], items: list[tuple], size: int = 10) -> dict:
    """id -> (n_words, hit positions, item names)."""
    windows: dict[tuple, set] = {}
    for item, text in items:
        own = item_words(text)
        for i in range(max(min(len(own), 1), len(own) - size + 1)):
            windows.setdefault(tuple(own[i : i + size]), set()).add(str(item))
    out = {}
    for doc, text in docs:
        own, hit, names = item_words(text), set(), set()
        for window, held in windows.items():
            for i in range(len(own) - len(window) + 1):
                if tuple(own[i : i + len(window)]) == window:
                    hit.update(range(i, i + len(window)))
                    names |= held
        out[doc] = (len(own), hit, names)
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


PERSONAL = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def personal(text: str | None) -> list[str]:
    out = []
    for kind, pattern in PERSONAL.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            sure = {
                "email": lambda m=m: True,
                "ip": lambda m=m: all(int(x) <= 255 for x in m[0].split(".")),
                "card": lambda d=digits: 16 <= len(d) <= 19 and luhn(d),
                "phone": lambda d=digits: 8 <= len(d) <= 15,
            }[kind]()
            if sure:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def quality_counts(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    own = words(text)
    grams = [tuple(own[i : i + 3]) for i in range(len(own) - 2)]
    often = Counter(grams)
    inside = {k for i, g in enumerate(grams) if often[g] >= 2 for k in range(i, i + 3)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (
        len(own), sum(len(w.decode()) for w in own), len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)), len(inside),
    )


def mix_targets(sizes: dict) -> dict:
    """Source -> target, by sharing the excess out again until none is
    left; sizes in the order of the sources."""
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sizes)}
    target, free, left = {}, set(sizes), 1.5 * sum(sizes.values())
    while free:
        unit = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * unit > 2 * sizes[s]}
        for s in over or free:
            target[s] = 2 * sizes[s] if over else weight[s] * unit
        left -= sum(2 * sizes[s] for s in over)
        free -= over or free
    return target
