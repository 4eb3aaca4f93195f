"""Plain Python versions of what the operators compute."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return [w for w in (text or "").encode().lower().split()]


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    seen, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if seen[x] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(covered),
    )


def shingle_set(text, width):
    w = words(text)
    if len(w) < width:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[k : k + width]) for k in range(len(w) - width + 1))


def near_components(texts, width, percent=80):
    """Smallest linked id for each of ``{id: text}``, over all pairs."""
    sets = {i: shingle_set(t, width) for i, t in texts.items()}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def repeated(texts, size=50):
    """For each id which words lie in a block that occurs before."""
    seen, out = set(), {}
    for i in sorted(texts):
        w = words(texts[i])
        out[i] = [False] * len(w)
        for k in range(len(w) - size + 1):
            block = tuple(w[k : k + size])
            if block in seen:
                out[i][k : k + size] = [True] * size
            seen.add(block)
    return out


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def personal(text):
    out = []
    for kind, pattern in PII.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()


def licence_words(text):
    found = re.findall(r"(?:[^\W_]|\.)+", (text or "").lower())
    return [w for w in (x.strip(".") for x in found) if w]


def licences(text, templates, least):
    """(name, Dice, start, stop) of the standing windows, rating every start."""
    w = licence_words(text)
    grams = list(zip(w, w[1:]))
    rated = []
    for nth, (name, template) in enumerate(templates):
        t = licence_words(template)
        wanted = set(zip(t, t[1:]))
        for i, g in enumerate(grams):
            if g not in wanted:
                continue
            last = max(k for k in range(i, min(i + len(wanted), len(grams))) if grams[k] in wanted)
            window = set(grams[i : last + 1])
            dice = 2 * len(window & wanted) / (len(window) + len(wanted))
            if dice >= least:
                rated.append((-dice, -len(wanted), nth, i, last + 2, name))
    out = []
    for dice, _, _, start, stop, name in sorted(rated):
        if all(stop <= s or start >= e for _, _, s, e in out):
            out.append((name, round(-dice, 9), start, stop))
    return sorted(out, key=lambda x: x[2])
