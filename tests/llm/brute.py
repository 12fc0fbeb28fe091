"""Plain versions of what the operators must give."""

import re
from itertools import combinations

_LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return text.translate(_LOWER)


def digits(text):
    return re.sub(r"[^0-9]", "", text)


def luhn(number):
    total = 0
    for place, sign in enumerate(reversed(number)):
        value = int(sign) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


PII = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
           lambda m: all(int(part) <= 255 for part in m[0].split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+",
             lambda m: 14 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m[0])) <= 15),
}
SECRETS = {
    "assign": (
        r"((?ai:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
        r"([A-Za-z0-9+/_.=-]+)", lambda m: len(m[2]) >= 6),
    "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
}


def spans(text, rules):
    """Base spans ``(kind, start, end)`` by start, then kind."""
    found = [
        (kind, m.start(), m.end())
        for kind, (pattern, passes) in rules.items() for m in re.finditer(pattern, text) if passes(m)
    ]
    order = list(rules)
    return sorted(found, key=lambda s: (s[1], order.index(s[0])))


def shingles(text, words):
    found = WORD.findall(lower(text))
    if len(found) >= words:
        return frozenset(tuple(found[i : i + words]) for i in range(len(found) - words + 1))
    return frozenset([tuple(found)]) if found else frozenset()


def near_components(texts, words, percent):
    """Id to the smallest id reachable over links."""
    sets = {number: shingles(text, words) for number, text in texts.items()}
    parent = {number: number for number in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(n for n in sets if sets[n]), 2):
        small, large = sorted((len(sets[a]), len(sets[b])))
        if 100 * small < percent * large:
            continue
        common = len(sets[a] & sets[b])
        if 100 * common >= percent * (small + large - common):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {number: root(number) for number in texts}
