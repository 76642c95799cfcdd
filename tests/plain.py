"""Plain Python forms of the similarity rules, to check the Spark forms against."""

import math
import re
from collections import Counter


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


CODES = {c: d for d, cs in {"1": "BFPV", "2": "CGJKQSXZ", "3": "DT", "4": "L", "5": "MN", "6": "R"}.items() for c in cs}


def sound_code(text):
    letters = re.sub("[^A-Z]", "", text.upper())
    if not letters:
        return "0000"
    coded = "".join(CODES.get(c, c) for c in letters)
    out = []
    for c in coded:
        if not (out and c.isdigit() and out[-1] == c):
            out.append(c)
    tail = [c for c in out[1:] if c not in "AEIOUY"]
    return letters[0] + "".join(tail)[:3].ljust(3, "0")


def similarity(a, b):
    a, b = (re.sub(r"[^\w\s]", "", s.lower().strip()) for s in (a, b))
    if not a or not b:
        return 0.0
    x, y = Counter(a.split()), Counter(b.split())
    union = len(x.keys() | y.keys())
    jac = len(x.keys() & y.keys()) / union if union else 0.0
    norm = math.sqrt(sum(v * v for v in x.values())) * math.sqrt(sum(v * v for v in y.values()))
    cos = sum(v * y[k] for k, v in x.items()) / norm if norm else 0.0
    edit = 1 - edit_distance(a, b) / max(len(a), len(b))
    return jac * 0.3 + cos * 0.3 + edit * 0.3 + (0.1 if sound_code(a) == sound_code(b) else 0.0)


def greedy(items, alike):
    """(kept positions, position -> leader) of the sequential pass."""
    kept, lead = [], {}
    for i, x in enumerate(items):
        hit = next((k for k in kept if alike(items[k], x)), None)
        lead[i] = i if hit is None else hit
        if hit is None:
            kept.append(i)
    return kept, lead
