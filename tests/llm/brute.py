"""Plain versions of the operators for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import xxhash

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return SPACE_WORD.findall(text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def covered(rows, size=13):
    """rows: (id, text) -> list of sets of removed word positions."""
    least = {}
    for i, t in rows:
        w = words(t)
        if i is not None:
            for k in range(len(w) - size + 1):
                key = tuple(w[k:k + size])
                least[key] = min(least.get(key, i), i)
    out = []
    for i, t in rows:
        w, gone = words(t), set()
        if i is not None:
            for k in range(len(w) - size + 1):
                if least[tuple(w[k:k + size])] < i:
                    gone.update(range(k, k + size))
        out.append(gone)
    return out


def fingerprint(text):
    w = words(lower(text))
    shingles = [" ".join(w[k:k + 3]) for k in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(values, most=3):
    """Smallest index of each value's class under links of at most ``most`` bits."""
    up = list(range(len(values)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= most:
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def license_base(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    places, labels = [], set()
    for phrase, label in (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")):
        p = phrase.split()
        at = [k for k in range(len(w) - len(p) + 1) if w[k:k + len(p)] == p]
        places += at
        if at:
            labels.add(label)
    return w, len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def quality(text):
    t = text or ""
    w = words(t)
    lines = [x for x in t.split("\n") if words(x)]
    at = defaultdict(list)
    for k in range(len(w) - 7):
        at[tuple(w[k:k + 8])].append(k)
    rep = set()
    for v in at.values():
        if len(v) > 1:
            for k in v:
                rep.update(range(k, k + 8))
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(rep),
            len(w) < 20 or 100 * len(rep) > 30 * len(w))


def filled(has, mass, need):
    """min(has, f * mass) with the one f that makes the sum ``need``; dicts of floats."""
    whole = set()
    while True:
        f = (need - sum(has[k] for k in whole)) / (sum(v for k, v in mass.items() if k not in whole) or 1)
        more = {k for k in mass if k not in whole and f * mass[k] > has[k]}
        if not more:
            return {k: has[k] if k in whole else f * v for k, v in mass.items()}
        whole |= more


def mixed(cells, budget, power, sweeps):
    """Probability of each cell (a tuple of values): bounded raking to tempered marginals."""
    has, whole = {k: float(v) for k, v in cells.items()}, budget * sum(cells.values())
    need = []
    for d in range(3):
        own = defaultdict(float)
        for k, v in has.items():
            own[k[d]] += v
        need.append(filled(own, {v: x ** power for v, x in own.items()}, whole))
    mass = dict(has)
    for _ in range(sweeps):
        for d in range(3):
            for value, wanted in need[d].items():
                mass |= filled(has, {k: v for k, v in mass.items() if k[d] == value}, wanted)
        mass = filled(has, mass, whole)
    return {k: min(1.0, v / has[k]) for k, v in mass.items()}
