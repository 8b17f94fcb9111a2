"""Plain single-machine versions of the contracts, to compare results with."""

from __future__ import annotations

import bisect
import hashlib
import math
import re
from collections import Counter
from statistics import NormalDist

import xxhash

BLANK_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def quality_base(text: str | None) -> tuple:
    text = text or ""
    words = BLANK_WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if BLANK_WORD.search(line):
            dup += line in seen
            seen.add(line)
    places: dict = {}
    for i in range(len(words) - 7):
        places.setdefault(tuple(words[i : i + 8]), []).append(i)
    inside = {j for at in places.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    n = len(words)
    return n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(inside), n < 20 or 100 * len(inside) > 30 * n


SECRETS = (
    ("assign", re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A), 2, 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 16),
)


def secret_base(text: str | None) -> tuple:
    found = [(m.start(), k, m.end()) for k, (_, p, g, least) in enumerate(SECRETS) for m in p.finditer(text or "") if len(m[g]) >= least]
    counts = [sum(f[1] == k for f in found) for k in range(3)]
    return *counts, sha(",".join(f"{SECRETS[k][0]}:{a}:{b}" for a, k, b in sorted(found)))


def contaminated(texts: list, items: list) -> list[tuple]:
    windows: dict = {}
    for item, text in items:
        w = ITEM_WORD.findall((text or "").translate(LOWER))
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[i : i + 10]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for text in texts:
        w = ITEM_WORD.findall((text or "").translate(LOWER))
        hit, names = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if got := windows.get(tuple(w[i : i + n])):
                    hit.update(range(i, i + n))
                    names |= got
        out.append((len(w), len(hit), len(names), sha(",".join(sorted(names))), bool(hit)))
    return out


def fingerprint(text: str | None) -> int:
    words = BLANK_WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    k = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + k]).encode(), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(fps: dict[int, int]) -> dict[int, int]:
    """doc_id -> smallest doc_id reachable over pairs with two or fewer differing bits."""
    ids = sorted(fps)
    least = {i: i for i in ids}

    def find(i: int) -> int:
        while least[i] != i:
            i = least[i]
        return i

    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                least[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> int:
    """Sequences that best fit decreasing needs, piece by piece."""
    gaps: list[int] = []
    used = 0
    for n in sorted((n for n, c in counts.items() for _ in range(c)), reverse=True):
        at = bisect.bisect_left(gaps, n)
        gap = gaps.pop(at) if at < len(gaps) else capacity
        used += gap == capacity
        bisect.insort(gaps, gap - n)
    return used


def battery(token: str, encodings, effect: float) -> tuple[int, int, float, float]:
    """Length, alphabet size, chi-squared and the larger p-value of the runs and serial tests of one run."""
    alphabet = next(a for _, p, a in encodings if not p or re.fullmatch(p, token))
    v = [alphabet.index(c) for c in token.replace("-", "+").replace("_", "/")]
    n, k, cdf = len(v), len(alphabet), NormalDist().cdf
    chi = sum((c - n / k) ** 2 / (n / k) for c in (Counter(v)[i] for i in range(k)))
    sides = [x >= k / 2 for x in v]
    high = sum(sides)
    low, runs = n - high, 1 + sum(a != b for a, b in zip(sides, sides[1:], strict=False))
    expected, p_runs = 2 * high * low / n + 1, 1.0
    spread = 2 * high * low * (2 * high * low - n) / (n * n * (n - 1))
    if spread > 0:
        p_runs = cdf(abs(runs - expected) / math.sqrt(spread) - effect * math.sqrt(n))
    mean = sum(v) / n
    around, p_serial = sum((x - mean) ** 2 for x in v), 1.0
    if around > 0:
        p_serial = cdf((abs(sum((a - mean) * (b - mean) for a, b in zip(v, v[1:], strict=False)) / around) - effect) * math.sqrt(n))
    return n, k, chi, max(p_runs, p_serial)


def random_spans(texts: list, candidate: str, encodings, effect: float, fdr: float, least_runs: int) -> list[list[tuple[int, int]]]:
    """Per text the spans that the length-weighted Benjamini-Hochberg rule finds, p-values rounded up to 64 steps a decade."""
    found = [(i, m.start(), m.end(), *battery(m[0], encodings, effect)) for i, t in enumerate(texts) for m in re.finditer(candidate, t or "")]
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    if not found:
        return out
    median = lambda values: sorted(values)[math.ceil(len(values) / 2) - 1]
    uneven, wide = {}, {}
    for k in {f[4] for f in found}:
        runs = [f for f in found if f[4] == k]
        typical = median([(f[5] - k + 1) / (f[3] - 1) for f in runs])
        if len(runs) >= least_runs and typical > 1:
            uneven[k] = typical
    z = lambda n, k, chi: (chi - (k - 1 + n * uneven.get(k, 1.0))) / math.sqrt(2 * (k - 1 + 2 * n * uneven.get(k, 1.0)))
    for k in uneven:
        above = [x for x in (z(*f[3:6]) for f in found if f[4] == k) if x > 0]
        wide[k] = max(1.0, median(above) / 0.6745) if above else 1.0
    mean = sum(f[3] for f in found) / len(found)
    steps = []
    for f in found:
        p = max(NormalDist().cdf(z(*f[3:6]) / wide.get(f[4], 1.0)), f[6])
        p = min(1.0, p * mean / f[3])
        steps.append(1024 if p <= 0 else min(1024, math.floor(-64 * math.log10(p))))
    good = [b for b in set(steps) if 10 ** (-b / 64) * len(found) <= fdr * sum(s >= b for s in steps)]
    for f, b in zip(found, steps, strict=True):
        if good and b >= min(good):
            out[f[0]].append((f[1], f[2]))
    return out
