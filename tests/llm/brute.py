"""Plain-Python versions of the operators' definitions, for small inputs."""

import math
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(t):
    return re.sub("[A-Z]", lambda m: m.group().lower(), t)


def grams(w, k):
    return [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [" ".join(w)] if w else []


def fingerprint(text):
    sh = grams(WORD.findall(ascii_lower(text or "")), 3)
    n = [0] * 64
    for s in sh:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            n[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * n[b] > len(sh))


def components(pairs):
    """{fingerprint: smallest id reachable} from (fingerprint, id)."""
    fps = sorted({f for f, _ in pairs})
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            root[f] = root[root[f]]
            f = root[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    least = defaultdict(list)
    for f, i in pairs:
        if i is not None:
            least[find(f)].append(i)
    return {f: min(least[find(f)], default=None) for f in fps}


def quality(text):
    t = text or ""
    w = WORD.findall(t)
    at = defaultdict(list)
    for i in range(len(w) - 7):
        at[tuple(w[i:i + 8])].append(i)
    inside = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in t),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(inside)}


def em(patterns, on_good, on_bad, tolerance, most):
    """The label model on {votes: count}."""
    m = len(next(iter(patterns)))
    prior, good, bad = 0.8, [on_good[0] / sum(on_good)] * m, [on_bad[0] / sum(on_bad)] * m

    def p(v):
        x = math.log(prior / (1 - prior))
        for j in range(m):
            x += math.log(good[j] / (1 - bad[j])) if v[j] == 1 else math.log((1 - good[j]) / bad[j]) if v[j] == -1 else 0
        return 1 / (1 + math.exp(-x))

    for _ in range(most):
        ps = {v: p(v) for v in patterns}
        total = sum(patterns.values())
        new_prior = min(.99, max(.01, (sum(n * ps[v] for v, n in patterns.items()) + 8) / (total + 10)))
        new_good, new_bad = [], []
        for j in range(m):
            voted = [(v, n) for v, n in patterns.items() if v[j]]
            g = (sum(n * ps[v] for v, n in voted if v[j] == 1) + on_good[0]) / (sum(n * ps[v] for v, n in voted) + sum(on_good))
            b = (sum(n * (1 - ps[v]) for v, n in voted if v[j] == -1) + on_bad[0]) / (sum(n * (1 - ps[v]) for v, n in voted) + sum(on_bad))
            new_good.append(min(.999, max(.55, g)))
            new_bad.append(min(.99, max(2 * (1 - new_good[j]), .01, b)))
        moved = max(abs(a - b) for a, b in zip([new_prior, *new_good, *new_bad], [prior, *good, *bad], strict=True))
        prior, good, bad = new_prior, new_good, new_bad
        if moved < tolerance:
            break
    return {v: p(v) for v in patterns}


def contained(docs, items):
    """{(doc_id, item_id): (n_item, n_shared)} at containment 0.8 of five-word shingles."""
    out = {}
    sets = [(i, set(grams(WORD.findall((t or "").lower()), 5))) for i, t in items]
    for d, t in docs:
        g = set(grams(WORD.findall((t or "").lower()), 5))
        for i, s in sets:
            if s and len(s & g) * 10 >= len(s) * 8:
                out[d, i] = (len(s), len(s & g))
    return out


def targets(sizes, weights=(5, 2, 1), most=3):
    """{source: target}: shares by weight, capped at ``most`` times the size, the excess reshared."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    capped = set()
    while True:
        left = sum(sizes.values()) - sum(most * sizes[s] for s in capped)
        openw = sum(w[s] for s in order if s not in capped)
        over = {s for s in order if s not in capped and left * w[s] / openw >= most * sizes[s]} if openw else set()
        if not over:
            return {s: most * sizes[s] if s in capped else left * w[s] / openw for s in order}
        capped |= over


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def spans(text):
    digits = lambda m: re.sub("[^0-9]", "", m)
    rules = (("email", EMAIL, lambda m: True), ("ip", IP, lambda m: all(int(x) <= 255 for x in m.split("."))),
             ("card", CARD, lambda m: 16 <= len(digits(m)) <= 19 and _luhn(digits(m))), ("phone", PHONE, lambda m: 8 <= len(digits(m)) <= 15))
    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, r, ok in rules for m in r.finditer(text or "") if ok(m.group()))


def lcs(a, b):
    n = Counter()
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            n[i, j] = n[i - 1, j - 1] + 1 if x == y else max(n[i - 1, j], n[i, j - 1])
    return n[len(a) - 1, len(b) - 1] if a and b else 0
