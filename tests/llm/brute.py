"""Plain reference versions of the training-data operators."""

import hashlib
import re
from collections import Counter

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


class Sets:
    def __init__(self, n):
        self.parent = list(range(n))

    def find(self, x):
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def lowest(sets, ids):
    """For each row the smallest id of its class that is not null (its own if all are)."""
    low = {}
    for i, v in enumerate(ids):
        r = sets.find(i)
        if v is not None and (low.get(r) is None or v < low[r]):
            low[r] = v
    return [low.get(sets.find(i)) for i in range(len(ids))]


def shingle_set(text, k):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if len(w) >= k:
        return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}
    return {tuple(w)} if w else set()


def near_classes(rows, k, percent):
    """Sorted (id, n_shingles, component_id)."""
    s = [shingle_set(t, k) for _, t in rows]
    held, sets = {}, Sets(len(rows))
    for i, x in enumerate(s):
        both = Counter(j for g in x for j in held.get(g, ()))
        for g in x:
            held.setdefault(g, []).append(i)
        for j, n in both.items():
            if 100 * n >= percent * (len(x) + len(s[j]) - n):
                sets.join(i, j)
    return [(i, len(x), c) for (i, _), x, c in zip(rows, s, lowest(sets, [i for i, _ in rows]), strict=True)]


def repeated_words(rows, width):
    """Per row (id, n_words, n_removed, sha256 of the kept words); distinct ids."""
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        w = WORD.findall(t or "")
        keep = [True] * len(w)
        for a in range(len(w) - width + 1):
            key = tuple(w[a:a + width])
            if key in seen:
                keep[a:a + width] = [False] * width
            seen.add(key)
        kept = [x for x, ok in zip(w, keep, strict=True) if ok]
        out.append((i, len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out


def good_vector(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)


def embedding_classes(rows, threshold):
    """(id, n_links, component_id) of (id, vector, label) rows."""
    sets, links = Sets(len(rows)), [0] * len(rows)
    for a, (_, x, la) in enumerate(rows):
        for b in range(a):
            _, y, lb = rows[b]
            if la is None or la != lb or not good_vector(x) or not good_vector(y) or len(x) != len(y):
                continue
            x1, y1 = np.array(x, float), np.array(y, float)
            if x1 @ y1 / (np.linalg.norm(x1) * np.linalg.norm(y1)) >= threshold:
                links[a] += 1
                links[b] += 1
                sets.join(a, b)
    return [(r[0], n, c) for r, n, c in zip(rows, links, lowest(sets, [r[0] for r in rows]), strict=True)]


def url_verdict(url, rules, default="allow"):
    """(host, path, rule, verdict)."""
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host):]).group()
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for rule, action in rules:
        if rule is None or action is None:
            continue
        cut = rule.find("/")
        h, p = (rule[:cut], rule[cut:]) if cut >= 0 else (rule, "")
        if url is not None and "://" in url and (h == "" or host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(best or (-1, "", ""), (len(rule), rule, action))
    return host, path, best[1] if best else None, best[2] if best else default
