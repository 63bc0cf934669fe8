"""Plain versions of the operators, one row after another, for comparison."""

from __future__ import annotations

import itertools
import math
import re
import zlib
from collections import Counter
from fractions import Fraction
from hashlib import md5, sha256

import numpy as np
import xxhash

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
RUN = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def lower_words(text):
    return WORD.findall((text or "").translate(UPPER))


def places(words, phrase):
    return [i for i in range(len(words) - len(phrase) + 1) if words[i : i + len(phrase)] == phrase]


def license_rows(docs, base, templates, least):
    """docs: (doc_id, text)."""
    split = [(i, lower_words(t)) for i, t in docs]
    df = Counter(w for _, ws in split for w in set(ws))
    out = []
    for i, ws in split:
        found, base_labels, labels, score = [], set(), set(), 0.0
        for label, text in base:
            at = places(ws, text.split())
            found += at
            if at:
                base_labels.add(label)
                labels.add(label)
                score = 1.0
        for label, text, key in templates:
            ts, ks = text.split(), key.split()
            idf = [math.log((len(docs) + 2.0) / (df[w] + 1.0)) for w in ts]
            at_key = places(ts, ks)[0]
            for s in range(len(ws) - len(ts) + 1):
                if ws[s + at_key : s + at_key + len(ks)] == ks:
                    share = sum(x for w, x, t in zip(ws[s:], idf, ts) if w == t) / sum(idf)
                    if share >= least - 1e-9:
                        labels.add(label)
                        score = max(score, share)
        out.append(
            (i, len(ws), len(found), min(found, default=None), max(found, default=None), ",".join(sorted(base_labels)),
             ",".join(sorted(labels)), round(score, 6))
        )
    return out


def contamination_rows(docs, items, size=10):
    wins: dict[tuple, set] = {}
    for item, text in items:
        ws = lower_words(text)
        if ws and text is not None:
            for i in range(max(1, len(ws) - size + 1)):
                wins.setdefault(tuple(ws[i : i + size]), set()).add("" if item is None else str(item))
    lengths = {len(w) for w in wins}
    out = []
    for i, text in docs:
        ws = lower_words(text)
        hit, ids = set(), set()
        for n in lengths:
            for s in range(len(ws) - n + 1):
                w = tuple(ws[s : s + n])
                if w in wins:
                    hit |= set(range(s, s + n))
                    ids |= wins[w]
        out.append((i, len(ws), len(hit), len(ids), sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return out


def shard_rows(docs, shards=16, seed=5):
    """docs: (doc_id, text, source) with distinct ids -> {doc_id: (shard, slot)}."""
    key = lambda i: md5(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    by: dict = {}
    for i, _, s in docs:
        by.setdefault((s is None, s or ""), []).append((key(i), i))
    ranked = []
    for s, rows in by.items():
        rows.sort()
        ranked += [((2 * r + 1) / (2 * len(rows)), k, s, i) for r, (k, i) in enumerate(rows)]
    ranked.sort()
    out, used = {}, Counter()
    for place, (_, _, _, i) in enumerate(ranked):
        shard = place * shards // len(ranked)
        out[i] = (shard, used[shard])
        used[shard] += 1
    return out


def targets(sizes, weights=(5.0, 2.0, 1.0), share=1.5, epochs=2):
    """sizes: {source: words}; the excess is shared again until no target is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, left, free = {}, share * sum(sizes.values()), set(names)
    while free:
        level = left / sum(w[s] for s in free)
        over = [s for s in free if level * w[s] > epochs * sizes[s]]
        if not over:
            break
        for s in over:
            full[s] = float(epochs * sizes[s])
            left -= full[s]
            free.remove(s)
    return {s: full.get(s, level * w[s] if s in free else 0.0) for s in names}


def mixing_rows(docs, seed=8):
    """docs: (doc_id, text, source) with distinct ids."""
    size = {i: len(RUN.findall(t or "")) for i, t, _ in docs}
    by: dict = {}
    for i, _, s in docs:
        by.setdefault(s, []).append((md5(f"{seed}:{'' if i is None else i}".encode()).hexdigest(), i))
    whole = {s: sum(size[i] for _, i in rows) for s, rows in by.items()}
    want = targets(whole)
    out = []
    for s, rows in by.items():
        budget, before = math.floor(want[s] + 0.5), 0
        rounds = budget // whole[s] if whole[s] else 0
        for _, i in sorted(rows):
            extra = max(0, min(size[i], budget - rounds * whole[s] - before))
            out.append((i, size[i], whole[s], want[s], rounds * size[i] + extra))
            before += size[i]
    return out


def top_rows(rows, k=5, every=50, scale=256):
    """rows: (vec_id, vector)."""
    good = [
        (i, [math.floor(scale * Fraction(float(x))) for x in v])
        for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for at, (q, v) in enumerate(good):
        if q % every == 0:
            others = [o for j, o in enumerate(good) if j != at]
            scored = sorted((-sum(a * b for a, b in zip(v, o)), i) for i, o in others if len(o) == len(v))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return out


def fingerprint(text, n=3):
    words = RUN.findall((text or "").translate(UPPER))
    if not words:
        return 0
    grams = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def component_rows(prints, reach=3):
    """prints: (doc_id, fingerprint)."""
    fps = np.array([f for _, f in prints], np.uint64)
    up = list(range(len(prints)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(prints)):
        for j in np.nonzero(np.bitwise_count(fps[i + 1 :] ^ fps[i]) <= reach)[0]:
            a, b = root(i), root(i + 1 + int(j))
            up[max(a, b)] = min(a, b)
    groups: dict = {}
    for i, (d, _) in enumerate(prints):
        groups.setdefault(root(i), []).append(d)
    first = {r: min((d for d in ds if d is not None), default=None) for r, ds in groups.items()}
    return [(d, f"{f:016x}", first[root(i)]) for i, (d, f) in enumerate(prints)]


ASSIGN = re.compile(r"""(?i:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]+")


def base_secrets(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 12]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= 16]
    return sorted(found)


def entropy(text):
    n = len(text)
    return -sum(c / n * math.log2(c / n) for c in Counter(text).values())


def crc(text):
    return zlib.crc32((text or "").encode())


def subsequence_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        row = list(itertools.accumulate(range(1, len(b) + 1), lambda left, j, r=row: max(left, r[j], r[j - 1] + 1) if x == b[j - 1] else max(left, r[j]), initial=0))
    return row[-1]


def mixed(window):
    digits, upper, lower = (sum(f(c) for c in window) for f in (lambda c: c in "0123456789", str.isupper, str.islower))
    return digits > 0 and upper + lower > 0 or min(upper, lower) >= 5


def hot_places(text):
    """Places of a text that windows of high entropy cover, every window on its own."""
    classes = [("0123456789abcdef", 3.0), ("0123456789ABCDEF", 3.0)]
    letters = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    classes += [(letters, 3.6), (letters + "+/=_-", 3.7)]
    harmless = set()
    for m in re.finditer("[A-Za-z0-9+/_=-]{20,}", text):
        if re.fullmatch("/?([a-z0-9_-]+/)+[a-z0-9_-]*", m[0]):
            harmless |= set(range(*m.span()))
        for p in (r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", "(?i)example|sample|placeholder|changeme|your[_-]?", "(sha(1|256|384|512)|md5)-[A-Za-z0-9+/=]+"):
            for x in re.finditer(p, m[0]):
                harmless |= set(range(m.start() + x.start(), m.start() + x.end()))
    out = set()
    for i in range(len(text) - 19):
        window = text[i : i + 20]
        if mixed(window) and any(set(window) <= set(c) and entropy(window) > bits + 1e-9 for c, bits in classes):
            places = set(range(i, i + 20))
            if not places & harmless:
                out |= places
    return out


def document_statistics(text):
    """The classifier's statistics, byte after byte and word after word."""
    data = (text or "").encode("utf-8", "replace")
    kinds = [
        lambda b: 65 <= b <= 90, lambda b: 97 <= b <= 122 or b >= 128, lambda b: 48 <= b <= 57, lambda b: b in b" \t\r\f\v",
        lambda b: b == 10, lambda b: b in b".,;:'\"()", lambda b: b in b"!?", lambda b: b in b"|/\\-_=+<>[]{}", lambda b: b in b"#*%$&@^~`",
    ]
    shares = [sum(1 for b in data if kind(b)) / len(data) if data else 0.0 for kind in kinds]
    words, lines = (text or "").split(), [x for x in (text or "").split("\n") if x != ""]
    n, k = len(words) or 1, len(lines) or 1
    longest = 0
    for w in words:
        longest = max(longest, len(w))
    return [
        *shares, math.log(1 + len(words)), len(text or "") / n, len(set(words)) / n, len(set(lines)) / k, len(words) / k,
        math.log(1 + len(lines)), longest, len([x for x in lines if len(x) < 20]) / k, len([w for w in words if not w[-1].isalnum()]) / n,
    ]
