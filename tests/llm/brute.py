"""The contracts in plain Python, for small inputs."""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections import Counter, defaultdict
from html import unescape

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def contamination(docs, items):
    grams, lengths = defaultdict(set), set()
    for item, text in items:
        w = WORD.findall(low(text))
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            grams[tuple(w[k : k + n])].add(str(item) if item is not None else None)
            lengths.add(n)
    out = []
    for doc, text in docs:
        w, hit, found = WORD.findall(low(text)), set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                got = grams.get(tuple(w[k : k + n]))
                if got:
                    hit |= set(range(k, k + n))
                    found |= got - {None}
        bad = bool(hit) and 20 * len(hit) >= len(w)
        out.append((doc, len(w), len(hit), len(found), sha(",".join(sorted(found))), bad))
    return out


def encoded(docs, tokenizer, end=2):
    """Rows in stored order; only meaningful for distinct ids or equal texts."""
    start, out = 0, []
    for doc, text in sorted(docs, key=lambda r: (r[0] is None, r[0] or 0)):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]
        out.append((doc, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return out


def shingles(text):
    w = low(text).encode().split()
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def similar_groups(docs):
    sets = {d: shingles(t) for d, t in docs}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [(d, len(sets[d]), find(d)) for d in ids]


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (2 if k % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base_spans(text):
    out = [(m.start(), 0, m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(len(x) <= 3 and int(x or "0") <= 255 for x in (part.lstrip("0") for part in m[0].split("."))):
            out.append((m.start(), 1, m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end(), "phone"))
    return [(s, e, k) for s, _, e, k in sorted(out)]


def line_key(line):
    return low(line.strip(" \t\n\x0b\x0c\r"))


def dedup_lines(docs, threshold=10):
    counts = Counter()
    for _, text in docs:
        counts.update({line_key(x) for x in (text or "").split("\n")} - {""})
    out = []
    for doc, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if counts[line_key(x)] < threshold]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def article(html):
    inner = re.search(r"<article>(.*?)</article>", html, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", inner.replace("<br>", " "))
    texts = (re.sub(r"\s+", " ", unescape(re.sub(r"<[^>]+>", "", b))).strip() for b in blocks)
    return " ".join(t for t in texts if t)


def quality(text):
    text = text or ""
    w = SPACED.findall(text)
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    seen = Counter(zip(w, w[1:], w[2:]))
    covered = set()
    for k in range(len(w) - 2):
        if seen[w[k], w[k + 1], w[k + 2]] > 1:
            covered |= {k, k + 1, k + 2}
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    bad = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), bad
