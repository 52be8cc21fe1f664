"""Plain single-machine versions of the operators, to compare results with."""

import hashlib
import math
import re
from collections import Counter

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ascii_words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if w]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def base_score(texts, training):
    counts = Counter()
    for text, used in zip(texts, training):
        if used:
            counts.update(ascii_words(text) + [""])
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for text in texts:
        tokens = ascii_words(text) + [""]
        base = sum(math.log10((counts.get(w, 0) + 1) / (total + distinct + 1)) for w in tokens)
        out.append((len(tokens), sum(counts.get(w, 0) > 0 for w in tokens), total, base))
    return out


def secret_base(text):
    text = text or ""
    spans = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m[2]) >= 8:
            spans.append((m.start(), 0, m.end()))
    spans += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 16]
    spans += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if m.end() - m.start() >= 32]
    return sorted(spans)


def window_entropy(key, width=20):
    best = 0.0
    for i in range(len(key) - width + 1):
        counts = Counter(key[i : i + width])
        best = max(best, -sum(n / width * math.log2(n / width) for n in counts.values()))
    return best


def secret_spans(text):
    """Base spans and those that entropy adds: runs of key characters outside base spans."""
    base = secret_base(text)
    letters = list(text or "")
    for a, _, b in base:
        letters[a:b] = " " * (b - a)
    placeholder = re.compile(r"example|sample|placeholder|dummy|abcdefgh|01234567", re.I)
    found = list(base)
    for run in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", "".join(letters)):
        parts = [(run.start(), run[0])]
        if placeholder.search(run[0]):
            parts = [(run.start() + m.start(), m[0]) for m in re.finditer(r"[A-Za-z0-9+]{20,}", run[0]) if not placeholder.search(m[0])]
        for at, key in parts:
            plain = not re.search("[0-9]", key) or not re.search("[A-Za-z]", key)
            uuid = re.fullmatch(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", key)
            if not plain and not uuid and window_entropy(key) > (3.0 if re.fullmatch("[0-9a-fA-F]+", key) else 3.7):
                found.append((at, 3, at + len(key)))
    return sorted(found)


def redacted(text):
    covered = {p for a, _, b in secret_spans(text) for p in range(a, b)}
    return "".join("" if p in covered and p - 1 in covered else "[secret]" if p in covered else c for p, c in enumerate(text))


def secret_row(text):
    spans = secret_base(text)
    kinds = ("assign", "access", "hex")
    n = [sum(s[1] == k for s in spans) for k in range(3)]
    return (*n, sha(",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in spans)))


def license_form(text):
    """Canonical words of a license text, word by word; spellings are written out here again on purpose."""
    import regex

    one = {"licence": "license", "licences": "licenses", "licenced": "licensed", "licencing": "licensing", "sublicence": "sublicense", "acknowledgement": "acknowledgment", "favour": "favor", "organisation": "organization", "recognise": "recognize", "merchantibility": "merchantability", "version": "v", "https": "http"}
    two = {("sub", "license"): ["sublicense"], ("non", "infringement"): ["noninfringement"], ("non", "commercial"): ["noncommercial"], ("per", "cent"): ["percent"], ("copyright", "holders"): ["copyright", "owners"], ("copyright", "holder"): ["copyright", "owner"]}
    prose = "and claim claims holder holders in interest interests is law laws licence license licenses notice notices of or owner owners protection statement statements to".split()
    lines, goes_on = [], False
    for line in (text or "").split("\n"):
        bare = regex.sub(r"^[^\p{L}\p{N}]*", "", line).lower()
        mark = regex.match(r"^[^\p{L}\p{N}]*(\(c\)|©)", line, regex.I)
        year = regex.search(r"\b(19|20)[0-9][0-9]\b", line)
        after = regex.match(r"copyright[ \t]+(\w*)\S*", bare)
        named = after and after[0].rstrip() != "copyright" and after[1] not in prose
        owner = regex.match(r"copyright\b", bare) and (year or "(c)" in bare or "©" in bare or named) or mark and (year or "©" in mark[0])
        if owner or goes_on:
            goes_on = regex.search(r"(,|&|\band)[ \t\r]*$", line, regex.I) is not None
        elif not regex.fullmatch(r"[^\p{L}\p{N}]*all rights reserved[^\p{L}\p{N}]*", line, regex.I):
            lines.append(line)
    words = [one.get(w, w) for w in regex.findall(r"[\p{L}\p{N}]+", "\n".join(lines).lower())]
    out, i = [], 0
    while i < len(words):
        pair = two.get(tuple(words[i : i + 2]))
        out += pair or [words[i]]
        i += 2 if pair else 1
    return " ".join(out)


def bench_words(text):
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER)) if w]


def contamination(text, items):
    words = bench_words(text)
    hit, found = set(), set()
    for item_id, item in items:
        other = bench_words(item)
        if item_id is None or not other:
            continue
        width = min(10, len(other))
        windows = {tuple(other[i : i + width]) for i in range(len(other) - width + 1)}
        for i in range(len(words) - width + 1):
            if tuple(words[i : i + width]) in windows:
                hit.update(range(i, i + width))
                found.add(str(item_id))
    return len(words), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)


def shingles(text, width=5):
    words = ascii_words(text)
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def union_find(ids, links):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def jaccard_components(rows):
    sets = {i: shingles(t) for i, t in rows}
    ids = sorted(sets)
    links = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    roots = union_find(ids, links)
    return {i: (len(sets[i]), roots[i]) for i in ids}
