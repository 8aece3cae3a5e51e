"""Plain Python versions of the operators, for small inputs."""

import collections
import hashlib
import re

import xxhash

WORD = re.compile("[^\x20\x09-\x0D]+")
PHRASE_WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else bytes(data)).hexdigest()


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def ordered(rows):
    return sorted(rows, key=repr)


def measures(text):
    words = WORD.findall(text or "")
    n = len(words)
    triples = collections.Counter(tuple(words[i : i + 3]) for i in range(n - 2))
    repeated = {j for i in range(n - 2) if triples[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    return (
        n,
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(repeated),
        n < 50 or 100 * len(repeated) > 50 * n,
    )


def substring_dedup(rows, length):
    def order(doc_id):
        return 1 << 62 if doc_id is None else doc_id

    words = [(text or "").encode().split() for _, text in rows]
    first = {}
    for (doc_id, _), w in zip(rows, words):
        for j in range(len(w) - length + 1):
            x = tuple(w[j : j + length])
            first[x] = min(first.get(x, order(doc_id)), order(doc_id))
    out = []
    for (doc_id, _), w in zip(rows, words):
        gone = set()
        for j in range(len(w) - length + 1):
            if first[tuple(w[j : j + length])] < order(doc_id):
                gone.update(range(j, j + length))
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((doc_id, len(w), len(gone), sha(kept)))
    return ordered(out)


def suffix_dedup(rows, length):
    texts = [(text or "").encode() for _, text in rows]
    seen = collections.Counter(b[j : j + length] for b in texts for j in range(len(b) - length + 1))
    out = []
    for (doc_id, _), b in zip(rows, texts):
        gone = set()
        for j in range(len(b) - length + 1):
            if seen[b[j : j + length]] > 1:
                gone.update(range(j, j + length))
        spans = sum(j - 1 not in gone for j in gone)
        out.append((doc_id, len(b), len(gone), spans, sha(bytes(x for j, x in enumerate(b) if j not in gone))))
    return ordered(out)


def contamination(docs, items, length):
    phrases = collections.defaultdict(set)
    for item, text in items:
        w = PHRASE_WORD.findall(lower(text))
        for j in range(max(1, len(w) - length + 1) if w else 0):
            phrases[tuple(w[j : j + length])].add("" if item is None else str(item))
    out = []
    for doc_id, text in docs:
        w = PHRASE_WORD.findall(lower(text))
        hit, found = set(), set()
        for n in {len(p) for p in phrases}:
            for j in range(len(w) - n + 1):
                own = phrases.get(tuple(w[j : j + n]))
                if own:
                    found |= own
                    hit.update(range(j, j + n))
        bad = len(hit) > 0 and 20 * len(hit) >= len(w)
        out.append((doc_id, len(w), len(hit), len(found), sha(",".join(sorted(found))), bad))
    return ordered(out)


def fingerprint(text, shingle=3):
    words = WORD.findall(lower(text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def linked(values, near):
    """For each value the smallest place reachable over links."""
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if near(values[i], values[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]
