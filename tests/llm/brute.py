"""Plain versions of what the operators return, for small tables: rows of (doc_id, text)."""

import hashlib
import re
from collections import Counter, defaultdict

NULL_ID = (1 << 63) - 1
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def key(doc_id):
    return NULL_ID if doc_id is None else doc_id


def windows(rows, n=50):
    """op1: words covered by a window that starts in a smaller doc_id too."""
    first = {}
    texts = [(d, WORD.findall(t or "")) for d, t in rows]
    for d, w in texts:
        for i in range(len(w) - n + 1):
            s = tuple(w[i : i + n])
            first[s] = min(first.get(s, NULL_ID), key(d))
    out = []
    for d, w in texts:
        hit = [False] * len(w)
        for i in range(len(w) - n + 1):
            if first[tuple(w[i : i + n])] < key(d):
                hit[i : i + n] = [True] * n
        out.append((d, len(w), sum(hit), sha(" ".join(x for x, h in zip(w, hit) if not h))))
    return out


def shingle_set(text, n=5):
    w = WORD.findall(low(text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1)))


def components(rows):
    """op3: set sizes and the smallest linked doc_id."""
    sets = [(d, shingle_set(t)) for d, t in rows]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[find(i)] = find(j)
    least = defaultdict(lambda: NULL_ID)
    for i, (d, _) in enumerate(sets):
        least[find(i)] = min(least[find(i)], key(d))
    return [(d, len(s), None if least[find(i)] == NULL_ID else least[find(i)]) for i, (d, s) in enumerate(sets)]


def substrings(rows, n=100):
    """op4: bytes covered by an n-byte string that starts earlier too."""
    first = {}
    texts = [(d, (t or "").encode()) for d, t in rows]
    for d, b in texts:
        for i in range(len(b) - n + 1):
            s = b[i : i + n]
            first[s] = min(first.get(s, (NULL_ID, 1 << 60)), (key(d), i))
    out = []
    for d, b in texts:
        hit = [False] * len(b)
        for i in range(len(b) - n + 1):
            if first[b[i : i + n]] < (key(d), i):
                hit[i : i + n] = [True] * n
        spans = sum(h and (i == 0 or not hit[i - 1]) for i, h in enumerate(hit))
        out.append((d, len(b), sum(hit), spans, sha(bytes(x for x, h in zip(b, hit) if not h))))
    return out


def contaminated(rows, items, n=13):
    """op7."""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    owners = defaultdict(set)
    for item, text in items:
        w = word.findall(low(text or ""))
        for i in range(max(1, len(w) - n + 1) if w else 0):
            owners[tuple(w[i : i + n])].add(item)
    sizes = {len(s) for s in owners}
    out = []
    for d, text in rows:
        w = word.findall(low(text or ""))
        hit, found = [False] * len(w), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                s = tuple(w[i : i + size])
                if s in owners:
                    hit[i : i + size] = [True] * size
                    found |= owners[s]
        found.discard(None)  # neither counted nor named
        names = sorted(str(x) for x in found)
        out.append((d, len(w), sum(hit), len(found), sha(",".join(names)), sum(hit) > 0 and 20 * sum(hit) >= len(w)))
    return out


def lines(rows, least_chars=20, least_docs=3):
    """op8."""
    holders = defaultdict(set)

    def norm(line):
        return low(line.strip("\x20\t\n\x0b\x0c\r"))

    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(norm(line)) >= least_chars:
                holders[norm(line)].add(key(d))
    out = []
    for d, t in rows:
        parts = (t or "").split("\n")
        keep = [x for x in parts if len(holders.get(norm(x), ())) < least_docs or max(holders[norm(x)]) == key(d)]
        out.append((d, len(parts), len(parts) - len(keep), sha("\n".join(keep))))
    return out


def base_quality(rows):
    """op9 but for the verdict: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    out = []
    for d, t in rows:
        t = t or ""
        w = WORD.findall(t)
        filled = [x for x in t.split("\n") if WORD.search(x)]
        grams = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
        count, hit = Counter(grams), [False] * len(w)
        for i, g in enumerate(grams):
            if count[g] > 1:
                hit[i : i + 8] = [True] * 8
        n = sum(hit)
        out.append(
            (d, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(filled) - len(set(filled)), n, len(w) < 20 or 100 * n > 30 * len(w))
        )
    return out


def boilerplate(rows, least_docs=20, share=0.1):
    """op9: words in lines that too many texts of a host hold, for rows of (doc_id, host, text)."""
    texts, holders = defaultdict(set), defaultdict(set)
    for _, host, t in rows:
        texts[host or ""].add(t or "")
        for line in (t or "").split("\n"):
            if w := WORD.findall(low(line)):
                holders[host or "", " ".join(w)].add(t or "")
    out = {}
    for d, host, t in rows:
        n = 0
        for line in (t or "").split("\n"):
            if w := WORD.findall(low(line)):
                k = len(holders[host or "", " ".join(w)])
                n += len(w) * (k > least_docs and k > share * len(texts[host or ""]))
        out[d] = n
    return out


def secrets(rows):
    """op2's base: doc_id, n_assign, n_access, n_hex, base_sha256."""
    kinds = [
        ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 8),
        ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16),
        ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 32),
    ]
    out = []
    for d, t in rows:
        spans, counts = [], []
        for i, (kind, pattern, good) in enumerate(kinds):
            found = [m for m in re.finditer(pattern, t or "", re.ASCII) if good(m)]
            counts.append(len(found))
            spans += [(m.start(), i, f"{kind}:{m.start()}:{m.end()}") for m in found]
        out.append((d, *counts, sha(",".join(s[2] for s in sorted(spans)))))
    return out


def warc(rows):
    """op10 for rows of (page_id, html)."""
    import base64

    owner = {}
    for p, h in rows:
        if p is not None:
            owner[h or ""] = max(owner.get(h or "", p), p)
    out = []
    for p, h in rows:
        h = h or ""
        again = p is not None and p < owner[h]
        name = base64.b32encode(hashlib.sha1(h.encode()).digest()).decode()
        out.append((p, len(h.encode()), name, "revisit" if again else "response", owner[h] if again else None))
    return out


def rake(cells, temper=0.7, sweeps=30, tolerance=1e-6):
    """op5: weights of {(source, lang, topic): tokens}."""
    total = sum(cells.values()) or 1
    weight = {c: t / total for c, t in cells.items()}
    target = []
    for axis in range(3):
        have = defaultdict(int)
        for c, t in cells.items():
            have[c[axis]] += t
        raw = {k: v**temper for k, v in have.items() if v}
        target.append({k: v / sum(raw.values()) for k, v in raw.items()})
    for _ in range(sweeps):
        worst = 0
        for axis in range(3):
            now = defaultdict(float)
            for c, w in weight.items():
                now[c[axis]] += w
            factor = {k: target[axis][k] / v for k, v in now.items() if v > 0}
            weight = {c: w * factor.get(c[axis], 1) for c, w in weight.items()}
            worst = max([worst, *(abs(f - 1) for f in factor.values())])
        if worst <= tolerance:
            break
    return weight, target


def probabilities(cells, weight, keep=0.5):
    budget = keep * sum(cells.values())
    low, high = 0.0, 1e30
    for _ in range(300):
        scale = (low + high) / 2
        if sum(min(t, scale * weight[c]) for c, t in cells.items()) < budget:
            low = scale
        else:
            high = scale
    return {c: min(1, high * weight[c] / t) if t else 1 for c, t in cells.items()}


def form(text):
    digits, lines = sum(c in "0123456789" for c in text), text.count("\n")
    return "numbers" if 20 * digits > len(text) else "lines" if 80 * lines > len(text) else "prose"


def mixed(rows, keep=0.5):
    """op5 for rows of (doc_id, text, lang, source): {doc_id: probability} and the sampled ids."""
    import struct

    import xxhash

    of, cells = [], defaultdict(int)
    for d, text, lang, source in rows:
        cell = (source or "", lang or "", form(text or ""))
        of.append((d, cell))
        cells[cell] += len(WORD.findall(text or ""))
    chance = probabilities(cells, rake(cells)[0], keep)

    def draw(d):
        seed = 42 if d is None else xxhash.xxh64(struct.pack("<q", d), seed=42).intdigest()
        return (xxhash.xxh64(b"mixing", seed=seed).intdigest() % (1 << 53)) / (1 << 53)

    return [(d, chance[cell]) for d, cell in of if draw(d) < chance[cell]]


def pipeline(rows, items):
    """Rows of (doc_id, text, lang, source) through all stages; ids and texts before the last, and what that samples."""
    base = {i: r[-1] for i, r in enumerate(base_quality([(i, r[1]) for i, r in enumerate(rows)]))}
    common = boilerplate([(i, r[3], r[1]) for i, r in enumerate(rows)])
    rows = [r for i, r in enumerate(rows) if not base[i] and common[i] <= 0.8 * len(WORD.findall(r[1] or ""))]
    holders = defaultdict(set)

    def norm(line):
        return low(line.strip("\x20\t\n\x0b\x0c\r"))

    for r in rows:
        for line in (r[1] or "").split("\n"):
            if len(norm(line)) >= 20:
                holders[norm(line)].add(r[0])
    rows = [
        (r[0], "\n".join(x for x in (r[1] or "").split("\n") if len(holders.get(norm(x), ())) < 3 or max(holders[norm(x)]) == r[0]), *r[2:])
        for r in rows
    ]
    linked = components([r[:2] for r in rows])
    rows = [r for r, c in zip(rows, linked) if c[2] == r[0]]
    dirty = {r[0] for r in contaminated([r[:2] for r in rows], items) if r[5]}
    rows = [r for r in rows if r[0] not in dirty]
    return rows, mixed(rows)
