"""Secret scans: pattern spans, and values in credential context judged by what guessing them costs.

Method (guess-cost dynamic programming): a value is segmented into dictionary words, dates, repeats,
keyboard walks and brute-force spans so that the product of the segments' guesses is least; values
that cost at least ``least_bits`` bits are secrets of kind ``guess``. The cost works on the whole
value, however long, and on repeats of any unit and walks of any length: maximal runs are found once,
and of the starts within a run only those are kept that can still give the least cost. The unit of a
repeat costs what its characters do, or where it begins as its run does, what guessing it costs.

Edge cases: a null text is empty; a very long text is scanned whole; repeated rows give repeated
rows; an empty table gives no rows; further columns are left out.
"""

from __future__ import annotations

import hashlib
import math
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# letters in either case, ASCII only
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
# credential context, wider than the assignments: more names, and any value without white space or quotes
CONTEXT = re.compile(
    r"""(?:password|passwd|passphrase|pwd|secret|token|api_?key|access_?key|auth|credential)s?["']?[\x20\t]*(?::=|=>|[:=])[\x20\t]*["']?([^\s"'<>,;]+)""",
    re.IGNORECASE | re.ASCII,
)
#: The commonest passwords and words in them, commonest first.
COMMON = """password admin login welcome letmein secret master user test guest root qwerty monkey dragon
football baseball iloveyou sunshine princess shadow superman batman trustno hello freedom whatever
michael jordan hunter ranger buster soccer hockey killer george charlie andrew daniel thomas jessica
pepper summer winter spring autumn ginger cookie banana orange purple yellow silver golden diamond
computer internet server database default changeme example sample token access private public system
manager service account company office house family friend forever love angel money lucky happy""".split()
#: Rows of a keyboard.
ROWS = ["`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./", "abcdefghijklmnopqrstuvwxyz"]
DATE = re.compile(
    r"(?:(?:19|20)\d\d[-/._]?(?:0?[1-9]|1[0-2])[-/._]?(?:0?[1-9]|[12]\d|3[01])|(?:0?[1-9]|[12]\d|3[01])[-/._]?(?:0?[1-9]|1[0-2])[-/._]?(?:19|20)\d\d|(?:19|20)\d\d)"
)
RANK = {word: i + 1 for i, word in enumerate(COMMON)}
NEXT = {(row[i], row[i + 1]) for row in ROWS for i in range(len(row) - 1)} | {(row[i + 1], row[i]) for row in ROWS for i in range(len(row) - 1)}
LONGEST = max(map(len, RANK))
LEET = str.maketrans("@4830159$7", "aaebolsgst")
KINDS = ("assign", "access", "hex", "guess")


def _alphabet(c: str) -> float:
    """Bits of one brute-forced character."""
    return math.log2(10 if c.isdigit() else 26 if c.islower() or c.isupper() else 33)


def _segments(value: str, start: int):
    """``(end, bits, kind)`` of the words and dates that begin at ``start``."""
    low = value[start : start + max(LONGEST, 10)].lower()
    plain = low.translate(LEET)
    for size in range(3, min(len(low), LONGEST) + 1):
        rank = RANK.get(low[:size])
        if rank is None and (rank := RANK.get(plain[:size])) is not None:
            rank *= 4  # letters replaced by signs
        if rank is not None:
            yield start + size, math.log2(rank) + (value[start : start + size] != low[:size]), "word"
    for size in (4, 6, 7, 8, 9, 10):
        if size <= len(low) and DATE.fullmatch(low[:size]):
            yield start + size, math.log2(200 if size == 4 else 200 * 365) + 2 * (size > 8), "date"


def _reach(low: str, i: int, j: int) -> int:
    """How many characters from ``i`` on equal those from ``j > i`` on."""
    size, step = 0, 1
    while step:
        if j + size + step <= len(low) and low[i + size : i + size + step] == low[j + size : j + size + step]:
            size, step = size + step, step * 2
        else:
            step //= 2
    return size


def _repeats(low: str) -> list[tuple[int, int, int]]:
    """``(start, end, unit)`` of all maximal repeats, each by its shortest unit.

    One of a unit of p characters holds two neighbouring multiples of p.
    """
    back, n, found = low[::-1], len(low), {}
    for unit in range(1, n // 2 + 1):
        end = 0
        for i in range(0, n - unit, unit):
            if i + unit < end or low[i] != low[i + unit]:
                continue
            start = i + 1 - _reach(back, n - 1 - i - unit, n - 1 - i)
            last = i + unit + _reach(low, i, i + unit)
            if last - start >= 2 * unit:
                found.setdefault((start, last), unit)
                end = last
    return [(start, end, unit) for (start, end), unit in found.items()]


class _Run:
    """A maximal stretch whose parts of ``least`` units or more are segments; a part of k units costs log2(k) above its unit."""

    def __init__(self, start, end, unit, least, bits, first, kind):
        self.start, self.end, self.unit, self.least, self.kind = start, end, unit, least, kind
        self.bits, self.first, self.starts = bits, first, {}

    def at(self, here, best):
        """The cheapest ``(bits, begin)`` of a part that ends here."""
        least, group = (math.inf, 0), (here - self.start) % self.unit
        kept = self.starts.setdefault(group, [])
        unit_bits = self.first if group == 0 else self.bits
        for begin in kept:
            k = (here - begin) // self.unit
            if k >= self.least:
                least = min(least, (best[begin][0] + unit_bits + math.log2(k) + 1, begin))
        return least

    def begin(self, here, best):
        kept = self.starts.setdefault((here - self.start) % self.unit, [])
        if here + self.least * self.unit > self.end:
            return
        # an earlier start that is no dearer at the first end stays so: its log2(k) grows more slowly
        first = best[here][0] + math.log2(self.least)
        if any(best[x][0] + math.log2((here - x) // self.unit + self.least) <= first for x in kept):
            return
        kept[:] = [x for x in kept if best[x][0] < best[here][0]] + [here]


def _runs(value: str):
    low = value.lower()
    bits = [0.0]
    for c in low:
        bits.append(bits[-1] + _alphabet(c))
    for start, end, unit in _repeats(low):
        brute = bits[start + unit] - bits[start]
        yield _Run(start, end, unit, 2, brute, min(brute, guess_cost(low[start : start + unit])[0]), "repeat")
    start = 0
    for i in range(1, len(low) + 1):
        if i == len(low) or (low[i - 1], low[i]) not in NEXT:
            if i - start >= 3:
                yield _Run(start, i, 1, 3, math.log2(50), math.log2(50), "walk")
            start = i


@lru_cache(1 << 14)
def guess_cost(value: str) -> tuple[float, tuple[tuple[int, int, str], ...]]:
    """Bits to guess ``value``, and the segments of the cheapest reading."""
    n = len(value)
    best: list[tuple[float, int, str]] = [(0.0, 0, "")] + [(math.inf, 0, "")] * n
    runs, opened, waiting = [], 0, []
    if n > 1:
        waiting = sorted(_runs(value), key=lambda r: r.start)
    for i in range(n + 1):
        while opened < len(waiting) and waiting[opened].start <= i:
            runs.append(waiting[opened])
            opened += 1
        for run in runs:
            bits, begin = run.at(i, best)
            if bits < best[i][0]:
                best[i] = (bits, begin, run.kind)
        for run in runs:
            run.begin(i, best)
        runs = [run for run in runs if run.end > i]
        if i == n:
            break
        cost = best[i][0]
        # neighbouring brute-force characters are one segment: only its first character pays the 1
        step = cost + _alphabet(value[i]) + (best[i][2] != "brute")
        if step < best[i + 1][0]:
            best[i + 1] = (step, i, "brute")
        for end, bits, kind in _segments(value, i):
            if cost + bits + 1 < best[end][0]:
                best[end] = (cost + bits + 1, i, kind)
    out, at = [], n
    while at:
        _, begin, kind = best[at]
        if kind == "brute" and out and out[-1][2] == "brute" and out[-1][0] == at:
            out[-1] = (begin, out[-1][1], kind)
        else:
            out.append((begin, at, kind))
        at = begin
    return best[n][0], tuple(reversed(out))


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """``(start, kind, end)``, ordered by start, then by kind as listed."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return [(start, KINDS[kind], end) for start, kind, end in sorted(found)]


def guessed_spans(text: str, least_bits: float, least_length: int) -> list[tuple[int, str, int, float]]:
    """Values in credential context that cost ``least_bits`` or more: ``(start, kind, end, bits)``."""
    out = []
    for m in CONTEXT.finditer(text):
        value = m[1].rstrip(".:)]}!?")
        if len(value) >= least_length and (bits := guess_cost(value)[0]) >= least_bits:
            out.append((m.start(1), "guess", m.start(1) + len(value), bits))
    return out


def joined(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end, *_ in spans)


RESULT = (
    "doc_id long, n_assign long, n_access long, n_hex long, n_guess long, base_sha256 string, spans string, "
    "max_guess_bits double"
)


def find_secrets(docs: DataFrame, least_bits: float = 36.0, least_length: int = 8) -> DataFrame:
    """One row per document: counts by kind, a digest of the base spans, all spans."""

    def scan(batches):
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                text = text or ""
                base = base_spans(text)
                more = guessed_spans(text, least_bits, least_length)
                every = sorted([*base, *more], key=lambda s: (s[0], KINDS.index(s[1])))
                count = [sum(kind == s[1] for s in every) for kind in KINDS]
                digest = hashlib.sha256(joined(base).encode()).hexdigest()
                rows.append((doc_id, *count, digest, joined(every), max((s[3] for s in more), default=None)))
            types = [pa.int64()] * 5 + [pa.string(), pa.string(), pa.float64()]
            columns = list(zip(*rows)) or [()] * 8
            names = [x.split()[0] for x in RESULT.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, RESULT)
