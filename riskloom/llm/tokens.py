"""Token counts of a byte-level BPE vocabulary by a compiled finite-state transducer.

Method (finite-state tokenizer compilation): the splitting rule of the vocabulary is compiled to a
deterministic transducer over classes of characters. Texts are cut into chunks of equal length; each
chunk gives the map from every state to the state it ends in; a parallel prefix scan composes these
maps, which tells each chunk the state it begins in; then all chunks run at once and mark where
pieces begin. A piece's closing transition emits its number of tokens, from a table that is filled
by the vocabulary's merges when a task meets a piece for the first time.

Edge cases: a null or empty text has no tokens; a very long text is cut into chunks like any other;
repeated rows give repeated rows; an empty table gives no rows; further columns are left out.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.arrays import FIRST, text_slices

CHUNK, TABLE_LIMIT = 64, 400_000
# classes of characters: the letters of contractions apart, since they end pieces after an apostrophe
LETTER, NUMBER, BLANK, SPACE, QUOTE, OTHER, ONE, R, V, E, L, END = range(12)
# states: what the piece so far is; a run of spaces is told by its length and its last character
(AT_START, IN_LETTERS, IN_NUMBERS, IN_OTHERS, ONE_BLANK, ONE_SPACE, BLANK_LAST, SPACE_LAST, QUOTED, QUOTED_R, QUOTED_V, QUOTED_L, CONTRACTED) = range(13)
#: Unicode White_Space.
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def _classes():
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    out[WHITE] = SPACE
    out[0x20], out[0x27], out[0] = BLANK, QUOTE, OTHER
    for c in "stmd":
        out[ord(c)] = ONE
    for c, kind in (("r", R), ("v", V), ("e", E), ("l", L)):
        out[ord(c)] = kind
    return out


def compile_splitter():
    """``next_state[class, state]`` and ``begins[class, state]``: 1 a piece begins here, 2 one character ago."""
    go, out = np.zeros((12, 13), np.uint8), np.zeros((12, 13), np.uint8)
    for state in range(13):
        white = state in (ONE_BLANK, ONE_SPACE, BLANK_LAST, SPACE_LAST)
        blank = state in (ONE_BLANK, BLANK_LAST)
        pending = 2 if state in (QUOTED_R, QUOTED_V, QUOTED_L) else 0  # its letter begins a piece, unless the contraction goes on
        # a run of several spaces gives its last one away; a single blank joins the piece after it
        given = 2 if state in (BLANK_LAST, SPACE_LAST) else 0
        joins = 0 if blank else 1
        for kind in range(12):
            if kind == END:
                go[kind, state], out[kind, state] = AT_START, pending
            elif kind in (BLANK, SPACE):
                last = {BLANK: (ONE_BLANK, BLANK_LAST), SPACE: (ONE_SPACE, SPACE_LAST)}[kind]
                go[kind, state], out[kind, state] = (last[1], 0) if white else (last[0], 1 | pending)
            elif kind in (QUOTE, OTHER):
                if state in (IN_OTHERS, QUOTED):
                    go[kind, state], out[kind, state] = IN_OTHERS, 0
                else:
                    go[kind, state] = QUOTED if kind == QUOTE and not blank else IN_OTHERS
                    out[kind, state] = given | joins | pending
            elif kind == NUMBER:
                go[kind, state], out[kind, state] = (IN_NUMBERS, 0) if state == IN_NUMBERS else (IN_NUMBERS, given | joins | pending)
            elif state == QUOTED and kind in (ONE, R, V, L):
                go[kind, state] = {ONE: CONTRACTED, R: QUOTED_R, V: QUOTED_V, L: QUOTED_L}[kind]
            elif (state, kind) in ((QUOTED_R, E), (QUOTED_V, E), (QUOTED_L, L)):
                go[kind, state] = CONTRACTED
            elif pending or state == IN_LETTERS:
                go[kind, state], out[kind, state] = IN_LETTERS, pending
            else:
                go[kind, state], out[kind, state] = IN_LETTERS, given | joins
    return go, out


def piece_starts(kinds, go, out):
    """Where pieces begin in a sequence of classes, by chunk maps and their scan."""
    n = len(kinds)
    lanes = -(-n // CHUNK)
    padded = np.full(lanes * CHUNK, END, np.uint8)
    padded[:n] = kinds
    columns = np.ascontiguousarray(padded.reshape(lanes, CHUNK).T).astype(np.intp)
    states = go.shape[1]
    flat_go, flat_out = go.ravel(), out.ravel()
    maps = np.tile(np.arange(states, dtype=np.uint8), (lanes, 1))
    for kind in columns:
        maps = flat_go[kind[:, None] * states + maps]
    # inclusive scan: after it, maps[i] is the map of chunks 0..i
    step = 1
    while step < lanes:
        maps[step:] = np.take_along_axis(maps[step:], maps[:-step].astype(np.intp), axis=1)
        step *= 2
    state = np.concatenate([[AT_START], maps[:-1, AT_START]]).astype(np.intp)
    emitted = np.empty((CHUNK, lanes), np.uint8)
    for i, kind in enumerate(columns):
        at = kind * states + state
        emitted[i] = flat_out[at]
        state = flat_go[at].astype(np.intp)
    emitted = emitted.T.ravel()[:n]
    begins = (emitted & 1).astype(bool)
    begins[np.flatnonzero(emitted & 2) - 1] = True
    return begins


class Counter:
    """Counts tokens with one vocabulary; the table of pieces is bounded and refilled as needed."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.special]
        self.kinds, (self.go, self.out) = _classes(), compile_splitter()
        self.known, self.tokens = np.empty(0, np.uint64), np.empty(0, np.int64)

    def _lookup(self, hashes, piece):
        """Tokens of each distinct piece; ``piece(i)`` gives its text."""
        at = np.searchsorted(self.known, hashes)
        found = at < len(self.known)
        found[found] = self.known[at[found]] == hashes[found]
        counts = np.zeros(len(hashes), np.int64)
        counts[found] = self.tokens[at[found]]
        new = np.flatnonzero(~found)
        if len(new):
            encoded = self.tokenizer.encode_batch_fast([piece(i) for i in new], add_special_tokens=False)
            counts[new] = [len(x.ids) for x in encoded]
            known, tokens = (self.known, self.tokens) if len(self.known) + len(new) <= TABLE_LIMIT else (self.known[:0], self.tokens[:0])
            known, tokens = np.concatenate([known, hashes[new]]), np.concatenate([tokens, counts[new]])
            order = np.argsort(known)
            self.known, self.tokens = known[order], tokens[order]
        return counts

    def count(self, texts: list[str]):
        """Tokens of each text."""
        parts, owner, totals = [], [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            pieces = [text]
            for special in self.special:
                if special in text:
                    pieces = [y for x in pieces for y in x.split(special)]
            totals[i] += len(pieces) - 1  # each cut is one special token
            parts += pieces
            owner += [i] * len(pieces)
        line = "\0".join(parts)
        codes = np.frombuffer(line.encode("utf-32-le"), np.uint32)
        if not len(codes):
            return totals
        ends = np.cumsum([len(p) + 1 for p in parts])
        kinds = self.kinds[codes]
        kinds[ends[:-1] - 1] = END
        begins = piece_starts(kinds, self.go, self.out)
        cut = begins.copy()
        cut[ends[:-1] - 1] = True  # a separator closes the piece before it
        edge = np.flatnonzero(cut)
        stop = np.append(edge[1:], len(codes))
        real = begins[edge]
        start, stop = edge[real], stop[real]
        hashes = FIRST.span(FIRST.sums(codes.astype(np.uint64) + np.uint64(1)), start, stop) + (stop - start).astype(np.uint64)
        distinct, first, group = np.unique(hashes, return_index=True, return_inverse=True)
        counts = self._lookup(distinct, lambda i: line[start[first[i]] : stop[first[i]]])
        of = np.asarray(owner)[np.searchsorted(ends, start, side="right")]
        return totals + np.bincount(of, weights=counts[group], minlength=len(texts)).astype(np.int64)


def _batches(path):
    def run(batches):
        counter = Counter(path)
        for batch in batches:
            for first, last, _, bounds in text_slices(batch.column("text"), 1 << 19):
                rows = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array(np.diff(bounds)), pa.array(counter.count(rows.column("text").to_pylist()))],
                    names=["doc_id", "n_bytes", "n_tokens"],
                )

    return run


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 1024) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit``: no special tokens are added; those in a text count as one.

    ``vocabulary`` is the path of a byte-level BPE file, the same on all executors.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    counted = texts.mapInArrow(_batches(vocabulary), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
