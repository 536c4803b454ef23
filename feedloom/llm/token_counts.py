"""Word-piece token counts by a linear longest-match automaton.

The vocabulary is a byte trie of word-initial and of continuing pieces. Every
node has a failure link (where matching goes on after the longest pieces of the
read text are popped) and the number of pieces popped on that link, both
computed once. A word is then counted in one pass over its bytes, without going
back and without building pieces. All distinct words of a chunk of texts walk
the automaton side by side.

A word that the vocabulary cannot cover counts as one unknown token. Words are
runs of bytes other than space and 0x09-0x0D; case is kept.

Defined cases: null and wordless texts have no tokens; repeated rows are counted
one by one; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .tables import prepare

CHUNK_BYTES = 4 << 20
MARK = "▁"
_TABLE = bytes(32 if 9 <= b <= 13 else b for b in range(256))
NONE = -1


class PieceAutomaton:
    """Failure-link automaton. Node 0 begins a word, node 1 continues it.

    ``bare``: the vocabulary has a piece that marks a word's beginning alone,
    which is popped when no initial piece fits."""

    def __init__(self, initial: Iterable[bytes], continuing: Iterable[bytes], bare: bool = False):
        child: list[dict[int, int]] = [{}, {}]
        whole: set[int] = set()
        for root, pieces in ((0, initial), (1, continuing)):
            for piece in pieces:
                at = root
                for byte in piece:
                    if byte not in child[at]:
                        child[at][byte] = len(child)
                        child.append({})
                    at = child[at][byte]
                if piece:
                    whole.add(at)
        fail, pops = [NONE] * len(child), [0] * len(child)
        if bare:
            fail[0], pops[0] = 1, 1
        level = [0, 1]
        while level:                                    # nodes by depth
            below = []
            for u in level:
                for byte, v in child[u].items():
                    below.append(v)
                    if v in whole:
                        fail[v], pops[v] = 1, 1
                        continue
                    z, popped = fail[u], pops[u]
                    while z != NONE and byte not in child[z]:
                        popped += pops[z]
                        z = fail[z]
                    if z != NONE:
                        fail[v], pops[v] = child[z][byte], popped
            level = below
        self.fail, self.pops = np.array(fail, dtype=np.int32), np.array(pops, dtype=np.int32)
        edges = np.array([(u << 8 | byte, v) for u, moves in enumerate(child) for byte, v in moves.items()], dtype=np.int64).reshape(-1, 2)
        self.bits = max(4, int(4 * len(edges)).bit_length())
        self.keys, self.to = np.full(1 << self.bits, -1, dtype=np.int64), np.full(1 << self.bits, NONE, dtype=np.int32)
        slot, left = self._slot(edges[:, 0]), np.arange(len(edges))
        while len(left):                                # open addressing, all edges at once
            free = self.keys[slot[left]] == -1
            self.keys[slot[left[free]]] = edges[left[free], 0]
            placed = self.keys[slot[left]] == edges[left, 0]
            self.to[slot[left[placed]]] = edges[left[placed], 1]
            left = left[~placed]
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def move(self, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The next node of each state, or NONE."""
        key = state.astype(np.int64) << 8 | byte
        slot = self._slot(key)
        out = np.where(self.keys[slot] == key, self.to[slot], NONE)
        left = np.flatnonzero((self.keys[slot] != key) & (self.keys[slot] != -1))
        while len(left):
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)
            got = self.keys[slot[left]]
            hit = got == key[left]
            out[left[hit]] = self.to[slot[left[hit]]]
            left = left[~hit & (got != -1)]
        return out

    def count(self, buf: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """Pieces of each word; 0 for a word that cannot be covered."""
        order = np.argsort(-lens, kind="stable")
        starts, lens = starts[order], lens[order]
        state, pieces = np.zeros(len(lens), dtype=np.int32), np.zeros(len(lens), dtype=np.int64)
        longest = int(lens[0]) if len(lens) else 0
        longer = np.searchsorted(-lens, -np.arange(longest), side="left")  # words with more than t bytes
        for t in range(longest):
            live = np.flatnonzero(state[:longer[t]] != NONE)
            byte = buf[starts[live] + t]
            nxt = self.move(state[live], byte)
            stuck = np.flatnonzero(nxt == NONE)
            while len(stuck):
                at = live[stuck]
                pieces[at] += self.pops[state[at]]
                state[at] = self.fail[state[at]]
                stuck = stuck[state[at] != NONE]
                nxt[stuck] = self.move(state[live[stuck]], byte[stuck])
                stuck = stuck[nxt[stuck] == NONE]
            state[live] = nxt
        left = np.flatnonzero((state != 1) & (state != NONE))
        while len(left):                                # pop what is still matched at the word's end
            pieces[left] += self.pops[state[left]]
            state[left] = self.fail[state[left]]
            left = left[(state[left] != 1) & (state[left] != NONE)]
        out = np.empty_like(pieces)
        out[order] = np.where(state == 1, pieces, 0)
        return out


def load_vocabulary(path: str) -> PieceAutomaton:
    """The pieces of a sentencepiece model file as a word-piece vocabulary:
    pieces with the word mark are initial, the others continue a word; control,
    unknown and byte pieces are left out."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    initial = [p[1:].encode() for p in plain if p.startswith(MARK)]
    return PieceAutomaton([p for p in initial if p], [p.encode() for p in plain if MARK not in p], bare=b"" in initial)


def count_tokens(docs: DataFrame, automaton: PieceAutomaton, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_tokens, n_unknown`` for every document row. The
    automaton sent to the tasks has the size of the vocabulary."""
    prepare(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(automaton)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in W.chunks(batches, "text", CHUNK_BYTES):
            w = W.split(W.texts_of(chunk, "text"), _TABLE)
            code, unique = pd.factorize(W.hash_words(w))
            first = np.empty(len(unique), dtype=np.int64)
            first[code[::-1]] = np.arange(len(code))[::-1]
            pieces = sent.value.count(w.buf, w.starts[first], w.lens[first])
            unknown = W.segments_sum((pieces == 0)[code], w.bounds)
            yield pa.RecordBatch.from_arrays([chunk.column(0), pa.array(w.counts), pa.array(W.segments_sum(pieces[code], w.bounds) + unknown), pa.array(unknown)],
                                             ["doc_id", "n_words", "n_tokens", "n_unknown"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {id_type}, n_words long, n_tokens long, n_unknown long")
