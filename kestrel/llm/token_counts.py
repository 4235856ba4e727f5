"""Token counts of a byte-fallback BPE by a compiled finite-state transducer.

The tokenizer's vocabulary is compiled, transition by transition as texts ask
for them, into a deterministic transducer over characters.  After a prefix p of
the text, the state holds what the future can depend on: the longest suffix of
p that some longer piece starts with, and for each position inside that suffix
the last token of the prefix that ends there and how many tokens fewer it has.
Reading a character finds the one piece that ends the new prefix's tokenization
(a piece t fits after token s if BPE splits s + t into exactly s, t), and the
transition is annotated with the number of tokens that this adds, which may be
negative when pieces merge.  The annotations of a path sum to the token count.

Texts are cut into chunks.  A chunk's state map says, for a start state, the end
state and the tokens emitted; chunks run side by side as numpy lanes, one
character a step.  A chunk that starts at a space behind a non-space has one
possible start state, because no piece reaches over such a place.  Other chunks
(no space for a chunk's length) get their maps for the start states that the
maps before them can end in, until no new one turns up.  A prefix scan by
pointer doubling then composes the maps of each text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import text_slices

SPACE = "▁"
#: Characters of a chunk; bytes of transition tables that a worker keeps before it compiles anew.
CHUNK = 512
TABLE_BYTES = 160 << 20
#: A transition is one number: next state << 6 | tokens added + 32.
SHIFT, ZERO = 6, 32


class Transducer:
    """Lazily compiled transducer of a sentencepiece BPE model."""

    def __init__(self, model_path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        special = [model.is_control, model.is_unknown, model.is_byte]
        self.rank: dict[str, float] = {}
        for i in range(model.get_piece_size()):
            if not any(f(i) for f in special):
                self.rank[model.id_to_piece(i)] = -model.get_score(i)
        self.starts = {p[:k] for p in self.rank for k in range(1, len(p))}
        self.fits: dict[tuple[str, str], bool] = {}
        self.reset()

    def reset(self) -> None:
        """Forget the compiled part; state 0 is the start, or any place that no piece reaches over."""
        self.keys: list[tuple] = [(("", None, 0),)]
        self.states: dict[tuple, int] = {self.keys[0]: 0}
        self.symbol_of = np.full(0x110000, -1, np.int16)
        self.chars: list[str] = []
        self.outside: dict[int, str] = {}  # the first character outside the vocabulary, by UTF-8 length
        self.table = np.full((4096, 96), -1, np.int32)

    def bpe(self, text: str) -> list[str]:
        """BPE of a short string by its definition: merge the best pair, leftmost first, until none is left."""
        parts = list(text)
        while len(parts) > 1:
            best = min((self.rank.get(parts[i] + parts[i + 1], np.inf), i) for i in range(len(parts) - 1))
            if best[0] == np.inf:
                break
            parts[best[1]:best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        return parts

    def _fits(self, left: str, right: str) -> bool:
        key = (left, right)
        if key not in self.fits:
            if len(self.fits) > 1 << 20:
                self.fits.clear()
            self.fits[key] = self.bpe(left + right) == [left, right]
        return self.fits[key]

    def step(self, state: int, char: str) -> tuple[int, int]:
        """(next state, tokens added).

        A key lists the open positions, longest first: (text from there on, last
        token before it or None, tokens there are more of by now).
        """
        key = self.keys[state]
        if char not in self.rank:  # as bytes, and nothing reaches over them
            return 0, len(char.encode())
        last = key[-1][1]
        if char == SPACE and last is not None and last[-1] != SPACE:
            key = self.keys[0]  # no piece has a space behind another character
        for text, before, since in key:
            piece = text + char
            if piece in self.rank and (before is None or self._fits(before, piece)):
                added = 1 - since
                break
        else:
            raise ValueError(f"no piece ends in {char!r}")
        open_ = [(t + char, b, n + added) for t, b, n in key if t + char in self.starts]
        new = (*open_, ("", piece, 0))
        if new not in self.states:
            self.states[new] = len(self.keys)
            self.keys.append(new)
        return self.states[new], added

    def symbols(self, points: np.ndarray) -> np.ndarray:
        """Columns of code points; characters outside the vocabulary share one for each UTF-8 length."""
        out = self.symbol_of[points]
        if (out < 0).any():
            for p in np.unique(points[out < 0]).tolist():
                char = SPACE if p == 32 else chr(p)
                if char not in self.rank:
                    char = self.outside.setdefault(len(char.encode()), char)
                if char not in self.chars:
                    self.chars.append(char)
                self.symbol_of[p] = self.chars.index(char)
            if len(self.chars) > self.table.shape[1]:
                self._grow(len(self.table), len(self.chars) + 32)
            out = self.symbol_of[points]
        return out

    def _grow(self, rows: int, columns: int) -> None:
        table = np.full((rows, columns), -1, np.int32)
        table[: self.table.shape[0], : self.table.shape[1]] = self.table
        self.table = table

    def _compile(self, states: np.ndarray, symbols: np.ndarray) -> None:
        for k in np.unique(states << 16 | symbols).tolist():
            state, symbol = k >> 16, k & 0xFFFF
            to, added = self.step(state, self.chars[symbol])
            if to >= len(self.table):
                self._grow(len(self.table) * 3 // 2, self.table.shape[1])
            self.table[state, symbol] = to << SHIFT | added + ZERO

    def run(self, symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """End state and tokens emitted of each lane: ``lengths`` characters from ``starts`` on, begun in ``states``."""
        order = np.argsort(-lengths, kind="stable")
        at, left, state = starts[order].copy(), lengths[order], states[order].astype(np.int64)
        count = -ZERO * left
        alive = np.searchsorted(-left, -np.arange(1, int(left[0]) + 1), side="right") if len(left) else []
        for m in alive:
            symbol = symbols[at[:m]]
            move = self.table.ravel().take(state[:m] * self.table.shape[1] + symbol)
            if move.min() < 0:
                self._compile(state[:m][move < 0], symbol[move < 0])
                move = self.table.ravel().take(state[:m] * self.table.shape[1] + symbol)
            count[:m] += move & (2 * ZERO - 1)
            state[:m] = move >> SHIFT
            at[:m] += 1
        end, out = np.empty_like(state), np.empty_like(count)
        end[order], out[order] = state, count
        return end, out


def _chunks(first: int, stop: int, breaks: np.ndarray, size: int) -> list[tuple[int, bool]]:
    """(start, whether its start state is 0) of a text's chunks: cut at breaks, or after twice the size without one."""
    out, at = [(first, True)], first
    while stop - at > 2 * size:
        k = int(np.searchsorted(breaks, at + size))
        known = k < len(breaks) and breaks[k] <= at + 2 * size
        at = int(breaks[k]) if known else at + 2 * size
        if at >= stop:
            break
        out.append((at, known))
    return out


def count_tokens(fst: Transducer, texts: list[str], size: int = CHUNK) -> list[int]:
    """Tokens of each text, without added ones."""
    if fst.table.nbytes > TABLE_BYTES:
        fst.reset()
    joined = "".join([SPACE + t if t else "" for t in texts])
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    symbols = fst.symbols(points)
    space = (points == 32) | (points == ord(SPACE))
    breaks = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    starts, known, owner, at = [], [], [], 0
    for i, t in enumerate(texts):
        stop = at + (len(t) + 1 if t else 0)
        for a, k in _chunks(at, stop, breaks, size) if t else []:
            starts.append(a)
            known.append(k)
            owner.append(i)
        at = stop
    totals = np.zeros(len(texts), np.int64)
    if not starts:
        return totals.tolist()
    begin, owner = np.array(starts), np.array(owner)
    length = np.append(begin[1:], at) - begin
    follows = np.append(owner[1:] == owner[:-1], False)  # the next chunk is of the same text
    # state maps, as nodes (chunk, start state) -> end state, tokens
    chunk, state = np.arange(len(begin)), np.zeros(len(begin), np.int64)
    node = {(c, 0): c for c in np.flatnonzero(~np.array(known)).tolist()}
    nodes_chunk, nodes_end, nodes_count = [], [], []
    while len(chunk):
        end, count = fst.run(symbols, begin[chunk], length[chunk], state)
        nodes_chunk.append(chunk)
        nodes_end.append(end)
        nodes_count.append(count)
        n = sum(map(len, nodes_chunk))
        new = {}
        for c, e in zip((chunk + 1).tolist(), end.tolist(), strict=True):
            if c < len(begin) and not known[c] and (c, e) not in node:
                node[c, e] = n + len(new)
                new[c, e] = None
        chunk = np.array([c for c, _ in new], np.int64)
        state = np.array([e for _, e in new], np.int64)
    chunk, end, count = map(np.concatenate, (nodes_chunk, nodes_end, nodes_count))
    after = np.where(follows[chunk], chunk + 1, -1)
    for i in np.flatnonzero(follows[chunk]).tolist():
        c = int(chunk[i]) + 1
        if not known[c]:
            after[i] = node[c, int(end[i])]
    # prefix scan: every node composes with the node that its map leads to, at doubling distance
    after = np.append(np.where(after < 0, len(chunk), after), len(chunk))
    total = np.append(count, 0)
    while (after[:-1] != len(chunk)).any():
        total = total + np.where(np.arange(len(after)) == len(chunk), 0, total[after])
        after = after[after]
    first = np.append(True, owner[1:] != owner[:-1])
    totals[owner[first]] = total[: len(begin)][first]
    return totals.tolist()


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), one row per input row.

    Tokens are those of the sentencepiece BPE model at ``model_path`` for the
    whole text, without begin, end or other added tokens; control strings in a
    text are ordinary text.  A null or empty text has no bytes and no tokens.
    """
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        fst = Transducer(model_path)
        for (ids,), texts in text_slices(batches, 4 << 20):
            n = np.array(count_tokens(fst, [t.decode() for t in texts]), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.array(n), pa.array(n > limit)],
                                             names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
