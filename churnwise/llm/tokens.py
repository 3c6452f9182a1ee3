"""Token counts of a unigram tokenizer by count-only Viterbi.

A text is read as a unigram tokenizer with a space mark reads it: every space becomes the mark, a text that does
not begin with a space gets one in front, and no piece spans a mark but at its start. An Aho-Corasick automaton
over the vocabulary's bytes enumerates the pieces that end at each byte; dynamic programming carries the best
score and the number of pieces, never the pieces themselves.

Tie rules, as the tokenizer has them: of equal scores the piece that begins first (the longest) wins. A character
that is no piece of its own may be unknown, at the least score of the vocabulary less 10, and loses ties. An
unknown character counts one token for each of its bytes where the vocabulary has all byte pieces; else a run of
unknown characters is one token.

Words repeat, so each distinct word of a block of text is counted once. All distinct words step through the
automaton together, a byte at a time. The vocabulary is a parameter (a file outside this repository); what is
broadcast is the vocabulary alone, and each worker builds its automaton once.

Defined results: null and empty texts have 0 tokens; repeated rows get equal counts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnwise.llm.common import CODES, chunks, mixed, powers, text_bytes

MARK = "▁"
#: The vocabulary file of the registered query.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: Words longer than this are counted one by one.
LONG = 256
_SHARED: dict[str, Automaton] = {}


class Automaton:
    """Aho-Corasick over the bytes of the pieces, as a table of next states."""

    def __init__(self, pieces: list[tuple[str, float]], byte_pieces: bool):
        self.byte_pieces = byte_pieces
        self.unknown = min((s for _, s in pieces), default=0.0) - 10.0
        children: list[dict[int, int]] = [{}]
        length, score = [0], [0.0]
        for piece, value in pieces:
            at = 0
            data = piece.encode()
            for c in data:
                if c not in children[at]:
                    children[at][c] = len(children)
                    children.append({})
                    length.append(0)
                    score.append(0.0)
                at = children[at][c]
            if data:
                length[at], score[at] = len(data), value
        n = len(children)
        self.length, self.score = np.array(length, np.int32), np.array(score)
        self.next = np.zeros((n, 256), np.int32)
        #: The longest proper suffix that is a piece.
        self.shorter = np.zeros(n, np.int32)
        fail = np.zeros(n, np.int32)
        level = [0]
        while level:  # states of one depth at a time; the states they fail to are shallower and complete
            parent = np.array([p for p in level for _ in children[p]], np.int32)
            byte = np.array([c for p in level for c in children[p]], np.int32)
            child = np.array([s for p in level for s in children[p].values()], np.int32)
            if len(child):
                fail[child] = np.where(parent == 0, 0, self.next[fail[parent], byte])
                self.next[parent, byte] = child
                self.next[child] = self.next[fail[child]]
                self.shorter[child] = np.where(self.length[fail[child]] > 0, fail[child], self.shorter[fail[child]])
            level = child.tolist()

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Tokens of each word; a word begins with its mark."""
        out = np.zeros(len(words), np.int64)
        size = np.array([len(w) for w in words])
        order = np.argsort(size, kind="stable")
        order = order[size[order] > 0]
        while len(order) and size[order[0]] <= LONG:
            # words of like length in one matrix
            take = order[: np.searchsorted(size[order], min(LONG, size[order[0]] * 5 // 4 + 1), "right")][:8192]
            out[take] = self._together([words[i] for i in take])
            order = order[len(take) :]
        for i in order:
            out[i] = self._alone(words[i])
        return out

    def _together(self, words: list[bytes]) -> np.ndarray:
        n, size = len(words), np.array([len(w) for w in words])
        longest = int(size.max())
        text = np.frombuffer(b"".join(w.ljust(longest, b"\0") for w in words), np.uint8).reshape(n, longest)
        best, count = np.full((n, longest + 1), -np.inf), np.zeros((n, longest + 1), np.int64)
        unknown = np.zeros((n, longest + 1), bool)
        best[:, 0] = 0
        state = np.zeros(n, np.int32)
        begun = np.zeros(n, np.int64)  # where the character at hand begins
        for j in range(longest):
            byte = text[:, j]
            begun[(byte & 0xC0) != 0x80] = j
            state = self.next[state, byte]
            ends = size > j + 1
            last = ~ends & (size == j + 1)
            if j + 1 < longest:
                ends &= (text[:, j + 1] & 0xC0) != 0x80  # a character ends here
            at = np.flatnonzero(ends | last)
            if not len(at):
                continue
            single = np.zeros(len(at), bool)
            top, tokens = np.full(len(at), -np.inf), np.zeros(len(at), np.int64)
            who = np.where(self.length[state[at]] > 0, state[at], self.shorter[state[at]])
            live = np.flatnonzero(who)
            while len(live):
                s = who[live]
                start = j + 1 - self.length[s]
                value = best[at[live], start] + self.score[s]
                better = value > top[live]
                k = live[better]
                top[k], tokens[k] = value[better], count[at[k], start[better]] + 1
                single[live[start == begun[at[live]]]] = True
                who[live] = self.shorter[s]
                live = live[who[live] > 0]
            value = best[at, begun[at]] + self.unknown
            k = np.flatnonzero(~single & (value > top))
            top[k] = value[k]
            tokens[k] = count[at[k], begun[at[k]]] + ((j + 1 - begun[at[k]]) if self.byte_pieces else ~unknown[at[k], begun[at[k]]])
            unknown[at[k], j + 1] = True
            best[at, j + 1], count[at, j + 1] = top, tokens
        return count[np.arange(n), size]

    def _alone(self, word: bytes) -> int:
        """The same for one word, a step at a time: for words too long to share a matrix."""
        n = len(word)
        best, count, unknown = [-math.inf] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        best[0], state, begun = 0.0, 0, 0
        for j in range(n):
            if word[j] & 0xC0 != 0x80:
                begun = j
            state = int(self.next[state, word[j]])
            if j + 1 < n and word[j + 1] & 0xC0 == 0x80:
                continue
            top, tokens, single, is_unknown = -math.inf, 0, False, False
            s = state if self.length[state] else int(self.shorter[state])
            while s:
                start = j + 1 - int(self.length[s])
                value = best[start] + float(self.score[s])
                if value > top:
                    top, tokens = value, count[start] + 1
                single |= start == begun
                s = int(self.shorter[s])
            if not single and best[begun] + self.unknown > top:
                top, is_unknown = best[begun] + self.unknown, True
                tokens = count[begun] + (j + 1 - begun if self.byte_pieces else not unknown[begun])
            best[j + 1], count[j + 1], unknown[j + 1] = top, tokens, is_unknown
        return count[n]


def vocabulary(path: str) -> tuple[list[tuple[str, float]], bool]:
    """Pieces of a piece model file and whether it has all byte pieces. A file of merges holds ranks instead of
    log-probabilities; a rank r then scores -ln(r + 2), the frequency that Zipf's law gives it."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    plain = [i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    scores = [model.get_score(i) for i in plain]
    if all(s == int(s) for s in scores):
        scores = [-math.log(2 - s) for s in scores]
    return [(model.id_to_piece(i), s) for i, s in zip(plain, scores)], sum(map(model.is_byte, ids)) == 256


def _count(path: str, shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    if path not in _SHARED:  # one automaton a worker process
        _SHARED.clear()
        _SHARED[path] = Automaton(*shared.value)
    machine = _SHARED[path]
    for batch in batches:
        column = pc.replace_substring(batch.column("text").fill_null(""), MARK, " ")
        n_bytes = np.diff(text_bytes(batch.column("text"))[1])
        raw, offsets = text_bytes(column)
        out = [count_texts(machine, raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in chunks(offsets)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_bytes), pa.array(np.concatenate(out) if out else [], pa.int64())], ["doc_id", "n_bytes", "n_tokens"])


def count_texts(machine: Automaton, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Tokens of each row of `raw`, in which marks are spaces already."""
    rows = np.flatnonzero(np.diff(offsets))
    out = np.zeros(len(offsets) - 1, np.int64)
    if not len(rows):
        return out
    # a word is what follows a space, or the begin of a row without one, up to the next space
    spaces = np.flatnonzero(raw == 0x20)
    first = offsets[rows][raw[offsets[rows]] != 0x20]
    starts = np.sort(np.concatenate([spaces + 1, first]))
    # a row's last space may be followed by the next row's begin: two words of which the first is empty
    row = np.searchsorted(offsets, np.concatenate([spaces, first]), "right") - 1
    order = np.lexsort((np.concatenate([spaces, first]), np.concatenate([spaces + 1, first])))
    row = row[order]
    ends = np.append(starts[1:], len(raw)) - np.append(raw[np.minimum(starts[1:] - 1, len(raw) - 1)] == 0x20, False)
    ends = np.minimum(ends, offsets[row + 1])
    ends = np.maximum(ends, starts)
    # hash of each word: sum of byte codes by place
    size = ends - starts
    at = np.repeat(starts - (np.cumsum(size) - size), size) + np.arange(size.sum())
    place = at - np.repeat(starts, size)
    values = np.concatenate([[np.uint64(0)], np.cumsum(CODES[raw[at]] * powers(int(size.max()) + 1)[place])])
    to = np.cumsum(size)
    hashes = mixed(values[to] - values[to - size])
    _, pick, number = np.unique(hashes, return_index=True, return_inverse=True)
    mark = MARK.encode()
    tokens = machine.counts([mark + raw[starts[i] : ends[i]].tobytes() for i in pick])[number]
    np.add.at(out, row, tokens)
    return out


def count(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of each row of docs. The driver reads the vocabulary at `path`."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary(path))
    narrow = docs.select("doc_id", F.col("text").cast("string").alias("text"))

    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(lambda b: _count(path, shared, b), f"doc_id {kind}, n_bytes long, n_tokens long")

