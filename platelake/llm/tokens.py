"""Token ids of whole texts with a tokenizer of the ``tokenizers`` library.

A tokenizer of this kind drops white space and never joins across it, nor across the boundaries of ``spans.units``, so a text's ids
are those of its units in turn. Every distinct unit is encoded once in a task and its ids are put where it occurs, which
is an order of magnitude less work than encoding running text.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from platelake.llm import spans

#: Units remembered by a task; beyond it it starts anew.
REMEMBERED = 1_000_000
END_ID = 1
#: Units encoded at once, and how a vocabulary marks the last token of a word.
BLOCK, WORD_END = 512, "</w>"
#: Units of ASCII that hold nothing that a tokenizer may take for more than letters, digits or marks.
PLAIN = re.compile("[!-&(-;=-{}~]+")


class UnitEncoder:
    """Encodes texts unit by unit, remembering units between calls."""

    def __init__(self, path: str) -> None:
        # Spark already runs a worker on each core.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        if not self.ends.any():
            self.ends = None
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _encoded(self, texts: list[str], n_plain: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all units in turn, and how many each has. The first ``n_plain`` units certainly are words or marks.

        Those are encoded many at a time with blanks between them: where the vocabulary marks the ends of words, the marks part
        them again. As each has one end at least, a block with as many ends as units has one for each; any other block is
        encoded unit by unit, as are the rest, which may be nothing, several words, or special tokens.
        """
        n_plain = 0 if self.ends is None else n_plain
        blocks = [texts[i : min(i + BLOCK, n_plain)] for i in range(0, n_plain, BLOCK)]
        found = self.tokenizer.encode_batch_fast([" ".join(b) for b in blocks], add_special_tokens=False)
        flat, counts = [], []
        for block, joined in zip(blocks, found):
            ids = np.array(joined.ids, np.uint32)
            ends = np.flatnonzero(self.ends[ids])
            if len(ends) == len(block) and ends[-1] == len(ids) - 1:
                flat.append(ids)
                counts.append(np.diff(ends, prepend=-1))
            else:
                self._singly(block, flat, counts)
        self._singly(texts[n_plain:], flat, counts)
        return np.concatenate(flat), np.concatenate(counts)

    def _singly(self, texts: list[str], flat: list[np.ndarray], counts: list[np.ndarray]) -> None:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        counts.append(np.fromiter(map(len, found), np.int64, len(found)))
        flat.append(np.fromiter((i for ids in found for i in ids), np.uint32, int(counts[-1].sum())))

    def _learn(self, data: np.ndarray, words: spans.Spans, h: np.ndarray) -> None:
        raw = data.tobytes()
        texts = [raw[s : s + n].decode() for s, n in zip(words.start.tolist(), words.length.tolist())]
        plain = np.fromiter((t.isalpha() or bool(PLAIN.fullmatch(t)) for t in texts), bool, len(texts))
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        n_plain = int(plain.sum())
        texts = [texts[i] for i in order.tolist()]
        flat, count = self._encoded(texts, n_plain)
        at = np.cumsum(count) - count + len(self.ids)
        keys = np.concatenate([self.keys, h[order]])
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.at = np.concatenate([self.at, at])[order]
        self.count = np.concatenate([self.count, count])[order]
        self.ids = np.concatenate([self.ids, flat])

    def _place(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.keys):
            return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
        at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        return at, self.keys[at] == h

    def encode(self, texts: spans.Texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the offsets of the texts among them."""
        if b"<|" not in texts.data.tobytes():  # written-out special tokens keep their case
            texts.data = spans.LOWER[texts.data]
        found = spans.units(texts)
        own, first, inverse = np.unique(spans.hashes(texts.data, found), return_index=True, return_inverse=True)
        if len(self.keys) > REMEMBERED:
            self._forget()
        at, known = self._place(own)
        if not known.all():
            new = first[~known]
            self._learn(texts.data, spans.Spans(found.start[new], found.length[new], found.first), own[~known])
            at, _ = self._place(own)
        count, begin = self.count[at][inverse], self.at[at][inverse]
        ends = np.cumsum(count)
        total = int(ends[-1]) if len(ends) else 0
        where = np.arange(total) + np.repeat(begin - (ends - count), count)
        offsets = np.concatenate([[0], ends])[found.first]
        return self.ids[where], offsets

    def encode_column(self, column: pa.Array, end_id: int | None = END_ID) -> tuple[np.ndarray, np.ndarray]:
        """``encode`` of an Arrow column, NULL as empty, with ``end_id`` after each text."""
        ids, offsets = self.encode(spans.texts_of(column))
        if end_id is None:
            return ids, offsets
        ids = np.insert(ids, offsets[1:], np.uint32(end_id))
        return ids, offsets + np.arange(len(offsets))


def encoded(batches: Iterator[pa.RecordBatch], column: str, path: str, end_id: int | None = END_ID) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with the ids of their texts and the offsets of each."""
    encoder = None
    for part in spans.chunked(batches, column):
        encoder = encoder or UnitEncoder(path)
        ids, offsets = encoder.encode_column(part.column(column), end_id)
        yield part, ids, offsets
