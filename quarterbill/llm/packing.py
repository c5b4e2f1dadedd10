"""Packing documents into token windows by the online sum-of-squares rule.

A window has a fill level. A piece goes to the level, or to a new window, for which the sum
of the squared numbers of partially filled windows per level is least afterwards; that keeps
all levels rare, so that whatever comes next finds one that it fills. Each partition packs
its own stream with an array of counts per level. What stays open at its end is closed by
cutting the pieces of the emptiest windows to fill the fullest, and a last rest becomes
windows whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

WINDOW = 4096
END = 2
#: Open windows of a task; beyond, they are closed as at the end.
MOST_OPEN = 1024
#: Texts that no normaliser changes but by lower-casing single characters, and their pieces:
#: contractions, runs of letters, single digits, runs of other signs.
PLAIN = re.compile("[\t-\r -~\xa0-\u012f\u0131-\u017f]*")
LETTER = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\u017f"
DIGIT = "0-9\xb2\xb3\xb9\xbc-\xbe"
PIECE = re.compile(rf"'(?:s|t|re|ve|m|ll|d)|[{LETTER}]+|[{DIGIT}]|[^\s{LETTER}{DIGIT}]+")
#: Stands for the end of a word in bytes; plain texts have no control characters.
MARK = "\x01"


def _word_ranks(spec: dict) -> dict[bytes, int] | None:
    """The vocabulary as bytes and merge ranks, a word's end as MARK; None if it has another form."""
    model = spec["model"]
    if model.get("type") != "BPE" or model.get("end_of_word_suffix") != "</w>":
        return None
    vocabulary, merges = model["vocab"], model["merges"]
    first = len(vocabulary) - len(merges)
    made = ("".join(m if isinstance(m, list) else m.split(" ")) for m in merges)
    if any(vocabulary[m] != first + i for i, m in enumerate(made)):  # a merge's rank must be its id
        return None
    # the byte-level alphabet: printable bytes stand for themselves, the others follow 255
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    ranks = {MARK.encode(): len(vocabulary)}
    for token, rank in vocabulary.items():
        body = token.removesuffix("</w>")
        raw = bytes(byte[c] for c in body)
        if MARK.encode() not in raw:
            ranks[raw + MARK.encode() * (body != token)] = rank
    return ranks


class Tokens:
    """Token ids of texts, as the tokenizer file gives them.

    Plain texts are cut into the tokenizer's pieces here and merged by tiktoken, which reads
    the same vocabulary several times faster; any other text is encoded by tokenizers. If the
    vocabulary has another form, or the two disagree on a trial text, all texts are.
    """

    TRIAL = "It's 2 o'clock -- they'll WON'T over-internationalise caf\xe9s, na\xefve 3.14 \xbd \u0153uvre?! x_y@z \xa0#1"

    def __init__(self, path: str | None = None):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path or public_tokenizers.path("word_bpe_49k.json"))
        self.special = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.fast = None
        ranks = _word_ranks(json.loads(self.tokenizer.to_str()))
        if ranks:
            self.fast = tiktoken.Encoding("words", pat_str=f"[^{MARK}]+{MARK}", mergeable_ranks=ranks, special_tokens={})
            if self._plain(self.TRIAL) != self._any(self.TRIAL):
                self.fast = None

    def _plain(self, text: str) -> list[int]:
        pieces = PIECE.findall(text.lower())
        return self.fast.encode_ordinary(MARK.join(pieces) + MARK) if pieces else []

    def _any(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def ids(self, text: str | None, end: int = END) -> np.ndarray:
        text = text or ""
        plain = self.fast and PLAIN.fullmatch(text) and not any(s in text for s in self.special)
        ids = self._plain(text) if plain else self._any(text)
        out = np.empty(len(ids) + 1, np.uint32)
        out[:-1], out[-1] = ids, end
        return out


class Packer:
    """Windows of one task. A piece is (document, start, document's tokens, ids)."""

    def __init__(self, window: int = WINDOW, most_open: int = MOST_OPEN):
        self.window, self.most_open = window, most_open
        self.level = np.zeros(window + 1, np.int64)  # partially filled windows per level
        self.open: dict[int, list[list]] = {}  # level: windows, each a list of pieces
        self.n_open = 0
        self.done: list[list] = []

    def add(self, doc: object, ids: np.ndarray) -> None:
        """A document: whole windows of its own first, the rest by the rule."""
        n = len(ids)
        whole = n - n % self.window
        for at in range(0, whole, self.window):
            self.done.append([(doc, at, n, ids[at : at + self.window])])
        if n > whole:
            self._place((doc, whole, n, ids[whole:]))

    def _place(self, piece: tuple) -> None:
        size, n = len(piece[3]), self.level
        levels = np.flatnonzero(n[1 : self.window - size + 1]) + 1
        best, cost = 0, 2 * n[size] + 1  # a new window
        if len(levels):
            # squares after less squares before; a filled window counts no more
            after = np.where(levels + size < self.window, 2 * n[levels + size] + 1, 0)
            change = after - 2 * n[levels] + 1
            at = len(levels) - 1 - int(np.argmin(change[::-1]))  # the fullest of equals
            if change[at] <= cost:
                best = int(levels[at])
        pieces = self.open[best].pop() if best else []
        if best:
            n[best] -= 1
            self.n_open -= 1
        pieces.append(piece)
        if best + size == self.window:
            self.done.append(pieces)
        else:
            n[best + size] += 1
            self.n_open += 1
            self.open.setdefault(best + size, []).append(pieces)
            if self.n_open > self.most_open:
                self.close()

    def close(self) -> list | None:
        """Fill the fullest open windows with pieces of the emptiest; what is left stays open."""
        windows = [w for level in sorted(self.open) for w in self.open[level]]
        self.level[:] = 0
        self.open, self.n_open = {}, 0
        low, high = 0, len(windows) - 1
        while low < high:
            room = self.window - sum(len(p[3]) for p in windows[high])
            while room and low < high:
                doc, start, total, ids = windows[low].pop()
                if len(ids) > room:
                    windows[low].append((doc, start, total, ids[:-room]))
                    start, ids = start + len(ids) - room, ids[-room:]
                windows[high].append((doc, start, total, ids))
                room -= len(ids)
                if not windows[low]:
                    low += 1
            if room:  # nothing is left to fill it
                break
            self.done.append(windows[high])
            high -= 1
        if low <= high and windows:
            rest = windows[high]
            level = sum(len(p[3]) for p in rest)
            if level == self.window:
                self.done.append(rest)
                return None
            self.open, self.n_open = {level: [rest]}, 1
            self.level[level] = 1
            return rest
        return None

    def finish(self) -> None:
        """Close all; the last rest becomes windows of power-of-two lengths."""
        rest = self.close()
        if rest is None:
            return
        self.open, self.n_open = {}, 0
        self.level[:] = 0
        left = sum(len(p[3]) for p in rest)
        while left:
            room = length = 1 << left.bit_length() - 1
            window = []
            while room:
                doc, start, total, ids = rest.pop(0)
                if len(ids) > room:
                    rest.insert(0, (doc, start + room, total, ids[room:]))
                    ids = ids[:room]
                window.append((doc, start, total, ids))
                room -= len(ids)
            self.done.append(window)
            left -= length


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_length long"


def pack(docs: DataFrame, vocabulary: str | None = None, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """One row per piece of a document: where it lies in which sequence; `with_ids`, its ids.

    A null or empty text is its end token alone. Rows with equal ids are documents of their
    own. A null doc_id stays null. Sequences are numbered per partition of `docs`, so read
    docs from files (or stage them), for a lost task to find the same rows again. Other
    columns are ignored; an empty table gives an empty one. Memory per task: one document
    and the open windows, at most MOST_OPEN of them.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, packer = Tokens(vocabulary), Packer(window)
        number = TaskContext.get().partitionId() << 33

        def out() -> pa.RecordBatch:
            nonlocal number
            columns: list[list] = [[] for _ in range(8)]
            ids: list[np.ndarray] = []
            for pieces in packer.done:
                offset, length = 0, sum(len(p[3]) for p in pieces)
                for doc, start, total, some in pieces:
                    row = (doc, start, len(some), zlib.crc32(some.astype("<u4").tobytes()), total, number, offset, length)
                    for column, value in zip(columns, row):
                        column.append(value)
                    offset += len(some)
                    ids.append(some)
                number += 1
            packer.done = []
            arrays = [pa.array(c, pa.int64()) for c in columns]
            names = [c.split()[0] for c in PIECES.split(", ")]
            if with_ids:
                ends = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
                flat = np.concatenate([np.empty(0, np.uint32), *ids]).astype(np.int32)
                arrays.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))
                names.append("ids")
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                packer.add(doc, tokens.ids(text.as_py()))
                if len(packer.done) >= 2000:
                    yield out()
        packer.finish()
        if packer.done:
            yield out()

    return docs.select("doc_id", "text").mapInArrow(work, PIECES + (", ids array<int>" if with_ids else ""))
