"""Exact token ids of whole texts from public vocabularies, remembered per
space-separated piece.

For both vocabulary kinds used here no token crosses a single space between
two visible characters: the byte-level pattern starts a new pre-token at such
a space, and no piece of the sentence-piece vocabulary holds its space mark
after another character.  So a text's ids are its pieces' ids in order, and a
piece is encoded by the library once.  Texts with other spacing (leading,
trailing or doubled spaces, spaces beside unusual characters) are cut only at
the safe spaces, by the slower path.
"""

from __future__ import annotations

import re
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from matchstats.llm.wordtable import row_chunks, string_hashes

#: Entries that a worker's memo may hold; beyond it the memo starts afresh.
MEMO_ENTRIES = 800_000
SAFE = "!-~À-ɏ"
_UNSAFE = f" [^{SAFE}]|[^{SAFE}] |^ | $"
_CUT = re.compile(f"(?<=[{SAFE}]) (?=[{SAFE}])")


def _byte_bpe(path: str):
    """Pieces go through the rank file beside the vocabulary, if there is one
    (the same merges, several times as fast); those that hold the string of a
    special token, and all without a rank file, through the vocabulary's own
    library."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    special = [t.content for t in tok.get_added_tokens_decoder().values()]
    ranks = path.removesuffix(".json") + ".tiktoken"
    quick = None
    if os.path.exists(ranks):
        import base64

        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        quick = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table,
                                  special_tokens={}).encode_ordinary

    def encode(first: list[str], rest: list[str]) -> list[list[int]]:
        xs = first + [f" {x}" for x in rest]
        if quick is None:
            return [e.ids for e in tok.encode_batch_fast(xs, add_special_tokens=False)]
        return [tok.encode(x, add_special_tokens=False).ids if any(s in x for s in special) else quick(x) for x in xs]

    return encode


def _sentence_piece(path: str):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    mark = "▁"
    if any(mark in sp.id_to_piece(i).lstrip(mark) for i in range(sp.get_piece_size())):
        raise ValueError(f"{path}: pieces cross word marks, so texts can't be encoded piece by piece")

    def encode(first: list[str], rest: list[str]) -> list[list[int]]:
        return sp.encode(first + rest, num_threads=1)

    return encode


class Memo:
    """Ids per piece, in one flat array, found by the piece's 64-bit hash.  The
    first piece of a text and later ones are told apart (a byte-level piece
    takes the space before it)."""

    def __init__(self, path: str):
        self.encode = _sentence_piece(path) if path.endswith(".model") else _byte_bpe(path)
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)  # sorted
        self.entry = np.zeros(0, np.int64)  # of each key
        self.n = 0
        self.lengths = np.zeros(1 << 12, np.int32)
        self.starts = np.zeros(1 << 12, np.int64)
        self.flat = np.zeros(1 << 14, np.uint32)
        self.used = 0

    def _add(self, keys: np.ndarray, first: list[str], rest: list[str]) -> None:
        got = self.encode(first, rest)
        lengths = np.fromiter(map(len, got), np.int64, len(got))
        need = int(lengths.sum())
        while self.used + need > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(len(self.flat), np.uint32)])
        while self.n + len(got) > len(self.lengths):
            self.lengths = np.concatenate([self.lengths, np.zeros(len(self.lengths), np.int32)])
            self.starts = np.concatenate([self.starts, np.zeros(len(self.starts), np.int64)])
        at = slice(self.n, self.n + len(got))
        self.lengths[at] = lengths
        self.starts[at] = self.used + np.cumsum(lengths) - lengths
        self.flat[self.used: self.used + need] = np.fromiter(chain.from_iterable(got), np.uint32, need)
        self.used += need
        order = np.argsort(keys)
        where = np.searchsorted(self.keys, keys[order])
        self.keys = np.insert(self.keys, where, keys[order])
        self.entry = np.insert(self.entry, where, self.n + order)
        self.n += len(got)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Entry of each key, -1 where there is none."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.entry[at], -1)

    def pieces(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(memo entry of each piece, number of pieces of each text)."""
        texts = texts.fill_null("") if texts.null_count else texts
        lists = pc.split_pattern(texts, " ")
        odd = pc.match_substring_regex(texts, _UNSAFE)
        if pc.any(odd).as_py():
            rows = lists.to_pylist()
            for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)):
                rows[i] = _CUT.split(texts[int(i)].as_py())
            lists = pa.array(rows, pa.list_(pa.string()))
        per_text = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = pc.dictionary_encode(lists.flatten())
        code = coded.indices.to_numpy(zero_copy_only=False)
        vocab = coded.dictionary
        first = np.zeros(len(code), dtype=bool)
        heads = np.cumsum(per_text) - per_text
        first[heads[per_text > 0]] = True
        if self.n > MEMO_ENTRIES:
            self.clear()
        heads = np.unique(code[first])
        tails = np.flatnonzero(np.bincount(code[~first], minlength=len(vocab)))
        hashed = string_hashes(vocab)
        keys = np.concatenate([hashed[heads], hashed[tails] ^ np.uint64(0xA5A5A5A5)])
        found = self._find(keys)
        if (miss := found < 0).any():
            a, b = heads[miss[: len(heads)]], tails[miss[len(heads):]]
            self._add(keys[miss], vocab.take(pa.array(a)).to_pylist(), vocab.take(pa.array(b)).to_pylist())
            found = self._find(keys)
        entry = np.zeros((2, max(1, len(vocab))), np.int64)
        entry[0, heads], entry[1, tails] = found[: len(heads)], found[len(heads):]
        out = entry[1][code]
        out[first] = entry[0][code[first]]
        return out, per_text

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Number of ids of each text."""
        entries, per_text = self.pieces(texts)
        total = np.concatenate([[0], np.cumsum(self.lengths[entries], dtype=np.int64)])
        ends = np.cumsum(per_text)
        return total[ends] - total[ends - per_text]

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, offsets of each text's ids)."""
        entries, per_text = self.pieces(texts)
        lengths = self.lengths[entries].astype(np.int64)
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(self.starts[entries] - (ends - lengths), lengths)
        by_piece = np.concatenate([[0], ends])
        last = np.cumsum(per_text)
        return self.flat[at], np.concatenate([[0], by_piece[last]]).astype(np.int64)


_MEMOS: dict[str, Memo] = {}


def memo(path: str) -> Memo:
    """The worker process's memo; it holds one vocabulary at a time."""
    if path not in _MEMOS:
        _MEMOS.clear()
        _MEMOS[path] = Memo(path)
    return _MEMOS[path]


def text_slices(texts: pa.Array, most: int = 1 << 21):
    """(first row, slice) of runs of rows of about ``most`` bytes."""
    for a, b, _data, _off in row_chunks(texts, most):
        yield a, texts.slice(a, b - a)


def crc32_ids(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())
