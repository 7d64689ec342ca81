"""Exact SentencePiece encoding and decoding (operator 12).

Encoding by a prefix table of merges: for every prefix of a piece of text the
last token of its encoding is unique, and an encoding is right when each pair
of neighbours is.  So one run of an automaton over the piece finds, at each
place, the tokens that end there; the one whose left neighbour (the last token
of the prefix before it) is compatible is stored.  The ids are then recovered
backwards from the end.  Two tokens are compatible if merging their characters
in the model's order never joins across their border; that is found by undoing
their merges, the latest first, and remembered.  A text is cut at spaces that no
token crosses, and a piece met before is taken from the worker's memo.

Characters that no token holds are given as their bytes.  Decoding looks up
each id's bytes, drops the space that encoding put in front, and writes U+FFFD
for every byte that is no part of a character.

Defined results: null and empty texts are the begin and the end id, and decode
to the empty text; repeated rows get equal results; an empty table gives no
row; extra columns are ignored.  Texts are processed whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchstats.llm.common import ship_code
from matchstats.llm.tokens import Memo, text_slices

MARK = "▁"
#: Pairs of tokens whose compatibility a worker remembers.
PAIR_ENTRIES = 2_000_000
#: No token: the character before this place is given as bytes.
OTHER = -1


class PrefixTable:
    """Encoder of one merge-type model with byte fallback.

    ``pieces``: (text, score, id) of the tokens that text may become; a merge of
    two neighbours has the score of the token they form, the highest goes
    first, of equal ones the leftmost."""

    def __init__(self, pieces: list[tuple[str, float, int]], byte_ids: list[int]):
        import ahocorasick

        self.byte_ids = byte_ids
        self.score = {t: s for t, s, _ in pieces}
        self.id_of = {t: i for t, _, i in pieces}
        self.text = {i: t for t, _, i in pieces}
        if any(c not in self.id_of for t in self.id_of for c in t):
            raise ValueError("a token holds a character that is no token itself")
        #: token -> (left id, right id) of its last merge; tokens that no text becomes have none
        self.split: dict[int, tuple[int, int]] = {}
        #: (left id, right id) -> score of what they form
        self.joined: dict[tuple[int, int], float] = {}
        #: tokens that are formed after a merge of a lower score
        self.irregular: set[int] = set()
        found = ahocorasick.Automaton()
        for t, s, i in sorted(pieces, key=lambda x: len(x[0])):
            if len(t) > 1:
                parts = self.merged(t, last=True)
                if parts is None:
                    continue
                left, right = (self.id_of[x] for x in parts)
                self.split[i] = left, right
                self.joined[left, right] = s
                below = [x for x in (left, right) if x in self.split]
                if any(self.score[self.text[x]] < s or x in self.irregular for x in below):
                    self.irregular.add(i)
            found.add_word(t, (i, len(t)))
        found.make_automaton()
        self.found = found
        self.pairs: dict[tuple[int, int], bool] = {}

    def merged(self, text: str, last: bool = False):
        """Tokens of ``text`` by merging one pair after another; with ``last``,
        the two that are merged at the end into one, or None."""
        parts, before = list(text), None
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = self.score.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if best is None:
                break
            before = parts[at: at + 2]
            parts[at: at + 2] = ["".join(before)]
        if last:
            return before if len(parts) == 1 else None
        return parts

    def compatible(self, left: int, right: int) -> bool:
        """Do the two tokens stay apart?"""
        if left in self.irregular or right in self.irregular:
            a, b = self.text[left], self.text[right]
            return self.merged(a + b) == [a, b]
        score, split, text = self.score, self.split, self.text
        # a merge across the border counts if it goes before those undone so far
        limit, first = -np.inf, False
        while True:
            across = self.joined.get((left, right))
            if across is not None and (across > limit or (first and across == limit)):
                return False
            of_left = score[text[left]] if left in split else np.inf
            of_right = score[text[right]] if right in split else np.inf
            if of_left == of_right == np.inf:
                return True
            # the lower score was merged later; of equal ones the right one
            if of_left < of_right:
                limit, first = of_left, False
                left = split[left][1]
            else:
                limit, first = of_right, True
                right = split[right][0]

    def encode(self, text: str) -> list[int]:
        """Ids of ``text``, whose spaces are marks already."""
        n = len(text)
        last, size = [OTHER] * n, [1] * n
        pairs, compatible = self.pairs, self.compatible
        if len(pairs) > PAIR_ENTRIES:
            pairs.clear()
        done = -1
        for end, (i, length) in self.found.iter(text):
            if end == done:
                continue
            start = end - length
            if start >= 0 and (before := last[start]) != OTHER:
                fits = pairs.get((before, i))
                if fits is None:
                    fits = pairs[before, i] = compatible(before, i)
                if not fits:
                    continue
            last[end], size[end], done = i, length, end
        out, at = [], n - 1
        while at >= 0:
            if last[at] == OTHER:
                out.extend(self.byte_ids[b] for b in reversed(text[at].encode()))
            else:
                out.append(last[at])
            at -= size[at]
        out.reverse()
        return out


def model_pieces(path: str) -> dict:
    """Tokens of the model's file: (text, score, id) of the plain ones, ids of
    the 256 bytes, the begin and end ids, and the bytes that each id decodes to
    (None for a byte).  Refuses models of another kind."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    plain, byte_ids, decoded = [], [0] * 256, []
    for i in range(sp.get_piece_size()):
        t = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte_ids[int(t[3:5], 16)] = i
            decoded.append(None)
        elif sp.is_control(i):
            decoded.append(b"")
        elif sp.is_unknown(i):
            decoded.append(" ⁇ ".encode())
        elif sp.is_unused(i):
            raise ValueError(f"{path}: unused pieces are not handled")
        else:
            if MARK in t.lstrip(MARK):
                raise ValueError(f"{path}: pieces cross word marks, so texts can't be encoded piece by piece")
            plain.append((t, sp.get_score(i), i))
            decoded.append(t.replace(MARK, " ").encode())
    probe = "  ½ Å  x "
    if sp.decode(sp.encode(probe)) != probe:
        raise ValueError(f"{path}: only models that leave texts as they are, with a space put in front")
    return {"plain": plain, "bytes": byte_ids, "decoded": decoded, "begin": sp.bos_id(), "end": sp.eos_id()}


class CodecMemo(Memo):
    """Ids per piece from the prefix table; see ``tokens.Memo``."""

    def __init__(self, path: str):
        self.model = model_pieces(path)
        table = PrefixTable(self.model["plain"], self.model["bytes"])

        def encode(first: list[str], rest: list[str]) -> list[list[int]]:
            return [table.encode(MARK + x.replace(" ", MARK)) if x else [] for x in first + rest]

        self.encode, self.table = encode, table
        self.clear()
        plain = [b"\0" if x is None else x for x in self.model["decoded"]]
        self.piece_bytes = np.frombuffer(b"".join(plain), np.uint8).copy()
        self.piece_length = np.array([len(x) for x in plain], np.int64)
        self.piece_start = np.cumsum(self.piece_length) - self.piece_length
        self.is_byte = np.zeros(len(plain), dtype=bool)
        self.is_byte[self.model["bytes"]] = True
        self.piece_bytes[self.piece_start[self.model["bytes"]]] = np.arange(256)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """UTF-8 of the text of each run of ids."""
        if len(ids) and (int(ids.min()) < 0 or int(ids.max()) >= len(self.piece_length)):
            raise ValueError("an id outside the model")
        length = self.piece_length[ids]
        ends = np.concatenate([[0], np.cumsum(length)])
        at = np.arange(ends[-1]) + np.repeat(self.piece_start[ids] - ends[:-1], length)
        data = self.piece_bytes[at].tobytes()
        cut, odd = ends[offsets].tolist(), np.concatenate([[0], np.cumsum(self.is_byte[ids])])[offsets].tolist()
        out = []
        for k, (a, b) in enumerate(zip(cut[:-1], cut[1:])):
            text = data[a:b]
            if odd[k + 1] > odd[k]:
                part = ids[offsets[k]: offsets[k + 1]]
                text = self._repaired(text, part)
                first = part[length[offsets[k]: offsets[k + 1]] > 0][0]
                spaced = not self.is_byte[first] and text[:1] == b" " and self.model["decoded"][first][:1] == b" "
            else:
                spaced = text[:1] == b" "
            if spaced and not text.startswith(" ⁇ ".encode()):
                text = text[1:]
            out.append(text)
        return out

    def _repaired(self, text: bytes, ids: np.ndarray) -> bytes:
        """Bytes that are no part of a character become U+FFFD; only runs of
        byte ids can hold such."""
        try:
            text.decode()
            return text
        except UnicodeDecodeError:
            pass
        out, at, n = [], 0, len(ids)
        while at < n:
            stop = at
            while stop < n and self.is_byte[ids[stop]]:
                stop += 1
            if stop == at:
                out.append(self.model["decoded"][ids[at]])
                at += 1
                continue
            run = bytes(int(self.piece_bytes[self.piece_start[i]]) for i in ids[at:stop])
            while run:
                for size in (1, 2, 3, 4):
                    try:
                        run[:size].decode()
                        out.append(run[:size])
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    size = 1
                    out.append("�".encode())
                run = run[size:]
            at = stop
        return b"".join(out)


@lru_cache(maxsize=1)
def codec(path: str) -> CodecMemo:
    """The worker process's codec."""
    return CodecMemo(path)


def _with_ends(c: CodecMemo, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the texts, each between the begin and the end id."""
    ids, offsets = c.ids(texts)
    n = len(offsets) - 1
    out = np.empty(len(ids) + 2 * n, np.uint32)
    starts = offsets + 2 * np.arange(n + 1)
    inner = np.ones(len(out), dtype=bool)
    inner[starts[:-1]] = inner[starts[1:] - 1] = False
    out[inner] = ids
    out[starts[:-1]], out[starts[1:] - 1] = c.model["begin"], c.model["end"]
    return out, starts


def encode_texts(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id and ids (with begin and end id) of every row."""
    ship_code(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model_path)
        for batch in batches:
            for at, part in text_slices(batch.column("text")):
                ids, offsets = _with_ends(c, part)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, len(part)),
                     pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids.astype(np.int32)))],
                    ["doc_id", "ids"])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode_ids(encoded: DataFrame, model_path: str) -> DataFrame:
    """doc_id and text of every row of (doc_id, ids); null ids are none."""
    ship_code(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model_path)
        for batch in batches:
            lists = batch.column("ids")
            offsets = lists.offsets.to_numpy().astype(np.int64)
            texts = c.decode(lists.values.to_numpy(zero_copy_only=False)[offsets[0]: offsets[-1]], offsets - offsets[0])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.binary()).cast(pa.string())], ["doc_id", "text"])

    ids = F.coalesce(F.filter("ids", lambda i: i.isNotNull()), F.array().cast("array<int>"))
    return encoded.select("doc_id", ids.alias("ids")).mapInArrow(run, "doc_id long, text string")


def codec_digests(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row: the digests
    of what ``encode_texts`` and ``decode_ids`` give, without keeping it."""
    ship_code(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model_path)
        for batch in batches:
            for at, part in text_slices(batch.column("text")):
                ids, offsets = _with_ends(c, part)
                data, cut = ids.astype("<u4").tobytes(), (4 * offsets).tolist()
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, len(part)), pa.array(np.diff(offsets), pa.int64()),
                     pa.array([hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(cut[:-1], cut[1:])]),
                     pa.array([hashlib.sha256(x).hexdigest() for x in c.decode(ids, offsets)])],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
