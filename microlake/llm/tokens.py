"""Whole-text encoding with the tokenizers library, one library call per distinct piece.

A text is cut only where the tokenizer itself always ends a pre-token, so the ids of the
pieces joined are the ids of the whole text:

* ``lower_words`` tokenizers drop white space and no pre-token holds any; the text is cut
  at blanks and line feeds.
* ``byte_level`` tokenizers attach one blank to the word behind it; the text is cut before
  a blank that a printing character follows, and around a line feed that stands alone.
  Other white space (runs, tabs, wide blanks) stays inside a piece.

Texts are encoded in blocks. Arrow cuts the texts of a block and numbers its distinct pieces,
so what Python does once per piece it does for distinct ones only; a take by number gives all
ids. Distinct pieces of plain Latin letters, digits and signs are cut together into their
pre-tokens, and the library's model encodes each pre-token that is not known yet; any other
piece goes through the library whole. The cache of pre-tokens keeps two generations: a full
young one becomes the old one, and what is found there is young again, so frequent entries
stay and rare ones go. Memory stays bounded by a block and twice ``max_pre_tokens`` entries,
and results never change. ``worker_encoder`` keeps one encoder per Python worker process:
later tasks of the process neither load the vocabulary again nor start with a cold cache.

Strings of special tokens in a text are ordinary text (``encode_special_tokens``), as the
description installed with the public vocabulary files gives the call.
"""
from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import per_worker

#: White space in a row, or any white space or control character but a blank and a line feed.
_IRREGULAR = r"[ \n]{2}|[\x00-\x09\x0b-\x1f\x7f-\x{a0}\x{1680}\x{180e}\x{2000}-\x{206f}\x{3000}\x{feff}]"
_BEFORE_WORD = re.compile(r"(?= [!-~])")
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = rf"^(?:\n| ?[!-~{_LETTERS}]+)$"
#: The tokenizers' own pre-token patterns over plain pieces, with a zero byte between pieces.
_PRE_TOKENS = {
    "lower_words": re.compile(rf"\x00|'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\s\x00{_LETTERS}0-9]+"),
    "byte_level": re.compile(rf"\x00|\n|'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^\s\x00{_LETTERS}0-9]+"),
}
#: No id: vocabularies stay far below, so these bytes occur in no row of ids.
_NO_ID = 0xFFFFFFFF
_BETWEEN = b"\xff\xff\xff\xff"
BLOCK_BYTES = 2 << 20
MAX_PRE_TOKENS = 200_000        # of one generation
MAX_PIECE_CHARS = 64


class PieceEncoder:
    """Texts -> unsigned 32-bit ids. ``kind``: lower_words or byte_level."""

    def __init__(self, path: str, kind: str, block_bytes: int = BLOCK_BYTES, max_pre_tokens: int = MAX_PRE_TOKENS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        if kind not in _PRE_TOKENS:
            raise ValueError(f"unknown tokenizer kind {kind!r}")
        tok = Tokenizer.from_file(path)
        tok.encode_special_tokens = True        # their strings in a text are ordinary text
        self._tok, self.kind, self.block_bytes, self.max_pre_tokens = tok, kind, block_bytes, max_pre_tokens
        self._model, self._pre_tokens, self._lower = tok.model, _PRE_TOKENS[kind], kind == "lower_words"
        in_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        plain = [chr(c) for c in [10, *range(32, 127), *range(0xC0, 0x100)]]
        self._alphabet = str.maketrans({c: in_bytes.pre_tokenize_str(c)[0][0] for c in plain})
        # plain dicts: a set looks its members up in one, but walks through a subclass
        self._known: dict[str, bytes] = {"\x00": _BETWEEN}
        self._old_known: dict[str, bytes] = {}

    def _model_ids(self, pre: str) -> bytes:
        return array("I", [t.id for t in self._model.tokenize(pre.translate(self._alphabet))]).tobytes()

    def _pieces(self, texts: pa.Array) -> pa.Array:
        """The pieces of each text, as a list column."""
        if self._lower:
            return pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        odd = pc.match_substring_regex(texts, _IRREGULAR)
        if pc.any(odd).as_py():
            lists = [_BEFORE_WORD.split(t) if o else t.replace(" ", "\x00 ").replace("\n", "\x00\n\x00").split("\x00")
                     for t, o in zip(texts.to_pylist(), odd.to_pylist())]
            return pa.array(lists, pa.list_(pa.string()))
        return pc.split_pattern(pc.replace_substring(pc.replace_substring(texts, " ", "\x00 "), "\n", "\x00\n\x00"), "\x00")

    def _of_distinct(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pool, start, length): piece k has the ids ``pool[start[k]:start[k] + length[k]]``."""
        plain = pc.and_(pc.match_substring_regex(pieces, _PLAIN), pc.less_equal(pc.utf8_length(pieces), MAX_PIECE_CHARS))
        some = pieces.filter(plain).to_pylist()
        length = np.zeros(len(pieces), np.int64)
        parts = []
        where = np.asarray(plain)
        if some:
            joined = "\x00".join(some)
            pres = self._pre_tokens.findall(joined.lower() if self._lower else joined)
            if len(self._known) > self.max_pre_tokens:
                self._old_known, self._known = self._known, {"\x00": _BETWEEN}
            for pre in set(pres).difference(self._known):
                self._known[pre] = self._old_known.get(pre) or self._model_ids(pre)
            pool = np.frombuffer(b"".join(map(self._known.__getitem__, pres)), "<u4")
            cuts = np.flatnonzero(pool == _NO_ID)
            length[where] = np.diff(np.concatenate([[-1], cuts, [len(pool)]])) - 1
            parts.append(np.delete(pool, cuts))
        other = pieces.filter(pc.invert(plain)).to_pylist()
        odd = [np.array(self._tok.encode(p, add_special_tokens=False).ids, "<u4") for p in other]
        length[~where] = [len(o) for o in odd]
        start = np.zeros(len(pieces), np.int64)         # plain ones first in the pool
        order = np.concatenate([np.flatnonzero(where), np.flatnonzero(~where)])
        start[order] = np.cumsum(length[order]) - length[order]
        return np.concatenate([*parts, *odd, np.zeros(0, "<u4")]), start, length

    def _block(self, texts: pa.Array, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
        lists = self._pieces(texts)
        words = lists.flatten().dictionary_encode()
        pool, start, length = self._of_distinct(words.dictionary)
        number = np.asarray(words.indices)
        sizes = length[number]
        total = np.cumsum(np.concatenate([[0], sizes]))
        ids = pool[np.repeat(start[number] - total[:-1], sizes) + np.arange(total[-1])]
        ends = total[np.cumsum(np.asarray(pc.list_value_length(lists)))]
        if end_id is None:
            return ids, ends
        ends = ends + np.arange(1, len(ends) + 1)
        out = np.empty(len(ids) + len(ends), "<u4")
        inside = np.ones(len(out), bool)
        inside[ends - 1] = False
        out[ends - 1], out[inside] = end_id, ids
        return out, ends

    def blocks(self, texts: pa.Array, end_id: int | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first, ids, ends) of blocks of whole texts: text ``first + k`` of the column has the ids
        ``ids[ends[k - 1]:ends[k]]``, with ``end_id`` behind them if given. Null reads as empty."""
        texts = pc.fill_null(texts, "")
        size = np.cumsum(np.asarray(pc.binary_length(texts)).astype(np.int64))
        begin = 0
        while begin < len(texts):
            before = size[begin - 1] if begin else 0
            stop = max(begin + 1, int(np.searchsorted(size, before + self.block_bytes, side="right")))
            yield begin, *self._block(texts.slice(begin, stop - begin), end_id)
            begin = stop

    def ids(self, text: str | None) -> bytes:
        """Ids of one whole text as little-endian bytes; null reads as empty."""
        return next(self.blocks(pa.array([text], pa.string())))[1].tobytes()


def worker_encoder(path: str, kind: str, block_bytes: int = BLOCK_BYTES) -> PieceEncoder:
    """The encoder of this Python process for a vocabulary file, made by its first task."""
    return per_worker("piece-encoder", (path, kind, block_bytes, os.path.getmtime(path), os.path.getsize(path)),
                      lambda: PieceEncoder(path, kind, block_bytes))


def token_path(name: str) -> str:
    """Place of a public tokenizer file on this machine (installed on every executor)."""
    import public_tokenizers

    return public_tokenizers.path(name)
