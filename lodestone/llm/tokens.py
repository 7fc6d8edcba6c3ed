"""Token ids of whole texts by a public tokenizer, each distinct word encoded once per task.

The pre-tokenizer of the byte-level vocabularies never joins text across a single space, which
begins the next piece, or across a single line feed, which is a piece of its own, where both
neighbours are no white space.  So such a text can be cut there and its parts looked up.  Parts
not seen before are encoded together.  Letters alone are one piece, so no pattern is matched:
runs of them go to the model as one string, parted by a byte that no UTF-8 text holds and no
merge joins.  Marks after letters are a part of their own.  Other parts are encoded as lines of
one text, whose ids are cut again at the line feed's.  Texts with other white space, a zero byte
or a special token's string are encoded whole, and so is everything for tokenizers of another kind.

Ids of many parts are ranges ``(data, starts, sizes)``: part i has ``sizes[i]`` ids in ``data``
from ``starts[i]``.
"""

from __future__ import annotations

import codecs
import json
import string
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White space other than the space and the line feed.
_OTHER_SPACE = [chr(c) for c in (9, 11, 12, 13, *range(28, 32), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                                 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
#: Bytes that no UTF-8 text holds.
_NEVER = (*range(0xF5, 0x100), 0xC0, 0xC1)
_RUN = 64  # parts that the model gets as one string
_BLOCK = 1 << 20  # parts whose ids are gathered at a time


def _byte_letters() -> str:
    """The character that byte-level vocabularies write for each byte."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return "".join(chr(b if b in shown else next(hidden)) for b in range(256))


def _separator(model: dict, letters: str) -> str | None:
    """A byte's character that no text has and no merge joins to its neighbours; None for models
    whose ids of such a string need not be those of its parts."""
    if model.get("type") != "BPE" or any(model.get(k) for k in (
            "dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
        return None
    merged = set().union(*(m if isinstance(m, str) else "".join(m) for m in model["merges"]))
    return next((c for b in _NEVER if (c := letters[b]) in model["vocab"] and c not in merged), None)


def _plain(text: str) -> bool:
    """Only single spaces and line feeds between words, none at the ends."""
    if "\0" in text or "  " in text or "\n\n" in text or " \n" in text or "\n " in text or text[0] in " \n" or text[-1] in " \n":
        return False
    for c in _OTHER_SPACE:
        if c in text:
            return False
    return True


def _bytes(ids: list[int]) -> bytes:
    return np.array(ids, dtype="<u4").tobytes()


def _between(ids: np.ndarray, mark: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of what lies between the marks."""
    at = np.flatnonzero(ids == mark)
    starts = np.append(0, at + 1)
    return starts, np.append(at, len(ids)) - starts


def _gather(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The ids of all ranges in a row."""
    rows = [data[:0]]
    for i in range(0, len(starts), _BLOCK):
        n = sizes[i:i + _BLOCK]
        where = np.repeat(starts[i:i + _BLOCK] - (np.cumsum(n) - n), n)
        where += np.arange(len(where))
        rows.append(data[where])
    return np.concatenate(rows)


def _letters_and_marks(parts: pa.LargeStringArray) -> pa.LargeStringArray:
    """Two for each part: its letters and the ASCII marks after them, or all of it and nothing."""
    head = pc.ascii_rtrim(parts, characters=string.punctuation)
    letters = pc.utf8_is_alpha(pc.ascii_ltrim(head, characters=" ")).to_numpy(zero_copy_only=False)
    _, offsets, text = parts.buffers()
    whole = np.frombuffer(offsets, dtype=np.int64)[parts.offset:parts.offset + len(parts) + 1]
    halves = np.repeat(whole, 2)[:-1]
    halves[1::2] = np.where(letters, whole[:-1] + pc.binary_length(head).to_numpy(), whole[1:])
    return pa.LargeStringArray.from_buffers(2 * len(parts), pa.py_buffer(halves), text)


class TextEncoder:
    """Encode texts with the tokenizer file at ``path`` (tokenizers library, no special tokens
    added).  Remembers at most ``limit`` parts, none longer than ``longest`` bytes."""

    def __init__(self, path: str, limit: int = 800_000, longest: int = 48):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self._model = Tokenizer(self.tokenizer.model)  # alone: one piece a string, in the bytes' characters
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.specials = [t["content"] for t in spec.get("added_tokens") or []]
        pre = spec.get("pre_tokenizer") or {}
        self.line_feed = self.tokenizer.encode("\n", add_special_tokens=False).ids
        letters = _byte_letters()
        separator = _separator(spec["model"], letters)
        self.cuts = (pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
                     and pre.get("use_regex", True) and not spec.get("normalizer") and len(self.line_feed) == 1
                     and separator is not None)
        if self.cuts:
            self._letters = separator + letters[1:]  # a zero byte stands for the separator
            self._separator = spec["model"]["vocab"][separator]
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.limit, self.longest = limit, longest
        self._known = self._first = pa.array(["", "\n"], pa.large_string())
        self._ranges = self._first_ranges = (
            np.array(self.line_feed, dtype="<u4"), np.zeros(2, np.int64), np.array([0, len(self.line_feed)]))

    def _whole(self, text: str) -> bytes:
        return _bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _words(self, words: list[str]) -> np.ndarray:
        """The ids of parts of letters alone, the separator's between them."""
        ids: list[int] = []
        for i in range(0, len(words), _RUN):
            run = codecs.charmap_decode("\0".join(words[i:i + _RUN]).encode(), "strict", self._letters)[0]
            ids += self._model.encode_batch_fast([run], add_special_tokens=False)[0].ids
            ids.append(self._separator)
        return np.array(ids[:-1], dtype="<u4")

    def _lines(self, parts: list[str]) -> np.ndarray:
        """The ids of parts of any kind, the line feed's between them."""
        lines = self.tokenizer.encode_batch_fast(["\n".join(parts)], add_special_tokens=False)[0]
        return np.array(lines.ids, dtype="<u4")

    def _learn(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ranges of the ids of distinct parts."""
        letters = np.array([m.lstrip(" ").isalpha() for m in parts], dtype=bool)
        starts, sizes = np.zeros((2, len(parts)), dtype=np.int64)
        data = [np.empty(0, dtype="<u4")]
        for own, ids_of, mark in ((letters, self._words, self._separator), (~letters, self._lines, self.line_feed[0])):
            if own.any():
                ids = ids_of([parts[i] for i in np.flatnonzero(own)])
                at, sizes[own] = _between(ids, mark)
                starts[own] = at + sum(map(len, data))
                data.append(ids)
        return np.concatenate(data), starts, sizes

    def _look_up(self, parts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ranges of the ids of distinct parts; those not known are learnt and remembered."""
        found = pc.index_in(parts, value_set=self._known)
        new = parts.filter(found.is_null())
        at = found.fill_null(0).to_numpy().astype(np.int64)
        at[found.is_null().to_numpy(zero_copy_only=False)] = len(self._known) + np.arange(len(new))
        learnt = self._learn(new.to_pylist())
        data, starts, sizes = (np.concatenate([a, b]) for a, b in zip(self._ranges, learnt))
        starts[len(self._known):] += len(self._ranges[0])
        short = pc.less_equal(pc.binary_length(new), self.longest)
        kept = np.append(np.ones(len(self._known), dtype=bool), short.to_numpy(zero_copy_only=False))
        if kept.sum() > self.limit:
            self._known, self._ranges = self._first, self._first_ranges
        else:
            self._known = pa.concat_arrays([self._known, new.filter(short)])
            if kept.all():
                self._ranges = data, starts, sizes
            else:
                n = sizes[kept]
                self._ranges = _gather(data, starts[kept], n), np.cumsum(n) - n, n
        return data, starts[at], sizes[at]

    def _ids(self, parts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """The parts' ids in a row, and where each part's end."""
        coded = parts.dictionary_encode()
        halves = _letters_and_marks(coded.dictionary).dictionary_encode()
        data, starts, sizes = self._look_up(halves.dictionary)
        half, at = halves.indices.to_numpy(), coded.indices.to_numpy()
        data = _gather(data, starts[half], sizes[half])
        sizes = sizes[half].reshape(-1, 2).sum(axis=1)
        starts, sizes = (np.cumsum(sizes) - sizes)[at], sizes[at]
        return _gather(data, starts, sizes), np.cumsum(sizes)

    def _encode(self, texts: list[str | None]) -> Iterator[bytes]:
        cut = [bool(text) and self.cuts and _plain(text) and not any(s in text for s in self.specials)
               for text in texts]
        lines = "\n".join([text for text, c in zip(texts, cut) if c])
        if lines:
            marked = pa.array([lines.replace(" ", "\0 ").replace("\n", "\0\n\0")], pa.large_string())
            ids, ends = self._ids(pc.split_pattern(marked, "\0").values)
        part = start = 0
        for text, c in zip(texts, cut):
            if not c:
                yield self._whole(text) if text else b""
                continue
            part += 1 + text.count(" ") + 2 * text.count("\n")
            stop = int(ends[part - 1])
            yield ids[start:stop].tobytes()
            part, start = part + 1, stop + 1  # past the line feed between two texts

    def encode(self, texts: Iterable[str | None], most: int = 8_000_000) -> Iterator[bytes]:
        """Each text's ids, 4 bytes each, little-endian; null and empty texts have none.  About
        ``most`` characters are cut up at a time."""
        held: list[str | None] = []
        size = 0
        for text in texts:
            held.append(text)
            size += len(text or "")
            if size >= most:
                yield from self._encode(held)
                held, size = [], 0
        yield from self._encode(held)

    def ids(self, text: str | None) -> bytes:
        return next(self.encode([text]))


_ENCODERS: dict[str, TextEncoder] = {}


def encoder(path: str) -> TextEncoder:
    """The worker's encoder for a tokenizer file, loaded once."""
    if path not in _ENCODERS:
        _ENCODERS[path] = TextEncoder(path)
    return _ENCODERS[path]


def default_path() -> str:
    """The byte-level vocabulary that the registered queries use."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")
