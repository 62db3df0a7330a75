"""Token ids of a public byte-level BPE vocabulary, with pieces of text that come again encoded once."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from functools import cached_property

import numpy as np

from lapwise.llm.chunks import Lot, Numbers, Rows

#: Chunks between blanks kept by one worker, about 25 bytes each; beyond that it starts anew.
KEPT_CHUNKS = 2_000_000
# Fixed value: how byte-level vocabularies of this kind split a text before merging.
_PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Longer texts are encoded in parts.
LONG_TEXT = 4 << 20
_CUT = re.compile(r"\S(?= \S)")
_encoders: dict[str, "Encoder"] = {}


def encoder(path: str) -> "Encoder":
    """One encoder for each worker process and vocabulary."""
    if path not in _encoders:
        _encoders[path] = Encoder(path, added=True)
    return _encoders[path]


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it can be printed, else one from U+0100 on."""
    printed = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = (b for b in range(256) if b not in printed)
    return {chr(b): b for b in printed} | {chr(0x100 + n): b for n, b in enumerate(rest)}


def token_bytes(vocabulary: dict[str, int], added: Sequence[str]) -> dict[bytes, int]:
    """Ids by the bytes of their entries, without the added tokens."""
    letter = byte_letters()
    return {bytes(map(letter.__getitem__, entry)): number for entry, number in vocabulary.items() if entry not in added}


def merger(path: str, told: dict):
    """A faster encoder of the same file, or None where the file is of another kind.

    It merges by the order of ids, so the file's merges must be in that order, and
    it splits as `_PIECES` does, so the file must ask for no other splitting.
    """
    import tiktoken

    model, split = told["model"], told["pre_tokenizer"] or {}
    plain = model["type"] == "BPE" and not told["normalizer"] and split.get("type") == "ByteLevel"
    if not plain or split["add_prefix_space"] or not split["use_regex"]:
        return None
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    if any(model["vocab"]["".join(pair)] != 256 + turn for turn, pair in enumerate(pairs)):
        return None
    ranks = token_bytes(model["vocab"], [t["content"] for t in told["added_tokens"]])
    return tiktoken.Encoding(path, pat_str=_PIECES, mergeable_ranks=ranks, special_tokens={})


def parts(text: str, most: int = LONG_TEXT) -> Iterator[str]:
    """A text in parts of about `most` letters; every part but the first begins with a blank between two letters that are not white space."""
    start = 0
    while len(text) - start > most:
        cut = _CUT.search(text, start + most)
        if cut is None:
            break
        yield text[start : cut.start() + 1]
        start = cut.start() + 1
    yield text[start:]


class Encoder:
    """Ids as little-endian unsigned 32-bit bytes.

    The vocabulary's own splitting starts a new piece at every blank that no white
    space follows, so ids of such a text are those of its chunks, one after the
    other. Texts with other white space around blanks are encoded whole. With `added`
    the strings of the vocabulary's added tokens become these tokens, and texts that
    hold one are encoded whole; without it such strings are ordinary text.
    """

    def __init__(self, path: str, added: bool = False) -> None:
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        self._path, self._with_added = path, added
        self._merger = merger(path, told)
        strings = [t["content"] for t in told["added_tokens"] if t["content"]] if added else []
        self._added = re.compile("|".join(map(re.escape, strings)) or "(?!)")
        self._opens = np.zeros(max([*told["model"]["vocab"].values(), *(t["id"] for t in told["added_tokens"])]) + 1, np.bool_)
        self._opens[[number for entry, number in told["model"]["vocab"].items() if entry.startswith("Ġ")]] = True
        self._numbers = Numbers(KEPT_CHUNKS, self._learn, self._forget)
        self._forget()

    def _forget(self) -> None:
        self._known = Rows(np.uint32)

    @cached_property
    def _tokenizer(self):
        """The library's own encoder, for other kinds of files and texts with added tokens."""
        from tokenizers import Tokenizer

        made = Tokenizer.from_file(self._path)
        made.encode_special_tokens = not self._with_added
        return made

    def ids(self, text: str) -> np.ndarray:
        if self._merger is None or self._added.search(text):
            return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(self._merger.encode_ordinary(text), np.uint32)

    def of_chunks(self, chunks: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks, each behind a blank, and their number for each chunk; many in one call, as a blank opens each."""
        values, sizes = [], []
        for lot in range(0, len(chunks), 4096):
            some = chunks[lot : lot + 4096]
            ids = self.ids(" " + " ".join(some))
            opens = np.flatnonzero(self._opens[ids])
            if len(opens) == len(some):
                values.append(ids)
                sizes.append(np.diff(np.r_[opens, len(ids)]))
            else:
                each = [self.ids(" " + chunk) for chunk in some]
                values += each
                sizes.append(np.array([len(e) for e in each]))
        return np.concatenate([np.zeros(0, np.uint32), *values]), np.concatenate([np.zeros(0, np.int64), *sizes])

    def _learn(self, chunks: list[str], first: list[bool]) -> None:
        behind = [chunk for chunk, alone in zip(chunks, first) if not alone]
        values, sizes = self.of_chunks(behind)
        alone = {place: self.ids(chunk) for place, (chunk, one) in enumerate(zip(chunks, first)) if one}
        if not alone:
            return self._known.add(values, sizes)
        count = np.zeros(len(chunks), np.int64)
        count[~np.array(first)] = sizes
        ends = np.cumsum(sizes)
        parts, done = [], 0
        for turn, (place, ids) in enumerate(alone.items()):
            upto = ends[place - turn - 1] if place > turn else 0
            parts += [values[done:upto], ids]
            done, count[place] = upto, len(ids)
        self._known.add(np.concatenate([*parts, values[done:]]), count)

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """Ids of each text as bytes; a very long text goes in parts cut before single blanks, where a piece begins."""
        if max(map(len, texts), default=0) <= LONG_TEXT:
            return self._encode(texts)
        return [b"".join(b"".join(self._encode([part])) for part in parts(text)) for text in texts]

    def _encode(self, texts: Sequence[str]) -> list[bytes]:
        lot = Lot([text.encode() for text in texts], blank_first=False)
        whole = lot.odd.copy()
        if self._added.pattern != "(?!)":
            whole |= [self._added.search(text) is not None for text in texts]
        chosen = np.flatnonzero(~whole[lot.owner])
        self._numbers.room()
        numbers = self._numbers.of(lot, chosen)
        sizes = np.bincount(lot.owner[chosen], self._known.sizes(numbers), len(texts)).astype(np.int64)
        ends = 4 * np.cumsum(sizes)
        data = self._known.take(numbers).astype("<u4").tobytes()
        return [
            self.ids(text).astype("<u4").tobytes() if alone else data[end - 4 * size : end]
            for text, alone, end, size in zip(texts, whole.tolist(), ends.tolist(), sizes.tolist())
        ]
