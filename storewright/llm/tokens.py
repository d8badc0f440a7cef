"""Ids of a public byte-level BPE, fast on repeated words. Runs inside Spark tasks.

The pre-tokenizer never lets a piece reach over a space that follows a
non-space, so a text without double spaces is cut at its spaces. The cuts of
two megabytes of text are numbered by Arrow; each distinct one is looked up in a
cache of bounded size, and those it lacks are encoded in one call. A text with two
spaces in a row is encoded whole, and so is one with another blank before a space if
an id of the vocabulary stands for both. Cuts with letters outside the
Latin blocks go through the tokenizer itself, whose tables of letters decide, and
so do whole texts that hold one of its special strings, such as an end mark: it
gives them their own id, as an unmodified tokenizer does.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator
from functools import cached_property
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHE_ENTRIES = 50_000
SLICE_BYTES = 2_000_000  # text whose cuts are numbered together
PLAIN = re.compile("[\t\n -~¡-ɏ]*")
JOINABLE = re.compile("[!-~¡-ɏ][\t\n!-~¡-ɏ]*")  # a cut that may follow any other in one call
LONG_CUT = 2_000  # a longer cut is encoded each time, not kept


def cuts(text: str) -> tuple[str, list[str]] | None:
    """The cut before the first space and those after each space, without it; None if spaces follow each other."""
    if "  " in text:
        return None
    first, *rest = text.split(" ")
    return first, rest


class ByteBpe:
    """Ids as little-endian 32-bit bytes."""

    def __init__(self, json_path: str):
        import public_tokenizers
        import tiktoken

        self.json_path = json_path
        with open(json_path, encoding="utf-8") as f:
            told = json.load(f)
        vocabulary = told["model"]["vocab"]
        #: Strings that the tokenizer takes for one id wherever they stand, also within a piece.
        self.special = tuple(t["content"] for t in told.get("added_tokens", []))
        byte_of = {chr(c): b for b, c in enumerate(_printable_codes())}
        ranks = {bytes(map(byte_of.get, word)): i for word, i in vocabulary.items() if set(word) <= byte_of.keys()}
        ranks = {word: i for word, i in ranks.items() if i < len(vocabulary) - 1}
        words = [word.decode("utf-8", "ignore") for word in ranks if b" " in word[1:]]
        #: What an id may reach over although a space begins in it.
        self.uncut = sorted({"  "} | {word[i - 1 : i + 1] for word in words for i in range(1, len(word)) if word[i] == " "})
        self.n_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.n_bytes[list(ranks.values())] = [len(word) for word in ranks]
        self.plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.cache: dict[str, bytes] = {}

    @cached_property
    def whole(self):
        """The tokenizer itself, read once a text needs it: many tasks do without its memory."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.json_path)

    def _encode(self, cut: str) -> bytes:
        if PLAIN.fullmatch(cut):
            ids = self.plain.encode_ordinary(cut)
        else:
            ids = self.whole.encode(cut, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _encode_joined(self, some: list[str]) -> list[bytes]:
        """Ids of each of some cuts, told apart by the bytes that the ids stand for."""
        text = " " + " ".join(some)
        ids = np.array(self.plain.encode_ordinary(text), "<u4")
        begins = np.flatnonzero(np.frombuffer(text.encode(), np.uint8) == ord(" "))
        bounds = 4 * np.searchsorted(np.cumsum(self.n_bytes[ids]), begins, "right")
        data = ids.tobytes()
        return [data[i:j] for i, j in pairwise([*bounds.tolist(), len(data)])]

    def _after_space(self, distinct: list[str]) -> list[bytes]:
        """Ids of each of the distinct cuts, with the space before it."""
        table = list(map(self.cache.get, distinct))
        lacking = [i for i, ids in enumerate(table) if ids is None]
        joined = [i for i in lacking if len(distinct[i]) <= LONG_CUT and JOINABLE.fullmatch(distinct[i])]
        if joined:
            for i, ids in zip(joined, self._encode_joined([distinct[i] for i in joined]), strict=True):
                table[i] = ids
        for i in lacking:
            if table[i] is None:
                table[i] = self._encode(" " + distinct[i])
        if len(self.cache) + len(lacking) > CACHE_ENTRIES:
            self.cache.clear()
        kept = [i for i in lacking if len(distinct[i]) <= LONG_CUT]
        self.cache.update((distinct[i], table[i]) for i in kept[:CACHE_ENTRIES])
        return table

    def _slice(self, texts: pa.Array) -> Iterator[bytes]:
        def holding(some: Iterable[str]) -> np.ndarray:
            found = np.zeros(len(texts), bool)
            for part in some:
                found |= pc.match_substring(texts, part).to_numpy(zero_copy_only=False)
            return found

        special = holding(self.special)
        at_once = special | holding(self.uncut)
        cut = pc.split_pattern(pc.if_else(pa.array(at_once), pa.scalar("", texts.type), texts), " ")
        numbered = cut.flatten().dictionary_encode()
        distinct, numbers = numbered.dictionary.to_numpy(zero_copy_only=False).tolist(), numbered.indices.to_numpy()
        table = self._after_space(distinct)
        lengths = np.array([len(ids) // 4 for ids in table], np.int64)
        begins, flat = np.cumsum(lengths) - lengths, np.frombuffer(b"".join(table), "<u4")
        for i, (first, end) in enumerate(pairwise(cut.offsets.to_numpy().tolist())):
            if special[i]:
                ids = self.whole.encode(texts[i].as_py(), add_special_tokens=False).ids
                yield np.array(ids, "<u4").tobytes()
            elif at_once[i]:
                yield self._encode(texts[i].as_py())
            else:
                out = [self._encode(distinct[numbers[first]])]
                for at in range(first + 1, end, 50_000):  # a very long text does not need all its places at once
                    some = numbers[at : min(at + 50_000, end)]
                    n, stops = lengths[some], np.cumsum(lengths[some])
                    out.append(flat[np.repeat(begins[some] - stops + n, n) + np.arange(stops[-1])].tobytes())
                yield b"".join(out)

    def ids(self, texts: pa.Array) -> Iterator[bytes]:
        """Ids of each text; a null is empty."""
        texts = pc.fill_null(texts, "")
        place = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)) // SLICE_BYTES
        for first, end in pairwise([0, *(np.flatnonzero(np.diff(place)) + 1).tolist(), len(texts)]):
            yield from self._slice(texts.slice(first, end - first))


def _printable_codes() -> Iterable[int]:
    """The code point that stands for each byte in a byte-level vocabulary file."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    beyond = 256
    for b in range(256):
        if b in printable:
            yield b
        else:
            yield beyond
            beyond += 1


def byte_bpe(json_path: str) -> ByteBpe:
    """One per task: Spark keeps its Python workers, and a kept tokenizer would take its memory from all later stages."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return ByteBpe(json_path)
