"""Token counts of a unigram tokenizer by dynamic programming over a trie of distinct pre-tokens.

Every distinct pre-token of a batch is inserted into a trie. The forward score
of a node is the best log probability over all ways to cut the prefix it stands
for into vocabulary pieces; it is computed once however many pre-tokens share
the prefix, and the number of pieces is stored at terminals. Documents then add
up the stored counts. Nothing is shuffled; the store of a Python worker is
bounded and emptied when full.

Vocabulary: a public rank file of byte pieces; the log probability of the piece
of rank r is -log((r + 2) * H), Zipf's law over the ranks, where H normalizes it.
Every single byte is a piece, so every text can be cut. Equal scores take fewer
pieces.

Defined results: a null or empty text has zero counts and score 0.
"""

from __future__ import annotations

import base64
import math
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storewright.llm.tokens import LONG_CUT, cuts

STORE_ENTRIES = 700_000
OUT = "doc_id long, n_chars long, n_pretokens long, n_tokens long, log_prob double"


class UnigramVocabulary:
    def __init__(self, rank_file: str):
        with open(rank_file, "rb") as f:
            ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, f)}
        norm = math.log(sum(1.0 / (r + 2) for r in ranks.values()))
        #: The vocabulary as an automaton: (state, byte) -> state, and the log probability of a state that ends a piece.
        self.step: dict[int, int] = {}
        self.ends: list[float | None] = [None]
        for word, rank in ranks.items():
            state = 0
            for byte in word:
                at = state << 8 | byte
                if at not in self.step:
                    self.step[at] = len(self.ends)
                    self.ends.append(None)
                state = self.step[at]
            self.ends[state] = -math.log(rank + 2) - norm


class PrefixTrie:
    """A trie walked in order of its keys: what is known of the current path is kept, so a node is scored once.

    A node holds its best score, its number of pieces, and the pieces that are
    begun and not yet known to fail: (depth of their start, automaton state).
    """

    def __init__(self, vocabulary: UnigramVocabulary):
        self.step, self.ends = vocabulary.step, vocabulary.ends

    def terminals(self, keys: list[bytes]) -> Iterator[tuple[bytes, int, float]]:
        """(key, pieces, score) of sorted distinct keys."""
        step, ends = self.step.get, self.ends
        path, score, pieces, begun = b"", [0.0], [0], [[]]
        for key in keys:
            shared, most = 0, min(len(path), len(key))
            while shared < most and path[shared] == key[shared]:
                shared += 1
            del score[shared + 1 :], pieces[shared + 1 :], begun[shared + 1 :]
            for i in range(shared, len(key)):
                byte, best, fewest, going = key[i], -math.inf, 0, []
                for start, state in [*begun[i], (i, 0)]:
                    state = step(state << 8 | byte)
                    if state is None:
                        continue
                    going.append((start, state))
                    p = ends[state]
                    if p is not None:
                        s, k = score[start] + p, pieces[start] + 1
                        if s > best or s == best and k < fewest:
                            best, fewest = s, k
                score.append(best)
                pieces.append(fewest)
                begun.append(going)
            path = key
            yield key, pieces[-1], score[-1]


class TokenCounter:
    """Stored counts of cuts, the cut being the key and its place in the columns the value."""

    def __init__(self, rank_file: str, pattern: str):
        self.pattern = regex.compile(pattern)
        self.trie = PrefixTrie(UnigramVocabulary(rank_file))
        self._empty()

    def _empty(self) -> None:
        self.place: dict[str, int] = {}
        self.pretokens, self.tokens, self.score = array("q"), array("q"), array("d")

    def insert(self, new: set[str]) -> None:
        split = {}
        for cut in new:  # a cut of letters only, after at most one space, is one pre-token
            one = cut.isalpha() or cut[:1] == " " and cut[1:].isalpha()
            split[cut] = [cut.encode()] if one else [p.encode() for p in self.pattern.findall(cut)]
        keys = sorted({p for parts in split.values() for p in parts})
        done = {key: (count, score) for key, count, score in self.trie.terminals(keys)}
        for cut, parts in split.items():
            self.place[cut] = len(self.tokens)
            self.pretokens.append(len(parts))
            self.tokens.append(sum(done[p][0] for p in parts))
            self.score.append(math.fsum(done[p][1] for p in parts))

    def count(self, texts: list[str]) -> list[tuple[int, int, float]]:
        """(pre-tokens, tokens, score) of each text."""
        if len(self.place) > STORE_ENTRIES:
            self._empty()
        split = []
        for text in texts:
            found = cuts(text)
            if found is None:
                split.append(self.pattern.findall(text))
            else:
                split.append([found[0]] * bool(found[0]) + [" " + x for x in found[1]])
        place = self.place
        self.insert({c for parts in split for c in parts if c not in place})
        at = np.fromiter((place[c] for parts in split for c in parts), np.int64, sum(map(len, split)))
        ends = np.cumsum([len(parts) for parts in split])
        taken = [np.frombuffer(column, kind)[at] if len(at) else np.zeros(0, kind)
                 for column, kind in ((self.pretokens, "i8"), (self.tokens, "i8"), (self.score, "f8"))]
        if any(len(c) > LONG_CUT for c in list(place)[-len(at) :]):
            self._empty()  # texts of endless words are counted but not kept
        return [
            tuple(x[a:b].sum().item() for x in taken) for a, b in zip([0, *ends[:-1]], ends, strict=True)
        ]


@lru_cache(maxsize=2)
def counter(rank_file: str, pattern: str) -> TokenCounter:
    return TokenCounter(rank_file, pattern)


def token_counts(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = counter(rank_file, pattern)
        for whole in batches:
            for at in range(0, whole.num_rows, 200):
                batch = whole.slice(at, 200)
                texts = [t or "" for t in batch.column(1).to_pylist()]
                pre, n, score = zip(*tokens.count(texts), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).cast(pa.int64()),
                        pa.array(map(len, texts), pa.int64()),
                        pa.array(pre, pa.int64()),
                        pa.array(n, pa.int64()),
                        pa.array(score, pa.float64()),
                    ],
                    ["doc_id", "n_chars", "n_pretokens", "n_tokens", "log_prob"],
                )

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(count, OUT)
