"""The pipeline against plain versions of its stages on made tables, and token counts of texts of any length."""

from __future__ import annotations

import base64
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from storewright.llm import trie_counts
from storewright.llm.queries import PACKING


TOXIC = ["vile", "nasty", "wicked", "cruel", "hideous", "rotten"]


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0d]+", (text or "").lower())
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def one_of_near_copies(rows):
    sets, group = [shingles(t) for _, t in rows], list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= 75 * len(sets[a] | sets[b]):
                group = [group[b] if g == group[a] else g for g in group]
    best = {}
    for n, (i, _) in enumerate(rows):
        if i is not None and sets[n]:
            best[group[n]] = min(best.get(group[n], i), i)
    return [(i, t) for n, (i, t) in enumerate(rows) if not sets[n] or best.get(group[n]) in (None, i)]


def cut_repeats(rows):
    first, out = {}, []
    keyed = [(i, 2**63 - 1 if i is None else i, t, (t or "").encode()) for i, t in rows]
    for _, key, _, b in keyed:
        for p in range(len(b) - 49):
            first[b[p : p + 50]] = min(first.get(b[p : p + 50], key), key)
    for i, key, t, b in keyed:
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if first[b[p : p + 50]] < key:
                gone[p : p + 50] = b"\1" * 50
        rest = bytes(c for c, g in zip(b, gone, strict=True) if not g).decode("utf-8", "ignore")
        if not any(gone):
            out.append((i, t))
        elif rest.strip():
            out.append((i, rest))
    return out


def holds(text, passage):
    """Whether some part of the text is within 5 % edits of the passage."""
    plain = [np.frombuffer(" ".join((t or "").lower().split()).encode(), np.uint8) for t in (text, passage)]
    row, step = np.zeros(len(plain[0]) + 1, int), np.arange(len(plain[0]) + 1)
    for c in plain[1]:
        cost = row + 1
        cost[1:] = np.minimum(cost[1:], row[:-1] + (plain[0] != c))
        row = np.minimum.accumulate(cost - step) + step
    return row.min() <= int(0.05 * len(plain[1]))


def pieces(rows):
    tokenizer = Tokenizer.from_file(PACKING["tokenizer"])
    size, out = PACKING["capacity"], Counter()
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [PACKING["end_id"]]
        cut = [0, *range(len(ids) % size or min(size, len(ids)), len(ids) + 1, size)]
        for n, (a, b) in enumerate(zip(cut, cut[1:], strict=False)):
            out[i, n, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    return out


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(11)
    words = ["".join(rng.choices("abdefghkmnoprstué", k=rng.randint(3, 8))) for _ in range(400)]
    some = lambda n: rng.choices(words, k=n)
    passage, items = some(18), [" ".join(some(16)) for _ in range(4)] + [None]
    rows = []
    for i in range(240):
        text = some(70)
        if i % 8 == 0:
            text[5:65:10] = TOXIC  # so plain that the chain has to tell them apart
        elif i % 24 == 1:
            text[30:30] = passage
        elif i % 24 == 3:
            text[10:10] = items[i % 4].upper().split()
        elif i % 24 == 5:
            text[10:10] = items[i % 4].replace("a", "ä", 1).split()
        rows.append((i, " ".join(text)))
    for i in range(240, 260):  # copies with a word changed
        copy = rows[(i * 7) % 240][1].split()
        copy[20] = "other"
        rows.append((i, " ".join(copy)))
    rows += [(300, " ".join(passage)), (301, None), (302, ""), (303, " \n"), (None, " ".join(some(30))), (304, " ".join(some(2500)))]
    rows.append((305, " ".join(some(20)) + "<|endoftext|>" + " ".join(some(20))))
    folder = tmp_path_factory.mktemp("tables")
    docs = [(i, t, "en", "made", None if t is None else len(t)) for i, t in rows]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars int").repartition(5).write.parquet(
        f"{folder}/documents.parquet"
    )
    labels = [(i, 1, int(i % 8 == 0)) for i in range(200)] + [(None, 1, 1), (999, 1, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), rows, [t for t in items if t]


def test_pipeline_against_plain_stages(spark, tables):
    folder, rows, items = tables
    clean = [(i, t) for i, t in rows if not set(TOXIC) & set((t or "").split())]
    single = one_of_near_copies(clean)
    cut = cut_repeats(single)
    kept = [(i, t) for i, t in cut if not any(holds(t, p) for p in items)]
    assert len(rows) > len(clean) > len(single) > len(cut) > len(kept) > 150 and dict(cut) != dict(single)
    found = corpus_pipeline.run(spark, folder).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == pieces(kept)
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        ends = [0]
        for offset, length in sorted(parts):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= PACKING["capacity"]


CLASHING = "doc_id long, text string, toxic string, p_toxic string, node int, chunk string, kept string, lang string, n_chars int"


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_columns_of_any_name(spark, tables, name):
    """Columns named like those that operators add come back as they were; repeated rows too; empty tables stay empty."""
    folder, rows, _ = tables
    stage = dict(corpus_pipeline.STAGES)[name]
    given = [(i, t, f"mine {n}", "p", n, "c", "k", "en", len(t or "")) for n, (i, t) in enumerate(rows + rows[9:12])]
    docs = spark.createDataFrame(given, CLASHING).repartition(4)
    kept = stage(spark, docs, folder)
    assert kept.columns == docs.columns
    by_number = {r[4]: r for r in given}
    found = kept.collect()
    assert 100 < len(found) <= len(given) and len({r.node for r in found}) == len(found)
    for r in found:
        want = by_number[r.node]
        assert (r.doc_id, r.toxic, r.p_toxic, r.chunk, r.kept, r.lang) == (want[0], want[2], "p", "c", "k", "en")
        assert r.text == want[1] or name == "suffix_dedup"
    empty = stage(spark, spark.createDataFrame([], CLASHING), folder)
    assert empty.columns == docs.columns and empty.collect() == []


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_bound_the_bytes_of_a_batch(spark, tables, conf, name):
    """Unless the session does, so that a batch does not grow with the length of texts."""
    option = "spark.sql.execution.arrow.maxBytesPerBatch"
    conf(**{option.replace(".", "__"): "9000000"})
    stage, docs = dict(corpus_pipeline.STAGES)[name], spark.createDataFrame([], CLASHING)
    stage(spark, docs, tables[0])
    assert spark.conf.get(option) == "9000000"
    spark.conf.unset(option)
    stage(spark, docs, tables[0])
    long = spark.range(0, 400, 1, 1).select(F.repeat(F.lit("a"), 50_000).alias("text"))
    sizes = long.mapInArrow(lambda bs: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"]) for b in bs), "n long").collect()
    assert len(sizes) >= 4 and max(r.n for r in sizes) <= 4_200_000


def test_packing_of_an_empty_table(spark, tables):
    assert corpus_pipeline.pack_sequences(spark, spark.createDataFrame([], CLASHING), tables[0]).collect() == []


def test_token_counts_of_long_texts(spark):
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    longest = max(len(base64.b64decode(line.split()[0])) for line in Path(ranks).read_bytes().splitlines() if line)
    counter, vocabulary = trie_counts.TokenCounter(ranks, pattern), trie_counts.UnigramVocabulary(ranks)

    def log_prob(piece):
        state = 0
        for byte in piece:
            state = vocabulary.step.get(state << 8 | byte)
            if state is None:
                return None
        return vocabulary.ends[state]

    def plain(word):
        best = [(0.0, 0)]
        for i in range(1, len(word) + 1):
            cuts = [
                (best[j][0] + p, best[j][1] - 1)
                for j in range(max(0, i - longest), i) if (p := log_prob(word[j:i])) is not None
            ]
            best.append(max(cuts))
        return -best[-1][1], best[-1][0]

    rng = random.Random(8)
    texts = ["".join(rng.choices(["the ", "ing", "er", "é", "\n", "日本", " 12"], k=n)) for n in (150, 400, 2500)]
    texts += ["a" * 3000, "".join(rng.choices("abcdefgh", k=2000)), "x " * 700]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in trie_counts.token_counts(docs, ranks, pattern).collect()}
    for i, t in enumerate(texts):
        words = [plain(w.encode()) for w in counter.pattern.findall(t)]
        assert len(t) == got[i].n_chars and (i == 0 or len(t) > 400)
        assert (got[i].n_pretokens, got[i].n_tokens) == (len(words), sum(n for n, _ in words))
        assert got[i].log_prob == pytest.approx(sum(s for _, s in words), rel=1e-9)
