"""Operators that compare texts with each other, against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from rankfold.llm import common, golay, repeated_phrases, simhash_groups
from rankfold.llm.components import components


def grouped(nodes, links):
    parent = {node: node for node in nodes}

    def find(node):
        while parent[node] != node:
            node = parent[node]
        return node

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    return {node: find(node) for node in nodes}


# --- keys and pairs -------------------------------------------------------------------------


def test_two_bits_always_share_a_key():
    words = np.random.default_rng(0).integers(0, 1 << 23, 5000)
    keys = golay.keys(words)
    assert set((keys >= 0).sum(1)) == {1, 6}
    flips = [0, *(1 << i for i in range(23)), *(1 << i | 1 << j for i in range(23) for j in range(i))]
    for flip in flips:
        others = golay.keys(words ^ flip)
        assert ((keys[:, :, None] == others[:, None, :]) & (keys[:, :, None] >= 0)).any((1, 2)).all()


@pytest.mark.parametrize("bits, crowded", [(1, 1000), (2, 1000), (2, 2), (5, 1000)])
def test_pairs_are_those_of_all_comparisons(spark, bits, crowded):
    rng = np.random.default_rng(1)
    values = set(rng.integers(-(1 << 63), 1 << 63, 100).tolist()) | {0, -1}
    for value in list(values)[:80]:
        for _ in range(4):
            mask = sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 8), replace=False))
            values.add(int(np.uint64(value & (1 << 64) - 1 ^ mask).astype(np.int64)))
    values = np.array(sorted(values), np.int64)
    frame = spark.createDataFrame([(int(v),) for v in values], "fp long")
    got = {(row.a, row.b) for row in simhash_groups.near_pairs(frame, bits, crowded).collect()}
    distance = np.bitwise_count((values[:, None] ^ values[None, :]).view(np.uint64))
    wanted = {(int(values[i]), int(values[j])) for i, j in zip(*np.nonzero(distance <= bits)) if i < j}
    assert got == wanted and wanted


def test_components_against_union_find(spark):
    rng = random.Random(5)
    nodes = range(-40, 160)
    links = [(rng.choice(nodes), rng.choice(nodes)) for _ in range(120)] + [(i, i + 1) for i in range(100, 150)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    wanted = grouped(nodes, links)
    assert got == {node: root for node, root in wanted.items() if node != root}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def slow_fingerprint(text):
    words = text.encode().lower().split()
    runs = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(run, seed=42) for run in runs]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def test_fingerprints_and_groups_of_odd_rows(spark, documents, no_documents):
    rows = documents.select("doc_id", "text").collect()
    marks = {r: slow_fingerprint(r.text or "") for r in rows}
    got = simhash_groups.link_fingerprints(documents).collect()
    assert len(got) == len(rows)
    assert sorted((str(r.doc_id), r.fp % (1 << 64)) for r in got) == sorted((str(r.doc_id), f) for r, f in marks.items() for _ in range(rows.count(r)))
    groups = {(r.doc_id, r.fp): r.component_id for r in got}
    assert groups[3, 0] == groups[4, 0] == groups[6, 0] == 3
    assert {c for (d, _), c in groups.items() if d in (1, 2)} == {1}
    assert [c for (d, _), c in groups.items() if d is None] == [None]
    assert simhash_groups.link_fingerprints(no_documents).count() == 0


def test_blocks_of_hashes_add_up(monkeypatch):
    hashes = simhash_groups.shingle_hashes(b"a b c d e f g h i j")
    whole = simhash_groups.fingerprint(hashes)
    monkeypatch.setattr(simhash_groups, "_BLOCK", 3)
    assert simhash_groups.fingerprint(hashes) == whole


def test_frequent_fingerprints_and_star_centres(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_ROWS", 5)
    same, centre = " ".join(f"w{i}" for i in range(60)), 1 << 40
    rows = [(i, same) for i in range(40)] + [(100 + i, f"other {i} text {i * i}") for i in range(20)] + [(50, None), (51, "")]
    got = simhash_groups.link_fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 62 and {r.component_id for r in got if r.doc_id < 40} == {0}
    assert {r.component_id for r in got if r.doc_id in (50, 51)} == {50}
    links = [(centre, i) for i in range(60)] + [(i, 1000 + i) for i in range(60)]
    roots = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.root for r in roots} == {0} and len(roots) == 120


# --- repeated phrases -----------------------------------------------------------------------


def slow_removal(rows, window):
    words = [(r.text or "").encode().split() for r in rows]
    counts = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    for row, w in zip(rows, words):
        gone = {j for i in range(len(w) - window + 1) if counts[tuple(w[i : i + window])] > 1 for j in range(i, i + window)}
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        yield str(row.doc_id), len(w), len(gone), hashlib.sha256(kept).hexdigest()


def removal(frame, **options):
    got = repeated_phrases.remove_repeats(frame, **options).collect()
    return sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got)


@pytest.mark.parametrize("window, anchor", [(35, 16), (5, 2), (4, 4)])
def test_repeats_against_brute_force(spark, documents, no_documents, window, anchor):
    rng = random.Random(window)
    passage = [f"p{i}" for i in range(50)]
    rows = []
    for i in range(60):
        text = [f"w{rng.randint(0, 3 if i % 4 == 0 else 900)}" for _ in range(rng.randint(0, 120))]
        if i % 3:
            a, b = sorted(rng.sample(range(51), 2))
            at = rng.randint(0, len(text))
            text[at:at] = passage[a:b]
        rows.append((i % 50, " ".join(text)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for docs in (frame, documents):
        got = removal(docs, window=window, anchor=anchor)
        assert got == sorted(slow_removal(docs.collect(), window))
    assert removal(no_documents, window=window, anchor=anchor) == []


def test_codes_of_words_match_only_whole_words(monkeypatch):
    monkeypatch.setattr(repeated_phrases.PhraseAutomaton, "LETTERS", "ab")
    words = [bytes([97 + i]) for i in range(8)]
    rng = random.Random(0)
    for _ in range(100):
        phrases = {tuple(rng.choice(words) for _ in range(3)) for _ in range(4)}
        text = [rng.choice([*words, b"other"]) for _ in range(60)]
        got = repeated_phrases.PhraseAutomaton(phrases, 3).places(text).tolist()
        assert got == [i for i in range(58) if tuple(text[i : i + 3]) in phrases]


def test_a_passage_in_every_document_stays_in_no_task(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit(passage + " own"), F.col("id").cast("string")).alias("text"))
    got = repeated_phrases.remove_repeats(docs).collect()
    assert {(r.n_words, r.n_removed) for r in got} == {(61, 60)}


def test_rows_repeated_whole_spread_over_the_shards(spark):
    text = " ".join(f"p{i}" for i in range(60))
    same = spark.range(1000).select(F.lit(7).cast("long").alias("doc_id"), F.lit(text).alias("text"))
    others = spark.range(2000).select("id", F.concat(F.lit("own "), F.col("id").cast("string")))
    docs = same.unionAll(others).repartition(4)
    dealt = repeated_phrases.dealt_into_shards(docs)
    sizes = [r["count"] for r in dealt.groupBy("shard").count().collect()]
    assert sum(sizes) == 3000 and max(sizes) < 2 * 3000 / len(sizes)
    got = removal(docs)
    assert got == sorted(slow_removal(docs.collect(), 35))
