"""Ranked search against scores of every pair, and its early end."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankfold.llm import mask_ranking
from rankfold.llm.mask_ranking import Best, Chunk, Query, rank_chunk, rank_documents, same_masks, terms

WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain_terms(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, best=10):
    found = [(doc_id, Counter(plain_terms(text))) for doc_id, text in docs]
    found = [(doc_id, counts) for doc_id, counts in found if counts]
    n_docs, n_words = len(found), sum(c.total() for _, c in found)
    holding = Counter(term for _, counts in found for term in counts)
    rows = []
    for item_id, text in items:
        scored = []
        for doc_id, counts in found:
            m = 25 + 75 * counts.total() * n_docs // n_words
            score = 0
            for term in plain_terms(text):
                if tf := counts[term]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding[term] + 1)))
                    score += w * (1_000_000_000 * tf // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        rows += [
            (item_id, rank, None if null else doc_id, -score)
            for rank, (score, null, doc_id) in enumerate(sorted(scored)[:best], 1)
        ]
    return rows


def in_order(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[3], str(r[2])))


def some_text(rng, words, most):
    return " ".join(rng.choices([f"w{i}" for i in range(words)], [1 / (i + 1) for i in range(words)], k=rng.randint(0, most)))


@pytest.mark.parametrize("chunk", [4, 8192])
def test_against_every_pair(spark, monkeypatch, chunk):
    monkeypatch.setattr(mask_ranking, "CHUNK_DOCS", chunk)
    rng = random.Random(chunk)
    docs = [(rng.choice([None, *range(150)]), some_text(rng, 90, 60)) for _ in range(250)]
    # Copies share every score; one document has every word, one item more words than a mask word has bits.
    docs += [(i, docs[3][1]) for i in range(200, 230)] + [(500, " ".join(f"W{i}" for i in range(90)) * 20)]
    items = [(i, some_text(rng, 90, 25)) for i in range(15)] + [(20, " ".join(f"w{i}" for i in range(90)))]
    got = rank_documents(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
        spark.createDataFrame(items, "item_id long, text string"),
        block_bytes=300,
    )
    assert in_order(got.collect()) == in_order(plain(docs, items))


def test_odd_rows(spark, documents):
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    items = [(1, "The MIT-license, end; WORD3"), (None, "日本"), (2, None), (3, "?!"), (4, "absent"), (1, "long end")]
    table = spark.createDataFrame(items, "item_id long, text string").withColumns({"score": F.lit(1), "rank": F.lit(2)})
    got = rank_documents(documents.withColumns({"score": F.lit(1), "id": F.lit("x")}), table)
    wanted = [
        row
        for item in items
        for row in plain(docs, [item])
    ]
    assert in_order(got.collect()) == in_order(wanted)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]


def test_empty_tables(spark, documents, no_documents):
    items = spark.createDataFrame([(1, "word1 mit")], "item_id long, text string")
    assert rank_documents(no_documents, items).collect() == []
    assert rank_documents(documents, items.where("false")).collect() == []


def test_terms():
    text = "Ab1-c\x7fÉÀ_x\x00y  z"
    assert [t.decode() for t in terms(text.encode())] == plain_terms(text) == ["ab1", "c", "ÉÀ", "x", "y", " z"]


@pytest.mark.parametrize("rows", [1, 8, 63, 64, 65, 200])
def test_same_masks(rows):
    bits = np.random.default_rng(rows).integers(0, 2, (rows, 300)).astype(np.uint8)
    bits[:, 150:] = bits[:, :150]
    firsts, groups = same_masks(bits)
    assert len({bits[:, i].tobytes() for i in range(300)}) == len(firsts)
    assert all((bits[:, firsts[group]] == bits[:, i]).all() for i, group in enumerate(groups))


def test_masks_that_cannot_win_are_left():
    chunk = Chunk()
    for i in range(5000):
        chunk.add(i, Counter({b"common": 1, **({b"rare": 1} if i % 100 == 0 else {})}), {b"common": 0, b"rare": 1}, 100)
    chunk.index()
    best = Best(10)
    evaluated = rank_chunk(chunk, Query([0, 1], [1, 5000]), best)
    assert [doc_id for _, _, doc_id in best.rows] == list(range(0, 1000, 100))
    assert evaluated == 50
