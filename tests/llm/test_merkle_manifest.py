"""The manifest against a plain tree in memory."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from rankfold.llm.merkle_manifest import BlockTree, folded, manifest

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def h(*inputs):
    return hashlib.sha256("".join(inputs).encode()).hexdigest()


def plain_leaf(row, more=0):
    values = dict(row)
    if values["n_chars"] is not None:
        values["n_chars"] += more
    return h(*("-" if values[f] is None else f"{len(str(values[f]).encode())}:{values[f]}" for f in FIELDS))


def plain_tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def plain_siblings(levels, at):
    for level in levels[:-1]:
        yield (at & 1, level[at ^ 1]) if at ^ 1 < len(level) else None
        at //= 2


def plain(rows):
    parts = {}
    for row in rows:
        parts.setdefault(row["lang"], []).append(row)
    names = sorted(parts, key=lambda name: (name is not None, (name or "").encode()))
    for mine in parts.values():
        mine.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r)))
    trees = [plain_tree([plain_leaf(r) for r in parts[name]]) for name in names]
    top = plain_tree([tree[-1][0] for tree in trees])
    for i, (name, tree) in enumerate(zip(names, trees)):
        for j, row in enumerate(parts[name]):
            siblings = [*plain_siblings(tree, j), *plain_siblings(top, i)]
            changed = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 7 == 0
            node = plain_leaf(row, more=int(changed))
            for sibling in siblings:
                if sibling is None:
                    node = h(node)
                else:
                    node = h(sibling[1], node) if sibling[0] else h(node, sibling[1])
            proof = h(*(sibling[1] for sibling in siblings if sibling))
            yield row["doc_id"], plain_leaf(row), tree[-1][0], top[-1][0], proof, node, node == top[-1][0]


def sorted_rows(rows):
    return sorted(map(tuple, rows), key=lambda row: (row[0] is not None, row))


def checked(docs, height):
    more = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    got = manifest(docs, tampered={"n_chars": more}, height=height)
    assert sorted_rows(got.collect()) == sorted_rows(plain([row.asDict() for row in docs.collect()]))
    return got


SCHEMA = "pos long, doc_id long, text string, lang string, source string, n_chars long, part string"


@pytest.mark.parametrize("height", [2, 12])
@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 3}, {None: 1, "": 2, "é": 70, "en": 5, "z": 16, "zz": 17}])
def test_every_shape_of_tree(spark, height, sizes):
    rows = []
    for lang, size in sizes.items():
        rows += [(0, 5 * i % 101, f"text {lang} {i}", lang, "s", i, "p") for i in range(size)]
    got = checked(spark.createDataFrame(rows, SCHEMA), height)
    failed = {r.doc_id for r in got.collect() if not r.verified}
    assert failed == {r[1] for r in rows if zlib.crc32(str(r[1]).encode()) % 7 == 0}


def test_nulls_ties_and_repeated_rows(spark):
    same = (1, 7, "same", "en", "s", 4, "p")
    rows = [same] * 30 + [
        (1, 7, "other", "en", "s", 5, "p"),
        (1, None, None, None, None, None, None),
        (1, None, "", "en", "", 0, None),
        (1, 10, "a" * 100_000 + "\U0001f600", "en", "s", None, "p"),
        (1, 14, "", None, None, 3, "p"),
    ]
    checked(spark.createDataFrame(rows, SCHEMA), 2)


def test_other_columns_and_empty_tables(spark, documents):
    docs = documents.withColumns({name: F.lit(1) for name in ("lang", "n_chars", "part", "pos", "digest", "block")})
    assert manifest(docs, height=2).count() == docs.count()
    assert manifest(docs.where("false")).collect() == []


def test_versions_copy_ancestors_and_share_the_rest():
    tree = BlockTree([h(str(i)) for i in range(13)], 13, 12)
    for at in range(13):
        version = tree.changed(at, "other")
        # One node a level, those above the leaf; all others are the original's.
        assert sorted(version) == [(level, at >> level) for level in range(len(tree.levels))]
        assert tree.root_of(version) == folded("other", tree.siblings(at))
        assert tree.root_of({}) == tree.root == folded(h(str(at)), tree.siblings(at))


def test_a_block_among_others_grows_to_full_height():
    # One node left over on a tier with more: it is hashed alone on every level.
    tree = BlockTree(["a"], 5, 2)
    assert tree.root == h(h("a"))
    assert tree.siblings(0) == ["", ""]
