import public_tokenizers
import pytest
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def vocabularies():
    return {name: public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")}


@pytest.fixture
def documents(spark):
    """Rows of a few odd kinds, with columns that clash with those the operators make."""
    words = " ".join(f"word{i}" for i in range(60))
    rows = [
        (1, words, "src0", "x", 1),
        (2, words, "src0", "x", 2),
        (3, None, "src1", None, None),
        (4, "", None, "x", 3),
        (4, "Released under the MIT License.", "src1", "x", 4),
        (4, "Released under the MIT License.", "src1", "x", 4),
        (None, "mail a.b@example.com or john dot doe at example dot com", "src1", "x", 5),
        (5, "long " * 5000 + "end", "src1", "x", 6),
        (6, " \t\n ", "src1", "x", 7),
        (7, "<|endoftext|> 日本 é \U0001f600​", "src2", "x", 8),
    ]
    # Columns of the operators' own working names must be left alone.
    named = spark.createDataFrame(rows, "doc_id long, text string, source string, key string, n_tokens int")
    clashing = ("_id", "_key", "_text_key", "host", "fp", "root", "n_met", "shard", "place", "kept", "item_id", "row", "h")
    return named.withColumns({name: F.lit(name) for name in clashing})


@pytest.fixture
def no_documents(documents):
    return documents.where("false")
