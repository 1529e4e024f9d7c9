import public_tokenizers as P

from soundline.llm import packing


def test_pieces_whatever_is_remembered(spark):
    """How many chunks a worker remembers, and how much it encodes at a time, changes no piece."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = [sorted(map(tuple, packing.pieces_of(docs, P.path("word_bpe_49k.json"), keep_ids=False, most=m, most_chars=c).collect())) for m, c in ((50, 1), (600_000, 3_000_000))]
    assert found[0] == found[1] and len(found[0]) >= 200
