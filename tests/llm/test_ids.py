"""64-bit ids beside nulls come back as they are."""

import pytest

from bescheid.llm import fingerprint, html_text, packing, pieces, secret_scan, similar, simhash, training_order

IDS = [None, 2**53 + 1, 2**53 + 3, -(2**63) + 1, 2**63 - 1, None]
FOUND = {
    "fingerprints": fingerprint.fingerprints, "pieces": pieces.encode, "decoded": lambda d: pieces.decode(pieces.encode(d)), "packing": packing.pack,
    "secrets": secret_scan.find, "simhash": simhash.near_duplicates,
}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, f"text number {n} of the corpus") for n, i in enumerate(IDS)], "doc_id long, text string").coalesce(1)


def in_order(values):
    return sorted(values, key=lambda x: (x is not None, x or 0))


@pytest.mark.parametrize("name", FOUND)
def test_ids(docs, name):
    assert in_order(r.doc_id for r in FOUND[name](docs).collect()) == in_order(IDS)


def test_shards(spark, docs, tmp_path):
    assert in_order(r.doc_id for r in training_order.write(docs, f"file://{tmp_path}/part-3/x").read(spark).collect()) == in_order(IDS)


def test_both_directions_and_pages(spark, docs):
    from bescheid.llm.common import mapped

    assert in_order(r.doc_id for r in mapped(docs, pieces._both(pieces.public_tokenizers.path("piece_bpe_32k.model")), "doc_id long, n_pieces long, n_bytes long, score double, ids_crc32 long, decoded_crc32 long, round_trip boolean").collect()) == in_order(IDS)
    pages = docs.selectExpr("doc_id as page_id", "'u' as url", "text as html")
    assert in_order(r.page_id for r in html_text.extract(pages).collect()) == in_order(IDS)


def test_components(spark):
    rows = [(2**53 + 3, "a b c d"), (2**53 + 1, "a b c d"), (None, "a b c d"), (-(2**63) + 1, "x y z"), (None, "x y z"), (2**63 - 1, "x y z")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(df).collect() if r.doc_id is not None}
    assert got == {2**53 + 3: 2**53 + 1, 2**53 + 1: 2**53 + 1, -(2**63) + 1: -(2**63) + 1, 2**63 - 1: -(2**63) + 1}
    assert {r.doc_id: r.component_id for r in similar.near_duplicates(df).collect()} == got
