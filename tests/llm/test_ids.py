import pytest

from lumbung.llm import jaccard, licenses, media, packing, pii

from .fixtures import documents

LARGE = 2**53 + 1
ROWS = [(LARGE, "All rights reserved.", "en", "s"), (None, "All rights reserved.", "en", "s"), (LARGE + 2, "some other words here", "en", "s")]


@pytest.mark.parametrize(
    "run", [pii.scan, licenses.scan, media.digests, media.store, lambda d: jaccard.join_components(d, jaccard.Join(3, 90, 100)), lambda d: packing.pack_documents(d, 64)],
)
def test_large_ids_beside_null(spark, run):
    found = run(documents(spark, ROWS).coalesce(1))
    assert dict(found.dtypes)["doc_id"] == "bigint"
    ids = {r["doc_id"] for r in found.collect()}
    assert ids in ({LARGE, None, LARGE + 2}, {LARGE, None})


def test_components_of_large_ids(spark):
    rows = jaccard.join_components(documents(spark, ROWS).coalesce(1), jaccard.Join(3, 90, 100)).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"]) for r in rows) == [(0, LARGE), (LARGE, LARGE), (LARGE + 2, LARGE + 2)]
