"""Repeated strings where a gram has many contexts, and buckets in blocks."""

import numpy as np
import pytest
from test_documents import COLUMNS, collected, removed

from quarterbill.llm import substrings


def test_grams_with_many_contexts(shipped, monkeypatch):
    random = np.random.default_rng(11)
    letters = list("abcdefgh")
    passage = "".join(random.choice(letters, 70))
    text = lambda n: "".join(random.choice(letters, n))
    rows = [(int(i), text(random.integers(0, 60)) + passage + ("xy" * 10 if i % 7 else "") + text(random.integers(0, 60))) for i in random.permutation(90)]
    want = sorted(removed(rows, 50), key=repr)
    largest = []
    docs = shipped.createDataFrame(rows, "doc_id long, text string").repartition(4)
    monkeypatch.setattr(substrings, "MOST_CONTEXTS", 10)
    remover = substrings.Remover(docs)
    settled = docs.mapInArrow(remover._anchors(), substrings.ROW).repartition("bucket").sortWithinPartitions("kind", "bucket").mapInArrow(remover._compare(), substrings.ROW)
    for r in settled.where(f"kind = {substrings.OPEN}").collect():
        largest += np.unique(substrings._unpack([r.blob], substrings.OPEN_ROW)[2], return_counts=True)[1].tolist()
    assert settled.where(f"kind = {substrings.MANY}").count() and max(largest, default=0) <= 10
    assert collected(remover.removed(), *COLUMNS) == want


@pytest.mark.parametrize("most", [1, 7, 100, 10_000])
def test_blocks_hold_whole_keys(most):
    random = np.random.default_rng(12)
    doc = random.integers(0, 40, 500)
    blobs = [b"".join(c.tobytes() for c in (doc[a : a + 100].astype(np.int64), np.arange(a, a + 100, dtype=np.uint32))) for a in range(0, 500, 100)]
    blocks = list(substrings._blocks(blobs, substrings.PLACE_ROW, most, 0))
    assert len(blocks) == -(-500 // most)
    keys = [set(b[0].tolist()) for b in blocks]
    assert sum(map(len, keys)) == len(set(doc.tolist()))
    assert sorted(np.concatenate([b[1] for b in blocks]).tolist()) == list(range(500))
