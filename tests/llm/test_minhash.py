"""MinHash near-duplicates against brute force: sketches, links, hot groups, edge rows."""

import random
import re

import numpy as np
import pytest
from conftest import prose

from quarterbill.llm import minhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k=4):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(lower)
    return {" ".join(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {" ".join(w)} if w else set()


def brute(rows, percent=80):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[top(i)] = top(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [d for j, (d, _) in enumerate(rows) if top(j) == top(i) and d is not None]
        least = min(ids, default=None)
        out.append((doc, len(sets[i]), least, doc == least))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()), key=repr)


def edited(text, rng, n):
    w = text.split()
    for i in rng.sample(range(len(w)), n):
        w[i] = f"edit{rng.random()}"
    return " ".join(w)


def test_sketch_fills_and_agrees_like_the_similarity():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 40, 3000):
        pool = rng.integers(1, 2**63, 2 * n, dtype=np.uint64)
        agree = []
        for k in range(40):
            a, b = minhash.mix(pool[:n] + np.uint64(k)), minhash.mix(pool[n // 5 : n + n // 5] + np.uint64(k))
            x, y = minhash.sketch(np.unique(a)), minhash.sketch(np.unique(b))
            assert (x != np.uint64(0xFFFFFFFFFFFFFFFF)).all()
            agree.append((x == y).mean())
        union = n + n // 5
        assert abs(np.mean(agree) - (n - n // 5) / union) < 0.06


def test_groups_against_brute_force(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(minhash.near_duplicates(docs)) == brute(rows)


@pytest.mark.parametrize("piece", [4096, 16])
def test_chains_and_hot_groups(shipped, monkeypatch, piece):
    monkeypatch.setattr(minhash, "PIECE", piece)
    monkeypatch.setattr(minhash, "PARTNERS_PER_TASK", 8)
    rng, rows = random.Random(5), []
    base = prose(9, 300)
    rows += [(1000 + i, edited(base, rng, 12 + i % 9)) for i in range(80)]  # about the limit: some linked, some not
    text = prose(4, 200)
    for i in range(40):  # a chain, each like the one before
        rows.append((i, text))
        text = edited(text, rng, 4)
    rows += [(2000 + i, prose(9, 300)) for i in range(60)] + [(3000 + i, prose(30 + i, 60)) for i in range(40)]
    rng.shuffle(rows)
    want = brute(rows)
    assert len({r[2] for r in want}) > 42
    assert found(minhash.near_duplicates(shipped.createDataFrame(rows, "doc_id long, text string"))) == want


def test_links_of_a_bucket_against_brute_force():
    """What a bucket's forest connects is what its links connect, in one piece or between two."""
    rng = random.Random(2)
    for pieces in (1, 2):
        base = [rng.getrandbits(63) for _ in range(100)]
        sets = [{*base[: 100 - rng.randrange(30)], *(rng.getrandbits(63) for _ in range(rng.randrange(12)))} for _ in range(40)]
        rows = []
        for i, s in enumerate(sets):
            hashes = np.array(sorted(s), np.uint64)
            rows.append((2 if pieces == 1 else i % 2, i, i, minhash.sketch(hashes).astype(np.uint8).tobytes(), hashes.tobytes()))
        label, edges = list(range(40)), minhash._forest(rows, pieces == 1, 80)
        want = [(i, j) for i in range(40) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) and (pieces == 1 or (i + j) % 2)]
        groups = []
        for links in (edges, want):
            label = list(range(40))
            for u, v in links:
                label = [label[u] if x == label[v] else x for x in label]
            groups.append({frozenset(i for i in range(40) if label[i] == x) for x in label})
        assert groups[0] == groups[1] and len(edges) < 40


def test_empty(empty):
    assert found(minhash.near_duplicates(empty)) == []
    with pytest.raises(ValueError):
        minhash.near_duplicates(empty, percent=50)
