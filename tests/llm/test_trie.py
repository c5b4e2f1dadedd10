"""The prefix trie against brute force, in shards of a few turns; the tree against plain loops."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from quarterbill.llm import statements, trie
from quarterbill.llm.parens import BlockMinima, Tree

SCHEMA = "conv_id long, turn long, role string, text string, path string, chars long, n_convs long"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def talks():
    out = []
    for c in range(0, 330):
        if c in (100, 7):  # one family without its first conversation
            continue
        for t in range(40 if c == 200 else c % 7):
            out.append((c, t, "user" if t % 2 == 0 else "bot", f"turn {t} of {c % 3 if c < 60 else c}", "x", 1, 2))
    out += [(205, 0, None, None, None, None, None), (205, None, "user", "before", None, None, None), (205, 0, "", "", "y", 1, 1)]
    out += [(None, 0, "user", "nobody", None, None, None), (-105, 0, "user", "é\U0001f600", None, None, None), (-105, 1, "bot", "z" * 5000, None, None, None)]
    return out + [(c, t, "user", "same", None, None, None) for c in range(500, 560) for t in range(6)] + out[:9]


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, key, (role, text)))
    own = {c: [x[-1] for x in sorted(v)] for c, v in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        path = tuple(own.get(base, [])[:h] + own[c][h:])
        ends[path].append(c)
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    out = []
    for p, m in members.items():
        below = [q for q in members if q[: len(p)] == p]
        out.append(
            (
                min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p],
                sum(not children[q] for q in below),
                sum((len(members[q]) - 1) * len(q[-1][1]) for q in below if q),
                hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest(),
            )
        )
    return sorted(out)


def found(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def test_tree_against_loops():
    rng = random.Random(3)
    for n in (1, 2, 63, 64, 65, 200, 1500):
        depths = [0]
        for _ in range(n - 1):
            depths.append(rng.randint(max(1, depths[-1] - rng.choice([0, 1, 60])), depths[-1] + 1))
        values = np.array([rng.randint(-9, 99) for _ in range(n)])
        tree, d = Tree(np.array(depths)), depths
        last = [next((j for j in range(i + 1, n) if d[j] <= d[i]), n) - 1 for i in range(n)]
        assert tree.last.tolist() == last
        assert tree.sums(values).tolist() == [values[i : e + 1].sum() for i, e in enumerate(last)]
        assert tree.minima(values).tolist() == [values[i : e + 1].min() for i, e in enumerate(last)]
        assert tree.leaves().tolist() == [sum(j == last[j] for j in range(i, e + 1)) for i, e in enumerate(last)]
        lo = np.array([rng.randrange(n) for _ in range(50)])
        hi = np.array([rng.randrange(i, n) for i in lo])
        assert BlockMinima(values).over(lo, hi).tolist() == [values[a : b + 1].min() for a, b in zip(lo, hi)]


@pytest.mark.parametrize("shard", [15, 200, 1 << 20])
def test_trie_against_brute_force(shipped, shard, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 7)
    rows = talks()
    random.Random(1).shuffle(rows)
    df = shipped.createDataFrame(rows, SCHEMA)
    assert found(trie.prefix_trie(trie.rebuild(df), shard=shard)) == brute(rows)


def test_empty_turnless_and_single(shipped):
    df = shipped.createDataFrame(talks(), SCHEMA)
    assert trie.conversation_trie(df.limit(0)).count() == 0
    one = [(3, 0, "user", None, None, None, None)]  # crc32("3") % 6 is 3: its own turn is not after the first h
    assert found(trie.conversation_trie(shipped.createDataFrame(one, SCHEMA))) == brute(one)
    assert brute(one) == [(3, 0, None, 1, 0, 1, 0, hashlib.sha256(b"3").hexdigest())]


def test_sql_twin_on_the_edge_rows():
    rows = talks()
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR, path VARCHAR, chars BIGINT, n_convs BIGINT)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?, ?, ?, ?)", rows)
    got = con.execute(statements.TRIE).fetchall()
    assert sorted(got) == brute(rows)
