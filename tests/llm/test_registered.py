"""run() and the registered queries on small tables, against brute force that calls no operator."""

import re
from collections import Counter

import __spark_entry__
import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from conftest import prose
from test_documents import BASE, COLUMNS, WORD, collected, removed, slow_fingerprint
from tokenizers import Tokenizer

SECRET = 'token = "04dbebab91ab85687d33eeaaf9ac699e"'
N = 400


def words(text):
    return len(WORD.findall(text))


def targets(sizes):
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes))}
    target, free, left = {}, set(sizes), 1.5 * sum(sizes.values())
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > 2 * sizes[s]}
        if not over:
            break
        target |= {s: 2 * sizes[s] for s in over}
        left -= sum(target[s] for s in over)
        free -= over
    return target | {s: weight[s] * level for s in free}


def groups(rows):
    """The least id that each fingerprint reaches."""
    prints = {d: slow_fingerprint(t) for d, t in rows}
    out = {}
    for doc, fp in prints.items():
        seen, todo = {fp}, [fp]
        while todo:
            at = todo.pop()
            new = {f for f in prints.values() if (f ^ at).bit_count() <= 3} - seen
            seen |= new
            todo += new
        out[doc] = min(d for d, f in prints.items() if f in seen)
    return out


@pytest.fixture(scope="module")
def tables(shipped, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    docs, labels = [], []
    for i in range(N):
        toxic = i % 4 == 0
        text = f"Quiet words number{i} here. Some more of{i % 17} them" + (" you nasty fool" if toxic else "") + ". "
        text += prose(i - 1 if i % 20 == 3 else i, 30 + i % 50) + (f" {SECRET}" if i % 10 == 1 else "")
        docs.append((i, docs[i - 2][1] if i % 50 == 7 else text, "en", "abc"[i % 3], 0))
        labels.append((i, 1, int(toxic)))
    shipped.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    shipped.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    page = "<html><nav>Home</nav><article><h1>Title {0}</h1><p>Read us daily</p><p>Body {0}</p></article><footer>us</footer></html>"
    pages = [(i, f"http://a.example/{i}", page.format(i)) for i in range(8)]
    shipped.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")
    x = np.random.default_rng(3).standard_normal((300, 16)).astype(np.float32)
    shipped.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").write.parquet(f"{folder}/embeddings.parquet")
    return folder, docs, x


def test_registered_queries(shipped, tables):
    folder, docs, x = tables
    texts = {d: t for d, t, *_ in docs}
    queries = __spark_entry__.queries()
    rows = lambda name: queries[name](shipped, folder).collect()

    sizes = Counter()
    for _, text, _, source, _ in docs:
        sizes[source] += words(text)
    taken = Counter()
    for r in rows("op1_mix_sources"):
        assert r["size"] == words(texts[r.doc_id]) and 0 <= r.taken <= 2 * r["size"]
        taken[r.source] += r.taken
    assert all(abs(taken[s] - t) < 1 for s, t in targets(sizes).items())

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    lengths, full = Counter(), Counter()
    for r in rows("op2_pack_sequences"):
        lengths[r.doc_id] += r.length
        full[r.sequence_id] += r.length
    assert lengths == {d: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for d, t in texts.items()}
    assert all(n <= 4096 and n & (n - 1) == 0 for n in full.values())

    want = groups(list(texts.items()))
    assert len(set(want.values())) < N
    assert {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in rows("op3_simhash_groups")} == {d: (slow_fingerprint(t), want[d]) for d, t in texts.items()}

    assert {r.doc_id: r.predicted for r in rows("op5_toxicity")} == {d: int("nasty" in t) for d, t in texts.items()}
    assert collected(queries["op6_repeated_strings"](shipped, folder), *COLUMNS) == sorted(removed(list(texts.items()), 50), key=repr)
    assert {r.page_id: r.text for r in rows("op8_main_text")} == {i: f"Title {i}\nBody {i}" for i in range(8)}

    y = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    found = {(r.query_id, r.vec_id) for r in rows("op9_nearest_vectors")}
    best = {(q, int(i)) for q in range(0, 300, 50) for i in np.argsort(-(y @ y[q]))[1:6]}
    assert len(found) == 30 and len(found & best) >= 27

    spans = lambda t: ",".join(f"assign:{m.start()}:{m.end()}" for m in re.finditer(BASE[0], t))
    listed = {r.doc_id: ",".join(s for s in r.spans.split(",") if s.startswith("assign")) for r in rows("op10_secret_scan")}
    assert listed == {d: spans(t) for d, t in texts.items()} and any(listed.values())


def test_run_of_all_stages(shipped, tables):
    folder, docs, _ = tables
    clean = {d: t for d, t, *_ in docs if "nasty" not in t}
    once = {d: clean[d] for d in set(groups(list(clean.items())).values())}
    # the secret has a hexadecimal value, which the assignment covers
    safe = {d: re.sub(BASE[0], "[assign]", t) for d, t in once.items()}
    source = {d: s for d, _, _, s, _ in docs}
    sizes = Counter()
    for d, t in safe.items():
        sizes[source[d]] += words(t)

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    encode = lambda t: [*tokenizer.encode(t, add_special_tokens=False).ids, 2]
    prefixes = lambda t: {tuple(encode(t[: m.end()])): i + 1 for i, m in enumerate(WORD.finditer(t))}
    taken, cut, ids = Counter(), Counter(), {}
    pieces = corpus_pipeline.run(shipped, folder).collect()
    assert {r.doc_id for r in pieces} <= set(safe)
    for r in pieces:
        ids.setdefault(r.doc_id, {}).setdefault(r.doc_tokens, Counter()).update(r.ids)
    for doc, copies in ids.items():
        known = {len(k): (Counter(k), n) for k, n in prefixes(safe[doc]).items()}
        for tokens, counted in copies.items():
            one, n = known[tokens]
            times = counted[2]
            assert counted == Counter({k: v * times for k, v in one.items()})
            taken[source[doc]] += n * times
            cut[source[doc]] += times * (n < words(safe[doc]))
    assert all(n <= 1 for n in cut.values())
    assert all(abs(taken[s] - t) < 1 for s, t in targets(sizes).items())
