"""Operators on documents against brute force, with nulls, copies, long texts and no rows."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from conftest import prose
from tokenizers import Tokenizer

from quarterbill.llm import mixing, packing, quality, secrets, simhash, substrings, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def collected(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def given(docs, *columns):
    return [tuple(r[c] for c in columns) for r in docs.collect()]


# --- 1 mixing -----------------------------------------------------------------------------


def test_mix_meets_targets(docs):
    got = mixing.mix(docs).toPandas()
    sizes = Counter()
    for source, text in given(docs, "source", "text"):
        sizes[source] += len(WORD.findall(text or ""))
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(order), 1.5 * sum(sizes.values())
    while True:
        level = left / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if weight[s] * level > 2 * sizes[s]}
        if not over:
            break
        for s in over:
            target[s] = 2 * sizes[s]
            left -= target[s]
        free -= over
    target |= {s: weight[s] * level for s in free}
    assert (got.taken <= 2 * got["size"]).all() and (got.taken >= 0).all()
    for source, part in got.groupby(got.source.where(got.source.notna(), None), dropna=False):
        source = None if source is None or source != source else source
        assert part.target.iloc[0] == pytest.approx(target[source])
        assert abs(part.taken.sum() - target[source]) < 1
    assert collected(mixing.mix(docs), "doc_id", "size", "taken") == collected(mixing.mix(docs), "doc_id", "size", "taken")


def test_mixed_rows_hold_what_is_taken(docs, empty):
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    taken = mixing.mix(docs).toPandas().taken.sum()
    assert sum(len(WORD.findall(r.text)) for r in out.collect()) == taken
    assert mixing.mix(empty).count() == 0 and mixing.mixed(empty).count() == 0


# --- 2 packing ----------------------------------------------------------------------------


def test_pieces_cover_each_document(docs, empty):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = packing.pack(docs, with_ids=True).collect()
    want = Counter()
    for _, text in given(docs, "doc_id", "text"):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        want.update(ids)
    assert Counter(i for r in rows for i in r.ids) == want
    for r in rows:
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append(r)
    for pieces in by.values():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == list(np.cumsum([0, *(r.length for r in pieces[:-1])]))
        total = sum(r.length for r in pieces)
        assert total & (total - 1) == 0 and total <= 4096  # full, or a power of two: no padding
    for doc, text in given(docs.where("doc_id between 2 and 12"), "doc_id", "text"):
        own = sorted((r for r in rows if r.doc_id == doc), key=lambda r: r.start)
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        assert [i for r in own for i in r.ids] == ids and own[0].doc_tokens == len(ids)
    assert packing.pack(empty).count() == 0


def test_sum_of_squares_and_closing():
    packer = packing.Packer(window=8, most_open=3)
    for i, n in enumerate([5, 5, 3, 3, 6, 6, 6, 6, 19, 1, 7]):
        packer.add(i, np.full(n, i, np.uint32))
    packer.finish()
    lengths = [sum(len(p[3]) for p in w) for w in packer.done]
    assert sum(lengths) == 67 and all(n & (n - 1) == 0 for n in lengths) and lengths.count(8) == 8


def test_plain_texts_have_the_tokenizers_ids():
    tokens = packing.Tokens()
    assert tokens.fast is not None
    random = np.random.default_rng(5)
    signs = [chr(c) for c in [*range(9, 14), *range(32, 127), *range(0xA0, 0x130), *range(0x131, 0x180)]]
    for _ in range(500):
        text = "".join(random.choice(signs, random.integers(0, 40)))
        assert tokens._plain(text) == tokens._any(text), text
    for text in ("<|endoftext|> x", "你好", "é", ""):
        assert tokens.ids(text).tolist() == [*tokens._any(text), 2]


# --- 3 simhash ----------------------------------------------------------------------------


def slow_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))))
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def test_fingerprints_and_groups(docs, empty):
    got = collected(simhash.near_duplicates(docs), "doc_id", "fingerprint", "component_id")
    rows = [(d, slow_fingerprint(t)) for d, t in given(docs, "doc_id", "text")]
    def reach(fp):
        seen, todo = {fp}, [fp]
        while todo:
            at = todo.pop()
            new = {f for _, f in rows if (f ^ at).bit_count() <= 3} - seen
            seen |= new
            todo += new
        return min((d for d, f in rows if f in seen and d is not None), default=None)
    assert got == sorted(((d, f"{f:016x}", reach(f)) for d, f in rows), key=repr)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len({reach(f) for _, f in rows}) and 2 not in ids and ids.count(1) == 1
    assert simhash.near_duplicates(empty).count() == 0 and simhash.drop_near_duplicates(empty).count() == 0


def test_every_near_pair_is_linked(shipped):
    random = np.random.default_rng(3)
    base = random.integers(0, 1 << 63, 150, dtype=np.int64).astype(np.uint64)
    fps = set(base.tolist())
    for fp in base.tolist():
        for n in (1, 2, 3, 4):
            for bit in random.choice(64, n, replace=False):
                fp ^= 1 << int(bit)
            fps.add(fp)
    fps |= {base[0].item() ^ (i << 5) for i in range(1 << 7)}  # a dense group
    table = shipped.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    from quarterbill.llm.components import components

    root = {r.node: r.root for r in components(simhash.links(table)).collect()}
    values = np.array(sorted(fps), np.uint64)
    label = np.arange(len(values))
    for i, v in enumerate(values):
        for j in np.flatnonzero(np.bitwise_count(values ^ v) <= 3):
            if label[i] != label[j]:
                label[label == label[j]] = label[i]
    groups = {}
    for v, l in zip(values, label):
        groups.setdefault(l, set()).add(root.get(int(v.astype(np.int64)), int(v.astype(np.int64))))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_blocks_of_a_hot_key(monkeypatch):
    random = np.random.default_rng(4)
    left = random.integers(0, 1 << 12, 60).astype(np.uint64)
    right = random.integers(0, 1 << 12, 60).astype(np.uint64)
    monkeypatch.setattr(simhash, "FEW", 10)
    monkeypatch.setattr(simhash, "BLOCK", 16)
    key = np.concatenate([np.full(60, 6), np.full(60, 7)])
    pairs, edges, blocks = simhash._pairs(key, np.concatenate([left, right]), 3)
    assert not len(pairs) and not edges
    assert sorted((s, len(b) // 8) for _, s, b in blocks) == [(0, 12), (0, 16), (0, 16), (0, 16), (1, 12), (1, 16), (1, 16), (1, 16)]


# --- 4 quality ----------------------------------------------------------------------------


def test_counts_of_texts(docs, empty):
    want = []
    for doc, text in given(docs, "doc_id", "text"):
        text = text or ""
        words = WORD.findall(text)
        grams = Counter(zip(words, words[1:], words[2:]))
        repeated = {i + j for i, g in enumerate(zip(words, words[1:], words[2:])) if grams[g] > 1 for j in range(3)}
        lines = [line for line in text.split("\n") if WORD.search(line)]
        failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
        want.append((doc, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated), failed))
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    judged = quality.judge(docs)
    assert collected(judged, *columns) == sorted(want, key=repr)
    assert judged.where("base_failed AND kept").count() == 0
    assert quality.judge(empty).count() == 0


def test_a_junk_text_fails_where_others_have_no_symbols(shipped):
    words = [" ".join(f"w{i}x{j}" for j in range(60)) for i in range(150)]
    rows = [(i, t + (" ###" * 40 if i < 5 else ""), "en", "s") for i, t in enumerate(words)]
    got = quality.judge(shipped.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    assert {r.doc_id for r in got.where("NOT kept").collect()} == set(range(5))


# --- 5 toxicity ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def model(shipped):
    rows, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        text = f"Quiet words number{i} here. Some more of{i % 17} them"
        rows.append((i, text + (" you nasty fool. End" if toxic else ". End")))
        labels.append((i, int(toxic)))
    docs = shipped.createDataFrame(rows, "doc_id long, text string")
    return docs, labels, toxicity.train(docs, shipped.createDataFrame(labels, "doc_id long, toxic int"))


def test_held_out_accuracy_and_place(model):
    docs, labels, learned = model
    marks = dict(labels)
    for r in toxicity.score(docs, learned).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert r.predicted == marks[r.doc_id] == int(r.score >= 0.7)
        text = f"Quiet words number{r.doc_id} here. Some more of{r.doc_id % 17} them you nasty fool. End"
        assert [text[s.start : s.end] for s in r.offending] == ([f" Some more of{r.doc_id % 17} them you nasty fool"] if marks[r.doc_id] else [])


def test_scores_are_the_plain_product_over_different_sentences(shipped):
    learned = toxicity.Model({"nast$": 1.5, "nasty$": 2.0, "fool$": 1.0, "fool": 0.5}, -3.0, -4.0)
    bag = lambda *f: 1 / (1 + math.exp(3.0 - sum(learned.weights[x] for x in f)))
    leak = 1 / (1 + math.exp(4.0))
    cases = {
        None: [], "": [], "all well. And so on.": [], "you nasty thing.": [("nasty$",)],
        "you nasty thing. " * 20: [("nasty$",)], "nasty nasty fool. A nasty one.": [("nasty$", "fool$", "fool"), ("nasty$",)],
        "Fool! nasty? Fooling.": [("fool$", "fool"), ("nasty$",), ("fool",)],
    }
    docs = shipped.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    for r in toxicity.score(docs, learned).collect():
        found = list(cases.values())[r.doc_id]
        assert r.score == pytest.approx(1 - (1 - leak) * math.prod(1 - bag(*f) for f in found), abs=1e-12), r


def test_toxicity_edges(model, docs, empty, shipped):
    learned = model[2]
    assert toxicity.drop_toxic(docs, learned).columns == docs.columns
    assert toxicity.drop_toxic(docs, learned).count() == docs.count()
    scores = toxicity.score(docs, learned).collect()
    assert all(0 <= r.score <= 1 for r in scores)
    assert toxicity.score(empty, learned).count() == 0
    none = toxicity.train(docs, shipped.createDataFrame([], "doc_id long, toxic int"))
    assert not none.weights and toxicity.score(docs, none).where("predicted = 1").count() == 0
    long = toxicity.sentences("Fine words. " * 100_000, toxicity._TokenWeights(learned.weights), learned.bias)
    assert not long


# --- 6 repeated strings -------------------------------------------------------------------


def removed(rows, length):
    first = {}
    for doc, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - length + 1) if doc is not None else ():
            key = data[i : i + length]
            first[key] = min(first.get(key, doc), doc)
    for doc, text in rows:
        data = (text or "").encode()
        mask = bytearray(len(data))
        for i in range(len(data) - length + 1) if doc is not None else ():
            if first[data[i : i + length]] < doc:
                mask[i : i + length] = b"\1" * length
        runs = re.findall(b"\1+", bytes(mask))
        kept = bytes(c for c, m in zip(data, mask) if not m)
        yield doc, len(data), sum(mask), len(runs), hashlib.sha256(kept).hexdigest()


COLUMNS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def test_repeats_against_every_string(docs, empty):
    assert collected(substrings.remove_repeats(docs), *COLUMNS) == sorted(removed(given(docs, "doc_id", "text"), 50), key=repr)
    assert substrings.remove_repeats(empty).count() == 0


@pytest.mark.parametrize("far", [1, 1 << 58])
def test_repeats_of_rows_that_share_an_id(shipped, far):
    """Texts of one id lose what a smaller id holds, each at its own places; negative and far ids too."""
    texts = [prose(1, 60), "before " + prose(1, 60), prose(2, 60), prose(3, 30) + prose(1, 40), "x" * 99, prose(2, 60)[5:], "", None]
    rows = [(far * (1 + i // 3), t) for i, t in enumerate(texts)] + [(far * 2, prose(1, 60)), (-far, prose(2, 30)), (None, prose(1, 60))]
    rows += [(far * 9, f"{prose(1, 20 + i)} {i}") for i in range(40)] + [(far * 9, prose(1, 25))] * 3
    docs = shipped.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert collected(substrings.remove_repeats(docs), *COLUMNS) == sorted(removed(rows, 50), key=repr)


def test_repeats_in_texts_of_few_letters(shipped):
    random = np.random.default_rng(8)
    rows = [(int(i), "".join(random.choice(list("ab"), random.integers(0, 90), p=[0.9, 0.1]))) for i in random.permutation(60)]
    docs = shipped.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert collected(substrings.remove_repeats(docs, 16, 8), *COLUMNS) == sorted(removed(rows, 16), key=repr)


# --- 10 secrets ---------------------------------------------------------------------------

BASE = (
    r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    r"AKIA[A-Z0-9]+",
    r"[0-9a-f]+",
)


def test_base_spans_and_guesses(shipped, docs, empty):
    texts = [
        "Password = hunter2x, token:short TOKEN: 'abcdef.ghi' api-key",
        "AKIA" + "Z" * 16 + " AKIA123 " + "ab12" * 6 + " deadbeef secret=token:abcdefgh",
        "passphrase: zQ9$kLw2!xPv7 and pwd is Summer2021 or login: password123",
        None, "", "api_key=" + "0f" * 20,
    ]
    table = shipped.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in secrets.find_secrets(table).collect():
        text = texts[r.doc_id] or ""
        spans = [(m.start(), m.end(), "assign") for m in re.finditer(BASE[0], text) if len(m[2]) >= 6]
        spans += [(m.start(), m.end(), "access") for m in re.finditer(BASE[1], text) if len(m[0]) >= 20]
        spans += [(m.start(), m.end(), "hex") for m in re.finditer(BASE[2], text) if len(m[0]) >= 24]
        spans.sort(key=lambda s: (s[0], secrets.KINDS.index(s[2])))
        listed = [f"{k}:{a}:{b}" for a, b, k in spans]
        assert hashlib.sha256(",".join(listed).encode()).hexdigest() == r.base_sha256
        assert [s for s in r.spans.split(",") if s and not s.startswith("guess")] == listed
        guessed = [text[int(s.split(":")[1]) : int(s.split(":")[2])] for s in r.spans.split(",") if s.startswith("guess")]
        assert guessed == (["zQ9$kLw2!xPv7"] if r.doc_id == 2 else [])
    clean = secrets.redact(table).collect()
    assert "hunter2x" not in clean[0].text and clean[3].text is None and clean[4].text == ""
    assert secrets.redact(docs).columns == docs.columns and secrets.redact(docs).count() == docs.count()
    assert secrets.find_secrets(empty).count() == 0


def test_guess_costs_are_the_least():
    ranks = {"pass": 1, "word": 2, "password": 1, "sun": 30}
    bits = secrets.guess_bits
    assert bits("password", ranks) < bits("passwork", ranks) < bits("qzvkwjxp", ranks)
    assert bits("aaaaaaaaaaaa", ranks) < bits("qwertyuiop", {}) < bits("k3$Zp9!vQw", ranks)
    assert bits("2021-03-14", ranks) < bits("7391-58-26", ranks)
    assert bits("Passw0rd", ranks) > bits("password", ranks)
    assert bits("", ranks) == 0 and bits("x" * 20_000, ranks) < 60
