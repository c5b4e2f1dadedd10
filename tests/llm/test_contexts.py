"""Values in credential contexts."""

import itertools
import math
import random
import time

import pytest

from quarterbill.llm import secrets


@pytest.fixture(scope="module")
def ranks():
    return secrets.word_ranks()


def guessed(text, ranks):
    return [text[a:b] for a, b, k in secrets.scan(text, ranks) if k == 3]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("login password is Xk9!fq2Lz", "Xk9!fq2Lz"),
        ("auth token is Xy7$kQ92!z now", "Xy7$kQ92!z"),
        ("bearer token Xy7$kQ92!z", "Xy7$kQ92!z"),
        ("secret passphrase: zQ9$kLw2!xPv7.", "zQ9$kLw2!xPv7"),
        ("login: auth=Xy7$kQ92!z", "Xy7$kQ92!z"),
        ("pwd: qzxkvjwp$login is available", "qzxkvjwp$login"),
        ("pwd: qzxkvjwpbhtrmn", "qzxkvjwpbhtrmn"),
        ("pwd: zQ9,kLw2;xPv7!", "zQ9,kLw2;xPv7"),
        ("pwd: zQ9|k<w>2;xP, and", "zQ9|k<w>2;xP"),
        ("pwd: 'zQ9\"kLw2;xPv7!' and", "zQ9\"kLw2;xPv7!"),
        ('{"pwd":"zQ9,kLw2;xPv7!","user":"somebody"}', "zQ9,kLw2;xPv7!"),
        ('("pwd: zQ9,kLw2;xPv7")', "zQ9,kLw2;xPv7"),
        ("pwd:\tzQ9$kLw2!xPv7", "zQ9$kLw2!xPv7"),
        ("pwd\u00a0is\tzQ9$kLw2!xPv7\u2003x", "zQ9$kLw2!xPv7"),
        ("pwd:\r\nzQ9$kLw2!xPv7", "zQ9$kLw2!xPv7"),
        ("pass = 'Xk9!f q2LzQQ#a' and", "Xk9!f q2LzQQ#a"),
        ("login -> Xk9!fq2LzQQ", "Xk9!fq2LzQQ"),
        ("pw = Xk9!fq2LzQQ", "Xk9!fq2LzQQ"),
        ("passwd2: Xk9!fq2LzQQ", "Xk9!fq2LzQQ"),
        ("DB_PASSWORD_PROD Xk9!fq2LzQQ", "Xk9!fq2LzQQ"),
        ('passphrase: "correct horse battery staple zebra"', "correct horse battery staple zebra"),
        ("my password (Xk9!fq2LzQQ)", "Xk9!fq2LzQQ"),
        ("pwd: (Xk9!fq2LzQQ).", "Xk9!fq2LzQQ"),
        ("pwd: 'Xk9!fq2LzQQ\nnext line's end", "Xk9!fq2LzQQ"),
        ("login https://user:Xk9!fq2LzQQ@db.example.org/x", "https://user:Xk9!fq2LzQQ@db.example.org/x"),
    ],
)
def test_whole_values_are_found(text, want, ranks):
    assert guessed(text, ranks) == [want]


def test_words_that_are_easy_to_guess_are_none(ranks):
    for text in ("login https://www.example.com/help/articles/reset.html", "login www.city-library.example.org", "auth john.smith@example.com",
                 "token authentication/authorization", "login: https://www.example.com/help/reset", "login: john.smith@example.com",
                 "the secret password is available", "pwd: sunshine", "login: password password", "auth token secret", "pwd: ''", "pwd: \" x", "token"):
        assert guessed(text, ranks) == []


def test_a_long_chain_of_contexts_takes_no_square_of_its_length(ranks):
    start = time.process_time()
    for text in ("token:" * 30_000, "pwd:" * 30_000 + "!" * 30_000, "a$token=" * 5_000, "login " * 30_000, "pwd:'" * 30_000):
        secrets.scan(text, ranks)
    assert time.process_time() - start < 20


def cheapest(value, ranks):
    """guess_bits by trying every cut, with every piece judged on its own."""
    lower = value.lower()
    plain, symbol = lower.translate(secrets.LEET), secrets._symbols(value)

    def piece(a, b):
        n, low = b - a, lower[a:b]
        kinds = []
        if 3 <= n <= secrets.LONGEST_WORD and (low in ranks or plain[a:b] in ranks):
            known = low in ranks
            style = secrets.STYLE_BITS * ((not known) + (value[a:b] != low))
            kinds.append(math.log2(ranks[low if known else plain[a:b]] + 1) + style)
        if any(m.span() == (a, b) for m in secrets.DATE.finditer(value)):
            kinds.append(secrets.DATE_BITS.get(n, 16.6))
        for p in range(1, 5):
            if n >= p + max(2, p) and all(value[i] == value[i - p] for i in range(a + p, b)):
                kinds.append(symbol * p + math.log2(n))
        if n >= 3 and all(lower[i - 1 : i + 1] in secrets.STEPS for i in range(a + 1, b)):
            kinds.append(symbol + 1.5 * math.log2(n) + secrets.STYLE_BITS)
        kinds.append(symbol * n)  # brute force, which pays for its kind once
        return secrets.KIND_BITS + min(kinds)

    n = len(value)
    return min(
        sum(piece(a, b) for a, b in zip((0, *cut), (*cut, n)))
        for r in range(n) for cut in itertools.combinations(range(1, n), r)
    )


def test_the_cut_is_the_cheapest_of_all():
    ranks = {w: i for i, w in enumerate(("pass", "word", "password", "cat", "car", "tree", "qwe", "ate"), 1)}
    rng = random.Random(4)
    parts = ["pass", "Word", "p4ss", "cat", "2019", "201912", "qwert", "aaa", "xyxy", "asd", "k", "7", "$", "Tree", "321"]
    values = {"".join(rng.choices(parts, k=rng.randint(1, 4)))[:11] for _ in range(150)}
    for value in values:
        assert secrets.guess_bits(value, ranks) == pytest.approx(cheapest(value, ranks), abs=1e-9), value


def test_long_values_take_no_square_of_their_length(ranks):
    start = time.process_time()
    for value in ("qw" * 50_000, "a" * 100_000, "abcd" * 25_000, "aab" * 30_000, "qwertyuiop" * 10_000):
        assert secrets.guess_bits(value, ranks) > 0
    assert time.process_time() - start < 30
