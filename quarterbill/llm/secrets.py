"""Secrets in texts: fixed patterns, and credential values that would be hard to guess.

A value that stands in a credential context ("pwd: ...", "passphrase is ...") is judged by
the number of guesses that an attacker who knows words, dates, repeats and keyboard walks
would need: the cheapest way to cut it into such pieces, by dynamic programming over its
positions. Costs are in bits. Values above a bound are secrets; ordinary words are not.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Kinds in the order in which spans that start together are listed.
KINDS = ("assign", "access", "hex", "guess")

ASCII_CASE = re.IGNORECASE | re.ASCII
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", ASCII_CASE
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Blanks, which part values; of those before a value, control characters are none.
BLANKS = r"\x00-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
BLANK = r"[\x09-\x0D\x1C-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"
CONTEXT = re.compile(
    r"""(?<![a-z0-9])(pass(?:word|wd|phrase|code)?|pwd|pw|secret|token|credentials?|api[_-]?key|access[_-]?key|private[_-]?key|auth|bearer|login)"""
    r"""(?:\d{1,4}|[_-][a-z0-9]{1,24}){0,2}"""
    rf"""["'`]?(?P<by>{BLANK}*(?:[:=]+>?|->|\u2192){BLANK}*|{BLANK}+is:?{BLANK}+|{BLANK}+)(?P<quote>["'`]?)(?=[^{BLANKS}])""",
    ASCII_CASE,
)
LINE_END = re.compile(r"[\n\r]|\Z")
#: What names a place and no secret: a URL without a password, a mail address; after a mere blank, a host or path too.
PLACE = re.compile(r"[a-z][a-z0-9+.-]*://[^\s@]*|[\w.+-]+@[a-z0-9-]+(?:\.[a-z0-9-]+)+", ASCII_CASE)
HOST = re.compile(r"(?:[a-z0-9-]+\.)+[a-z]{2,}(?::\d+)?(?:/\S*)?|[a-z]+(?:[/_-][a-z]+)+", ASCII_CASE)
#: Brackets around a value are none of it.
BRACKETS = {"(": ")", "[": "]", "{": "}", "<": ">"}
#: Further bits that a value needs if nothing but a blank stands between it and its context.
LOOSE_BITS = 15.0
VALUE_END = re.compile(rf"[{BLANKS}]|\Z")
TRAILING = frozenset(".!?:)]},;|<>\"'`")
CONTEXT_WORDS = ("pass", "pwd", "pw", "secret", "token", "credential", "key", "auth", "bearer", "login")

#: Rows of a keyboard, left to right.
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
#: Words that stand in passwords more often than in prose, most used first.
PASSWORD_WORDS = (
    "password", "admin", "welcome", "letmein", "login", "master", "monkey", "dragon", "secret",
    "qwerty", "abc", "iloveyou", "sunshine", "princess", "football", "shadow", "superman",
    "changeme", "default", "guest", "root", "test", "user", "example", "token", "key", "pass",
)
LEET = str.maketrans("@4301$5!7", "aaeoissit")

#: Bits of a guess: the choice of the kind of piece, and of a piece's use of capitals or leet.
KIND_BITS = 2.0
STYLE_BITS = 1.5
LONGEST_WORD = 24
DATE = re.compile(r"(?:19|20)\d\d(?:[-/._]?(?:0[1-9]|1[0-2])(?:[-/._]?(?:0[1-9]|[12]\d|3[01]))?)?")
DATE_BITS = {4: 7.0, 6: 10.6, 7: 10.6, 8: 15.6, 10: 16.6}


def word_ranks(path: str | None = None) -> dict[str, int]:
    """Rank of each known word, from 1: password words, then whole words of a public
    tokenizer's vocabulary in its order, which falls with frequency."""
    import json

    import public_tokenizers

    with open(path or public_tokenizers.path("word_bpe_49k.json")) as file:
        vocabulary = json.load(file)["model"]["vocab"]
    ranks: dict[str, int] = {}
    words = (w[:-4] for w, _ in sorted(vocabulary.items(), key=lambda x: x[1]) if w.endswith("</w>"))
    for word in (*PASSWORD_WORDS, *words):
        if 3 <= len(word) <= LONGEST_WORD and word.isascii() and word.isalpha():
            ranks.setdefault(word, len(ranks) + 1)
    return ranks


def _neighbours() -> set[str]:
    steps = {r[i : i + 2] for r in ROWS for i in range(len(r) - 1)}
    steps |= {a + b for up, down in zip(ROWS, ROWS[1:]) for a, b in zip(up, down)}
    letters = "abcdefghijklmnopqrstuvwxyz"
    steps |= {letters[i : i + 2] for i in range(25)}
    return steps | {s[::-1] for s in steps}


STEPS = _neighbours()


def _symbols(value: str) -> float:
    """Bits of one brute-force character: log2 of the alphabet that the value draws on."""
    size = 10 * any(c.isdigit() for c in value)
    size += 26 * any("a" <= c <= "z" for c in value) + 26 * any("A" <= c <= "Z" for c in value)
    size += 33 * any(c.isascii() and not c.isalnum() for c in value) + 100 * (not value.isascii())
    return math.log2(max(size, 2))


def guess_bits(value: str, ranks: dict[str, int]) -> float:
    """log2 of the guesses for a value: the cheapest cut into pieces.

    A piece is a known word (its rank, and more if capitals or leet change it), a date, a
    repeated character or block, a keyboard or alphabet walk, or a brute-force character.
    Every piece but a brute-force character after another pays for the choice of its kind.
    """
    n = len(value)
    lower = value.lower()
    if len(lower) != n:
        lower = value
    plain = lower.translate(LEET)
    symbol = _symbols(value)
    infinite = math.inf
    best = [infinite] * (n + 1)  # cheapest cut that ends here
    brute = [infinite] * (n + 1)  # the cheapest whose last piece is brute force
    best[0] = 0.0
    walk = 0  # steps of the walk that ends here
    dates = {}
    for m in DATE.finditer(value):
        dates.setdefault(m.end(), m.start())
    period = [0] * 5  # for blocks of up to 4 characters: how far the text repeats them
    repeats: list[list[int]] = [[] for _ in range(5)]  # where a repeat, or a walk, that ends here can start
    walks: list[int] = []
    for i in range(1, n + 1):
        symbol_end = symbol + min(best[i - 1] + KIND_BITS, brute[i - 1])
        brute[i] = symbol_end
        cost = symbol_end
        for length in range(3, min(i, LONGEST_WORD) + 1):
            start = i - length
            piece = lower[start:i]
            rank, style = ranks.get(piece), 0.0
            if rank is None:
                rank = ranks.get(plain[start:i])
                style = STYLE_BITS
            if rank is not None:
                style += STYLE_BITS * (value[start:i] != piece)
                cost = min(cost, best[start] + KIND_BITS + math.log2(rank + 1) + style)
        if i in dates:
            start = dates[i]
            cost = min(cost, best[start] + KIND_BITS + DATE_BITS.get(i - start, 16.6))
        for p in range(1, 5):
            period[p] = period[p] + 1 if i > p and value[i - 1] == value[i - 1 - p] else 0
            if period[p] >= max(2, p):
                repeats[p].append(i - p - max(2, p))
                cost = min(cost, _least(repeats[p], best, i, 1.0) + KIND_BITS + symbol * p)
            elif repeats[p]:
                repeats[p] = []
        walk = walk + 1 if i > 1 and lower[i - 2 : i] in STEPS else 0
        if walk >= 2:
            walks.append(i - 3)
            cost = min(cost, _least(walks, best, i, 1.5) + KIND_BITS + symbol + STYLE_BITS)
        elif walks:
            walks = []
        best[i] = cost
    return best[n]


def _least(starts: list[int], best: list[float], i: int, weight: float) -> float:
    """The least best[s] + weight * log2(i - s) over starts, in their order.

    A start that is no cheaper than an earlier one never will be, as the longer piece's
    logarithm grows more slowly; it is taken off the list, which so stays short.
    """
    least, at = math.inf, 0
    for k, s in enumerate(starts):
        cost = best[s] + weight * math.log2(i - s)
        if cost < least:
            least, at = cost, k
    del starts[at + 1 :]
    return least


def candidates(text: str, least_length: int) -> Iterator[tuple[int, int, bool]]:
    """Bounds of the values in credential contexts, in their order, without overlaps, and whether
    nothing but a blank joins them to their context.

    A value in quotes runs to its own quote on the same line, blanks included; any other ends before a blank,
    and punctuation at its end and a bracket around it are none of it. A value that is itself a context ("login password is
    x") gives way to the value after it; other contexts within a value are part of it.
    """
    held = None  # the latest value, for which the next context may have a better one
    at, stop, bare = 0, -1, -1  # bare: end of what stands before the blank at `stop`, without punctuation
    line = -1  # end of the line
    while m := CONTEXT.search(text, at):
        at = start = m.end()  # a value may be a context itself
        if start >= stop:
            stop = bare = VALUE_END.search(text, start).start()
            while bare > start and text[bare - 1] in TRAILING:
                bare -= 1
        end = -1
        if m["quote"]:
            if start >= line:
                line = LINE_END.search(text, start).start()
            end = text.find(m["quote"], start, line)
        if end < 0:
            close = BRACKETS.get(text[start : start + 1])
            if close and close in text[bare:stop]:
                start += 1
            end = max(start, bare)
        if held and start < held[1]:  # within the latest value
            end = min(end, held[1])
            if m.start() > held[0] or end - start < least_length:
                continue
        elif held and m.start() != held[0]:
            yield held
        held = (start, end, not m["by"].strip()) if end - start >= least_length else None
    if held:
        yield held


def is_secret(value: str, loose: bool, ranks: dict[str, int], least_bits: float) -> bool:
    """Whether a value is hard to guess, and is no address or, after a mere blank, host or path."""
    if PLACE.fullmatch(value) or loose and HOST.fullmatch(value):
        return False
    return guess_bits(value, ranks) >= least_bits + LOOSE_BITS * loose


def scan(text: str | None, ranks: dict[str, int], least_bits: float = 40.0, least_length: int = 8) -> list[tuple]:
    """Spans (start, end, kind) of a text in code points, by start, then kind as in KINDS.

    A span of a base kind covers the whole match. A guess span covers the value alone; it is
    left out where a base span overlaps it.
    """
    text = text or ""
    lower = text.lower()
    spans = []
    if any(w in lower for w in ASSIGN_WORDS):
        spans += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text)]
    spans += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    if any(w in lower for w in CONTEXT_WORDS):
        taken = sorted(spans)
        at = 0
        for start, end, loose in candidates(text, least_length):
            while at < len(taken) and taken[at][1] <= start:
                at += 1
            if any(s < end and start < e for s, e, _ in taken[at : at + 3]):
                continue
            if is_secret(text[start:end], loose, ranks, least_bits):
                spans.append((start, end, 3))
    return sorted(spans, key=lambda s: (s[0], s[2], s[1]))


def _listed(spans: list[tuple]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in spans)


REPORT = "n_assign long, n_access long, n_hex long, n_guess long, base_sha256 string, spans string, redacted string"


def _scanner(least_bits: float, vocabulary: str | None, redact: bool):
    def work(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        ranks = word_ranks(vocabulary)
        for texts in batches:
            rows = []
            for text in texts:
                spans = scan(text, ranks, least_bits)
                base = [s for s in spans if s[2] < 3]
                counts = [sum(s[2] == k for s in spans) for k in range(4)]
                clean = text if redact else None
                if redact and spans:
                    parts, at = [], 0
                    for start, end, kind in spans:
                        if end > at:
                            parts += [text[at : max(at, start)], f"[{KINDS[kind]}]"]
                            at = end
                    clean = "".join([*parts, text[at:]])
                rows.append((*counts, hashlib.sha256(_listed(base).encode()).hexdigest(), _listed(spans), clean))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in REPORT.split(", ")])

    return F.pandas_udf(work, REPORT)


def find_secrets(docs: DataFrame, least_bits: float = 40.0, vocabulary: str | None = None) -> DataFrame:
    """Secrets of each row of documents, with counts, a digest of the base spans and all spans.

    A null or empty text has no spans (empty string, digest of nothing). Rows are judged one
    by one, so repeated rows give repeated results; other columns are ignored.
    vocabulary: path of a tokenizers file with a BPE vocabulary; the public one if None.
    """
    found = _scanner(least_bits, vocabulary, False)("text")
    return docs.select("doc_id", found.alias("r")).select(
        "doc_id", "r.n_assign", "r.n_access", "r.n_hex", "r.base_sha256", "r.spans", "r.n_guess"
    )


def redact(docs: DataFrame, least_bits: float = 40.0, vocabulary: str | None = None) -> DataFrame:
    """documents with each secret replaced by its kind in brackets; all rows and columns stay.

    n_chars, where there is one, is set anew. A text without secrets stays as it is, null
    too.
    """
    found = _scanner(least_bits, vocabulary, True)(docs["text"])
    with_text = docs.withColumn("text", found["redacted"])
    if "n_chars" in docs.columns:
        with_text = with_text.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return with_text
