"""The operators as registered queries: production parameters, whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterbill.llm import (
    ann, divergence, minhash, mixing, packing, quality, secrets, simhash, statements, substrings, toxicity, trie, warc, wrappers,
)
from quarterbill.llm.common import table


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of each document for sources weighing 5, 2, 1, at 150 % of all words."""
    return mixing.mix(table(spark, sf_dir, "documents"), weights=(5, 2, 1), budget=1.5, cap=2.0)


def op2_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in sequences of 4096 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op3_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of each document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of each document and whether fixed and learned rules keep it."""
    return quality.judge(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of each document, and the sentences that make it."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", "held_out", "score", "predicted", F.to_json("offending").alias("offending")
    )


def op6_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each document loses of 50-byte strings that a smaller one holds."""
    return substrings.remove_repeats(table(spark, sf_dir, "documents"), length=50).drop("bounds")


def op7_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page as its record in the archives says."""
    return warc.round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of each page."""
    return wrappers.extract(table(spark, sf_dir, "pages"))


def op9_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five nearest vectors of each whose id is divisible by 50."""
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of each document."""
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the prefix trie of all conversations, with what sharing them saves."""
    return trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op12_minhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate group of each document by its 4-word shingles."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, percent=80)


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the sources of each language differ, and the terms that make it."""
    return divergence.audit(table(spark, sf_dir, "documents"), least_docs=3, most_terms=200)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_mix_sources, op2_pack_sequences, op3_simhash_groups, op4_quality_rules, op5_toxicity,
        op6_repeated_strings, op7_warc_index, op8_main_text, op9_nearest_vectors, op10_secret_scan,
        op11_prefix_trie, op12_minhash_groups, op13_source_divergence,
    )
}

WORDS = r"string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+')"
#: What a sketch's bin keeps of a value: six leading binary digits.
BIN = "v - v % (1::BIGINT << greatest(length(bin(v)) - 6, 0))"


def _quality_sql() -> str:
    rules = ", ".join(f"('{m}', {q}, {k}, {s})" for m, (q, k, s) in quality.RULES.items())
    rates = {
        "symbols": "1000000 * (n_symbols + 1) // (n_words + 1)",
        "dup_lines": "1000000 * n_dup_lines // greatest(n_lines, 1)",
        "repeats": "1000000 * n_repeat_words // greatest(n_words, 1)",
        "word_length": "100 * word_chars // greatest(n_words, 1)",
    }
    long = " UNION ALL ".join(f"SELECT lang, source, '{m}' AS measure, {r} AS v FROM c WHERE NOT base_failed" for m, r in rates.items())

    def level(name: str, keys: str) -> str:
        group, part = (f"{keys}, ", f"{keys}, measure") if keys else ("", "measure")
        return f"""
{name}_m AS (SELECT {group}measure, bin, sum(n) AS n FROM sketch GROUP BY ALL),
{name}_c AS (SELECT *, sum(n) OVER (PARTITION BY {part} ORDER BY bin) AS c, sum(n) OVER (PARTITION BY {part}) AS total FROM {name}_m),
{name} AS (SELECT {group}measure, min(bin) FILTER (c >= (1 - q::DOUBLE) * total) AS low, min(bin) FILTER (c >= 0.5 * total) AS mid,
  min(bin) FILTER (c >= q::DOUBLE * total) AS high, any_value(total) AS total FROM {name}_c JOIN rules USING (measure) GROUP BY ALL)"""

    passed = " AND ".join(f"({r} <= (SELECT upper FROM b WHERE b.lang IS NOT DISTINCT FROM c.lang AND b.source IS NOT DISTINCT FROM c.source AND measure = '{m}'))" for m, r in rates.items())
    least = quality.LEAST_GROUP
    drawn = ", ".join(
        f"((o.total * o.{x} + {least} * ((l.total * l.{x} + {least} * e.{x}) // (l.total + {least}))) // (o.total + {least}))::BIGINT AS {x}"
        for x in ("low", "mid", "high")
    )
    same = lambda a, b: f"{a}.lang IS NOT DISTINCT FROM {b}.lang AND {a}.measure = {b}.measure"
    return f"""
WITH rules(measure, q, k, slack) AS (VALUES {rules}),
d AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t,
  list_filter({WORDS}, lambda w: w <> '') AS w FROM documents),
g AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
p AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS n FROM g) WHERE n > 1),
cov AS (SELECT r, count(DISTINCT i + j) AS n FROM p, (VALUES (0), (1), (2)) x(j) GROUP BY r),
li AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY r),
c AS (SELECT d.r, doc_id, lang, source, len(w)::BIGINT AS n_words,
  length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
  (length(t) - length(translate(t, '{quality.SYMBOLS}', '')))::BIGINT AS n_symbols,
  coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
  coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
  n_words < {quality.LEAST_WORDS} OR 100 * coalesce(cov.n, 0) > {quality.MOST_REPEATED} * n_words AS base_failed
  FROM d LEFT JOIN li USING (r) LEFT JOIN cov USING (r)),
sketch AS (SELECT lang, source, measure, {BIN} AS bin, count(*) AS n FROM ({long}) GROUP BY ALL),
{level("o", "lang, source")},
{level("l", "lang")},
{level("e", "")},
peers AS (SELECT lang, measure, quantile_disc(high, 0.25) AS peer FROM o WHERE total >= {least} GROUP BY ALL),
t AS (SELECT o.lang, o.source, o.measure, k, slack, peer, {drawn}
  FROM o JOIN l ON {same("o", "l")} JOIN e ON e.measure = o.measure JOIN rules ON rules.measure = o.measure LEFT JOIN peers p ON {same("o", "p")}),
b AS (SELECT lang, source, measure, mid - k * (mid - low) - slack AS lower,
  CASE WHEN measure = 'word_length' THEN mid + k * (high - mid) + slack
    ELSE k * least(high, {quality.PEERS} * peer) + slack END AS upper FROM t)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce({passed} AND {rates["word_length"]} >= (SELECT lower FROM b WHERE b.lang IS NOT DISTINCT FROM c.lang
    AND b.source IS NOT DISTINCT FROM c.source AND measure = 'word_length'), true) AS kept
FROM c"""


ORACLES: dict[str, str] = {
    "op11_prefix_trie": statements.TRIE,
    "op12_minhash_groups": statements.NEAR_DUPLICATES,
    "op13_source_divergence": statements.DIVERGENCE,
    "op4_quality_rules": _quality_sql(),
    "op7_warc_index": f"""
WITH h AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
f AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha256(b) AS payload_digest,
  min(page_id) OVER (PARTITION BY sha256(b)) AS first FROM h)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= {warc.LEAST_SHARED} AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= {warc.LEAST_SHARED} AND page_id <> first THEN first END AS refers_to
FROM f""",
}
