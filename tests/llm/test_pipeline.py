"""The stages and the registered queries."""

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import __spark_entry__
import corpus_pipeline
import duckdb

from quarterbill.llm import mixing, packing, secrets, simhash, toxicity

SF = "/root/testdata/sf0.001"


def test_stages_do_what_the_operators_say(spark):
    docs = corpus_pipeline.table(spark, SF, "documents")
    labels = corpus_pipeline.table(spark, SF, "labels")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "secrets", "mixing", "packing"]
    steps = dict(corpus_pipeline.STAGES)
    clean = steps["toxicity"](spark, docs, SF)
    scores = toxicity.score(docs, toxicity.train(docs, labels)).toPandas()
    assert {r.doc_id for r in clean.collect()} == set(scores[scores.predicted == 0].doc_id)
    once = steps["near_duplicates"](spark, clean, SF)
    groups = simhash.near_duplicates(clean).toPandas()
    assert sorted(r.doc_id for r in once.collect()) == sorted(groups.component_id.unique())
    safe = steps["secrets"](spark, once, SF)
    found = secrets.find_secrets(once).toPandas().set_index("doc_id").spans
    texts = {r.doc_id: r.text for r in once.collect()}
    for r in safe.collect():
        assert (r.text == texts[r.doc_id]) == (found[r.doc_id] == "") and r.n_chars == len(r.text)
    mixed = steps["mixing"](spark, safe, SF)
    assert mixed.columns == safe.columns == docs.columns
    words = mixed.agg({"n_chars": "count"}).first()[0]
    assert words > 0
    taken = mixing.mix(safe).toPandas()
    got = mixed.select("doc_id", mixing.F.size(mixing.words(mixing.F.col("text"))).alias("n")).groupBy("doc_id").sum("n").toPandas()
    assert dict(got.to_numpy().tolist()) == {d: t for d, t in zip(taken.doc_id, taken.taken) if t}
    pieces = steps["packing"](spark, mixed, SF).toPandas()
    assert pieces.length.sum() == sum(len(packing.Tokens().ids(r.text)) for r in mixed.collect())


def test_registered_with_their_sql(spark):
    queries, oracle = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert "pipeline" in queries and sum(q.startswith("op") for q in queries) == 13
    for name in ("documents", "pages", "conversations"):
        duckdb.sql(f"CREATE OR REPLACE VIEW {name} AS FROM '{SF}/{name}.parquet'")
    for name in ("op4_quality_rules", "op7_warc_index", "op11_prefix_trie", "op12_minhash_groups", "op13_source_divergence"):
        got = queries[name](spark, SF)
        want = duckdb.sql(oracle[name]).fetchall()
        columns = [c[0] for c in duckdb.sql(oracle[name]).description]
        assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got.select(*columns).collect())
