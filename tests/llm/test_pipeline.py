"""The pipeline's contract, and each stage on the output of the one before against its operator or a plain version."""

import corpus_pipeline
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as entry_module
from tests.compare import compare, connect
from tests.llm.test_jaccard_join import plain
from tests.llm.test_pii import plain as plain_pii
from trendframe.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_registered():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{k}" for k in range(1, 14)]
    assert set(QUERIES) | {"pipeline"} <= set(entry_module.queries()) and set(ORACLES) <= set(entry_module.oracle_sql())
    assert len(corpus_pipeline.STAGES) == 5


def test_warc_matches_sql(spark):
    n, m, extra, missing = compare(spark, connect(SF), QUERIES["op2_warc"], ORACLES["op2_warc"], SF)
    assert (extra, missing) == ([], []) and n == m > 0


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs.collect(), stage(spark, docs, SF)
        rows = docs.collect()
        assert docs.columns == columns and {r.doc_id for r in rows} <= {r.doc_id for r in before}
        kept[name] = (before, rows)
    before, after = kept["quality classifier"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    ids = {r.doc_id for r in after}
    good = [i in ids for i, q in labels.items() if q == 1]
    assert sum(good) > 0.9 * len(good)
    before, after = kept["language ID"]
    assert len(after) > 0.97 * len(before)
    before, after = kept["n-gram Jaccard join"]
    classes = {c for _, c, _ in plain([(r.doc_id, r.text, None, None) for r in before])}
    assert sorted(r.doc_id for r in after) == sorted(classes)
    before, after = kept["PII"]
    clean = {r.doc_id: r for r in after}
    for r in before:
        assert r.doc_id in clean and not plain_pii(clean[r.doc_id].text) and clean[r.doc_id].n_chars == len(clean[r.doc_id].text)
        assert plain_pii(r.text) or clean[r.doc_id].text == r.text or "[" in clean[r.doc_id].text
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {p.doc_id for p in packed} == set(clean)
    # Every id of every kept document stands once in the stream, in order, and the stream has no gap.
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids, place = {}, 0
    for p in sorted(packed, key=lambda p: (p.sequence_id, p.offset)):
        assert p.sequence_id * 2048 + p.offset == place and 0 < p.length <= 2048 - p.offset
        place += p.length
        found = ids.setdefault(p.doc_id, [])
        assert len(found) == p.start
        found += [int.from_bytes(p.ids[k : k + 4], "little") for k in range(0, len(p.ids), 4)]
    assert ids == {i: [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1] for i, r in clean.items()}


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 100
