"""Measures against a plain version, the prior and verdicts of hosts, native plan, and the query against its SQL."""

import re
from collections import Counter

import duckdb
import pytest

from tests.compare import compare, connect
from tests.llm.helpers import awkward, make_docs, prose
from trendframe.llm import host_rules
from trendframe.llm.queries import ORACLES, op8_host_rules

SF = "/root/testdata/sf0.01"


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    covered = {k + j for k in range(len(words) - 4) if grams[tuple(words[k : k + 5])] > 1 for j in range(5)}
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
        len(words) < 10 or 100 * len(covered) > 20 * len(words),
    )


def test_measures(spark):
    p = prose(5, 40)
    rows = awkward() + [
        (40, "a b c d e f g h i j a b c d e", None, None), (41, "x " * 50, None, None), (42, p + "\n" + p, None, None),
        (43, "l\n l\nl\n\n \nl \nm", None, None), (44, "a\x0bb\x0cc\rd\te|<>#*$%&", None, None), (45, "a b c d e a b c d e a b c d e", None, None),
        (46, "a\x1cb c d e f", None, None),
    ]
    got = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in host_rules.measures(make_docs(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted(((i, *plain(t)) for i, t, _, _ in rows), key=str)


def test_hosts_that_mostly_fail_lose_all_documents(spark):
    good = [(k, prose(k, 30), "en", "good") for k in range(60)]
    bad = [(100 + k, prose(k, 30) if k < 3 else "few words", "en", "bad") for k in range(60)]
    small = [(200, "few", "en", "small"), (201, prose(1, 30), "en", None)]
    kept = {r.doc_id: r.kept for r in host_rules.quality_rules(make_docs(spark, good + bad + small)).collect()}
    assert all(kept[k] for k in range(60)) and not any(kept[100 + k] for k in range(60))
    assert not kept[200] and kept[201]
    measured = host_rules.measures(make_docs(spark, good + bad + small))
    rates = {r.source: r.rate for r in host_rules.host_verdicts(measured).collect()}
    assert 0.5 < rates["small"] < 1 and rates["good"] < 0.05 and rates["bad"] > 0.9  # one failure says less than many


def test_prior_follows_the_moments(spark):
    hosts = spark.createDataFrame([("a", 100, 10), ("b", 100, 30), ("c", 100, 50)], "source string, n long, failures long")
    alpha, beta = host_rules.beta_prior(hosts)
    assert alpha / (alpha + beta) == pytest.approx(0.3)
    between = (0.01 + 0.09 + 0.25) / 3 - 0.09 - 0.21 * 3 / 300
    assert alpha + beta == pytest.approx(0.21 / between - 1)
    same = spark.createDataFrame([("a", 10, 1), ("b", 10, 1)], "source string, n long, failures long")
    assert sum(host_rules.beta_prior(same)) == pytest.approx(host_rules.STRENGTH[1])
    assert host_rules.beta_prior(same.limit(0)) == (1.0, 1.0)


def test_native_plan_and_empty_table(spark):
    df = host_rules.quality_rules(make_docs(spark, []))
    assert df.count() == 0
    for plan in (df, host_rules.measures(make_docs(spark, awkward()))):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", text)


def test_query_matches_sql(spark):
    n, m, extra, missing = compare(spark, connect(SF), op8_host_rules, ORACLES["op8_host_rules"], SF)
    assert (extra, missing) == ([], []) and n == m > 0


def test_query_matches_sql_where_hosts_fail(spark, tmp_path):
    """A host that fails as a whole, one just above and one below the limit, a null host, and a small one, by the query and its SQL."""
    rows = [(k, prose(k, 30), "en", f"good{k % 8}") for k in range(400)]
    rows += [(1_000 + k, prose(k, 30) if k % 10 == 0 else "few words", "en", "bad") for k in range(100)]
    rows += [(2_000 + k, prose(k, 30) if k % 9 < 4 else "too few", "en", "above") for k in range(180)]
    rows += [(3_000 + k, prose(k, 30) if k % 9 < 5 else "too few", "en", "below") for k in range(180)]
    rows += [(4_000 + k, "no" if k % 4 else prose(k, 30), "en", None) for k in range(60)] + [(5_000, "few", "en", "small")]
    docs = make_docs(spark, rows).select("doc_id", "text", "lang", "source", "n_chars")
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    n, m, extra, missing = compare(spark, con, op8_host_rules, ORACLES["op8_host_rules"], str(tmp_path))
    assert (extra, missing) == ([], []) and n == m == len(rows)
    kept = {r.doc_id: (r.base_failed, r.kept) for r in op8_host_rules(spark, str(tmp_path)).collect()}
    refused = {r[3] for r in rows if kept[r[0]] == (False, False)}
    assert refused == {"bad", "above", None}
    assert all(kept[r[0]][1] != kept[r[0]][0] for r in rows if r[3] not in refused)
