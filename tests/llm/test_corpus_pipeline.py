"""Every pipeline stage on a whole small table against SQL or brute force, and the registered queries."""

import itertools
import re
from collections import Counter, defaultdict

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from stratum.llm import oracle, queries

SF = "/root/testdata/sf0.001"
BLANK = r"[^\x20\x09-\x0D]+"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """The documents before and after every stage, each written and read again."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.toPandas()]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs.toPandas())
    return out


def sql(name, documents):
    con = duckdb.connect()
    con.register("documents", documents)
    con.execute(f"CREATE VIEW benchmark AS FROM read_parquet('{SF}/benchmark.parquet')")
    return con.execute(oracle.SQL[name]).df()


def words(text):
    return re.findall(BLANK, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_quality_stage_keeps_what_the_rules_keep(steps):
    judged = sql("op2_adaptive_quality", steps[0])
    assert set(steps[1].doc_id) == set(judged.doc_id[judged.kept]) and len(steps[1]) < len(steps[0])
    assert list(steps[1].columns) == list(steps[0].columns)


def test_near_dedup_stage_keeps_one_of_each_group(steps):
    sets = {r.doc_id: {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}
            for r in steps[1].itertuples() for w in [words(r.text)]}
    group = {k: k for k in sets}
    for _ in range(2):
        for a, b in itertools.combinations(sorted(sets), 2):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((group[a], group[b]))
                group = {k: low if g == high else g for k, g in group.items()}
    assert set(steps[2].doc_id) == {k for k, g in group.items() if k == g}


def test_substring_stage_leaves_no_repeat_across_documents(steps):
    before, after = (dict(zip(s.doc_id, s.text)) for s in (steps[2], steps[3]))
    assert set(before) == set(after)

    def windows(text):
        at = [m.span() for m in re.finditer(BLANK, text)]
        return {text[at[i][0]:at[i + 50][1]] for i in range(len(at) - 50)}

    count = Counter(w for t in after.values() for w in windows(t))
    assert not [w for w, n in count.items() if n > 1]
    shared = Counter(w for t in before.values() for w in windows(t))
    for k, t in before.items():
        if t != after[k]:      # only documents that share a stretch with another, or repeat one themselves
            assert any(shared[w] > 1 for w in windows(t)) or len(words(t)) - len(words(after[k])) >= 49
    assert all(n == len(t) for n, t in zip(steps[3].n_chars, steps[3].text))


def test_decontamination_stage_drops_what_overlaps(steps):
    hit = set(sql("op9_spaced_seeds", steps[3]).doc_id)
    assert set(steps[4].doc_id) == set(steps[3].doc_id) - hit


def test_packing_stage_matches_its_sql(steps):
    want = sql("op1_length_buckets", steps[4])
    got = steps[5].set_index("doc_id").sort_index()
    want = want.set_index("doc_id").sort_index()[list(got.columns)]
    assert got.fillna(-1).astype(int).equals(want.fillna(-1).astype(int))


def test_run_and_registration(spark, steps):
    assert corpus_pipeline.run(spark, SF).count() == len(steps[5])
    names = __spark_entry__.queries()
    assert "pipeline" in names and set(queries.QUERIES) <= set(names) and set(oracle.SQL) <= set(queries.QUERIES)
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES} == set(range(1, 14))


def test_stages_take_empty_tables_and_null_columns(spark):
    empty = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0
    odd = spark.createDataFrame([(None, None, None, None, None), (1, None, None, None, None), (1, "", "en", "s", 0)], empty.schema)
    counts = defaultdict(int)
    for name, stage in corpus_pipeline.STAGES:
        counts[name] = stage(spark, odd, SF).count()
    assert counts["quality_rules"] == 0 and counts["packing"] == 3 and counts["decontamination"] == 3
