"""The pipeline's stages on a small table, and the registered queries."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
import oracle
from tabloom.llm import catalogue, decontaminate, simhash, suffix_levels

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = set(entry.queries())
    assert "pipeline" in names and {n.split("_")[0] for n in catalogue.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(catalogue.QUERIES) <= names and set(catalogue.ORACLE) <= set(catalogue.QUERIES)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE))
def test_matches_sql(spark, name):
    sf = "/root/testdata/sf0.01"
    assert oracle.compare(oracle.connect(sf), catalogue.QUERIES[name](spark, sf), catalogue.ORACLE[name]) == []


def test_stages(spark):
    docs = catalogue.table(spark, SF, "documents")
    columns = docs.columns
    benchmark = catalogue.table(spark, SF, "benchmark")
    before, checks = docs, {}
    for k, (label, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, before, SF).cache()
        if k + 1 < len(corpus_pipeline.STAGES):
            assert after.columns == columns and dict(after.dtypes) == dict(docs.dtypes)
        checks[label] = (before, after)
        before = after
    kept = checks["simhash"][1]
    assert kept.count() == simhash.near_duplicates(checks["simhash"][0]).select("component_id").distinct().count()
    cut_in, cut_out = checks["suffix_levels"]
    assert cut_out.count() == cut_in.count()
    removed = suffix_levels.report(cut_in).agg({"n_removed": "sum"}).first()[0]
    lost = cut_in.selectExpr("sum(octet_length(text))").first()[0] - cut_out.selectExpr("sum(octet_length(text))").first()[0]
    assert lost >= removed > 0 and cut_out.where("n_chars <> length(text)").count() == 0
    assert decontaminate.report(checks["decontaminate"][1], benchmark).where("contaminated").count() == 0
    packed = checks["packing"][1]
    assert packed.select("doc_id").distinct().count() == checks["packing"][0].count()


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF)
    assert "batch" in out.columns and out.count() > 0
