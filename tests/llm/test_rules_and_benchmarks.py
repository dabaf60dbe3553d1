"""Rule paths without a leading slash, very long urls, long and repeated benchmark items."""

import random

import brute
from pyspark.sql import functions as F

from tabloom.llm import decontaminate, url_rules


def test_host_and_path_are_not_mixed_up(spark):
    rules = url_rules.rule_table(spark, [("block", "ne", "t/x"), ("block", "a.b", "/c"), ("allow", "b", "xy"), ("block", "net", "")])
    urls = ["http://net/x", "http://ne/t/x", "http://ne", "http://q.a.b/c", "http://a.b/", "http://b/xy", "http://b" + "/x" * 50_000, "http://" + "a." * 20_000 + "net/x"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r["page_id"]: r["rule"] for r in url_rules.judge(pages, rules).collect()}
    assert got == {0: "net", 1: None, 2: None, 3: "a.b/c", 4: None, 5: None, 6: None, 7: "net"}


def test_long_and_repeated_items(spark, monkeypatch):
    """An item longer than a piece and a third of the rows under one item change nothing, and slices stay within their bound."""
    rng = random.Random(3)
    stock = ["".join(rng.choice("abcdeé") for _ in range(4)) for _ in range(400)]
    long = [rng.choice(stock) for _ in range(900)]
    items = [("long", " ".join(long)), *[("same", "one two three four five six seven eight nine ten eleven")] * 300, ("short", "zz yy"), ("none", None), (None, "q w e")]
    items += [(f"i{k}", " ".join(rng.choice(stock) for _ in range(40))) for k in range(40)]
    docs = [(k, " ".join([*(rng.choice(stock) for _ in range(30)), *long[k * 20 : k * 20 + 12], "."])) for k in range(40)]
    docs += [(50, "x one two three four five six seven eight nine ten y zz yy"), (51, None), (52, "zz, YY; q w e")]
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    table = spark.createDataFrame(docs, "doc_id long, text string").withColumn("words", F.lit(1))
    monkeypatch.setattr(decontaminate, "PIECE_BYTES", 500)
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 4000)
    pieces, slices = decontaminate.dealt(benchmark, "item_id", "text", 10)
    assert slices > 1 and pieces.groupBy(decontaminate._slice(slices)).agg(F.sum(F.octet_length("words")).alias("n")).agg(F.max("n")).first()[0] <= 4000
    assert pieces.where("item = 'same'").count() == 1
    got = sorted(tuple(r) for r in decontaminate.report(table, benchmark).collect())
    assert got == sorted(brute.op7(docs, items))


def test_spans_are_cut(spark):
    items = spark.createDataFrame([(1, "a b c d")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x, A b. C d! y é"), (2, None), (3, "plain")], "doc_id long, text string").withColumn("row", F.lit(7))
    got = {r["doc_id"]: (r["text"], r["row"]) for r in decontaminate.drop_spans(docs, items).collect()}
    assert got == {1: ("x, ! y é", 7), 2: (None, 7), 3: ("plain", 7)}
