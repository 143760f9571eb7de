"""Retrieval over a small repository of our own."""

from pyspark.sql import functions as F

from lorefold.operators import code as C
from lorefold.operators import retrieval as R

SERVICE = "package s;\npublic class OrderService {\n  public void settle(int x) {\n    book(x);\n  }\n  public void book(int x) {\n    int total = x;\n  }\n}\n"


def test_retrieve(spark):
    files = spark.createDataFrame([("service/OrderService.java", "java", SERVICE), ("x/Other.java", "java", "public class Other {\n}\n")], "path string, language string, text string")
    nodes, edges = C.build(files)
    items = spark.createDataFrame([("i1", "How does OrderService settle orders?", ["service/OrderService.java#settle"], ["booked"]), ("i2", "unrelated words", None, None)], "id string, question string, context_refs array<string>, expected_checks array<string>")
    evidence = spark.createDataFrame([("service/OrderService.java#settle", "service/OrderService.java::book")], "ref string, node_id string")
    best, facts = R.retrieve(items, files, nodes, edges, evidence)
    got = {r.candidate_id: (r["rank"], r.source) for r in best.where(F.col("query_id") == "i1").collect()}
    assert got["service/OrderService.java::settle"] == (1, "context_ref") and "service/OrderService.java::book" in got and "service/OrderService.java::OrderService" in got
    assert best.where("query_id = 'i2'").count() == 0
    told = {r.statement: r.confidence for r in facts.collect()}
    assert told["settle calls settle, book"] == 0.95 or "book" in next(iter(told))
