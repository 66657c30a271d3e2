"""Templates: runs whose slots do not correspond."""

from claimlake.llm import templates


def found(spark, docs_of, item, *texts):
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    return {r.doc_id: r for r in templates.contaminated(docs_of(*enumerate(texts)), bench).collect()}


def test_verbatim_parts_beside_inconsistent_slots(spark, docs_of):
    item = "Yesterday Alice bought 3 apples and 5 pears for 12 euros at the market near Paris today while Alice sang"
    again = "In all 5 cases the old men went up the long road to see 5 birds and came back in 9 days with nothing"
    texts = (item.replace("Alice sang", "Eve sang"), item.replace("Alice bought", "Eve bought"))
    rows = found(spark, docs_of, item, *texts)
    assert {k: r.n_tokens for k, r in rows.items()} == {0: 18, 1: 18} and {r.changed_slots for r in rows.values()} == {0}
    rows = found(spark, docs_of, again, again.replace("5 birds", "7 birds"), again.replace("9 days", "4 days"))
    assert rows[0].n_tokens == 14 and (rows[1].n_tokens, rows[1].changed_slots) == (24, 1)
