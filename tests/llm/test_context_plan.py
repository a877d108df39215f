from tarnspark.llm import context_tree


def test_growing_tables_are_not_broadcast(spark):
    docs = spark.createDataFrame([(i, f"some words number {i} and more of them") for i in range(40)], "doc_id long, text string")
    plain, own = context_tree.score_texts(docs, 2), context_tree.score_texts(docs, 2, 50)
    assert "Broadcast" not in own._jdf.queryExecution().executedPlan().toString()
    a, b = ({r.doc_id: (r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in x.collect()} for x in (plain, own))
    assert a == b and len(a) == 40
