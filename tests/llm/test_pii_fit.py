"""The trees and thresholds of the personal data operator are fitted on every labelled span."""

from tessera.llm import pii_gbt


def test_every_labelled_span_counts(spark, monkeypatch):
    text = " ".join(f"pay by card {4111111111110000 + k} please" for k in range(400))
    docs = spark.createDataFrame([(i, text) for i in range(40)], "doc_id long, text string")
    spans = pii_gbt.cut_lineage(pii_gbt.generate(docs, keep=["doc_id"]))
    seen = []
    keep = pii_gbt.cut_lineage
    monkeypatch.setattr(pii_gbt, "cut_lineage", lambda df: seen.append(keep(df)) or seen[-1])
    trees, _ = pii_gbt.fit(spans)
    labelled = spans.selectExpr("sum(size(base) + size(spelled) + size(broken))").first()[0]
    assert trees and labelled > 12_000
    assert seen[0].selectExpr("sum(n)").first()[0] == labelled and seen[0].count() < labelled / 10
