"""The query of the curriculum mix counts what the written order of the mix holds."""

from docsmith.llm import common, mixing
from docsmith.llm.queries import op6_curriculum_mix


def test_query_goes_through_the_curriculum(spark, tmp_path):
    docs = [(i, " ".join(["w"] * (1 + i % 7)), f"s{i % 3}") for i in range(60)] + [(60, None, "s0"), (61, "a b", None)]
    spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(3) \
        .write.parquet(str(tmp_path / "documents.parquet"))
    rows = {r["doc_id"]: r for r in op6_curriculum_mix(spark, str(tmp_path)).collect()}
    plan = {r["doc_id"]: r for r in mixing.schedule(
        spark, common.table(spark, str(tmp_path), "documents")).collect()}
    assert {k: r["taken"] for k, r in rows.items()} == {k: r["size"] * r["repeats"] for k, r in plan.items()}
    order = next(x for x in reversed(common._STAGED) if "/mix-order-" in x)
    at = [r["at"] for r in spark.read.parquet(order).collect()]
    assert sorted(at) == sorted(x for r in plan.values() for x in r["positions"])
    # early: more of the source whose share falls than of the one whose share rises
    slopes = {"s0": -0.6, "s2": 0.6}
    means = {s: [x for r in plan.values() if r["source"] == s for x in r["positions"]] for s in slopes}
    assert sum(means["s0"]) / len(means["s0"]) < sum(means["s2"]) / len(means["s2"])
