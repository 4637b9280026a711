"""The pipeline's stages on a table of odd rows and on an empty one."""

import re

import corpus_pipeline as C

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_stage_order():
    assert [n for n, _ in C.STAGES] == ["quality_rules", "line_dedup", "near_duplicates", "mix_sources", "encode_pieces"]


def test_stages_take_effect(spark, messy_dir, tmp_path):
    docs = spark.read.parquet(f"{messy_dir}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in C.STAGES:
        out = stage(spark, docs, messy_dir)
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = docs.collect()
        if name != C.STAGES[-1][0]:
            assert docs.columns == columns
    assert all(len(WORD.findall(r["text"] or "")) >= 10 for r in seen["quality_rules"])
    assert len(seen["line_dedup"]) == len(seen["quality_rules"])
    ids = [r["doc_id"] for r in seen["near_duplicates"]]
    assert len(ids) == len(set(ids)) and 10 in ids and not set(range(11, 18)) & set(ids) and 25 not in ids
    assert set(range(60, 140)) <= {r["doc_id"] for r in seen["quality_rules"]}  # clean documents stay
    assert all(r["round_trip"] for r in seen["encode_pieces"]) and len(seen["encode_pieces"]) == len(seen["mix_sources"])


def test_empty(spark, empty_dir):
    assert C.run(spark, empty_dir).count() == 0
