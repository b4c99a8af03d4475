import os

from tessera.plans.catalog import REGISTRY


def test_documents_as_files(spark, tmp_path, monkeypatch):
    """A file for each document and nothing beside it; texts come back as they were."""
    rows = [(7, "a\nb\n"), (-3, ""), (5, None), (None, "nobody's"), (2 ** 40, "ñ\r\n  x ")]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr("tessera.plans.catalog.shared_dir", lambda s, name: f"{tmp_path}/{name}")
    got = REGISTRY["src_text_files"][0](spark, str(tmp_path)).collect()
    assert {(r.doc_id, r.text) for r in got} == {(i, t or "") for i, t in rows} and len(got) == len(rows)
    files = [f for _, _, names in os.walk(f"{tmp_path}/text_files") for f in names]
    assert sorted(files) == sorted(f"{'none' if i is None else i}.txt" for i, _ in rows)
