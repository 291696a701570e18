from tallystone import streaming


def test_each_staged_blob_is_uploaded_once(spark, tmp_path):
    staged = tmp_path / "staged" / "aa"
    staged.mkdir(parents=True)
    for i in range(3):
        (staged / f"blob{i}").write_text("x")
    seen = []
    query = streaming.upload(streaming.staged_files(spark, str(tmp_path / "staged")), lambda df, _: seen.extend(r["blobid"] for r in df.select("blobid").collect()), str(tmp_path / "cp"), once=True)
    query.awaitTermination(60)
    assert sorted(seen) == ["blob0", "blob1", "blob2"]
