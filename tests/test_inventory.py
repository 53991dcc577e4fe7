"""Headers, encodings and sizes of many files by a constant number of jobs."""

import pytest

from haatlake.sources import files
from haatlake.sources.inventory import inventory


def test_headers_encodings_and_sizes(spark, tmp_path):
    (tmp_path / "a b.csv").write_bytes('id,"na""me, x",city\n1,a,Pün\n'.encode())
    (tmp_path / "l.csv").write_bytes("id,prénom\n1,é\n".encode("latin-1"))
    (tmp_path / "late.csv").write_bytes(b"id,x\n" + b"1,plain\n" * 5000 + "2,é\n".encode("latin-1"))
    (tmp_path / "empty.csv").write_bytes(b"")
    (tmp_path / "head.csv").write_bytes(b"only,header")
    folder = tmp_path / "parts.csv"
    folder.mkdir()
    (folder / "part-0.csv").write_bytes(b"")
    (folder / "part-1.csv").write_bytes(b"id,y\n1,z\n")
    (folder / "part-2.csv").write_bytes("id,y\n1,ÿ\n".encode("latin-1"))
    names = ["a b.csv", "l.csv", "late.csv", "empty.csv", "head.csv", "parts.csv"]
    got = {s.path.rsplit("/", 1)[1]: (s.header, s.encoding) for s in inventory(spark, [f"{tmp_path}/{n}" for n in names])}
    assert got == {"a b.csv": (("id", 'na"me, x', "city"), "UTF-8"), "l.csv": (("id", "prénom"), "ISO-8859-1"), "late.csv": (("id", "x"), "ISO-8859-1"),
                   "head.csv": (("only", "header"), "UTF-8"), "parts.csv": (("id", "y"), "ISO-8859-1")}
    assert [s.size for s in inventory(spark, [f"file://{tmp_path}/l.csv"], "UTF-8")] == [(tmp_path / "l.csv").stat().st_size]


def test_a_file_of_several_blocks(spark, tmp_path):
    """The header and a character at a split: lines, and so characters, stay whole."""
    text = "id,word\n" + "".join(f"{i},ééééééé{i}\n" for i in range(40_000))
    for name, encoding in (("u", "utf-8"), ("l", "latin-1")):
        (tmp_path / f"{name}.csv").write_bytes(text.encode(encoding))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10001")
    try:
        got = inventory(spark, [f"{tmp_path}/u.csv", f"{tmp_path}/l.csv"])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [(s.header, s.encoding) for s in got] == [(("id", "word"), "UTF-8"), (("id", "word"), "ISO-8859-1")]


@pytest.mark.parametrize("kind", ["auto", "UTF-8"])
def test_jobs_do_not_follow_the_number_of_files(spark, tmp_path, kind):
    def jobs(n):
        folder = tmp_path / f"{kind}{n}"
        folder.mkdir()
        for i in range(n):
            columns = "transaction_id,customer_id" if i % 2 else "transaction_id,customer_id,delivery_type"
            (folder / f"sales_{i}.csv").write_text(f"{columns}\nT{i},C{i},x\n")
        group = f"files-{kind}-{n}"
        spark.sparkContext.setJobGroup(group, "")
        try:
            df = files.load_year_files(spark, str(folder), encoding=kind)
            assert len(df.columns) == 4
            return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)), df
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

    few, many = jobs(100), jobs(600)
    assert few[0] == many[0] <= 10
    assert many[1].count() == 600 and many[1].where("delivery_type = 'x'").count() == 300


def test_all_files_are_empty(spark, tmp_path):
    (tmp_path / "sales_1.csv").write_bytes(b"")
    with pytest.raises(ValueError, match="empty"):
        files.load_year_files(spark, str(tmp_path))
