from genospark.sources.zipfiles import archive_status, zip_lines

from helpers import write_zip


def test_zip_members_and_status(spark, tmp_path):
    d = str(tmp_path)
    write_zip(d, "one.zip", {"a.txt": "l0\r\nl1\nl2"})
    write_zip(d, "two.zip", {"a.txt": "x", "b.txt": "y"})
    write_zip(d, "none.zip", {})
    write_zip(d, "bad.zip", raw=b"not a zip at all")
    write_zip(d, "skip.txt", raw=b"ignored: not a zip name")
    lines = zip_lines(spark, d)
    got = {r["file_name"]: r for r in archive_status(lines).collect()}
    assert set(got) == {"one.zip", "two.zip", "none.zip", "bad.zip"}
    assert (got["one.zip"]["status"], got["one.zip"]["n_lines"], got["one.zip"]["first_line"]) == ("ok", 3, "l0")
    assert (got["two.zip"]["status"], got["two.zip"]["n_members"]) == ("members", 2)
    assert (got["none.zip"]["status"], got["none.zip"]["n_members"]) == ("members", 0)
    assert got["bad.zip"]["status"] == "corrupt"
    one = sorted((r["line_no"], r["line"]) for r in lines.where("file_name = 'one.zip'").collect())
    assert [n for n, _ in one] == [0, 1, 2]
