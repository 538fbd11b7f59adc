"""Lines of several lists are numbered without sorting them all in one task."""

from namewright.sources import repos


def test_lines_are_numbered_by_file(spark, tmp_path):
    lists = {"b.txt": "\n u/b1 \r\n# no\nu/b2", "a.txt": "u/a1\nu/a1\n\n", "c.txt": "# none\n", "d.txt": "u/d1"}
    for name, text in lists.items():
        (tmp_path / name).write_bytes(text.encode())
    made = repos.read_repo_list(spark, str(tmp_path))
    got = [(r.repo_ord, r.url) for r in made.orderBy("repo_ord").collect()]
    assert got == list(enumerate(["u/a1", "u/a1", "u/b1", "u/b2", "u/d1"]))
    assert "row_number" not in made._jdf.queryExecution().optimizedPlan().toString()
