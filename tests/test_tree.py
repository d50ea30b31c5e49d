"""Listings lose no entry of a directory, whatever happens to another."""

import os

from hazardlens import audit_tree, read_tree
from hazardlens.sources.tree import _examine, _take_turn, list_tree, read_listed, store_decoded


def test_vanished_file_and_dangling_link_are_rejected_alone(spark, tmp_path):
    for name in ("a.py", "b.py", "c.py", "d.py"):
        (tmp_path / name).write_text("x = 1\n")
    os.symlink(tmp_path / "missing.py", tmp_path / "link.py")
    os.symlink(tmp_path / "a.py", tmp_path / "good.py")
    os.symlink(tmp_path / "loop.py", tmp_path / "loop.py")

    files, rejected = read_tree(spark, str(tmp_path))
    assert {os.path.basename(r["path"]) for r in files.collect()} == {"a.py", "b.py", "c.py", "d.py", "good.py"}
    reasons = {os.path.basename(r["path"]): r["reason"] for r in rejected.collect()}
    assert set(reasons) == {"link.py", "loop.py"} and reasons["link.py"] == "not_found"
    assert reasons["loop.py"].startswith("not_listed")

    listing = _examine(str(tmp_path), False, (".py",), 100)
    first = next(listing)
    gone = next(n for n in ("a.py", "b.py", "c.py", "d.py") if not first[0].endswith(n))
    (tmp_path / gone).unlink()
    rows = {os.path.basename(p): reason for p, _, reason, _, _ in [first, *listing]}
    if gone == "a.py":
        assert rows.pop("good.py") in (None, "not_found")
    assert rows[gone] == "not_found" and str(tmp_path) not in rows
    assert {n for n, reason in rows.items() if reason is None} >= {"b.py", "c.py", "d.py"} - {gone}


def walked(root):
    return sorted(os.path.join(at, n) for at, _, names in os.walk(root) for n in names if n.endswith(".py"))


def test_crowded_directory_and_lopsided_tree_are_dealt_out(spark, tmp_path):
    crowded = tmp_path / "crowded"
    crowded.mkdir()
    for k in range(700):
        (crowded / f"f{k}.{'py' if k % 7 else 'txt'}").touch()
    deep = tmp_path
    for k in range(40):
        deep = deep / f"d{k}"
        deep.mkdir()
        for j in range(5):
            (deep / f"x{j}.py").write_text("y")
    os.symlink(tmp_path / "crowded", tmp_path / "again")
    got = list_tree(spark, str(tmp_path), True, turn=50).collect()
    assert sorted(r.path for r in got) == walked(tmp_path)
    assert {(r.reason, r.size) for r in got} == {(None, 0), (None, 1)}
    # No turn examines more than it may, but for the rest of a directory's names, which it only hands on.
    rows = list(_examine(str(tmp_path), True, (".py",), 50))
    assert sum(1 for r in rows if not r[4]) <= 50
    assert all(len(names) <= 50 for _, _, _, names, is_open in rows if is_open and names)
    assert sorted(r.path for r in list_tree(spark, str(crowded), turn=50).collect()) == walked(crowded)


def test_names_that_are_no_text_and_unlisted_directories_are_rows(spark, tmp_path):
    (tmp_path / "a.py").write_text("x = 1")
    with open(os.fsencode(tmp_path) + b"/b\xff.py", "w") as f:
        f.write("x = 2")
    reasons = {os.path.basename(r.path): r.reason for r in list_tree(spark, str(tmp_path)).collect()}
    assert reasons == {"a.py": None, "b\ufffd.py": "not_listed: name is not UTF-8"}
    assert [r.reason for r in list_tree(spark, str(tmp_path / "none"), True).collect()] == ["not_found"]
    (tmp_path / "empty").mkdir()
    assert list_tree(spark, str(tmp_path / "empty"), True).collect() == []
    assert list(_take_turn(True, (".py",), 5)(iter([]))) == []


def test_files_and_rejected_ones_come_of_one_reading(spark, tmp_path):
    source = tmp_path / "src"
    source.mkdir()
    (source / "a.py").write_bytes(b"x\r\ny")
    (source / "b.py").write_bytes(b"\xff")
    files, rejected = store_decoded(read_listed(list_tree(spark, str(source))), str(tmp_path / "out"))
    (source / "a.py").unlink()  # nothing is read again
    assert [tuple(r) for r in files.collect()] == [(f"{source}/a.py", ".py", "x\ny")]
    assert [tuple(r) for r in rejected.collect()] == [(f"{source}/b.py", "not_utf8")]
    empty = spark.createDataFrame([], "path string, content binary, reason string")
    files, rejected = store_decoded(empty, str(tmp_path / "none"))
    assert (files.count(), rejected.count()) == (0, 0)
    plan = audit_tree(spark, str(source))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1
