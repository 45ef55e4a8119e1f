import os

from docpipe.sources.corpus import read_markdown, scan_markdown


def test_directory_tree(spark, tmp_path):
    files = {
        "a.md": b"# A\r\nline\rend", "deep/er/b c.md": "grün".encode(), "deep/notes.txt": b"no",
        "bad.md": b"\xff\xfe\x00", "upper.MD": b"no", ".hidden/x.md": b"no", "_draft.md": b"no",
        "empty.md": b"", "naïve/ü.md": b"umlaut",
    }
    for name, content in files.items():
        target = tmp_path / name
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(content)
    got = {os.path.relpath(r["source_path"], tmp_path): r["text"]
           for r in read_markdown(spark, str(tmp_path)).collect()}
    assert got == {"a.md": "# A\nline\nend", "deep/er/b c.md": "grün", "naïve/ü.md": "umlaut",
                   "_draft.md": "no", "empty.md": ""}
    failed = scan_markdown(spark, str(tmp_path)).where("not read").collect()
    assert [os.path.relpath(r["source_path"], tmp_path) for r in failed] == ["bad.md"]


def test_missing_directory_has_no_documents(spark, tmp_path):
    df = read_markdown(spark, str(tmp_path / "nowhere"))
    assert df.columns == ["text", "source_path"] and df.count() == 0
