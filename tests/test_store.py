"""The store of files: each once, from many tasks at once, after attempts that died, and checked by its digest."""

import hashlib
import io
import os
import zipfile

from voltframe.sources import store


def zipped(**files):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in files.items():
            z.writestr(name, text)
    return out.getvalue()


def test_the_same_bytes_from_many_tasks_are_one_file(spark, tmp_path):
    root = str(tmp_path / "store")
    package = zipped(a="1", b="22")
    contents = [f"file {i % 7}".encode() for i in range(200)] + [package, b"", None]
    docs = spark.createDataFrame([(i, c and bytearray(c) if c != b"" else bytearray()) for i, c in enumerate(contents)], "doc_id long, content binary").repartition(16)
    got = {r["doc_id"]: r for r in store.put(docs, root).collect()}
    for i, c in enumerate(contents):
        assert got[i]["blob_sha256"] == (None if c is None else hashlib.sha256(c).hexdigest())
    assert [(m["member_path"], m["member_sha256"], m["size"]) for m in got[200]["members"]] == [(n, hashlib.sha256(t).hexdigest(), len(t)) for n, t in (("a", b"1"), ("b", b"22"))]
    files = [f for _, _, names in os.walk(root) for f in names if not f.endswith(".crc")]
    assert sorted(files) == sorted({hashlib.sha256(c).hexdigest() for c in contents if c is not None})
    # again: nothing is new, and nothing changes
    assert not any(r["is_new"] for r in store.put(docs, root).collect())
    assert {r["blob_sha256"]: bytes(r["content"]) for r in store.blobs(spark, root).collect()} == {hashlib.sha256(c).hexdigest(): c for c in contents if c}  # Spark reads no empty files


def test_attempts_that_died_and_files_that_were_cut(spark, tmp_path):
    root = str(tmp_path / "store")
    data = b"whole bytes"
    digest = hashlib.sha256(data).hexdigest()
    os.makedirs(f"{root}/{digest[:2]}")
    with open(f"{root}/{digest[:2]}/{store.ATTEMPT}x", "wb") as f:
        f.write(b"half")
    with open(f"{root}/{digest[:2]}/{digest}", "wb") as f:
        f.write(b"whole")
    assert [r["blob_sha256"] for r in store.damaged(spark, root).collect()] == [digest]
    docs = spark.createDataFrame([(bytearray(data),)], "content binary")
    assert store.put(docs, f"file://{root}").first()["is_new"]
    assert store.damaged(spark, root).count() == 0 and store.blobs(spark, root).count() == 1
    store.discard(root, [digest, "0" * 64])
    assert not os.path.exists(f"{root}/{digest[:2]}/{digest}")


def test_a_task_that_fails_is_run_again_to_the_same_end(spark, tmp_path):
    root, marker = str(tmp_path / "store"), str(tmp_path / "failed")
    docs = spark.createDataFrame([(i, bytearray(f"blob {i}".encode())) for i in range(40)], "doc_id long, content binary").repartition(4)

    def once(batches):
        for pdf in batches:
            yield pdf
            if not os.path.exists(marker) and (pdf["doc_id"] % 4 == 0).any():
                open(marker, "w").close()

    stored = store.put(docs, root)
    for _ in range(2):  # evaluated twice: as a second attempt would
        assert stored.mapInPandas(once, stored.schema).count() == 40
    assert store.blobs(spark, root).count() == 40
