"""What workers keep, and for how long."""

from __future__ import annotations

from groundburn.llm import base


def test_a_worker_keeps_what_its_operator_uses(monkeypatch):
    monkeypatch.setattr(base, "_kept", [])
    monkeypatch.setattr(base, "_current", "")
    made = []

    def make(rules):
        made.append(rules)
        return object()

    get = base.worker_cache(make)
    base._turn_to("one")
    first = get("a")
    base._turn_to("one")  # the next task of the same operator
    assert get("a") is first and made == ["a"]
    base._turn_to("two")
    base._turn_to("one")
    assert get("a") is not first and made == ["a", "a"]


def test_nothing_is_left_staged(spark, tmp_path):
    staged = base.staged(spark.range(3), "some")
    assert staged.count() == 3
    path = base.shared_folder(spark)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    assert files.exists(hadoop)
    base.release_staged(spark)
    assert not files.exists(hadoop)
