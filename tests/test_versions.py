"""Published versions of a set of tables."""

import json
import time

import pytest

from salesmart import jobs
from salesmart.sources import read_tables
from salesmart.versions import PublishConflict, Versions


def write(spark, version, **rows):
    for name, n in rows.items():
        version.workspace.store(name, spark.range(n).selectExpr("id", f"'{name}' AS name"))
    return rows


def counts(versions):
    return {name: table.count() for name, table in versions.read().items()}


def test_readers_see_whole_versions_only(spark, tmp_path):
    versions = Versions(spark, str(tmp_path / "wh"))
    assert versions.current() is None
    with pytest.raises(FileNotFoundError):
        versions.read()
    first = versions.begin()
    first.publish(write(spark, first, a=3, b=4))
    assert counts(versions) == {"a": 3, "b": 4}
    opened = versions.read(["a"])["a"]

    killed = versions.begin()  # dies between its two tables
    write(spark, killed, a=30)
    with pytest.raises(FileNotFoundError, match="b is not written whole"):
        killed.publish({"a": 30, "b": 40})
    assert counts(versions) == {"a": 3, "b": 4}

    second = versions.begin()
    second.publish(write(spark, second, a=5, b=6))
    assert counts(Versions(spark, str(tmp_path / "wh"))) == {"a": 5, "b": 6}
    assert opened.count() == 3  # who read before goes on with the old files
    assert {n: t.count() for n, t in read_tables(spark, versions.folder, ["b"]).items()} == {"b": 6}


def test_of_two_runs_one_is_told(spark, tmp_path):
    versions = Versions(spark, str(tmp_path / "wh"))
    one, two = versions.begin(), versions.begin()
    one.publish(write(spark, one, a=1))
    with pytest.raises(PublishConflict):
        two.publish(write(spark, two, a=2))
    assert counts(versions) == {"a": 1}
    names = [p.name for p in (tmp_path / "wh" / "_manifests").iterdir() if not p.name.endswith(".crc")]
    assert names == ["0000000001.json"]


def test_prune_keeps_what_is_read(spark, tmp_path):
    versions, folders = Versions(spark, str(tmp_path / "wh")), []
    for n in range(1, 5):
        if n == 2:
            dead = versions.begin()
            write(spark, dead, a=9)
            folders.append(dead.workspace.folder)
        version = versions.begin()
        version.publish(write(spark, version, a=n))
        folders.append(version.workspace.folder)
        time.sleep(0.05)
    running = versions.begin()
    write(spark, running, a=7)
    gone = versions.prune(keep=2)
    assert sorted(gone) == sorted(f.rsplit("/", 1)[1] for f in folders[:3])
    assert counts(versions) == {"a": 4}
    running.publish({"a": 7})
    assert counts(versions) == {"a": 7}
    with pytest.raises(ValueError):
        versions.prune(keep=0)


def test_a_job_that_fails_leaves_the_published_tables(spark, staging_rows, tmp_path, monkeypatch, capsys):
    def run(*rows):
        path = tmp_path / f"staging-{len(list(tmp_path.iterdir()))}"
        staging_rows(*rows).write.parquet(str(path))
        jobs.main(["star", "--parquet", str(path), "--publish", str(tmp_path / "wh"),
                   "--work", str(tmp_path / "work"), "--ids", "key"])
        return json.loads(capsys.readouterr().out)

    assert run({"id": "1"}, {"id": "2", "customer_email": "bo@x.com"})["sales_fact"] == 2
    before = {n: sorted(t.collect()) for n, t in read_tables(spark, str(tmp_path / "wh"), ["customer_dim", "sales_fact"]).items()}
    assert [(r.customer_id, r.email) for r in before["customer_dim"]] == [(1, "ann@x.com"), (2, "bo@x.com")]
    monkeypatch.setattr(jobs.star, "sales_fact", lambda *a, **k: 1 / 0)  # after the dimensions
    with pytest.raises(ZeroDivisionError):
        run({"id": "3", "customer_email": "cy@x.com"})
    after = {n: sorted(t.collect()) for n, t in read_tables(spark, str(tmp_path / "wh"), before).items()}
    assert after == before
    jobs.main(["reports", "--star", str(tmp_path / "wh"), "--reports-out", str(tmp_path / "r"),
               "--work", str(tmp_path / "work")])
    assert json.loads(capsys.readouterr().out)["report_time_yearly"] == 1
