"""The erase job over odd holdings, lost on the way and repeated."""

from __future__ import annotations

import os
import time
from pathlib import Path

import pytest

from chanlake.plans import erasing
from chanlake.plans.erasing import Holding, ask, erase_job, pending, traces, vacuum_stages
from chanlake.session import shared_dir, write_stage
from chanlake.sources.tables import finish_replacements, replace_folder, write_version


def numbers(spark, path):
    return sorted(r[0] for r in spark.read.parquet(path).select("n").collect())


def test_a_lost_replacement_is_ended(spark, tmp_path):
    path = str(tmp_path / "root" / "version=1")
    spark.range(5).selectExpr("id AS n").write.parquet(path)
    replace_folder(spark.read.parquet(path).filter("n > 2"), path)
    assert numbers(spark, path) == [3, 4]
    beside = Path(path).parent / "_new-version=1"
    spark.range(2).selectExpr("id AS n").write.parquet(str(beside))
    finish_replacements(spark, str(Path(path).parent))  # the old one is still there: it counts
    assert numbers(spark, path) == [3, 4] and not beside.exists()
    os.rename(path, beside)
    finish_replacements(spark, str(Path(path).parent))
    assert numbers(spark, path) == [3, 4] and not beside.exists()


def test_erase_job_is_repeated_until_nothing_is_left(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([(f"c{i % 4}", i) for i in range(40)], "channel_id string, n long")
    at = {name: str(tmp_path / name) for name in ("rows", "rounds", "versions", "files", "values", "uses", "log", "absent")}
    rows.write.parquet(at["rows"])
    rows.write.parquet(at["uses"])
    rows.select("n").write.parquet(at["values"])
    for k in (1, 2):
        write_version(rows.filter(f"n % 2 = {k - 1}"), at["rounds"], str(k))
        write_version(rows, at["versions"], str(k))
    for name in ("c1/2024.jsonl", "c2/2024.jsonl"):
        (tmp_path / "files" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "files" / name).write_text("{}")
    holdings = [
        Holding("rows", "rows", at["rows"]), Holding("rounds", "rounds", at["rounds"]), Holding("versions", "versions", at["versions"]),
        Holding("files", "files", at["files"], "path", "{channel_id}/{period}.jsonl"), Holding("absent", "rows", at["absent"]),
        Holding("values", "values", at["values"], by=(at["uses"], "n", "n")),
    ]
    gone = spark.createDataFrame([("c1",), ("c1",), ("nobody",)], "channel_id string")

    def fail(*_):
        raise RuntimeError("lost")

    monkeypatch.setitem(erasing.KINDS, "files", fail)
    with pytest.raises(RuntimeError):
        erase_job(gone, holdings, at["log"], 4)
    assert [r[0] for r in traces(spark, holdings, gone).collect()] == ["files"]
    monkeypatch.undo()
    assert erase_job(gone.limit(0), holdings, at["log"], 4) == 0  # the log knows what is still to do
    assert pending(spark, at["log"]).count() == 0
    left = [n for n in range(40) if n % 4 != 1]
    assert numbers(spark, at["rows"]) == left == numbers(spark, at["rounds"]) == numbers(spark, at["versions"] + "/version=2")
    assert numbers(spark, at["values"]) == left and not Path(at["versions"], "version=1").exists()
    assert [p.name for p in (tmp_path / "files").rglob("*.jsonl")] == ["2024.jsonl"]
    assert not (tmp_path / "files" / "c1" / "2024.jsonl").exists()
    time.sleep(0.01)
    assert {r[0] for r in ask(gone, at["log"]).collect()} == {"c1", "nobody"}  # it may come again


def test_vacuum_of_old_stages(spark):
    old, new = (Path(write_stage(spark.range(3), name)) for name in ("old", "new"))
    os.utime(old, (time.time() - 9 * 86400,) * 2)
    assert old.name in vacuum_stages(spark, 7) and not old.exists() and new.exists()
    assert str(new).startswith(shared_dir(spark))
