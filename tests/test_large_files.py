"""Files that no task may hold: mergeable digests, landing in parts, and reading the parts."""

import hashlib
import os
import random

import pytest

from stratum import jobs
from stratum.plans import bronze
from stratum.sources import blocks, objects


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda n: spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def put(path, content):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(content)


def brute(content):
    out = []
    for k, base in enumerate(blocks._BASES):
        out.append(sum(int(blocks._CODES[k][b]) * pow(base, i, 2**64) for i, b in enumerate(content)) % 2**64)
    return "".join(f"{x:016x}" for x in out)


def test_digests_do_not_hang_on_the_split(spark, tmp_path, small_splits):
    rng = random.Random(1)
    contents = {
        "random.bin": rng.randbytes(60_000), "lines.csv": b"".join(b"%d,row\n" % k for k in range(9000)), "open.csv": b"a\n\n\nb,c", "one.txt": b"x",
        "wide.txt": b"y" * 30_000 + b"\n" + "é".encode() * 5000, "ends.txt": b"\n\n\n"}
    for name, x in contents.items():
        put(f"{tmp_path}/{name}", x)
    paths = [f"{tmp_path}/{n}" for n in contents]
    seen = []
    for n in (128 << 20, 7_000, 1_000):
        small_splits(n)
        seen.append({os.path.basename(r.path): r.sums for r in blocks.file_digests(spark, paths).collect()})
        if n == 1_000:
            assert spark.read.option("lineSep", "\n").text(paths).rdd.getNumPartitions() > 4
    assert seen[0] == seen[1] == seen[2]
    assert {n: brute(x) for n, x in contents.items()} == seen[0]


def test_one_changed_byte_changes_the_digest(spark, tmp_path):
    x = bytearray(b"".join(b"%d,row %d\n" % (k, k * k) for k in range(400)))
    put(f"{tmp_path}/a.csv", bytes(x))
    for k, at in enumerate((0, 1234, len(x) - 2)):
        y = bytearray(x)
        y[at] ^= 1
        put(f"{tmp_path}/b{k}.csv", bytes(y))
    put(f"{tmp_path}/c.csv", bytes(x).replace(b"\n1,", b",\n1", 1))
    got = {r.path.rsplit("/", 1)[1]: r.sums for r in blocks.file_digests(spark, [str(tmp_path)]).collect()}
    assert len(set(got.values())) == 5


def test_large_files_land_in_parts(spark, tmp_path, small_splits, monkeypatch):
    small_splits(20_000)
    monkeypatch.setattr(blocks, "PART_BYTES", 3_000)
    rows = b"".join(b"%d,%s,%d\n" % (k, b"name \xc3\xa9" + b"z" * (k % 50), k * 7) for k in range(4000))
    big, small = b"k,name,n\n" + rows, b"k,name,n\n1,only,2\n"
    zone, lake = f"{tmp_path}/zone [1]", f"{tmp_path}/lake"
    put(f"{zone}/big file.csv", big[:-1])
    put(f"{zone}/small.csv", small)
    land = lambda: {r.object_name: r for r in bronze.land(spark, zone.replace("[", r"\[").replace("]", r"\]"), f"{lake}/b", f"{lake}/m", big=10_000).collect()}
    first = land()
    assert {n: r.action for n, r in first.items()} == {"big file.csv": "new", "small.csv": "new"}
    assert first["small.csv"].content_md5 == hashlib.md5(small).hexdigest()
    assert first["big file.csv"].content_md5 == f"blocks-{len(big) - 1}-{brute(big[:-1])}"
    assert {r.action for r in land().values()} == {"unchanged"}
    landed = spark.read.parquet(f"{lake}/b").where("object_name = 'big file.csv'")
    parts = sorted((r.part, bytes(r.content)) for r in landed.collect())
    assert len(parts) > 20 and max(len(c) for _, c in parts) < 6_000 and b"".join(c for _, c in parts) == big
    now = bronze.current_objects(spark, f"{lake}/b", f"{lake}/m").where("object_name = 'big file.csv'")
    table = objects.read_objects(now)
    assert table.columns == ["k", "name", "n"] and table.count() == 4000
    assert {(r.k, r.n) for r in table.collect()} == {(str(k), str(k * 7)) for k in range(4000)}
    put(f"{zone}/big file.csv", big.replace(b"3999,", b"9993,"))
    assert {n: r.action for n, r in land().items()} == {"big file.csv": "changed", "small.csv": "unchanged"}
    assert jobs.run_bronze(spark, str(tmp_path / "zone*"), f"{lake}/b2", f"{lake}/m2").count() == 2


def test_landing_counts_and_refuses_files_that_change_meanwhile(spark, tmp_path, monkeypatch):
    from stratum.operators.checks import CheckFailed

    zone, lake = f"{tmp_path}/zone", f"{tmp_path}/lake"
    for k in range(4):
        put(f"{zone}/f{k}.csv", b"x" * (10 + k))
    metrics = {}
    bronze.land(spark, zone, f"{lake}/b", f"{lake}/m", metrics=metrics)
    assert metrics == {"contents": {"objects": 4, "bytes": 46, "changed": 0, "missing": 0}, "manifest": {"rows": 4}}
    put(f"{zone}/f1.csv", b"new")
    keep = bronze.materialize

    def then_changed(*args):
        out = keep(*args)
        put(f"{zone}/f1.csv", b"newer")
        return out

    monkeypatch.setattr(bronze, "materialize", then_changed)
    with pytest.raises(CheckFailed, match="changed = 1"):
        bronze.land(spark, zone, f"{lake}/b", f"{lake}/m")
    assert bronze.read_manifest(spark, f"{lake}/m").count() == 4
    monkeypatch.setattr(bronze, "materialize", keep)
    again = {}
    bronze.land(spark, zone, f"{lake}/b", f"{lake}/m", metrics=again)
    assert again["contents"]["objects"] == 1 and again["contents"]["bytes"] == 5
    none = {}
    bronze.land(spark, zone, f"{lake}/b", f"{lake}/m", metrics=none)
    assert none == {}
