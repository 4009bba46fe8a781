"""Drop zones of many files: written by tasks, landed without a list of their paths."""

from stratum.plans import bronze, fixtures


def zone_of(spark, path, rows, suffix=""):
    fixtures.write_drop_zone(spark.createDataFrame(rows, "s_suppkey long, s_name string").coalesce(1), path, suffix)


def contents(path):
    return {p.name: p.read_bytes() for p in path.iterdir() if not p.name.startswith(".")}


def test_drop_zone_is_written_by_tasks(spark, tmp_path, monkeypatch):
    def refused(*args, **kwargs):
        raise AssertionError("rows pass through the driver")

    monkeypatch.setattr(type(spark.range(1)), "toLocalIterator", refused)
    rows = [(k, f"Supplier#{k:03} é") for k in range(60)] + [(61, None), (70, "twice"), (65, "twice"), (64, "dot")]
    zone_of(spark, f"{tmp_path}/zone x", rows, "more")
    want = {}
    for k, name in rows:
        want[f"{name}{'.bin' if k % 10 == 4 else '.csv'}"] = f"{k},{name}\nmore".encode()
    assert contents(tmp_path / "zone x") == want and want["twice.csv"].startswith(b"65,")


def test_landing_lists_no_single_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(bronze, "_literal_paths", lambda paths: 1 / 0)
    zone, lake = f"{tmp_path}/zone", f"{tmp_path}/lake"
    rows = [(k, f"n{k}") for k in range(40)]
    zone_of(spark, zone, rows)
    landed = []
    for changed in (range(0), range(0, 40, 3), range(0)):
        if changed:
            zone_of(spark, zone, [rows[k] for k in changed], "changed")
        metrics = {}
        bronze.land(spark, zone, f"{lake}/b", f"{lake}/m", metrics=metrics)
        landed.append(metrics.get("contents", {}).get("objects", 0))
    assert landed == [36, sum(k % 10 != 4 for k in range(0, 40, 3)), 0]
    now = {r.object_name: bytes(r.content) for r in bronze.current_objects(spark, f"{lake}/b", f"{lake}/m").collect()}
    assert now == {n: c for n, c in contents(tmp_path / "zone").items() if n.endswith(".csv")}


def test_pattern_join_deals_the_largest_edges_out_twice(spark):
    from stratum.plans.graph import bgp_join

    triples = [("c:1", "P31", "n:1"), ("n:1", "P279", "root"), ("c:1", "P169", "o:1"), ("c:1", "P169", "o:1"), ("c:1", "P169", "o:2"),
               ("o:1", "P69", "s:1"), ("o:1", "P69", "s:1"), ("o:2", "P69", "s:2"), ("o:2", "P69", "s:3"), (None, "P69", "s:1"),
               ("s:1", "P31", "t:0"), ("s:2", "P31", "t:1"), ("s:3", "P31", "t:9"), ("o:1", "P512", "d:1"), ("o:1", "P512", None), ("o:1", "P512", "d:2")]
    labels = [("c:1", "en", "One"), ("c:1", "de", "Eins"), ("s:1", "en", "First"), ("s:1", "en", "Prime"), ("d:1", "en", "Doctor"), ("d:2", "en", None)]
    out = None
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        out = bgp_join(spark.createDataFrame(triples, "s string, p string, o string"), spark.createDataFrame(labels, "id string, lang string, text string"))
        rows = [tuple(r) for r in out.collect()]
        plan = out._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before[0])
        spark.conf.set("spark.sql.adaptive.enabled", before[1])
    assert len(rows) == len(set(rows)) and set(rows) == {
        *(("One", "o:1", u, d) for u in ("First", "Prime") for d in ("Doctor", "d:2", None)), ("One", "o:2", "s:2", None)}
    # the distinct, the join on executives and, as broadcasts are off here, the one on universities
    largest = next(k for k, line in enumerate(plan) if "P69" in line and "Filter" in line)
    depth, above = plan[largest].index("Filter"), 0
    for line in reversed(plan[:largest]):
        at = len(line) - len(line.lstrip(" :+-*()0123456789"))
        if at < depth:
            depth, above = at, above + ("Exchange" in line)
    assert above == 3
