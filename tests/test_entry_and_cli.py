import math
import os

import duckdb
import pytest

import __spark_entry__ as driver
from tidewatch import cli

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")
CORE = [n for n in driver.oracle_sql() if not n.startswith("op") and n != "pipeline"]


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", CORE)
def test_query_equals_its_sql(spark, con, name):
    df = driver.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    want = con.sql(driver.oracle_sql()[name])
    assert sorted(want.columns) == cols
    place = [want.columns.index(c) for c in cols]
    assert got == sorted((tuple(plain(r[i]) for i in place) for r in want.fetchall()), key=repr)


def test_every_rule_fires_and_not_always(spark):
    row = driver.queries()["gate_telemetry"](spark, SF).first().asDict()
    for k in ("quarantined_r2", "quarantined_r3", "quarantined_r4", "gap_alerts", "divergence_alerts", "n_valid"):
        assert 0 < row[k] < 1000


def test_entry(spark):
    assert driver.entry(spark).count() > 100


def test_commands(spark, tmp_path, capsys):
    path, frames, out = (str(tmp_path / x) for x in ("clean", "frames", "out"))
    assert cli.main([]) == 1
    assert cli.main(["contract", "show"]) == 0
    assert cli.main(["fixture", "generate", "--path", path, "--rows", "120"]) == 0
    digest = capsys.readouterr().out.split()[-1]
    assert cli.main(["fixture", "verify", "--path", path, "--content-sha256", digest]) == 0
    assert cli.main(["fixture", "verify", "--path", path, "--content-sha256", "0"]) == 1
    assert cli.main(["bars", "--input", path, "--output", str(tmp_path / "bars")]) == 0
    assert cli.main(["slo", "--rows", "300"]) == 0
    assert cli.main(["metrics", "--path", path]) == 0
    assert cli.main(["export", "--path", path, "--content-sha256", digest, "--parquet-sha256", "b", "--output", str(tmp_path / "site")]) == 0
    assert (tmp_path / "site" / "index.html").exists()
    assert cli.main(["sanity", "--root", str(tmp_path / "none")]) == 2
    from tidewatch.functions.codec import encode_frames
    from tidewatch.operators.faultlab import clean_fixture

    rows = encode_frames(clean_fixture(spark, 20)).selectExpr("cast(null AS binary) AS key", "value", "0 AS partition", "seq AS offset")
    rows.unionByName(rows.limit(3).selectExpr("key", "substring(value, 1, 9) AS value", "partition", "offset + 1000 AS offset")).write.parquet(frames)
    assert cli.main(["gate", "--input", frames, "--output", out]) == 0
    assert cli.main(["quarantine", "stats", "--path", out]) == 0
    assert '"R1": 3' in capsys.readouterr().out
    assert cli.main(["quarantine", "ls", "--path", out]) == 0
    key = capsys.readouterr().out.split()[0]
    assert cli.main(["quarantine", "show", "--path", out, "--key", key]) == 0 and cli.main(["quarantine", "show", "--path", out, "--key", "none"]) == 1
    assert cli.main(["gate", "--input", frames, "--output", f"{out}-first", "--max-messages", "7"]) == 0
    assert spark.read.parquet(f"{out}-first/telemetry").selectExpr("sum(count)").first()[0] == 7
    # bars of what passed, from the gate's folder; the newest minutes stay open
    assert cli.main(["bars", "--valid", out, "--output", str(tmp_path / "live"), "--delay", "1 millisecond"]) == 0
    assert 0 < spark.read.parquet(str(tmp_path / "live")).count() and cli.main(["bars"]) == 2
    pins = str(tmp_path / "fixtures.yaml")
    assert cli.main(["fixture", "generate", "--path", path, "--rows", "100", "--pins", pins]) == 0 and cli.main(["fixture", "verify", "--pins", pins]) == 0
    assert cli.main(["metrics", "--pins", pins]) == 0
