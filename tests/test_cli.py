"""The command line over a small folder tree."""

from datetime import datetime, timedelta

from edgeledger.__main__ import main
from edgeledger.schemas import GEO_FIELDS

LINE = "Msg: 2024-01-10 00:0{}:00 fw n=1,p=TCP,s=30.128.0.{},d=101.0.7.9,sp=1,dp=2,n=9.9.9.9,np={}"


def test_jobs(spark, rows, tmp_path, capsys):
    root, out = tmp_path / "in", str(tmp_path / "out")
    for minute in range(5):
        folder = root / f"20240110/00/0{minute}"
        folder.mkdir(parents=True)
        (folder / "log").write_text(LINE.format(minute, minute, minute) + "\n")
    geo, accounts = str(tmp_path / "geo"), str(tmp_path / "accounts")
    text = "|".join(GEO_FIELDS)
    spark.createDataFrame([(0, 2**32 - 1, text)], "lo long, hi long, text string").write.parquet(geo)
    spark.createDataFrame([('{"ip":"30.128.0.1","account":"u1"}',)], "value string").write.text(accounts)
    people = str(tmp_path / "people")
    spark.createDataFrame(
        [("u1", "1", "2", "3", "4")],
        "username string, rid1 string, rid2 string, rid3 string, rid4 string",
    ).write.parquet(people)
    common = ["--root", str(root), "--geo", geo, "--accounts", accounts, "--out", out]

    main(["minutes", *common, "--time", "2024-01-10T00:05", "--cells"], spark)
    report = spark.read.parquet(f"{out}/report")
    assert rows(report.where("types in ('city', 'username')"), "types", "data", "count") == [
        ("city", "city", 5), ("username", "u1", 1),
    ]

    main(["day", "--batches", out, "--subscribers", people, "--time", "2024-01-10", "--out", out], spark)
    assert rows(spark.read.parquet(f"{out}/liveness"), "username", "resolver") == [("u1", 1)]
    assert rows(spark.read.parquet(f"{out}/count_day"), "counter", "count_day") == [
        ("nat_count", 5), ("nat_hbase_count", 5),
    ]

    main(["targets", "--batches", out, "--geo", geo, "--time", "2024-01-10T00:00", "--out", out], spark)
    assert rows(spark.read.parquet(f"{out}/ip_detail")) == [("101.0.7.9", "province", "city", "operator")]

    capsys.readouterr()
    for query in (["--endpoint", "9.9.9.9:3", "--days", "20240110"], ["--where", "sourceIp=30.128.0.3"],
                  ["--start", "2024-01-10T00:03", "--end", "2024-01-10T00:04"]):
        main(["trace", "--store", f"{out}/sessions", *query], spark)
        shown = capsys.readouterr().out
        assert "30.128.0.3" in shown and "30.128.0.2" not in shown

    folded = ["trace", "--store", f"{out}/sessions", "--compacted", f"{out}/session_days"]
    for query in (["--endpoint", "9.9.9.9:3"], ["--where", "sourceIp=30.128.0.3"], ["--where", "targetPort=2", "-n", "9"],
                  ["--where", "endpoints=101.0.7.9,2,9.9.9.9,3"], ["--start", "2024-01-10T00:03", "--end", "2024-01-10T00:04"]):
        main([*folded, *query], spark)
        shown = capsys.readouterr().out
        assert "30.128.0.3" in shown and ("30.128.0.2" in shown) == ("targetPort=2" in query)
    seen, after = [], []
    while True:
        main([*folded, "--start", "2024-01-10T00:00", "--end", "2024-01-11T00:00", "-n", "2", *after], spark)
        shown = capsys.readouterr().out
        seen += [k for k in range(5) if f"30.128.0.{k}" in shown]
        if "go on with" not in shown:
            break
        after = shown.split("go on with ")[1].split()
    assert sorted(seen) == list(range(5))

    # Files by change time: all of them changed within the last slots.
    start = datetime.now() - timedelta(hours=1)
    filled = str(tmp_path / "filled")
    times = ["--start", start.isoformat(), "--end", (start + timedelta(hours=2)).isoformat()]
    main(["backfill", *common[:-1], filled, *times, "--year", "2024"], spark)
    assert spark.read.parquet(f"{filled}/sessions").count() == 5

    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    changed = (root / "20240110/00/00/log").stat().st_mtime
    spark.createDataFrame(
        [(f"{root}/20240110/00/00/log", 0, datetime.fromtimestamp(changed), True)],
        "path string, size_mb long, mtime timestamp, backlog boolean",
    ).write.parquet(old)
    settings = str(tmp_path / "settings")
    spark.createDataFrame([(40,)], "performance int").write.parquet(settings)
    late = str(tmp_path / "late")
    main(["delayed", *common[:-1], late, "--backlog", old, "--new-backlog", new, "--settings", settings,
          "--time", "2024-01-10T00:05"], spark)
    assert spark.read.parquet(f"{late}/sessions").count() == 1
    assert spark.read.parquet(new).count() == 0

    streamed = str(tmp_path / "streamed")
    main(["stream", *common[:-1], streamed, "--checkpoint", f"{streamed}/checkpoint", "--once"], spark)
    assert spark.read.parquet(f"{streamed}/sessions").count() == 5
