from datetime import date

import pytest

from daybook import __main__ as cli
from daybook.__main__ import object_store, parse_args
from daybook.sources import warehouse as wh


def test_arguments():
    options = parse_args(["run", "--run-date", "2026-08-03", "2026-08-04", "--in-root", "a", "--out-root", "b"])
    assert options.run_date == [date(2026, 8, 3), date(2026, 8, 4)]
    assert object_store(options) is None
    places = ["--in-root", "a", "--out-root", "b"]
    assert parse_args(["run", "--logical-date", "2026-08-03", *places]).run_date == [date(2026, 8, 3)]
    both = ["run", "--logical-date", "2026-08-03", "--run-date", "2026-08-01", *places]
    assert parse_args(both).run_date == [date(2026, 8, 1)]
    for bad in (["run", "--run-date", "soon", "--in-root", "a", "--out-root", "b"], ["load", "--out-root", "b"], ["run", *places], ["sleep"]):
        with pytest.raises(SystemExit):
            parse_args(bad)


def test_object_store_needs_keys():
    args = ["models", "--warehouse", "w", "--s3-endpoint", "http://store"]
    with pytest.raises(ValueError):
        object_store(parse_args(args))
    settings = object_store(parse_args([*args, "--s3-access-key", "k", "--s3-secret-key", "s"]))
    assert settings["access.key"] == "k" and settings["endpoint"] == "http://store"


def test_checks_and_views_of_a_warehouse(spark, tmp_path, monkeypatch, capsys):
    monkeypatch.setattr(cli, "create_session", lambda *args: spark)
    wh.create_tables(spark, str(tmp_path))
    place = ["--warehouse", str(tmp_path)]
    cli.main(["contracts", *place])
    with pytest.raises(SystemExit, match="freshness failed(.|\n)*rejected_records"):
        cli.main(["freshness", *place])
    cli.main(["views", *place])
    assert "v_daily_quality_metrics" in capsys.readouterr().out


def test_stream_arguments():
    places = ["--in-root", "a", "--out-root", "b", "--warehouse", "w"]
    with pytest.raises(SystemExit):
        parse_args(["stream", *places])
    options = parse_args(["stream", *places, "--checkpoint", "c", "--portfolio-form", "lines"])
    assert options.run_date == [] and options.portfolio_form == "lines" and not options.quarantine
