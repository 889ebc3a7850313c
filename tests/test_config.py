import pytest

from fixtures import platform_tables
from spendlens.config import spec_from_vars
from spendlens.plans import build
from spendlens.spec import SpecError

VARS = {
    "output_dataset_id": "reports",
    "timezone": "Europe/Berlin",
    "ads_service": {
        "active": True,
        "account_ids": [1000],
        "source_dataset_id": "raw_ads",
        "conversions": [{"event_name": "purchase", "output_name": "purchases"}],
        "regexp_filters": [{"dimension": "platform", "expression": "^Insta", "result": "false"}],
        "actions": True,
        "models": {
            "daily_platform": {
                "active": True,
                "table_id": "daily_platform_v2",
                "dimensions": [{"name": "date", "type": "DATE", "expression": "date"},
                               {"name": "platform", "type": "STRING", "expression": "platform"}],
                "metrics": [{"name": "cost", "type": "FLOAT64", "expression": "sum(cost)"},
                            {"name": "purchases", "type": "FLOAT64",
                             "expression": "sum(actions_purchases)", "active": True}],
            }
        },
    },
    "external_project": {"active": True, "project_id": "",
                         "schema_settings": {"location": "EU", "description": "copy",
                                             "friendly_name": "Copy"}},
}


def test_spec_from_vars_reads_every_setting():
    s = spec_from_vars(VARS, "ads_service", "daily_platform", "platform")
    assert s.target == "reports.daily_platform_v2"
    assert s.source == "raw_ads"
    assert s.selection == "all"
    assert [f.name for f in s.fields] == ["date", "platform", "cost", "purchases"]
    assert s.account_ids == (1000,)
    assert s.regex_filters[0].result is False
    assert s.actions and not s.action_values and not s.pivots
    assert s.timezone == "Europe/Berlin"
    # only the campaign and multi-fact reports copy themselves to the external project
    assert not s.external.active and s.external.database == "reports"
    assert s.is_active
    # the campaign-style reports pick default fields, then active ones
    # (here no dimension is marked default or active, so that spec has no dimension)
    with pytest.raises(SpecError):
        spec_from_vars(VARS, "ads_service", "daily_platform", "campaign")
    c = spec_from_vars(VARS, "ads_service", "daily_platform", "campaign", selection="all")
    assert [f.name for f in c.selected_metrics] == ["cost", "purchases"]
    assert c.external.active
    # regex filters, actions and conversions are platform-report settings only
    assert c.regex_filters == () and not c.actions and c.conversions == ()


def test_missing_flags_mean_inactive_and_build_an_empty_table(spark):
    v = {**VARS, "ads_service": {**VARS["ads_service"], "active": None}}
    s = spec_from_vars(v, "ads_service", "daily_platform", "platform")
    assert not s.is_active
    assert build(spark, "platform", s).count() == 0


def test_spec_from_vars_builds_the_report(spark):
    s = spec_from_vars(VARS, "ads_service", "daily_platform", "platform")
    out = build(spark, "platform", s, tables=platform_tables(spark))
    # account 1000 only; the regex filter drops Instagram and the NULL platform
    assert {r.platform for r in out.collect()} == {"Facebook"}


def test_bad_field_is_a_spec_error():
    v = {"svc": {"active": True, "models": {"m": {"active": True,
                                                  "dimensions": [{"name": "x"}]}}}}
    with pytest.raises(SpecError):
        spec_from_vars(v, "svc", "m", "platform")


def test_source_is_required_to_read_storage(spark):
    s = spec_from_vars(VARS, "ads_service", "daily_platform", "platform", source="")
    with pytest.raises(SpecError):
        build(spark, "platform", s)


def test_cli_runs_a_report_from_a_vars_file(spark, tmp_path):
    import json

    from spendlens.__main__ import main
    from spendlens.sinks import ensure_schema
    src = tmp_path / "raw"
    for name, df in platform_tables(spark).items():
        df.write.parquet(str(src / name))
    v = json.loads(json.dumps(VARS))
    v["output_dataset_id"] = "cli_reports"
    v["ads_service"]["source_dataset_id"] = str(src)
    v["external_project"]["active"] = False
    path = tmp_path / "vars.json"
    path.write_text(json.dumps(v))
    ensure_schema(spark, "cli_reports")
    args = ["--vars", str(path), "--service", "ads_service", "--model", "daily_platform",
            "--kind", "platform", "--run-ts", "2024-02-01T12:00:00"]
    assert main(["schema"] + args) == 0
    assert main(["run"] + args) == 0
    out = spark.table("cli_reports.daily_platform_v2")
    assert {r.platform for r in out.collect()} == {"Facebook"}


def test_cluster_settings_scale_with_the_shuffle():
    from spendlens.session import cluster_settings
    small, big = cluster_settings(1 << 30), cluster_settings(10 << 40)
    assert int(small["spark.sql.shuffle.partitions"]) == 200
    assert int(big["spark.sql.shuffle.partitions"]) > 100 * 200 // 2
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


EXAMPLE = [("social_ads", "platform_report", "platform"),
           ("business_ads", "campaign_report", "campaign"),
           ("search_ads", "ad_group_report", "ad_group"),
           ("search_ads", "keyword_report", "keyword"),
           ("video_ads", "ad_report", "multi_fact")]


@pytest.mark.parametrize("service,model,kind", EXAMPLE)
def test_example_vars_build_every_report_kind(spark, service, model, kind):
    import json
    import os

    from spendlens.catalog.standins import spark_sources
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                        "examples", "vars.json")
    spec = spec_from_vars(json.load(open(path)), service, model, kind,
                          run_ts=__import__("datetime").datetime(2024, 2, 1))
    assert spec.external.active == (kind in ("campaign", "multi_fact"))
    df = build(spark, kind, spec, tables=spark_sources(spark, "/root/testdata/sf0.001", kind))
    assert df.columns == [f.name for f in spec.fields]
    assert df.count() > 0


def test_cli_runs_and_republishes_a_campaign_report(spark, tmp_path):
    import json
    import os

    from spendlens.__main__ import main
    from spendlens.catalog.standins import spark_sources
    from spendlens.sinks import ensure_schema
    src = tmp_path / "raw"
    for name, df in spark_sources(spark, "/root/testdata/sf0.001", "campaign").items():
        df.write.parquet(str(src / name))
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                        "examples", "vars.json")
    v = json.load(open(path))
    v["output_dataset_id"] = "cli_home"
    v["external_project"]["schema_settings"]["friendly_name"] = "Copies"
    v["business_ads"]["source_dataset_id"] = str(src)
    vars_file = tmp_path / "vars.json"
    vars_file.write_text(json.dumps(v))
    ensure_schema(spark, "cli_home")
    assert main(["run", "--vars", str(vars_file), "--service", "business_ads",
                 "--model", "campaign_report", "--kind", "campaign",
                 "--run-ts", "2024-02-01T12:00:00"]) == 0
    home = spark.table("cli_home.business_campaign_daily")
    # the external project has no id here, so the copy targets the home table itself: the
    # republish reads and replaces the same table, which goes through a staging table
    assert home.count() > 0
    assert home.columns == ["date", "campaign_name", "account_name", "cost", "clicks",
                            "conversions", "last_synced_at"]
    assert not spark.catalog.tableExists("cli_home.business_campaign_daily__staging")
    # CREATE SCHEMA IF NOT EXISTS leaves an existing schema as it is, as in the source
    props = {r[0]: r[1] for r in spark.sql("DESCRIBE DATABASE EXTENDED cli_home").collect()}
    assert "Copies" not in str(props.get("Properties"))


def test_vars_load_from_yaml_like_json(tmp_path):
    import json
    import os

    yaml = pytest.importorskip("yaml")
    from spendlens.__main__ import load_vars
    src = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                       "examples", "vars.json")
    data = json.load(open(src))
    path = tmp_path / "vars.yaml"
    path.write_text(yaml.safe_dump(data))
    assert load_vars(str(path)) == data == load_vars(src)


def test_fields_are_picked_where_the_flag_equals_true():
    v = {"svc": {"active": True, "models": {"m": {
        "active": True, "stitch": "chained", "history_order": "updated_at", "history_tiebreak": "v",
        "dimensions": [{"name": "a", "type": "STRING", "expression": "a", "default": True},
                       {"name": "b", "type": "STRING", "expression": "b", "active": "false"},
                       {"name": "c", "type": "STRING", "expression": "c", "active": 1}]}}}}
    s = spec_from_vars(v, "svc", "m", "multi_fact")
    assert [f.name for f in s.selected_dimensions] == ["a"]
    assert (s.stitch, s.history_order, s.history_tiebreak) == ("chained", "updated_at", ("v",))
    assert spec_from_vars(v, "svc", "m", "multi_fact", stitch="grain_safe").stitch == "grain_safe"
