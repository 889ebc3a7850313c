import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from spendlens.operators import (account_allow_list, assert_unique, attach_sync, build_report,
                                 current_only, latest_by, left_join, pivot_metrics, regex_filters,
                                 rollup, stitch_facts, sync_info)
from spendlens.operators.enrich import chain, one_day_per_group
from spendlens.operators.facts import constant_sum, product_sum
from spendlens.spec import ConversionSpec, FieldSpec, RegexFilter, ReportSpec, SpecError

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def test_rollup_sums_constants_and_product(spark):
    df = spark.createDataFrame(
        [(D1, 1, 2.0, 3, 1.5), (D1, 1, 1.0, None, 2.0), (D2, 1, None, 1, None)],
        "date date, ad bigint, spend double, qty bigint, price double")
    out = rollup(df, ["date", "ad"],
                 {"cost": F.sum("spend"), "zero": constant_sum(0),
                  "rev": product_sum("qty", "price")},
                 constants={"conversions": F.lit(0).cast("bigint")})
    assert rows(out) == [(D1, 1, 3.0, 0, 4.5, 0), (D2, 1, None, 0, None, 0)]
    assert dict(out.dtypes)["zero"] == "bigint"


def test_current_only_drops_false_and_null_flags(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id bigint, is_current boolean")
    assert rows(current_only(df)) == [(1, True)]


def test_latest_by_newest_then_tiebreak_nulls_last(spark):
    df = spark.createDataFrame(
        [(1, "old", dt.datetime(2024, 1, 1), 1), (1, "new", dt.datetime(2024, 1, 5), 2),
         (2, "b", dt.datetime(2024, 1, 3), 9), (2, "a", dt.datetime(2024, 1, 3), 4),
         (3, "nul", None, 1), (3, "dated", dt.datetime(2020, 1, 1), 2),
         (None, "x", dt.datetime(2024, 1, 1), 1), (None, "y", dt.datetime(2024, 2, 1), 2)],
        "id bigint, name string, t timestamp_ntz, v bigint")
    out = latest_by(df, ["id"], "t", ["v"])
    assert rows(out, "id", "name") == [(1, "new"), (2, "a"), (3, "dated"), (None, "y")]
    assert_unique(out, ["id"])
    with pytest.raises(ValueError):
        assert_unique(df, ["id"])


def test_pivot_semantics_and_names(spark):
    df = spark.createDataFrame(
        [(1, "purchase", 2.0), (1, "purchase", 3.0), (1, "view", 9.0),
         (2, "view", 1.0),                      # key with only unlisted values
         (3, "purchase", None),                 # listed value with only NULL amounts
         (4, None, 5.0)],
        "k bigint, action string, value double")
    out = pivot_metrics(df, ["k"], "action",
                        [ConversionSpec("purchase", "buys"), ConversionSpec("cart", "carts")],
                        {"actions": F.col("value"), "n": F.lit(1)})
    assert out.columns == ["k", "actions_buys", "actions_carts", "n_buys", "n_carts"]
    assert rows(out) == [(1, 5.0, None, 2, None), (2, None, None, None, None),
                         (3, None, None, 1, None), (4, None, None, None, None)]
    pruned = pivot_metrics(df, ["k"], "action", [("purchase", "buys")], {"actions": F.col("value")},
                           prune_unlisted=True)
    assert rows(pruned) == [(1, 5.0), (3, None)]


def test_left_join_string_normalised_keys_and_misses(spark):
    fact = spark.createDataFrame([(1, 10.0), (2, 5.0), (None, 1.0)], "ad_id bigint, cost double")
    dim = spark.createDataFrame([("1", "one"), ("3", "three"), (None, "null")], "id string, name string")
    out = left_join(fact, dim, [("ad_id", "id")], {"ad_name": "name", "dim_id": "id"},
                    normalise=True)
    assert rows(out, "ad_id", "ad_name", "dim_id") == [(1, "one", "1"), (2, None, None),
                                                        (None, None, None)]
    # without normalisation Spark coerces too, but the string form is what is compared
    frac = spark.createDataFrame([(1.0,)], "ad_id double")
    with pytest.raises(TypeError):
        left_join(frac, dim, [("ad_id", "id")], {"n": "name"}, normalise=True)
    with pytest.raises(ValueError):
        left_join(fact, dim, [("ad_id", "id")], {"cost": "name"})


def test_allow_list_casts_ids_to_column_type(spark):
    df = spark.createDataFrame([("1",), ("2",), (None,), ("10",)], "account_id string")
    assert rows(account_allow_list(df, "account_id", (1, 10))) == [("1",), ("10",)]
    assert rows(account_allow_list(df, "account_id", ())) == rows(df)
    num = spark.createDataFrame([("7",), ("8",)], "advertiser_id string")
    assert rows(account_allow_list(num, "advertiser_id", (7,), cast="INT64")) == [("7",)]
    bad = spark.createDataFrame([("x7",)], "advertiser_id string")
    with pytest.raises(Exception):  # strict cast of a malformed id raises
        account_allow_list(bad, "advertiser_id", (7,), cast="INT64").collect()


def test_regex_filters_partial_match_and_nulls(spark):
    df = spark.createDataFrame([("Facebook",), ("Instagram",), (None,), ("fb_test",)], "p string")
    keep = regex_filters(df, [RegexFilter("p", "book", True)])
    assert rows(keep) == [("Facebook",)]
    drop = regex_filters(df, [RegexFilter("p", "book", False)])
    assert rows(drop) == [("Instagram",), ("fb_test",)]          # NULL dropped for both wants
    both = regex_filters(df, [RegexFilter("p", "^[A-Z]", True), RegexFilter("p", "gram$", False)])
    assert rows(both) == [("Facebook",)]
    assert rows(regex_filters(df, None)) == rows(df)


def test_sync_info_one_row_even_when_empty(spark):
    empty = spark.createDataFrame([], "date date, synced timestamp_ntz")
    s = sync_info(empty, F.col("synced"), F.col("date"))
    assert s.collect()[0].asDict() == {"max_synced_at": None, "max_data_date": None}
    api = spark.createDataFrame([(1,), (2,)], "x bigint")
    out = attach_sync(api, s)
    assert out.count() == 2 and set(out.columns) == {"x", "last_synced_at", "last_data_date"}


def _spec(dims, mets):
    return ReportSpec(target="db.t", dimensions=tuple(dims), metrics=tuple(mets))


def test_build_report_groups_on_casted_dims_and_keeps_names(spark):
    api = spark.createDataFrame([(1.2, 1.0), (0.8, 2.0), (2.5, 4.0), (None, 8.0)],
                                "cost double, v double")
    spec = _spec([FieldSpec("cost", "INT64", "cost")],
                 [FieldSpec("total", "FLOAT64", "sum(cost)"), FieldSpec("n", "INT64", "count(*)"),
                  FieldSpec("vv", "INT64", "sum(v) / 3")])
    out = build_report(api, spec)
    # 1.2 and 0.8 both cast to 1 and form one group; sum(cost) reads the api column
    assert rows(out) == [(1, 2.0, 2, 1), (3, 2.5, 1, 1), (None, None, 1, 3)]
    assert [f.metadata["comment"] for f in out.schema.fields] == [
        "[db_field_name = cost]", "[db_field_name = total]", "[db_field_name = n]",
        "[db_field_name = vv]"]


def test_build_report_errors_are_spec_errors(spark):
    api = spark.createDataFrame([(1, 2)], "x bigint, y bigint")
    # a metric over a grouped column is fine; one over an ungrouped column needs an aggregate
    ok = build_report(api, _spec([FieldSpec("a", "INT64", "x")], [FieldSpec("m", "INT64", "x + 1")]))
    assert rows(ok) == [(1, 2)]
    with pytest.raises(SpecError):
        build_report(api, _spec([FieldSpec("a", "INT64", "x")], [FieldSpec("m", "INT64", "y + 1")]))
    with pytest.raises(SpecError):
        build_report(api, _spec([FieldSpec("a", "INT64", "no_such_col")], []))


def test_stitch_as_written_fans_out_and_blanks_after_a_missing_link(spark):
    k = "date date, ad_id bigint, _gn_id string"
    spine = spark.createDataFrame([(D1, 1, "a", 1.0), (D2, 1, "a", 2.0), (D1, 2, "b", 4.0)],
                                  k + ", cost double")
    page = spark.createDataFrame([(D1, 1, "a", 5), (D1, 1, "z", 7)], k + ", p bigint")
    attr = spark.createDataFrame([(D1, 1, "a", 1), (D2, 1, "a", 2)], k + ", x bigint")
    eng = spark.createDataFrame([(D1, 1, "a", 10), (D1, 2, "b", 20)], k + ", y bigint")
    aw = stitch_facts(spine, (page, ["p"]), [(attr, ["x"]), (eng, ["y"])], mode="as_written")
    # (D1,1,a): 2 page rows (page ignores _gn_id) x 2 attribution rows (no date) x 1 engagement
    # (D2,1,a): no page row x 2 attribution rows; (D1,2,b): no attribution -> engagement blank
    assert rows(aw, "date", "ad_id", "p", "x", "y") == sorted([
        (D1, 1, 5, 1, 10), (D1, 1, 5, 2, 10), (D1, 1, 7, 1, 10), (D1, 1, 7, 2, 10),
        (D2, 1, None, 1, 10), (D2, 1, None, 2, 10),
        (D1, 2, None, None, None)], key=lambda t: tuple((v is None, str(v)) for v in t))
    gs = stitch_facts(spine, (page, ["p"]), [(attr, ["x"]), (eng, ["y"])], mode="grain_safe")
    assert rows(gs, "date", "ad_id", "p", "x", "y") == [
        (D1, 1, 5, 1, 10), (D1, 2, None, None, 20), (D2, 1, None, 2, None)]
    assert aw.columns == gs.columns
    ch = stitch_facts(spine, (page, ["p"]), [(attr, ["x"]), (eng, ["y"])], mode="chained")
    # chained: the page as the source joins it, and the source's chain (no attribution ->
    # engagement blank) on the whole grain, so the chain multiplies nothing
    assert rows(ch, "date", "ad_id", "p", "x", "y") == [
        (D1, 1, 5, 1, 10), (D1, 1, 7, 1, 10), (D1, 2, None, None, None), (D2, 1, None, 2, None)]
    assert rows(stitch_facts(spine, (page, ["p"]), [(attr, ["x"]), (eng, ["y"])])) == rows(aw)
    with pytest.raises(ValueError, match="chained"):
        one_day_per_group([eng, attr])
    one_day_per_group([eng])


def test_latest_by_default_tiebreak_is_total(spark):
    df = spark.createDataFrame(
        [(1, "b", dt.datetime(2024, 1, 3), 9), (1, "a", dt.datetime(2024, 1, 3), 9),
         (1, "c", dt.datetime(2024, 1, 1), 1)],
        "id bigint, name string, t timestamp_ntz, v bigint")
    # tied on t: every other column breaks the tie (name ascending first)
    picks = {latest_by(df.repartition(3), ["id"], "t").first().name for _ in range(3)}
    assert picks == {"a"}


def test_regex_filters_take_java_syntax(spark):
    df = spark.createDataFrame([("Ab",), ("ab",), ("fooBAR",), ("a.b",), ("axb",), ("x",)], "d string")

    def kept(pattern):
        spec = ReportSpec(target="t", dimensions=(FieldSpec("d", "STRING", "d"),),
                          regex_filters=(RegexFilter("d", pattern),))
        return [r.d for r in regex_filters(df, spec.regex_filters).orderBy("d").collect()]

    assert kept(r"^\p{Lu}") == ["Ab"]
    assert kept(r"foo(?i)bar") == ["fooBAR"]
    assert kept(r"\Qa.b\E") == ["a.b"]
    assert kept(r"^x\z") == ["x"]


def test_required_columns_match_in_any_letter_case(spark):
    from spendlens.sources.tables import require_columns
    df = spark.createDataFrame([(1, 2, 3)], "Spend int, other int, `DAY` int")
    out = require_columns(df, ["spend", "day", "spend"], "fact")
    assert out.columns == ["spend", "day"] and rows(out) == [(1, 3)]
    assert require_columns(df, [], "fact").columns == ["Spend", "other", "DAY"]


def test_chain_nests_and_equals_level_by_level_joins(spark):
    base = spark.createDataFrame([(1, 10), (2, 11), (3, None), (4, 99)], "k int, a int")
    a = spark.createDataFrame([(10, 20, "a10"), (11, None, "a11"), (12, 21, "a12")], "id int, b int, n string")
    b = spark.createDataFrame([(20, 30, "b20"), (21, 31, "b21")], "id int, c int, n string")
    c = spark.createDataFrame([(30, "c30"), (30, "c30b")], "id int, n string")
    for how in ("left", "inner"):
        links = [(a, [("a", "id")], {"a_name": "n", "__b": "b"}, how),
                 (b, [("__b", "id")], {"b_id": "id", "b_name": "n", "__c": "c"}, how),
                 (c, [("__c", "id")], {"c_name": "n"}, how),
                 (b, [("k", "id")], {"other": "n"}, "left")]
        level = base
        for dim, on, take, kind in links:
            level = left_join(level, dim, on, take, how=kind)
        cols = ("k", "a_name", "b_id", "b_name", "c_name", "other")
        assert rows(chain(base, links), *cols) == rows(level, *cols)
    # an inner link below a left one drops rows of the base, nested or not
    mixed = [(a, [("a", "id")], {"a_name": "n", "__b": "b"}, "left"),
             (b, [("__b", "id")], {"b_name": "n"}, "inner")]
    assert rows(chain(base, mixed), "k", "a_name", "b_name") == [(1, "a10", "b20")]
