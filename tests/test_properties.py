"""Properties from SURVEY section 5.3, checked against plain-Python brute force."""

import datetime as dt
import os
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from spendlens.operators import latest_by, left_join, pivot_metrics, rollup, stitch_facts

# deterministic examples by default (a green suite stays green); SPENDLENS_RANDOM=1 and a
# larger SPENDLENS_EXAMPLES explore further
SETTINGS = dict(max_examples=int(os.environ.get("SPENDLENS_EXAMPLES", "8")), deadline=None,
                derandomize=os.environ.get("SPENDLENS_RANDOM") != "1",
                suppress_health_check=[HealthCheck.function_scoped_fixture])

small = st.integers(min_value=0, max_value=4)
vals = st.one_of(st.none(), st.integers(min_value=-50, max_value=50))


@settings(**SETTINGS)
@given(st.lists(st.tuples(small, small, vals), min_size=0, max_size=40))
def test_rollup_matches_brute_force_and_grain_is_unique(spark, data):
    df = spark.createDataFrame(data, "a bigint, b bigint, v bigint")
    out = rollup(df, ["a", "b"], {"s": F.sum("v"), "n": F.count(F.lit(1))})
    expect = defaultdict(lambda: [None, 0])
    for a, b, v in data:
        e = expect[(a, b)]
        e[0] = v if e[0] is None else (e[0] if v is None else e[0] + v)
        e[1] += 1
    assert sorted(rows(out)) == sorted((a, b, s, n) for (a, b), (s, n) in expect.items())
    assert out.count() == out.select("a", "b").distinct().count()


@settings(**SETTINGS)
@given(st.lists(st.tuples(small, st.sampled_from(["x", "y", "z", None]), vals), max_size=40))
def test_pivot_cells_sum_to_the_filtered_long_total(spark, data):
    df = spark.createDataFrame(data, "k bigint, e string, v bigint")
    out = pivot_metrics(df, ["k"], "e", [("x", "x"), ("y", "y")], {"m": F.col("v")})
    got = {r.k: (r.m_x, r.m_y) for r in out.collect()}
    assert set(got) == {k for k, _, _ in data}          # every key group appears
    for ev, idx in (("x", 0), ("y", 1)):
        total = [v for _, e, v in data if e == ev and v is not None]
        cells = [c[idx] for c in got.values() if c[idx] is not None]
        assert sum(cells) == sum(total)


@settings(**SETTINGS)
@given(st.lists(st.tuples(small, st.integers(0, 5), st.integers(0, 1000)), min_size=1, max_size=40,
                unique_by=lambda t: t[2]))
def test_latest_by_is_unique_and_newest(spark, data):
    df = spark.createDataFrame(data, "id bigint, t bigint, v bigint")
    out = {r.id: (r.t, r.v) for r in latest_by(df, ["id"], "t", ["v"]).collect()}
    best = {}
    for i, t, v in data:
        if i not in best or (t, -v) > (best[i][0], -best[i][1]):
            best[i] = (t, v)
    assert out == best


@settings(**SETTINGS)
@given(st.lists(st.tuples(small, small), max_size=30),
       st.lists(st.tuples(small, st.text("ab", max_size=2)), max_size=10, unique_by=lambda t: t[0]))
def test_join_to_a_unique_dimension_keeps_row_count(spark, facts, dims):
    f = spark.createDataFrame(facts, "k bigint, v bigint")
    d = spark.createDataFrame(dims, "id bigint, name string")
    out = left_join(f, d, [("k", "id")], {"name": "name"})
    assert out.count() == len(facts)


D0 = dt.date(2024, 1, 1)


@settings(**SETTINGS)
@given(st.sets(st.tuples(small, st.integers(0, 3)), min_size=1, max_size=12))
def test_as_written_equals_grain_safe_when_gn_is_one_to_one(spark, keys):
    # _gn_id identifies one (ad, day); attribution, engagement and event cover every key
    spine_rows = [(D0 + dt.timedelta(days=d), ad, f"{ad}-{d}", ad * 10 + d) for ad, d in keys]
    schema = "date date, ad_id bigint, _gn_id string, m bigint"
    spine = spark.createDataFrame(spine_rows, schema)
    facts = [(spark.createDataFrame(spine_rows, schema).withColumnRenamed("m", f"m{i}"), [f"m{i}"])
             for i in range(4)]
    page = (spark.createDataFrame(spine_rows, schema).withColumnRenamed("m", "p"), ["p"])
    aw = stitch_facts(spine, page, facts, mode="as_written")
    gs = stitch_facts(spine, page, facts, mode="grain_safe")
    assert rows(aw) == rows(gs)
    assert aw.count() == len(spine_rows)


fact_rows = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 2), st.sampled_from("ab"),
                               st.integers(1, 9)), max_size=8)


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 2), st.sampled_from("ab"),
                          st.integers(1, 9)), min_size=1, max_size=6),
       fact_rows, fact_rows, fact_rows, fact_rows, fact_rows)
def test_as_written_matches_a_literal_join_chain(spark, spine, page, a, e, ev, v):
    """Nested chain == left-to-right chain keyed on the previous fact, fan-out included."""
    def df(data, m):
        return spark.createDataFrame(
            [(D0 + dt.timedelta(days=d), ad, g, x) for d, ad, g, x in data],
            f"date date, ad_id bigint, _gn_id string, {m} bigint")

    out = stitch_facts(df(spine, "s"), (df(page, "p"), ["p"]),
                       [(df(a, "a"), ["a"]), (df(e, "e"), ["e"]), (df(ev, "ev"), ["ev"]),
                        (df(v, "v"), ["v"])], mode="as_written")
    expect = []
    for d, ad, g, s in spine:
        for p in [r for r in page if r[1] == ad and r[0] == d] or [None]:
            prev = (ad, g)
            chains = [[]]
            for fact in (a, e, ev, v):
                grown = []
                for c in chains:
                    key = prev if not c else (None if c[-1] is None else (c[-1][1], c[-1][2]))
                    hits = [r for r in fact if key is not None and (r[1], r[2]) == key]
                    grown += [c + [h] for h in hits] or [c + [None]]
                chains = grown
            for c in chains:
                expect.append((D0 + dt.timedelta(days=d), ad, g, s, p and p[3],
                               *[(r[3] if r else None) for r in c]))
    got = rows(out, "date", "ad_id", "_gn_id", "s", "p", "a", "e", "ev", "v")
    key = lambda t: tuple((x is None, str(x)) for x in t)
    assert got == sorted(expect, key=key)


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 2), st.sampled_from("ab"),
                          st.integers(1, 9)), min_size=1, max_size=6, unique_by=lambda t: t[:3]),
       fact_rows, fact_rows, fact_rows, fact_rows, fact_rows)
def test_chained_matches_a_literal_chain_on_the_grain(spark, spine, page, a, e, ev, v):
    """Chained: the page joins on (ad, date) as in the source; each link joins the previous
    fact on (date, ad, gn), which never multiplies rows of rolled-up facts."""
    def uniq(data):
        seen = {}
        for d, ad, g, x in data:
            seen.setdefault((d, ad, g), x)
        return [(*k, x) for k, x in seen.items()]

    page, a, e, ev, v = (uniq(x) for x in (page, a, e, ev, v))

    def df(data, m):
        return spark.createDataFrame(
            [(D0 + dt.timedelta(days=d), ad, g, x) for d, ad, g, x in data],
            f"date date, ad_id bigint, _gn_id string, {m} bigint")

    out = stitch_facts(df(spine, "s"), (df(page, "p"), ["p"]),
                       [(df(a, "a"), ["a"]), (df(e, "e"), ["e"]), (df(ev, "ev"), ["ev"]),
                        (df(v, "v"), ["v"])], mode="chained")
    expect = []
    for d, ad, g, s in spine:
        pages = [r[3] for r in page if r[:2] == (d, ad)] or [None]
        vals, key = [], (d, ad, g)
        for fact in (a, e, ev, v):
            hit = next((r for r in fact if key is not None and r[:3] == key), None)
            vals.append(hit[3] if hit else None)
            key = hit[:3] if hit else None
        expect += [(D0 + dt.timedelta(days=d), ad, g, s, p, *vals) for p in pages]
    got = rows(out, "date", "ad_id", "_gn_id", "s", "p", "a", "e", "ev", "v")
    key = lambda t: tuple((x is None, str(x)) for x in t)
    assert got == sorted(expect, key=key)


@settings(**SETTINGS)
@given(st.sets(st.tuples(small, st.integers(0, 3)), min_size=1, max_size=10),
       st.lists(st.booleans(), min_size=50, max_size=50))
def test_chained_equals_as_written_when_gn_is_one_ad_day(spark, keys, present):
    """With one _gn_id per ad-day, the pair-free mode equals the source's literal joins,
    missing links (NULL propagation) included."""
    spine_rows = [(D0 + dt.timedelta(days=d), ad, f"{ad}-{d}", ad * 10 + d) for ad, d in keys]
    schema = "date date, ad_id bigint, _gn_id string, m bigint"
    flags = iter(present * 10)
    def some(name):
        kept = [r for r in spine_rows if next(flags)]
        return spark.createDataFrame(kept, schema).withColumnRenamed("m", name), [name]
    spine = spark.createDataFrame(spine_rows, schema)
    page, facts = some("p"), [some(f"m{i}") for i in range(4)]
    aw = stitch_facts(spine, page, facts, mode="as_written")
    ch = stitch_facts(spine, page, facts, mode="chained")
    assert rows(aw) == rows(ch)


DELIMS = set(' \t\n[](){}/|\\<>!?@"^#$&~_,.:;*%+-')


def _initcap_reference(s):
    out, start = [], True
    for ch in s.lower():
        if ch in DELIMS or ch.isspace():
            out.append(ch)
            start = True
        else:
            out.append(ch.upper() if start else ch)
            start = False
    return "".join(out)


@settings(**SETTINGS)
@given(st.lists(st.text(alphabet="abcXYZ019 _-.#/()\t", max_size=20), min_size=1, max_size=20))
def test_initcap_delims_matches_a_character_rule(spark, texts):
    from spendlens.functions import initcap_delims
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r.o for r in df.select(initcap_delims("s").alias("o")).collect()]
    assert got == [_initcap_reference(t) for t in texts]


@settings(**SETTINGS)
@given(st.lists(st.one_of(st.integers(-40, 40).map(lambda k: k / 2),
                          st.floats(-1e6, 1e6, allow_nan=False)), min_size=1, max_size=30))
def test_float_to_int64_rounds_half_away_from_zero(spark, xs):
    from decimal import ROUND_HALF_UP, Decimal

    from pyspark.sql import types as T

    from spendlens.functions import typed_cast
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r.o for r in df.select(typed_cast(F.col("x"), T.LongType(), T.DoubleType()).alias("o"))
           .collect()]
    assert got == [int(Decimal(repr(x)).quantize(Decimal(1), rounding=ROUND_HALF_UP)) for x in xs]


@settings(**SETTINGS)
@given(st.lists(st.tuples(small, small), min_size=1, max_size=15),
       st.lists(st.tuples(small, small, st.sampled_from(["x", "y", "z", None]), vals), max_size=30))
def test_pruned_pivot_joins_back_like_the_full_pivot(spark, spine, long):
    spine_df = spark.createDataFrame(spine, "a bigint, b bigint")
    long_df = spark.createDataFrame(long, "a bigint, b bigint, e string, v bigint")
    outs = []
    for prune in (False, True):
        wide = pivot_metrics(long_df, ["a", "b"], "e", [("x", "x"), ("y", "y")],
                             {"m": F.col("v")}, prune_unlisted=prune)
        outs.append(rows(left_join(spine_df, wide, [("a", "a"), ("b", "b")],
                                   {"m_x": "m_x", "m_y": "m_y"})))
    assert outs[0] == outs[1]


opt_key = st.one_of(st.none(), st.integers(0, 3))


@settings(**SETTINGS)
@given(st.lists(st.tuples(opt_key, st.integers(0, 9)), min_size=1, max_size=15),
       st.lists(st.tuples(opt_key, opt_key), max_size=8),
       st.lists(st.tuples(opt_key, st.sampled_from("pq")), max_size=8))
def test_dimension_chain_first_equals_joining_through_every_level(spark, fact, d1, d2):
    """F ⟕ (A ⟕ B) == (F ⟕ A) ⟕ B for a condition reading only A; duplicates, misses and
    NULL keys included."""
    from spendlens.operators import chain
    f = spark.createDataFrame(fact, "k bigint, v bigint")
    a = spark.createDataFrame(d1, "id bigint, link bigint")
    b = spark.createDataFrame(d2, "id bigint, name string")
    dims = chain(a.select(F.col("id").alias("a_id"), F.col("link").alias("a_link")),
                 [(b, [("a_link", "id")], {"b_name": "name"}, "left")])
    first = left_join(f, dims, [("k", "a_id")], {"a_link": "a_link", "b_name": "b_name"})
    level = left_join(left_join(f, a, [("k", "id")], {"a_link": "link"}),
                      b, [("a_link", "id")], {"b_name": "name"})
    assert rows(first, "k", "v", "a_link", "b_name") == rows(level, "k", "v", "a_link", "b_name")


# (name, declared type, Spark SQL expression, DuckDB expression with the declared cast)
DIM_POOL = [
    ("status", "STRING", "o_orderstatus", "CAST(o_orderstatus AS VARCHAR)"),
    ("prio", "STRING", "o_orderpriority", "CAST(o_orderpriority AS VARCHAR)"),
    ("band", "INT64", "o_totalprice / 50000", "CAST(round(o_totalprice / 50000) AS BIGINT)"),
    ("day", "DATE", "CAST(o_orderdate AS DATE)", "CAST(o_orderdate AS DATE)"),
    ("yr", "INT64", "year(o_orderdate)", "CAST(year(o_orderdate) AS BIGINT)"),
]
MET_POOL = [
    ("n", "INT64", "count(*)", "CAST(count(*) AS BIGINT)"),
    ("total", "FLOAT64", "sum(CAST(o_totalprice AS DECIMAL(18,2)))",
     "CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE)"),
    ("top", "INT64", "max(o_totalprice)", "CAST(round(max(o_totalprice)) AS BIGINT)"),
    ("custs", "INT64", "count(DISTINCT o_custkey)", "CAST(count(DISTINCT o_custkey) AS BIGINT)"),
]


@settings(**SETTINGS)
@given(st.lists(st.sampled_from(range(len(DIM_POOL))), min_size=1, max_size=3, unique=True),
       st.lists(st.sampled_from(range(len(MET_POOL))), max_size=4, unique=True))
def test_random_report_specs_match_duckdb(spark, dims, mets):
    import duckdb

    from spendlens.operators import build_report
    from spendlens.spec import FieldSpec, ReportSpec
    path = "/root/testdata/sf0.001/orders.parquet"
    d = [DIM_POOL[i] for i in dims]
    m = [MET_POOL[i] for i in mets]
    spec = ReportSpec(target="db.t", dimensions=tuple(FieldSpec(n, t, e) for n, t, e, _ in d),
                      metrics=tuple(FieldSpec(n, t, e) for n, t, e, _ in m))
    got = rows(build_report(spark.read.parquet(path), spec))
    select = ", ".join(f"{sql} AS {n}" for n, _, _, sql in d + m)
    groups = ", ".join(str(i + 1) for i in range(len(d)))
    want = duckdb.sql(f"SELECT {select} FROM read_parquet('{path}') GROUP BY {groups}").fetchall()
    key = lambda t: tuple((x is None, str(x)) for x in t)
    assert got == sorted([tuple(r) for r in want], key=key)


REGEX_POOL = [("campaign_name", "_1", True), ("platform", "^Unknown$", False),
              ("account_name", "A", True), ("platform", "book", True),
              ("campaign_name", "NATION_2", False)]


@settings(**SETTINGS)
@given(st.lists(st.integers(0, 5), max_size=4, unique=True),
       st.lists(st.sampled_from(range(len(REGEX_POOL))), max_size=3, unique=True),
       st.booleans())
def test_platform_report_with_random_filters_matches_source_sql(spark, ids, regex, trim):
    """Allow-lists (with and without the inner-join trim) and regex filters vs the
    source-shaped left-join SQL with the same WHERE clause."""
    import duckdb

    from spendlens.catalog.oracle import report_platform_sql
    from spendlens.catalog.specs import PLATFORM_SPEC
    from spendlens.catalog.standins import spark_sources
    from spendlens.plans import platform_report
    from spendlens.sources import loader
    from spendlens.spec import RegexFilter, ReportSpec
    sf = "/root/testdata/sf0.001"
    filters = tuple(RegexFilter(*REGEX_POOL[i]) for i in regex)
    spec = ReportSpec(**{**PLATFORM_SPEC.__dict__, "account_ids": tuple(ids),
                         "regex_filters": filters, "inner_join_trim": trim})
    got = rows(platform_report(spec, loader(spark, "", spark_sources(spark, sf, "platform"))))
    conds = []
    if ids:
        conds.append("account_id IN (" + ", ".join(f"'{i}'" for i in ids) + ")")
    conds += [f"regexp_matches({d}, '{e}') = {str(r).lower()}" for d, e, r in
              (REGEX_POOL[i] for i in regex)]
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    res = con.execute(report_platform_sql(("WHERE " + " AND ".join(conds)) if conds else ""))
    cols = [c[0] for c in res.description]
    want = [tuple(dict(zip(cols, r))[c] for c in PLATFORM_SPEC.schema().fieldNames())
            for r in res.fetchall()]
    key = lambda t: tuple((x is None, str(x)) for x in t)
    assert got == sorted(want, key=key)


@settings(**SETTINGS)
@given(st.sampled_from(["chained", "as_written", "grain_safe"]),
       st.lists(st.integers(0, 3), max_size=3, unique=True))
def test_multi_fact_report_modes_and_allow_lists_match_source_sql(spark, mode, ids):
    import duckdb

    from spendlens.catalog.oracle import report_multi_fact_sql
    from spendlens.catalog.specs import MULTI_FACT_SPEC
    from spendlens.catalog.standins import spark_sources
    from spendlens.plans import multi_fact_report
    from spendlens.sources import loader
    from spendlens.spec import ReportSpec
    sf = "/root/testdata/sf0.001"
    spec = ReportSpec(**{**MULTI_FACT_SPEC.__dict__, "stitch": mode, "account_ids": tuple(ids)})
    got = rows(multi_fact_report(spec, loader(spark, "", spark_sources(spark, sf, "multi_fact"))))
    where = ("WHERE CAST(advertiser_id AS BIGINT) IN (" + ", ".join(map(str, ids)) + ")"
             if ids else "")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{sf}/events.parquet')")
    res = con.execute(report_multi_fact_sql(mode, where))
    cols = [c[0] for c in res.description]
    want = [tuple(dict(zip(cols, r))[c] for c in MULTI_FACT_SPEC.schema().fieldNames())
            for r in res.fetchall()]
    key = lambda t: tuple((x is None, str(x)) for x in t)
    assert got == sorted(want, key=key)


@settings(**SETTINGS)
@given(st.sampled_from(["campaign", "ad_group", "keyword"]),
       st.lists(st.integers(0, 8), max_size=4, unique=True), st.booleans())
def test_reports_with_random_allow_lists_match_source_sql(spark, kind, ids, trim):
    import duckdb

    from spendlens.catalog.oracle import report_campaign_sql, star_report_sql
    from spendlens.catalog.specs import REPORT_SPECS
    from spendlens.catalog.standins import spark_sources
    from spendlens.plans.reports import BUILDERS
    from spendlens.sources import loader
    from spendlens.spec import ReportSpec
    sf = "/root/testdata/sf0.001"
    base = REPORT_SPECS[kind]
    spec = ReportSpec(**{**base.__dict__, "account_ids": tuple(ids), "inner_join_trim": trim})
    got = rows(BUILDERS[kind](spec, loader(spark, "", spark_sources(spark, sf, kind))))
    where = ("WHERE account_id IN (" + ", ".join(map(str, ids)) + ")") if ids else ""
    sql = report_campaign_sql(where) if kind == "campaign" else \
        star_report_sql(kind == "keyword", where)
    con = duckdb.connect()
    for t in ("region", "nation", "supplier", "part", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    res = con.execute(sql)
    cols = [c[0] for c in res.description]
    want = [tuple(dict(zip(cols, r))[c] for c in base.schema().fieldNames())
            for r in res.fetchall()]
    key = lambda t: tuple((x is None, str(x)) for x in t)
    assert got == sorted(want, key=key)


@settings(**SETTINGS)
@given(st.lists(st.integers(0, 366 * 24 * 3600), min_size=1, max_size=30),
       st.sampled_from(["America/New_York", "Europe/Berlin", "Australia/Sydney", "Asia/Kolkata"]))
def test_local_datetime_matches_zoneinfo(spark, offsets, tz):
    """Wall clock of UTC load stamps in a zone, DST transitions of 2024 included."""
    from datetime import datetime, timedelta, timezone
    from zoneinfo import ZoneInfo

    from pyspark.sql import types as T

    from spendlens.functions import local_datetime
    stamps = [datetime(2024, 1, 1) + timedelta(seconds=s) for s in offsets]  # UTC wall clock
    df = spark.createDataFrame([(s,) for s in stamps], "ts timestamp_ntz")
    got = [r.o for r in df.select(local_datetime("ts", tz, T.TimestampNTZType()).alias("o"))
           .collect()]
    want = [s.replace(tzinfo=timezone.utc).astimezone(ZoneInfo(tz)).replace(tzinfo=None)
            for s in stamps]
    assert got == want


@settings(**SETTINGS)
@given(st.lists(st.integers(0, 366 * 24 * 3600), min_size=1, max_size=30),
       st.sampled_from(["UTC", "America/Los_Angeles", "Asia/Tokyo", "Pacific/Kiritimati"]))
def test_utc_date_of_instants_ignores_the_session_zone(spark, offsets, session_tz):
    from datetime import datetime, timedelta

    from pyspark.sql import types as T

    from spendlens.functions import utc_date
    texts = [(datetime(2024, 1, 1) + timedelta(seconds=s)).isoformat(sep=" ") for s in offsets]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "UTC")  # texts are UTC instants
        df = spark.createDataFrame([(t,) for t in texts], "s string") \
                  .selectExpr("CAST(s AS TIMESTAMP) AS ts")
        spark.conf.set("spark.sql.session.timeZone", session_tz)
        got = [str(r.d) for r in df.select(utc_date("ts", T.TimestampType()).alias("d")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [t[:10] for t in texts]
