"""The five report composites, each a lazily built DataFrame.

Every builder takes ``(spec, load)`` where ``load(name, required)`` returns a source
table (see ``sources.loader``) and returns the ``api`` relation; ``*_report`` adds the
allow-list, regex filters and the final regroup. Nothing is executed here: the caller's
write (or collect) is the single action.

Plan shape shared by all reports, chosen for large inputs:

* facts are rolled up first (partial aggregate, one shuffle on the grain);
* pivots are conditional sums over listed events only, grouped on the same grain, so the
  join back to the roll-up reuses that partitioning;
* dimension chains are joined among themselves and then to the fact once;
* with an account allow-list, joins the filtered column depends on become inner joins
  and the list is applied to the dimension before it meets the fact;
* the freshness row is read as one merged scalar subquery (no join), which Catalyst drops
  where no field reads it.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import local_datetime, platform_label, utc_date
from ..operators.enrich import chain, left_join, stitch_facts
from ..operators.facts import constant_sum, product_sum, rollup, sum_of
from ..operators.filters import account_allow_list, allow_list_predicate, regex_filters
from ..operators.history import current_only, latest_by
from ..operators.pivot import pivot_metrics, pivot_name
from ..operators.shape import build_report
from ..operators.sync import attach_sync, rollup_with_sync, run_time_literal, sync_info
from ..operators.weighted import ROWS, stitch_sums, versions, weighed
from ..sources.tables import Loader
from ..spec import STITCH_AS_WRITTEN, ReportSpec
from .lineage import columns_read, is_read, linear
from .links import Link, needed_links

# --- fixed values: source column holding the load time stamp of each row ---
LOAD_STAMP = "_fivetran_synced"


def _trim(spec: ReportSpec) -> bool:
    return bool(spec.account_ids) and spec.inner_join_trim


SYNC_COLUMNS = ("last_synced_at", "last_data_date")
#: The latest load stamp of a group's rows, kept beside its measures for the freshness row.
_SYNCED = "__synced"


def _synced_rollup(spec: ReportSpec, fact: DataFrame, keys: dict, measures: dict, synced_at: Column,
                   read: frozenset[str] | None, stamped: bool, constants: dict | None = None
                   ) -> tuple[DataFrame, DataFrame]:
    """The daily roll-up, cut to the measures that are read, and the freshness row.

    Without filters the freshness row comes from the roll-up (one scan of the fact, its
    exchange reused). An allow-list or a regex filter reaches the fact's scan, which then
    lacks rows that freshness counts: there it reads its two columns apart.
    ``stamped``: ``synced_at`` is an expression over the fact's rows, not a constant.
    """
    measures = {n: c for n, c in measures.items() if is_read(n, read)}
    constants = {n: c for n, c in (constants or {}).items() if is_read(n, read)}
    if spec.account_ids or spec.regex_filters or not any(is_read(c, read) for c in SYNC_COLUMNS):
        return rollup(fact, keys, measures, constants), sync_info(fact, synced_at, keys["date"])
    if stamped:
        report = rollup(fact, keys, {**measures, _SYNCED: F.max(synced_at)})
        report, sync = rollup_with_sync(report, _SYNCED)
    else:
        report, sync = rollup_with_sync(rollup(fact, keys, measures), synced_at)
    for name, c in constants.items():
        report = report.withColumn(name, c)
    return report, sync


def _have(df: DataFrame, *names: str) -> list[str]:
    """Those of the names that ``df`` has (unread measures and dimensions are not made)."""
    return [n for n in names if n in df.columns]


def _declared(spec: ReportSpec, table: str) -> str:
    return table if table in spec.unique_ids else ""


def _with_dims(report: DataFrame, dims: DataFrame, on: list[tuple[str, str]], columns: list[str], how: str,
               declared: str, read: frozenset[str] | None, unique: bool = False,
               normalise: bool = False) -> tuple[DataFrame, list[str]]:
    """Join the dimension chain to the roll-up, unless it can go; and the columns it brought."""
    link = Link(dims, on, {c: c for c in columns}, how, unique=unique, declared=declared)
    if not needed_links([link], read):
        return report, []
    return left_join(report, dims, on, link.take, how=how, normalise=normalise), columns


def finish(api: DataFrame, spec: ReportSpec, account_col: str,
           account_cast: str | None = None) -> DataFrame:
    """Allow-list, regex filters (AND-combined), then the typed regroup."""
    api = account_allow_list(api, account_col, spec.account_ids, account_cast)
    api = regex_filters(api, spec.regex_filters)
    return build_report(api, spec)


# ----------------------------------------------------------------------------------
# R1: platform report (daily ad x publisher platform; snowflake of current versions)
# ----------------------------------------------------------------------------------
# --- fixed values: source fact table of the platform report ---
PLATFORM_FACT = "platform_report"


def platform_api(spec: ReportSpec, load: Loader, fact_name: str = PLATFORM_FACT,
                 read: frozenset[str] | None = None) -> DataFrame:
    fact = load(fact_name, ["date", "ad_id", "publisher_platform", "spend", "clicks",
                            "impressions"])
    keys = ["date", "ad_id", "publisher_platform"]
    report, sync = _synced_rollup(
        spec, fact, {k: F.col(k) for k in keys},
        {"cost": F.sum("spend"), "clicks": F.sum("clicks"), "impressions": F.sum("impressions"),
         "frequency": constant_sum(0), "reach": constant_sum(0)},
        run_time_literal(spec.run_time()), read, stamped=False,
        constants={"conversions": F.lit(0).cast("bigint")})

    # optional single-metric pivots, joined on the roll-up's own grain
    pivot_cols: list[str] = []
    for enabled, suffix, alias in ((spec.actions, "_actions", "actions"),
                                   (spec.action_values, "_action_values", "action_values")):
        conversions = _read_conversions(spec, [alias], read)
        if not enabled or not conversions:
            continue
        long = load(fact_name + suffix, ["ad_id", "publisher_platform", "date",
                                         "action_type", "value"])
        # grouped in the roll-up's key order so the join reuses its hash partitioning
        wide = pivot_metrics(long, keys, "action_type", conversions,
                             {alias: F.col("value")}, prune_unlisted=True)
        names = [pivot_name(alias, c.output_name) for c in conversions]
        report = left_join(report, wide, [(k, k) for k in keys], {n: n for n in names},
                           normalise=("ad_id",))
        pivot_cols += names

    # snowflake ad -> ad set -> campaign -> account, current versions only
    trim = _trim(spec)
    how = "inner" if trim else "left"
    ads = current_only(load("ad_history", ["id", "name", "ad_set_id", "is_current"]))
    ad_sets = current_only(load("ad_set_history", ["id", "name", "campaign_id", "is_current"]))
    campaigns = current_only(load("campaign_history", ["id", "name", "account_id",
                                                       "is_current"]))
    accounts = current_only(load("account_history", ["account_id", "name", "is_current"]))
    if trim:
        accounts = account_allow_list(accounts, "account_id", spec.account_ids)
    base = ads.select(F.col("id").alias("__ad_key"), F.col("name").alias("ad_name"),
                      F.col("ad_set_id").alias("__ad_set_link"))
    links = needed_links([
        Link(ad_sets, [("__ad_set_link", "id")],
             {"ad_set_id": "id", "ad_set_name": "name", "__campaign_link": "campaign_id"}, how,
             declared=_declared(spec, "ad_set_history")),
        Link(campaigns, [("__campaign_link", "id")],
             {"campaign_id": "id", "campaign_name": "name", "__account_link": "account_id"}, how,
             declared=_declared(spec, "campaign_history")),
        Link(accounts, [("__account_link", "account_id")],
             {"account_id": "account_id", "account_name": "name"}, how,
             declared=_declared(spec, "account_history")),
    ], read)
    dims = chain(base, [link.joined() for link in links], normalise=True)
    dim_cols = [c for c in ("ad_name", "ad_set_id", "ad_set_name", "campaign_id", "campaign_name",
                            "account_id", "account_name") if c in dims.columns]
    wide, dim_cols = _with_dims(report, dims, [("ad_id", "__ad_key")], dim_cols, how,
                                "" if links else _declared(spec, "ad_history"), read, normalise=True)

    api = wide.select(
        "date", *_have(wide, "cost", "clicks", "impressions", "frequency", "reach", "conversions"),
        platform_label("publisher_platform").alias("platform"),
        "publisher_platform",
        F.lit(bool(spec.actions)).alias("has_actions"),
        F.lit(bool(spec.action_values)).alias("has_action_values"),
        "ad_id", *dim_cols, *pivot_cols)
    return attach_sync(api, sync)


def platform_report(spec: ReportSpec, load: Loader) -> DataFrame:
    return finish(platform_api(spec, load, read=columns_read(spec, "account_id")), spec, "account_id")


# ----------------------------------------------------------------------------------
# R2: campaign report (daily campaign; newest version of each dimension)
# ----------------------------------------------------------------------------------
# --- fixed values: source fact table and summed columns of the campaign report ---
CAMPAIGN_FACT = "ad_analytics_by_campaign"
CAMPAIGN_MEASURES = ("clicks", "impressions", "comments", "follows", "shares",
                     "landing_page_clicks")


def campaign_api(spec: ReportSpec, load: Loader, fact_name: str = CAMPAIGN_FACT,
                 read: frozenset[str] | None = None) -> DataFrame:
    fact = load(fact_name, ["day", "campaign_id", "cost_in_usd",
                            "external_website_conversions", LOAD_STAMP,
                            *CAMPAIGN_MEASURES])
    measures = {"cost": F.sum("cost_in_usd"), "clicks": F.sum("clicks"),
                "impressions": F.sum("impressions"),
                "conversions": F.sum("external_website_conversions"),
                "revenue": constant_sum(0)}
    measures.update(sum_of("comments", "follows", "shares", "landing_page_clicks"))
    day = utc_date("day", fact.schema["day"].dataType)
    synced = local_datetime(LOAD_STAMP, spec.timezone, fact.schema[LOAD_STAMP].dataType)
    report, sync = _synced_rollup(spec, fact, {"date": day, "campaign_id": F.col("campaign_id")},
                                  measures, synced, read, stamped=True)

    trim = _trim(spec)
    how = "inner" if trim else "left"
    tb = spec.history_tiebreak
    more = tb or ()
    groups = latest_by(load("campaign_group_history", ["id", "name", "last_modified_time", *more]),
                       ["id"], "last_modified_time", tb)
    campaigns = latest_by(load("campaign_history", ["id", "name", "campaign_group_id",
                                                    "account_id", "last_modified_time", *more]),
                          ["id"], "last_modified_time", tb)
    accounts = latest_by(load("account_history", ["id", "name", "last_modified_time", *more]),
                         ["id"], "last_modified_time", tb)
    if trim:
        accounts = account_allow_list(accounts, "id", spec.account_ids)
    base = campaigns.select(F.col("id").alias("__campaign_key"),
                            F.col("name").alias("campaign_name"),
                            F.col("campaign_group_id").alias("__group_link"),
                            F.col("account_id").alias("__account_link"))
    # newest versions are unique by construction
    links = needed_links([
        Link(groups, [("__group_link", "id")],
             {"campaign_group_name": "name", "campaign_group_id": "id"}, unique=True),
        Link(accounts, [("__account_link", "id")], {"account_id": "id", "account_name": "name"},
             how, unique=True),
    ], read)
    dims = chain(base, [link.joined() for link in links])
    dim_cols = [c for c in ("campaign_name", "campaign_group_name", "campaign_group_id",
                            "account_id", "account_name") if c in dims.columns]
    wide, dim_cols = _with_dims(report, dims, [("campaign_id", "__campaign_key")], dim_cols, how, "",
                                read, unique=True)
    api = wide.select(
        "date", "campaign_id", *dim_cols,
        *_have(wide, "clicks", "cost", "impressions", "conversions", "revenue", "comments", "follows",
               "shares", "landing_page_clicks"),
        F.lit(None).cast("timestamp").alias("run_schedule_start"),
        F.lit(None).cast("timestamp").alias("campaign_group_run_schedule_start"))
    return attach_sync(api, sync)


def campaign_report(spec: ReportSpec, load: Loader) -> DataFrame:
    return finish(campaign_api(spec, load, read=columns_read(spec, "account_id")), spec, "account_id")


# ----------------------------------------------------------------------------------
# R3 / R4: ad-group and keyword reports (star of active dimensions + 3-metric pivot)
# ----------------------------------------------------------------------------------
# --- fixed values: source tables and goal measures of the ad-group and keyword reports ---
AD_GROUP_FACT = "ad_performance_report"
KEYWORD_FACT = "keyword_performance_report"
GOALS = "goals_and_funnels_report"
GOAL_MEASURES = ("all_conversions", "all_revenue", "view_through_conversions")


def _star_api(spec: ReportSpec, load: Loader, keyword: bool, fact_name: str,
              read: frozenset[str] | None) -> DataFrame:
    keys = ["date", "campaign_id", "ad_group_id", "account_id"] + (["keyword_id"] if keyword
                                                                    else [])
    fact = load(fact_name, keys + ["spend", "clicks", "impressions", "conversions",
                                   "revenue"])
    synced = run_time_literal(spec.run_time(), "datetime" if keyword else "date")
    report, sync = _synced_rollup(
        spec, fact, {k: F.col(k) for k in keys},
        {"cost": F.sum("spend"), "clicks": F.sum("clicks"), "impressions": F.sum("impressions"),
         "conversions": F.sum("conversions"), "revenue": F.sum("revenue")},
        synced, read, stamped=False)
    pivot_cols: list[str] = []
    conversions = _read_conversions(spec, GOAL_MEASURES, read)
    if spec.pivots and conversions:
        # grouped in the roll-up's key order so the join reuses its hash partitioning
        goals = load(GOALS, keys + list(GOAL_MEASURES) + ["goal"])
        wide = pivot_metrics(goals, keys, "goal", conversions,
                             {m: F.col(m).try_cast("double") for m in GOAL_MEASURES},
                             prune_unlisted=True)
        for c in conversions:
            pivot_cols += [pivot_name(m, c.output_name) for m in GOAL_MEASURES]
        report = left_join(report, wide, [(k, k) for k in keys], {n: n for n in pivot_cols})

    trim = _trim(spec)
    campaigns = current_only(load("campaign_history", ["id", "name", "_gn_active"]), "_gn_active")
    ad_groups = current_only(load("ad_group_history", ["id", "name", "_gn_active"]), "_gn_active")
    accounts = current_only(load("account_history", ["id", "name", "_gn_active"]), "_gn_active")
    if trim:
        accounts = account_allow_list(accounts, "id", spec.account_ids)
    # the account join goes first: under an allow-list it is an inner join that drops rows
    # before the other joins (and its IN filter is inferred onto the fact's account key)
    links = [
        Link(accounts, [("account_id", "id")], {"__account_id": "id", "account_name": "name"},
             "inner" if trim else "left", declared=_declared(spec, "account_history")),
        Link(campaigns, [("campaign_id", "id")], {"campaign_name": "name"},
             declared=_declared(spec, "campaign_history")),
        Link(ad_groups, [("ad_group_id", "id")], {"ad_group_name": "name"},
             declared=_declared(spec, "ad_group_history"))]
    if keyword:
        keywords = current_only(load("keyword_history", ["id", "text", "match_type",
                                                         "_gn_active"]), "_gn_active")
        links.append(Link(keywords, [("keyword_id", "id")],
                          {"keyword_text": "text", "keyword_match_type": "match_type"},
                          declared=_declared(spec, "keyword_history")))
    # the report's account_id is the account's own id
    own = read | {"__account_id"} if read is not None and "account_id" in read else read
    wide, brought = report, set()
    for link in needed_links(links, own):
        wide = left_join(wide, *link.joined())
        brought |= set(link.take)
    account = [F.col("__account_id").alias("account_id")] if "__account_id" in brought else []
    api = wide.select(
        "date", "campaign_id", *_of(brought, "campaign_name"), "ad_group_id",
        *_of(brought, "ad_group_name", "keyword_text", "keyword_match_type"),
        *account, *_of(brought, "account_name"),
        *_have(wide, "clicks", "cost", "impressions", "conversions", "revenue"), *pivot_cols)
    return attach_sync(api, sync)


def _read_conversions(spec: ReportSpec, measures: Iterable[str], read: frozenset[str] | None) -> list:
    """The conversions of which some pivot column is read."""
    return [c for c in spec.conversions if any(is_read(pivot_name(m, c.output_name), read) for m in measures)]


def _of(brought: set[str], *names: str) -> list[str]:
    return [n for n in names if n in brought]


def ad_group_api(spec: ReportSpec, load: Loader, fact_name: str = AD_GROUP_FACT,
                 read: frozenset[str] | None = None) -> DataFrame:
    return _star_api(spec, load, keyword=False, fact_name=fact_name, read=read)


def keyword_api(spec: ReportSpec, load: Loader, fact_name: str = KEYWORD_FACT,
                read: frozenset[str] | None = None) -> DataFrame:
    return _star_api(spec, load, keyword=True, fact_name=fact_name, read=read)


def ad_group_report(spec: ReportSpec, load: Loader) -> DataFrame:
    return finish(ad_group_api(spec, load, read=columns_read(spec, "account_id")), spec, "account_id")


def keyword_report(spec: ReportSpec, load: Loader) -> DataFrame:
    return finish(keyword_api(spec, load, read=columns_read(spec, "account_id")), spec, "account_id")


# ----------------------------------------------------------------------------------
# R5: multi-fact ad report (six daily fact tables stitched onto one spine)
# ----------------------------------------------------------------------------------
# --- fixed values: source tables and measure columns of the multi-fact report ---
MULTI_FACT = "ads_basic_data_metrics_by_day_report"
ATTRIBUTION = ("ads_attribution_metrics_by_day_report",
               ("cta_registration", "cta_purchase", "cta_conversion", "cta_app_install",
                "vta_purchase", "vta_registration", "vta_app_install", "vta_conversion"))
ENGAGEMENT = ("ads_engagement_metrics_by_day_report",
              ("clicks_on_music_disc", "follows", "shares", "comments", "likes",
               "profile_visits"))
IN_APP_EVENT = ("ads_in_app_event_metrics_by_day_report",
                ("subscribe", "start_trial", "search", "ratings", "login", "loan_disbursement",
                 "loan_credit", "loan_apply", "in_app_ad_impr", "in_app_ad_click", "sales_lead",
                 "unlock_achievement", "achieve_level", "spend_credits", "create_gamerole",
                 "join_group", "create_group", "complete_tutorial", "launch_app",
                 "add_to_wishlist", "add_payment_info", "next_day_open", "view_content",
                 "checkout", "app_event_add_to_cart", "purchase", "registration",
                 "app_install", "real_time_app_install"))
VIDEO_PLAY = ("ads_video_play_metrics_by_day_report",
              ("video_views_p100", "video_views_p75", "video_views_p50", "video_views_p25",
               "video_watched_6s", "video_watched_2s", "video_play_actions"))
PAGE_EVENT = ("ads_page_event_metrics_by_day_report",
              ("add_billing", "button_click", "download_start", "form", "initiate_checkout",
               "on_web_add_to_wishlist", "on_web_order", "on_web_subscribe", "online_consult",
               "product_details_page_browse", "user_registration", "web_event_add_to_cart"))
BASIC_MEASURES = {"cost": "spend", "clicks": "clicks",
                  "real_time_conversion": "real_time_conversion", "impressions": "impressions",
                  "conversions": "conversion", "result": "result",
                  "real_time_result": "real_time_result"}
FACT_KEYS = ("stat_time_day", "ad_id", "_gn_id")
CHAIN_FACTS = (ATTRIBUTION, ENGAGEMENT, IN_APP_EVENT, VIDEO_PLAY)
SPINE_MEASURES = ("cost", "clicks", "impressions", "conversions", "result", "real_time_result",
                  "real_time_conversion")
MULTI_DIMS = ("ad_name", "adgroup_id", "adgroup_name", "advertiser_id", "campaign_id",
              "campaign_name", "objective_type", "advertiser_name", "currency")


def _fact_rollup(df: DataFrame, measures: dict) -> DataFrame:
    day = utc_date("stat_time_day", df.schema["stat_time_day"].dataType)
    return rollup(df, {"date": day, "ad_id": "ad_id", "_gn_id": "_gn_id"}, measures)


def _multi_facts(spec: ReportSpec, load: Loader, fact_name: str, read: frozenset[str] | None):
    """The spine's roll-up with its freshness row, and the (roll-up, measures) of the page and chain facts."""
    basic = load(fact_name, [*FACT_KEYS, *BASIC_MEASURES.values(), LOAD_STAMP])
    synced = local_datetime(LOAD_STAMP, spec.timezone, basic.schema[LOAD_STAMP].dataType)
    day = utc_date("stat_time_day", basic.schema["stat_time_day"].dataType)
    metrics, sync = _synced_rollup(
        spec, basic, {"date": day, "ad_id": F.col("ad_id"), "_gn_id": F.col("_gn_id")},
        {out: F.sum(src) for out, src in BASIC_MEASURES.items()}, synced, read, stamped=True)

    def fact(spec_pair):
        name, cols = spec_pair
        return _fact_rollup(load(name, [*FACT_KEYS, *cols]), sum_of(*cols)), list(cols)

    page_src = load(PAGE_EVENT[0], [*FACT_KEYS, "complete_payment",
                                    "value_per_complete_payment", *PAGE_EVENT[1]])
    page_measures = {"revenue": product_sum("complete_payment", "value_per_complete_payment")}
    page_measures.update(sum_of(*PAGE_EVENT[1]))
    page = (_fact_rollup(page_src, page_measures), ["revenue", *PAGE_EVENT[1]])
    return metrics, sync, page, [fact(f) for f in CHAIN_FACTS]


def _multi_dims(spec: ReportSpec, load: Loader, read: frozenset[str] | None = None,
                weighted: bool = False) -> tuple[DataFrame | None, list[str], list[str]]:
    """The ads with their campaigns and accounts, the dimension columns, and the weights.

    ``weighted`` cuts every history to the columns read and its distinct rows, each with
    the number of versions it stands for. Newest versions (``history_order``) are unique
    by construction: links of which nothing is read are left out.
    """
    newest = bool(spec.history_order)
    order = [spec.history_order, *(spec.history_tiebreak or ())] if newest else []
    ad = load("ad_history", ["ad_id", "ad_name", "adgroup_id", "adgroup_name", "advertiser_id",
                             "campaign_id", *order])
    campaign = load("campaign_history", ["campaign_id", "campaign_name", "objective_type",
                                         "advertiser_id", *order])
    account = load("ad_accounts_history", ["advertiser_id", "name", "currency", *order])
    if newest:
        # opt-in: the newest version per id instead of every version (the source keeps all,
        # which repeats each report row once per version)
        ad = latest_by(ad, ["ad_id"], spec.history_order, spec.history_tiebreak)
        campaign = latest_by(campaign, ["campaign_id"], spec.history_order,
                             spec.history_tiebreak)
        account = latest_by(account, ["advertiser_id"], spec.history_order,
                            spec.history_tiebreak)
    if _trim(spec):
        ad = ad.where(allow_list_predicate(ad, "advertiser_id", spec.account_ids, "INT64"))

    def cut(*names: str) -> dict[str, str]:
        return {n: n for n in names if is_read(n, read)}

    ad_cols = {"__ad_key": "ad_id", **cut("ad_name", "adgroup_id", "adgroup_name", "advertiser_id"),
               "__camp_link": "campaign_id"}
    camp_cols = {"campaign_id": "campaign_id", **cut("campaign_name", "objective_type"),
                 "__adv_link": "advertiser_id"}
    acc_cols = {"__adv_key": "advertiser_id"}
    acc_cols.update({o: src for o, src in {"advertiser_name": "name", "currency": "currency"}.items()
                     if is_read(o, read)})
    weights: list[str] = []

    def side(df: DataFrame, columns: dict[str, str], weight: str) -> DataFrame:
        if not weighted or newest:
            return df.select(*[F.col(src).alias(out) for out, src in columns.items()])
        weights.append(weight)
        return versions(df, columns, weight)

    ads, campaigns, accounts = side(ad, ad_cols, "__w_ad"), side(campaign, camp_cols, "__w_camp"), \
        side(account, acc_cols, "__w_acc")

    def take(df: DataFrame, *without: str) -> dict[str, str]:
        return {c: c for c in df.columns if c not in without}

    links = [Link(campaigns, [("__camp_link", "campaign_id")], take(campaigns), unique=newest),
             Link(accounts, [("__adv_link", "__adv_key")], take(accounts, "__adv_key"), unique=newest)]
    links = needed_links(links, read)
    dims = chain(ads, [link.joined() for link in links])
    names = [c for c in MULTI_DIMS if c in dims.columns and is_read(c, read)]
    if newest and not links and not names and not _trim(spec):
        return None, [], []
    return dims, names, [w for w in weights if w in dims.columns]


def _multi_joined(spec: ReportSpec, stitched: DataFrame, dims: DataFrame | None, names: list[str],
                  weights: list[str]) -> DataFrame:
    if dims is None:
        return stitched
    return left_join(stitched, dims, [("ad_id", "__ad_key")], {c: c for c in [*names, *weights]},
                     how="inner" if _trim(spec) else "left")


def _multi_select(wide: DataFrame, sync: DataFrame, names: list[str], measures: list[str], *more: str) -> DataFrame:
    api = wide.select("date", "ad_id", "_gn_id", *_have(wide, *SPINE_MEASURES), *names, *measures, *more,
                      F.lit("").alias("dpa_target_audience_type"), F.lit("").alias("promotion_type"))
    return attach_sync(api, sync)


def multi_fact_api(spec: ReportSpec, load: Loader, fact_name: str = MULTI_FACT,
                   read: frozenset[str] | None = None) -> DataFrame:
    metrics, sync, page, chain_facts = _multi_facts(spec, load, fact_name, read)
    stitched = stitch_facts(metrics, page, chain_facts, mode=spec.stitch)
    dims, names, _ = _multi_dims(spec, load, read)
    wide = _multi_joined(spec, stitched, dims, names, [])
    return _multi_select(wide, sync, names, [c for _, cols in chain_facts for c in cols] + page[1])


def multi_fact_sums_api(spec: ReportSpec, load: Loader, fact_name: str = MULTI_FACT,
                        read: frozenset[str] | None = None) -> DataFrame:
    """``multi_fact_api`` for linear metrics: one row for each spine row and distinct dimension
    version that is read, with measures multiplied by the rows it stands for (``ROWS``)."""
    metrics, sync, page, chain_facts = _multi_facts(spec, load, fact_name, read)
    own = _have(metrics, *SPINE_MEASURES)
    measures = [c for _, cols in chain_facts for c in cols] + page[1]
    stitched = stitch_sums(metrics, page, chain_facts, own)
    dims, names, weights = _multi_dims(spec, load, read, weighted=True)
    wide = weighed(_multi_joined(spec, stitched, dims, names, weights), [*own, *measures], weights)
    return _multi_select(wide, sync, names, measures, ROWS)


def multi_fact_report(spec: ReportSpec, load: Loader) -> DataFrame:
    """The report; where its metrics are linear, by products of counts instead of the rows
    that the source's joins pair up (``factorise=False`` makes these rows)."""
    read = columns_read(spec, "advertiser_id")
    if spec.factorise and spec.stitch == STITCH_AS_WRITTEN and read is not None:
        measures = [*SPINE_MEASURES, "revenue", *PAGE_EVENT[1], *(c for _, cols in CHAIN_FACTS for c in cols)]
        over_sums = linear(spec, measures)
        if over_sums is not None:
            return finish(multi_fact_sums_api(spec, load, read=read), over_sums, "advertiser_id", "INT64")
    return finish(multi_fact_api(spec, load, read=read), spec, "advertiser_id", "INT64")


BUILDERS = {
    "platform": platform_report,
    "campaign": campaign_report,
    "ad_group": ad_group_report,
    "keyword": keyword_report,
    "multi_fact": multi_fact_report,
}
