"""DuckDB statements equal to the named Spark queries in ``shopflow.registry``.

Tables ``events part supplier customer nation region`` are views; every statement
rebuilds the behaviour fixtures from them (FIXTURES.md) and then states the
operator directly in SQL.  Doubles are rounded to 6 places like the Spark side.
"""

from __future__ import annotations

from .schema import ACTION_NAMES, BINARY_OUTCOME_LABELS, CONFIDENCE_LABELS, HOUR_BUCKET_LABELS, UNKNOWN_ACTION

SEED = 42
RATIOS = (0.7, 0.15, 0.15)
TEST_SHARE = RATIOS[1] / (RATIOS[1] + RATIOS[2])

K_CTE = "k as (select *, cast(regexp_extract(props,'([0-9]+)',1) as int) as k from events)"

BEHAVIOR_CTE = """behavior as (
 select e.event_id as row_id, concat('u', cast(e.user_id as varchar(20))) as user_log_acct,
  cast(k as bigint) as item_sku_id, e.ts as action_time,
  case e.event_type when 'view' then 1 when 'purchase' then 2 when 'signup' then 3 when 'click' then 4 else 5 end as action_type,
  case when k % 19 = 0 then null else p.p_brand end as brand_code,
  cast(k % 10 as bigint) as shop_id, p.p_type as item_third_cate_cd, cast(s.s_nationkey as bigint) as vender_id,
  case when k % 17 = 0 then null else cast(k % 11 as double) end as shop_score,
  case when user_id % 13 = 0 then null else cast(user_id % 7 as double) end as age,
  cast(user_id % 3 as int) - 1 as sex, cast(user_id % 7 as int) + 1 as user_level,
  r.r_name as province, n.n_name as city, c.c_mktsegment as county
 from k e
 join part p on p.p_partkey = k
 join supplier s on s.s_suppkey = k % 10
 join customer c on c.c_custkey = e.user_id
 join nation n on n.n_nationkey = c.c_nationkey
 join region r on r.r_regionkey = n.n_regionkey)"""

TS_TEXT = "strftime(action_time, '%Y-%m-%d %H:%M:%S')"


def behavior_text_cte(with_bad: bool = True) -> str:
    bad = "row_id % 41 = 0" if with_bad else "false"
    return f"""behavior_text as (select * replace (
  case when {bad} then 'not-a-time' when row_id % 23 = 0 then {TS_TEXT} || '.0' else {TS_TEXT} end as action_time)
  from behavior)"""


def _fill_select(src: str, parts: bool = False) -> str:
    cols = ["row_id", "coalesce(user_log_acct,'unknown') as user_log_acct", "coalesce(item_sku_id,-1) as item_sku_id",
            "action_time", "coalesce(action_type,-1) as action_type", "coalesce(brand_code,'unknown') as brand_code",
            "coalesce(shop_id,-1) as shop_id", "coalesce(item_third_cate_cd,'unknown') as item_third_cate_cd",
            "coalesce(vender_id,-1) as vender_id", "coalesce(shop_score,-1) as shop_score", "coalesce(age,-1) as age",
            "coalesce(sex,-1) as sex", "coalesce(user_level,-1) as user_level",
            "coalesce(province,'unknown') as province", "coalesce(city,'unknown') as city",
            "coalesce(county,'unknown') as county"]
    if parts:
        cols += [f"coalesce({p},-1) as {p}" for p in ("hour", "day", "month", "dayofweek")]
    return f"select {', '.join(cols)} from {src}"


FILLED_CTE = f"filled as ({_fill_select('behavior')})"
TIMED_CTE = """timed as (select *, cast(hour(action_time) as integer) as hour, cast(day(action_time) as integer) as day,
  cast(month(action_time) as integer) as month, cast(isodow(action_time) - 1 as integer) as dayofweek from behavior)"""
LABELED_CTE = f"""filled_timed as ({_fill_select('timed', parts=True)}),
labeled as (select *, cast(case when action_type = 2 then 1 else 0 end as integer) as target from filled_timed)"""


def scored_cte(name: str = "scored", rotation: int = 0) -> str:
    mult = [7, 11, 13, 17, 19]
    mult = mult[rotation:] + mult[:rotation]
    mods = [97, 89, 83, 79, 73]
    ws = ", ".join(f"(event_id*{m}+k) % {d} + 1 as w{i}" for i, (m, d) in enumerate(zip(mult, mods)))
    ps = ", ".join(f"cast(w{i} as double)/(w0+w1+w2+w3+w4) as p{i}" for i in range(5))
    return f"""{name}_w as (select event_id as row_id,
  case event_type when 'view' then 0 when 'purchase' then 1 when 'signup' then 2 when 'click' then 3 else 4 end as label,
  {ws}, (event_id*37+k*11) % 101 as s from k),
{name} as (select row_id, cast(label as integer) as label, cast(case when label=1 then 1 else 0 end as integer) as target,
  cast(s as double)/100.0 as probability, {ps} from {name}_w)"""


def _alloc(name: str, src: str, ncol: str, draws: str, out: str, stratum: str = "target") -> str:
    """Largest-remainder allocation of ``draws`` over strata, ties to the lower stratum."""
    return f"""{name} as (
  select * exclude (cont, base, extra, rr), base + case when rr <= extra then 1 else 0 end as {out} from (
    select *, {draws} - sum(base) over () as extra,
      row_number() over (order by cont - base desc, {stratum}) as rr from (
      select *, cast(floor(cont) as bigint) as base from (
        select *, cast({ncol} as double) / cast(sum({ncol}) over () as double) * cast({draws} as double) as cont
        from {src}) a) b) c)"""


def split_ctes(src: str, seed: int = SEED, stratum: str = "target") -> str:
    """CTEs ending in ``split``: ``src`` rows plus a ``split`` column."""
    d1 = f"cast(floor(cast({RATIOS[0]!r} as double) * cast(sum(n) over () as double)) as bigint)"
    d2 = f"cast(floor(cast({TEST_SHARE!r} as double) * cast(sum(n_rest) over () as double)) as bigint)"
    return f"""keyed as (select *, md5('{seed}:' || cast(row_id as varchar)) as skey from {src}),
strata as (select {stratum}, count(*) as n from keyed group by {stratum}),
{_alloc('alloc1', 'strata', 'n', d1, 'n_train', stratum)},
alloc1r as (select *, n - n_train as n_rest from alloc1),
{_alloc('alloc2', 'alloc1r', 'n_rest', d2, 'n_test', stratum)},
ranked as (select *, row_number() over (partition by {stratum} order by skey, row_id) as rnk from keyed),
split as (select r.* exclude (skey, rnk),
  case when rnk <= a.n_train then 'train' when rnk <= a.n_train + a.n_test then 'test' else 'val' end as split
  from ranked r join alloc2 a using ({stratum}))"""


def with_(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


BASE = with_(K_CTE, BEHAVIOR_CTE)


def _name_case(code_expr: str, one_based: bool) -> str:
    whens = " ".join(f"when {k + (1 if one_based else 0)} then '{v}'" for k, v in ACTION_NAMES.items())
    return f"coalesce(case {code_expr} {whens} end, '{UNKNOWN_ACTION}(' || cast({code_expr} as varchar) || ')')"


def _argmax(cols: list[str]) -> str:
    g = f"greatest({', '.join(cols)})"
    return "cast(case " + " ".join(f"when {c} = {g} then {i}" for i, c in enumerate(cols)) + " end as integer)"


P5 = ["p0", "p1", "p2", "p3", "p4"]
HB = HOUR_BUCKET_LABELS
CL = CONFIDENCE_LABELS


def _hour_bucket(h: str = "hour") -> str:
    return (f"case when {h} > 0 and {h} <= 6 then '{HB[0]}' when {h} > 6 and {h} <= 12 then '{HB[1]}' "
            f"when {h} > 12 and {h} <= 18 then '{HB[2]}' when {h} > 18 and {h} <= 24 then '{HB[3]}' end")


CATS = ["brand_code", "shop_id", "item_third_cate_cd", "vender_id", "province", "city", "county"]


def _sorted_codes(src: str, cols=CATS) -> str:
    return ", ".join(f"cast(dense_rank() over (order by cast({c} as varchar)) - 1 as integer) as {c}" for c in cols)


# ------------------------------------------------------------------ statistic families
def _user_stats(src: str) -> str:
    return f"""select user_log_acct, count(item_sku_id) as user_item_count, avg(action_type) as user_action_mean,
  count(distinct shop_id) as user_shop_nunique, count(distinct brand_code) as user_brand_nunique,
  count(distinct item_third_cate_cd) as user_cate_nunique from {src} where user_log_acct is not null group by user_log_acct"""


def _item_stats(src: str) -> str:
    return f"""select item_sku_id, count(user_log_acct) as item_user_count, avg(action_type) as item_action_mean
  from {src} where item_sku_id is not null group by item_sku_id"""


FAMILIES = {
    "user_log_acct": ("user", [("item_sku_id", ["count", "nunique"]), ("action_type", ["mean", "std", "count"]),
                               ("shop_id", ["nunique"]), ("brand_code", ["nunique"]),
                               ("item_third_cate_cd", ["nunique"]), ("hour", ["mean", "std"])]),
    "item_sku_id": ("item", [("user_log_acct", ["count", "nunique"]), ("action_type", ["mean", "std", "count"]),
                             ("shop_id", ["nunique"]), ("brand_code", ["nunique"]), ("hour", ["mean", "std"])]),
    "shop_id": ("shop", [("user_log_acct", ["count", "nunique"]), ("action_type", ["mean", "std", "count"]),
                         ("item_sku_id", ["nunique"]), ("brand_code", ["nunique"]), ("hour", ["mean", "std"])]),
}
_SQL_AGG = {"count": "count({})", "nunique": "count(distinct {})", "mean": "avg({})", "std": "stddev_samp({})"}


def family_sql(src: str, key: str) -> str:
    prefix, spec = FAMILIES[key]
    aggs = ", ".join(f"{_SQL_AGG[h].format(s)} as {prefix}_{s}_{h}" for s, hs in spec for h in hs)
    return f"select {key}, {aggs} from {src} where {key} is not null group by {key}"


def family_cols(key: str) -> list[str]:
    prefix, spec = FAMILIES[key]
    return [f"{prefix}_{s}_{h}" for s, hs in spec for h in hs]


def _r(c: str) -> str:
    return f"round({c}, 6) as {c}"


def _div(a: str, b: str) -> str:
    return f"case when {b} = 0 then null else cast({a} as double) / cast({b} as double) end"


def rich_features_sql(drop: tuple[str, ...] = ()) -> tuple[str, list[str]]:
    """CTEs ending in ``rich`` (zero-filled) and its column list."""
    base_cols = ["row_id", "user_log_acct", "item_sku_id", "action_time", "action_type", "brand_code", "shop_id",
                 "item_third_cate_cd", "vender_id", "shop_score", "age", "sex", "user_level", "province", "city",
                 "county"]
    base_cols = [c for c in base_cols if c not in drop]
    present = set(base_cols) | {"hour"}
    fams = [k for k, (_, spec) in FAMILIES.items() if k in present and all(s in present for s, _ in spec)]
    ctes = [f"rb as (select {', '.join(base_cols)} from filled)",
            """rt as (select *, cast(hour(action_time) as integer) as hour, cast(day(action_time) as integer) as day,
  cast(month(action_time) as integer) as month, cast(isodow(action_time) - 1 as integer) as dayofweek from rb)""",
            f"""rw as (select *, cast(case when dayofweek in (5, 6) then 1 else 0 end as integer) as is_weekend,
  {_hour_bucket()} as hour_category from rt)"""]
    joined = "rw"
    cols = base_cols + ["hour", "day", "month", "dayofweek", "is_weekend", "hour_category"]
    for i, key in enumerate(fams):
        ctes.append(f"f{i} as ({family_sql('rw', key)})")
        nxt = f"j{i}"
        ctes.append(f"{nxt} as (select * from {joined} left join f{i} using ({key}))")
        joined = nxt
        cols += family_cols(key)
    # ratios: count / nunique within the key
    ratio_defs = {"user_item_ratio": ("user_log_acct", "item_sku_id"),
                  "user_shop_ratio": ("user_log_acct", "shop_id"),
                  "item_user_ratio": ("item_sku_id", "user_log_acct")}
    for name, (key, col) in ratio_defs.items():
        if key in present and col in present:
            ctes.append(f"""r_{name} as (select {key}, {_div(f'count({col})', f'count(distinct {col})')} as {name}
  from rw where {key} is not null group by {key})""")
            nxt = f"{joined}_{name}"
            ctes.append(f"{nxt} as (select * from {joined} left join r_{name} using ({key}))")
            joined = nxt
            cols.append(name)
    ctes.append(f"""seqf as (select *,
  cast(hour - lag(hour) over w as double) as hour_diff,
  (epoch_us(action_time) - epoch_us(lag(action_time) over w)) / 1e6 as action_frequency
  from {joined} window w as (partition by user_log_acct order by action_time, row_id))""")
    cols += ["hour_diff", "action_frequency"]
    text = {"user_log_acct", "action_time", "brand_code", "item_third_cate_cd", "province", "city", "county",
            "hour_category"}
    sel = ", ".join(c if c in text else f"coalesce({c}, 0) as {c}" for c in cols)
    ctes.append(f"rich as (select {sel} from seqf)")
    return ",\n".join(ctes), cols


DOUBLE_RICH = {"shop_score", "age", "hour_diff", "action_frequency", "user_item_ratio", "user_shop_ratio",
               "item_user_ratio"}


def _rich_select(cols: list[str], exclude: tuple[str, ...] = ()) -> str:
    out = []
    for c in cols:
        if c in exclude:
            continue
        if c in DOUBLE_RICH or c.endswith("_mean") or c.endswith("_std"):
            out.append(_r(c))
        else:
            out.append(c)
    return ", ".join(out)


def base_features_ctes() -> str:
    """CTEs ending in ``basef``: row_id + the 22 features."""
    return f"""{TIMED_CTE},
{LABELED_CTE},
enc as (select * exclude ({', '.join(CATS)}), {_sorted_codes('filled_timed')} from filled_timed),
bu as ({_user_stats('enc')}),
bi as ({_item_stats('enc')}),
basef as (select row_id, brand_code, shop_id, item_third_cate_cd, vender_id, shop_score, age, sex, user_level,
  province, city, county, hour, day, month, dayofweek, user_item_count, user_action_mean, user_shop_nunique,
  user_brand_nunique, user_cate_nunique, item_user_count, item_action_mean
  from enc left join bu using (user_log_acct) left join bi using (item_sku_id))"""


def requests_cte() -> str:
    fields = ["user_log_acct", "item_sku_id", "action_time", "age", "sex", "user_level", "province",
              "city", "county", "brand_code", "shop_id", "item_third_cate_cd", "vender_id", "shop_score"]
    out = ["row_id"]
    for f in fields:
        if f == "action_time":
            txt = TS_TEXT
        elif f == "age":
            txt = "cast(cast(age as integer) as varchar)"
        else:
            txt = f"cast({f} as varchar)"
        txt = f"coalesce({txt}, '')"
        if f == "brand_code":
            txt = f"case when row_id % 4 = 2 then 'new-' || {txt} else {txt} end"
        keep = f in ("user_log_acct", "item_sku_id", "shop_score")
        blank = "row_id % 4 = 1" + ("" if keep else " or row_id % 4 = 3")
        out.append(f"case when {blank} then '' else {txt} end as {f}")
    return f"requests as (select {', '.join(out)} from behavior)"


REQUEST_DEFAULTS_SELECT = """select row_id,
  coalesce(nullif(user_log_acct,''),'unknown') as user_log_acct, coalesce(nullif(item_sku_id,''),'unknown') as item_sku_id,
  coalesce(nullif(action_time,''),'2024-02-01 12:00:00') as action_time,
  coalesce(cast(nullif(age,'') as integer),-1) as age, coalesce(cast(nullif(sex,'') as integer),-1) as sex,
  coalesce(cast(nullif(user_level,'') as integer),-1) as user_level,
  coalesce(nullif(province,''),'unknown') as province, coalesce(nullif(city,''),'unknown') as city,
  coalesce(nullif(county,''),'unknown') as county, coalesce(nullif(brand_code,''),'unknown') as brand_code,
  coalesce(nullif(shop_id,''),'unknown') as shop_id, coalesce(nullif(item_third_cate_cd,''),'unknown') as item_third_cate_cd,
  coalesce(nullif(vender_id,''),'unknown') as vender_id, coalesce(cast(nullif(shop_score,'') as double),-1) as shop_score
  from requests"""


def _per_class(src: str, group: str = "") -> str:
    """CTEs: classes (observed labels and predictions), pc (per-class metrics) over ``src``."""
    g = f"{group}, " if group else ""
    gj = f"using ({group}, class)" if group else "using (class)"
    return f"""classes as (select distinct {g}class from (select {g}label as class from {src} union all
  select {g}prediction as class from {src})),
tn_ as (select {g}label as class, count(*) as support, count(*) filter (where label = prediction) as tp
  from {src} group by all),
pn_ as (select {g}prediction as class, count(*) as predicted from {src} group by all),
pc0 as (select {g}class, coalesce(support, 0) as support, coalesce(tp, 0) as tp, coalesce(predicted, 0) as predicted
  from classes left join tn_ {gj} left join pn_ {gj}),
pc1 as (select *, case when predicted = 0 then 0.0 else cast(tp as double) / predicted end as precision,
  case when support = 0 then 0.0 else cast(tp as double) / support end as recall from pc0),
pc as (select *, case when precision + recall = 0 then 0.0 else 2 * precision * recall / (precision + recall) end as f1
  from pc1)"""


def _weighted(group: str = "") -> str:
    g = f"{group}, " if group else ""
    gb = f"group by {group}" if group else ""
    return f"""select {g}case when sum(support) = 0 then 0.0 else sum(precision * support) / sum(support) end as weighted_precision,
  case when sum(support) = 0 then 0.0 else sum(recall * support) / sum(support) end as weighted_recall,
  case when sum(support) = 0 then 0.0 else sum(f1 * support) / sum(support) end as weighted_f1 from pc {gb}"""


def _macro(group: str = "") -> str:
    g = f"{group}, " if group else ""
    gb = f"group by {group}" if group else ""
    return f"select {g}avg(precision) as macro_precision, avg(recall) as macro_recall, avg(f1) as macro_f1 from pc {gb}"


SCORED_PRED = f"sp as (select *, {_argmax(P5)} as prediction from scored)"
BIN_PRED = "bp as (select *, cast(case when probability > 0.5 then 1 else 0 end as integer) as prediction from scored)"
CONF_BIN = """select count(*) filter (where target = 0 and prediction = 0) as tn,
  count(*) filter (where target = 0 and prediction = 1) as fp, count(*) filter (where target = 1 and prediction = 0) as fn,
  count(*) filter (where target = 1 and prediction = 1) as tp from bp"""
BIN_METRICS = f"""cb as ({CONF_BIN}),
bm as (select case when tn+fp+fn+tp = 0 then 0.0 else cast(tp+tn as double)/(tn+fp+fn+tp) end as accuracy,
  case when tp+fp = 0 then 0.0 else cast(tp as double)/(tp+fp) end as precision,
  case when tp+fn = 0 then 0.0 else cast(tp as double)/(tp+fn) end as recall from cb),
bm2 as (select *, case when precision + recall = 0 then 0.0 else 2*precision*recall/(precision+recall) end as f1 from bm)"""


def _members_ctes() -> str:
    return ",\n".join([scored_cte("m0s", 0), scored_cte("m1s", 1), scored_cte("m2s", 2)]) + """,
members as (select a.row_id, a.label, a.p0 as a0, a.p1 as a1, a.p2 as a2, a.p3 as a3, a.p4 as a4,
  b.p0 as b0, b.p1 as b1, b.p2 as b2, b.p3 as b3, b.p4 as b4, c.p0 as c0, c.p1 as c1, c.p2 as c2, c.p3 as c3, c.p4 as c4
  from m0s a join m1s b using (row_id) join m2s c using (row_id)),
voted as (select *, """ + ", ".join(f"((a{i} + b{i}) + c{i}) / 3.0 as v{i}" for i in range(5)) + " from members)"


def _learned(split: str) -> dict[str, str]:
    """What must hold of learned results whatever the trees are (see ``shopflow.plans.learned``)."""
    def per(key: str, part: str, columns: str) -> str:
        names = ", ".join(f"count(*) as {c}" for c in columns.split())
        return split + f"select {key}, {names} from (select *, cast(action_type - 1 as integer) as label from split) " \
                       f"where split = '{part}' group by {key}"

    def flags(key: str, values: list[str], columns: str) -> str:
        rows = ", ".join(f"('{v}')" for v in values)
        return f"select {key}, {', '.join(f'true as {c}' for c in columns.split())} from (values {rows}) t({key})"

    def curve(metrics: tuple[str, str]) -> str:
        rows = ", ".join(f"('{s}', '{m}')" for s in ("train", "valid") for m in metrics)
        return f"select split, metric, true as gapless, true as in_range from (values {rows}) t(split, metric)"

    members = [*[f"class_{c}" for c in range(5)], "forest", "linear"]
    rules = ["kept_round_is_best", "stopped_by_patience", "model_has_kept_rounds", "fitted_at_most_twice_the_stop"]
    ids = "select row_id, true as consistent, true as named"
    return {
        "train_binary": per("target", "val", "rows in_range consistent"),
        "train_multiclass": per("label", "val", "rows sums_to_one consistent"),
        "train_joint": split + "select row_id, cast(action_type - 1 as integer) as label, cast(0 as double) as gradient_sum, "
                               "true as one_positive, true as consistent from split where split in ('train', 'val')",
        # class weights and the weighted class shares p give the first round's sums: sum of w (y - p) = 0, of w p (1 - p)
        "joint_leaf_values": split + """, per as (select cast(action_type - 1 as integer) as cls, count(*) as n from split
  where split = 'train' group by cls),
weighted as (select cls, n * sqrt(cast(sum(n) over () as double) / (count(*) over () * n)) *
  (1 + ln(cast(sum(n) over () as double) / n)) as w, cast(sum(n) over () as bigint) as rows from per),
shares as (select cls, rows, w / sum(w) over () as p, sum(w) over () as total from weighted)
select cast(r as integer) as round, cls, rows, case when r = 1 then cast(0 as double) end as root_gradient,
  case when r = 1 then round(total * p * (1 - p), 3) end as root_curvature, true as leaf_rule, true as children_add_up
from shares, range(1, 4) t(r)""",
        "joint_early_stopping": flags("rule", ["trees_fitted_are_rounds_run", "stopped_by_patience", "kept_round_is_best",
                                               "model_has_kept_rounds"], "holds"),
        "joint_resume": "select cast(r as integer) as round, cast(c as integer) as cls, true as same_tree "
                        "from range(1, 6) t(r), range(5) u(c)",
        "train_ensemble_members": per("label", "val", "rows boosted forest linear voting sums_to_one"),
        "early_stopping": flags("rule", rules, "holds"),
        "learning_curve": curve(("auc", "binary_logloss")),
        "multiclass_learning_curve": curve(("macro_acc", "multi_logloss")),
        "ensemble_comparison": flags("model", ["boosted", "forest", "linear", "voting"], "in_range recall_is_accuracy"),
        "resume_training": flags("member", members, "first_run_fitted second_run_loaded refit_on_change"),
        "score_ensemble": split + "select user_log_acct, item_sku_id, action_time, true as in_range, true as consistent "
                                  "from split where split = 'test'",
        "model_roundtrip": split + "select count(*) as rows, count(*) as equal_rows from split where split = 'test'",
        "score_batch": split + "select user_log_acct, item_sku_id, action_time, true as in_range, true as consistent "
                               "from split where split = 'test'",
        "feature_importance": "select cast(22 as bigint) as features, true as all_splits",
        "multiclass_feature_importance": "select cast(22 as bigint) as features, true as all_splits",
        "score_records": BASE + ids + ", 1.0::double as p_sum from behavior",
        "score_records_stream": BASE + ids + ", 1.0::double as p_sum from behavior",
        "score_records_fallback": BASE + ids + ", true as two_valued, true as in_range from behavior",
    }


def statements() -> dict[str, str]:
    q: dict[str, str] = {}
    B = BASE
    q["load_behavior"] = B + "select * from behavior"
    messy_time = r"try_strptime(regexp_replace(t.action_time, '\.0$', ''), '%Y-%m-%d %H:%M:%S')"
    q["load_behavior_quoted"] = B + """select * replace (
  case row_id % 7 when 0 then 'He said "hi", ok ' || brand_code when 1 then 'two' || chr(10) || 'lines'
    when 2 then 'one' || chr(13) || chr(10) || 'two,' || chr(10) || chr(10) || '"three"' when 3 then '"' else brand_code end as brand_code,
  case row_id % 7 when 4 then '5" ' || city when 5 then city || ' "x"' || chr(10) else city end as city) from behavior"""
    q["load_behavior_messy"] = with_(K_CTE, BEHAVIOR_CTE, behavior_text_cte()) + f"""select t.* replace (
  {messy_time} as action_time, cast(null as bigint) as vender_id) from behavior_text t"""
    q["file_order_ids"] = B + "select row_number() over () - 1 as row_id from behavior"
    q["head_n"] = B + "select * from behavior order by row_id limit 500"
    split_from_labeled = with_(K_CTE, BEHAVIOR_CTE, TIMED_CTE, LABELED_CTE, split_ctes("labeled"))
    q["split_roundtrip"] = split_from_labeled + "select row_id, target, split from split"
    q["stratified_split"] = q["split_roundtrip"]
    q["split_null_keys"] = with_(K_CTE, BEHAVIOR_CTE) + f"""select coalesce(cast(t as varchar), 'none') as name,
  count(*) as rows from (select case when row_id % 7 <> 3 then case when action_type = 2 then 1 else 0 end end as t from behavior)
group by 1 union all
select unnest(['train', 'test', 'val']), unnest([n_train, n_test, n - n_train - n_test]) from (
  select *, cast(floor(cast({TEST_SHARE!r} as double) * cast(n - n_train as double)) as bigint) as n_test from (
    select count(*) as n, cast(floor(cast({RATIOS[0]!r} as double) * count(*)) as bigint) as n_train from behavior))"""
    q["frozen_target_statistics"] = split_from_labeled + """, prior as (select avg(target) as p from split where split = 'train'),
brands as (select brand_code, sum(target) as t, count(*) as n from split where split = 'train' group by brand_code),
shops as (select shop_id, sum(target) as t, count(*) as n from split where split = 'train' group by shop_id)
select s.row_id, s.split, round((coalesce(b.t, 0) + p) / (coalesce(b.n, 0) + 1.0), 6) as brand_code_target,
  round((coalesce(h.t, 0) + p) / (coalesce(h.n, 0) + 1.0), 6) as shop_id_target
from split s cross join prior left join brands b on b.brand_code is not distinct from s.brand_code
left join shops h on h.shop_id is not distinct from s.shop_id where s.split <> 'train'"""
    q["ordered_target_statistics"] = B + """, t as (select *, case when action_type = 2 then 1 else 0 end as y from behavior),
o as (select row_id, coalesce(sum(y) over w, 0)::double as sum_before, count(*) over w as rows_before from t
  window w as (partition by user_log_acct order by md5('42:' || row_id::varchar), row_id rows between unbounded preceding and 1 preceding))
select *, round((sum_before + 0.5) / (rows_before + 1.0), 6) as user_target from o"""
    q["split_report"] = split_from_labeled + \
        "select split, count(*) as rows, round(avg(target), 6) as positive_ratio from split group by split"
    q["prediction_output"] = with_(K_CTE, BEHAVIOR_CTE, scored_cte()) + """select b.user_log_acct, b.item_sku_id,
  b.action_time, cast(case when s.probability > 0.5 then 1 else 0 end as integer) as prediction,
  round(s.probability, 6) as probability from behavior b join scored s using (row_id)"""
    q |= _learned(split_from_labeled)
    bt = with_(K_CTE, BEHAVIOR_CTE, behavior_text_cte())
    q["time_text_clean"] = bt + r"select row_id, regexp_replace(action_time, '\.0$', '') as action_time from behavior_text"
    q["parse_time_coerce"] = bt + r"""select row_id,
  try_strptime(regexp_replace(action_time, '\.0$', ''), '%Y-%m-%d %H:%M:%S') as action_time from behavior_text"""
    q["parse_time_strict"] = with_(K_CTE, BEHAVIOR_CTE, behavior_text_cte(False)) + r"""select row_id,
  strptime(regexp_replace(action_time, '\.0$', ''), '%Y-%m-%d %H:%M:%S') as action_time from behavior_text"""
    q["parse_time_free"] = B + """select row_id, date_trunc('second', action_time) as iso, date_trunc('minute', action_time) as slashes,
  date_trunc('second', action_time) as offset, date_trunc('second', action_time) as month_first,
  date_trunc('day', action_time)::timestamp as date_only, date_trunc('day', action_time)::timestamp as compact from behavior"""
    tm = with_(K_CTE, BEHAVIOR_CTE, TIMED_CTE)
    q["time_parts"] = tm + "select row_id, hour, day, month, dayofweek from timed"
    q["weekend_flag"] = tm + \
        "select row_id, dayofweek, cast(case when dayofweek in (5, 6) then 1 else 0 end as integer) as is_weekend from timed"
    q["hour_bucket"] = tm + f"select row_id, hour, {_hour_bucket()} as hour_category from timed"
    fl = with_(K_CTE, BEHAVIOR_CTE, FILLED_CTE)
    q["fill_missing_typed"] = fl + "select * from filled"
    q["fill_missing_zero"] = B + """select coalesce(row_id, 0) as row_id, user_log_acct, coalesce(item_sku_id, 0) as item_sku_id,
  action_time, coalesce(action_type, 0) as action_type, brand_code, coalesce(shop_id, 0) as shop_id, item_third_cate_cd,
  coalesce(vender_id, 0) as vender_id, coalesce(shop_score, 0) as shop_score, coalesce(age, 0) as age,
  coalesce(sex, 0) as sex, coalesce(user_level, 0) as user_level, province, city, county from behavior"""
    q["binary_target"] = B + \
        "select row_id, action_type, cast(case when action_type = 2 then 1 else 0 end as integer) as target from behavior"
    q["multiclass_label"] = B + "select row_id, cast(action_type - 1 as integer) as label from behavior"
    q["base_feature_matrix"] = with_(K_CTE, BEHAVIOR_CTE, TIMED_CTE, LABELED_CTE) + """select row_id, brand_code,
  shop_id, item_third_cate_cd, vender_id, shop_score, age, sex, user_level, province, city, county, hour, day, month,
  dayofweek from filled_timed"""
    rich_ctes, rich_cols = rich_features_sql()
    rich = with_(K_CTE, BEHAVIOR_CTE, FILLED_CTE, rich_ctes)
    q["rich_features"] = rich + f"select {_rich_select(rich_cols)} from rich"
    q["rich_feature_matrix"] = rich + \
        f"select {_rich_select(rich_cols, ('user_log_acct', 'item_sku_id', 'action_time', 'action_type'))} from rich"
    part_ctes, part_cols = rich_features_sql(drop=("item_third_cate_cd",))
    q["rich_features_partial"] = with_(K_CTE, BEHAVIOR_CTE, FILLED_CTE, part_ctes) + \
        f"select {_rich_select(part_cols)} from rich"
    q["action_name"] = B + f"""select row_id, action_type, {_name_case('action_type', True)} as action_name,
  cast(action_type - 1 as integer) as label, {_name_case('(action_type - 1)', False)} as label_name from behavior"""
    sc = with_(K_CTE, scored_cte())
    q["threshold_predict"] = sc + """select row_id, round(probability, 6) as probability,
  cast(case when probability > 0.5 then 1 else 0 end as integer) as prediction from scored"""
    q["argmax_predict"] = with_(K_CTE, scored_cte(), SCORED_PRED) + \
        "select row_id, prediction, cast(prediction + 1 as integer) as action_type from sp"
    o = BINARY_OUTCOME_LABELS
    q["binary_outcome"] = sc + f"""select row_id, case when probability > 0.5 then '{o[0]}' else '{o[1]}' end as outcome,
  round(case when probability > 0.5 then probability else 1 - probability end, 6) as outcome_probability from scored"""
    q["confidence_binary"] = sc + f"""select row_id, case when probability > 0.9 or probability < 0.1 then '{CL[0]}'
  when probability > 0.7 or probability < 0.3 then '{CL[1]}' when probability > 0.5 or probability < 0.5 then '{CL[2]}'
  end as confidence from scored"""
    g = f"greatest({', '.join(P5)})"
    q["confidence_multiclass"] = sc + f"""select row_id, round({g}, 6) as max_probability,
  case when {g} > 0.8 then '{CL[0]}' when {g} > 0.6 then '{CL[1]}' when {g} > 0.4 then '{CL[2]}' else '{CL[3]}' end
  as confidence from scored"""
    q["pad_probabilities"] = sc + """select row_id, cast(5 as integer) as n, round(1 - probability, 6) as pad_0,
  round(probability, 6) as pad_1, 0.0::double as pad_2, 0.0::double as pad_3, 0.0::double as pad_4 from scored"""
    q["class_probability_rows"] = sc + " union all ".join(
        f"select row_id, cast({i + 1} as integer) as action_type, '{ACTION_NAMES[i]}' as action_name, "
        f"round(p{i}, 6) as probability from scored" for i in range(5))
    q["two_valued_flag"] = sc + """select row_id,
  len(list_distinct([1 - probability, probability, 0.0, 0.0, 0.0])) <= 2 as two_valued from scored"""
    rq = with_(K_CTE, BEHAVIOR_CTE, requests_cte())
    q["request_defaults"] = rq + REQUEST_DEFAULTS_SELECT
    first_seen = " union all ".join(
        f"select '{c}' as col, cast({c} as varchar) as value, row_number() over (order by min(row_id)) - 1 as code "
        f"from filled group by cast({c} as varchar)" for c in CATS)
    stats7 = ["user_item_count", "user_action_mean", "user_shop_nunique", "user_brand_nunique", "user_cate_nunique",
              "item_user_count", "item_action_mean"]
    enc_sel = ", ".join(f"cast(coalesce((select code from dict where col = '{c}' and value = d.{c}), -1) as integer) as {c}"
                        for c in CATS)
    q["request_backfill"] = with_(K_CTE, BEHAVIOR_CTE, FILLED_CTE, base_features_ctes(), requests_cte(),
                                  f"rd as ({REQUEST_DEFAULTS_SELECT})", f"dict as ({first_seen})",
                                  "means as (select " + ", ".join(f"avg({s}) as {s}" for s in stats7) + " from basef)") + \
        f"""select d.row_id, {enc_sel}, d.shop_score, d.age, d.sex, d.user_level,
  cast(hour(strptime(d.action_time, '%Y-%m-%d %H:%M:%S')) as integer) as hour,
  cast(day(strptime(d.action_time, '%Y-%m-%d %H:%M:%S')) as integer) as day,
  cast(month(strptime(d.action_time, '%Y-%m-%d %H:%M:%S')) as integer) as month,
  cast(isodow(strptime(d.action_time, '%Y-%m-%d %H:%M:%S')) - 1 as integer) as dayofweek,
  """ + ", ".join(f"round(m.{s}, 6) as {s}" for s in stats7) + " from rd d, means m"
    q["label_encode"] = fl + f"select row_id, {_sorted_codes('filled')} from filled"
    sp_rich = with_(K_CTE, BEHAVIOR_CTE, TIMED_CTE, LABELED_CTE, split_ctes("labeled"),
                    f"tv as (select *, {_hour_bucket()} as hour_category from split where split in ('train', 'val'))")
    joint = []
    for c in CATS + ["hour_category"]:
        order = f"cast({c} as varchar)" if c not in ("shop_id", "vender_id") else c
        joint.append(f"""cast(case when {c} is null then (select count(distinct {c}) from tv)
  else dense_rank() over (partition by {c} is null order by {order}) - 1 end as integer) as {c}""")
    q["label_encode_joint"] = sp_rich + f"select row_id, split, {', '.join(joint)} from tv"
    frozen_dicts = ",\n".join(
        f"""d_{c} as (select v, cast(dense_rank() over (order by v) - 1 as integer) as code from
  (select distinct cast({c} as varchar) as v from split where split = 'train'))""" for c in CATS)
    frozen_sel = ", ".join(f"coalesce(d_{c}.code, -1) as {c}" for c in CATS)
    frozen_join = " ".join(f"left join d_{c} on cast(t.{c} as varchar) = d_{c}.v" for c in CATS)
    q["label_encode_frozen"] = with_(K_CTE, BEHAVIOR_CTE, TIMED_CTE, LABELED_CTE, split_ctes("labeled"), frozen_dicts) + \
        f"select t.row_id, {frozen_sel} from (select * from split where split = 'test') t {frozen_join}"
    q["user_stats"] = B + f"""select user_log_acct, user_item_count, round(user_action_mean, 6) as user_action_mean,
  user_shop_nunique, user_brand_nunique, user_cate_nunique from ({_user_stats('behavior')})"""
    q["item_stats"] = B + f"""select item_sku_id, item_user_count, round(item_action_mean, 6) as item_action_mean
  from ({_item_stats('behavior')})"""
    for key, name in (("user_log_acct", "rich_user_stats"), ("item_sku_id", "rich_item_stats"),
                      ("shop_id", "rich_shop_stats")):
        sel = ", ".join(_r(c) if (c.endswith("_mean") or c.endswith("_std")) else c for c in family_cols(key))
        q[name] = tm + f"select {key}, {sel} from ({family_sql('timed', key)})"
        q[name.replace("rich", "merged")] = q[name]
    q["attach_base_stats"] = B + f"""select b.*, u.user_item_count, round(u.user_action_mean, 6) as user_action_mean,
  u.user_shop_nunique, u.user_brand_nunique, u.user_cate_nunique, i.item_user_count,
  round(i.item_action_mean, 6) as item_action_mean
  from behavior b left join ({_user_stats('behavior')}) u using (user_log_acct)
  left join ({_item_stats('behavior')}) i using (item_sku_id)"""
    all_fam = []
    for key in FAMILIES:
        all_fam += [_r(c) if (c.endswith("_mean") or c.endswith("_std")) else c for c in family_cols(key)]
    q["attach_rich_stats"] = tm + f"""select t.*, {', '.join(all_fam)} from timed t
  left join ({family_sql('timed', 'user_log_acct')}) using (user_log_acct)
  left join ({family_sql('timed', 'item_sku_id')}) using (item_sku_id)
  left join ({family_sql('timed', 'shop_id')}) using (shop_id)"""
    for name, key, col in (("user_item_ratio", "user_log_acct", "item_sku_id"),
                           ("user_shop_ratio", "user_log_acct", "shop_id"),
                           ("item_user_ratio", "item_sku_id", "user_log_acct")):
        q[name] = B + f"""select b.row_id, round(r.{name}, 6) as {name} from behavior b left join
  (select {key}, {_div(f'count({col})', f'count(distinct {col})')} as {name} from behavior
   where {key} is not null group by {key}) r using ({key})"""
    q["base_features"] = with_(K_CTE, BEHAVIOR_CTE, base_features_ctes()) + """select * replace (
  round(user_action_mean, 6) as user_action_mean, round(item_action_mean, 6) as item_action_mean) from basef"""
    q["leave_one_out_means"] = B + """select row_id,
  round(case when count(action_type) over (partition by user_log_acct) <= 1 then null else
    cast(sum(action_type) over (partition by user_log_acct) - action_type as double)
    / (count(action_type) over (partition by user_log_acct) - 1) end, 6) as user_action_mean,
  round(case when count(action_type) over (partition by item_sku_id) <= 1 then null else
    cast(sum(action_type) over (partition by item_sku_id) - action_type as double)
    / (count(action_type) over (partition by item_sku_id) - 1) end, 6) as item_action_mean from behavior"""
    win = "window w as (partition by user_log_acct order by action_time, row_id)"
    q["sequence_after_history"] = tm + f"""select row_id, hour_diff, action_frequency from (select *,
  cast(hour - lag(hour) over w as double) as hour_diff,
  round((epoch_us(action_time) - epoch_us(lag(action_time) over w)) / 1e6, 6) as action_frequency from timed {win}),
  (select min(epoch_us(action_time)) as a, max(epoch_us(action_time)) as b from timed) where epoch_us(action_time) > a + (b - a) // 2"""
    q["hour_diff"] = tm + f"select row_id, cast(hour - lag(hour) over w as double) as hour_diff from timed {win}"
    q["action_gap_seconds"] = tm + f"""select row_id,
  round((epoch_us(action_time) - epoch_us(lag(action_time) over w)) / 1e6, 6) as action_gap_seconds from timed {win}"""
    q["group_transform"] = B + """select b.row_id, g.item_user_count, g.item_user_nunique from behavior b left join
  (select item_sku_id, count(user_log_acct) as item_user_count, count(distinct user_log_acct) as item_user_nunique
   from behavior where item_sku_id is not null group by item_sku_id) g using (item_sku_id)"""
    q["class_distribution"] = B + f"""select label, {_name_case('label', False)} as action_name, count,
  round(cast(count as double) / sum(count) over (), 6) as share from
  (select cast(action_type - 1 as integer) as label, count(*) as count from behavior group by 1)"""
    q["positive_ratio"] = B + \
        "select round(avg(case when action_type = 2 then 1 else 0 end), 6) as positive_ratio from behavior"
    cw = """cw as (select label, count(*) as class_count from scored group by label),
cw2 as (select label, class_count, sqrt(cast(sum(class_count) over () as double) / (cast(count(*) over () as double) *
  cast(class_count as double))) * (1 + ln(cast(sum(class_count) over () as double) / cast(class_count as double)))
  as weight from cw)"""
    q["class_weights"] = with_(K_CTE, scored_cte(), cw) + \
        "select label, class_count, round(weight, 6) as weight from cw2"
    q["row_weights"] = with_(K_CTE, scored_cte(), cw) + \
        "select s.row_id, s.label, round(w.weight, 6) as weight from scored s left join cw2 w using (label)"
    num_cols = ["item_sku_id", "action_type", "shop_id", "vender_id", "shop_score", "age", "sex", "user_level"]
    q["numeric_profile"] = B + " union all ".join(
        f"""select '{c}' as column, round(min(cast({c} as double)), 6) as min, round(max(cast({c} as double)), 6) as max,
  round(avg(cast({c} as double)), 6) as mean, round(quantile_cont(cast({c} as double), 0.5), 6) as median from behavior"""
        for c in num_cols)
    text_cols = ["user_log_acct", "brand_code", "item_third_cate_cd", "province", "city", "county"]
    q["categorical_profile"] = B + " union all ".join(
        f"""select '{c}' as column, {c} as value, cast(row_number() over (order by min(row_id)) - 1 as integer) as position
  from behavior group by {c}""" for c in text_cols)
    q["dataset_shape"] = B + "select count(*) as rows, cast(16 as bigint) as columns from behavior"
    spq = with_(K_CTE, scored_cte(), SCORED_PRED)
    q["macro_accuracy"] = spq + """select round(avg(coalesce(acc, 0.0)), 6) as macro_acc from
  (select cast(range as integer) as class from range(5)) c left join
  (select label as class, avg(case when label = prediction then 1.0 else 0.0 end) as acc from sp group by label) a
  using (class)"""
    q["soft_vote"] = with_(K_CTE, _members_ctes()) + f"""select row_id, {_argmax([f'v{i}' for i in range(5)])} as prediction,
  """ + ", ".join(f"round(v{i}, 6) as p{i}" for i in range(5)) + " from voted"
    bpq = with_(K_CTE, scored_cte(), BIN_PRED)
    q["score_summary"] = bpq + """select count(*) as rows, cast(sum(prediction) as bigint) as positives,
  round(avg(prediction), 6) as positive_share from bp"""
    q["confusion_binary"] = bpq + CONF_BIN
    q["binary_metrics"] = with_(K_CTE, scored_cte(), BIN_PRED, BIN_METRICS) + \
        "select round(accuracy, 6) as accuracy, round(precision, 6) as precision, round(recall, 6) as recall, " \
        "round(f1, 6) as f1 from bm2"
    q["metrics_long"] = with_(K_CTE, scored_cte(), BIN_PRED, BIN_METRICS) + \
        "select metric, round(value, 6) as value from (unpivot bm2 on accuracy, precision, recall, f1 " \
        "into name metric value value)"
    q["evaluation_report"] = with_(K_CTE, scored_cte(), BIN_PRED, BIN_METRICS) + """select metric, round(value, 6) as value
  from (unpivot bm2 on accuracy, precision, recall, f1 into name metric value value)
  union all select 'auc' as metric, round((sum(case when target = 1 then r end) - p * (p + 1) / 2.0) / (p * n), 6) from
  (select target, rank() over (order by probability) + (count(*) over (partition by probability) - 1) / 2.0 as r,
   cast(sum(case when target = 1 then 1 else 0 end) over () as double) as p,
   cast(sum(case when target = 1 then 0 else 1 end) over () as double) as n from scored) group by p, n
  union all select metric, cast(value as double) from (unpivot cb on tn, fp, fn, tp into name metric value value)"""
    q["roc_auc"] = sc + """select round((sum(case when target = 1 then r end) - p * (p + 1) / 2.0) / (p * n), 6) as auc from
  (select target, rank() over (order by probability) + (count(*) over (partition by probability) - 1) / 2.0 as r,
   cast(sum(case when target = 1 then 1 else 0 end) over () as double) as p,
   cast(sum(case when target = 1 then 0 else 1 end) over () as double) as n from scored) group by p, n"""
    q["confusion_matrix"] = spq + """, cls as (select distinct c from (select label as c from sp union all
  select prediction as c from sp)), cnt as (select label, prediction, count(*) as count from sp group by all)
  select a.c as label, b.c as prediction, coalesce(cnt.count, 0) as count from cls a cross join cls b
  left join cnt on cnt.label = a.c and cnt.prediction = b.c"""
    pcq = with_(K_CTE, scored_cte(), SCORED_PRED, _per_class("sp"))
    q["per_class_metrics"] = pcq + """select class, round(precision, 6) as precision, round(recall, 6) as recall,
  round(f1, 6) as f1, support from pc"""
    q["macro_metrics"] = pcq + "select round(macro_precision, 6) as macro_precision, round(macro_recall, 6) as " \
        f"macro_recall, round(macro_f1, 6) as macro_f1 from ({_macro()})"
    q["weighted_metrics"] = pcq + "select round(weighted_precision, 6) as weighted_precision, round(weighted_recall, 6) " \
        f"as weighted_recall, round(weighted_f1, 6) as weighted_f1 from ({_weighted()})"
    q["multiclass_accuracy"] = spq + \
        "select round(avg(case when label = prediction then 1.0 else 0.0 end), 6) as accuracy from sp"
    stacked = "stk as (" + " union all ".join(
        [f"select 'm{i}' as model, label, {_argmax([f'{ch}{j}' for j in range(5)])} as prediction from members"
         for i, ch in enumerate("abc")] +
        [f"select 'voting' as model, label, {_argmax([f'v{j}' for j in range(5)])} as prediction from voted"]) + ")"
    q["model_comparison"] = with_(K_CTE, _members_ctes(), stacked, _per_class("stk", "model"),
                                  f"w as ({_weighted('model')})",
                                  "acc as (select model, avg(case when label = prediction then 1.0 else 0.0 end) as "
                                  "accuracy from stk group by model)") + \
        """select model, round(accuracy, 6) as accuracy, round(weighted_precision, 6) as precision,
  round(weighted_recall, 6) as recall, round(weighted_f1, 6) as f1 from acc join w using (model)"""
    q["split_metrics"] = with_(K_CTE, scored_cte(), SCORED_PRED, split_ctes("sp"),
                               "ev as (select * from split where split <> 'train')", _per_class("ev", "split"),
                               f"mm as ({_macro('split')})", f"ww as ({_weighted('split')})",
                               "acc as (select split, avg(case when label = prediction then 1.0 else 0.0 end) as "
                               "accuracy from ev group by split)") + \
        """select split, round(accuracy, 6) as accuracy, round(macro_precision, 6) as macro_precision,
  round(macro_recall, 6) as macro_recall, round(macro_f1, 6) as macro_f1,
  round(weighted_precision, 6) as weighted_precision, round(weighted_recall, 6) as weighted_recall,
  round(weighted_f1, 6) as weighted_f1 from acc join mm using (split) join ww using (split)"""
    return q
