"""Independent restatement of every query in DuckDB SQL (the correctness oracle).

Text is composed from CTE fragments; the forest is grown level by level in
SQL with the same hash rules as the Spark operators, and scored by
unrolling the descent into one join per level.  Doubles are rounded to 6
decimals in the final projections of both engines.
"""

from __future__ import annotations

from dataclasses import replace

from ctxanomaly.config import (
    EPS,
    EULER_GAMMA,
    FEATURE_DIGITS,
    FEATURES,
    METHOD_LABELS,
    OVERLAP_LABELS,
    PUBLISHED_POOL,
    SENSITIVITY_THRESHOLDS,
    SUMMARY_PROPERTIES,
    DetectConfig,
)
from ctxanomaly.operators.forest import DRAW_PRIME, draw_factors

CFG = DetectConfig()
SEP = "chr(31)"
TWO60 = float(1 << 60)
DIGITS = 6


def h(*parts: str) -> str:
    """SQL of the 60-bit md5 hash of parts joined by the key separator."""
    joined = ", ".join(f"cast({p} as varchar)" for p in parts)
    return f"('0x' || substr(md5(concat_ws({SEP}, {joined})), 1, 15))::bigint"


def r(expr: str) -> str:
    # "+ 0.0" turns a rounded -0.0 into 0.0 (Spark's round never yields -0.0)
    return f"(round({expr}, {DIGITS}) + 0.0)"


def replace_round(cols: list[str]) -> str:
    if not cols:
        return "*"
    return "* replace (" + ", ".join(f"{r(c)} as {c}" for c in cols) + ")"


def c_factor(n: str) -> str:
    return (
        f"(case when {n} <= 1 then 0.0 when {n} = 2 then 1.0 else "
        f"2.0::double * (ln(({n})::double - 1.0) + {EULER_GAMMA}::double) "
        f"- 2.0::double * (({n})::double - 1.0) / ({n})::double end)"
    )


# --------------------------------------------------------------------------
# raw records
# --------------------------------------------------------------------------

RAW_EVENTS = """
raw_events as (
  select
    case when event_id % 103 = 0 then 'not-a-date' else cast(cast(ts as date) as varchar) end as transition_date,
    case when event_id % 97 = 0 then '24' when event_id % 89 = 0 then null
         else cast(extract(hour from ts) as varchar) end as transition_hour,
    case when event_id % 101 = 0 then null else event_type end as line,
    upper(event_type) as line_name,
    n_name as town,
    case when event_id % 83 = 0 then 'n/a' when event_id % 107 = 0 then '-1'
         else cast(cast(value as decimal(18,2)) as varchar) end as number_of_passenger,
    case when event_id % 79 = 0 then null else regexp_extract(props, '([0-9]+)', 1) end as number_of_passage
  from events
  join customer on c_custkey = user_id
  join nation on n_nationkey = c_nationkey
)"""

RAW_LINEITEM = """
raw_lineitem as (
  select
    cast(l_shipdate as date) as transition_date,
    cast(l_orderkey % 24 as integer) as transition_hour,
    concat(l_returnflag, l_linestatus) as line,
    concat('LINE ', l_returnflag, l_linestatus) as line_name,
    n_name as town,
    l_quantity as number_of_passenger,
    cast(l_linenumber as double) as number_of_passage
  from lineitem
  join supplier on s_suppkey = l_suppkey
  join nation on n_nationkey = s_nationkey
)"""


RAW_PRICES = """
raw_prices as (
  select
    cast(date_trunc('week', l_shipdate) as date) as transition_date,
    cast((l_orderkey % 2) * 12 as integer) as transition_hour,
    l_returnflag as line,
    concat('LINE ', l_returnflag) as line_name,
    'ALL' as town,
    l_extendedprice as number_of_passenger,
    l_quantity * (1.0::double - l_discount) as number_of_passage
  from lineitem
)"""


def record_chain(src: str, p: str) -> str:
    """cast -> valid -> dated -> hourly -> cells (prefix p)."""
    return f"""
{p}cast as (
  select try_cast(transition_date as date) as transition_date,
         case when floor(try_cast(transition_hour as double)) = try_cast(transition_hour as double)
              then try_cast(try_cast(transition_hour as double) as integer) end as transition_hour,
         line, line_name, town,
         try_cast(number_of_passenger as double) as number_of_passenger,
         try_cast(number_of_passage as double) as number_of_passage
  from {src}
),
{p}valid as (
  select * from {p}cast
  where transition_date is not null and transition_hour is not null
    and transition_hour between 0 and 23
    and number_of_passenger is not null and number_of_passenger >= 0
    and number_of_passenger < 'inf'::double
),
{p}dated as (
  select *, cast(transition_date as timestamp) + to_hours(transition_hour) as datetime from {p}valid
),
{p}hourly as materialized (
  select datetime, line, line_name, town,
         sum(number_of_passenger) as total_passengers,
         sum(number_of_passage) as total_passages,
         count(*) as record_count
  from {p}dated group by datetime, line, line_name, town
),
{p}cells as materialized (
  select *,
         cast(hour(datetime) as integer) as hour,
         cast(month(datetime) as integer) as month,
         cast(dayofweek(datetime) + 1 as integer) as spark_dayofweek,
         case when dayofweek(datetime) in (0, 6) then 1 else 0 end as is_weekend
  from {p}hourly
)"""


def z_chain(p: str, z: float = CFG.z_threshold) -> str:
    return f"""
{p}moments as materialized (
  select line, hour, spark_dayofweek,
         avg(total_passengers) as group_mean,
         stddev_samp(total_passengers) as group_std
  from {p}cells group by line, hour, spark_dayofweek
),
{p}attached as (
  select c.*, m.group_mean, m.group_std
  from {p}cells c left join {p}moments m
    on c.line = m.line and c.hour = m.hour and c.spark_dayofweek = m.spark_dayofweek
),
{p}z0 as (
  select *, case when group_std is null or group_std = 0 then null
                 else (total_passengers - group_mean) / group_std end as z_score
  from {p}attached
),
{p}zscored as materialized (
  select *, coalesce(abs(z_score) > {z}, false) as is_anomaly from {p}z0
)"""


def feature_chain(p: str, min_obs: int = CFG.min_context_obs) -> str:
    signed = {
        "independent_context_residual": f"(total_passengers - loo_mean_passengers) / (loo_std_passengers + {EPS})",
        "relative_to_context_mean": "(total_passengers - loo_mean_passengers) / (loo_mean_passengers + 1.0)",
        "log_observed_expected_ratio": "ln(1 + total_passengers) - ln(1 + loo_mean_passengers)",
        "passage_per_passenger_diff": "passage_per_passenger - context_avg_passage_per_passenger",
        "passenger_per_record_diff": "passenger_per_record - context_avg_passenger_per_record",
    }
    sig = ",\n         ".join(f"coalesce(round({e}, {FEATURE_DIGITS}), 0.0) as {k}" for k, e in signed.items())
    ab = ",\n         ".join(f"abs({k}) as abs_{k}" for k in signed)
    return f"""
{p}labelled as (
  select *, case when is_anomaly then 1 else 0 end as zscore_anomaly from {p}zscored
),
{p}complete as (
  select * from {p}labelled
  where total_passengers is not null and not isnan(total_passengers)
    and total_passages is not null and not isnan(total_passages)
    and record_count is not null and hour is not null and month is not null
    and spark_dayofweek is not null and is_weekend is not null
),
{p}in_range as (
  select * from {p}complete
  where total_passengers >= 0 and total_passengers < 'inf'::double
    and total_passages >= 0 and total_passages < 'inf'::double
    and record_count > 0 and hour between 0 and 23
),
{p}ratios as (
  select *,
         total_passages / (total_passengers + 1.0) as passage_per_passenger,
         total_passengers / (record_count + 1.0) as passenger_per_record,
         total_passages / (record_count + 1.0) as passage_per_record
  from {p}in_range
),
{p}profile as materialized (
  select line, hour, spark_dayofweek,
         count(*) as context_obs_count,
         avg(total_passengers) as context_mean_passengers,
         var_samp(total_passengers) as context_var_passengers,
         round(avg(passage_per_passenger), {FEATURE_DIGITS}) as context_avg_passage_per_passenger,
         round(avg(passenger_per_record), {FEATURE_DIGITS}) as context_avg_passenger_per_record,
         round(avg(passage_per_record), {FEATURE_DIGITS}) as context_avg_passage_per_record
  from {p}ratios group by line, hour, spark_dayofweek
),
{p}joined as (
  select r.*, s.context_obs_count, s.context_mean_passengers, s.context_var_passengers,
         s.context_avg_passage_per_passenger, s.context_avg_passenger_per_record,
         s.context_avg_passage_per_record
  from {p}ratios r join {p}profile s
    on r.line = s.line and r.hour = s.hour and r.spark_dayofweek = s.spark_dayofweek
  where s.context_obs_count >= {min_obs}
),
{p}loo0 as (
  select *, total_passengers - context_mean_passengers as _d, cast(context_obs_count as double) as _n,
         sum((total_passengers - context_mean_passengers) * (total_passengers - context_mean_passengers))
           over (partition by line, hour, spark_dayofweek) as _ss
  from {p}joined
),
{p}loo as (
  select * exclude (_d, _n, _ss),
         context_mean_passengers - _d / (_n - 1.0) as loo_mean_passengers,
         sqrt(case when _ss - _d * _d * _n / (_n - 1.0) < 1e-12 * _ss then 0.0
                   else (_ss - _d * _d * _n / (_n - 1.0)) / greatest(_n - 2.0, 1.0) end + {EPS}) as loo_std_passengers
  from {p}loo0
),
{p}signed as (
  select *,
         {sig}
  from {p}loo
),
{p}featured as materialized (
  select *,
         {ab},
         concat_ws({SEP}, strftime(datetime, '%Y-%m-%d %H'), coalesce(line, '\\N'),
                   coalesce(line_name, '\\N'), coalesce(town, '\\N')) as row_key
  from {p}signed
)"""


def scale_chain(p: str) -> str:
    stats = ",\n         ".join(
        f"avg({c}) as {c}_mean, stddev_samp({c}) as {c}_std" for c in FEATURES
    )
    scaled = ",\n         ".join(
        f"coalesce((f.{c} - coalesce(s.{c}_mean, 0.0)) / "
        f"(case when s.{c}_std is null or s.{c}_std = 0 then 1.0 else s.{c}_std end), 0.0) as {c}_scaled"
        for c in FEATURES
    )
    return f"""
{p}fstats as materialized (
  select {stats}
  from {p}featured
),
{p}scaled as materialized (
  select f.*,
         {scaled}
  from {p}featured f cross join {p}fstats s
)"""


def pool_chain(p: str, cfg: DetectConfig = CFG) -> str:
    seed = str(cfg.seed)
    fcols = ", ".join(f"{c}_scaled" for c in FEATURES)
    limit = "" if cfg.pool_size is None else f"order by h_pool, row_key limit {cfg.pool_size}"
    factors = ", ".join(f"({t}, {a}, {b})" for t, (a, b) in enumerate(draw_factors(cfg)))
    return f"""
{p}pool as materialized (
  select row_key, {h(repr(seed), "'pool'", 'row_key')} as h_pool, {fcols}
  from {p}scaled
  {limit}
),
{p}factors as (
  select * from (values {factors}) v(tree_id, a, b)
),
{p}samples as materialized (
  select t.tree_id::integer as tree_id, p.row_key,
         ((p.h_pool % {DRAW_PRIME}) * t.a + t.b) % {DRAW_PRIME} as h_tree, {fcols}
  from {p}pool p cross join {p}factors t
  qualify row_number() over (partition by t.tree_id order by h_tree, p.row_key) <= {cfg.max_samples}
)"""


def forest_chain(p: str, cfg: DetectConfig = CFG) -> str:
    seed = str(cfg.seed)
    scaled = [f"{c}_scaled" for c in FEATURES]
    fcols = ", ".join(scaled)

    def pick(feature_col: str, prefix: str = "") -> str:
        whens = " ".join(f"when {i} then {prefix}{c}" for i, c in enumerate(scaled))
        return f"(case {feature_col} {whens} end)"

    parts = [
        pool_chain(p, cfg),
        f"""
{p}l0 as materialized (
  select tree_id, 1::bigint as node_id, {fcols} from {p}samples
)"""
    ]
    levels = []
    for d in range(cfg.max_depth + 1):
        feat = f"({h(repr(seed), "'feature'", 'tree_id', 'node_id')} % {len(FEATURES)})::integer"
        u = f"({h(repr(seed), "'split'", 'tree_id', 'node_id')}::double / {TWO60})"
        parts.append(
            f"""
{p}n{d}f as (
  select tree_id, node_id, {feat} as feature, {u} as u, {fcols} from {p}l{d}
),
{p}n{d}a as (
  select tree_id, node_id, count(*) as size, any_value(feature) as feature, any_value(u) as u,
         min({pick('feature')}) as mn, max({pick('feature')}) as mx
  from {p}n{d}f group by tree_id, node_id
),
{p}n{d} as materialized (
  select tree_id, node_id, {d} as depth, size, feature, mn + u * (mx - mn) as split,
         ({d} >= {cfg.max_depth} or size <= 1 or mn = mx or mn + u * (mx - mn) <= mn) as is_leaf
  from {p}n{d}a
)"""
        )
        if d < cfg.max_depth:
            parts.append(
                f"""
{p}l{d + 1} as materialized (
  select l.tree_id, 2 * l.node_id + (case when {pick('n.feature', 'l.')} >= n.split then 1 else 0 end) as node_id,
         {", ".join("l." + c for c in scaled)}
  from {p}l{d} l join {p}n{d} n on l.tree_id = n.tree_id and l.node_id = n.node_id
  where not n.is_leaf
)"""
            )
        levels.append(f"select * from {p}n{d}")
    union = "\n  union all\n  ".join(levels)
    parts.append(
        f"""
{p}nodes as materialized (
  select tree_id::integer as tree_id, node_id::bigint as node_id, depth::integer as depth,
         size::bigint as size, is_leaf,
         case when is_leaf then null else feature::integer end as feature,
         case when is_leaf then null else split end as split,
         case when is_leaf then round((depth + {c_factor('size')}) * 1e9)::bigint end as path_units
  from (
  {union}
  )
)"""
    )
    # scoring: descend max_depth levels, one join per level
    parts.append(
        f"""
{p}s0 as materialized (
  select s.row_key, t.tree_id::integer as tree_id, 1::bigint as node_id, {", ".join("s." + c for c in scaled)}
  from {p}scaled s cross join range(0, {cfg.num_trees}) t(tree_id)
)"""
    )
    for d in range(cfg.max_depth):
        parts.append(
            f"""
{p}s{d + 1} as materialized (
  select s.row_key, s.tree_id,
         case when n.is_leaf then s.node_id
              else 2 * s.node_id + (case when {pick('n.feature', 's.')} >= n.split then 1 else 0 end) end as node_id,
         {", ".join("s." + c for c in scaled)}
  from {p}s{d} s join {p}nodes n on s.tree_id = n.tree_id and s.node_id = n.node_id
)"""
        )
    last = cfg.max_depth
    norm = f"{c_factor(str(cfg.max_samples))}"
    parts.append(
        f"""
{p}units as materialized (
  select s.row_key, sum(n.path_units)::bigint as iforest_path_units
  from {p}s{last} s join {p}nodes n on s.tree_id = n.tree_id and s.node_id = n.node_id
  group by s.row_key
),
{p}scored0 as materialized (
  select f.*, u.iforest_path_units,
         pow(2.0, -(u.iforest_path_units::double / 1e9 / {cfg.num_trees}.0) / {norm}) as iforest_score
  from {p}scaled f join {p}units u on f.row_key = u.row_key
),
{p}thr as materialized (
  select n, rk, (select iforest_path_units from (
             select iforest_path_units, row_number() over (order by iforest_path_units) as rn from {p}scored0)
           where rn = n - rk + 1) as threshold_units
  from (select n, greatest(1, least(n, ceil((1 - {cfg.contamination}) * n)))::bigint as rk
        from (select count(*) as n from {p}scored0))
),
{p}flagged as materialized (
  select s.*, case when s.iforest_path_units <= t.threshold_units then 1 else 0 end as iforest_anomaly,
         case when s.iforest_path_units <= t.threshold_units then 1 else 0 end as iforest_prediction
  from {p}scored0 s cross join {p}thr t
)"""
    )
    return ",".join(parts)


def with_ctes(*fragments: str) -> str:
    return "with " + ",".join(f.strip("\n").lstrip(",") for f in fragments) + "\n"


EVENTS = with_ctes(RAW_EVENTS, record_chain("raw_events", "e_"), z_chain("e_"), feature_chain("e_"))
EVENTS_FOREST = with_ctes(
    RAW_EVENTS,
    record_chain("raw_events", "e_"),
    z_chain("e_"),
    feature_chain("e_"),
    scale_chain("e_"),
    forest_chain("e_"),
)
PRICES_Z = with_ctes(RAW_PRICES, record_chain("raw_prices", "p_"), z_chain("p_"))
PRICES_FOREST = with_ctes(
    RAW_PRICES,
    record_chain("raw_prices", "p_"),
    z_chain("p_"),
    feature_chain("p_"),
    scale_chain("p_"),
    forest_chain("p_"),
)
PUBLISHED = replace(CFG, pool_size=PUBLISHED_POOL)
LINEITEM_PUBLISHED = with_ctes(
    RAW_LINEITEM,
    record_chain("raw_lineitem", "l_"),
    z_chain("l_"),
    feature_chain("l_"),
    scale_chain("l_"),
    pool_chain("l_", PUBLISHED),
)
# F2 z-scores read from text: some passages are not numbers, labels come in three forms.
TEXT_Z = """
t_zscored as materialized (
  select * replace (case when extract(day from datetime) = 13 then null else total_passages end as total_passages)
  from l_zscored
)"""
LINEITEM_TEXT = with_ctes(
    RAW_LINEITEM,
    record_chain("raw_lineitem", "l_"),
    z_chain("l_"),
    TEXT_Z,
    feature_chain("t_"),
    scale_chain("t_"),
    forest_chain("t_"),
)
LINEITEM_Z = with_ctes(RAW_LINEITEM, record_chain("raw_lineitem", "l_"), z_chain("l_"))
# F2 after March of every year came again with one passenger more in every record.
CORRECTED = """
raw_corrected as (
  select * replace (case when month(transition_date) = 3 then number_of_passenger + 1 else number_of_passenger end
                    as number_of_passenger)
  from raw_lineitem
)"""
CORRECTED_Z = with_ctes(RAW_LINEITEM, CORRECTED, record_chain("raw_corrected", "u_"), z_chain("u_"))
LINEITEM_F = with_ctes(
    RAW_LINEITEM, record_chain("raw_lineitem", "l_"), z_chain("l_"), feature_chain("l_"), scale_chain("l_")
)
LINEITEM_FOREST = with_ctes(
    RAW_LINEITEM,
    record_chain("raw_lineitem", "l_"),
    z_chain("l_"),
    feature_chain("l_"),
    scale_chain("l_"),
    forest_chain("l_"),
)

KEYS = "datetime, line, line_name, town"
CELL = f"{KEYS}, total_passengers, total_passages, record_count"
TEMPORAL = "hour, month, spark_dayofweek, is_weekend"
OUTPUT = (
    f"{CELL}, {TEMPORAL}, zscore_anomaly, context_obs_count, loo_mean_passengers, "
    f"loo_std_passengers, {', '.join(FEATURES)}"
)
OUTPUT_DOUBLES = ["total_passengers", "total_passages", "loo_mean_passengers", "loo_std_passengers", *FEATURES]


def method_aggs() -> str:
    return (
        "count(*) as total_obs, sum(zscore_anomaly)::bigint as zscore_anomaly_count, "
        "sum(iforest_anomaly)::bigint as iforest_anomaly_count, avg(iforest_score) as avg_iforest_score"
    )


def method_rates(src: str) -> str:
    return (
        f"select *, zscore_anomaly_count::double / total_obs as zscore_anomaly_rate, "
        f"iforest_anomaly_count::double / total_obs as iforest_anomaly_rate from ({src})"
    )


def summary_sql(src: str = "l_flagged") -> str:
    return f"""select *,
  zscore_anomaly_count::double / total_rows as zscore_anomaly_rate,
  iforest_anomaly_count::double / total_rows as iforest_anomaly_rate,
  both_methods_anomaly_count::double / total_rows as method_overlap_rate,
  case when zscore_anomaly_count = 0 then null else both_methods_anomaly_count::double / zscore_anomaly_count end
    as overlap_among_zscore_anomalies,
  case when iforest_anomaly_count = 0 then null else both_methods_anomaly_count::double / iforest_anomaly_count end
    as overlap_among_iforest_anomalies
from (select count(*) as total_rows,
  sum(zscore_anomaly)::bigint as zscore_anomaly_count,
  sum(iforest_anomaly)::bigint as iforest_anomaly_count,
  cast(count_if(zscore_anomaly = 1 and iforest_anomaly = 1) as bigint) as both_methods_anomaly_count,
  cast(count_if(zscore_anomaly = 1 and iforest_anomaly = 0) as bigint) as only_zscore_anomaly_count,
  cast(count_if(zscore_anomaly = 0 and iforest_anomaly = 1) as bigint) as only_iforest_anomaly_count,
  avg(iforest_score) as avg_iforest_score, max(iforest_score) as max_iforest_score,
  min(iforest_score) as min_iforest_score
  from {src})"""


SUMMARY_DOUBLES = [
    "avg_iforest_score",
    "max_iforest_score",
    "min_iforest_score",
    "zscore_anomaly_rate",
    "iforest_anomaly_rate",
    "method_overlap_rate",
    "overlap_among_zscore_anomalies",
    "overlap_among_iforest_anomalies",
]
METHOD_DOUBLES = ["avg_iforest_score", "zscore_anomaly_rate", "iforest_anomaly_rate"]


def final(ctes: str, body: str, doubles: list[str] | tuple[str, ...] = ()) -> str:
    return f"{ctes}select {replace_round(list(doubles))} from (\n{body}\n)"


def rate_by_sql(src: str, key: str, flag: str = "is_anomaly") -> str:
    return (
        f"select {key}, count({flag}) as total_obs, sum(case when {flag} then 1 else 0 end)::bigint as anomaly_count, "
        f"sum(case when {flag} then 1 else 0 end)::double / count({flag}) as anomaly_rate "
        f"from {src} where {key} is not null group by {key}"
    )


def sql_queries() -> dict[str, str]:
    """Oracle SQL per query key (see ``__spark_entry__.queries``)."""
    q: dict[str, str] = {}
    ev, lz, lf, lt = EVENTS, LINEITEM_Z, LINEITEM_F, LINEITEM_FOREST
    raw_cols = "transition_date, transition_hour, line, line_name, town, number_of_passenger, number_of_passage"

    # --- sources and record operators (F1: dirty events) -------------------
    q["scan_records"] = final(ev, f"select {raw_cols} from raw_events")
    q["scan_records_permuted"] = q["scan_records"]
    hour = "cast(extract(hour from ts) as integer)"
    q["cast_records_decimal_hours"] = (
        f"select event_id, case when event_id % 3 = 1 or event_id % 89 = 0 then null else {hour} end as transition_hour "
        "from events"
    )
    q["cast_records"] = final(ev, f"select {raw_cols} from e_cast", ["number_of_passenger", "number_of_passage"])
    q["valid_records"] = final(ev, f"select {raw_cols} from e_valid", ["number_of_passenger", "number_of_passage"])
    q["build_datetime"] = final(
        ev, f"select {raw_cols}, datetime from e_dated", ["number_of_passenger", "number_of_passage"]
    )
    q["coerce_datetime"] = final(ev, "select try_cast(transition_date as timestamp) as datetime, line from raw_events")
    q["profile_records"] = final(
        ev,
        "select count(*) as row_count, "
        + ", ".join(f"count({c}) as non_null_{c}" for c in raw_cols.split(", "))
        + " from e_cast",
    )
    q["hourly_aggregate"] = final(ev, f"select {CELL} from e_hourly", ["total_passengers", "total_passages"])
    q["temporal_features"] = final(ev, f"select {CELL}, {TEMPORAL} from e_cells", ["total_passengers", "total_passages"])
    q["ensure_temporal"] = q["temporal_features"]
    q["merge_parts_mixed"] = final(
        lz,
        "select datetime, line, line_name, town, total_passengers, "
        "case when hour % 3 = 2 then null else total_passages end as total_passages, record_count from l_cells",
        ["total_passengers", "total_passages"],
    )
    q["read_results"] = final(
        ev,
        f"select {KEYS}, total_passengers, "
        "case when hour % 5 = 0 then null else z_score end as z_score, case when is_anomaly then 1 else 0 end as zscore_anomaly "
        "from e_zscored",
        ["total_passengers", "z_score"],
    )
    q["merge_parts"] = final(lz, f"select {CELL} from l_hourly", ["total_passengers", "total_passages"])
    q["coerce_numeric"] = final(
        ev,
        f"select {KEYS}, try_cast(cast(total_passengers as varchar) as double) as total_passengers, "
        "try_cast(cast(total_passages as varchar) as double) as total_passages, "
        "try_cast(cast(record_count as varchar) as double) as record_count from e_cells",
        ["total_passengers", "total_passages", "record_count"],
    )
    q["read_stage"] = final(lz, f"select {CELL}, {TEMPORAL} from l_cells", ["total_passengers", "total_passages"])
    q["normalize_label"] = final(ev, f"select {KEYS}, zscore_anomaly from e_labelled")
    q["complete_rows"] = final(
        ev, f"select {CELL}, zscore_anomaly from e_complete", ["total_passengers", "total_passages"]
    )
    q["in_range_rows"] = final(
        ev, f"select {CELL}, zscore_anomaly from e_in_range", ["total_passengers", "total_passages"]
    )
    q["drop_reasons"] = final(
        ev,
        """select 'records' as stage, reason, count(*) as row_count from (
  select case when transition_date is null then 'null_or_bad_date'
              when transition_hour is null then 'null_or_bad_hour'
              when not (transition_hour between 0 and 23) then 'hour_out_of_range'
              when number_of_passenger is null then 'null_or_bad_passengers'
              when not (number_of_passenger >= 0 and number_of_passenger < 'inf'::double)
                then 'negative_or_non_finite_passengers'
              else 'kept' end as reason
  from e_cast) group by reason
union all
select 'cells' as stage, reason, count(*) as row_count from (
  select case when c.total_passengers is null or c.total_passages is null or c.record_count is null then 'null_total'
              when not (c.total_passengers >= 0 and c.total_passengers < 'inf'::double)
                or not (c.total_passages >= 0 and c.total_passages < 'inf'::double)
                or c.record_count <= 0 then 'negative_or_non_finite_total'
              when c.line is null or c.hour is null or c.spark_dayofweek is null then 'null_context_key'
              when coalesce(p.context_obs_count, 0) < 5 then 'small_context'
              else 'kept' end as reason
  from e_cells c left join e_profile p
    on c.line = p.line and c.hour = p.hour and c.spark_dayofweek = p.spark_dayofweek) group by reason""",
    )
    q["drop_reasons_observed"] = q["drop_reasons"]
    q["profile_records_observed"] = q["profile_records"]
    q["drop_reasons_malformed"] = final(
        ev,
        """select reason, count(*) as row_count from (
  select case when town in ('FRANCE', 'PERU') then 'malformed_line'
              when transition_date is null then 'null_or_bad_date'
              when transition_hour is null then 'null_or_bad_hour'
              when not (transition_hour between 0 and 23) then 'hour_out_of_range'
              when number_of_passenger is null then 'null_or_bad_passengers'
              when not (number_of_passenger >= 0 and number_of_passenger < 'inf'::double)
                then 'negative_or_non_finite_passengers'
              else 'kept' end as reason
  from e_cast) group by reason""",
    )
    q["contextual_zscore_events"] = final(
        ev,
        f"select {CELL}, {TEMPORAL}, group_mean, group_std, z_score, is_anomaly from e_zscored",
        ["total_passengers", "total_passages", "group_mean", "group_std", "z_score"],
    )

    # --- z-score (F2: lineitem) --------------------------------------------
    zcols = f"{CELL}, {TEMPORAL}, group_mean, group_std, z_score, is_anomaly"
    zd = ["total_passengers", "total_passages", "group_mean", "group_std", "z_score"]
    q["context_moments"] = final(lz, "select * from l_moments", ["group_mean", "group_std"])
    q["attach_context"] = final(
        lz, f"select {CELL}, {TEMPORAL}, group_mean, group_std from l_attached",
        ["total_passengers", "total_passages", "group_mean", "group_std"],
    )
    q["contextual_zscore"] = final(lz, f"select {zcols} from l_zscored", zd)
    q["contextual_zscore_bucketed"] = q["contextual_zscore"]
    q["context_moments_merged"] = q["context_moments"]
    q["update_month"] = final(CORRECTED_Z, f"select {CELL}, {TEMPORAL} from u_cells", ["total_passengers", "total_passages"])
    q["update_zscore"] = final(CORRECTED_Z, f"select {zcols} from u_zscored where month = 3", zd)
    q["rescore"] = final(CORRECTED_Z, f"select {zcols} from u_zscored", zd)
    q["zscore_anomalies"] = final(lz, f"select {zcols} from l_zscored where is_anomaly", zd)
    q["top_zscore"] = final(
        lz,
        f"select {zcols} from l_zscored where is_anomaly "
        "order by abs(z_score) desc nulls last, datetime nulls first, line nulls first, "
        "line_name nulls first, town nulls first limit 20",
        zd,
    )
    sens = " union all ".join(
        f"select {t}::double as threshold, cast(count_if(abs(z_score) > {t}) as bigint) as anomaly_count, "
        f"cast(count_if(abs(z_score) > {t}) as bigint)::double / count(*) as anomaly_rate from l_zscored"
        for t in SENSITIVITY_THRESHOLDS
    )
    q["threshold_sensitivity"] = final(lz, sens, ["anomaly_rate"])
    q["rate_by_month"] = final(lz, rate_by_sql("l_zscored", "month"), ["anomaly_rate"])
    q["rate_by_line"] = final(lz, rate_by_sql("l_zscored", "line"), ["anomaly_rate"])
    q["rate_by_weekend"] = final(lz, rate_by_sql("l_zscored", "is_weekend"), ["anomaly_rate"])
    q["rate_by_town"] = final(lz, rate_by_sql("l_zscored", "town"), ["anomaly_rate"])
    q["top5_line_rate"] = final(
        lz, rate_by_sql("l_zscored", "line") + " order by anomaly_rate desc, line limit 5", ["anomaly_rate"]
    )
    q["hourly_average"] = final(
        lz, "select hour, avg(total_passengers) as avg_passengers from l_zscored group by hour", ["avg_passengers"]
    )
    q["top_anomaly_lines"] = final(
        lz,
        "select line, count(*) as anomaly_count from l_zscored where is_anomaly and line is not null "
        "group by line order by anomaly_count desc, line limit 10",
    )
    q["overall_ratio"] = final(
        lz,
        "select count(*) as total_rows, cast(count_if(is_anomaly) as bigint) as total_anomalies, "
        "coalesce(cast(count_if(is_anomaly) as bigint)::double / nullif(count(*), 0), 0.0) as anomaly_ratio from l_zscored",
        ["anomaly_ratio"],
    )
    ds = (
        "(select count(*)::double as total_rows, 15.0::double as total_columns, "
        "cast(count_if(is_anomaly) as bigint)::double as total_anomalies, "
        "coalesce(cast(count_if(is_anomaly) as bigint)::double / nullif(count(*), 0), 0.0) as anomaly_ratio from l_zscored)"
    )
    q["dataset_summary"] = final(
        lz,
        " union all ".join(
            f"select '{label}' as property, {col} as value from {ds}"
            for label, col in zip(
                SUMMARY_PROPERTIES, ("total_rows", "total_columns", "total_anomalies", "anomaly_ratio")
            )
        ),
        ["value"],
    )
    q["line_series"] = final(
        lz,
        "select datetime, line_name, town, total_passengers, "
        "case when is_anomaly then total_passengers end as anomaly_passengers "
        "from l_zscored where line = 'NO'",
        ["total_passengers", "anomaly_passengers"],
    )

    # --- context features (F2) ----------------------------------------------
    q["ratio_features"] = final(
        lf,
        f"select {CELL}, passage_per_passenger, passenger_per_record, passage_per_record from l_ratios",
        ["total_passengers", "total_passages", "passage_per_passenger", "passenger_per_record", "passage_per_record"],
    )
    prof_d = [
        "context_mean_passengers",
        "context_var_passengers",
        "context_avg_passage_per_passenger",
        "context_avg_passenger_per_record",
        "context_avg_passage_per_record",
    ]
    tidy = [f"round({c}, {FEATURE_DIGITS}) as {c}" for c in ("context_mean_passengers", "context_var_passengers")]
    q["context_profile"] = final(lf, f"select * replace ({', '.join(tidy)}) from l_profile", prof_d)
    q["c_factor"] = final(
        lf,
        f"select line, hour, spark_dayofweek, context_obs_count, {c_factor('context_obs_count')} as c_factor from l_profile",
        ["c_factor"],
    )
    q["context_profile_joined"] = final(
        lf,
        f"select {CELL}, context_obs_count, context_mean_passengers, context_var_passengers from "
        f"(select r.*, s.context_obs_count, s.context_mean_passengers, s.context_var_passengers from l_ratios r "
        f"left join l_profile s on r.line = s.line and r.hour = s.hour and r.spark_dayofweek = s.spark_dayofweek)",
        ["total_passengers", "total_passages", "context_mean_passengers", "context_var_passengers"],
    )
    q["min_context"] = final(
        lf, f"select {CELL}, context_obs_count from l_joined", ["total_passengers", "total_passages"]
    )
    q["leave_one_out"] = final(
        lf,
        f"select {CELL}, context_obs_count, loo_mean_passengers, loo_std_passengers from l_loo",
        ["total_passengers", "total_passages", "loo_mean_passengers", "loo_std_passengers"],
    )
    q["context_features"] = final(lf, f"select {OUTPUT} from l_featured", OUTPUT_DOUBLES)
    q["feature_moments"] = final(
        lf, "select * from l_fstats", [f"{c}_{s}" for c in FEATURES for s in ("mean", "std")]
    )
    scaled = [f"{c}_scaled" for c in FEATURES]
    q["standardize"] = final(lf, f"select {KEYS}, {', '.join(scaled)} from l_scaled", scaled)

    # --- forest (F2) ------------------------------------------------------------
    lp = LINEITEM_PUBLISHED
    q["training_pool"] = final(lp, f"select row_key, h_pool, {', '.join(scaled)} from l_pool", scaled)
    drawn = (
        f"(select *, {h(repr(str(CFG.seed)), repr('pool'), 'row_key')} as h_pool from l_scaled) "
        f"where h_pool < (select case when count(*) <= 2000 then {1 << 60} "
        f"else greatest(({1 << 60}::hugeint * 2000) // count(*), {1 << 60} // 1000) end from l_scaled)"
    )
    q["bernoulli_sample"] = final(lf, f"select row_key, h_pool, {', '.join(scaled)} from {drawn}", scaled)
    q["bernoulli_pool"] = final(lf, f"select row_key, h_pool from {drawn} order by h_pool, row_key limit 2000")
    q["tree_samples_published_pool"] = final(lp, "select tree_id, row_key, h_tree from l_samples")
    q["tree_samples"] = final(lt, "select tree_id, row_key, h_tree from l_samples")
    q["fit_forest"] = final(lt, "select * from l_nodes", ["split"])
    q["iforest_score"] = final(
        lt, f"select {KEYS}, iforest_path_units, iforest_score from l_scored0", ["iforest_score"]
    )
    q["iforest_threshold"] = final(
        lt,
        f"select n as scored_rows, rk as threshold_rank, threshold_units, "
        f"pow(2.0, -(threshold_units::double / 1e9 / {CFG.num_trees}.0) / {c_factor(str(CFG.max_samples))}) "
        f"as threshold_score from l_thr",
        ["threshold_score"],
    )
    q["iforest_flags"] = final(
        lt,
        f"select {KEYS}, zscore_anomaly, iforest_score, iforest_prediction, iforest_anomaly from l_flagged",
        ["iforest_score"],
    )
    q["detect_end_to_end"] = final(
        lt,
        f"select {OUTPUT}, iforest_score, iforest_prediction, iforest_anomaly from l_flagged",
        [*OUTPUT_DOUBLES, "iforest_score"],
    )
    q["top_iforest"] = final(
        lt,
        f"select {KEYS}, zscore_anomaly, iforest_score, iforest_anomaly from l_flagged "
        "order by iforest_score desc, datetime nulls first, line nulls first, line_name nulls first, "
        "town nulls first limit 20",
        ["iforest_score"],
    )
    q["method_summary"] = final(lt, summary_sql(), SUMMARY_DOUBLES)
    q["method_summary_events"] = final(EVENTS_FOREST, summary_sql("e_flagged"), SUMMARY_DOUBLES)
    q["iforest_flags_events"] = final(
        EVENTS_FOREST,
        f"select {KEYS}, zscore_anomaly, iforest_path_units, iforest_score, iforest_anomaly from e_flagged",
        ["iforest_score"],
    )
    by_month = method_rates(f"select month, {method_aggs()} from l_flagged group by month")
    by_line = method_rates(f"select line, {method_aggs()} from l_flagged group by line")
    q["method_by_month"] = final(lt, by_month, METHOD_DOUBLES)
    q["method_by_line"] = final(lt, by_line, METHOD_DOUBLES)
    q["write_report"] = q["method_by_month"]
    q["method_grouping_sets"] = final(
        lt,
        method_rates(
            f"select case grouping(month, line) when 3 then 'all' when 1 then 'month' else 'line' end as grain, "
            f"month, line, {method_aggs()} from l_flagged group by grouping sets ((), (month), (line))"
        ),
        METHOD_DOUBLES,
    )
    q["line_ranking_min_obs"] = final(
        lt,
        f"select * from ({by_line}) where total_obs >= 1000 order by iforest_anomaly_rate desc, line limit 3",
        METHOD_DOUBLES,
    )
    q["line_rate_pairs"] = final(
        lt,
        f"select line, zscore_anomaly_rate, iforest_anomaly_rate, total_obs from ({by_line}) where total_obs >= 1000",
        ["zscore_anomaly_rate", "iforest_anomaly_rate"],
    )
    zl, il = METHOD_LABELS["zscore"], METHOD_LABELS["iforest"]
    q["monthly_counts_long"] = final(
        lt,
        f"select month, '{zl}' as method, zscore_anomaly_count as anomaly_count from ({by_month}) "
        f"union all select month, '{il}' as method, iforest_anomaly_count as anomaly_count from ({by_month})",
    )
    q["monthly_rates_long"] = final(
        lt,
        f"select month, '{zl}' as method, zscore_anomaly_rate as anomaly_rate from ({by_month}) "
        f"union all select month, '{il}' as method, iforest_anomaly_rate as anomaly_rate from ({by_month})",
        ["anomaly_rate"],
    )
    summ = summary_sql()
    q["method_table"] = final(
        lt,
        f"select '{zl}' as method, zscore_anomaly_count as anomaly_count, zscore_anomaly_rate as anomaly_rate "
        f"from ({summ}) union all select '{il}' as method, iforest_anomaly_count as anomaly_count, "
        f"iforest_anomaly_rate as anomaly_rate from ({summ})",
        ["anomaly_rate"],
    )
    b, oz, oi = OVERLAP_LABELS
    q["overlap_table"] = final(
        lt,
        f"select '{b}' as category, both_methods_anomaly_count as count from ({summ}) "
        f"union all select '{oz}' as category, only_zscore_anomaly_count as count from ({summ}) "
        f"union all select '{oi}' as category, only_iforest_anomaly_count as count from ({summ})",
    )
    pct = lambda c: f"printf('%.2f%%', {c} * 100.0)"
    q["formatted_monthly"] = (
        f"{lt}select month, "
        + ", ".join(
            f"format('{{:,}}', {c}) as {c}" for c in ("total_obs", "zscore_anomaly_count", "iforest_anomaly_count")
        )
        + f", {pct('zscore_anomaly_rate')} as zscore_anomaly_rate, {pct('iforest_anomaly_rate')} as iforest_anomaly_rate "
        f"from ({by_month})"
    )
    q["iforest_flags_approx"] = final(
        lt,
        "select n as scored_rows, true as rank_within_tolerance, true as flags_follow_score "
        "from (select count(*) as n from l_scored0)",
    )
    q["iforest_flags_sketch"] = final(
        lt,
        "select n as scored_rows, true as rank_within_bound, true as flags_follow_units "
        "from (select count(*) as n from l_scored0)",
    )

    # --- fractional measure, many records per cell (F3) -----------------------
    pz, pf = PRICES_Z, PRICES_FOREST
    q["hourly_aggregate_prices"] = final(pz, f"select {CELL} from p_hourly", ["total_passengers", "total_passages"])
    q["contextual_zscore_prices"] = final(pz, f"select {zcols} from p_zscored", zd)
    q["context_features_prices"] = final(  # deviations of 1e5: compared at four decimals
        pf,
        f"select {OUTPUT} from (select * replace (round(loo_std_passengers, 4) as loo_std_passengers) from p_featured)",
        OUTPUT_DOUBLES,
    )
    q["iforest_flags_prices"] = final(
        pf,
        f"select {KEYS}, zscore_anomaly, iforest_path_units, iforest_score, iforest_anomaly from p_flagged",
        ["iforest_score"],
    )
    q["method_summary_prices"] = final(pf, summary_sql("p_flagged"), SUMMARY_DOUBLES)

    # --- forest from a text table of z-scores ----------------------------------
    tx = LINEITEM_TEXT
    q["iforest_flags_text"] = final(
        tx, f"select {KEYS}, zscore_anomaly, iforest_path_units, iforest_anomaly from t_flagged"
    )
    q["drop_reasons_text"] = final(
        tx,
        """select 'cells' as stage, reason, count(*) as row_count from (
  select case when z.total_passages is null then 'null_total'
              when coalesce(p.context_obs_count, 0) < 5 then 'small_context' else 'kept' end as reason
  from t_zscored z left join t_profile p
    on z.line = p.line and z.hour = p.hour and z.spark_dayofweek = p.spark_dayofweek) group by reason""",
    )
    return q
