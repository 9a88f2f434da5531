"""SQL that gives the same rows as each registered query, for checking in another engine."""

from __future__ import annotations

from riskloom.plans.queries import SCALED
from riskloom.plans.workspace import COEFFICIENTS, INTERCEPT, MODEL_RUN_ID, T_BLOCK, T_REVIEW
from riskloom.schemas import COUNTRIES

_LANDS = "[" + ", ".join(f"'{c}'" for c in COUNTRIES) + "]"
_ROUNDED = """* replace (round(amount_vs_customer_p95, 6) as amount_vs_customer_p95,
  round(device_age_days, 6) as device_age_days,
  round(merchant_fraud_rate_hist, 6) as merchant_fraud_rate_hist)"""

# Named building blocks, each a CTE; a query lists the ones it needs through {{name}}.
_BASE = {
    "b": """select event_id, user_id, cast(json_extract_string(props, '$.k') as int) as k, ts, value,
      event_type, c_nationkey % 7 as h from events left join customer on c_custkey = user_id""",
    "x": """select *, cast(case when event_id % 33 = 0 then (h + 1 + (event_id // 33) % 6) % 7
      else h end as int) as ci,
      case when event_type = 'error' and (k >= 90 or event_id % 10 = 0) then 1 else 0 end as lab
      from b""",
    "t": f"""select event_id, concat('TXN', lpad(cast(event_id as varchar), 10, '0')) as transaction_id,
      concat('CUST', lpad(cast(user_id as varchar), 7, '0')) as customer_id,
      concat('MERC', lpad(cast(k as varchar), 6, '0')) as merchant_id,
      concat('DEV', lpad(cast(user_id * 3 + k % 3 as varchar), 7, '0')) as device_id,
      ts as timestamp, value as amount,
      case when event_id % 10 < 7 then 'card' when event_id % 10 < 9 then 'wallet'
        else 'bank_transfer' end as payment_method,
      {_LANDS}[ci + 1] as country,
      {_LANDS}[(case when event_id % 47 = 0 then (ci + 1) % 7 else ci end) + 1]
        as ip_country,
      {_LANDS}[cast(h as int) + 1] as home_country,
      lab as fraud_label,
      case when lab = 1 then ts + to_days(cast(event_id % 15 as int)) end as confirmed_fraud_at,
      k / 200.0::double + case when event_type = 'error' then 0.3::double else 0.0::double end
        + value / 2500.0::double as model_score,
      list_extract(['crypto', 'dining', 'electronics', 'fashion', 'gaming', 'grocery', 'other',
        'travel'], k % 8 + 1) as merchant_category
      from x""",
    "f_txn": """select transaction_id, amount, payment_method, cast(hour(timestamp) as bigint) as hour_of_day,
      case when hour(timestamp) in (1, 2, 3, 4) then 1 else 0 end as is_night,
      case when country <> home_country then 1 else 0 end as is_cross_border from t""",
    "f_beh": """select transaction_id, case when n >= 5 then amount / (p + 1e-6) else 1.0 end
      as amount_vs_customer_p95 from (select transaction_id, amount,
        quantile_cont(amount, 0.95) over w as p, count(*) over w as n from t
        window w as (partition by customer_id order by timestamp, transaction_id
          rows between unbounded preceding and 1 preceding))""",
    "f_vel": """select transaction_id,
      count(*) over (partition by customer_id order by timestamp range between
        interval 1 hour preceding and interval 1 microsecond preceding) as txn_count_1h,
      count(*) over (partition by customer_id order by timestamp range between
        interval 24 hour preceding and interval 1 microsecond preceding) as txn_count_24h
      from t""",
    "dv": """select device_id, min(timestamp) as first_seen_at, min(customer_id) as customer_id
      from t group by device_id""",
    "f_dev": """select transaction_id, is_new_device, device_age_days,
      cast(coalesce(sum(first_use) over (partition by customer_id order by timestamp, transaction_id
        rows between unbounded preceding and 1 preceding), 0) as bigint)
        as customer_device_count_so_far
      from (select t.transaction_id, t.customer_id, t.timestamp,
        case when row_number() over (partition by t.device_id order by t.timestamp, t.transaction_id)
          = 1 then 1 else 0 end as is_new_device,
        case when row_number() over (partition by t.customer_id, t.device_id
          order by t.timestamp, t.transaction_id) = 1 then 1 else 0 end as first_use,
        greatest((epoch_us(t.timestamp) - epoch_us(first_seen_at)) / 86400e6, 0)
          as device_age_days from t join dv on t.device_id = dv.device_id)""",
    "f_geo": """select transaction_id, case when row_number() over (partition by customer_id, country
        order by timestamp, transaction_id) = 1 then 1 else 0 end as is_new_country_for_customer,
      case when country <> ip_country then 1 else 0 end as ip_country_mismatch from t""",
    "f_mer": """select transaction_id, least(greatest((case when den >= 20 then num else gnum end
        - own) / greatest(case when den >= 20 then den else gden end, 1), 0), 1)
        as merchant_fraud_rate_hist
      from (select transaction_id, own, is_txn,
        coalesce(sum(is_txn) over (partition by merchant_id order by seen_at range between
          unbounded preceding and interval 1 microsecond preceding), 0) as den,
        sum(is_conf) over (partition by merchant_id order by seen_at range between
          unbounded preceding and current row) as num,
        coalesce(sum(is_txn) over (order by seen_at range between
          unbounded preceding and interval 1 microsecond preceding), 0) as gden,
        sum(is_conf) over (order by seen_at range between
          unbounded preceding and current row) as gnum
        from (select transaction_id, merchant_id, timestamp as seen_at, 1 as is_txn, 0 as is_conf,
            case when confirmed_fraud_at <= timestamp then 1 else 0 end as own from t
          union all select null, merchant_id, confirmed_fraud_at, 0, 1, 0 from t
            where fraud_label = 1))
      where is_txn = 1""",
    "f": """select t.transaction_id, customer_id, merchant_id, timestamp, t.amount, t.payment_method,
      hour_of_day, is_night, is_cross_border, amount_vs_customer_p95, txn_count_1h, txn_count_24h,
      is_new_device, device_age_days, customer_device_count_so_far, merchant_fraud_rate_hist,
      is_new_country_for_customer, ip_country_mismatch
      from t join f_txn using (transaction_id) join f_beh using (transaction_id)
      join f_vel using (transaction_id) join f_dev using (transaction_id)
      join f_mer using (transaction_id) join f_geo using (transaction_id)""",
    "fr": f"select {_ROUNDED} from f",
    "mxr": f"select {_ROUNDED} from mx",
    "cut": """select epoch_us(min(timestamp)) + cast(floor((epoch_us(max(timestamp))
        - epoch_us(min(timestamp))) * 0.70::double) as bigint) as c1,
      epoch_us(min(timestamp)) + cast(floor((epoch_us(max(timestamp))
        - epoch_us(min(timestamp))) * (0.70::double + 0.15::double)) as bigint) as c2 from t""",
    "sp": """select t.*, case when epoch_us(timestamp) < c1 then 'train'
      when epoch_us(timestamp) < c2 then 'val' else 'test' end as split from t, cut""",
    "mx": """select f.*, split, case when payment_method = 'bank_transfer' then 1 else 0 end
        as payment_method_bank_transfer,
      case when payment_method = 'card' then 1 else 0 end as payment_method_card,
      case when payment_method = 'wallet' then 1 else 0 end as payment_method_wallet
      from f join (select transaction_id, split from sp) using (transaction_id)""",
    "bg": "select * from mx where split = 'train'",
    "rl": """select f.*, model_score, event_id, fraud_label,
      is_new_device = 1 and is_new_country_for_customer = 1 and ip_country_mismatch = 1 as r1,
      txn_count_1h >= 5 as r2, merchant_fraud_rate_hist > 0.15 as r3,
      amount_vs_customer_p95 > 3.0 and is_new_device = 1 as r4
      from f join (select transaction_id, event_id, model_score, fraud_label from t)
        using (transaction_id)""",
    "dc": f"""select *, case when fired and rlev >= mlev then list_extract(['approve', 'review', 'block'],
        rlev + 1) else list_extract(['approve', 'review', 'block'], mlev + 1) end as decision,
      case when fired and rlev >= mlev then 'rule' else 'model' end as decision_source
      from (select *, event_id as id, timestamp as created_at, r1 or r2 or r3 or r4 as fired,
        case when r1 or r2 then 2 when r3 or r4 then 1 else 0 end as rlev,
        case when model_score >= {T_BLOCK} then 2 when model_score >= {T_REVIEW} then 1 else 0 end
          as mlev,
        concat_ws(',', case when r1 then 'device_location_takeover' end,
          case when r2 then 'velocity_spike' end, case when r3 then 'high_risk_merchant' end,
          case when r4 then 'outsized_amount_new_device' end) as triggered_rules
        from rl)""",
    "grid": "select i, i * 0.01::double as c from range(0, 101) r(i)",
    "val": "select * from sp where split = 'val'",
    "cells": """select i as ti, j as tj, ci, cj, sum(cast(case when model_score < ci and fraud_label = 1
        then amount else 0 end as decimal(18, 2)))
      + 3.5 * count(*) filter (where model_score >= ci and model_score < cj)
      + 25 * count(*) filter (where model_score >= cj and fraud_label = 0) as cost
      from val, (select a.i, b.i as j, a.c as ci, b.c as cj from grid a, grid b where b.c > a.c)
      group by all""",
    "best": """select round(ci, 4) as t_review, round(cj, 4) as t_block, cast(cost as double) as total_cost
      from cells order by cost, ti, tj limit 1""",
    "curve": """select round(c, 4) as t_review, cast(sum(cast(case when model_score < c and fraud_label = 1
        then amount else 0 end as decimal(18, 2)))
      + 3.5 * count(*) filter (where model_score >= c and model_score < t_block)
      + 25 * count(*) filter (where model_score >= t_block and fraud_label = 0) as double) as cost,
      t_block from val, best, grid where c < t_block group by c, t_block""",
    "runs": """select name, start_time, concat(name, '-', strftime(start_time, '%Y%m%d')) as run_id,
        round(case when sum(pos) = 0 then 0 else sum(pos * tp / seen) / sum(pos) end, 6) as val_pr_auc
      from (select name, start_time, pos,
          sum(pos) over w as tp, sum(n) over w as seen
        from (select name, start_time, s, sum(fraud_label) as pos, count(*) as n
          from (select date_trunc('day', timestamp)::timestamp as start_time, fraud_label,
              unnest(['baseline', 'random_forest', 'xgboost', 'lightgbm']) as name,
              unnest([round(model_score, 6), merchant_raw, amount, ratio_raw]) as s
            from (select sp.*, merchant_fraud_rate_hist as merchant_raw,
              amount_vs_customer_p95 as ratio_raw from sp join fr using (transaction_id)
              where split = 'val'))
          group by all)
        window w as (partition by name, start_time order by s desc))
      group by name, start_time""",
    "latest": """select * from runs qualify row_number() over (partition by name
      order by start_time desc, run_id desc) = 1""",
    "contrib": "select transaction_id, feature, value from (\n"
    + "\nunion all ".join(
        f"select mx.transaction_id, {i} as place, '{c}' as feature,"
        f" ({c} - (select avg({c}) from bg)) * cast({w} as double) as value from mx"
        for i, (c, w) in enumerate(COEFFICIENTS.items())) + ")",
}
_BASE["contrib"] = _BASE["contrib"].replace("select transaction_id, feature, value from (",
                                            "select * from (")
_NEEDS = {
    "b": [], "x": ["b"], "t": ["x"], "f_txn": ["t"], "f_beh": ["t"], "f_vel": ["t"], "dv": ["t"],
    "f_dev": ["t", "dv"], "f_geo": ["t"], "f_mer": ["t"],
    "f": ["f_txn", "f_beh", "f_vel", "f_dev", "f_mer", "f_geo"],
    "fr": ["f"], "mxr": ["mx"], "cut": ["t"], "sp": ["cut"], "mx": ["f", "sp"], "bg": ["mx"], "rl": ["f"], "dc": ["rl"],
    "grid": [], "val": ["sp"], "cells": ["val", "grid"], "best": ["cells"],
    "curve": ["best"], "runs": ["sp", "fr"], "latest": ["runs"], "contrib": ["bg"],
}


def _with(needs: list[str], body: str) -> str:
    order: list[str] = []

    def add(name: str) -> None:
        for n in _NEEDS[name]:
            add(n)
        if name not in order:
            order.append(name)

    for n in needs:
        add(n)
    ctes = ",\n".join(f"{n} as materialized ({_BASE[n]})" for n in order)
    return f"with {ctes}\n{body}" if ctes else body


ORACLES: dict[str, str] = {}


def _oracle(name: str, needs: list[str], body: str) -> None:
    ORACLES[name] = _with(needs, body)


_oracle("feat_transaction", ["f_txn"], "select * from f_txn")
_oracle("feat_behavioral", ["f_beh"], "select * replace (round(amount_vs_customer_p95, 6) as"
        " amount_vs_customer_p95) from f_beh")
_oracle("feat_velocity", ["f_vel"], "select * from f_vel")
_oracle("feat_device", ["f_dev"],
        "select * replace (round(device_age_days, 6) as device_age_days) from f_dev")
_oracle("feat_geo", ["f_geo"], "select * from f_geo")
_oracle("feat_merchant", ["f_mer"], "select * replace (round(merchant_fraud_rate_hist, 6) as"
        " merchant_fraud_rate_hist) from f_mer")
_oracle("feature_table", ["fr"], "select * from fr")

_ORDERS = """o as (select cast(o_orderkey as varchar) as transaction_id,
  cast(o_custkey as varchar) as customer_id, o_orderpriority as merchant_id,
  o_orderdate::timestamp as timestamp, o_totalprice as amount from orders)"""
ORACLES["ties_velocity"] = f"""with {_ORDERS} select transaction_id,
  count(*) over (partition by customer_id order by timestamp range between
    interval 1 hour preceding and interval 1 microsecond preceding) as txn_count_1h,
  count(*) over (partition by customer_id order by timestamp range between
    interval 24 hour preceding and interval 1 microsecond preceding) as txn_count_24h from o"""
ORACLES["ties_behavioral"] = f"""with {_ORDERS} select transaction_id,
  round(case when n >= 5 then amount / (p + 1e-6) else 1.0 end, 6) as amount_vs_customer_p95
  from (select transaction_id, amount, quantile_cont(amount, 0.95) over w as p, count(*) over w as n
    from o window w as (partition by customer_id order by timestamp, transaction_id
      rows between unbounded preceding and 1 preceding))"""
ORACLES["ties_merchant"] = f"""with {_ORDERS},
  e as (select transaction_id, merchant_id, timestamp as seen_at, 1 as is_txn, 0 as is_conf,
      case when amount > 200000 then 1 else 0 end as own from o
    union all select null, merchant_id, timestamp, 0, 1, 0 from o where amount > 200000),
  c as (select *,
    coalesce(sum(is_txn) over (partition by merchant_id order by seen_at range between unbounded preceding
      and interval 1 microsecond preceding), 0) as den,
    sum(is_conf) over (partition by merchant_id order by seen_at range between unbounded preceding
      and current row) as num,
    coalesce(sum(is_txn) over (order by seen_at range between unbounded preceding
      and interval 1 microsecond preceding), 0) as gden,
    sum(is_conf) over (order by seen_at range between unbounded preceding and current row) as gnum
    from e)
  select transaction_id, round(least(greatest((case when den >= 20 then num else gnum end - own)
    / greatest(case when den >= 20 then den else gden end, 1), 0), 1), 6) as merchant_fraud_rate_hist
  from c where is_txn = 1"""
# Rows with missing values: the same answer from every plan.
_BASE["th"] = """select * replace (case when event_id % 13 <> 0 then amount end as amount,
    case when event_id % 17 <> 0 then country end as country,
    case when event_id % 19 <> 0 then device_id end as device_id) from t"""
_NEEDS["th"] = ["t"]
_HOLES = {
    "behavioral": """select transaction_id, round(coalesce(case when n >= 5 then amount / (p + 1e-6) end, 1.0), 6)
        as amount_vs_customer_p95
      from (select transaction_id, amount, quantile_cont(amount, 0.95) over w as p, count(amount) over w as n
        from th window w as (partition by customer_id order by timestamp, transaction_id
          rows between unbounded preceding and 1 preceding))""",
    "geo": """select transaction_id, case when country is not null and row_number() over (
          partition by customer_id, country order by timestamp, transaction_id) = 1 then 1 else 0 end
        as is_new_country_for_customer,
      case when country = ip_country then 0 else 1 end as ip_country_mismatch from th""",
    "velocity": _BASE["f_vel"].replace("from t", "from th"),
    "device": """select transaction_id, is_new_device, round(device_age_days, 6) as device_age_days,
      cast(coalesce(sum(first_use) over (partition by customer_id order by timestamp, transaction_id
        rows between unbounded preceding and 1 preceding), 0) as bigint) as customer_device_count_so_far
      from (select th.transaction_id, th.customer_id, th.timestamp,
        case when th.device_id is not null and row_number() over (partition by th.device_id
          order by th.timestamp, th.transaction_id) = 1 then 1 else 0 end as is_new_device,
        case when th.device_id is not null and row_number() over (partition by th.customer_id, th.device_id
          order by th.timestamp, th.transaction_id) = 1 then 1 else 0 end as first_use,
        case when first_seen_at is not null then greatest((epoch_us(th.timestamp) - epoch_us(first_seen_at))
          / 86400e6, 0) end as device_age_days from th left join dv on th.device_id = dv.device_id)""",
}
for _family, _sql in _HOLES.items():
    for _plan in ("windows", "groups", "split"):
        _oracle(f"holes_{_family}_{_plan}", ["th", "dv"], _sql)
ORACLES["feat_merchant_split"] = ORACLES["feat_merchant"]
_MODEL_COLUMNS = ", ".join(COEFFICIENTS)
_oracle("model_matrix", ["mxr"], f"select transaction_id, {_MODEL_COLUMNS} from mxr")
_oracle("training_rows", ["fr", "t"],
        "select fr.*, fraud_label from fr join (select transaction_id, fraud_label from t)"
        " using (transaction_id)")

# ---------------------------------------------------------------- quality

_FEATURE_NAMES = [
    "transaction_id", "customer_id", "merchant_id", "timestamp", "amount", "payment_method",
    "hour_of_day", "is_night", "is_cross_border", "amount_vs_customer_p95", "txn_count_1h",
    "txn_count_24h", "is_new_device", "device_age_days", "customer_device_count_so_far",
    "merchant_fraud_rate_hist", "is_new_country_for_customer", "ip_country_mismatch",
]


def _failures(table: str, column: str, check: str, condition: str, entity: str | None = None) -> str:
    lead = f"'{entity}' as entity, " if entity else ""
    text = check.replace("'", "''")
    return (f"select {lead}'{column}' as \"column\", '{text}' as \"check\","
            f" count(*) filter (where {condition}) as failures from {table}")


def _in(values: list) -> tuple[str, str]:
    inside = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)
    return f"isin([{inside}])", f"not in ({inside})"


_FLAG = _in([0, 1])
_PAY = _in(["bank_transfer", "card", "wallet"])
_LAND = _in(COUNTRIES)
_feature_checks = [(c, "not_nullable", f"{c} is null") for c in _FEATURE_NAMES] + [
    ("transaction_id", "str_startswith('TXN')", "not starts_with(transaction_id, 'TXN')"),
    ("amount", "greater_than(0)", "amount <= 0"),
    ("payment_method", _PAY[0], f"payment_method {_PAY[1]}"),
    ("hour_of_day", "in_range(0, 23)", "hour_of_day not between 0 and 23"),
    ("amount_vs_customer_p95", "greater_than(0)", "amount_vs_customer_p95 <= 0"),
    ("txn_count_1h", "greater_than_or_equal_to(0)", "txn_count_1h < 0"),
    ("txn_count_24h", "greater_than_or_equal_to(0)", "txn_count_24h < 0"),
    ("device_age_days", "greater_than_or_equal_to(0)", "device_age_days < 0"),
    ("customer_device_count_so_far", "greater_than_or_equal_to(0)",
     "customer_device_count_so_far < 0"),
    ("merchant_fraud_rate_hist", "in_range(0, 1)", "merchant_fraud_rate_hist not between 0 and 1"),
] + [(c, _FLAG[0], f"{c} {_FLAG[1]}") for c in (
    "is_night", "is_cross_border", "is_new_device", "is_new_country_for_customer",
    "ip_country_mismatch")]
_oracle("dq_column_checks", ["f"], "\nunion all ".join(
    [_failures("f", *c) for c in _feature_checks]
    + ["select 'transaction_id', 'field_uniqueness', cast(coalesce(sum(n), 0) as bigint) from"
       " (select count(*) as n from f group by transaction_id having count(*) > 1)"]))

_SEGMENT = _in(["business", "premium", "retail"])
_CATEGORY = _in(["crypto", "dining", "electronics", "fashion", "gaming", "grocery", "other",
                 "travel"])


def _unique(table: str, key: str, entity: str) -> str:
    return (f"select '{entity}', '{key}', 'field_uniqueness', cast(coalesce(sum(n), 0) as bigint)"
            f" from (select count(*) as n from {table} group by {key} having count(*) > 1)")


def _missing(entity: str, column: str) -> str:
    return f"select '{entity}', '{column}', 'column_in_dataframe', 1::bigint"


_oracle("dq_entity_report", ["t", "dv"], f"""select * from (
with cu as (select concat('CUST', lpad(cast(c_custkey as varchar), 7, '0')) as customer_id,
    lower(c_mktsegment) as customer_segment,
    {_LANDS}[cast(c_nationkey % 7 as int) + 1] as home_country from customer),
  me as (select distinct merchant_id, merchant_category from t)
""" + "\nunion all ".join([
    _failures("cu", c, "not_nullable", f"{c} is null", "customers")
    for c in ("customer_id", "customer_segment", "home_country")] + [
    _failures("cu", "customer_id", "str_startswith('CUST')",
              "not starts_with(customer_id, 'CUST')", "customers"),
    _failures("cu", "customer_segment", _SEGMENT[0], f"customer_segment {_SEGMENT[1]}", "customers"),
    _failures("cu", "home_country", _LAND[0], f"home_country {_LAND[1]}", "customers"),
    _unique("cu", "customer_id", "customers"),
    _missing("customers", "account_created_at"), _missing("customers", "home_city"),
    *[_failures("me", c, "not_nullable", f"{c} is null", "merchants")
      for c in ("merchant_id", "merchant_category")],
    _failures("me", "merchant_id", "str_startswith('MERC')",
              "not starts_with(merchant_id, 'MERC')", "merchants"),
    _failures("me", "merchant_category", _CATEGORY[0], f"merchant_category {_CATEGORY[1]}",
              "merchants"),
    _unique("me", "merchant_id", "merchants"),
    _missing("merchants", "country"), _missing("merchants", "created_at"),
    *[_failures("dv", c, "not_nullable", f"{c} is null", "devices")
      for c in ("device_id", "customer_id", "first_seen_at")],
    _failures("dv", "device_id", "str_startswith('DEV')", "not starts_with(device_id, 'DEV')",
              "devices"),
    _unique("dv", "device_id", "devices"), _missing("devices", "device_type"),
    *[_failures("t", c, "not_nullable", f"{c} is null", "transactions")
      for c in ("transaction_id", "customer_id", "merchant_id", "device_id", "timestamp", "amount",
                "payment_method", "country", "ip_country")],
    _failures("t", "transaction_id", "str_startswith('TXN')",
              "not starts_with(transaction_id, 'TXN')", "transactions"),
    _failures("t", "amount", "greater_than(0)", "amount <= 0", "transactions"),
    _failures("t", "payment_method", _PAY[0], f"payment_method {_PAY[1]}", "transactions"),
    _failures("t", "country", _LAND[0], f"country {_LAND[1]}", "transactions"),
    _failures("t", "ip_country", _LAND[0], f"ip_country {_LAND[1]}", "transactions"),
    _unique("t", "transaction_id", "transactions"),
    _missing("transactions", "currency"), _missing("transactions", "city"),
    *[_failures("t", c, "not_nullable", f"{c} is null", "ground_truth")
      for c in ("transaction_id", "fraud_label")],
    _failures("t", "fraud_label", _FLAG[0], f"fraud_label {_FLAG[1]}", "ground_truth"),
    _unique("t", "transaction_id", "ground_truth"),
    _missing("ground_truth", "fraud_probability_true"),
]) + ")")
_text = _SEGMENT[0].replace("'", "''")
ORACLES["dq_failure_cases"] = f"""
select concat('CUST', lpad(cast(c_custkey as varchar), 7, '0')) as customer_id,
  'customer_segment' as "column", '{_text}' as "check", lower(c_mktsegment) as failure_case
from customer where lower(c_mktsegment) {_SEGMENT[1]}
union all select concat('CUST', lpad(cast(c_custkey as varchar), 7, '0')), 'customer_segment',
  'not_nullable', null from customer where c_mktsegment is null"""
_KEY_OF = {"cu": ("customers", "customer_id"), "t": ("transactions", "transaction_id"), "ff": ("features", "transaction_id")}
# Cells with planted faults, by the number of a transaction.
_FLAWS = """amount_was.* replace (
  case when n % 97 = 0 then null when n % 89 = 0 then -5.5 else amount end as amount,
  case when n % 83 = 0 then 'cash' else payment_method end as payment_method,
  case when n % 79 = 0 then 24 else hour_of_day end as hour_of_day, case when n % 73 = 0 then 7 else is_night end as is_night,
  case when n % 71 = 0 then 1.5 else merchant_fraud_rate_hist end as merchant_fraud_rate_hist,
  case when n % 67 = 0 then -1 else txn_count_1h end as txn_count_1h)"""


def _flawed(table: str) -> str:
    return (f"select {_FLAWS} from (select *, cast(substr(transaction_id, 4, 10) as bigint) as n from {table}) amount_was")


def _cases(table: str, column: str, check: str, condition: str) -> str:
    entity, key = _KEY_OF[table]
    return (f"select '{entity}' as entity, {key} as key, '{column}' as \"column\", '{check.replace("'", "''")}' as \"check\","
            f" cast({column} as varchar) as failure_case from {table} where {condition}")


_customer_checks = [(c, "not_nullable", f"{c} is null") for c in ("customer_id", "customer_segment", "home_country")] + [
    ("customer_id", "str_startswith('CUST')", "not starts_with(customer_id, 'CUST')"),
    ("customer_segment", _SEGMENT[0], f"customer_segment {_SEGMENT[1]}"), ("home_country", _LAND[0], f"home_country {_LAND[1]}")]
_transaction_checks = [(c, "not_nullable", f"{c} is null") for c in (
    "customer_id", "merchant_id", "device_id", "timestamp", "amount", "payment_method", "country", "ip_country")] + [
    ("amount", "greater_than(0)", "amount <= 0"), ("payment_method", _PAY[0], f"payment_method {_PAY[1]}"),
    ("country", _LAND[0], f"country {_LAND[1]}"), ("ip_country", _LAND[0], f"ip_country {_LAND[1]}")]
_oracle("dq_all_failure_cases", ["t", "f"], f"""select * from (with cu as (
    select concat('CUST', lpad(cast(c_custkey as varchar), 7, '0')) as customer_id, lower(c_mktsegment) as customer_segment,
      {_LANDS}[cast(c_nationkey % 7 as int) + 1] as home_country from customer),
  ff as ({_flawed('f')})
""" + "\nunion all ".join([_cases("cu", *c) for c in _customer_checks] + [_cases("t", *c) for c in _transaction_checks]
                          + [_cases("ff", *c) for c in _feature_checks]) + ")")
_oracle("dq_scored_failures", ["dc"], f"""select transaction_id, "column", "check", failure_case from (with
  ff as (select * from ({_flawed('dc')}) order by id desc limit 500)
""" + "\nunion all ".join(_cases("ff", *c).replace(" as key,", " as transaction_id,") for c in _feature_checks) + ")")
ORACLES["dq_duplicate_keys"] = """select l_orderkey, l_linenumber, count(*) as occurrences
from lineitem group by all having count(*) > 1"""
_bad = " + ".join(f"(case when {c} then 1 else 0 end)" for _, _, c in _feature_checks)
_oracle("dq_scored_summary", ["dc"], f"""select count(*) as checked_rows,
  coalesce(sum(bad), 0) = 0 as passed, cast(coalesce(sum(bad), 0) as bigint) as failed_cells
from (select {_bad} as bad from (select * from dc order by id desc limit 500))""")


def _orphans(name: str, child: str, column: str, parent: str, key: str) -> str:
    return (f"select '{name}' as reference, count(*) as orphans from {child} c where not exists"
            f" (select 1 from {parent} p where p.{key} = c.{column})")


_oracle("dq_fk_orphans", ["t", "dv"], "\nunion all ".join([
    _orphans("order_customer", "orders", "o_custkey", "customer", "c_custkey"),
    _orphans("line_order", "lineitem", "l_orderkey", "orders", "o_orderkey"),
    _orphans("line_part", "lineitem", "l_partkey", "part", "p_partkey"),
    _orphans("line_supplier", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
    "select 'transaction_customer', count(*) from t where customer_id not in (select"
    " concat('CUST', lpad(cast(c_custkey as varchar), 7, '0')) from customer where c_custkey % 5 <> 0)",
    "select 'transaction_merchant', count(*) from t where merchant_id not in"
    " (select merchant_id from t where cast(substr(merchant_id, 5) as bigint) % 11 <> 0)",
    "select 'transaction_device', count(*) from t where device_id not in"
    " (select device_id from dv where cast(substr(device_id, 4) as bigint) % 7 <> 0)",
    "select 'device_customer', count(*) from dv where customer_id not in (select"
    " concat('CUST', lpad(cast(c_custkey as varchar), 7, '0')) from customer where c_custkey % 5 <> 0)",
    _orphans("label_document", "documents", "doc_id", "labels", "doc_id"),
]))
ORACLES["set_except_keys"] = "select doc_id from documents except select doc_id from labels"
ORACLES["dq_device_ownership"] = """with o as (select l_partkey, min(l_suppkey) as owner
  from lineitem group by l_partkey)
select concat(l_orderkey, '-', l_linenumber, '-', l.l_partkey) as transaction_id,
  l.l_partkey as device_id, l_suppkey as customer_id, owner
from lineitem l join o on o.l_partkey = l.l_partkey where owner <> l_suppkey"""
_BASE["flawed"] = """select transaction_id, timestamp, case when event_id % 3 = 0
    then confirmed_fraud_at - interval 5 day else confirmed_fraud_at end as confirmed_fraud_at
  from t where event_id % 23 <> 0 union all select transaction_id, timestamp, case when event_id % 3 = 0
    then confirmed_fraud_at - interval 5 day else confirmed_fraud_at end from t where event_id % 29 = 0"""
_NEEDS["flawed"] = ["t"]
_oracle("dq_one_to_one", ["t", "f", "flawed"], """
select 'transactions_ground_truth' as pair,
  (select count(*) from t where transaction_id not in (select transaction_id from flawed)) as only_left,
  (select count(*) from flawed where transaction_id not in (select transaction_id from t)) as only_right,
  (select count(*) from (select 1 from flawed group by transaction_id having count(*) > 1)) as repeated
union all select 'documents_labels',
  (select count(distinct doc_id) from documents where doc_id not in (select doc_id from labels)),
  (select count(distinct doc_id) from labels where doc_id not in (select doc_id from documents)),
  (select count(*) from (select doc_id from documents group by 1 having count(*) > 1
    union select doc_id from labels group by 1 having count(*) > 1))
union all select 'features_transactions',
  (select count(*) from f where transaction_id not in (select transaction_id from t)),
  (select count(*) from t where transaction_id not in (select transaction_id from f)),
  (select count(*) from (select 1 from f group by transaction_id having count(*) > 1))""")
_oracle("dq_temporal_order", ["flawed"], """
select 'ship_before_order' as relation, count(*) as violations from lineitem
  join orders on l_orderkey = o_orderkey where l_shipdate < o_orderdate
union all select 'confirmed_before_transaction', count(*) from flawed where confirmed_fraud_at < timestamp
""")
_oracle("dq_schema_columns", ["t"], """select "column", "check", forbidden,
  (select count(*) from t) as "rows" from (values
  ('event_id', 'column_in_schema', false), ('home_country', 'column_in_schema', false),
  ('fraud_label', 'column_in_schema', true), ('confirmed_fraud_at', 'column_in_schema', true),
  ('model_score', 'column_in_schema', false), ('merchant_number', 'column_in_schema', false),
  ('currency', 'column_in_dataframe', false), ('city', 'column_in_dataframe', false))
  v("column", "check", forbidden)""")

# ---------------------------------------------------------------- exploration

_oracle("eda_star", ["t"], """select transaction_id, fraud_label, merchant_category, home_country,
  country, amount from t""")
_oracle("eda_prevalence", ["t"], """select round(avg(fraud_label), 6) as prevalence,
  cast(sum(fraud_label) as bigint) as positives, count(*) as total from t""")
_oracle("eda_rate_by_hour", ["t"], """select cast(hour(timestamp) as bigint) as hour,
  round(avg(fraud_label), 6) as fraud_rate from t group by 1
  order by avg(fraud_label) desc, 1 limit 6""")
_oracle("eda_rate_by_category", ["t"], """select merchant_category,
  round(avg(fraud_label), 6) as fraud_rate from t group by 1""")
_oracle("eda_median_amount", ["t"], """select fraud_label,
  round(quantile_cont(amount, 0.5), 6) as median_amount from t group by 1""")
_oracle("eda_amount_hist", ["t"], """select fraud_label, least(cast(floor((x - lo) / (hi - lo) * 50)
    as bigint), 49) as bin, count(*) as n
  from (select fraud_label, least(amount, 1000) as x,
    min(least(amount, 1000)) over (partition by fraud_label) as lo,
    max(least(amount, 1000)) over (partition by fraud_label) as hi from t) group by all""")
_oracle("eda_flag_lift", ["t", "f"], """select flag, round(avg(fraud_label) filter (where v = 1), 6)
    as rate_flagged, round(avg(fraud_label) filter (where v = 0), 6) as rate_not_flagged,
  round(avg(fraud_label) filter (where v = 1) / avg(fraud_label) filter (where v = 0), 6) as lift
  from (select fraud_label, unnest(['is_new_device', 'ip_mismatch', 'is_cross_border']) as flag,
    unnest([is_new_device, ip_country_mismatch, is_cross_border]) as v
    from f join (select transaction_id, fraud_label from t) using (transaction_id))
  group by flag""")

# ---------------------------------------------------------------- split and metrics

_oracle("time_split", ["sp"], "select transaction_id, split from sp")
_oracle("time_split_counts", ["sp"], 'select split, count(*) as "rows" from sp group by split')
_oracle("class_weights", ["sp"], """select p as positives, n as negatives,
  round(n / greatest(p, 1), 6) as scale_pos_weight, round((p + n) / (2 * p), 6) as weight_positive,
  round((p + n) / (2 * n), 6) as weight_negative
  from (select count(*) filter (where fraud_label = 1) as p,
    count(*) filter (where fraud_label = 0) as n from sp where split = 'train')""")
_STEPS = """select s, pos, n, sum(pos) over (order by s desc) as tp, sum(n) over (order by s desc)
  as seen from (select model_score as s, sum(fraud_label) as pos, count(*) as n from t group by 1)"""
_oracle("metric_average_precision", ["t"],
        f"select round(sum(pos * tp / seen) / sum(pos), 6) as average_precision from ({_STEPS})")
ORACLES["metric_average_precision_blocks"] = ORACLES["metric_average_precision"]
_oracle("metric_roc_auc", ["t"], f"""select round(sum((n - pos) * (tp - pos + pos / 2))
  / (sum(pos) * sum(n - pos)), 6) as roc_auc from ({_STEPS})""")
_oracle("metric_prf_at_thresholds", ["t"], """select threshold,
  round(coalesce(tp / nullif(flagged, 0), 0), 6) as precision,
  round(coalesce(tp / nullif(p, 0), 0), 6) as recall,
  round(coalesce(2 * tp / nullif(flagged + p, 0), 0), 6) as f1
  from (select cast(threshold as double) as threshold,
    count(*) filter (where fraud_label = 1) as p,
    count(*) filter (where model_score >= threshold) as flagged,
    count(*) filter (where model_score >= threshold and fraud_label = 1) as tp
    from t, (values (0.3::double), (0.5::double), (0.7::double)) v(threshold)
    group by threshold)""")
_oracle("calibration_curve", ["t"], """select bin, round(avg(model_score), 6) as mean_predicted,
  round(avg(fraud_label), 6) as fraction_positive, count(*) as "rows" from (
  select *, cast(len(list_filter(e, lambda q: q < model_score)) as int) as bin from t,
    (select quantile_cont(model_score, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) as e from t))
  group by bin""")
_oracle("candidate_runs", ["runs"], "select * from runs")
_oracle("candidate_comparison", ["latest"], """select name, run_id, val_pr_auc, row_number() over (
    order by val_pr_auc desc, list_position(['baseline', 'random_forest', 'xgboost', 'lightgbm'],
    name)) = 1 as is_deployed from latest""")
_oracle("boosted_champion", ["latest"], """select name, val_pr_auc from latest
  where name in ('xgboost', 'lightgbm')
  order by val_pr_auc desc, list_position(['xgboost', 'lightgbm'], name) limit 1""")
_oracle("promotion_gate", ["latest"], """select r.name, r.run_id, r.val_pr_auc,
  l.val_pr_auc as champion_val_pr_auc, r.val_pr_auc >= l.val_pr_auc as may_promote
  from runs r, latest l where l.name = 'baseline'""")

# ---------------------------------------------------------------- policy and rules

_oracle("policy_cost", ["t"], f"""select missed_fraud, review_cost, false_positive_cost,
  missed_fraud + review_cost + false_positive_cost as total_cost from (select
  cast(sum(cast(case when model_score < {T_REVIEW} and fraud_label = 1 then amount else 0 end
    as decimal(18, 2))) as double) as missed_fraud,
  3.5::double * count(*) filter (where model_score >= {T_REVIEW} and model_score < {T_BLOCK})
    as review_cost,
  25.0::double * count(*) filter (where model_score >= {T_BLOCK} and fraud_label = 0)
    as false_positive_cost from t)""")
_oracle("threshold_grid", ["best"], "select * from best")
_oracle("cost_curve", ["curve"], "select * from curve")
_oracle("cost_interpolate", ["curve"], """select transaction_id, round(t, 6) as t, round(case
    when t <= lo_t then lo_c when t >= hi_t then hi_c
    else a.cost + (t - a.t_review) / (a.next_t - a.t_review) * (a.next_c - a.cost) end, 6) as cost
  from (select transaction_id, model_score as t from t) q
  cross join (select min(t_review) as lo_t, arg_min(cost, t_review) as lo_c,
    max(t_review) as hi_t, arg_max(cost, t_review) as hi_c from curve) ends
  left join (select t_review, cost, lead(t_review) over (order by t_review) as next_t,
    lead(cost) over (order by t_review) as next_c from curve) a
    on t > a.t_review and t <= a.next_t""")
_oracle("rules_eval", ["rl"], """select transaction_id, concat_ws(',',
    case when r1 then 'device_location_takeover' end, case when r2 then 'velocity_spike' end,
    case when r3 then 'high_risk_merchant' end,
    case when r4 then 'outsized_amount_new_device' end,
    case when al = 1 then 'trusted_allowlist' end) as triggered_rules,
  case when r1 or r2 then 'block' when r3 or r4 then 'review' else 'approve' end as rule_decision,
  al as is_allowlisted
  from (select *, case when customer_id in ('CUST0000007', 'CUST0000011')
    or merchant_id = 'MERC000042' then 1 else 0 end as al from rl)""")
_oracle("rules_allowlist_tables", ["rl"], """select
  case when r1 or r2 then 'block' when r3 or r4 then 'review' else 'approve' end as rule_decision,
  case when customer_id in (select concat('CUST', lpad(cast(c_custkey as varchar), 7, '0'))
      from customer where lower(c_mktsegment) = 'machinery')
    or merchant_id in (select merchant_id from t where merchant_category = 'travel')
    then 1 else 0 end as is_allowlisted, count(*) as n from rl group by all""")
_oracle("score_bands", ["t"], f"""select transaction_id, case when model_score >= {T_BLOCK} then 'block'
  when model_score >= {T_REVIEW} then 'review' else 'approve' end as band from t""")
_oracle("decide", ["dc"], "select transaction_id, decision, decision_source from dc")
_oracle("decision_records", ["dc"], f"""select id, transaction_id, round(model_score, 6) as model_score,
  decision, triggered_rules, decision_source, '{MODEL_RUN_ID}' as model_run_id, amount, created_at
  from dc""")
_oracle("policy_model_match", ["t"], f"""select '{MODEL_RUN_ID}' as model_run_id, count(*) as decisions,
  cast(policy_run = '{MODEL_RUN_ID}' as int) as policy_matches, policy_run
  from t, (values ('run-other'), ('{MODEL_RUN_ID}')) v(policy_run) group by policy_run""")

# ---------------------------------------------------------------- decision log

_oracle("decisions_page", ["dc"], """, ahead as (select * from dc where decision = 'review'
    and id < (select count(*) // 2 from dc) order by id desc limit 51),
  shown as (select * from ahead order by id desc limit 50)
select id, transaction_id, decision, case when (select count(*) from ahead) > 50
  then (select min(id) from shown) end as next_cursor from shown""")
ORACLES["decisions_page"] = ORACLES["decisions_page"].replace("\n, ahead", ", ahead")
ORACLES["log_page"] = ORACLES["decisions_page"]
_oracle("log_newest_page", ["dc"], """select id, transaction_id, case when (select count(*) from dc) > 100
  then (select min(id) from (select id from dc order by id desc limit 100)) end as next_cursor
  from dc order by id desc limit 100""")
_oracle("log_rows", ["dc"], "select id, transaction_id, decision, round(model_score, 6) as model_score, created_at from dc")
_oracle("log_files", ["dc"], """select count(*) as "rows", min(id) as first_id, max(id) as last_id,
  count(*) filter (where decision = 'review') as review_rows, 0::bigint as files_with_gaps, true as few_files_for_a_page
  from dc where floor(id * 8 / (select count(*) from dc)) < 6""")
_oracle("decisions_offset_page", ["dc"], """select id, transaction_id, decision from dc
  order by id desc limit 10 offset 30""")
_STATS = """select count(*) as total, count(*) filter (where decision = 'approve') as approve_count,
  count(*) filter (where decision = 'review') as review_count,
  count(*) filter (where decision = 'block') as block_count,
  round(coalesce(avg(model_score), 0), 6) as avg_score from dc"""
_oracle("decisions_stats", ["dc"], _STATS)
_oracle("decisions_stats_window", ["dc"],
        _STATS + " where created_at >= timestamp '2024-01-30 12:00:00' - interval 60 minute")
_oracle("rollup_stats", ["dc"], _STATS)
_oracle("rollup_stats_window", ["dc"],
        _STATS + " where created_at >= timestamp '2024-01-30 12:00:00' - interval 60 minute")
_oracle("decisions_by_minute", ["dc"], """select strftime(created_at, '%Y-%m-%dT%H:%M') as minute,
  decision, count(*) as "count" from dc group by all""")
_oracle("decisions_pivot", ["dc"], """select strftime(created_at, '%Y-%m-%dT%H:%M') as minute,
  count(*) filter (where decision = 'approve') as approve,
  count(*) filter (where decision = 'review') as review,
  count(*) filter (where decision = 'block') as block from dc group by 1""")
_oracle("kpi_cards", ["dc"], """select decision, count(*) as all_time, count(*) filter (
    where created_at >= timestamp '2024-01-30 12:00:00' - interval 1440 minute) as recent
  from dc group by decision""")
for _name in ("by_minute", "pivot"):
    ORACLES[f"rollup_{_name}"] = ORACLES[f"decisions_{_name}"]
ORACLES["rollup_kpi_cards"] = ORACLES["kpi_cards"].replace("12:00:00", "12:00:31")
_oracle("latest_decision", ["dc"], """select customer_id as transaction_id, id, created_at, decision
  from dc qualify row_number() over (partition by customer_id order by created_at desc, id desc) = 1
""")
_oracle("newest_rows", ["dc"], """select id, transaction_id, round(model_score, 6) as model_score
  from dc order by id desc limit 500""")
_oracle("first_rows", ["t"], """select transaction_id, amount from t order by transaction_id
  limit 200""")
_oracle("sample_rows", ["t"], """select transaction_id, amount from t
  order by md5(concat_ws(':', transaction_id, '42')) limit 200""")
_oracle("cyclic_batch", ["t"], """select transaction_id, amount, slot, next_cursor from (
  select *, (pos - (n - 10) + n) % n as slot, (n - 10 + 30) % n as next_cursor from (
    select transaction_id, amount, row_number() over (order by transaction_id) - 1 as pos,
      count(*) over () as n from t)) where slot < 30""")
_oracle("linear_attribution", ["contrib"],
        "select transaction_id, feature, round(value, 6) as value from contrib")
_oracle("explain_top5", ["contrib"], """select transaction_id,
  string_agg(feature, ',' order by abs(value) desc, place) as top_features from (
  select *, row_number() over (partition by transaction_id order by abs(value) desc, place) as r
  from contrib) where r <= 5 group by transaction_id""")
_oracle("global_importance", ["contrib"], """select feature,
  round(avg(abs(value)), 9) as mean_abs_contribution from contrib group by feature""")

# ---------------------------------------------------------------- drift and risk

_NUMERIC = [c for c in _FEATURE_NAMES[4:] if c != "payment_method"]


def _long(ref: str, cur: str) -> str:
    parts = [f"select '{c}' as col, cast({c} as double) as v, {i} as is_ref from {side}"
             for i, side in ((1, ref), (0, cur)) for c in _NUMERIC]
    return " union all ".join(parts)


def _distances(ref: str, cur: str) -> str:
    return f"""lv as ({_long(ref, cur)}),
  g as (select col, v, sum(is_ref) as r, sum(1 - is_ref) as c from lv group by col, v),
  cum as (select *, sum(r) over w / sum(r) over (partition by col) as fr,
    sum(c) over w / sum(c) over (partition by col) as fc,
    lead(v) over (partition by col order by v) as nv from g
    window w as (partition by col order by v)),
  sd as (select col, stddev_pop(v) as sd from lv where is_ref = 1 group by col),
  dist as (select col, coalesce(sum(abs(fr - fc) * (nv - v)), 0) / case when any_value(sd) > 1e-9
    then any_value(sd) else 1 end as wasserstein, max(abs(fr - fc)) as ks
    from cum join sd using (col) group by col)"""


def _js(ref: str, cur: str) -> str:
    return f"""select sqrt(greatest(sum(case when p > 0 then p * ln(p / ((p + q) / 2)) else 0 end
    + case when q > 0 then q * ln(q / ((p + q) / 2)) else 0 end) / 2, 0)) as js
  from (select payment_method, count(*) filter (where s = 1) / (select count(*) from {ref}) as p,
    count(*) filter (where s = 0) / (select count(*) from {cur}) as q
    from (select payment_method, 1 as s from {ref} union all select payment_method, 0 from {cur})
    group by 1)"""


_SIDES = """, ref as (select * from mxr where split = 'train'),
  cur as (select * from mxr where split <> 'train'),
"""


def _after(needs: list[str], more: str, body: str) -> str:
    return _with(needs, "@@").replace("\n@@", more + body)


ORACLES["drift_wasserstein"] = _after(["mxr"], _SIDES + _distances("ref", "cur"),
    '\nselect col as "column", round(wasserstein, 6) as wasserstein from dist')
ORACLES["drift_ks"] = _after(["mxr"], _SIDES + _distances("ref", "cur"),
    '\nselect col as "column", round(ks, 6) as ks from dist')
ORACLES["drift_ks_blocks"] = ORACLES["drift_ks"]
ORACLES["drift_far_values"] = """with a as (select o_orderkey % 2 as odd from orders),
  s as (select avg(odd) as p, stddev_pop(odd) as sd from a)
select 'amount' as "column", round(1 / sd, 6) as wasserstein, round(greatest(1 - p, p), 6) as ks from s"""
_METHODS = """(select case when cast(substr(transaction_id, 4, 10) as bigint) % {n} <> 0 then payment_method end
    as payment_method from t)"""
_oracle("drift_missing_categories", ["t"], """select 'payment_method' as "column", round(js, 6) as js from (
  """ + _js(_METHODS.format(n=2), _METHODS.format(n=3)) + """)
union all select 'itself', 0.0::double""")
ORACLES["drift_js"] = _after(["mxr"], _SIDES.rstrip().rstrip(","),
    f"\nselect 'payment_method' as \"column\", round(js, 6) as js from ({_js('ref', 'cur')})")
ORACLES["drift_summary"] = _after(["dc", "fr"], """, ref as (select * from fr),
  cur as (select * replace (round(amount_vs_customer_p95, 6) as amount_vs_customer_p95) from dc
    order by id desc limit 500),
""" + _distances("ref", "cur"), f"""
select (select count(*) from cur) as checked_rows, count(*) filter (where d >= 0.1)
  as drifted_columns_count, round(avg(case when d >= 0.1 then 1 else 0 end), 6) as drifted_share
from (select wasserstein as d from dist union all ({_js('ref', 'cur')}))""")
# Drift per column: all statistics from value counts; tails of the normal distribution by Simpson's rule.
def _column_tests(ref: str, cur: str) -> str:
    return f"""all_values as (select col, v::varchar as v, v as place, is_ref from lv
    union all select 'payment_method', payment_method, ascii(payment_method), 1 from {ref}
    union all select 'payment_method', payment_method, ascii(payment_method), 0 from {cur}),
  vc as (select col, v, any_value(place) as place, sum(is_ref) as r, sum(1 - is_ref) as c from all_values
    where v is not null group by col, v),
  vt as (select *, sum(r) over (partition by col) as n, sum(c) over (partition by col) as m from vc),
  st as (select col, any_value(n) as n, any_value(m) as m, count(*) as d, count(*) filter (where r > 0) as d_ref,
    sum(case when r > 0 then (c - r * m / n) ** 2 / (r * m / n) when c > 0 then 'infinity'::double else 0 end) as chi,
    arg_max(r / n, place) as p, arg_max(c / m, place) as q,
    sqrt(greatest(sum(case when r > 0 then r / n * ln(r / n / ((r / n + c / m) / 2)) else 0 end
      + case when c > 0 then c / m * ln(c / m / ((r / n + c / m) / 2)) else 0 end) / 2, 0)) as js
    from vt group by col),
  zs as (select *, (p * n + q * m) / (n + m) as pooled from st),
  tests as (select zs.*, ks, wasserstein, case when pooled > 0 and pooled < 1
      then (p - q) / sqrt(pooled * (1 - pooled) * (1 / n + 1 / m)) else 0 end as z,
    wasserstein is not null and d_ref > 5 as many
    from zs left join dist using (col))"""


def _tail(z: str) -> str:
    """Two-sided tail of the normal distribution."""
    return f"""(select greatest(0, 1 - sqrt(2 / pi()) * abs({z}) / 6000 * sum(
    case when i in (0, 2000) then 1 when i % 2 = 1 then 4 else 2 end * exp(-pow({z} * i / 2000, 2) / 2)))
    from range(0, 2001) s(i))"""


_P_VALUES = f"""
select col as "column", case when many then 'kolmogorov_smirnov' when d <= 2 then 'proportions_z' else 'chi_square' end as method,
  round(case when many then ks when d <= 2 then z else chi end, 6) as statistic, round(p_value, 6) as p_value, p_value < 0.05 as drifted
from (select *, case
  when many then least(1, greatest(0, (select sum(2 * (-1) ** (k - 1) * exp(-2 * (k * ks) ** 2 * n * m / (n + m)))
    from range(1, 101) s(k))))
  when d <= 2 then {_tail('z')}
  when d % 2 = 1 then (select sum(exp(-chi / 2) * (chi / 2) ** k / gamma(k + 1)) from range(0, (d - 1) // 2) s(k))
  else {_tail('sqrt(chi)')} + (select coalesce(sum(exp(-chi / 2) * (chi / 2) ** (k - 0.5) / gamma(k + 0.5)), 0)
    from range(1, (d - 2) // 2 + 1) s(k)) end as p_value from tests)"""
ORACLES["drift_tests"] = _after(["mxr"], _SIDES + _distances("ref", "cur") + ",\n  " + _column_tests("ref", "cur"), _P_VALUES)
ORACLES["drift_tests_blocks"] = ORACLES["drift_tests"]
ORACLES["drift_tests_summary"] = _after(["dc", "fr"], """, ref as (select * from fr),
  cur as (select * replace (round(amount_vs_customer_p95, 6) as amount_vs_customer_p95) from dc
    order by id desc limit 500),
""" + _distances("ref", "cur") + ",\n  " + _column_tests("ref", "cur"), """
select (select count(*) from cur) as checked_rows, count(*) filter (where case when many then wasserstein else js end >= 0.1)
  as drifted_columns_count, round(avg(case when case when many then wasserstein else js end >= 0.1 then 1 else 0 end), 6) as drifted_share
from tests""")
_oracle("table_fingerprint", ["t"], """select count(*) as "rows", cast(sum(cast(('0x' || substr(md5(
  concat_ws('|', transaction_id, customer_id, merchant_id, device_id, payment_method, country)),
  1, 15)) as hugeint)) as varchar) as content_hash from t""")


def _z(c: str) -> str:
    return (f"({c} - avg({c}) over ()) / case when stddev_pop({c}) over () > 1e-9"
            f" then stddev_pop({c}) over () else 1 end")


_oracle("zscore", ["f"], f"""select transaction_id, round({_z('amount')}, 6) as z_amount,
  round({_z('device_age_days')}, 6) as z_device_age_days from f""")
_RISK = "select transaction_id, " + " + ".join(
    f"({_z(c) if c in SCALED else c}) * {w}::double" for c, w in COEFFICIENTS.items()) + " as z from mx"
_oracle("latent_risk_score", ["mx"], f"select transaction_id, round(z, 6) as z from ({_RISK})")
ORACLES["prior_shift"] = _after(["mx"], f""", zs as materialized ({_RISK}),
  solve as (select 1 as i, -15.0::double as lo, 5.0::double as hi),
""" + ",\n".join(
    f"s{i} as materialized (select case when p < 0.015 then mid else lo end as lo,"
    f" case when p < 0.015 then hi else mid end as hi from (select any_value(lo) as lo,"
    f" any_value(hi) as hi, any_value(lo + hi) / 2 as mid,"
    f" avg(1 / (1 + exp(-((lo + hi) / 2 + z)))) as p"
    f" from zs, {'solve' if i == 1 else f's{i - 1}'}))" for i in range(1, 51)), """
select round((lo + hi) / 2, 6) as intercept,
  round(avg(1 / (1 + exp(-((lo + hi) / 2 + z)))), 6) as mean_probability, count(*) as "rows"
from zs, s50 group by lo, hi""")
_oracle("exact_quantiles", ["f"], """select payment_method, p as probability,
  round(case p when 0.05 then quantile_cont(amount, 0.05) when 0.5 then quantile_cont(amount, 0.5)
    else quantile_cont(amount, 0.95) end, 6) as quantile
  from f, (values (0.05::double), (0.5::double), (0.95::double)) v(p) group by payment_method, p""")

ORACLES["exact_quantiles_blocks"] = ORACLES["exact_quantiles"]

# ---------------------------------------------------------------- models, sinks and streams

_LINEAR = " + ".join([f"cast({INTERCEPT} as double)"] + [
    f"{c} * cast({w} as double)" for c, w in COEFFICIENTS.items()])
_BASE["ls"] = f"select *, 1 / (1 + exp(-({_LINEAR}))) as score from mx"
_NEEDS["ls"] = ["mx"]
_oracle("linear_scores", ["ls"],
        "select transaction_id, round(score, 6) as model_score from ls")
_oracle("parquet_round_trip", ["fr"], "select * from fr")
_oracle("csv_round_trip", ["t"],
        "select transaction_id, round(model_score, 6) as model_score from t")
_oracle("json_round_trip", ["fr"], """select transaction_id, txn_count_24h, device_age_days,
  case when cast(substr(transaction_id, 4, 10) as bigint) % 97 <> 0 then amount end as amount
  from fr""")
_oracle("policy_document", ["curve"], """select t_review, t_block, total_cost,
  'run-demo' as model_run_id, (select count(*) from curve) as points,
  (select arg_min(cost, t_review) from curve) as first_cost from best""")
_BASE["sd"] = f"""select *, case when fired and rlev >= mlev then list_extract(['approve', 'review',
    'block'], rlev + 1) else list_extract(['approve', 'review', 'block'], mlev + 1) end as decision,
  case when fired and rlev >= mlev then 'rule' else 'model' end as decision_source
  from (select transaction_id, score, r1 or r2 or r3 or r4 as fired,
    case when r1 or r2 then 2 when r3 or r4 then 1 else 0 end as rlev,
    case when score >= {T_BLOCK} then 2 when score >= {T_REVIEW} then 1 else 0 end as mlev,
    concat_ws(',', case when r1 then 'device_location_takeover' end,
      case when r2 then 'velocity_spike' end, case when r3 then 'high_risk_merchant' end,
      case when r4 then 'outsized_amount_new_device' end) as triggered_rules
    from rl join (select transaction_id, score from ls) using (transaction_id)
    where event_id % 97 <> 0)"""
_NEEDS["sd"] = ["rl", "ls"]
_oracle("stream_decisions", ["sd"], """select transaction_id, round(score, 6) as model_score, decision,
  decision_source, triggered_rules from sd""")
_oracle("stream_rejected", ["f_vel", "t"], """select transaction_id, txn_count_24h from f_vel
  join (select transaction_id, event_id from t) using (transaction_id) where event_id % 97 = 0""")
_oracle("stream_repeated_batch", ["t"], """select count(*) as "rows", count(*) as ids, 1 as same_largest,
  1 as without_gap from t where event_id % 97 <> 0""")
_oracle("stream_log_stats", ["sd"], """select count(*) as total,
  count(*) filter (where decision = 'approve') as approve_count,
  count(*) filter (where decision = 'review') as review_count,
  count(*) filter (where decision = 'block') as block_count,
  round(coalesce(avg(score), 0), 6) as avg_score from sd""")
_oracle("stream_batch_counts", ["t"], """select count(*) filter (where event_id % 97 <> 0) as scored,
  count(*) filter (where event_id % 97 = 0) as skipped from t""")
_oracle("decision_times", ["t"], """select event_id as id, case when epoch_us(timestamp) % 1000000 = 0
    then strftime(timestamp, '%Y-%m-%dT%H:%M:%S') else strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%f')
    end || '+00:00' as created_at from t""")

# Trained models: facts that follow from what training does, whatever the fitted numbers.
_oracle("trained_candidates", ["sp"], """select name, count(*) as "rows", sum(fraud_label)::bigint as positives,
  count(*) as in_range, 1 as better_than_chance
  from sp, (values ('baseline'), ('random_forest'), ('xgboost'), ('lightgbm')) v(name)
  where split = 'test' group by name""")
_oracle("tree_attribution", ["sp"], """select name, count(*) as "rows", count(*) as adding_up, count(*) as with_five
  from sp, (values ('xgboost'), ('lightgbm')) v(name) where split = 'test' group by name""")
_oracle("tree_decisions", ["f"], """select count(*) as "rows", count(*) as explained, count(*) as in_range from f""")
_DAYS = """select name, date_trunc('day', timestamp) as start_time, sum(fraud_label) as frauds
  from sp, (values ('baseline'), ('random_forest'), ('xgboost'), ('lightgbm')) v(name) where split = 'val' group by all"""
_oracle("trained_runs", ["sp"], f"""select name, concat_ws('-', name, strftime(start_time, '%Y%m%d')) as run_id, start_time,
  true as in_range from ({_DAYS})""")
_oracle("trained_comparison", ["sp"], f"""select count(distinct name) as candidates, 1::bigint as deployed, 1::bigint as deployed_is_best,
  strftime(max(start_time), '%Y%m%d') as newest_day, strftime(max(start_time), '%Y%m%d') as oldest_day from ({_DAYS})""")
_oracle("trained_gate", ["sp"], f"""select name, count(*) as runs, count(*) as judged_right
  from ({_DAYS}) group by name""")
ORACLES["trained_choice"] = """select 4::bigint as candidates, 1::bigint as deployed_is_best,
  1::bigint as boosted_is_best"""
_oracle("calibrated_mean", ["sp"], """select count(*) as "rows", round(avg(fraud_label), 6) as mean_score
  from sp where split = 'val'""")
# The isotonic fit as a maximum over left ends of minima over right ends of means.
_oracle("isotonic_map", ["val"], """, pts as (select floor(model_score * 100)::double as value, sum(fraud_label) as s, count(*) as n
    from val group by 1),
  run as (select value, sum(s) over (order by value) as upto, sum(n) over (order by value) as seen, s, n from pts),
  ends as (select a.value as low, b.value as high, (b.upto - a.upto + a.s) / (b.seen - a.seen + a.n) as mean
    from run a join run b on a.value <= b.value),
  least as (select x.value, e.low, min(e.mean) as mean from run x join ends e on e.low <= x.value and e.high >= x.value group by all)
select value, round(max(mean), 6) as calibrated from least group by value""")
ORACLES["isotonic_map"] = ORACLES["isotonic_map"].replace("\n, pts", ", pts")
ORACLES["isotonic_map_blocks"] = ORACLES["isotonic_map"]
_oracle("baseline_residual", ["sp"], """select round(count(*) / 2.0::double, 1) as weighted_positives,
  round(count(*) / 2.0::double, 1) as weighted_scores from sp where split = 'train'""")
ORACLES["stored_model_again"] = "select 1::bigint as figures, 2::bigint as better_than_chance"
_oracle("stored_policy", ["sp"], """select count(*) as "rows", true as cost_of_its_thresholds, true as none_cheaper,
  true as in_order from sp where split = 'val'""")
_oracle("anomaly_flags", ["sp"], """select count(*) as "rows", true as share_kept, 0::bigint as flagged_below,
  true as some_flagged from sp where split = 'train'""")
_oracle("deployed_comparison", ["sp"], """select least(100, count(*) filter (where split = 'train')) as background_rows,
  16::bigint as importances, true as largest_first, true as curve_covers_test, true as same_validation from sp""")
_oracle("anomaly_mean", ["sp"], """select count(*) as "rows", count(*) as inside, 0::bigint as missing
  from sp where split = 'test'""")
_oracle("json_array_source", ["f"], """select transaction_id, txn_count_24h,
  case when cast(substr(transaction_id, 4, 10) as bigint) % 97 <> 0 then amount end as amount
  from f""")
_BASE["sdt"] = "select sd.*, timestamp from sd join (select transaction_id, timestamp from t) using (transaction_id)"
_NEEDS["sdt"] = ["sd"]
ORACLES["stream_velocity"] = ORACLES["feat_velocity"]
_oracle("stream_minute_counts", ["sdt"], """select strftime(timestamp, '%Y-%m-%dT%H:%M') as minute, decision,
  count(*) as "count" from sdt group by all""")
