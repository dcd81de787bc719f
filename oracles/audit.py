"""Expected results: scans, audit, profiling, bands."""

from oracles.base import CLEAN, COLS, CUSTOMERS, LINES, ROW_ID, q

NAMES = [c.strip() for c in COLS.split(",")]
NUMERIC = ["Age", "AnnualIncome", "NumberOfPurchases", "TimeSpentOnWebsite", "DiscountsAvailed"]
INTEGERS = {"Age", "Gender", "NumberOfPurchases", "ProductCategory", "LoyaltyProgram", "DiscountsAvailed", "PurchaseStatus"}
TYPES = {c: "int" if c in INTEGERS else "double" for c in NAMES} | {"profile_id": "bigint"}
LEAKAGE = {
    "Age": ("pre_session", "low"), "Gender": ("pre_session", "low"), "AnnualIncome": ("pre_session", "low"),
    "NumberOfPurchases": ("pre_session", "low"), "ProductCategory": ("session_context", "medium"),
    "TimeSpentOnWebsite": ("session_end_proxy", "medium"), "LoyaltyProgram": ("pre_session", "medium"),
    "DiscountsAvailed": ("post_intervention_or_leaky", "high"), "PurchaseStatus": ("target", "high"),
}
INPUTS = {"Age", "AnnualIncome", "NumberOfPurchases", "TimeSpentOnWebsite", "Gender", "ProductCategory", "LoyaltyProgram"}


def each(columns, template):
    return " union all ".join(template(c) for c in columns)


def edges(column, source="cd"):
    return (f"(select list_sort(list_distinct(quantile_cont(cast({column} as double), [0,0.25,0.5,0.75,1]))) from {source})")


def band(column, edge_list):
    return (f"case when {column} is not null then cast(len(list_filter(list_slice({edge_list}, 2, len({edge_list})-1), "
            f"lambda v: v < cast({column} as double))) as int) end")


def rate_by_band(with_rate=True):
    rate = ", round(avg(PurchaseStatus),6) purchase_rate" if with_rate else ""
    part = lambda c: f"""select '{c}' column_name, b band_index, round(e[b+1],6) lower_edge, round(e[b+2],6) upper_edge,
      count(*) row_count{rate} from (select *, {band(c, 'e')} b from (select *, {edges(c)} e from cd)) where {c} is not null group by b, e[b+1], e[b+2]"""
    return each(NUMERIC, part)


def spelled():
    return """case profile_id%5 when 0 then concat(cast(PurchaseStatus as varchar),'.0') when 1 then concat(' ',cast(PurchaseStatus as varchar))
      when 2 then 'unknown' when 3 then null else cast(PurchaseStatus as varchar) end"""


FEATURE_EDGES = """,
tr as (select * from cd where split='train'),
fe as (select
  (select list_sort(list_distinct(quantile_cont(AnnualIncome,[0,0.25,0.5,0.75,1]))) from tr) ei,
  (select list_sort(list_distinct(quantile_cont(cast(NumberOfPurchases as double),[0,0.25,0.5,0.75,1]))) from tr) ep,
  (select list_sort(list_distinct(quantile_cont(TimeSpentOnWebsite,[0,0.25,0.5,0.75,1]))) from tr) et,
  (select quantile_cont(TimeSpentOnWebsite,0.75) from tr) high_time,
  (select quantile_cont(cast(NumberOfPurchases as double),0.25) from tr) low_history),
fx as (select cd.*,
  case when AnnualIncome is null then 'income_unknown' else 'income_q'||(1+""" + band("AnnualIncome", "ei") + """) end income_bucket,
  case when NumberOfPurchases is null then 'purchase_frequency_unknown' else 'purchase_frequency_q'||(1+""" + band("NumberOfPurchases", "ep") + """) end purchase_frequency_bucket,
  case when TimeSpentOnWebsite is null then 'time_spent_unknown' else 'time_spent_q'||(1+""" + band("TimeSpentOnWebsite", "et") + """) end time_spent_bucket,
  AnnualIncome/(coalesce(NumberOfPurchases,0)+1e0) income_per_purchase_proxy,
  coalesce(LoyaltyProgram,0)*TimeSpentOnWebsite loyalty_time_interaction,
  cast(case when TimeSpentOnWebsite>=high_time and coalesce(NumberOfPurchases,0)<=low_history then 1 else 0 end as int) high_time_low_history_flag,
  cast(case when coalesce(LoyaltyProgram,0)=0 and TimeSpentOnWebsite>=high_time then 1 else 0 end as int) non_loyal_high_time_flag
  from cd, fe)"""
FEATURES = CLEAN + FEATURE_EDGES + """,
ft as (select *, coalesce(cast(ProductCategory as varchar),'nan')||'__'||income_bucket category_income_interaction from fx)"""

SQL = {
    "customer_profile": q(CUSTOMERS, "select * from cp"),
    "scan_profile": q(CUSTOMERS, "select count(*) row_count, cast(count(case when "
                      + " and ".join(f"{c} is not null" for c in NAMES) + " then 1 end) as bigint) complete_rows, "
                      + ", ".join(f"count({c}) non_null_{c}" for c in NAMES) + " from cp"),
    "csv_rejects": q(CUSTOMERS, "select count(*) row_count, cast(count(case when " + " and ".join(
        f"{c} is not null" for c in NAMES) + " and profile_id%19<>0 then 1 end) as bigint) complete_rows, "
        + ", ".join(f"count({f'case when profile_id%19<>0 then {c} end' if c == 'TimeSpentOnWebsite' else c}) non_null_{c}" for c in NAMES)
        + ", (select count(*) from cp where profile_id%13=0 or profile_id%17=0) rejected_rows from cp where profile_id%13<>0 and profile_id%17<>0"),
    "schema_diff": q(CUSTOMERS, each(
        NAMES + ["profile_id"],
        lambda c: f"select '{c}' column_name, '{'unexpected' if c == 'profile_id' else 'matched'}' status, "
                  f"'{TYPES[c]}' data_type, count({c}) non_null_count from cp")),
    "coerce_numeric": q(CUSTOMERS, """select profile_id, try_cast(trim(case when profile_id%7=0 then 'n/a'
      when profile_id%11=0 then concat(' ',NumberOfPurchases,' ') when profile_id%5=0 then concat(NumberOfPurchases,'.5')
      else cast(NumberOfPurchases as varchar) end) as double) as value from cp"""),
    "binary_like_values": q(CUSTOMERS, f"""select case when t in ('0','0.0') then '0' when t in ('1','1.0') then '1' else t end as value,
      count(*) row_count from (select trim({spelled()}) t from cp) where t is not null group by 1"""),
    "role_projection": q(CUSTOMERS, "select profile_id, Age, AnnualIncome, NumberOfPurchases, TimeSpentOnWebsite, Gender, ProductCategory, LoyaltyProgram from cp"),
    "numeric_checks": q(CUSTOMERS, each(NUMERIC, lambda c: f"""select '{c}' column_name, round(min(cast({c} as double)),6) min_value,
      round(max(cast({c} as double)),6) max_value, round(avg({c}),6) mean_value,
      count(case when {c}<0 {'or Age>120' if c == 'Age' else ''} then 1 end) suspicious_count,
      {f'count(case when {c}%1<>0 then 1 end)' if c in INTEGERS else 'cast(0 as bigint)'} integer_violations from cp""")),
    "row_identity": q(CUSTOMERS, f"select profile_id, {ROW_ID} row_id from cp"),
    "column_profile": q(CUSTOMERS, each(NAMES, lambda c: f"""select '{c}' column_name, count({c}) non_null_count,
      count(*)-count({c}) null_count, count(distinct {c}) unique_count,
      {f'cast(min({c}) as double)' if c in NUMERIC else 'cast(null as double)'} min_value,
      {f'cast(max({c}) as double)' if c in NUMERIC else 'cast(null as double)'} max_value from cp""")),
    "category_preview": q(CUSTOMERS, each(
        ["Gender", "ProductCategory", "LoyaltyProgram", "NumberOfPurchases", "PurchaseStatus"],
        lambda c: f"""select '{c}' column_name, v as value, cast(rn as int) as position from (select v, row_number() over (order by v) rn
          from (select distinct cast({c} as varchar) v from cp where {c} is not null)) where rn<=10""")),
    "target_distribution": q(CUSTOMERS, """select cast(PurchaseStatus as varchar) as label, count(*) row_count,
      round(count(*)/(select count(*) from cp),6) rate from cp group by 1"""),
    "target_verdict": q(CUSTOMERS, """select count(*)-count(PurchaseStatus) missing_target_count,
      count(case when PurchaseStatus=0 then 1 end) zero_count, count(case when PurchaseStatus=1 then 1 end) one_count,
      count(case when PurchaseStatus not in (0,1) then 1 end) other_count, true is_binary_and_complete from cp"""),
    "missing_summary": q(CUSTOMERS, each(NAMES, lambda c: f"""select '{c}' column_name, count(*)-count({c}) missing_count,
      round((count(*)-count({c}))/count(*),6) missing_ratio,
      count(case when {' or '.join(f'{x} is null' for x in NAMES)} then 1 end) rows_with_missing,
      cast({' + '.join(f'(count(*)-count({x}))' for x in NAMES)} as bigint) total_missing_cells from cp""")),
    "duplicate_summary": q(CUSTOMERS, f"""select cast(sum(k-1) as bigint) duplicate_row_count, round(sum(k-1)/sum(k),6) duplicate_rate,
      count(case when k>1 then 1 end) duplicate_group_count,
      cast(coalesce(sum(case when k>1 and PurchaseStatus=0 then k end),0) as bigint) duplicate_members_label_0,
      cast(coalesce(sum(case when k>1 and PurchaseStatus=1 then k end),0) as bigint) duplicate_members_label_1
      from (select {COLS}, count(*) k from cp group by all)"""),
    "duplicate_preview": q(CUSTOMERS, f"""select * from (select {COLS}, count(*) copies from cp group by all) where copies>1
      order by copies desc, {', '.join(c + ' nulls first' for c in NAMES)} limit 5"""),
    "dedup": q(CUSTOMERS, f"select distinct {COLS} from cp"),
    "go_decision": q(CUSTOMERS, f"""select cast(sum(k) as bigint) row_count, round(sum(k-1)/sum(k),6) duplicate_rate, true target_valid,
      'Conditional Go' decision from (select {COLS}, count(*) k from cp group by all)"""),
    "leakage_risk": q(CUSTOMERS, each(NAMES, lambda c: f"""select '{c}' column_name, count({c}) non_null_count,
      round(corr({c}, PurchaseStatus),6) label_correlation, '{LEAKAGE[c][0]}' availability_stage, '{LEAKAGE[c][1]}' risk_level,
      {'true' if c in INPUTS else 'false'} model_input from cp""")),
    "numeric_summary": q(CLEAN, each(NUMERIC, lambda c: f"""select '{c}' column_name, round(avg({c}),6) mean_value, round(stddev_samp({c}),6) std_value,
      round(min(cast({c} as double)),6) min_value, round(max(cast({c} as double)),6) max_value, round(skewness({c}),6) skew_value,
      round(quantile_cont(cast({c} as double),0.5),6) median_value from cd""")),
    "purchase_rate_by_category": q(CLEAN, each(["Gender", "ProductCategory", "LoyaltyProgram", "DiscountsAvailed"], lambda c:
        f"select '{c}' column_name, cast({c} as varchar) as value, count(*) row_count, round(avg(PurchaseStatus),6) purchase_rate from cd group by 2")),
    "purchase_rate_lookup": q(CLEAN, """select 'ProductCategory' column_name, w.v as value, coalesce(r.pr,0e0) purchase_rate
      from (select distinct cast(NumberOfPurchases%8 as varchar) v from cp) w left join
      (select cast(ProductCategory as varchar) v, round(avg(PurchaseStatus),6) pr from cd group by 1) r on r.v=w.v"""),
    "purchase_rate_by_band": q(CLEAN, rate_by_band()),
    "quantile_bands": q(CLEAN, rate_by_band(False)),
    "target_correlation": q(CLEAN, each(NUMERIC, lambda c: f"select '{c}' column_name, round(corr({c}, PurchaseStatus),6) correlation from cd")),
    "correlation_matrix": q(CLEAN, each(
        [(a, b) for a in NUMERIC + ["PurchaseStatus"] for b in NUMERIC + ["PurchaseStatus"]],
        lambda t: f"select '{t[0]}' left_column, '{t[1]}' right_column, round(corr({t[0]}, {t[1]}),6) correlation from cd")),
    "segment_profiles": q(CLEAN, f"""select {band('Age', 'ea')} age_band, {band('AnnualIncome', 'ei')} income_band, LoyaltyProgram,
      count(*) row_count, round(avg(PurchaseStatus),6) purchase_rate
      from (select *, {edges('Age')} ea, {edges('AnnualIncome')} ei from cd) group by 1,2,3
      order by row_count desc, purchase_rate desc, age_band, income_band, LoyaltyProgram limit 10"""),
    "anomaly_segments": q(CLEAN, """select count(case when AnnualIncome>=qi then 1 end) high_income_row_count,
      round(avg(case when AnnualIncome>=qi then PurchaseStatus end),6) high_income_purchase_rate,
      count(case when TimeSpentOnWebsite>=qt and NumberOfPurchases<=qp then 1 end) high_time_low_history_row_count,
      round(avg(case when TimeSpentOnWebsite>=qt and NumberOfPurchases<=qp then PurchaseStatus end),6) high_time_low_history_purchase_rate
      from cd, (select quantile_cont(AnnualIncome,0.95) qi, quantile_cont(TimeSpentOnWebsite,0.95) qt,
        quantile_cont(cast(NumberOfPurchases as double),0.25) qp from cd)"""),
    "iqr_outliers": q(CLEAN, each(["Age", "AnnualIncome", "NumberOfPurchases", "TimeSpentOnWebsite"], lambda c:
        f"""select '{c}' column_name, round(a-1.5e0*(b-a),6) lower_bound, round(b+1.5e0*(b-a),6) upper_bound,
        count(case when {c}<a-1.5e0*(b-a) or {c}>b+1.5e0*(b-a) then 1 end) outlier_count from cd,
        (select quantile_cont(cast({c} as double),0.25) a, quantile_cont(cast({c} as double),0.75) b from cd where split='train')
        where split='train' group by a, b""")),
    "target_raw_vs_dedup": q(CLEAN, """select cast(r.y as varchar) as label, raw_count, dedup_count,
      round(raw_count/(select count(*) from cp),6) raw_rate, round(dedup_count/(select count(*) from cd),6) dedup_rate,
      (select count(*) from cp)-(select count(*) from cd) dropped_rows
      from (select PurchaseStatus y, count(*) raw_count from cp group by 1) r
      join (select PurchaseStatus y, count(*) dedup_count from cd group by 1) d on r.y=d.y"""),
    "numeric_histogram": q(CLEAN, each(NUMERIC, lambda c: f"""select '{c}' column_name, bi bin_index, round(lo+bi*w,4) bin_start, count(*) row_count from
      (select lo, w, cast(least(floor((cast({c} as double)-lo)/w),19) as int) bi from cd,
      (select cast(min({c}) as double) lo, (cast(max({c}) as double)-cast(min({c}) as double))/20 w from cd) where {c} is not null) group by bi, lo, w""")),
    "imbalance_profile": q(LINES, """select cast(arg_min(y,k) as varchar) minority_label, cast(arg_max(y,k) as varchar) majority_label,
      min(k) minority_count, max(k) majority_count, round(min(k)/max(k),6) minority_to_majority_ratio,
      case when round(min(k)/max(k),6)>=0.75 then 'mild' when round(min(k)/max(k),6)>=0.5 then 'moderate' else 'severe' end severity
      from (select PurchaseStatus y, count(*) k from lp where split='train' group by 1)"""),
    "feature_edges": q(CLEAN + FEATURE_EDGES, " union all ".join(
        f"select '{n}' bucket, cast(i as int) edge_index, round({e}[i+1],6) edge from fe, range(1, 4) t(i) where i <= len({e})-2"
        for n, e in (("income_bucket", "ei"), ("purchase_frequency_bucket", "ep"), ("time_spent_bucket", "et")))),
    "feature_bands": q(FEATURES, """select income_bucket, purchase_frequency_bucket, time_spent_bucket, split, count(*) row_count
      from ft group by all"""),
    "fixed_bands": q(CUSTOMERS, """select case when Age>=17 and Age<=29 then '18_29' when Age>29 and Age<=44 then '30_44'
      when Age>44 and Age<=70 then '45_plus' else 'unknown' end age_band,
      case when AnnualIncome>=0 and AnnualIncome<=50000 then 'income_low' when AnnualIncome>50000 and AnnualIncome<=90000 then 'income_mid'
      when AnnualIncome>90000 then 'income_high' else 'unknown' end income_band, count(*) row_count from cp group by 1,2"""),
}
